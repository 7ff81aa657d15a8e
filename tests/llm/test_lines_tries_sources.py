"""Line dedup, prefix trie and source divergence against plain Python on awkward rows."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from folio.llm import divergence, line_dedup, prefix_trie
from tests.llm import cases

WS = "[\x20\x09-\x0d]"


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- line dedup


def lines_by_hand(rows, least_docs, least_chars):
    key = lambda line: lower(re.sub(f"^{WS}+|{WS}+$", "", line))
    order = lambda doc: (doc is not None, doc)
    holders = collections.defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least_chars or len(holders[key(x)]) < least_docs
                or doc == max(holders[key(x)], key=lambda d: order(d) if d is not None else (False, 0))]
        out.append((doc, len(lines), len(lines) - len(kept), digest("\n".join(kept))))
    return sorted(map(repr, out))


def line_rows(rng):
    shared = [f"this line number {i} is in many documents" for i in range(12)] + ["É" * 19, "É" * 20, "short", "x" * 20, " ", " " + "y" * 19]
    rows = [(None, "a line of no document at all\nthis line number 1 is in many documents"), (None, None), (3, ""), (4, "\n\n"), (5, "\n")]
    for i in range(10, 90):
        own = [f"own line {i} with some words {k}" for k in range(rng.randrange(4))]
        lines = own + [rng.choice([str.upper, str, lambda x: f" \t{x}\x0b ", lambda x: x + "\r"])(x) for x in rng.choices(shared, k=rng.randrange(6))]
        lines += ["the line that all of them hold, once or twice"] * rng.randrange(1, 3)
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    return rows + [rows[20]] * 40 + [(20, "the line that all of them hold, once or twice\nother text, same id")] + [
        (200, "\n".join(f"line {k % 700} of a very long document" for k in range(20_000)))] + [
        (201 + k, "line 5 of a very long document\nline 6 of a very long document") for k in range(3)]


def line_frame(spark, rows):
    return spark.createDataFrame([(d, t, "k", 1, 2) for d, t in rows], "doc_id long, text string, bitmap string, id long, perhaps int")


@pytest.mark.parametrize("partitions, least_docs", [(1, 3), (7, 3), (60, 3), (60, 2)])
def test_lines_stay_in_the_first_document_that_holds_them(spark, partitions, least_docs):
    rows = line_rows(random.Random(3))
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)  # with many, a line goes on over many tasks
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = line_dedup.dedup(line_frame(spark, rows), least_docs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    assert sorted(repr(tuple(r)) for r in got) == lines_by_hand(rows, least_docs, 20)


def test_line_bitmaps_of_few_documents_and_none(spark):
    assert line_dedup.dedup(line_frame(spark, [])).collect() == []
    rows = [(1, "one line that is long enough\nb"), (2, "One line that is long enough"), (3, "c\n one line that is long enough \nd")]
    bitmaps = line_dedup.keep_bitmaps(line_frame(spark, rows)).collect()
    assert {r["id"]: line_dedup.unpack(r["n_lines"], r["bitmap"]).tolist() for r in bitmaps} == {1: [False, True], 2: [False]}
    texts = {r["doc_id"]: bytes(r["kept"]).decode() for r in line_dedup.apply(line_frame(spark, rows), line_dedup.keep_bitmaps(line_frame(spark, rows))).collect()}
    assert texts == {1: "b", 2: "", 3: rows[2][1]}


# --- prefix trie


def trie_by_hand(rows):
    """rows: (conv_id, turn, role, text)."""
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
        own[conv].append(((turn is not None, turn or 0, tie), role, text))
    own = {c: [x[1:] for x in sorted(t)] for c, t in own.items()}
    built = {}
    for c, turns in own.items():
        if c is None:
            built[c] = turns
            continue
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        built[c] = own.get(base, [])[:h] + turns[h:]
    last = lambda c: (c is None, c or 0)
    nodes = collections.defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    children = collections.Counter(p[:-1] for p in nodes if p)
    least = {p: min(m, key=last) for p, m in nodes.items()}
    saved, leaves = collections.Counter(), collections.Counter()
    for p, m in nodes.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
            leaves[p[:d]] += not children[p]
    return sorted(repr((least[p], len(p), least[p[:-1]] if p else None, len(m), children[p], leaves[p], saved[p],
                        digest(",".join("" if c is None else str(c) for c in sorted((c for c in m if built[c] == list(p)), key=last)))))
                  for p, m in nodes.items())


CONVERSATIONS = "conv_id long, turn long, role string, text string, id string, d int, a int"


def conversation_rows(rng):
    say = lambda: (rng.choice(["user", "assistant", None, ""]), rng.choice(["hi", "hello there", "", None, "a:b", "é" * 3]))
    rows = []
    for conv in [*range(-3, 40), *range(100, 160), *range(270, 300), None]:
        if conv in (105, 270):
            continue
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, rng.choice([turn, turn, turn, None, 1]), *say()))
    for conv in range(400, 460):  # copies of one conversation
        rows += [(conv, 0, "user", "same"), (conv, 1, "assistant", "same answer"), (conv, 2, "user", "same again")]
    rows += [(500, 0, "user", "again")] * 30
    rows += [(600, t, "user", f"turn {t // 2}") for t in range(300)] + [(700, t, "user", f"turn {t // 2}") for t in range(0, 300)] \
        + [(800, t, "user", f"turn {t // 2}" if t != 200 else "else") for t in range(300)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_every_prefix_is_a_node(spark, seed):
    rows = conversation_rows(random.Random(seed))
    turns, members = prefix_trie.with_shared_heads(prefix_trie.numbered(spark.createDataFrame([(*r, "x", 1, 2) for r in rows], CONVERSATIONS)))
    got = prefix_trie.trie(turns, members).collect()
    assert sorted(repr(tuple(r)) for r in got) == trie_by_hand(rows)


def test_empty_and_turnless_conversations(spark):
    none = spark.createDataFrame([], CONVERSATIONS)
    turns, members = prefix_trie.with_shared_heads(prefix_trie.numbered(none))
    assert prefix_trie.trie(turns, members).collect() == []
    only = spark.createDataFrame([(7,), (9,)], "id long")
    (root,) = prefix_trie.trie(turns, only).collect()
    assert tuple(root) == (7, 0, None, 2, 0, 1, 0, digest("7,9"))


def test_two_fattest_depth(spark):
    pairs = [(a, b) for a in range(0, 40) for b in range(a + 1, 41)]
    got = spark.createDataFrame(pairs, "x long, y long").select("x", "y", prefix_trie.two_fattest("x", "y").alias("f")).collect()
    assert all(r["f"] == max(range(r["x"] + 1, r["y"] + 1), key=lambda k: k & -k) for r in got)


# --- source divergence


def audit_by_hand(rows, least_docs, top):
    docs = [(lang or "", source or "", re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lower(text or ""))) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        frequency = collections.Counter(t for d in mine for t in set(d[2]))
        kept = sorted(t for t, n in frequency.items() if n >= least_docs)
        counts = collections.defaultdict(collections.Counter)
        for _, source, words in mine:
            counts[source].update(w for w in words if w in set(kept))
        total = sum(counts.values(), collections.Counter())
        weight = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
        f = lambda p, q: (p - q) ** 2 // (p + q)
        p, q = {s: weight(counts[s]) for s in {d[1] for d in mine}}, weight(total)
        for s in p:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in p if o != s]
            items = [(f(p[s][t], q[t]), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", items)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, x, v, k + 1) for k, (v, x) in enumerate(ranked) if part == "pair" or k < top]
    return sorted(map(repr, out))


SOURCES = "lang string, source string, text string, doc_id long, term string, n int, p int"


def source_rows(rng):
    words = [f"{a}{b}" for a in ["al", "Be", "éa", "ÉA", "ga", "x"] for b in ["", "n", "Or", "ß", "中"]]
    rows = [(None, None, None), ("", "a", ""), ("empty", "s", None), ("empty", "t", "12 _ 3"), ("one", "alone", "alpha beta"), ("en", "wordless", "1234 !?")]
    for k in range(400):
        lang, source = rng.choice(["en", "en", "de", None]), rng.choice(["s1", "s1", "s1", "s2", "s3", "S3", None])
        rows.append((lang, source, " ".join(rng.choices(words[:12] if source == "s2" else words, k=rng.randrange(30))) + rng.choice(["", "_x1y", "'s"])))
    return rows + [("en", s, "one Text that is copied everywhere AL") for s in ["s1", "s2", "s9"] * 50] + [("de", "s1", "one Text that is copied everywhere AL")] * 60


@pytest.mark.parametrize("block", [256, 2])
def test_divergence_of_sources(spark, block):
    rows = source_rows(random.Random(9))
    docs = spark.createDataFrame([(*r, 1, "x", 1, 2) for r in rows], SOURCES)
    got = [tuple(r) for r in divergence.audit(docs, 10, 4, block).collect()]
    assert sorted(map(repr, got)) == audit_by_hand(rows, 10, 4)
    assert divergence.audit(docs.limit(0)).collect() == []


def test_tallies_are_handed_on_when_full():
    tally = divergence.Tally()
    counts, docs = tally.of("en", "s")
    counts.update([b"a", b"a", b"b"])
    docs.update({b"a", b"b"})
    (part,) = tally.take()
    assert sorted(zip(part["term"], part["n"], part["docs"])) == [(b"a", 2, 1), (b"b", 1, 1)]
    assert tally.entries() == 0 and list(tally.take()) == []


def test_awkward_documents_have_results_of_all_three(spark):
    docs = cases.frame(spark, cases.awkward())
    n = docs.count()
    assert line_dedup.dedup(docs).count() == n
    assert divergence.audit(docs).where(F.col("part") == "pair").count() == 0  # one source only
