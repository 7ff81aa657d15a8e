"""URL filter, sharding, PII, BPE, chat formatting, toxicity and decontamination on awkward rows."""

import collections
import hashlib
import random
import re

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folio.llm import bpe, chat_format, decontaminate, pii, sharding, toxicity, url_filter
from folio.llm.queries import URL_RULES, vocabulary_path
from tests.llm import cases

URLS = [None, "", "no scheme", "http://", "http:///de/x", "HTTP://Example.ORG/es/a?b#c", "http://a.example.org/es", "http://example.org/en/123/x",
        "http://notexample.org/es/", "http://x.com/fr/1", "http://x.com/de/1", "http://com/de/", "http://b..com/de/", "http://u@h.com:80/fr/?q",
        "http://x.net/de/", "http://org", "http://org?x/y", "a://b://c.org/", "http://example.org#/es/", "http://com./de/", "http://x.com/FR/"]


def by_hand(url, rules):
    tail = url[url.index("://") + 3:] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", tail).group()
    path = re.match(r"[^?#]*", tail[len(host):]).group()
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    fits = []
    for verdict, rule in rules:
        h, slash, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(slash + p):
            fits.append((len(h) + len(slash + p), len(h), rule, verdict))
    return host, path, max(fits)[2] if fits else None, max(fits)[3] if fits else "allow"


@pytest.mark.parametrize("most", [100, 0])
def test_url_rules_by_trie_and_by_join(spark, most):
    rules = [*URL_RULES, url_filter.Rule("allow", "example.org/en/12"), url_filter.Rule("block", "a.example.org"), url_filter.Rule("allow", "a.example.org")]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS * 2)], "page_id long, url string, rule string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(pages, rules, max_broadcast_rules=most).collect()}
    assert got == {i: by_hand(u, rules) for i, u in enumerate(URLS * 2)}
    listed = spark.createDataFrame([tuple(r) for r in rules], "verdict string, rule string")
    assert url_filter.judge(pages, listed, max_broadcast_rules=most).count() == len(got)
    assert url_filter.judge(pages.limit(0), rules).count() == 0


def test_sharding_is_balanced_gapless_and_versioned(spark, tmp_path):
    rng = random.Random(1)
    rows = cases.awkward() + [(1000 + i, "t" * rng.randrange(300)) for i in range(3000)]
    docs = cases.frame(spark, rows)
    got = sharding.shard(docs, 7, str(tmp_path / "map"), n_slots=512).collect()
    assert len(got) == len(rows)
    assert collections.Counter(r["size"] for r in got) == collections.Counter(len((t or "").encode()) + 16 for _, t in rows)
    total, places = collections.Counter(), collections.defaultdict(list)
    for r in got:
        total[r["shard"]] += r["size"]
        places[r["shard"]].append(r["slot"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values()) and set(places) == set(range(7))
    assert max(total.values()) - min(total.values()) < 0.02 * sum(total.values()) / 7
    first, latest = sharding.load_map(spark, str(tmp_path / "map"), 1), sharding.load_map(spark, str(tmp_path / "map"))
    assert {r["version"] for r in latest.collect()} == {2} and first.count() == latest.count() == 512


def test_a_row_repeated_a_thousand_times_is_spread_over_shards(spark, tmp_path):
    import zlib
    rng = random.Random(3)
    rows = [(7, "same text again")] * 1000 + [(None, None)] * 300 + [(i, "x" * rng.randrange(40)) for i in range(100, 1100)]
    got = sharding.shard(cases.frame(spark, rows).repartition(5), 6, str(tmp_path / "map"), n_slots=256).collect()
    want = collections.Counter((k, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), "bytes", None) for k, t in rows)
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"], r["law"], r["grown_shard"]) for r in got) == want
    total, places, slots = collections.Counter(), collections.defaultdict(list), collections.Counter()
    for r in got:
        total[r["shard"]] += r["size"]
        places[r["shard"]].append(r["slot"])
        slots[r["virtual_slot"]] += 1
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(total.values()) - min(total.values()) < 0.03 * sum(total.values()) / 6 and max(slots.values()) < 60
    owner = {r["slot"]: r for r in sharding.load_map(spark, str(tmp_path / "map")).collect()}
    assert all(owner[r["virtual_slot"]]["shard"] == r["shard"] for r in got)
    assert all((s["parent"] is not None) == (k >= 256) for k, s in owner.items()) and len(owner) > 256


def test_growing_moves_slots_only_where_needed():
    rng = random.Random(2)
    sizes = {s: (rng.randrange(1, 1000), 1) for s in range(400)}
    before = sharding.rebalance(sharding.even_map(5, 400), sizes, 5)
    after = sharding.rebalance(before, sizes, 6)
    moved = [s for s in before if before[s] != after[s]]
    load = collections.Counter()
    for s, k in after.items():
        load[k] += sizes[s][0]
    assert len(moved) < 120 and max(load.values()) - min(load.values()) < 1000
    assert sharding.rebalance(after, sizes, 6) == after
    assert sharding.rebalance(sharding.even_map(3, 9), {}, 3) == sharding.even_map(3, 9)


_BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_by_hand(text):
    def ok(kind, found):
        digits = re.sub("[^0-9]", "", found)
        return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in found.split(".")),
                "card": 13 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
    return {k: [m.span() for m in re.finditer(p, text) if ok(k, m.group())] for k, p in _BASE.items()}


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a.@1-+ 2(%0.9@b4é", max_size=40))
def test_base_detectors_match_the_plain_patterns(text):
    assert pii.detect(text) == base_by_hand(text)


@pytest.mark.parametrize("text,kind,found", [
    ("mail john.doe [at] example [dot] com now", "email", "john.doe [at] example [dot] com"),
    ("john at example dot com", "email", "john at example dot com"),
    ("write john(at)mail.example.com", "email", "john(at)mail.example.com"),
    ("j\u043ehn@ex\u0430mple.com!", "email", "j\u043ehn@ex\u0430mple.com"),
    ("x \uff14\uff11\uff11\uff11 1111 1111 1111 y", "card", "\uff14\uff11\uff11\uff11 1111 1111 1111"),
    ("call four one one one one one one one one one one one one one one one", "card",
     "four one one one one one one one one one one one one one one one"),
    ("host 1\uff10.0.0.1 up", "ip", "1\uff10.0.0.1"),
    ("+4\uff19 30 1234567", "phone", "+4\uff19 30 1234567"),
])
def test_disguised_identifiers_map_back_to_their_source(text, kind, found):
    base, added = pii.scan(text)
    assert [text[s:e] for s, e in added[kind]] == [found]
    assert base == base_by_hand(text)


@pytest.mark.parametrize("text", ["look at example.com", "we met at noon, dot com boom", "one two things", "a\u200bb@c.de", "", "meet at ten dot"])
def test_clean_text_gets_no_added_span(text):
    assert not any(pii.scan(text)[1].values())


def test_pii_rows(spark):
    rows = [*cases.awkward(), (90, "a@b.c and 1.2.3.4 " + "1" * 50_000), (91, "x@" * 20_000), (92, "j at ex dot org")]
    got = pii.find(cases.frame(spark, rows).withColumnRenamed("row", "spans")).collect()
    assert len(got) == len(rows)
    for r in got:
        base = base_by_hand(r["text"] or "")
        own = ",".join(f"{k}:{s}:{e}" for k in pii.KINDS for s, e in base[k])
        assert r["base_sha256"] == hashlib.sha256(own.encode()).hexdigest() and set(own.split(",")) <= set(r["spans"].split(",")) | {""}
        assert [r["n_" + k] for k in pii.KINDS] == [len(base[k]) for k in pii.KINDS]


@pytest.fixture(scope="module")
def tokenizer():
    t = pytest.importorskip("tokenizers").Tokenizer.from_file(vocabulary_path())
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.Vocabulary(bpe.load(vocabulary_path())))


def same(tokenizer, encoder, texts):
    for text, (n, ids, decoded) in zip(texts, encoder.encode(texts)):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert ids == " ".join(map(str, want)) and n == len(want), text
        assert decoded == tokenizer.decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcdeghinorstABE 'lvm.,0129\n\t<|>_\u00e9\u00fc\u00df\u0436\u03a3\u65e5\U0001f600\u0301", max_size=60))
def test_bpe_equals_the_library(tokenizer, encoder, text):
    same(tokenizer, encoder, [text])


def test_bpe_equals_the_library_on_hard_texts(tokenizer, encoder, monkeypatch):
    rng = random.Random(3)
    texts = ["", "<|endoftext|>x <|startoftext|>Hello don't I'LL 'S", "x" * 3000, "aaaa" * 50 + "b", "\x00\x01 ab\x85c\u2003d", "it's'll''s \u0130 \ufb01 \u0391\u03a3 \u03c2",
             "<|endoftext|", "e\u0301 \u1e9b\u0323"]
    texts += ["".join(rng.choice(["th", "in", "er", "an", "ing", "tion", "re", "s", "a", "e", "x", "q"]) for _ in range(rng.randrange(30))) for _ in range(800)]
    same(tokenizer, encoder, texts)
    assert encoder.failed > 0  # some proposals fail and are merged exactly
    monkeypatch.setattr(bpe, "MAX_WORDS", 50)
    monkeypatch.setattr(bpe, "MAX_PAIRS", 40)
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 200)
    same(tokenizer, encoder, texts)


def test_bpe_rows(spark, tokenizer):
    rows = cases.awkward()
    got = bpe.encode(cases.frame(spark, rows).withColumnRenamed("score", "ids"), bpe.load(vocabulary_path())).collect()
    assert collections.Counter((r["doc_id"], r["ids"]) for r in got) == collections.Counter(
        (i, " ".join(map(str, tokenizer.encode(t or "", add_special_tokens=False).ids))) for i, t in rows)


@pytest.mark.parametrize("digests_only", [False, True])
def test_bpe_hands_out_runs_of_texts_not_whole_batches(encoder, monkeypatch, digests_only):
    """Ids and decoding are longer than the text; a task holds those of one run, however many rows a batch has."""
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 100)
    texts = ["a word or two", None, "", "x" * 250, *["some words"] * 60, "<|endoftext|>"]
    batches = [pd.Series(texts, dtype=object), pd.Series([], dtype=object), pd.Series(texts[::-1], dtype=object)]
    names = ("first", "second")
    got = list(bpe.frames(encoder, iter(batches), names, digests_only))
    both = texts + texts[::-1]
    want = [(n, *(hashlib.sha256(x.encode()).hexdigest() if digests_only else x for x in xs)) for n, *xs in encoder.encode(both)]
    assert [tuple(r) for f in got for r in f[["n_tokens", *names]].itertuples(index=False)] == want
    at = 0
    for f in got:
        sizes = [len(t or "") for t in both[at:at + len(f)]]
        assert len(f) and sum(sizes[:-1]) < 100
        at += len(f)


CHAT = "conv_id long, turn long, role string, text string"
NASTY = ["<|im_end|>", "<\\|im_start|>x", "<\\\\|", "<|n|>", "a<", "|b", "", None, "line\nend\n", "<<||>>", "<|im_start|>assistant\nok<|im_end|>\n"]


def formatted(spark, rows, **options):
    return chat_format.render(chat_format.fold(chat_format.as_events(spark.createDataFrame(rows, CHAT))), **options)


@pytest.mark.parametrize("size", [64, 3])
def test_chat_round_trip(spark, size):
    rng = random.Random(9)
    rows = [(c, t, rng.choice(["user", "assistant", "sys<|im_end|>\ntem", None]), rng.choice(NASTY)) for c in (1, 2, None) for t in range(40)]
    rows += [(7, None, "assistant", "x"), (7, -5, "user", "<"), (8, 1, "assistant", "dup"), (8, 1, "assistant", "dup")]
    blocks = formatted(spark, rows, turns_per_block=size)
    whole = {r["conv_id"]: r for r in chat_format.conversations(blocks).collect()}
    back = collections.defaultdict(list)
    for b in sorted(chat_format.read_back(blocks).collect(), key=lambda b: b["char_start"]):
        back[b["conv_id"]].append(b)
    for conv in {r[0] for r in rows}:
        want = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is None, r[1] or 0, r[2] or "", r[3] or ""))]
        assert [(t["role"], t["text"]) for b in back[conv] for t in b["turns"]] == want
        said = [t for role, t in want if role == "assistant"]
        assert [t for b in back[conv] for t in b["loss_texts"]] == said
        text, spans = whole[conv]["formatted"], whole[conv]["loss_spans"]
        assert [re.sub(r"<\\(\\*)\|", r"<\1|", text[s["start"]:s["end"]]) for s in spans] == said
        assert whole[conv]["n_turns"] == len(want) == text.count("<|im_end|>")
    assert formatted(spark, []).count() == 0


def test_chat_folds_deltas_edits_and_regenerations(spark):
    log = [(1, 0, 0, "message", "user", "hel"), (1, 0, 1, "delta", "user", "lo"), (1, 1, 0, "message", "assistant", "A"),
           (1, 1, 2, "delta", None, "C"), (1, 1, 1, "delta", None, "B"), (1, 1, 3, "regenerate", None, None), (1, 1, 4, "delta", None, "new "),
           (1, 1, 5, "delta", None, "text"), (1, 2, 0, "message", "user", "x"), (1, 2, 1, "edit", None, "y"), (1, 2, 2, "delta", None, "!"),
           (1, 3, 0, "delta", "assistant", "open"), (1, 4, 0, "unknown", "user", "z")]
    got = chat_format.fold(spark.createDataFrame(log, "conv_id long, turn long, seq long, kind string, role string, text string")).collect()
    assert sorted((r["turn"], r["role"], r["text"]) for r in got) == [
        (0, "user", "hello"), (1, "assistant", "new text"), (2, "user", "y!"), (3, "assistant", "open")]


def test_toxicity_learns_and_scores_every_row(spark):
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        ws = cases.words_text(rng, 40).split()
        if toxic:
            ws[rng.randrange(40)] = rng.choice(["idiot", "scum", "trash"])
        rows.append((i, " ".join(ws)))
        labels.append((i, 1, int(toxic)))
    rows += [(None, "idiot"), (9000, None), (9001, ""), (9002, "scum " * 20_000)]
    labels += [(None, 1, 1), (9001, 1, None), (3, 0, 0)]
    docs, marks = cases.frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, marks)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got.values())
    assert got[9000]["score"] == got[9001]["score"] and got[9000]["predicted"] == 0 and got[9002]["predicted"] == 1 and got[None]["predicted"] == 1
    held = [r["doc_id"] for r in docs.where(toxicity.is_held_out(docs["doc_id"])).select("doc_id").collect() if r["doc_id"] < 600]
    assert len(held) > 60 and sum(got[i]["predicted"] == (i % 4 == 0) for i in held) >= 0.97 * len(held)
    left = toxicity.drop_toxic(docs, model)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == {i for i, r in got.items() if not r["predicted"]}
    assert toxicity.score(docs, toxicity.fit(docs, marks.limit(0))).where("score != 0.5").count() == 0
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_swaps_lower_the_score_change_of_an_identity_term(spark):
    """A group's name occurs mostly in texts labelled toxic; the penalty takes the name's own weight away."""
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 3 == 0
        ws = cases.words_text(rng, 25).split() + (["idiot"] if toxic and i % 2 else [])
        if toxic or i % 20 == 1:
            ws.append("muslim")
        elif i % 5 == 1:
            ws.append("christian")
        rows.append((i, " ".join(ws)))
        labels.append((i, 1, int(toxic)))
    docs, marks = cases.frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    gap = []
    for weight in (0.0, 20.0):
        scorer = toxicity.Scorer(toxicity.fit(docs, marks, swap_weight=weight))
        gap.append(abs(scorer.score("a muslim neighbour") - scorer.score("a christian neighbour")))
    assert gap[1] < 0.35 * gap[0]


def test_decontamination_finds_whole_and_edited_copies_only(spark):
    rng = random.Random(12)
    items = [(k, cases.words_text(rng, 30 + k, 2000)) for k in range(12)] + [(20, "too short"), (21, None), (22, ""), (23, cases.words_text(rng, 5, 2000))]
    rows = cases.awkward(rng)
    want = set()
    for k, text in items[:12]:
        ws = text.split()
        rows.append((100 + k, cases.words_text(rng, 50, 2000) + " " + text.upper() + ". " + cases.words_text(rng, 40, 2000)))
        edited = [w if rng.random() > 0.15 else rng.choice(["new", "other", ""]) for w in ws]
        rows.append((200 + k, cases.words_text(rng, 30, 2000) + " " + " ".join(edited)))
        rows.append((300 + k, cases.words_text(rng, 30, 2000) + " " + " ".join(ws[:8])))  # a few words are no copy
        want |= {(100 + k, k), (200 + k, k)}
    rows.append((400, items[-1][1]))
    want.add((400, 23))
    docs = cases.frame(spark, rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    hits = decontaminate.find(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in hits} == want and len(hits) == len(want)
    text = dict(rows)
    for r in hits:
        if r["doc_id"] < 200:
            found = decontaminate.words(text[r["doc_id"]])[r["word_start"]:r["word_end"]]
            assert r["score"] == 1.0 and found == decontaminate.words(dict(items)[r["item_id"]])
    in_blocks = decontaminate.find(docs, bench, block_chars=400)
    assert {(r["doc_id"], r["item_id"]) for r in in_blocks.collect()} == want
    left = decontaminate.clean(docs, bench)
    assert left.columns == docs.columns
    assert collections.Counter(r["doc_id"] for r in left.collect()) == collections.Counter(i for i, _ in rows if i not in {d for d, _ in want})
    assert decontaminate.find(docs, bench.limit(0)).count() == 0 and decontaminate.find(docs.limit(0), bench).count() == 0


def test_alignment_matches_plain_smith_waterman():
    import numpy as np
    rng = random.Random(14)
    for _ in range(100):
        a, b = [rng.randrange(1, 5) for _ in range(rng.randrange(1, 12))], [rng.randrange(1, 5) for _ in range(rng.randrange(1, 20))]
        h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
        best, _, _ = decontaminate.align(np.array([a]), np.array([b]))
        assert best[0] == max(map(max, h))


def plain_score(a, b):
    """The best Smith-Waterman score of two lists of words, as a share of a whole copy's of the first."""
    best, above = 0, [0] * (len(b) + 1)
    for x in a:
        now = [0]
        for j, y in enumerate(b, 1):
            now.append(max(0, above[j - 1] + (2 if x == y else -1), above[j] - 1, now[j - 1] - 1))
        best, above = max(best, *now), now
    return best / (2 * len(a))


def test_decontamination_finds_all_that_plain_alignment_accepts(spark):
    rng = random.Random(21)
    items = [(k, cases.words_text(rng, rng.randrange(15, 21), 300)) for k in range(10)] + [(10, cases.words_text(rng, 40, 300))]
    rows = []
    for k, text in items[:10]:
        for i in range(8):  # from lightly to heavily edited: changed, dropped and inserted words
            share = 0.08 * (i + 1)
            ws = [w for w in text.split() for w in ([w] if rng.random() > share else rng.choice([["new"], [], [w, "more"]]))]
            rows.append((100 * k + i, cases.words_text(rng, 30, 300) + " " + " ".join(ws) + " " + cases.words_text(rng, 30, 300)))
        ws = text.split()
        ws[4::5] = ["changed"] * len(ws[4::5])  # no five words in a row are left
        rows.append((100 * k + 8, " ".join(ws)))
        rows.append((100 * k + 9, " and ".join(text.split())))  # no two
    half = " ".join(items[10][1].split()[:22])  # a passage that many documents share
    rows += [(2000 + i, cases.words_text(rng, 20, 300) + " " + half + " " + cases.words_text(rng, 20, 300)) for i in range(60)]
    score = {(d, k): plain_score(text.split(), t.split()) for d, t in rows for k, text in items}
    want = {pair: s for pair, s in score.items() if s >= 0.5}
    assert {(2000 + i, 10) for i in range(60)} | {(100 * k + j, k) for k in range(10) for j in (8, 9)} <= set(want)
    got = decontaminate.find(cases.frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]): r["score"] for r in got} == want


def test_many_items_of_common_words_are_searched_in_bounded_slices(monkeypatch):
    """2,000 items from a skewed vocabulary of 2,000 words: each word of a text is a seed of many items."""
    rng = random.Random(21)
    words = [f"w{i}" for i in range(2000)]
    weights = [1 / (i + 1) ** 0.5 for i in range(2000)]
    text_of = lambda n: " ".join(rng.choices(words, weights, k=n))
    items = [(k, text_of(20)) for k in range(2000)]
    texts = [text_of(400) for _ in range(200)]
    for k in range(0, 200, 10):  # half of an item, and a whole one with every fifth word changed
        texts[k] += " " + " ".join(items[k][1].split()[:11])
        texts[k + 1] += " " + " ".join("other" if i % 5 == 4 else w for i, w in enumerate(items[k + 1][1].split()))
    block = decontaminate.Items(items, 5)
    seen = [0] * (len(block.number) + 1)
    for t in texts:
        for w in set(decontaminate.words(t)) & set(block.number):
            seen[block.number[w]] += 1
    block.choose_seeds(decontaminate.np.array(seen), 0.5)
    sizes = []
    hits_of = decontaminate.seed_hits
    monkeypatch.setattr(decontaminate, "MAX_HITS", 100_000)
    monkeypatch.setattr(decontaminate, "seed_hits", lambda *a: (sizes.append(len(h[0])) or h for h in hits_of(*a)))
    got = decontaminate.find_in(block, texts)
    assert len(sizes) > 5 and max(sizes) < 100_000
    for k in range(0, 200, 10):
        assert k in [h[0] for h in got[k]] and k + 1 in [h[0] for h in got[k + 1]]
    for d in rng.sample(range(200), 6):  # all items against a text, by plain alignment
        found = {h[0] for h in got[d]}
        ids = [i for i in rng.sample(range(2000), 60)] + sorted(found)
        for i in ids:
            item = items[i][1].split()
            assert (i in found) == (plain_score(item, texts[d].split()) >= 0.5)


def test_decontamination_finds_short_items_as_whole_sequences(spark):
    items = [(1, "Fjord"), (2, "red fox"), (3, "what is a quark"), (4, "..."), (5, "東京の首都")]
    rows = [(1, "the fjord, here"), (2, "a red, FOX ran"), (3, "red dog, blue fox"), (4, "what is a red quark"), (5, "Say: what is a quark?"), (6, "(東京の首都)")]
    got = decontaminate.find(cases.frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"], r["score"]) for r in got} == {(1, 1, 1.0), (2, 2, 1.0), (5, 3, 1.0), (6, 5, 1.0)}


@pytest.mark.parametrize("text,kind,found", [
    ("host one nine two dot one six eight dot one dot one up", "ip", "one nine two dot one six eight dot one dot one"),
    ("at 192 dot 168 dot 1 dot one now", "ip", "192 dot 168 dot 1 dot one"),
    ("at ten (dot) zero, 10 [dot] zero [dot] zero [dot] 7", "ip", "10 [dot] zero [dot] zero [dot] 7"),
    ("call +49 five five five 1234 567 now", "phone", "+49 five five five 1234 567"),
    ("call +four nine 30 1234 five six seven", "phone", "+four nine 30 1234 five six seven"),
    ("card 4111 one one one one 1111 one one 11.", "card", "4111 one one one one 1111 one one 11"),
    ("card one ４１１１ 1111 1111 1111", "card", "４１１１ 1111 1111 1111"),
    ("write john at example [dot] com now", "email", "john at example [dot] com"),
    ("ask john dot doe at example dot com, please", "email", "john dot doe at example dot com"),
    ("ask john [dot] doe [at] mail.example dot com", "email", "john [dot] doe [at] mail.example dot com"),
    ("ask john.doe at example.com, please", "email", "john.doe at example.com"),
    ("ask john dot doe at example.com", "email", "john dot doe at example.com"),
    ("ask j." + "d" * 200 + " at example.com", "email", "j." + "d" * 200 + " at example.com"),
    ("mail john dot doe@example.com", "email", None),  # the base span stays
])
def test_disguises_in_parts_map_back_to_their_source(text, kind, found):
    base, added = pii.scan(text)
    assert [text[s:e] for s, e in added[kind]] == ([found] if found else [])
    assert base == base_by_hand(text) and not any(spans for k, spans in added.items() if k != kind)


@pytest.mark.parametrize("text", ["one dot two dot three", "see figure 3 at 2.5 km", "host at 10.0.0.1", "un 12 de dos dot com",
                                  "nine nine nine dot one dot one dot one", "+49 five", "at one, the dot com boom", "drop at noon. Next"])
def test_rewritten_text_without_an_identifier_gets_no_span(text):
    assert not any(pii.scan(text)[1].values())


def test_time_of_disguises_grows_with_the_text():
    import time
    for piece in ("one ", "a dot ", "a at b.", "a at ", "1 one ", "one dot ", "a [dot] ", "x.", "+", "oh-"):
        began = time.time()
        pii.scan(piece * 20_000)
        assert time.time() - began < 5, piece


def test_seeds_are_rare_words_in_the_order_of_the_item(monkeypatch):
    """Rare words that merely lie near each other are no seed; a window needs some of them in the item's order."""
    np = decontaminate.np
    rng = random.Random(23)
    items = [(k, " ".join(f"i{k}w{j}" for j in range(12))) for k in range(6)] + [(6, "to be or not to be that is the question"), (7, "fjord")]
    backwards = [" ".join(reversed(t.split())) for _, t in items[:6]]
    texts = backwards + ["whether to be or not is the question", "a fjord", "question the is that"] + [t for _, t in items]
    block = decontaminate.Items(items, 5)
    block.choose_seeds(np.ones(len(block.number) + 1, dtype=np.int64), 0.5)
    flat, start = block.look_up(texts)
    looked_at = []
    bounds = decontaminate.bounds
    monkeypatch.setattr(decontaminate, "bounds", lambda item, flat, left, right, mark: looked_at.extend(
        np.searchsorted(start, left, "right") - 1) or bounds(item, flat, left, right, mark))
    got = decontaminate.find_in(block, texts)
    assert not set(looked_at) & {0, 1, 2, 3, 4, 5, 8} and {6, 7, *range(9, 17)} <= set(looked_at)
    assert [[h[0] for h in hits] for hits in got] == [[]] * 6 + [[6], [7], []] + [[k] for k, _ in items]
    # against all chains, words that items and texts repeat included
    for _ in range(200):
        item = [rng.randrange(6) for _ in range(rng.randrange(1, 9))]
        words = [rng.randrange(8) for _ in range(rng.randrange(1, 25))]
        block = decontaminate.Items([(0, " ".join(f"w{x}" for x in item))], 1)
        block.choose_seeds(np.ones(len(block.number) + 1, dtype=np.int64), 0.5)
        flat, start = block.look_up([" ".join(f"w{x}" for x in words)])
        place = np.flatnonzero(np.isin(flat, block.seed_word))
        if not len(place):
            continue
        ends = decontaminate.ends_seed(block, flat, np.zeros_like(place), place, np.zeros_like(place))
        chosen = {f: [i for i in range(a, b + 1) if block.items[0][i] == f] for f, a, b in zip(block.seed_word, block.seed_first, block.seed_last)}
        chains = {(p, i) for p in place for i in chosen[flat[p]]}
        for _ in range(block.near[0] - 1):
            chains = {(q, j) for p, i in chains for q in place if p < q < p + block.span[0] for j in chosen[flat[q]] if j > i}
        assert {p for p, _ in chains} <= set(place[ends])
        if len(set(item)) == len(item):
            assert {p for p, _ in chains} == set(place[ends])
