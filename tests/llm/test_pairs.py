"""Exact dedup, Jaccard join and suffix dedup against plain Python."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from folio.llm import exact_dedup, jaccard_join, suffix_dedup
from folio.llm.components import connected_components
from tests.llm import cases


def by_row(df, *columns):
    return collections.Counter(tuple(r[c] for c in columns) for r in df.collect())


def test_exact_dedup_of_awkward_rows(spark):
    rows = cases.awkward()
    norm = [re.sub(cases.WS, "", t or "") for _, t in rows]
    want = collections.Counter()
    for (i, t), k in zip(rows, norm):
        group = [(-len(u or ""), j is None, j or 0, j) for (j, u), m in zip(rows, norm) if m == k]
        best = min(group)
        kept = i == best[3] and -len(t or "") == best[0]
        want[(i, best[3], len(group), kept, hashlib.sha256(k.encode()).hexdigest())] += 1
    got = exact_dedup.dedup(cases.frame(spark, rows))
    assert by_row(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == want


def test_exact_dedup_leaves_one_row_of_each_text_and_all_columns(spark):
    rows = cases.awkward()
    docs = cases.frame(spark, rows)
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns
    texts = [re.sub(cases.WS, "", r["text"] or "") for r in left.collect()]
    assert sorted(texts) == sorted({re.sub(cases.WS, "", t or "") for _, t in rows})


def test_digest_index_is_persistent_and_appends_only_what_is_new(spark):
    index = exact_dedup.DigestIndex(spark, buckets=4)
    first = exact_dedup.dedup(cases.frame(spark, [(1, "a b"), (2, "c")]), index).collect()
    assert all(r["kept"] for r in first)
    again = exact_dedup.DigestIndex(spark, index.name, buckets=4)
    second = {r["doc_id"]: r for r in exact_dedup.dedup(cases.frame(spark, [(3, "ab"), (4, "d"), (5, "d ")]), again).collect()}
    assert not second[3]["kept"] and second[3]["keep_id"] == 1 and second[3]["group_size"] is None
    assert second[5]["kept"] and not second[4]["kept"] and second[4]["keep_id"] == 5
    assert index.read().count() == 3
    assert exact_dedup.dedup(cases.frame(spark, []), again).count() == 0 and index.read().count() == 3


def test_anti_join_reads_the_index_in_bucket_order(spark):
    index = exact_dedup.DigestIndex(spark, buckets=4)
    keyed = exact_dedup.digests(cases.frame(spark, [(1, "a")]))
    texts = keyed.groupBy("digest").count().hint("merge").join(index.read().select("digest"), "digest", "left_anti")
    plan = texts._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1  # none on the index side


@pytest.mark.parametrize("n,least", [(3, 90), (5, 80)])
def test_jaccard_components_of_awkward_rows(spark, n, least):
    rows = cases.awkward()
    want, _ = cases.component_ids(rows, n, least)
    want = collections.Counter((i, size, c) for (i, _), (size, c) in zip(rows, want))
    assert by_row(jaccard_join.components(cases.frame(spark, rows), n, least), "doc_id", "n_shingles", "component_id") == want


def test_jaccard_join_drops_all_but_one_of_each_group(spark):
    rows = cases.awkward()
    _, group = cases.component_ids(rows, 5, 80)
    docs = cases.frame(spark, rows)
    left = jaccard_join.drop_near_copies(docs)
    assert left.columns == docs.columns
    blank = [(i, t) for i, t in rows if not (t or "").split()]
    full = {g for (i, t), g in zip(rows, group) if (t or "").split()}
    got = left.collect()
    # texts without words link with nothing: each (id, text) of them stays once
    assert len([r for r in got if (r["text"] or "").split()]) == len(full)
    assert len([r for r in got if not (r["text"] or "").split()]) == len({(i, t or "") for i, t in blank})


def test_jaccard_regions_split_on_the_cluster_and_windows_lose_no_link(spark):
    rng = random.Random(8)
    base = [f"v{rng.randrange(10 ** 6)}" for _ in range(150)]
    rows, now = [], base
    for i in range(160):  # a chain: neighbours link, ends do not
        now = list(now)
        now[rng.randrange(150)] = f"n{i}"
        if i % 3 == 0:
            now = list(base)
        rows.append((i, " ".join(now)))
    want, _ = cases.component_ids(rows, 3, 90)
    want = {i: c for (i, _), (_, c) in zip(rows, want)}
    got = jaccard_join.components(cases.frame(spark, rows), 3, 90, max_region=20_000)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == want
    region = jaccard_join.Region([np.unique([hash(s) >> 1 for s in cases.shingles(t, 3)]) for _, t in rows], 90)
    region.join(np.arange(len(rows)))
    assert dict(enumerate(region.component.tolist())) == want


def test_linked_sets_share_a_signature():
    rng = random.Random(2)
    for _ in range(600):
        size, least = rng.randrange(1, 400), rng.choice([80, 90])
        x = {rng.randrange(1 << 62) for _ in range(size)}
        y = set(x)
        for _ in range(400):  # as far apart as a link allows, by losing, gaining or both
            z = set(y) - {rng.choice(sorted(y))} if rng.random() < 0.5 and len(y) > 1 else set(y) | {rng.randrange(1 << 62)}
            if 100 * len(x & z) < least * len(x | z):
                break
            y = z
        found = [jaccard_join.signatures(np.array(sorted(k), dtype=np.int64), least) for k in (x, y)]
        signs = [set(s.tolist()) for s, _ in found]
        assert x == y or signs[0] & signs[1], (size, least, len(x), len(y))
        # whichever signatures are hot, what both sets do without is not all that they share
        full = np.full(jaccard_join.HOT_BITS // 8, 255, np.uint8)
        some = np.frombuffer(rng.randbytes(len(full)), np.uint8)
        left = [set(jaccard_join.meeting(s, c, full, [full, some])[0].tolist()) for s, c in found]
        assert x == y or left[0] & left[1], (size, least, len(x), len(y))
        bins = np.array([list(jaccard_join.histogram(np.array(sorted(k), dtype=np.int64))) for k in (x, y)], dtype=np.int32)
        assert jaccard_join.near_edges(np.array([len(x), len(y)]), bins, least) == [(0, 1)]


def test_short_sets_share_no_signature_by_an_empty_part():
    rng = np.random.default_rng(5)
    for size, least in ((5, 80), (8, 80), (12, 80), (9, 90), (20, 90)):
        held = collections.Counter()
        for _ in range(5000):
            held.update(set(jaccard_join.signatures(np.unique(rng.integers(0, 1 << 62, size)), least)[0].tolist()))
        assert max(held.values(), default=0) < 200, (size, least)


@pytest.mark.parametrize("n,least", [(3, 90), (5, 80)])
def test_hot_signatures_are_dealt_into_blocks_and_lose_no_link(spark, monkeypatch, n, least):
    """Near copies, chains and a passage that many texts share; signatures of more than four sets count as hot."""
    monkeypatch.setattr(jaccard_join, "HOT", 4)
    rng = random.Random(12)
    base, passage = ([f"w{rng.randrange(10 ** 6)}" for _ in range(m)] for m in (120, 80))
    rows = [(i, " ".join(base[:i % 120] + [f"n{i}"] + base[i % 120 + 1:])) for i in range(150)]
    now = list(base)
    for i in range(150, 230):
        now = list(now)
        now[rng.randrange(120)] = f"c{i}"
        rows.append((i, " ".join(now)))
    rows += [(300 + i, " ".join([f"o{i}_{k}" for k in range(rng.randrange(10, 60))] + passage)) for i in range(120)]
    rows += [(500 + i, cases.words_text(rng, 9, 40)) for i in range(150)]
    rows += rows[:3] + [(7, rows[0][1])] + [(900, rows[0][1])] * 20
    want, _ = cases.component_ids(rows, n, least)
    want = collections.Counter((i, size, c) for (i, _), (size, c) in zip(rows, want))
    assert by_row(jaccard_join.components(cases.frame(spark, rows), n, least), "doc_id", "n_shingles", "component_id") == want


def test_connected_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 40)] + [(200, 200)]
    got = {r["node"]: r["label"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 1 for i in range(1, 40)}}


def cut_by_hand(bodies, length):
    seen = collections.Counter(b[k:k + length] for b in bodies for k in range(len(b) - length + 1))
    out = []
    for b in bodies:
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                gone[k:k + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:len(b)]]) if b else b""
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_dedup_of_awkward_rows(spark):
    rng = random.Random(4)
    passage = cases.words_text(rng, 60, 5000)
    rows = cases.awkward(rng) + [(60 + i, cases.words_text(rng, 30) + " " + passage[i * 3:] + cases.words_text(rng, 30)) for i in range(12)]
    rows += [(80, passage + passage), (81, "x" * 199), (82, "y" * 200), (83, "z" * 201), (84, "\x00" * 400 + passage[:199])]
    want = collections.Counter((i, *w) for (i, _), w in zip(rows, cut_by_hand([(t or "").encode() for _, t in rows], 200)))
    got = suffix_dedup.dedup(cases.frame(spark, rows))
    assert by_row(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
    assert suffix_dedup.dedup(cases.frame(spark, [])).count() == 0


def test_suffix_buckets_agree_across_boundaries(spark, monkeypatch):
    """Many segments share one lead; tiny buckets put equal windows into different ones."""
    rng = random.Random(6)
    line = "".join(rng.choice("abcdefgh ") for _ in range(150))
    texts = [cases.words_text(rng, 20) + line + cases.words_text(rng, 25) for _ in range(150)]
    texts += [t[5:-7] + "tail %d" % i for i, t in enumerate(texts[:60])]
    rows = list(enumerate(texts))
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 2_000)
    want = {i: w for (i, _), w in zip(rows, cut_by_hand([t.encode() for _, t in rows], 200))}
    got = suffix_dedup.dedup(cases.frame(spark, rows))
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got.collect()} == want


def test_multikey_sort_matches_sorted_bytes():
    rng = random.Random(1)
    for _ in range(50):
        rows = [bytes(rng.choice(b"ab\x00") for _ in range(24)) for _ in range(rng.randrange(1, 60))]
        words = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, 24).copy().view(">u8").astype(np.uint64)
        order, common = suffix_dedup.multikey_sort(words)
        ordered = [rows[i] for i in order]
        assert ordered == sorted(rows)
        for a, b, c in zip(ordered, ordered[1:], common[1:]):
            assert c == next((k for k in range(24) if a[k] != b[k]), 24)


def test_long_texts_are_sliced(monkeypatch):
    rng = random.Random(3)
    body = bytes(rng.choice(b"abcd") for _ in range(5000))
    whole = {(int(f) + k, int(a)) for _, first, last, anchor, _ in suffix_dedup.anchors([body]) for f, t, a in zip(first, last, anchor)
             for k in range(int(t - f) + 1)}
    monkeypatch.setattr(suffix_dedup, "SLICE", 700)
    suffix_dedup.powers.cache_clear()
    cut = {(int(f) + k, int(a)) for _, first, last, anchor, _ in suffix_dedup.anchors([body]) for f, t, a in zip(first, last, anchor)
           for k in range(int(t - f) + 1)}
    suffix_dedup.powers.cache_clear()
    assert whole == cut and len(whole) == 4801


def test_a_large_region_of_near_copies_is_compared_in_bounded_tasks(spark):
    """Near copies of one text are within every pivot's window, so no cell of pivots would be smaller than the region."""
    rng = random.Random(9)
    base = [f"v{rng.randrange(10 ** 6)}" for _ in range(150)]
    rows, now = [], list(base)
    for i in range(200):  # copies with one changed word
        rows.append((i, " ".join(base[:i % 150] + [f"n{i}"] + base[i % 150 + 1:])))
    for i in range(200, 260):  # a chain that leads away from them
        now = list(now)
        now[rng.randrange(150)] = f"n{i}"
        rows.append((i, " ".join(now)))
    rows += [(300 + i, " ".join(base[:100] + [f"o{i}_{k}" for k in range(50)])) for i in range(40)]  # share a passage, no link
    want, _ = cases.component_ids(rows, 3, 90)
    want = {i: c for (i, _), (_, c) in zip(rows, want)}
    bound = 60_000
    assert sum(len(t) for _, t in rows) > 4 * bound
    docs = cases.frame(spark, rows)
    got = jaccard_join.components(docs, 3, 90, max_region=bound)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == want
    texts = spark.createDataFrame([(str(i).encode(), b"region", t.encode()) for i, t in rows], "sid binary, region binary, body binary")
    sets = jaccard_join.large_sets(texts, texts.select("region").distinct(), 3)
    tasks = jaccard_join.block_tasks(sets, jaccard_join.pivot_links(sets, 90), bound).join(sets.select("sid", "bytes"), "sid").collect()
    held, together = collections.Counter(), collections.defaultdict(set)
    label = {}
    for r in tasks:
        held[r["task"]] += r["bytes"]
        together[r["task"]].add(int(r["sid"]))
        label[int(r["sid"])] = bytes(r["label"])
    assert max(held.values()) <= bound and len(held) > 4
    met = {(x, y) for ids in together.values() for x in ids for y in ids}
    assert all((x, y) in met for x in label for y in label if label[x] != label[y])


@pytest.mark.parametrize("n,least", [(3, 90), (5, 80)])
def test_sets_outside_each_others_window_are_not_compared(n, least):
    """Groups around a common passage: every set is in most pivots' windows, but not in that of each other set."""
    rng = random.Random(17)
    base = [f"v{i}" for i in range(300)]
    rows = []
    for i in range(120):
        keep = 300 - 2 * i  # a chain of ever shorter texts: neighbours link, ends do not
        rows.append((i, " ".join(base[:keep])))
    rng.shuffle(rows)
    sets = [np.unique([hash(s) >> 1 for s in cases.shingles(t, n)]) for _, t in rows]
    region = jaccard_join.Region(sets, least)
    far = np.array([1 - region.shared(p, np.arange(len(sets))) / region.union(p, np.arange(len(sets)), region.shared(p, np.arange(len(sets))))
                    for p in range(3)])
    met = []
    shared = region.shared
    region.shared = lambda x, rest: met.append((x, rest)) or shared(x, rest)
    region.compare(np.arange(len(sets)), far)
    plain = jaccard_join.Region(sets, least)
    plain.compare(np.arange(len(sets)))
    assert region.component.tolist() == plain.component.tolist()
    assert met and all(np.abs(far[:, rest] - far[:, x:x + 1]).max() <= 1 - least / 100 + 1e-9 for x, rest in met)


@pytest.mark.parametrize("n,least", [(3, 90), (5, 80)])
def test_regions_are_cut_by_the_windows_of_pivots(monkeypatch, n, least):
    """Eight groups in one region: each is joined by itself, so no comparison takes sets of two groups."""
    rng = random.Random(18)
    sets, group = [], []
    for g in range(8):
        base = [f"g{g}w{i}" for i in range(100 + 10 * g)]
        for i in range(40):
            ws = list(base)
            ws[rng.randrange(len(ws))] = f"n{i}"
            sets.append(np.unique([hash(s) >> 1 for s in cases.shingles(" ".join(ws), n)]))
            group.append(g)
    region = jaccard_join.Region(sets, least)
    compared = []
    compare = jaccard_join.Region.compare
    monkeypatch.setattr(jaccard_join.Region, "compare", lambda self, members, far=None: compared.append(members) or compare(self, members, far))
    region.join(np.arange(len(sets)))
    assert len(compared) > 1 and max(map(len, compared)) < len(sets) / 2
    plain = jaccard_join.Region(sets, least)
    compare(plain, np.arange(len(sets)))
    assert region.component.tolist() == plain.component.tolist()
