"""Removal of repeated byte strings with a sparse suffix array.

Every byte that a ``length``-byte string covers goes if that string starts anywhere else as well, in the same
text or another (judged on the input; overlaps count; nothing crosses a text's border).

A full suffix array would move 200 bytes for each input byte.  Here only suffixes at anchors are sorted:

1. Anchors.  Of the ``lead``-byte pieces in a ``length``-byte window the one with the least hash (leftmost of
   equal ones) is the window's anchor.  Equal windows have their anchor at the same place, so windows need
   comparing only where their anchors' leading ``lead`` bytes are equal.  A record is an anchor with
   the run of windows that have it.
2. Leads that only one anchor has are dropped: leads are counted over all texts, a bitmap of fixed size of
   the repeated ones is broadcast, and each text's remaining records are cut out as segments (the run's
   bytes and the anchor's place in them).  Equal segments are one from here on, with their number.
3. Suffixes.  Segments are range-partitioned by their bytes from the anchor on: Spark samples splitters.
   In a bucket two arrays are sorted by multikey quicksort over 8-byte words: suffixes to the right of
   the anchors and prefixes to their left, read backwards.  Neighbours' common lengths give, for each
   offset of a window before its anchor, classes of equal right and equal left parts; windows that agree in
   both are equal.  This is exact; no hash decides.
4. Boundaries.  A run of equal leads at a bucket's edge may go on in the next bucket (splitters use all bytes, so
   a lead that very many segments share is spread).  Digests of such edge windows, one per class, are
   compared across buckets.
5. Repeated windows become covered intervals of the texts that hold the segment; only texts with an interval
   are shuffled for the cut, the others' digests are computed where they are read.

Texts are named by a 128-bit hash of their bytes, so equal texts share their intervals and ids may be null or
repeated.  Defined results: a null text is empty; a text shorter than ``length`` loses nothing; repeated
rows are texts of their own and so lose everything if long enough; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import hash_bitmap, keep, may_contain, ship

LENGTH, LEAD = 200, 64
SLICE = 1 << 20
PLACE_BITS = np.uint64(22)
FILTER_BITS = 1 << 27
#: Segment bytes per bucket; the arrays of a bucket take about ten times as much.
BUCKET_BYTES = 8 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


@functools.lru_cache(maxsize=1)
def powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random word per byte value, and powers of an odd base and of its inverse modulo 2^64."""
    words = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    n = 2 * SLICE + 4 * LENGTH + (1 << 12)
    inverse = np.uint64(pow(int(_ODD), -1, 1 << 64))
    step = lambda base: np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(n, base, np.uint64))])
    return words, step(_ODD), step(inverse)


def piece_hashes(data: np.ndarray, lead: int) -> np.ndarray:
    """A hash of every ``lead``-byte piece."""
    words, power, inverse = powers()
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words[data] * power[:len(data)])])
    h = (total[lead:] - total[:-lead]) * inverse[:len(data) - lead + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Least value of every ``w`` neighbours, from least values before and after block borders."""
    n = len(v)
    full = np.full(-(-n // w) * w, np.iinfo(v.dtype).max, dtype=v.dtype)
    full[:n] = v
    full = full.reshape(-1, w)
    before = np.minimum.accumulate(full, axis=1).ravel()
    after = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n - w + 1], before[w - 1:n])


def anchors(bodies: list[bytes], length: int = LENGTH, lead: int = LEAD) -> Iterator[tuple[np.ndarray, ...]]:
    """Records (text, first window, last window, anchor, hash of the lead), places within the text.
    Long texts are cut into slices that overlap by a window, so memory does not grow with a text."""
    batch, size = [], 0
    for d, body in enumerate(bodies):
        for s in range(0, len(body) - length + 1, SLICE):
            part = body[s:s + SLICE + length - 1]
            batch.append((d, s, part))
            size += len(part)
            if size >= SLICE:
                yield _records(batch, length, lead)
                batch, size = [], 0
    if batch:
        yield _records(batch, length, lead)


def _records(batch: list[tuple[int, int, bytes]], length: int, lead: int) -> tuple[np.ndarray, ...]:
    text, shift, parts = zip(*batch)
    size = np.array([len(p) for p in parts])
    at = np.concatenate([[0], np.cumsum(size)])
    data = np.frombuffer(b"".join(parts), dtype=np.uint8)
    h = piece_hashes(data, lead)
    low = (np.uint64(1) << PLACE_BITS) - np.uint64(1)
    packed = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    anchor = (sliding_min(packed, length - lead + 1) & low).astype(np.int64)
    valid = np.zeros(len(anchor), dtype=bool)
    for a, n in zip(at, size):
        valid[a:a + n - length + 1] = True
    window = np.flatnonzero(valid)
    anchor = anchor[window]
    new = np.ones(len(window), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)
    first = window[new]
    last = window[np.append(np.flatnonzero(new)[1:], len(window)) - 1]
    anchor = anchor[new]
    part = np.searchsorted(at, first, "right") - 1
    move = np.array(shift)[part] - at[part]
    return np.array(text)[part], first + move, last + move, anchor + move, h[anchor].view(np.int64)


def multikey_sort(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows of big-endian words, and how many leading bytes each row shares with the one before it.

    Multikey quicksort by words: rows are sorted by one word, and only runs of equal rows go on to the next.
    """
    n, depth = words.shape
    order, group, common = np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
    active = np.arange(n)
    for j in range(depth):
        if len(active) < 2:
            break
        rows, g = order[active], group[active]
        key = words[rows, j]
        by = np.lexsort((key, g))
        order[active], key = rows[by], key[by]
        together = g[1:] == g[:-1]
        differ = together & (key[1:] != key[:-1])
        x = key[1:][differ] ^ key[:-1][differ]
        equal = np.zeros(len(x), np.int64)
        for b in range(1, 8):
            equal += x < np.uint64(1) << np.uint64(64 - 8 * b)
        common[active[1:][differ]] = 8 * j + equal
        start = np.concatenate([[True], ~together | differ])
        of = np.cumsum(start) - 1
        group[active] = active[start][of]
        active = active[np.bincount(of)[of] > 1]
    same = np.zeros(n, dtype=bool)
    same[1:] = group[1:] == group[:-1]
    common[same] = 8 * depth
    return order, common


def side(segments: list[bytes], place: np.ndarray, width: int, right: bool) -> np.ndarray:
    """Bytes from the anchors on (or before them, backwards) as rows of big-endian words, zero-padded."""
    rows = np.zeros((len(segments), -(-width // 8) * 8), dtype=np.uint8)
    for i, (s, a) in enumerate(zip(segments, place.tolist())):
        part = s[a:a + width] if right else s[max(0, a - width):a][::-1]
        rows[i, :len(part)] = np.frombuffer(part, dtype=np.uint8)
    return rows.view(">u8").astype(np.uint64)


class Bucket:
    """Distinct segments of a bucket: which of their windows are repeated."""

    def __init__(self, segments: list[bytes], place: np.ndarray, times: np.ndarray, length: int, lead: int):
        n, depth = len(segments), length - lead
        size = np.array([len(s) for s in segments])
        self.segments, self.place, self.length = segments, place, length
        self.windows = size - length + 1
        right, common_right = multikey_sort(side(segments, place, length, True))
        left, common_left = multikey_sort(side(segments, place, depth, False)) if depth else (np.arange(n), np.zeros(n, np.int64))
        least, most = place - self.windows + 1, place
        self.repeated = np.zeros((n, depth + 1), dtype=bool)     # by segment and offset of the window before the anchor
        self.repeated[times > 1] = True
        run = np.cumsum(common_right < lead)
        edge = np.zeros(n, dtype=bool)
        edge[right] = (run == run[0]) | (run == run[-1])
        self.edge_windows: list[tuple[int, int]] = []
        right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
        for off in range(depth + 1):
            here = np.flatnonzero((least <= off) & (off <= most))
            if not len(here):
                continue
            right_class[right] = np.cumsum(common_right < length - off)
            left_class[left] = np.cumsum(common_left < off)
            key = right_class[here] * (n + 1) + left_class[here]
            by = np.argsort(key, kind="stable")
            new = np.ones(len(here), dtype=bool)
            new[1:] = key[by][1:] != key[by][:-1]
            of = np.cumsum(new) - 1
            self.repeated[here[by], off] |= np.bincount(of)[of] > 1
            first = here[by[new]]
            self.edge_windows += [(int(i), off) for i in first[edge[first]]]

    def runs(self) -> list[list[tuple[int, int]]]:
        """Per segment the runs of repeated windows, numbered from the segment's start, last one inclusive."""
        out = []
        for i, n in enumerate(self.windows):
            flags = self.repeated[i, self.place[i] - np.arange(n)]
            edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
            out.append(list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist())))
        return out


def lead_counts(source: DataFrame, length: int, lead: int) -> DataFrame:
    """(lead, n): anchors by lead hash, over all texts."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for *_, key in anchors(part["body"].tolist(), length, lead):
                yield pd.DataFrame({"lead": key})

    return source.select("body").mapInPandas(run, "lead long").groupBy("lead").agg(F.count("*").alias("n"))


def segments(source: DataFrame, bitmap: np.ndarray, length: int, lead: int) -> DataFrame:
    """(k1, k2, start, place, segment, sid): records whose lead may be repeated."""
    shared = source.sparkSession.sparkContext.broadcast(bitmap)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            bodies, k1, k2 = part["body"].tolist(), part["k1"].to_numpy(), part["k2"].to_numpy()
            for text, first, last, anchor, key in anchors(bodies, length, lead):
                some = np.flatnonzero(may_contain(shared.value, key))
                cut = [bodies[text[i]][first[i]:last[i] + length] for i in some]
                place = (anchor - first)[some]
                yield pd.DataFrame({
                    "k1": k1[text[some]], "k2": k2[text[some]], "start": first[some], "place": place, "segment": cut,
                    "sid": [xxhash.xxh3_128_digest(c + int(p).to_bytes(2, "big")) for c, p in zip(cut, place)]})

    return source.mapInPandas(run, "k1 long, k2 long, start long, place int, segment binary, sid binary")


def compare(found: DataFrame, length: int, lead: int) -> DataFrame:
    """(sid, kind, runs, digest, offset): per bucket the runs of repeated windows by segment (kind 0), and the edge windows' digests (kind 1)."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [p for p in parts if len(p)]
        if not got:
            return
        part = pd.concat(got, ignore_index=True)
        bucket = Bucket(part["segment"].tolist(), part["place"].to_numpy(), part["times"].to_numpy(), length, lead)
        sid = part["sid"].to_numpy()
        rows = [(sid[i], 0, [{"first": a, "last": b} for a, b in r], None, None) for i, r in enumerate(bucket.runs()) if r]
        for i, off in bucket.edge_windows:
            j = int(bucket.place[i]) - off
            digest = xxhash.xxh3_128_digest(bucket.segments[i][j:j + length] + off.to_bytes(2, "big"))
            rows.append((sid[i], 1, [{"first": j, "last": j}], digest, off))
        yield pd.DataFrame(rows, columns=["sid", "kind", "runs", "digest", "offset"])

    return found.mapInPandas(run, "sid binary, kind int, runs array<struct<first: int, last: int>>, digest binary, offset int")


def intervals(source: DataFrame, length: int, lead: int, bits: int) -> DataFrame:
    """(k1, k2, covered): removed half-open intervals of each text that has any, unmerged."""
    spark = source.sparkSession
    repeated = lead_counts(source, length, lead).where("n > 1")
    records = keep(segments(source, hash_bitmap(repeated, "lead", bits), length, lead), "segments")
    distinct = records.groupBy("sid").agg(F.first("place").alias("place"), F.first("segment").alias("segment"), F.count("*").alias("times"))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-records.count() * 2 * length // BUCKET_BYTES))
    suffix = F.expr("substring(segment, place + 1)")
    ranged = distinct.withColumn("suffix", suffix).repartitionByRange(buckets, "suffix", "sid").drop("suffix")
    found = keep(compare(ranged, length, lead), "windows")
    edges = found.where("kind = 1")
    # a digest of two buckets: each bucket's class has it once, and a class of more members is marked already
    across = edges.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
    runs = found.where("kind = 0").select("sid", "runs").unionByName(edges.join(across, "digest").select("sid", "runs"))
    covered = (records.select("k1", "k2", "start", "sid").join(runs, "sid")
               .select("k1", "k2", "start", F.inline("runs"))
               .select("k1", "k2", (F.col("start") + F.col("first")).alias("s"), (F.col("start") + F.col("last") + length).alias("e")))
    return covered.distinct().groupBy("k1", "k2").agg(F.collect_list(F.struct("s", "e")).alias("covered"))


def cutter():
    @F.pandas_udf("n_removed long, n_spans long, kept_sha256 string")
    def cut(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for bodies, covered in parts:
            rows = []
            for body, spans in zip(bodies, covered):
                kept, at, n, removed = hashlib.sha256(), 0, 0, 0
                for s, e in merged(spans):
                    kept.update(body[at:s])
                    at, n, removed = e, n + 1, removed + e - s
                kept.update(body[at:])
                rows.append((removed, n, kept.hexdigest()))
            yield pd.DataFrame(rows, columns=["n_removed", "n_spans", "kept_sha256"])

    return cut


def merged(spans) -> list[tuple[int, int]]:
    """Maximal runs of the given half-open intervals."""
    out: list[tuple[int, int]] = []
    for s, e in sorted((x["s"], x["e"]) for x in spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def named(docs: DataFrame) -> DataFrame:
    """(doc_id, body, k1, k2): texts as bytes with a 128-bit name."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id"), text.cast("binary").alias("body"),
                       F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(7), text).alias("k2"))


def dedup(docs: DataFrame, length: int = LENGTH, lead: int = LEAD, bits: int = FILTER_BITS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of ``docs``."""
    spark = docs.sparkSession
    ship(spark)
    source = named(docs)
    cuts = keep(intervals(source.select("body", "k1", "k2"), length, lead, bits), "cuts")
    flagged = spark.sparkContext.broadcast(hash_bitmap(cuts, "k1", bits))

    @F.pandas_udf("boolean")
    def perhaps(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for k in parts:
            yield pd.Series(may_contain(flagged.value, k.to_numpy()))

    size = F.octet_length("body").cast("long").alias("n_bytes")
    marked = source.withColumn("perhaps", perhaps("k1"))
    clean = marked.where(~F.col("perhaps")).select(
        "doc_id", size, F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.sha2("body", 256).alias("kept_sha256"))
    cut = (marked.where("perhaps").join(cuts, ["k1", "k2"], "left")
           .withColumn("cut", cutter()("body", F.coalesce("covered", F.array().cast("array<struct<s: bigint, e: bigint>>"))))
           .select("doc_id", size, "cut.n_removed", "cut.n_spans", "cut.kept_sha256"))
    return clean.unionByName(cut)
