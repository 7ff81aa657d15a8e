"""Exact n-gram Jaccard join by pivots, Voronoi regions and triangle-inequality windows.

A document's set: hashes of its distinct ``n``-word shingles (A-Z lower-cased words; with fewer words
the whole sequence is the one shingle).  Two documents link when
``100 * |x & y| >= least * |x | y|``; ``1 - Jaccard`` is a metric, so with ``eps = 1 - least / 100``:

* two linked sets differ by at most ``eps`` in their distance to any pivot, and
* a set whose nearest pivot is ``p`` must also be compared in the region of a pivot ``q`` when
  ``d(x, q) <= d(x, p) + 2 eps``.

Document pivots alone separate nothing here: unrelated texts are all at distance about 1 from
every pivot, so every window would take in every document.  The first level therefore finds regions by
the same metric's bound on the symmetric difference:

1. Equal sets are one set from here on, named by its first row; copies only rejoin at the end.
2. Linked sets of sizes a and b differ in at most ``d = (a + b) * (100 - least) / (100 + least)``
   shingles.  The hash space is cut into ``d + spare`` parts; then at least ``spare`` parts of two linked sets
   are equal.  A set hands out one signature per part, for its own size class and the next one, so
   that sets of neighbouring classes meet.  Parts with fewer than two shingles tell little and are
   left out, unless a set has as many of them as it must have parts equal to a linked one's; an empty part
   then comes with each part of a second cut.  Of the parts that must be equal nearly half may be left out on either
   side, so a set does without the signatures that most sets have (a passage that many documents share).
3. Of sets with an equal signature those are joined to a region whose histograms over 32 parts of the hash
   space differ by ``d`` at most (pivots and their neighbours, breadth first): the sum of differences is a
   metric that never exceeds the symmetric difference.  Signatures of more than ``HOT`` sets are dealt into
   blocks; a block's sets join pivots close to them, and the blocks' pivots join each other within wider bounds, so
   that linked sets of different blocks are in one region too.
4. A region joins recursively: document pivots, nearest pivot, windows of ``2 eps``, until regions
   are small or windows no longer separate; then sets are compared exactly, except those
   already in one component and those whose distances to a pivot differ by more than ``eps``.
5. Regions above ``max_region`` bytes are joined on the cluster.  Rounds of a few pivots per region are compared
   with all its sets, since near copies of one text are within every window but link to such a pivot.
   What is linked is one component; sets of different components are compared block against block, each two
   blocks within ``max_region`` bytes.

Bitmaps of fixed size keep texts and shingles of sets without a possible partner out of the
shuffles.  A false "perhaps" costs a comparison and changes no result.

Links between different sets are used for components, so a task emits at most one edge per set.

Defined results: null or empty texts have no shingles, link with nothing and are their own
component; null ids take part, but a component's id is the least non-null one; repeated rows are equal
sets; an empty table gives no rows; extra columns are ignored.  Shingles are 63-bit hashes and sets
128-bit digests of them.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from folio.llm.common import hash_bitmap, keep, keep_rows, mark_perhaps, may_contain, row_hash, ship, text_hash, tidy
from folio.llm.components import connected_components

MAX_KEPT_WORDS = 150_000
#: Bytes of text of a region that one task takes.
MAX_REGION = 48_000_000
#: Regions of so many sets are compared directly.
SMALL = 48
PIVOTS = 8
#: Bins of a set's histogram.
BINS = 32
#: Sets that a task's forest remembers.
MAX_MET = 500_000
#: Signatures of more sets are left out where a set can do without them, and else dealt into blocks of so many sets at most
#: (on average).  The driver and the tasks hold one bitmap of fixed size for each power of four above.
HOT = 2_000
HOT_BITS = 1 << 22
HOT_LEVELS = 12
#: Sets of a block that are so close to a pivot, as a share of what linked sets may differ in, are represented by it.
CLOSE = 0.125
FILTER_BITS = 1 << 27
ROW_BITS = 1 << 25


class Shingler:
    """Sorted distinct shingle hashes of texts; remembers word hashes up to a fixed number."""

    def __init__(self, n: int):
        self.n = n
        self.known: dict[bytes, int] = {}

    def set_of(self, body: bytes | None) -> np.ndarray:
        ws = body.lower().split() if body else []  # bytes: A-Z and ASCII white space only
        if not ws:
            return np.empty(0, np.int64)
        known = self.known
        if len(known) > MAX_KEPT_WORDS:
            known.clear()
        for w in set(ws).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, ws), np.uint64, len(ws))
        m = min(self.n, len(ws))
        out = np.full(len(ws) - m + 1, m, dtype=np.uint64)
        for k in range(m):
            out = (out ^ h[k:len(ws) - m + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(29)
        return np.unique((out >> np.uint64(1)).view(np.int64))


def size_class(size: int, least: int) -> int:
    """The number of a size class; the sizes of linked sets are in the same or in neighbouring classes."""
    return int(math.floor(math.log(size) / math.log(100 / least) + 1e-9))


@functools.lru_cache(maxsize=None)
def parts_of(tag: int, least: int) -> tuple[int, int]:
    """Of pairs that meet under a class's tag (sets of that class and the one below): the largest
    symmetric difference of a link, and the spare parts."""
    largest = math.ceil((100 / least) ** (tag + 1)) + 1
    differ = 2 * largest * (100 - least) // (100 + least)
    return differ, 6 + differ // 4


def part_sums(mixed: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum and number of the shingles in each of ``n`` parts of the hash space."""
    part = ((mixed >> np.uint64(20)) % np.uint64(n)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    count = np.bincount(part, minlength=n)
    seen = np.flatnonzero(count)
    total = np.zeros(n, dtype=np.uint64)
    total[seen] = np.add.reduceat(mixed[order], np.concatenate([[0], np.cumsum(count[seen])[:-1]]))
    return total, count


def signatures(shingles: np.ndarray, least: int) -> tuple[np.ndarray, list[int]]:
    """A set's signatures, tag by tag, and for each tag their number and how many of them it can do without.

    A set that has fewer low parts than parts that must be equal to a linked set's hands out the others; if
    both sets leave out less than half of those that must be equal, they still meet.  A set with more low parts hands out all
    parts: an empty one, which many sets have, with each part of a second cut into one part more than linked sets
    differ in, so that one of these is equal too; where that part is empty as well, with each part of a third cut.
    """
    if not len(shingles):
        return np.empty(0, np.int64), []
    mixed = shingles.view(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(31)
    own, out, can_do_without = size_class(len(shingles), least), [], []
    for tag in (own, own + 1):
        differ, spare = parts_of(tag, least)
        if not differ:
            continue  # too small for a link between different sets
        n = differ + spare
        total, count = part_sums(mixed, n)
        # a linked set has at most 100 / least times this one's shingles: so many parts are equal at least
        alike = n - min(differ, (len(shingles) + len(shingles) * 100 // least) * (100 - least) // (100 + least))
        low = int((count < 2).sum())
        if low < alike:
            number = np.flatnonzero(count >= 2)
            total, free = total[number], (alike - low - 1) // 2
        else:
            m = differ + 1
            (second, have), (third, _) = (part_sums(mixed * np.uint64(k), m) for k in (0x94D049BB133111EB, 0xD6E8FEB86659FD93))
            full, empty = np.flatnonzero(count), np.flatnonzero(count == 0)
            pairs = (empty[:, None] * m + np.flatnonzero(have)).ravel()
            triples = ((empty[:, None] * m + np.flatnonzero(have == 0)).ravel()[:, None] * m + np.arange(m)).ravel()
            number = np.concatenate([full, n + pairs, n + n * m + triples])
            total, free = np.concatenate([total[full], second[pairs % m], third[triples % m]]), 0
        sign = (total + number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(tag + 1)) * np.uint64(0xD6E8FEB86659FD93)
        sign ^= sign >> np.uint64(32)
        out.append((sign * np.uint64(0x94D049BB133111EB) >> np.uint64(1)).view(np.int64))
        can_do_without += [len(number), free]
    return (np.concatenate(out) if out else np.empty(0, np.int64)), can_do_without


def hot_level(signs: np.ndarray, hot: list[np.ndarray]) -> np.ndarray:
    """How hot signatures are: in how many of the bitmaps for ever more sets they are."""
    return np.sum([may_contain(h, signs) for h in hot], axis=0, dtype=np.int64) if hot else np.zeros(len(signs), np.int64)


def meeting(signs: np.ndarray, can_do_without: list[int], perhaps: np.ndarray, hot: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Signatures that another set may have, less the hottest of those that the set can do without, and their levels."""
    level = hot_level(signs, hot)
    use = may_contain(perhaps, signs)
    if hot and (use & (level > 0)).any():
        at = 0
        for count, free in zip(can_do_without[::2], can_do_without[1::2]):
            own = np.arange(at, at + count)
            own = own[use[own] & (level[own] > 0)]
            use[own[np.argsort(-level[own], kind="stable")][:free]] = False
            at += count
    return signs[use], level[use]


def shingle_sets(docs: DataFrame, n: int, least: int) -> DataFrame:
    """(doc_id, text_hash, sid, size, bins, signatures, can_do_without) by row: the set's digest, size, histogram and signatures."""
    ship(docs.sparkSession)
    body = F.coalesce(F.col("text"), F.lit(""))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("text_hash"), body.cast("binary").alias("body"))

    @tidy
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(n)
        for part in parts:
            sets = [shingler.set_of(b) for b in part["body"]]
            signs = [signatures(s, least) for s in sets]
            yield pd.DataFrame({
                "doc_id": part["doc_id"].astype("Int64"), "text_hash": part["text_hash"],
                "sid": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets], "size": [len(s) for s in sets],
                "bins": [histogram(s) for s in sets], "signatures": [s for s, _ in signs], "can_do_without": [c for _, c in signs]})

    return source.mapInPandas(run, "doc_id long, text_hash long, sid binary, size long, bins binary, signatures array<long>, "
                                   "can_do_without array<int>")


def histogram(shingles: np.ndarray) -> bytes:
    """Shingles per bin of the hash space (at most 255 counted): the bins of two sets differ by no more than the sets."""
    bins = (shingles.view(np.uint64) * np.uint64(0x94D049BB133111EB) >> np.uint64(40)) % np.uint64(BINS)
    return np.minimum(np.bincount(bins.astype(np.int64), minlength=BINS), 255).astype(np.uint8).tobytes()


def near_edges(size: np.ndarray, bins: np.ndarray, least: int, wide: float = 1) -> list[tuple[int, int]]:
    """Edges that connect sets whose histograms are as near as a link requires, or ``wide`` times that; one per set at most.

    Breadth first from the first set that is left: what is near it is joined, and each joined set is a pivot in
    turn.  Sets come in one order everywhere (by ``sid``), so groups that share sets have the same pivots.
    """
    edges, left = [], np.arange(len(size))
    while len(left) > 1:
        front, left = [int(left[0])], left[1:]
        while front and len(left):
            x = front.pop()
            far = np.abs(bins[left] - bins[x]).sum(axis=1) * (100 + least) > wide * ((size[left] + size[x]) * (100 - least))
            near = left[~far]
            edges += [(x, int(y)) for y in near]
            front += near.tolist()
            left = left[far]
    return edges


def leaders(size: np.ndarray, bins: np.ndarray, least: int) -> tuple[list[tuple[int, int]], list[int]]:
    """(edges, pivots) of a block: each set is a pivot or ``CLOSE`` to one that it has an edge to.

    Linked x and y are connected: where the first of them joins its pivot p, the other is no further from p than a link
    (x is 100 / least times y at most) and the closeness of x to p allow, and gets an edge to p too.
    """
    differ, grow = (100 - least) / (100 + least), 100 / least
    edges, pivots, left = [], [], np.arange(len(size))
    while len(left):
        p, left = int(left[0]), left[1:]
        pivots.append(p)
        apart = np.abs(bins[left] - bins[p]).sum(axis=1)
        near = apart <= differ * (size[left] * (1 + grow) + CLOSE * (grow * size[left] + size[p])) + 1e-9
        bound = CLOSE * differ * (size[left] + size[p])
        edges += [(p, y) for y in left[near].tolist()]
        left = left[(apart > bound) | (np.abs(size[left] - size[p]) > bound)]
    return edges, pivots


def wide_bound(least: int) -> float:
    """Times a link's bound that the pivots of linked sets may be apart: the link, and the closeness on both sides."""
    close = CLOSE * (100 - least) / (100 + least)
    return (1 + CLOSE) * (1 + close) / (1 - close) + CLOSE + 1e-9


class Forest:
    """Union-find over the sets that a task has met, so that it hands out edges of a forest only.  It forgets all
    at a fixed number of sets; an edge may then come again."""

    def __init__(self) -> None:
        self.above: dict[bytes, bytes] = {}

    def root(self, x: bytes) -> bytes:
        above = self.above
        top = x
        while (up := above.get(top, top)) != top:
            top = up
        while (up := above.get(x, x)) != x:
            above[x], x = top, up
        return top

    def join(self, x: bytes, y: bytes) -> bool:
        """Whether the two were apart so far."""
        a, b = self.root(x), self.root(y)
        if a == b:
            return False
        if len(self.above) >= MAX_MET:
            self.above.clear()
            a, b = x, y
        self.above[max(a, b)] = min(a, b)
        return True


def hot_bitmaps(counts: DataFrame) -> list[np.ndarray]:
    """Bitmaps of the signatures that more than ``HOT``, 4 ``HOT``, 16 ``HOT`` ... sets have, as far as there are any."""
    most = counts.agg(F.max("n")).first()[0] or 0
    steps = [HOT * 4 ** k for k in range(HOT_LEVELS) if HOT * 4 ** k < most]
    return [hash_bitmap(counts.where(F.col("n") > n), "signature", HOT_BITS) for n in steps]


def region_edges(sets: DataFrame, least: int, bits: int) -> DataFrame:
    """(a, b): edges between sets with an equal signature that may be linked.

    Most signatures belong to one set.  A bitmap of fixed size of those that do not lets most rows go before
    the shuffle; what it lets pass by chance meets nobody.  Sets that merely share a passage may have an equal
    part too: within a signature only sets are joined whose histograms differ by no more than linked sets can.
    """
    common = keep(sets.select(F.explode("signatures").alias("signature")).groupBy("signature").agg(F.count("*").alias("n"))
                  .where("n > 1"), "shared-signatures")
    hot = hot_bitmaps(common)
    maps = sets.sparkSession.sparkContext.broadcast((hash_bitmap(common, "signature", bits), hot))

    @tidy
    def shared(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            known = [meeting(np.asarray(s), c, *maps.value) for s, c in zip(part["signatures"], part["can_do_without"])]
            times = [len(k) for k, _ in known]
            yield pd.DataFrame({c: np.repeat(part[c].to_numpy(), times) for c in ("sid", "size", "bins")} | {
                "signature": np.concatenate([k for k, _ in known]) if known else np.empty(0, np.int64),
                "level": np.concatenate([v for _, v in known]) if known else np.empty(0, np.int64)})

    def by_signature(wide: float):
        """Edges of whole groups (signature, block), which come one after the other, and the pivots of hot blocks."""
        @tidy
        def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            rest, current, forest = [], None, Forest()
            for part in parts:
                if not len(part):
                    continue
                key, block = part["signature"].to_numpy(), part["block"].to_numpy()
                last = (key == key[-1]) & (block == block[-1])
                if last.all() and current in (None, (key[-1], block[-1])):
                    rest.append(part)
                else:
                    yield edges(pd.concat([*rest, part[~last]], ignore_index=True), forest, wide)
                    rest = [part[last]]
                current = key[-1], block[-1]
            if rest:
                yield edges(pd.concat(rest, ignore_index=True), forest, wide)
        return run

    def edges(part: pd.DataFrame, forest: Forest, wide: float) -> pd.DataFrame:
        key, block, sid, size = (part[c].to_numpy() for c in ("signature", "block", "sid", "size"))
        bins = np.frombuffer(b"".join(part["bins"]), dtype=np.uint8).reshape(-1, BINS).astype(np.int32)
        first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (block[1:] != block[:-1])]))
        count, plain = np.diff(np.append(first, len(key))), block[first] < 0
        two = first[plain & (count == 2)]
        near = np.abs(bins[two] - bins[two + 1]).sum(axis=1) * (100 + least) <= wide * ((size[two] + size[two + 1]) * (100 - least))
        found, pivots = [(x, x + 1) for x in two[near].tolist()], []
        for f, n in zip(first[plain & (count > 2)].tolist(), count[plain & (count > 2)].tolist()):
            found += [(f + x, f + y) for x, y in near_edges(size[f:f + n], bins[f:f + n], least, wide)]
        for f, n in zip(first[~plain].tolist(), count[~plain].tolist()):
            linked, chosen = leaders(size[f:f + n], bins[f:f + n], least)
            found += [(f + x, f + y) for x, y in linked]
            pivots += [f + x for x in chosen]
        new = [(sid[x], sid[y]) for x, y in found if forest.join(sid[x], sid[y])]
        joined = pd.DataFrame({"a": [x for x, _ in new], "b": [y for _, y in new]})
        if not pivots:
            return joined.assign(signature=None, size=None, bins=None)
        kept = part.iloc[pivots]
        return pd.concat([joined, pd.DataFrame({"a": kept["sid"], "b": None, "signature": kept["signature"].astype("Int64"),
                                                "size": kept["size"].astype("Int64"), "bins": kept["bins"]})], ignore_index=True)

    schema = "a binary, b binary, signature long, size long, bins binary"
    block = F.when(F.col("level") > 0, F.pmod(F.xxhash64("sid"), F.pow(F.lit(4.0), F.col("level")).cast("long"))).otherwise(F.lit(-1))
    met = (sets.select("sid", "size", "bins", "signatures", "can_do_without")
           .mapInPandas(shared, "sid binary, size long, bins binary, signature long, level long")
           .select("sid", "size", "bins", "signature", block.cast("long").alias("block")))
    found = (met.repartition("signature", "block").sortWithinPartitions("signature", "block", "sid").mapInPandas(by_signature(1), schema))
    if hot:
        found = keep(found, "near-sets")
        pivots = found.where("b IS NULL").select(F.col("a").alias("sid"), "size", "bins", "signature", F.lit(-1).cast("long").alias("block"))
        across = (pivots.repartition("signature").sortWithinPartitions("signature", "sid")
                  .mapInPandas(by_signature(wide_bound(least)), schema))
        found = found.where("b IS NOT NULL").unionByName(across)
    return found.select("a", "b").where("a != b").distinct()


class Region:
    """Sets of a region with local shingle numbers; finds components by pivots."""

    def __init__(self, sets: list[np.ndarray], least: int):
        self.least, self.eps = least, 1 - least / 100
        self.size = np.array([len(s) for s in sets], dtype=np.int64)
        _, flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.start = np.concatenate([[0], np.cumsum(self.size)])
        self.flat = flat.astype(np.int64)
        self.mark = np.zeros(int(flat.max()) + 1, dtype=np.int64)
        self.component = np.arange(len(sets))
        self.edges: list[tuple[int, int]] = []

    def link(self, x: int, y: int) -> None:
        a, b = self.component[x], self.component[y]
        if a != b:
            self.component[self.component == max(a, b)] = min(a, b)
            self.edges.append((x, y))

    def tokens(self, x: int) -> np.ndarray:
        return self.flat[self.start[x]:self.start[x + 1]]

    def shared(self, pivot: int, members: np.ndarray) -> np.ndarray:
        """Shingles that each member shares with the pivot."""
        own = self.tokens(pivot)
        self.mark[own] = 1
        size = self.size[members]
        at = np.repeat(self.start[members] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        out = np.add.reduceat(self.mark[self.flat[at]], np.concatenate([[0], np.cumsum(size)[:-1]]))
        self.mark[own] = 0
        return out

    def union(self, pivot: int, members: np.ndarray, shared: np.ndarray) -> np.ndarray:
        return self.size[members] + self.size[pivot] - shared

    def is_link(self, shared: np.ndarray, union: np.ndarray) -> np.ndarray:
        return 100 * shared >= self.least * union

    def join(self, members: np.ndarray) -> None:
        todo = [members]
        while todo:
            members = todo.pop()
            if len(members) <= SMALL:
                self.compare(members)
                continue
            order = members[np.argsort(self.size[members], kind="stable")]
            pivots = order[np.linspace(0, len(order) - 1, PIVOTS).astype(np.int64)]
            far = np.empty((len(pivots), len(members)))
            for i, p in enumerate(pivots):
                s = self.shared(p, members)
                u = self.union(p, members, s)
                for x in members[self.is_link(s, u)]:
                    self.link(int(p), int(x))
                far[i] = 1 - s / u
            near = far.min(axis=0)
            # the region of a pivot and its window; equal distances make sets members of several regions
            regions = [members[f <= near + 2 * self.eps + 1e-9] for f in far]
            if max(map(len, regions)) > 0.8 * len(members):
                self.compare(members, far)  # windows of regions separate no longer: those of each set do the rest
            else:
                todo += [r for r in regions if len(r) > 1]

    def compare(self, members: np.ndarray, far: np.ndarray | None = None) -> None:
        """Exact comparison within a region, leaving out pairs that are in one component and, with ``far`` (distances of
        the members to pivots), pairs whose distances to a pivot differ by more than ``eps``."""
        by_size = np.argsort(self.size[members], kind="stable")
        order, far = members[by_size], None if far is None else far[:, by_size]
        for i in range(len(order) - 1):
            x = int(order[i])
            rest = order[i + 1:]
            near = (self.size[rest] * self.least <= 100 * self.size[x]) & (self.component[rest] != self.component[x])
            if far is not None:
                at = i + 1 + np.flatnonzero(near)
                near[at - i - 1] = np.abs(far[:, at] - far[:, i:i + 1]).max(axis=0) <= self.eps + 1e-9
            rest = rest[near]
            if len(rest):
                s = self.shared(x, rest)
                for y in rest[self.is_link(s, self.union(x, rest, s))].tolist():
                    self.link(x, y)


@functools.lru_cache(maxsize=2)
def worker_shingler(n: int) -> Shingler:
    """One per Python worker, kept between groups and tasks."""
    return Shingler(n)


def region_texts(docs: DataFrame, wanted: DataFrame, repeated: bool = True) -> DataFrame:
    """(sid, region, body) of the sets in ``wanted`` (sid, doc_id, text_hash, region).  Texts are read again and
    filtered where they are read; only texts of sets that share a region are shuffled.  ``repeated``: rows of ``docs`` may
    be equal in id and text; then one of them is taken before a region's texts come together."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("text_hash"), "text")
    some = mark_perhaps(rows, row_hash(), wanted, row_hash(), ROW_BITS, "perhaps").where("perhaps")
    asked = wanted.select("sid", "region", F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash"))
    found = some.join(asked, same).select("sid", "region", F.col("text").cast("binary").alias("body"))
    return found.dropDuplicates(["sid"]) if repeated else found


def large_sets(texts: DataFrame, large: DataFrame, n: int) -> DataFrame:
    """(sid, region, bytes, shingles) of the sets in large regions."""

    @tidy
    def shingle(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            sets = [worker_shingler(n).set_of(b) for b in part["body"]]
            yield pd.DataFrame({"sid": part["sid"], "region": part["region"],
                                "bytes": [max(len(b), s.nbytes) for b, s in zip(part["body"], sets)], "shingles": sets})

    return keep(texts.join(large.select("region"), "region").select("sid", "region", "body").mapInPandas(
        shingle, "sid binary, region binary, bytes long, shingles array<long>").dropDuplicates(["sid"]), "large-regions")


def pivot_links(sets: DataFrame, least: int) -> DataFrame:
    """(a, b): links between pivots and all sets of their regions, in rounds of ``PIVOTS`` sets per region that no
    earlier pivot links to, as long as a round links a tenth of what is left."""
    edges, left = None, sets.select("sid", "region")
    count = left.count()
    while count:
        first = F.row_number().over(Window.partitionBy("region").orderBy(F.xxhash64("sid"), "sid"))
        chosen = left.withColumn("rank", first).where(F.col("rank") <= PIVOTS).select("sid")
        pivots = keep(sets.join(chosen, "sid").select("region", F.col("sid").alias("pivot"), F.col("shingles").alias("other")), "pivots")
        shared = F.size(F.array_intersect("shingles", "other"))
        linked = (sets.join(pivots, "region").withColumn("shared", shared)
                  .where(100 * F.col("shared") >= least * (F.size("shingles") + F.size("other") - F.col("shared")))
                  .select(F.col("pivot").alias("a"), F.col("sid").alias("b")))
        found = keep(linked, "pivot-links")  # a pivot is linked to itself
        edges = found if edges is None else edges.unionByName(found)
        left = keep(left.join(found.select(F.col("b").alias("sid")).distinct(), "sid", "left_anti"), "unlinked")
        before, count = count, left.count()
        if 10 * count > 9 * before:
            break
    return edges.where("a != b")


def block_tasks(sets: DataFrame, links: DataFrame, max_region: int) -> DataFrame:
    """(sid, region, label, shingles, task): every two sets of a region that ``links`` leave in different components
    are in a task together; a task has two blocks of about half of ``max_region`` bytes at most.

    A component above a quarter of it has blocks of its own, which are not compared with each other; the
    rest of a region is dealt into blocks by set.
    """
    known = connected_components(links).select(F.col("node").alias("sid"), "label")
    sets = sets.join(known, "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    room = max_region / 4  # blocks are dealt by hash: on average half of what they may have
    whole = sets.groupBy("region", "label").agg(F.sum("bytes").alias("bytes"))
    own = keep(whole.withColumn("own", F.when(F.col("bytes") > room, F.col("label")))
               .groupBy("region", "own").agg(F.sum("bytes").alias("bytes"))
               .withColumn("blocks", F.ceil(F.col("bytes") / room)), "components-in-blocks")
    several = own.where("own IS NOT NULL").select("region", F.col("own").alias("label"), "blocks")
    pooled = own.where("own IS NULL").select("region", F.col("blocks").alias("pooled"))
    dealt = (sets.join(several, ["region", "label"], "left").join(pooled, "region", "left")
             .withColumn("own", F.when(F.col("blocks").isNotNull(), F.col("label")))
             .withColumn("block", F.pmod(F.xxhash64("sid"), F.coalesce("blocks", "pooled")))
             .select("sid", "region", "label", "shingles", "own", "block"))
    each = own.select("region", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    name = F.struct(F.coalesce("own", F.lit(b"")).alias("own"), "block")
    x = each.select("region", F.col("own").alias("x_own"), name.alias("x"))
    y = each.select("region", F.col("own").alias("y_own"), name.alias("y"))
    pairs = (x.join(y, "region").where("x <= y AND NOT (x_own IS NOT NULL AND x_own <=> y_own)")
             .withColumn("task", F.xxhash64("x", "y")).select("region", "x", "y", "task"))
    sides = pairs.select("region", F.col("x").alias("at"), "task").unionByName(pairs.where("x != y").select("region", F.col("y").alias("at"), "task"))
    return dealt.withColumn("at", name).join(sides, ["region", "at"]).select("sid", "region", "label", "shingles", "task")


def link_edges(texts: DataFrame, n: int, least: int, max_region: int = MAX_REGION) -> DataFrame:
    """(a, b): links that connect every component within the regions."""

    def edges(part: pd.DataFrame, sets: list[np.ndarray]) -> pd.DataFrame:
        region = Region(sets, least)
        if "label" in part:
            region.component = pd.factorize(part["label"])[0]
        region.join(np.arange(len(part)))
        sid = part["sid"].to_numpy()
        return pd.DataFrame({"a": [sid[x] for x, _ in region.edges], "b": [sid[y] for _, y in region.edges]})

    def by_text(part: pd.DataFrame) -> pd.DataFrame:
        part = part.drop_duplicates("sid").sort_values("sid")
        if len(part) < 2:
            return pd.DataFrame({"a": [], "b": []})
        return edges(part, [worker_shingler(n).set_of(b) for b in part["body"]])

    def by_block(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("sid")
        if part["label"].nunique() < 2:
            return pd.DataFrame({"a": [], "b": []})
        return edges(part, [np.asarray(s, dtype=np.int64) for s in part["shingles"]])

    large = keep(texts.groupBy("region").agg(F.sum(F.octet_length("body")).alias("n")).where(F.col("n") > max_region), "large")
    if not large.limit(1).count():
        return texts.groupBy("region").applyInPandas(by_text, "a binary, b binary")
    small = texts.join(large, "region", "left_anti").groupBy("region").applyInPandas(by_text, "a binary, b binary")
    sets = large_sets(texts, large, n)
    links = pivot_links(sets, least)
    blocks = block_tasks(sets, links, max_region).groupBy("region", "task").applyInPandas(by_block, "a binary, b binary")
    return small.unionByName(links).unionByName(blocks)


def grouped(docs: DataFrame, n: int = 5, least: int = 80, max_region: int = MAX_REGION, bits: int = FILTER_BITS) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, first) for every row; links at ``least`` percent of ``n``-word
    shingles.  ``first``: the row is its component's first one, by id (null last), then by text hash."""
    rows = keep(shingle_sets(docs, n, least), "shingle-sets")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    named = keep(rows.where("size > 0").groupBy("sid").agg(F.min(row).alias("least_row")), "sets")
    first = F.xxhash64("least_row.doc_id", "least_row.text_hash")
    sets = mark_perhaps(rows.where("size > 0"), row_hash(), named, first, ROW_BITS, "perhaps").where("perhaps")
    edges = region_edges(sets, least, bits)
    regions = connected_components(edges).select(F.col("node").alias("sid"), F.col("label").alias("region"))
    wanted = keep(named.join(regions, "sid").select("sid", "region", "least_row.doc_id", "least_row.text_hash"), "wanted")
    again = rows.where("size > 0").groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).where("n > 1")
    texts = keep(region_texts(docs, wanted, bool(again.limit(1).count())), "region-texts")
    links = connected_components(link_edges(texts, n, least, max_region))
    own = named
    linked = links.select(F.col("node").alias("sid"), "label").join(own, "sid")
    best = linked.groupBy("label").agg(F.min("least_row").alias("best"))
    by_set = linked.join(best, "label").select("sid", "best")
    ids = keep(own.join(by_set, "sid", "left").select("sid", F.coalesce("best", "least_row").alias("best")), "components")
    found = (rows.where("size > 0").select("doc_id", "text_hash", "size", "sid").join(ids, "sid")
             .select("doc_id", "text_hash", F.col("size").alias("n_shingles"), F.col("best.doc_id").alias("component_id"),
                     (F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("text_hash") == F.col("best.text_hash"))).alias("first")))
    empty = rows.where("size = 0").select("doc_id", "text_hash", F.col("size").alias("n_shingles"),
                                          F.col("doc_id").alias("component_id"), F.lit(True).alias("first"))
    return found.unionByName(empty)


def components(docs: DataFrame, n: int = 5, least: int = 80, **options) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row; ``component_id``: the least id reachable by links."""
    return grouped(docs, n, least, **options).select("doc_id", "n_shingles", "component_id")


def drop_near_copies(docs: DataFrame, n: int = 5, least: int = 80, **options) -> DataFrame:
    """The rows of ``docs`` that are the first of their component, with all their columns."""
    return keep_rows(docs, grouped(docs, n, least, **options).select("doc_id", "text_hash", F.col("first").alias("stays")))
