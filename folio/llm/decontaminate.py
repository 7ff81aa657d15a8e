"""Benchmark decontamination: rare n-gram seeds, a score bound, then Smith-Waterman alignment.

An item is found in a text when the best local Smith-Waterman score of their words (letters and digits, lower
case; match 2, mismatch -1, gap -1) reaches ``least`` of a whole copy's score, 2 per word of the item.  Items
with fewer words than ``n`` are found as whole sequences only (there a single word could reach the share).
The steps before the alignment leave out only what cannot reach that score:

1. Every whole text is cut into words, and documents per word of the benchmark are counted over the whole corpus.
2. Seeds: a score of ``least`` needs ``least`` of the item's words matched, so of any set of ``k`` more places than may
   stay unmatched at least ``k`` are, in the item's order.  That set is the item's rarest words (by that count); its
   n-grams with gaps (``k`` of these words in order) are the seeds.  Rarity is a rank within the item, and the
   seeds cover every passage that reaches the score, however many texts share it and wherever it was edited; n-grams without
   gaps would lose copies in which every fifth word is changed.
3. An alignment is at most ``(3 - 2 least)`` lengths of the item long.  A window is where ``k`` rare words of an item lie as
   near in a text and a seed is among them, its words in the item's order.  In a window each word that
   the item has counts 2 and each other word -1: no alignment scores more than the best run of that sum.
4. Windows whose bound reaches the score are aligned.

The benchmark is handled in blocks of items whose text fits ``block_chars``; a block's words are
broadcast.  Each block reads all documents, never a part of them.  A document's work is its own:
nothing is grouped by passage, so a passage that a third of all texts share is no hot key.

``find`` gives one row per (document row, item) found, ``clean`` the rows that hold none.  Defined results: null or
empty texts hold nothing; items without a word are not searched; a run of letters without spaces is one word, so
an item in a script without spaces is found only where the text has the same runs; repeated items are found
each; an empty benchmark or corpus gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import ship, tidy

N = 5
LEAST = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
#: Characters of benchmark text per block; its words are what is broadcast.
BLOCK_CHARS = 8_000_000
#: Words of a seed (fewer for items with fewer words).
SEED_WORDS = 3
#: A place beyond every item.
FAR = 1 << 60
#: Seed hits that are handled at once, to bound memory; items are dealt into slices by their hits.
MAX_HITS = 2_000_000
#: Aligned at once, to bound memory: cells of one row of all alignments.
MAX_CELLS = 1_000_000
_WORD = re.compile(r"[^\W_]+")
HIT = "array<struct<item_id: bigint, score: double, word_start: int, word_end: int>>"


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


class Items:
    """A block of benchmark items: words numbered from 1."""

    def __init__(self, items: list[tuple[int, str]], n: int):
        self.n = n
        self.number: dict[str, int] = {}
        self.ids: list[int] = []
        self.items: list[np.ndarray] = []
        for key, text in items:
            ws = words(text)
            if ws:
                self.ids.append(key)
                self.items.append(np.array([self.number.setdefault(w, len(self.number) + 1) for w in ws], dtype=np.int64))
        self.size = np.array([len(x) for x in self.items], dtype=np.int64)

    def choose_seeds(self, seen: np.ndarray, least: float) -> None:
        """``seen``: documents by word.  Keeps, by word, the items that have it in a seed, and its first and last place there."""
        self.least = np.where(self.size < self.n, 1.0, least)
        #: Words of a text that an alignment with the item's least score may span.
        self.span = np.maximum(self.size, np.floor((3 - 2 * self.least) * self.size + 1e-9).astype(np.int64))
        matched = np.maximum(1, np.ceil(self.least * self.size - 1e-9).astype(np.int64))
        #: Rare words of the item that any such alignment matches: the words of a seed.
        self.near = np.minimum(SEED_WORDS, matched)
        pairs = [np.empty((4, 0), np.int64)]
        for item, numbers in enumerate(self.items):
            places = np.lexsort((numbers, seen[numbers]))[:len(numbers) - matched[item] + self.near[item]]
            seeds, of = np.unique(numbers[places], return_inverse=True)
            first, last = np.full(len(seeds), FAR), np.zeros(len(seeds), dtype=np.int64)
            np.minimum.at(first, of, places)
            np.maximum.at(last, of, places)
            pairs.append(np.stack([seeds, np.full(len(seeds), item), first, last]))
        word, item, first, last = np.concatenate(pairs, axis=1)
        order = np.lexsort((item, word))
        self.seed_word, self.seed_item, self.seed_first, self.seed_last = word[order], item[order], first[order], last[order]

    def look_up(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all texts in a row (0: in no item), and where texts start."""
        get = self.number.get
        parts = [np.array([get(w, 0) for w in words(t)], dtype=np.int64) for t in texts]
        start = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        return np.concatenate(parts) if parts else np.empty(0, np.int64), start


def bounds(item: np.ndarray, flat: np.ndarray, left: np.ndarray, right: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Per window (left to right in ``flat``) a score that no alignment of the item exceeds: the best run's sum."""
    length = right - left
    first = np.cumsum(length + 1) - (length + 1)  # one place before each window
    at = np.arange(first[-1] + length[-1] + 1) + np.repeat(left - 1 - first, length + 1)
    mark[item] = True
    gain = np.where(mark[flat[at]], MATCH, MISMATCH)
    mark[item] = False
    gain[first] = -((MATCH - MISMATCH) * int(length.max()) + 1)  # each window starts below all before it
    total = np.cumsum(gain)
    return np.maximum.reduceat(total - np.minimum.accumulate(total), first)


def align(items: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smith-Waterman of many pairs at once: rows of word numbers, padded by -1 (items) and -2 (texts).

    Returns per pair the best local score, and where its alignment ends in the item and in the text.
    A row's gap chain is a running maximum, so each item word is one pass over all pairs.
    """
    pairs, width = texts.shape
    slope = -GAP * np.arange(width + 1, dtype=np.int32)
    above = np.zeros((pairs, width + 1), dtype=np.int32)
    best, end_item, end_text = np.zeros(pairs, np.int32), np.zeros(pairs, np.int32), np.zeros(pairs, np.int32)
    for i in range(items.shape[1]):
        now = np.zeros_like(above)
        same = texts == items[:, i:i + 1]
        now[:, 1:] = np.maximum(above[:, :-1] + np.where(same, MATCH, MISMATCH), above[:, 1:] + GAP)
        np.maximum(now, 0, out=now)
        now = np.maximum.accumulate(now + slope, axis=1) - slope
        top = now.max(axis=1)
        better = top > best
        if better.any():
            best[better], end_item[better] = top[better], i + 1
            end_text[better] = now[better].argmax(axis=1)
        above = now
    return best, end_item, end_text


def find_in(block: Items, texts: list[str | None]) -> list[list[tuple]]:
    """Per text the block's items that it holds: (item_id, score, word_start, word_end), in order of place."""
    flat, start = block.look_up(texts)
    best: dict[tuple[int, int], tuple] = {}
    for place, item in seed_hits(block, flat, start):
        best.update(align_windows(block, flat, start, place, item))
    out: list[list[tuple]] = [[] for _ in texts]
    for (d, i), hit in best.items():
        out[d].append((block.ids[i], *hit))
    return [sorted(hits, key=lambda h: (h[2], h[3], h[0] is None, h[0] or 0)) for hits in out]


def least_before(values: np.ndarray, left: np.ndarray) -> np.ndarray:
    """For every place h the least of ``values[left[h]:h]`` (``FAR`` where that is empty), by runs of doubling length."""
    h = np.arange(len(values))
    length, out, step = h - left, np.full(len(values), FAR), 1
    while (some := np.flatnonzero(length >= step)).size:
        out[some] = np.minimum(values[left[some]], values[h[some] - step])  # longer runs come over shorter ones
        values = np.append(np.minimum(values[:-step], values[step:]), values[-step:])
        step *= 2
    return out


def ends_seed(block: Items, flat: np.ndarray, doc: np.ndarray, place: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Which hits (sorted by item and place) are the last word of a seed: the words before it come in the item's order, each
    within the item's span of the next.  Of a word that an item repeats only its first and last place are told apart."""
    pair = block.seed_word * len(block.items) + block.seed_item
    at = np.searchsorted(pair, flat[place] * len(block.items) + item)
    first, last, words_of = block.seed_first[at], block.seed_last[at], block.near[item]
    key = item * (len(flat) + 1) + place
    new = np.concatenate([[True], (item[1:] != item[:-1]) | (doc[1:] != doc[:-1])])
    left = np.maximum(np.searchsorted(key, key - block.span[item], "right"), np.maximum.accumulate(np.where(new, np.arange(len(key)), 0)))
    reached, ends = first, words_of == 1  # the least place of the item at which the words so far may end
    for k in range(2, int(words_of.max()) + 1):
        before = least_before(reached, left)
        reached = np.where(last > before, np.maximum(first, before + 1), FAR)
        ends |= (words_of == k) & (reached < FAR)
    return ends


def seed_hits(block: Items, flat: np.ndarray, start: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, item) of rare words that lie as near each other as an alignment needs, sorted by item and place.

    An item's hits are always in one slice, and a slice has at most ``MAX_HITS`` and one item's more.
    """
    words_in_all, total = len(block.number) + 1, len(flat)
    hits = np.bincount(flat, minlength=words_in_all)[block.seed_word]
    of_item = np.bincount(block.seed_item, hits, len(block.items)).astype(np.int64)
    slice_of = np.maximum(np.cumsum(of_item) - 1, 0) // MAX_HITS
    for number in np.unique(slice_of[of_item > 0]):
        own = (slice_of[block.seed_item] == number) & (hits > 0)
        seed_item = block.seed_item[own]
        times_of = np.bincount(block.seed_word[own], minlength=words_in_all)
        first_of = np.cumsum(times_of) - times_of
        at = np.flatnonzero(times_of[flat])
        times = times_of[flat[at]]
        entry = np.arange(times.sum()) + np.repeat(first_of[flat[at]] - np.cumsum(times) + times, times)
        key = np.sort(seed_item[entry] * total + np.repeat(at, times))
        place, item = key % total, key // total
        doc = np.searchsorted(start, place, "right") - 1
        near = np.zeros(len(key), dtype=bool)
        for k in np.unique(block.near[item]).tolist():
            last = len(key) - k + 1
            run = np.flatnonzero((block.near[item[:last]] == k) & (item[k - 1:] == item[:last]) & (doc[k - 1:] == doc[:last])
                                 & (place[k - 1:] - place[:last] < block.span[item[:last]])) if last > 0 else np.empty(0, np.int64)
            for i in range(k):
                near[run + i] = True
        if near.any():
            yield place[near], item[near]


def align_windows(block: Items, flat: np.ndarray, start: np.ndarray, place: np.ndarray, item: np.ndarray) -> dict[tuple[int, int], tuple]:
    """By (text, item): the best alignment (score, word_start, word_end) around the places, where it reaches the item's score."""
    doc = np.searchsorted(start, place, "right") - 1
    size = block.size
    # windows: hits of the same item that lie within its span of each other share one
    new = np.ones(len(place), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (place[1:] - place[:-1] > block.span[item[1:]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place)) - 1
    seeded = np.logical_or.reduceat(ends_seed(block, flat, doc, place, item), first)
    first, last = first[seeded], last[seeded]
    if not len(first):
        return {}
    doc, item = doc[first], item[first]
    left = np.maximum(start[doc], place[first] - block.span[item] + 1)
    right = np.minimum(start[doc + 1], place[last] + block.span[item])
    least = block.least[item] * MATCH * size[item]
    good = np.zeros(len(item), dtype=bool)
    mark = np.zeros(len(block.number) + 1, dtype=bool)
    of_item = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]]))
    for a, b in zip(of_item, np.append(of_item[1:], len(item))):
        good[a:b] = bounds(block.items[item[a]], flat, left[a:b], right[a:b], mark) >= least[a:b]
    doc, item, left, right = doc[good], item[good], left[good], right[good]
    best: dict[tuple[int, int], tuple] = {}
    order = np.lexsort((right - left, size[item]))
    k = 0
    while k < len(order):
        some = [order[k]]
        while k + len(some) < len(order) and (len(some) + 1) * (right - left)[order[k + len(some)]] <= MAX_CELLS \
                and size[item[order[k + len(some)]]] == size[item[some[0]]]:
            some.append(order[k + len(some)])
        k += len(some)
        width = int((right - left)[some].max())
        texts_at = np.full((len(some), width), -2, dtype=np.int64)
        for row, j in enumerate(some):
            texts_at[row, :right[j] - left[j]] = flat[left[j]:right[j]]
        items_at = np.stack([block.items[item[j]] for j in some])
        top, end_item, end_text = align(items_at, texts_at)
        full = MATCH * items_at.shape[1]
        good = np.flatnonzero(top >= block.least[item[some]] * full)
        if len(good):
            # the start: the same alignment, read backwards from its end
            back_items = np.full((len(good), items_at.shape[1]), -1, dtype=np.int64)
            back_texts = np.full((len(good), width), -2, dtype=np.int64)
            for row, g in enumerate(good):
                back_items[row, :end_item[g]] = items_at[g, :end_item[g]][::-1]
                back_texts[row, :end_text[g]] = texts_at[g, :end_text[g]][::-1]
            _, _, length = align(back_items, back_texts)
            for row, g in enumerate(good):
                j = some[g]
                end = int(left[j] + end_text[g] - start[doc[j]])
                key, hit = (int(doc[j]), int(item[j])), (float(top[g]) / full, end - int(length[row]), end)
                if key not in best or (hit[0], -hit[1]) > (best[key][0], -best[key][1]):
                    best[key] = hit
    return best


def blocks(benchmark: DataFrame, n: int, block_chars: int) -> Iterator[Items]:
    """Blocks of items, in order of the id; one block at a time is on the driver."""
    known = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.col("text").isNotNull())
    total = known.agg(F.sum(F.length("text"))).first()[0] or 0
    many = max(1, -(-total // block_chars))
    for b in range(many):
        rows = known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(many)) == b).collect()
        yield Items(sorted(((r["item_id"], r["text"]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1])), n)


def mark(docs: DataFrame, benchmark: DataFrame, n: int = N, least: float = LEAST, block_chars: int = BLOCK_CHARS,
         column: str = "hits") -> DataFrame:
    """All columns of ``docs`` with the list of items that each text holds (empty: clean).

    ``score``: share of a whole copy's alignment score; words are numbered from 0 within the text.
    """
    spark = docs.sparkSession
    ship(spark)
    others = [F.col(f"`{c}`") for c in docs.columns if c != column]
    out = docs.select(*others, F.array().cast(HIT).alias(column))
    for block in blocks(benchmark, n, block_chars):
        block.choose_seeds(documents_per_word(docs, block), least)
        search = searcher(spark.sparkContext.broadcast(block))
        out = out.withColumn(column, F.concat(column, search("text")))
    return out


def searcher(shared):
    @F.pandas_udf(HIT)
    @tidy
    def search(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            hits: list[list[dict]] = []
            for texts in chunks(part.tolist()):
                hits += [[dict(zip(("item_id", "score", "word_start", "word_end"), h)) for h in hs]
                         for hs in find_in(shared.value, texts)]
            yield pd.Series(hits, dtype=object)

    return search


def documents_per_word(docs: DataFrame, block: Items) -> np.ndarray:
    """How many documents of the whole corpus hold each word of the block (one number per word reaches the driver)."""
    shared = docs.sparkSession.sparkContext.broadcast(block)
    many = len(block.number) + 1

    @tidy
    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(many, dtype=np.int64)
        for part in parts:
            for texts in chunks(part["text"].tolist()):
                flat, start = shared.value.look_up(texts)
                doc = np.repeat(np.arange(len(texts)), np.diff(start))
                seen += np.bincount(np.unique((doc * many + flat)[flat > 0]) % many, minlength=many)
        at = np.flatnonzero(seen)
        yield pd.DataFrame({"word": at, "docs": seen[at]})

    seen = np.zeros(many, dtype=np.int64)
    rows = docs.select("text").mapInPandas(count, "word long, docs long").groupBy("word").agg(F.sum("docs").alias("docs"))
    for r in rows.toLocalIterator():
        seen[r["word"]] = r["docs"]
    return seen


def find(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """(doc_id, item_id, score, word_start, word_end), one row per document row and item that it holds."""
    marked = mark(docs.select("doc_id", "text"), benchmark, column="hits", **options)
    return marked.select("doc_id", F.explode("hits").alias("hit")).select("doc_id", "hit.*")


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose text holds no item.  No row is shuffled."""
    marked = mark(docs.select(F.struct("*").alias("row"), "text"), benchmark, **options)
    return marked.where(F.size("hits") == 0).select("row.*")


def chunks(texts: list[str | None], size: int = 2_000_000) -> Iterator[list[str | None]]:
    """Texts in runs of about ``size`` characters, so that a task's arrays stay small."""
    at = 0
    while at < len(texts):
        end, n = at, 0
        while end < len(texts) and (end == at or n < size):
            n += len(texts[end] or "")
            end += 1
        yield texts[at:end]
        at = end
