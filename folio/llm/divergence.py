"""How far the sources of a language differ in their words, over texts counted once.

Terms are runs of letters: A-Z, a-z and every character beyond ASCII; A-Z are lower-cased.  A language
keeps its terms that ``least_docs`` documents or more hold.  With ``V`` kept terms and ``N`` occurrences of
them in a group, a term with ``count`` occurrences weighs ``p = 1 + floor(SCALE * (count + 2) / (N + 2 V))``, and two
weights differ by ``f(p, q) = floor((p - q)^2 / (p + q))``.  All arithmetic is on integers.

1. Texts that are equal within a language are collapsed to one row with a multiplicity per source.  Only texts
   that a bitmap of fixed size marks as perhaps repeated are shuffled, one row per task of a group of
   copies; all others are counted where they are read.
2. Each collapsed text is tokenized once; its counts are added times the multiplicities, its document
   frequencies times their sum.  Tasks add up in dictionaries of bounded size.
3. Pairs of sources are evaluated sparsely.  Where one of two sources lacks a term the difference depends on
   one count only, so it is summed over the source's histogram of weights; where both lack it, it is one
   value times a number.  Only terms that both have need the two weights: they are compared in blocks of
   sources per term, and what the histograms said about them is taken back.

Defined results: null text, lang and source are ''; repeated rows count each; a group without terms has all
pairs and no terms; a language with one source has no pairs; without kept terms all pair values are 0; an empty
table gives no rows; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from folio.llm.common import keep, mark_perhaps, ship

SCALE = 1_000_000_000
ROW_BITS = 1 << 25
#: Entries of a task's dictionaries before it hands them on.
MAX_ENTRIES = 1_000_000
#: Sources per block of a term's row, and matrices of two blocks that a task adds up.
BLOCK = 256
MAX_MATRICES = 64

_LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_TO_TERMS = bytes(ord(chr(b).lower()) if b < 0x80 and b in _LETTERS else b if b >= 0x80 else 0x20 for b in range(256))
_COUNTED = "lang string, source string, term binary, n long, docs long"


def terms(body: bytes) -> list[bytes]:
    return body.translate(_TO_TERMS).split()


def collapsed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, source, body) of texts that occur once in their language, and (lang, body, sources, times) of the
    others: one row per text with its multiplicity per source."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = docs.select(name("lang"), name("source"), name("text")).withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))
    times = keep(rows.groupBy("lang", "digest", "source").agg(F.count("*").alias("n")), "text-multiplicities")
    several = times.groupBy("lang", "digest").agg(F.sum("n").alias("n")).where("n > 1").select("lang", "digest")
    key = F.xxhash64("lang", "digest")
    marked = mark_perhaps(rows, key, keep(several, "repeated-texts"), key, ROW_BITS, "perhaps")
    sole = marked.where("NOT perhaps").select("lang", "source", F.col("text").cast("binary").alias("body"))
    texts = marked.where("perhaps").groupBy("lang", "digest").agg(F.first("text").alias("text"))
    by_source = times.groupBy("lang", "digest").agg(F.collect_list("source").alias("sources"), F.collect_list("n").alias("times"))
    shared = texts.join(by_source, ["lang", "digest"]).select("lang", F.col("text").cast("binary").alias("body"), "sources", "times")
    return sole, shared


class Tally:
    """Counts and document frequencies by language, source and term."""

    def __init__(self) -> None:
        self.counts: dict[tuple[str, str], Counter] = {}
        self.docs: dict[tuple[str, str], Counter] = {}

    def of(self, lang: str, source: str) -> tuple[Counter, Counter]:
        key = (lang, source)
        if key not in self.counts:
            self.counts[key], self.docs[key] = Counter(), Counter()
        return self.counts[key], self.docs[key]

    def entries(self) -> int:
        return sum(map(len, self.counts.values()))

    def take(self) -> Iterator[pd.DataFrame]:
        for (lang, source), counts in self.counts.items():
            docs = self.docs[lang, source]
            if counts:
                yield pd.DataFrame({"lang": lang, "source": source, "term": list(counts), "n": list(counts.values()),
                                    "docs": [docs[t] for t in counts]})
        self.counts, self.docs = {}, {}


def counted(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences by group; ``docs`` sums to a term's documents over a language."""
    ship(docs.sparkSession)
    sole, shared = collapsed(docs)

    def run_sole(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tally = Tally()
        for part in parts:
            for lang, source, body in zip(part["lang"], part["source"], part["body"]):
                found = terms(body)
                counts, frequency = tally.of(lang, source)
                counts.update(found)
                frequency.update(set(found))
            if tally.entries() > MAX_ENTRIES:
                yield from tally.take()
        yield from tally.take()

    def run_shared(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tally = Tally()
        for part in parts:
            for lang, body, sources, times in zip(part["lang"], part["body"], part["sources"], part["times"]):
                found, total = Counter(terms(body)), int(sum(times))
                for k, (source, n) in enumerate(zip(sources, times)):
                    counts, frequency = tally.of(lang, source)
                    n = int(n)
                    for term, c in found.items():
                        counts[term] += c * n
                    if not k:  # frequencies are asked by language: once for all sources
                        for term in found:
                            frequency[term] += total
                if tally.entries() > MAX_ENTRIES:
                    yield from tally.take()
        yield from tally.take()

    both = sole.mapInPandas(run_sole, _COUNTED).unionByName(shared.mapInPandas(run_shared, _COUNTED))
    return (both.groupBy("lang", "source", F.col("term").cast("string").alias("term"))
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def weight(count: Column, total: Column) -> Column:
    """``1 + floor(SCALE * (count + 2) / total)``, exact; null where there is no total."""
    up = (count + 2).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.floor(F.call_function("div", up, F.nullif(total, F.lit(0)).cast("decimal(20,0)"))).cast("long") + 1


def difference(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _both(block: int):
    """Per two sources and over the terms that both have: f of the weights instead of what the histograms say."""

    def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        p, q = p[:, None], q[None, :]
        return (p - q) ** 2 // (p + q)

    def take(sums: dict[tuple[str, int, int], np.ndarray]) -> Iterator[pd.DataFrame]:
        for (lang, x, y), m in sums.items():
            i, j = np.nonzero(m)
            value = m[i, j]
            i, j = i + x * block, j + y * block
            if x != y:
                i, j, value = np.append(i, j), np.append(j, i), np.append(value, value)
            if len(i):
                yield pd.DataFrame({"lang": lang, "a": i, "b": j, "v": value})
        sums.clear()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple[str, int, int], np.ndarray] = {}
        for part in parts:
            for lang, x, y, i, p, zero, j, q, none in part.itertuples(index=False):
                if (lang, x, y) not in sums:
                    if len(sums) >= MAX_MATRICES:
                        yield from take(sums)
                    sums[lang, x, y] = np.zeros((block, block), dtype=np.int64)
                sums[lang, x, y][np.ix_(i, j)] += f(p, q) - f(p, none) - f(zero, q) + f(zero, none)
        yield from take(sums)

    return run


def audit(docs: DataFrame, least_docs: int = 10, top: int = 10, block: int = BLOCK) -> DataFrame:
    """(lang, source, part, item, value, rank): ``pair`` rows for every two sources of a language, and the ``top`` ``term``
    rows of each group whose weight is above the language's."""
    every = keep(counted(docs), "term-counts")
    kept = keep(every.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
                .where(F.col("docs") >= least_docs).select("lang", "term", "lang_n"), "kept-terms")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), (F.sum("lang_n") + 2 * F.count("*")).alias("lang_total"))
    counts = keep(every.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "kept-counts")
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.count("*").alias("own_terms"))
    v = F.coalesce("v", F.lit(0))
    groups = (docs.select(name("lang"), name("source")).distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
              .select("lang", "source", v.alias("v"), F.coalesce("own_terms", F.lit(0)).alias("own_terms"),
                      (F.coalesce("n", F.lit(0)) + 2 * v).alias("total"), "lang_total")
              .withColumn("zero", weight(F.lit(0), F.col("total")))
              .withColumn("at", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("long")))
    groups = keep(groups, "groups")
    weighed = counts.join(groups, ["lang", "source"]).withColumn("p", weight(F.col("n"), F.col("total")))
    weighed = keep(weighed.select("lang", "source", "term", "at", "p", "zero", weight(F.col("lang_n"), F.col("lang_total")).alias("q")), "weights")

    ranked = lambda df: df.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    term_rows = ranked(weighed.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                                     difference(F.col("p"), F.col("q")).alias("value"))).where(F.col("rank") <= top)

    one = F.struct((F.col("at") % block).alias("i"), "p", "zero")
    rows = weighed.groupBy("lang", "term", F.floor(F.col("at") / block).alias("block")).agg(F.collect_list(one).alias("x"))
    side = lambda x: [F.col(f"{x}.i"), F.col(f"{x}.p"), F.col(f"{x}.zero")]
    within = rows.select("lang", "block", F.col("block"), *side("x"), *side("x"))
    other = rows.where("block > 0").select("lang", "term", F.col("block").alias("block2"), F.col("x").alias("y"))
    across = rows.join(other, ["lang", "term"]).where("block < block2").select("lang", "block", "block2", *side("x"), *side("y"))
    schema = ["lang", "b1", "b2", "i", "p", "zero", "j", "q", "none"]
    both = (within.toDF(*schema).unionByName(across.toDF(*schema)).mapInPandas(_both(block), "lang string, a long, b long, v long")
            .groupBy("lang", "a", "b").agg(F.sum("v").alias("both")))

    weights = weighed.groupBy("lang", "source", "p").agg(F.count("*").alias("m"))
    weights = weights.groupBy("lang", "source").agg(F.collect_list(F.struct("p", "m")).alias("weights"))
    empty = F.array().cast("array<struct<p:bigint,m:bigint>>")
    known = keep(groups.join(weights, ["lang", "source"], "left").select(
        "lang", "source", "at", "v", "own_terms", "zero", F.coalesce("weights", empty).alias("weights")), "groups-weighed")
    mine = known.withColumnsRenamed({"at": "a", "own_terms": "a_terms", "zero": "a_zero", "weights": "a_weights"})
    theirs = known.select("lang", F.col("source").alias("item"), F.col("at").alias("b"), F.col("own_terms").alias("b_terms"),
                          F.col("zero").alias("b_zero"), F.col("weights").alias("b_weights"))
    against = lambda weights, zero: F.aggregate(
        weights, F.lit(0).cast("long"), lambda acc, x: acc + x["m"] * difference(x["p"], F.col(zero)))
    value = (against("a_weights", "b_zero") + against("b_weights", "a_zero")
             + (F.col("v") - F.col("a_terms") - F.col("b_terms")) * difference(F.col("a_zero"), F.col("b_zero")) + F.coalesce("both", F.lit(0)))
    # as many rows as the result has: one per two sources of a language
    pairs = mine.join(theirs, "lang").where("a != b").join(both, ["lang", "a", "b"], "left")
    pair_rows = ranked(pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce(value, F.lit(0)).cast("long").alias("value")))
    return pair_rows.select(*columns).unionByName(term_rows.select(*columns))
