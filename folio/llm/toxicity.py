"""Toxicity: a counterfactual-regularised linear classifier.

Features of a text: its distinct lower-cased words, each by itself and by its prefixes of 3 to 8
letters, hashed to 2^20 places.  A word's features always add the same amount, so a text's
score is the sum of its distinct words' weights and a bias, through a logistic function.

Fitting uses a bounded sample of labelled rows (``max_labelled``, in the order of a hash of the id;
the only bound here).  Spark joins it to the texts (broadcast of that bounded list), counts
features by label, keeps the ``n_features`` most telling ones, and brings one short sparse row per
sampled text to the driver, where the weights are fitted.

Counterfactuals: in each sampled text that names an identity term, the term is swapped for each other one of
its group, and the squared change of the score's logit is penalised by ``swap_weight``.  So a group's
mention in neutral text moves the score little, whatever the labels of the texts that name it.

Scoring reads every whole text once.  Labels, language, source and id are no inputs of a score.

Defined results: null and empty texts score the bias alone; rows whose label is null are not
used; an id labelled more than once counts as toxic if any label says so; of an id on several documents the
text with the least hash is learned from; without labelled
rows of both kinds every text scores the share of toxic ones, (toxic + 0.5) / (rows + 1);
repeated rows are scored each; other columns are passed through, and columns that carry a result
name are replaced.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.common import keep, ship, tidy

PLACES = 1 << 20
MAX_LABELLED = 20_000
N_FEATURES = 4_096
SWAP_WEIGHT = 1.0
PREFIXES = range(3, 9)
MAX_KEPT_WORDS = 150_000
_WORD = re.compile(r"\w+")

#: Identity terms by group; a term is swapped within its group.
IDENTITY_GROUPS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"),
    ("christian", "jewish", "muslim", "hindu", "buddhist", "atheist"),
    ("christians", "jews", "muslims", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"), ("african", "european", "american"),
    ("gay", "lesbian", "straight", "bisexual"), ("transgender", "cisgender"),
    ("immigrants", "natives"), ("refugees", "citizens"), ("old", "young"), ("deaf", "hearing"), ("blind", "sighted"),
    ("frauen", "männer"), ("femmes", "hommes"), ("mujeres", "hombres"),
    ("christen", "juden", "muslime"), ("chrétiens", "juifs", "musulmans"), ("cristianos", "judíos", "musulmanes"),
)


class Model(NamedTuple):
    bias: float
    weights: dict[int, float]  # by place


def words(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def places(word: str) -> list[int]:
    """Hashed features of a word: itself and its proper prefixes."""
    names = [f"={word}", *(word[:k] for k in PREFIXES if len(word) > k)]
    return [zlib.crc32(n.encode("utf-8", "surrogatepass")) & (PLACES - 1) for n in names]


def counts(ws: set[str]) -> Counter:
    return Counter(p for w in ws for p in places(w))


def swaps(ws: set[str], groups) -> list[set[str]]:
    """The text's word sets with one identity term swapped for each other one of its group that the text lacks."""
    return [ws - {term} | {other} for group in groups for term in group if term in ws for other in group if other not in ws]


def is_held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample_labelled(docs: DataFrame, labels: DataFrame, label: str, max_labelled: int) -> DataFrame:
    """(doc_id, toxic, text), one row per id, of at most ``max_labelled`` labelled ids outside the held-out fold.

    Of an id's rows the text with the least hash is taken, on Spark, so repeated ids add nothing to what is collected.
    """
    few = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~is_held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max((F.col(label) != 0).cast("int")).alias("toxic"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).join(F.broadcast(few), "doc_id")
    one = rows.groupBy("doc_id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    return keep(one, "labelled")


def feature_counts(sample: DataFrame) -> DataFrame:
    """(place, pos, neg): texts by label that have a feature."""

    @tidy
    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros((2, PLACES), dtype=np.int64)
        for part in parts:
            for toxic, text in zip(part["toxic"], part["text"]):
                at = np.fromiter(counts(words(text)), np.int64)
                seen[int(toxic), at] += 1
        at = np.flatnonzero(seen.any(axis=0))
        yield pd.DataFrame({"place": at, "pos": seen[1, at], "neg": seen[0, at]})

    return (sample.select("toxic", "text").mapInPandas(count, "place long, pos long, neg long")
            .groupBy("place").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))


def telling(seen: DataFrame, n_pos: int, n_neg: int, n_features: int) -> list[int]:
    """The features whose log odds differ most between labels, in standard errors."""
    p, n = F.col("pos") + 0.5, F.col("neg") + 0.5
    z = F.abs((F.log(p / (n_pos + 1)) - F.log(n / (n_neg + 1))) / F.sqrt(1 / p + 1 / n))
    top = seen.where(F.col("pos") + F.col("neg") >= 3).select("place", z.alias("z")).orderBy(F.desc("z"), "place").limit(n_features)
    return [r["place"] for r in top.collect()]


def sparse_rows(sample: DataFrame, chosen: list[int], groups) -> pd.DataFrame:
    """One row per sampled text, and one per swapped version, with the counts of the chosen features."""
    index = {p: i for i, p in enumerate(chosen)}
    shared = sample.sparkSession.sparkContext.broadcast(index)

    @tidy
    def rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = shared.value
        for part in parts:
            out = []
            for key, toxic, text in zip(part["doc_id"], part["toxic"], part["text"]):
                ws = words(text)
                for version, version_words in enumerate([ws, *swaps(ws, groups)]):
                    found = {at[p]: n for p, n in counts(version_words).items() if p in at}
                    out.append((int(key), zlib.crc32((text or "").encode("utf-8", "surrogatepass")), version, int(toxic), list(found), [float(n) for n in found.values()]))
            yield pd.DataFrame(out, columns=["doc_id", "crc", "version", "toxic", "at", "n"])

    got = sample.mapInPandas(rows, "doc_id long, crc long, version int, toxic int, at array<int>, n array<double>").toPandas()
    return got.sort_values(["doc_id", "crc", "version"], kind="stable").reset_index(drop=True)


def fit_weights(rows: pd.DataFrame, n_features: int, swap_weight: float, decay: float = 0.3, steps: int = 400) -> tuple[float, np.ndarray]:
    """Logistic regression with a squared penalty on weights and on logit changes under swaps (Adam, all rows each step)."""
    length = rows["at"].map(len).to_numpy()
    at = np.concatenate([np.asarray(x, dtype=np.int64) for x in rows["at"]]) if length.sum() else np.empty(0, np.int64)
    n = np.concatenate([np.asarray(x, dtype=float) for x in rows["n"]]) if length.sum() else np.empty(0)
    row = np.repeat(np.arange(len(rows)), length)
    own = (rows["version"] == 0).to_numpy()
    origin = np.maximum.accumulate(np.where(own, np.arange(len(rows)), 0))  # of each swapped row
    swapped = np.flatnonzero(~own)
    toxic, n_own = rows["toxic"].to_numpy(), own.sum()
    share = toxic[own].mean()
    w, b = np.zeros(n_features), float(np.log(share / (1 - share)))
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, steps + 1):
        s = np.bincount(row, n * w[at], len(rows)) + b
        pull = np.where(own, 1 / (1 + np.exp(-np.clip(s, -500, 500))) - toxic, 0.0)
        bias_pull = pull.sum()
        change = 2 * swap_weight * (s[swapped] - s[origin[swapped]])
        np.add.at(pull, swapped, change)
        np.add.at(pull, origin[swapped], -change)
        g = np.append(np.bincount(at, n * pull[row], n_features) + decay * w, bias_pull) / n_own
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return b, w


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_labelled: int = MAX_LABELLED,
        n_features: int = N_FEATURES, swap_weight: float = SWAP_WEIGHT, groups=IDENTITY_GROUPS) -> Model:
    ship(docs.sparkSession)
    sample = sample_labelled(docs, labels, label, max_labelled)
    by = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    pos, neg = by.get(1, 0), by.get(0, 0)
    if not pos or not neg:
        share = (pos + 0.5) / (pos + neg + 1)
        return Model(float(np.log(share / (1 - share))), {})
    chosen = telling(feature_counts(sample), pos, neg, n_features)
    terms = {p for g in groups for t in g for p in places(t)}
    chosen += sorted(terms.difference(chosen))
    bias, w = fit_weights(sparse_rows(sample, chosen, groups), len(chosen), swap_weight)
    return Model(float(bias), {p: float(x) for p, x in zip(chosen, w) if x})


class Scorer:
    """Scores texts; remembers words' weights up to a fixed number of words."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, float] = {}

    def score(self, text: str | None) -> float:
        ws, known = words(text), self.known
        if len(known) > MAX_KEPT_WORDS:
            known.clear()
        new = ws.difference(known)
        if new:
            weight = self.model.weights.get
            for w in new:
                known[w] = sum([weight(p, 0.0) for p in places(w)])
        s = self.model.bias + sum(sorted([x for x in map(known.__getitem__, ws) if x]))
        return float(1 / (1 + np.exp(-min(max(s, -500.0), 500.0))))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on)."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    @tidy
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared.value)
        for texts in parts:
            yield pd.Series([scorer.score(t) for t in texts.tolist()], dtype="float64")

    others = [c for c in docs.columns if c not in ("score", "predicted")]
    return (docs.select(*[F.col(f"`{c}`") for c in others]).withColumn("score", run(F.col(text)))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the model does not reject, with all their columns."""
    scored = score(docs.select(F.struct("*").alias("row"), "text"), model)
    return scored.where("predicted = 0").select("row.*")
