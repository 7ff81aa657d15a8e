"""Prefix trie of conversations, built as a z-fast trie in batches on Spark.

A conversation is a sequence of turns; a prefix of d turns is named by d and a 124-bit polynomial digest,
a sum over its turns that is formed by blocks.  Only digests and lengths take part, never texts.

The trie is compacted: its nodes are the root, the ends of conversations and the prefixes at which
conversations part; a node's edge covers the depths above its parent's, down to its own.  Each node is kept
under two keys: its handle, the prefix at the two-fattest depth of its edge (the depth in it that is divisible by
the highest power of two), and its name, the prefix one turn below its parent.

1. Equal conversations are one from here on (count and least id).
2. Batches: all conversations without a node look for their exit node by fat binary search. A probe at the
   two-fattest depth between the bounds joins the handles; a node that the conversation passes through raises the
   lower bound, anything else lowers the upper one.  So as many probes suffice as the longest length has bits.
3. What leaves the trie at the same place with the same next turn is a group.  Edges are split where conversations
   end or part, and one member of each group, the one of least hash, is inserted.  The others come again
   with the next batch; each batch at least halves a group's undecided depths on average.
4. Counts of subtrees are formed by doubling: after k rounds a node holds the sums of what is less than 2^k nodes
   below it.
5. Edges are expanded to one row per depth.  The tokens that sharing saves follow from sums over subtrees: with
   D the code points of a prefix, the sum of n * length over a subtree is the sum of D over its ends, less n times D
   above it.

A task holds single rows, a block of 64 turns or 4,096 ids.  The ids that end at one node are hashed as a stream
of sorted pieces.

Defined results: null role and text are empty; null turns come first; equal turns are ordered by the MD5 of their
role and text; repeated rows are turns of their own; a null conv_id is one conversation, which sorts last and is
written as nothing in the list of ids; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from folio.llm.common import keep, sha256_hex, ship

#: Stands for a null conv_id: the last one.
NO_ID = (1 << 63) - 1
TURNS_PER_BLOCK = 64
IDS_PER_PIECE = 4096
#: Probes that one plan holds before its rows are written.
PROBES = 4
#: Primes below 2^31, and a base for each.
_PRIMES = np.array([2147483647, 2147483629, 2147483587, 2147483579], dtype=np.uint64)
_BASES = np.array([1202604851, 1843027453, 961748929, 1500450271], dtype=np.uint64)
_SUMS = [f"s{w}" for w in range(len(_PRIMES))]


def numbered(rows: DataFrame) -> DataFrame:
    """(id, pos, digest, chars) of conversation rows (conv_id, turn, role, text); ``pos`` counts a conversation's turns from 1.

    Rows are range-partitioned and sorted, so that one conversation may lie in many tasks; a
    row's place is its place in its task plus what earlier tasks hold of its conversation.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = rows.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("id"), "turn",
                        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("digest"),
                        F.length(text).cast("long").alias("chars"), F.monotonically_increasing_id().alias("tie"))
    order = [F.col("id").asc(), F.col("turn").asc_nulls_first(), F.col("digest").asc(), F.col("tie").asc()]
    at = F.monotonically_increasing_id()
    placed = keep(turns.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "digest", "chars", at.alias("at")), "turns-placed")
    placed = placed.withColumn("task", F.shiftright("at", 33))
    spans = placed.groupBy("id", "task").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("id", "task", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first") + 1).alias("shift"))
    return placed.join(spans, ["id", "task"]).select("id", (F.col("at") + F.col("shift")).alias("pos"), "digest", "chars")


def _powers(exponent: np.ndarray) -> np.ndarray:
    """bases ** exponent, one column per prime."""
    out = np.ones((len(exponent), len(_PRIMES)), dtype=np.uint64)
    square, left = _BASES.copy(), exponent.astype(np.uint64)
    while left.any():
        odd = (left & np.uint64(1)).astype(bool)
        out[odd] = out[odd] * square % _PRIMES
        square = square * square % _PRIMES
        left >>= np.uint64(1)
    return out


def _summands(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        words = np.frombuffer(bytes.fromhex("".join(part["digest"])), dtype=">u4").astype(np.uint64).reshape(-1, len(_PRIMES))
        sums = (words % _PRIMES * _powers(part["pos"].to_numpy()) % _PRIMES).astype(np.int64)
        yield pd.DataFrame({"id": part["id"], "pos": part["pos"], "chars": part["chars"]} | {s: sums[:, w] for w, s in enumerate(_SUMS)})


def prefixes(turns: DataFrame) -> DataFrame:
    """(id, d, a, b, chars, total) of turns (id, pos, digest, chars): every prefix with its digest (a, b), the code
    points of its last turn and of all its turns."""
    schema = "id long, pos long, chars long, " + ", ".join(f"{s} long" for s in _SUMS)
    block = F.floor((F.col("pos") - 1) / TURNS_PER_BLOCK)
    rows = keep(turns.select("id", "pos", "digest", "chars").mapInPandas(_summands, schema).withColumn("block", block), "turn-sums")
    added = [*_SUMS, "chars"]
    earlier = Window.partitionBy("id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("id", "block").agg(*[F.sum(c).alias(c) for c in added])
    before = blocks.select("id", "block", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in added])
    here = Window.partitionBy("id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    local = rows.select("id", "block", "pos", "chars", *[F.sum(c).over(here).alias(f"{c}_here") for c in added])
    total = lambda c: F.col(f"{c}_here") + F.col(f"{c}_before")
    word = [total(s) % F.lit(int(p)) for s, p in zip(_SUMS, _PRIMES)]
    pair = lambda x, y: x * F.lit(1 << 31) + y
    return (local.join(before, ["id", "block"])
            .select("id", F.col("pos").alias("d"), pair(word[0], word[1]).alias("a"), pair(word[2], word[3]).alias("b"),
                    "chars", total("chars").alias("total")))


def two_fattest(above: str, to: str) -> Column:
    """The depth in (above, to] that is divisible by the highest power of two."""
    return F.expr(f"{to} & shiftleft(-1L, length(bin({above} ^ {to})) - 1)")


def _at(known: DataFrame, depth: str, a: str, b: str, of: str = "rep", total: str | None = None) -> DataFrame:
    """The prefixes of ``known`` with other names, to be joined on (of, depth)."""
    more = [F.col("total").alias(total)] if total else []
    return known.select(F.col("id").alias(of), F.col("d").alias(depth), F.col("a").alias(a), F.col("b").alias(b), *more)


NODE = ["len", "a", "b", "rep", "plen", "pa", "pb"]
KEYED = [*NODE, "f", "fa", "fb", "na", "nb"]


def _keyed(nodes: DataFrame, known: DataFrame) -> DataFrame:
    """Nodes with the digests of their handle (depth f) and of their name (depth plen + 1)."""
    return (nodes.withColumn("f", two_fattest("plen", "len")).join(_at(known, "f", "fa", "fb"), ["rep", "f"])
            .withColumn("below", F.col("plen") + 1).join(_at(known, "below", "na", "nb"), ["rep", "below"]).select(*KEYED))


def exits(todo: DataFrame, nodes: DataFrame, known: DataFrame, longest: int) -> DataFrame:
    """(rep, n, lo, la, lb) of conversations (rep, n): the deepest node, of depth ``lo``, that each passes through."""
    state = todo.select("rep", "n", F.lit(0).cast("long").alias("lo"), F.col("n").alias("hi"),
                        F.lit(0).cast("long").alias("la"), F.lit(0).cast("long").alias("lb"))
    handles = nodes.select("f", "fa", "fb", F.col("len").alias("u"), F.col("a").alias("ua"), F.col("b").alias("ub"))
    for k in range(longest.bit_length()):
        probe = (state.withColumn("f", F.when(F.col("lo") < F.col("hi"), two_fattest("lo", "hi")))
                 .join(_at(known, "f", "fa", "fb"), ["rep", "f"], "left").join(handles, ["f", "fa", "fb"], "left")
                 .join(_at(known, "u", "va", "vb"), ["rep", "u"], "left"))
        through = F.coalesce((F.col("ua") == F.col("va")) & (F.col("ub") == F.col("vb")), F.lit(False))
        state = probe.select(
            "rep", "n", F.when(through, F.col("u")).otherwise(F.col("lo")).alias("lo"),
            F.when(through | F.col("f").isNull(), F.col("hi")).otherwise(F.col("f") - 1).alias("hi"),
            F.when(through, F.col("ua")).otherwise(F.col("la")).alias("la"), F.when(through, F.col("ub")).otherwise(F.col("lb")).alias("lb"))
        if k % PROBES == PROBES - 1:
            state = keep(state, "trie-probes")
    return state.drop("hi")


def insert(todo: DataFrame, nodes: DataFrame, known: DataFrame, longest: int) -> DataFrame:
    """The nodes after a batch: every place where conversations of ``todo`` (rep, n, a, b) leave is a node, and one
    conversation for each next turn at such a place has its own."""
    left = (exits(todo.select("rep", "n"), nodes, known, longest).withColumn("below", F.col("lo") + 1)
            .join(_at(known, "below", "na", "nb"), ["rep", "below"]))
    names = nodes.where("plen >= 0").select(F.col("plen").alias("lo"), "na", "nb", F.col("rep").alias("other"), F.col("len").alias("u"),
                                            F.col("a").alias("ua"), F.col("b").alias("ub"))
    left = keep(left.join(names, ["lo", "na", "nb"], "left").select("rep", "n", "lo", "la", "lb", "other", "u", "ua", "ub"), "trie-exits")
    # along the edge that a conversation enters: how far its prefixes are those of the edge's own conversation
    mine = _at(known, "d", "xa", "xb")
    theirs = _at(known, "d", "ya", "yb", of="other")
    shared = (left.where("u IS NOT NULL").select("rep", "n", "lo", "other", "u").join(mine, "rep").where("d > lo AND d < u")
              .join(theirs, ["other", "d"]).where("xa = ya AND xb = yb").groupBy("rep").agg(F.max("d").alias("l")))
    parts = (left.join(shared, "rep", "left").withColumn("l", F.coalesce("l", "lo"))
             .join(_at(known, "l", "xa", "xb"), ["rep", "l"], "left")
             .withColumn("xa", F.coalesce("xa", "la")).withColumn("xb", F.coalesce("xb", "lb"))
             .withColumn("next", F.col("l") + 1).join(_at(known, "next", "ta", "tb"), ["rep", "next"], "left"))
    parts = keep(parts, "trie-parts")
    splits = parts.where("u IS NOT NULL AND l > lo").select("lo", "la", "lb", "other", "u", "ua", "ub", "l", "xa", "xb").distinct()
    edge = Window.partitionBy("u", "ua", "ub").orderBy("l")
    above = lambda c, top: F.coalesce(F.lag(c).over(edge), F.col(top))
    middle = splits.select(F.col("l").alias("len"), F.col("xa").alias("a"), F.col("xb").alias("b"), F.col("other").alias("rep"),
                           above("l", "lo").alias("plen"), above("xa", "la").alias("pa"), above("xb", "lb").alias("pb"))
    last = splits.groupBy("u", "ua", "ub").agg(F.max(F.struct("l", "xa", "xb")).alias("last"))
    cut = last.select(F.col("u").alias("len"), F.col("ua").alias("a"), F.col("ub").alias("b"), "last")
    lowered = nodes.select(*NODE).join(cut, ["len", "a", "b"]).select(
        "len", "a", "b", "rep", F.col("last.l").alias("plen"), F.col("last.xa").alias("pa"), F.col("last.xb").alias("pb"))
    chosen = (parts.where("l < n").groupBy("l", "xa", "xb", "ta", "tb").agg(F.min(F.struct(F.xxhash64("rep").alias("h"), "rep")).alias("x"))
              .select(F.col("x.rep").alias("rep"), "l", "xa", "xb").join(todo.select("rep", "n", "a", "b"), "rep"))
    leaves = chosen.select(F.col("n").alias("len"), "a", "b", "rep", F.col("l").alias("plen"), F.col("xa").alias("pa"), F.col("xb").alias("pb"))
    changed = _keyed(middle.unionByName(lowered).unionByName(leaves), known)
    return keep(nodes.join(cut.select("len", "a", "b"), ["len", "a", "b"], "left_anti").select(*KEYED).unionByName(changed), "trie-nodes")


def build(ends: DataFrame, known: DataFrame) -> DataFrame:
    """The compacted nodes (``KEYED``) of distinct conversations ``ends`` (n, a, b, rep), whose prefixes are ``known``."""
    spark = ends.sparkSession
    longest = ends.agg(F.max("n")).first()[0] or 0
    zero = F.lit(0).cast("long")
    root = spark.range(1).select(*[(F.lit(None).cast("long") if c == "rep" else F.lit(-1).cast("long") if c in ("plen", "pa", "pb") else zero)
                                   .alias(c) for c in KEYED])
    nodes = keep(root, "trie-nodes")
    while True:
        have = nodes.select(F.col("len").alias("n"), "a", "b")
        todo = keep(ends.select("rep", "n", "a", "b").join(have, ["n", "a", "b"], "left_anti"), "trie-todo")
        if not todo.limit(1).count():
            return nodes
        nodes = insert(todo, nodes, known, longest)


def subtree_sums(nodes: DataFrame) -> DataFrame:
    """Adds up ``cnt``, ``leaves``, ``ended`` and ``edges`` and takes the least ``least`` over the subtrees of nodes (key, parent, ...)."""
    adding = {"cnt": F.sum, "leaves": F.sum, "ended": F.sum, "edges": F.sum, "least": F.min}
    state = nodes.select("key", F.col("parent").alias("up"), *adding)
    while True:
        state = keep(state, "trie-sums")
        rising = state.where("up IS NOT NULL")
        if not rising.limit(1).count():
            return state.drop("up")
        below = rising.groupBy(F.col("up").alias("key")).agg(*[f(c).alias(f"{c}_below") for c, f in adding.items()])
        add = lambda c: F.least(c, f"{c}_below") if adding[c] is F.min else F.col(c) + F.coalesce(f"{c}_below", F.lit(0))
        # what rises to the root ends there
        jump = state.select(F.col("key").alias("up"), F.col("up").alias("next"))
        inner = rising.where("up.len > 0").join(jump, "up").select("key", "next")
        state = (state.drop("up").join(below, "key", "left").join(inner, "key", "left")
                 .select("key", F.col("next").alias("up"), *[add(c).alias(c) for c in adding]))


def end_digests(members: DataFrame) -> DataFrame:
    """(key, ends_sha256) of members (key, id): the digest of the ids that end at a node, ascending and comma-joined."""
    piece = F.floor(F.col("id") / F.lit(IDS_PER_PIECE).cast("decimal(20,0)")).cast("long")
    pieces = (members.groupBy("key", piece.alias("piece")).agg(F.array_sort(F.collect_list("id")).alias("ids"))
              .select(F.col("key.len").alias("len"), F.col("key.a").alias("a"), F.col("key.b").alias("b"), "piece",
                      F.array_join(F.transform("ids", lambda i: F.when(i == NO_ID, F.lit("")).otherwise(i.cast("string"))), ",").alias("text")))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, digest = None, None
        for part in parts:
            done = []
            for *at, _, text in part.itertuples(index=False):
                if at != key:
                    if key is not None:
                        done.append((*key, digest.hexdigest()))
                    key, digest = at, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(text.encode())
            yield pd.DataFrame(done, columns=["len", "a", "b", "ends_sha256"])
        if key is not None:
            yield pd.DataFrame([(*key, digest.hexdigest())], columns=["len", "a", "b", "ends_sha256"])

    hashed = pieces.repartition("len", "a", "b").sortWithinPartitions("len", "a", "b", "piece").mapInPandas(
        run, "len long, a long, b long, ends_sha256 string")
    return hashed.select(F.struct("len", "a", "b").alias("key"), "ends_sha256")


def trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """One row per prefix of the conversations ``members`` (id), turnless ones included, with turns (id, pos, digest, chars):

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).
    """
    ship(turns.sparkSession)
    every = keep(prefixes(turns), "prefixes")
    last = every.groupBy("id").agg(F.max(F.struct("d", "a", "b", "total")).alias("last"))
    zero = F.lit(0).cast("long")
    of = lambda c: F.coalesce(f"last.{c}", zero)
    members = keep(members.select("id").distinct().join(last, "id", "left").select(
        "id", F.struct(of("d").alias("len"), of("a").alias("a"), of("b").alias("b")).alias("key"), of("total").alias("total")), "members")
    ends = keep(members.groupBy("key").agg(F.count("*").alias("cnt"), F.min("id").alias("least"), F.max("total").alias("total"))
                .select("key", "cnt", "least", "total", F.col("key.len").alias("n"), F.col("key.a").alias("a"), F.col("key.b").alias("b"),
                        F.col("least").alias("rep")), "ends")
    known = keep(every.join(ends.select(F.col("rep").alias("id")), "id", "left_semi"), "prefixes-once")
    nodes = build(ends, known)

    key, parent = F.struct("len", "a", "b"), F.struct(F.col("plen").alias("len"), F.col("pa").alias("a"), F.col("pb").alias("b"))
    nodes = (nodes.join(_at(known, "len", "xa", "xb", total="down").drop("xa", "xb"), ["rep", "len"], "left")
             .join(_at(known, "plen", "ya", "yb", total="up").drop("ya", "yb"), ["rep", "plen"], "left")
             .select(key.alias("key"), F.when(F.col("plen") >= 0, parent).alias("parent"), "rep", "plen", "len",
                     F.coalesce("up", zero).alias("up_total"), (F.coalesce("down", zero) - F.coalesce("up", zero)).alias("edges")))
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("children"))
    nodes = keep(nodes.join(children, "key", "left").join(ends.select("key", "cnt", "least", "total"), "key", "left").select(
        "key", "parent", "rep", "plen", "len", "up_total", "edges", F.coalesce("children", zero).alias("children"),
        F.col("children").isNull().cast("long").alias("leaves"), F.coalesce("cnt", zero).alias("cnt"), "least",
        (F.coalesce("cnt", zero) * F.coalesce("total", zero)).alias("ended")), "trie-compacted")
    sums = subtree_sums(nodes)
    digests = end_digests(members.select("key", "id"))
    up = sums.select(F.col("key").alias("parent"), F.col("least").alias("parent_least"))
    edges = keep(nodes.select("key", "parent", "rep", "plen", "len", "up_total", "children").join(sums, "key").join(up, "parent", "left")
                 .join(digests, "key", "left"), "trie-edges")

    none = sha256_hex(F.lit("").cast("binary"))
    named = lambda c: F.when(c != NO_ID, c)
    every_depth = edges.where("len > 0").withColumn("d", F.explode(F.sequence(F.col("plen") + 1, F.col("len"))))
    every_depth = every_depth.join(known.select(F.col("id").alias("rep"), "d", (F.col("total") - F.col("chars")).alias("above")), ["rep", "d"])
    at_end = F.col("d") == F.col("len")
    # of the subtree: code points by conversation, less code points once
    saved = F.col("ended") - F.col("cnt") * F.col("above") - (F.col("edges") - (F.col("above") - F.col("up_total")))
    below = every_depth.select(
        named(F.col("least")).alias("conv_id"), F.col("d").alias("depth"),
        named(F.when(F.col("d") == F.col("plen") + 1, F.col("parent_least")).otherwise(F.col("least"))).alias("parent_conv_id"),
        F.col("cnt").alias("n_convs"), F.when(at_end, F.col("children")).otherwise(F.lit(1)).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"), saved.alias("saved_tokens"), F.when(at_end, F.coalesce("ends_sha256", none)).otherwise(none).alias("ends_sha256"))
    top = edges.where("len = 0 AND cnt > 0").select(
        named(F.col("least")).alias("conv_id"), zero.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), F.col("cnt").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), (F.col("ended") - F.col("edges")).alias("saved_tokens"),
        F.coalesce("ends_sha256", none).alias("ends_sha256"))
    return below.unionByName(top)


def with_shared_heads(turns: DataFrame, stride: int = 100, most: int = 5) -> tuple[DataFrame, DataFrame]:
    """Turns (id, pos, digest, chars) and members (id) in which conversation c begins with the first h turns of conversation
    ``c - c % stride`` and goes on with its own turns after its first h; ``h = crc32(decimal c) % (most + 1)``.  A null id (``NO_ID``)
    borrows nothing."""
    turns = keep(turns, "turns")
    none = F.col("id") == NO_ID
    ids = turns.select("id").distinct().select(
        "id", F.when(none, F.lit(0)).otherwise(F.crc32(F.col("id").cast("string").cast("binary")) % (most + 1)).cast("long").alias("h"),
        F.when(~none, F.col("id") - F.col("id") % stride).alias("base"))
    heads = keep(turns.where(F.col("pos") <= most), "heads")
    have = heads.groupBy(F.col("id").alias("base")).agg(F.count("*").alias("have"))
    ids = keep(ids.join(have, "base", "left").select("id", "h", "base", F.least("h", F.coalesce("have", F.lit(0))).alias("lent")), "members")
    lent = ids.where("lent > 0").select(F.col("id").alias("to"), F.col("base").alias("id"), "lent").join(heads, "id").where("pos <= lent")
    own = turns.join(ids.select("id", "h", "lent"), "id").where("pos > h")
    rebuilt = (lent.select(F.col("to").alias("id"), "pos", "digest", "chars")
               .unionByName(own.select("id", (F.col("pos") - F.col("h") + F.col("lent")).alias("pos"), "digest", "chars")))
    return rebuilt, ids.select("id")
