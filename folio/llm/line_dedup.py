"""Line dedup across documents by ranges of line hashes, with keep bitmaps as the result.

A line's key is the line without white space ``[\\x20\\x09-\\x0D]`` at its ends, A-Z lower-cased.  Keys of at least
``least_chars`` code points that ``least_docs`` documents or more hold lose their lines everywhere
but in the first document that holds them; first is the largest id.

1. Every document hands out one row per distinct long key: a 128-bit hash of the key, the document and the
   key's positions in it.  Texts are not among them.
2. The rows are range-partitioned and sorted by hash, then by document (largest first).  The range takes
   in the document, so that a line which a third of all documents hold is dealt over many tasks.
3. A task streams its rows: the first document of a hash keeps its lines, later ones lose theirs.  Only
   the first and the last hash of a task can go on in another one.  Their rows are told apart, with one summary
   row each (at most ``least_docs`` documents), and are decided by a second small join.
4. Positions come back to one row per document as a bitmap of the lines that stay, packed and deflated.

``apply`` joins the bitmaps with the texts.  Documents that lose nothing are not shuffled.

Defined results: a null or empty text is one empty line; rows that share an id are one document where
documents are counted, each with its own bitmap; null ids are one document, the least one; repeated
rows get equal results; an empty table gives no rows; extra columns are ignored, whatever their names.  A key
shorter than ``least_chars`` never loses a line.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.common import keep, mark_perhaps, sha256_hex, ship, text_hash

ENDS = b" \t\n\x0b\x0c\r"
ROW_BITS = 1 << 25
#: Rows that a task remembers, so that a row repeated many times hands out its lines about once per task.
REMEMBERED = 100_000
#: Stands for a null id: the least one.
NO_ID = -(1 << 63)

_KEYED = "h1 long, h2 long, id long, text_hash long, n_lines int, at array<int>"
_JUDGED = "kind string, h1 long, h2 long, id long, text_hash long, n_lines int, at array<int>, docs array<long>"


def _named_rows(docs: DataFrame) -> DataFrame:
    """(id, text_hash, body): an id and a text name a row; ``body`` is the text as bytes."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), text_hash().alias("text_hash"),
                       F.coalesce("text", F.lit("")).cast("binary").alias("body"))


def _row() -> Column:
    return F.xxhash64("id", "text_hash")


def line_keys(body: bytes, least_chars: int) -> dict[bytes, list[int]]:
    """Positions of every key of at least ``least_chars`` code points."""
    found: dict[bytes, list[int]] = {}
    for i, line in enumerate(body.split(b"\n")):
        key = line.strip(ENDS)
        # bytes 0x80 to 0xBF go on with a code point that has begun
        if len(key) >= least_chars and (key.isascii() or len(key.decode("utf-8", "replace")) >= least_chars):
            found.setdefault(key.lower(), []).append(i)  # bytes: A-Z only
    return found


def keyed_lines(docs: DataFrame, least_chars: int) -> DataFrame:
    """(h1, h2, id, text_hash, n_lines, at): one row per document and distinct long key."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[tuple] = set()
        for part in parts:
            out: list[tuple] = []
            for name, body in zip(zip(part["id"].tolist(), part["text_hash"].tolist()), part["body"]):
                if name in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(name)
                n = body.count(b"\n") + 1
                for key, at in line_keys(body, least_chars).items():
                    h = xxhash.xxh3_128_intdigest(key)
                    out.append(((h >> 64) - (1 << 63), (h & (1 << 64) - 1) - (1 << 63), *name, n, at))
            yield pd.DataFrame(out, columns=["h1", "h2", "id", "text_hash", "n_lines", "at"])

    return _named_rows(docs).mapInPandas(run, _KEYED)


def _judge(least_docs: int):
    """Streams sorted rows.  Kinds of rows out: ``drop`` (loses its lines), ``open`` (its hash may go on in
    another task) and ``end`` (an open hash's documents here, ``least_docs`` at most)."""

    def settle(part: pd.DataFrame, is_open: bool) -> list[pd.DataFrame]:
        """The rows of whole hashes: what they lose; or the rows of one open hash and its summary."""
        if not len(part):
            return []
        h1, h2 = part["h1"].to_numpy(), part["h2"].to_numpy()
        doc = part["id"].to_numpy()
        new_hash = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
        new_doc = np.concatenate([[True], doc[1:] != doc[:-1]]) | new_hash
        if is_open:
            docs = doc[new_doc][:least_docs]
            end = part.iloc[:1].assign(kind="end", n_lines=0, at=[[]], docs=[docs])
            return [part.assign(kind="open", docs=None), end]
        group = np.cumsum(new_hash) - 1
        rank = np.cumsum(new_doc)
        rank -= rank[new_hash][group] - 1  # of the row's document within its hash
        total = np.maximum.reduceat(rank, np.flatnonzero(new_hash))[group]
        lost = part[(total >= least_docs) & (rank > 1)]
        return [lost.assign(kind="drop", docs=None)] if len(lost) else []

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, held = True, []  # held: the rows of the last hash so far

        def flush(done: list[pd.DataFrame], is_open: bool) -> Iterator[pd.DataFrame]:
            whole = pd.concat(done, ignore_index=True) if len(done) > 1 else done[0]
            for out in settle(whole, is_open):
                yield out[["kind", "h1", "h2", "id", "text_hash", "n_lines", "at", "docs"]]

        for part in parts:
            if not len(part):
                continue
            h1, h2 = part["h1"].to_numpy(), part["h2"].to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]))
            if held and (held[0]["h1"].iloc[0], held[0]["h2"].iloc[0]) != (h1[0], h2[0]):
                yield from flush(held, first)
                first, held = False, []
            if len(starts) == 1:
                held.append(part)
                continue
            if first:
                yield from flush([*held, part.iloc[:starts[1]]], True)
                first, held, part = False, [], part.iloc[starts[1]:]
                starts = starts[1:] - starts[1]
            last = starts[-1]
            if held or last:
                yield from flush([*held, part.iloc[:last]], False)
            held = [part.iloc[last:]]
        if held:
            yield from flush(held, True)

    return run


def lost_lines(docs: DataFrame, least_docs: int = 3, least_chars: int = 20) -> DataFrame:
    """(id, text_hash, n_lines, at): positions of lines that a document loses; several rows per document."""
    ship(docs.sparkSession)
    order = [F.col("h1").asc(), F.col("h2").asc(), F.col("id").desc(), F.col("text_hash").asc()]
    # written first: the borders of ranges are found by a pass of its own
    ranged = keep(keyed_lines(docs, least_chars), "line-keys").repartitionByRange(*order).sortWithinPartitions(*order)
    judged = keep(ranged.mapInPandas(_judge(least_docs), _JUDGED), "lines-judged")
    # a row of at most least_docs ids per task and end: twice as many rows as there are tasks, so they may be broadcast
    documents = F.array_distinct(F.flatten(F.collect_list("docs")))
    ends = (judged.where("kind = 'end'").groupBy("h1", "h2").agg(documents.alias("docs"))
            .where(F.size("docs") >= least_docs).select("h1", "h2", F.array_max("docs").alias("first_id")))
    opened = judged.where("kind = 'open'").join(F.broadcast(ends), ["h1", "h2"]).where("id != first_id")
    columns = ["id", "text_hash", "n_lines", "at"]
    return judged.where("kind = 'drop'").select(*columns).unionByName(opened.select(*columns))


def pack(n_lines: int, lost: np.ndarray) -> bytes:
    """A bitmap of the lines that stay, deflated."""
    stays = np.ones(n_lines, dtype=np.uint8)
    stays[lost] = 0
    return zlib.compress(np.packbits(stays).tobytes(), 6)


def unpack(n_lines: int, bitmap: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), dtype=np.uint8), count=n_lines).astype(bool)


def keep_bitmaps(docs: DataFrame, least_docs: int = 3, least_chars: int = 20) -> DataFrame:
    """(id, text_hash, n_lines, n_dropped, bitmap) of the documents that lose lines; ``id``: ``NO_ID`` for null."""
    at = F.flatten(F.collect_set("at"))  # rows of different keys hold different positions
    lost = lost_lines(docs, least_docs, least_chars).groupBy("id", "text_hash").agg(F.max("n_lines").alias("n_lines"), at.alias("at"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame({
                "id": part["id"], "text_hash": part["text_hash"], "n_lines": part["n_lines"].astype("int64"),
                "n_dropped": [len(a) for a in part["at"]],
                "bitmap": [pack(n, np.asarray(a, dtype=np.int64)) for n, a in zip(part["n_lines"], part["at"])]})

    return lost.mapInPandas(run, "id long, text_hash long, n_lines long, n_dropped long, bitmap binary")


def kept_text(body: Column, bitmap: Column) -> Column:
    """The lines of ``body`` (binary) that ``bitmap`` keeps, joined by line ends (binary)."""

    @F.pandas_udf("binary")
    def cut(bodies: pd.Series, bitmaps: pd.Series) -> pd.Series:
        out = []
        for body, bits in zip(bodies, bitmaps):
            lines = body.split(b"\n")
            stays = unpack(len(lines), bits)
            out.append(b"\n".join([line for line, s in zip(lines, stays.tolist()) if s]))
        return pd.Series(out, dtype=object)

    return cut(body, bitmap)


def apply(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_lines, n_dropped, kept) for every row of ``docs``; ``kept`` is binary.

    A bitmap of fixed size of the documents that lose lines is broadcast; what it lets go is
    finished where it is read.
    """
    ship(docs.sparkSession)
    bitmaps = keep(bitmaps, "line-bitmaps")
    rows = mark_perhaps(_named_rows(docs), _row(), bitmaps, _row(), ROW_BITS, "perhaps")
    met = rows.where("perhaps").join(bitmaps, ["id", "text_hash"], "left")
    text = F.col("body").cast("string")
    n_lines = (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long")

    def out(df: DataFrame, lines: Column, dropped: Column, kept: Column) -> DataFrame:
        doc_id = F.when(F.col("id") != NO_ID, F.col("id"))
        return df.select(doc_id.alias("doc_id"), "text_hash", lines.alias("n_lines"), dropped.alias("n_dropped"), kept.alias("kept"))

    none = F.lit(0).cast("long")
    return (out(rows.where("NOT perhaps"), n_lines, none, F.col("body"))
            .unionByName(out(met.where("bitmap IS NULL"), n_lines, none, F.col("body")))
            .unionByName(out(met.where("bitmap IS NOT NULL"), F.col("n_lines"), F.col("n_dropped"), kept_text(F.col("body"), F.col("bitmap")))))


def dedup(docs: DataFrame, least_docs: int = 3, least_chars: int = 20) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) for every row of ``docs``."""
    done = apply(docs, keep_bitmaps(docs, least_docs, least_chars))
    return done.select("doc_id", "n_lines", "n_dropped", sha256_hex(F.col("kept")).alias("kept_sha256"))
