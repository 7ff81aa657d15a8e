"""Chat formatting by event-sourced reconstruction (DataFrame operations only).

A log holds events ``(conv_id, turn, seq, kind, role, text)``:

* ``message``: opens a message with its role and text;
* ``delta``: appends text to the open message of the turn (opens one if there is none);
* ``edit``: replaces the text of the open message;
* ``regenerate``: empties the open message; the deltas that follow rebuild it.

``fold`` partitions the log by conversation and turn, sorts by sequence and folds the events
to final messages.  ``render`` turns messages to blocks of marked text with the spans that
a loss may cover.  ``conversations`` joins a conversation's blocks to one text.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per message.  Inside roles and texts every
``<``, any number of backslashes, ``|`` gets one more backslash; in roles a line end becomes
``<|n|>``.  So no text holds ``<|``, the marks split the output without doubt, and taking one
backslash away restores the text.

A turn's events and a block of 64 turns are what a task holds at once; a conversation with
a third of all rows is many turns and blocks.  Only the final text of one conversation is a
single value, as a conversation's formatted text is.

Defined results: a null text or role is empty; null turns come last, null sequences last in
their turn; events with equal conversation, turn and sequence are ordered by kind (message
first), role and text; repeated ``message`` events are messages each; a null conv_id is a
conversation of its own; an empty log gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
TURNS_PER_BLOCK = 64
LOSS_ROLE = "assistant"
_KINDS = ("message", "regenerate", "edit", "delta")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def as_events(rows: DataFrame) -> DataFrame:
    """Rows that each hold one whole message, as a log: one ``message`` event per row."""
    return rows.select("conv_id", "turn", F.lit(0).cast("long").alias("seq"), F.lit("message").alias("kind"), "role", "text")


def fold(events: DataFrame) -> DataFrame:
    """Final messages ``(conv_id, turn, part, role, text)``; ``part`` numbers the messages of a turn."""
    known = events.where(F.col("kind").isin(*_KINDS)).select(
        "conv_id", "turn", F.col("seq").isNull().alias("late"), "seq",
        F.array_position(F.array(*[F.lit(k) for k in _KINDS]), F.col("kind")).alias("rank"), "kind",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = ["late", "seq", "rank", "role", "text"]
    past = Window.partitionBy("conv_id", "turn").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    opened = known.withColumn("part", F.sum((F.col("kind") == "message").cast("int")).over(past)) \
                  .withColumn("reset", F.sum((F.col("kind") != "delta").cast("int")).over(past))
    piece = F.struct(*order, "reset")
    whole = opened.groupBy("conv_id", "turn", "part").agg(
        F.array_sort(F.collect_list(piece)).alias("pieces"), F.max("reset").alias("last"))
    final = F.filter("pieces", lambda e: e["reset"] == F.col("last"))
    return whole.select("conv_id", "turn", "part", F.element_at("pieces", 1)["role"].alias("role"),
                        F.array_join(F.transform(final, lambda e: e["text"]), "").alias("text"))


def render(messages: DataFrame, turns_per_block: int = TURNS_PER_BLOCK, loss_role: str = LOSS_ROLE) -> DataFrame:
    """Blocks ``(conv_id, block, n_turns, formatted, char_start, loss_spans)``.

    ``loss_spans``: half-open code point spans of the conversation's formatted text that hold the
    (escaped) texts of ``loss_role``; ``char_start``: where the block starts in that text.
    """
    head = F.concat(F.lit(START), F.regexp_replace(escape(F.col("role")), "\n", "<|n|>"), F.lit("\n"))
    body = escape(F.col("text"))
    part = messages.select(
        "conv_id", F.floor(F.col("turn") / turns_per_block).alias("block"), "turn", "part",
        head.alias("head"), body.alias("body"), (F.col("role") == loss_role).alias("loss"))
    item = F.struct(F.col("turn"), F.col("part"), "head", "body", "loss")
    blocks = part.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list(item)).alias("items"))
    piece = lambda x: F.concat(x["head"], x["body"], F.lit(END + "\n"))
    tail = len(END) + 1
    walk = F.aggregate(
        "items", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans")),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["head"]) + F.length(x["body"]) + tail).cast("long").alias("at"),
            F.when(x["loss"], F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + F.length(x["head"])).cast("long").alias("start"),
                (acc["at"] + F.length(x["head"]) + F.length(x["body"])).cast("long").alias("end")))))
            .otherwise(acc["spans"]).alias("spans")))
    local = blocks.select("conv_id", "block", F.size("items").cast("long").alias("n_turns"),
                          F.array_join(F.transform("items", piece), "").alias("formatted"), walk.alias("walk"))
    before = Window.partitionBy("conv_id").orderBy(F.col("block").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("walk.at").over(before), F.lit(0)).cast("long")
    return (local.withColumn("char_start", start)
            .select("conv_id", "block", "n_turns", "formatted", "char_start",
                    F.transform("walk.spans", lambda s: F.struct(
                        (s["start"] + F.col("char_start")).alias("start"), (s["end"] + F.col("char_start")).alias("end"))).alias("loss_spans")))


def conversations(blocks: DataFrame) -> DataFrame:
    """One formatted text and list of loss spans per conversation."""
    item = F.struct("char_start", "formatted", "loss_spans")
    return (blocks.groupBy("conv_id").agg(F.array_sort(F.collect_list(item)).alias("b"), F.sum("n_turns").alias("n_turns"))
            .select("conv_id", "n_turns", F.array_join(F.transform("b", lambda x: x["formatted"]), "").alias("formatted"),
                    F.flatten(F.transform("b", lambda x: x["loss_spans"])).alias("loss_spans")))


def read_back(blocks: DataFrame) -> DataFrame:
    """Parse the formatted output: per block the turns (role, text) and the texts under the loss spans."""
    pieces = F.filter(F.split("formatted", r"<\|im_end\|>\n"), lambda p: p != "")
    bare = F.transform(pieces, lambda p: F.substring(p, F.lit(len(START) + 1), F.length(p)))
    cut = lambda p: F.instr(p, "\n")
    turns = F.transform(bare, lambda p: F.struct(
        unescape(F.regexp_replace(F.substring(p, F.lit(1), cut(p) - 1), r"<\|n\|>", "\n")).alias("role"),
        unescape(F.substring(p, cut(p) + 1, F.length(p))).alias("text")))
    under = F.transform("loss_spans", lambda s: unescape(F.substring(
        F.col("formatted"), (s["start"] - F.col("char_start") + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return blocks.select("conv_id", "block", "char_start", F.length("formatted").cast("long").alias("formatted_chars"),
                         turns.alias("turns"), under.alias("loss_texts"))
