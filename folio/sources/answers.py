"""A store of model answers: append-only, keyed by what was asked (SNK3, PRM9).

A question is a model's name, a token budget and a prompt; its key is their SHA-256.  Answers are Parquet rows,
partitioned by the first hex digits of the key.  ``ask`` anti-joins the questions with the store (keys only, sort-merge
where the store is large), calls the model for what is missing, each distinct question once, and appends.

The calls of one ``ask`` are made in ``waves`` by ranges of the key.  Every wave is a job with its own commit, so
that a killed run loses at most one wave: the next run calls only what no wave has stored.

A failed call is a row too, with its message and number of tries.  It is asked again by the next ``ask``, unless
``retry_failed`` is off; an answer always goes before a failure, a failure after more tries before one after fewer.

Defined results: a null prompt is the empty prompt, a null budget is none; equal questions share one answer; a
second answer to a question (two writers at once) changes nothing but which of the two texts is read, always
the lesser one; an empty relation calls nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.operators.prompts import invoke
from folio.sources.sinks import overwrite_partitions

PART_DIGITS = 2
ANSWERS = T.StructType([
    T.StructField("question", T.StringType()), T.StructField("model", T.StringType()), T.StructField("max_tokens", T.LongType()),
    T.StructField("result", T.StringType()), T.StructField("error_message", T.StringType()), T.StructField("tries", T.IntegerType()),
    T.StructField("part", T.StringType())])


def question_key(model: Column, max_tokens: Column, prompt: Column) -> Column:
    """SHA-256 of model, budget and prompt, apart from each other by their lengths."""
    said = [F.coalesce(c.cast("string"), F.lit("")) for c in (model, max_tokens, prompt)]
    return F.sha2(F.concat_ws("\n", F.length(said[0]).cast("string"), F.length(said[1]).cast("string"), *said), 256)


def with_question(prompts: DataFrame, model: str | Column, prompt: str = "prompt", budget: str = "max_tokens") -> DataFrame:
    """``prompts`` with the key ``question``; without a budget column there is no budget."""
    name = F.lit(model) if isinstance(model, str) else model
    tokens = F.col(budget) if budget in prompts.columns else F.lit(None).cast("long")
    return prompts.withColumn("question", question_key(name, tokens.cast("long"), F.col(prompt)))


def best_answers(stored: DataFrame) -> DataFrame:
    """One row per question: an answer if there is one (the lesser text of several), else the failure after the most tries."""
    failed = F.col("error_message").isNotNull()
    rank = F.struct(failed.alias("failed"), F.when(failed, -F.col("tries")).alias("late"), "result", "error_message", "tries")
    best = stored.groupBy("question").agg(F.min(rank).alias("best"), F.sum("tries").cast("int").alias("tries"))
    return best.select("question", F.col("best.result").alias("result"), F.col("best.error_message").alias("error_message"), "tries")


def unanswered(asked: DataFrame, stored: DataFrame, retry_failed: bool = True) -> DataFrame:
    """The distinct questions of ``asked`` (question, ...) that ``stored`` does not answer, one row each."""
    known = stored.where("error_message IS NULL") if retry_failed else stored
    return asked.dropDuplicates(["question"]).join(known.select("question"), "question", "left_anti")


def answered(asked: DataFrame, stored: DataFrame) -> DataFrame:
    """``asked`` (question, ...) with ``llm_result`` (result, errorMessage) as the store has it; null where it has none."""
    best = best_answers(stored).select("question", F.struct("result", F.col("error_message").alias("errorMessage")).alias("llm_result"))
    return asked.join(best, "question", "left").drop("question")


class AnswerStore:
    """Answers under ``path``, a folder that the driver and all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        spark.createDataFrame([], ANSWERS).write.mode("append").partitionBy("part").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(ANSWERS).parquet(self.path)

    def append(self, rows: DataFrame) -> None:
        """Append rows (question, model, max_tokens, result, error_message, tries), one file per part."""
        rows = rows.withColumn("part", F.substring("question", 1, PART_DIGITS))
        (rows.select(*ANSWERS.names).repartition("part").sortWithinPartitions("part", "question")
         .write.mode("append").partitionBy("part").parquet(self.path))

    def ask(self, prompts: DataFrame, predictor: Callable[[str, int], str], keys: list[str], model: str, *,
            prompt_col: str = "prompt", budget_col: str = "max_tokens", waves: int = 1, retry_failed: bool = True,
            **calls) -> DataFrame:
        """``keys`` of every row of ``prompts`` with ``llm_result``, like ``prompts.invoke``; stored questions are not called.

        ``calls`` go to ``invoke`` (partitions, concurrency, tries, delay).  The driver sees one count per wave.
        """
        asked = with_question(prompts, model, prompt_col, budget_col)
        budget = [budget_col] if budget_col in prompts.columns else []
        for wave in range(waves):
            in_wave = F.pmod(F.conv(F.substring("question", 1, 8), 16, 10).cast("long"), F.lit(waves)) == wave
            missing = unanswered(asked.where(in_wave).select("question", prompt_col, *budget), self.read(), retry_failed)
            told = invoke(missing, predictor, ["question", *budget], prompt_col, budget_col, with_tries=True, **calls)
            self.append(told.select("question", F.lit(model).alias("model"),
                                    (F.col(budget_col).cast("long") if budget else F.lit(None).cast("long")).alias("max_tokens"),
                                    F.col("llm_result.result").alias("result"), F.col("llm_result.errorMessage").alias("error_message"), "tries"))
        return answered(asked.select("question", *keys), self.read())

    def compact(self, least_files: int = 8) -> None:
        """Rewrite the parts with ``least_files`` files or more as one file each, one row per question.  For times without a writer."""
        files = (self.read().select("part", F.col("_metadata.file_path").alias("f")).groupBy("part").agg(F.countDistinct("f").alias("n"))
                 .where(F.col("n") >= least_files).select("part"))
        crowded = self.read().join(files, "part", "left_semi")
        head = crowded.groupBy("question").agg(F.first("model").alias("model"), F.first("max_tokens").alias("max_tokens"), F.first("part").alias("part"))
        rows = head.join(best_answers(crowded), "question").select(*ANSWERS.names)
        overwrite_partitions(rows.repartition("part").sortWithinPartitions("part", "question"), self.path, "part")
