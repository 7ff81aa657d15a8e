"""Assembly with few shuffles, streamed prompts and counts kept up, against plain Python."""

import random
import re

from pyspark.sql import functions as F

from folio.functions.common import KEYS
from folio.operators import boundaries as BD
from folio.operators import evaluation as EV
from folio.operators import prompts as PR
from folio.operators import sampling as SM
from folio.operators import standing as SC
from folio.operators import state as ST
from folio.operators import views as V
from folio.plans import fixtures as fx


def stored(df, tmp_path, name):
    path = str(tmp_path / name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def shuffles(df):
    return len(re.findall(r"Exchange (?:hash|range)partitioning", df._jdf.queryExecution().executedPlan().toString()))


def test_split_results_are_assembled_with_one_shuffle(spark, tmp_path):
    rng = random.Random(3)
    names = [f"{k}_F" for k in range(60)]
    resolved = [(n, [1, k % 7 + 2], rng.choice(["primary", "ultimate_fallback"])) for k, n in enumerate(names[:50])] + [(None, [1], "primary")]
    corrected = [(n, [1, 3] if k % 3 else None, "timeout" if k % 5 == 0 else None) for k, n in enumerate(names[:30])]
    responses = [(n, flag, f"m{k % 3}") for k, n in enumerate(names) for flag in rng.sample([True, False, None], rng.randrange(4))]
    pages = [(n, str(k % 4), k % 9 + 1) for k, n in enumerate(names[5:]) for _ in range(3)] + [(None, "0", 1)]
    r, c, p, g = (stored(spark.createDataFrame(rows, schema), tmp_path, name) for name, rows, schema in (
        ("r", resolved, "filename string, parsed_starts array<int>, boundary_source string"),
        ("c", corrected, "filename string, corrected_starts array<int>, verify_error string"),
        ("p", responses, "filename string, is_fallback boolean, model_used string"),
        ("g", pages, "filename string, folder_id string, total_pages int")))
    out = BD.split_results(r, c, p, g, "run", "202401")
    assert shuffles(out) == 1
    fixed, size = {n: (s, e) for n, s, e in corrected}, {n: (f, t) for n, f, t in pages}
    want = {}
    for n, starts, origin in resolved:
        if n is None or n not in size:
            continue
        told = [(flag, m) for x, flag, m in responses if x == n]
        used = any(flag for flag, _ in told) if told else None
        models = [m for flag, m in told if (flag if used else flag is False)]
        s, e = fixed.get(n, (None, None))
        want[n] = (*size[n], s if s and e is None else starts, used, max(models, default=None), origin == "ultimate_fallback")
    got = {x["filename"]: (x["folder_id"], x["total_pages"], x["predicted_starts"], x["fallback_used"], x["model_used"], x["needs_review"])
           for x in out.collect()}
    assert got == want and len(got) == 45


def test_batch_list_and_gate_meet_with_two_shuffles(spark, tmp_path):
    status = stored(spark.createDataFrame([("1", "awaiting_annotation", True, 5), ("2", "predicted", False, 2)],
                                          "day_id string, lifecycle string, has_errors boolean, n_files long"), tmp_path, "s")
    listing = stored(spark.createDataFrame([("inbox", "1"), ("inbox", "1"), ("validation", "1"), ("validation", "3"), ("inbox", "4"),
                                            ("archive", "5")], "volume string, day_id string"), tmp_path, "m")
    gate = stored(spark.createDataFrame([("1", True), ("6", True)], "day_id string, complete boolean"), tmp_path, "g")
    out = EV.batch_list(status, listing, gate)
    assert shuffles(out) <= 2
    assert sorted(map(tuple, out.collect())) == [("1", "annotated", True, 5, 2), ("2", "predicted", False, 2, 0),
                                                 ("3", "uploaded", False, 0, 0), ("4", "uploaded", False, 0, 1)]
    sample = stored(spark.createDataFrame([("1", "a"), ("1", "a"), ("1", "b"), ("2", "c"), ("2", None)], "day_id string, filename string"), tmp_path, "x")
    truth = stored(spark.createDataFrame([("1", "a"), ("1", "a"), ("2", "c"), ("2", None), ("3", "d")], "day_id string, filename string"), tmp_path, "t")
    state = EV.gate_state(sample, truth)
    assert shuffles(state) <= 2
    assert sorted(map(tuple, state.collect())) == [("1", 3, 2, 1, False), ("2", 2, 1, 1, False)]


def test_sample_reads_files_once(spark, tmp_path):
    files = [(str(k % 3), f"f{k % 700}") for k in range(2000)]
    out = SM.annotation_sample(stored(spark.createDataFrame(files, "day_id string, filename string"), tmp_path, "f"), 10)
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and final.count("FileScan") == 1
    assert len(re.findall(r"(?<!Reused)Exchange (?:hash|range)partitioning", final)) <= 4


def test_streamed_prompts_hold_one_batch_at_a_time(spark):
    """A package of 60 MB, small ones beside it, a predictor that stops early and one that fails."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    try:
        pages = spark.range(40_000).select(
            F.when(F.col("id") < 39_000, F.lit("big")).otherwise(F.concat(F.lit("f"), (F.col("id") % 50).cast("string"))).alias("filename"),
            F.col("id").cast("int").alias("position"), F.rpad(F.col("id").cast("string"), 1500, "x").alias("text"))
        heads = spark.createDataFrame([("big", -1, "["), ("f3", -1, None)], "filename string, position int, text string")

        def read(pieces, budget):
            import resource
            n, first, start = 0, None, 0
            for k, piece in enumerate(pieces):
                if k == 2000:
                    start = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
                first = piece if first is None else first
                n += len(piece)
                if n > 20_000 and budget is None and "f7" in piece:
                    break
            grown = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - start if start else 0
            return f"{n} {first} {grown}"

        got = {r["filename"]: r["llm_result"]["result"].split(" ") for r in
               PR.invoke_stream(pages.unionByName(heads), read, ["filename"], head="HEAD", tail="TAIL").collect()}
        assert len(got) == 51 and all(v[1] == "HEAD" for v in got.values())
        assert int(got["big"][0]) == 39_000 * 1501 - 1 + len("HEAD[TAIL") and int(got["f3"][0]) == 20 * 1501 - 1 + 8
        assert int(got["big"][2]) < 20_000  # KB beyond what it held after 3 MB

        def short(pieces, budget):
            if next(pieces) != "":
                raise ValueError("head")
            text = next(pieces)
            if text.startswith("39003"):
                raise TimeoutError("late")
            return text[:5]

        out = {r["filename"]: r["llm_result"] for r in PR.invoke_stream(pages, short, ["filename"]).collect()}
        assert len(out) == 51 and out["big"]["result"] == "0xxxx" and out["f4"]["result"] == "39004"
        assert out["f3"]["result"] is None and out["f3"]["errorMessage"] == "TimeoutError: late"
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_counts_kept_up_equal_counts_made_anew(spark, sf_small):
    rng = random.Random(5)
    log = stored_rows(spark, fx.fx_log(spark, sf_small), 400)
    split = stored_rows(spark, fx.fx_split(spark, sf_small), 200)
    counts = V.funnel(V.file_status(log, split))
    files = sorted({(r["day_id"], r["filename"]) for r in log.collect()})
    for step in range(3):
        some = spark.createDataFrame(rng.sample(files, 40) + [("999999", "nobody")], "day_id string, filename string")
        status = rng.choice(["error", "done", "parsed"])
        after = ST.guarded_update(log, some, {"status": F.lit(status), "sftp_delivery_status": F.lit(rng.choice(["failed", "delivered"]))},
                                  guard=F.col("log_seq") % 3 != step).drop("updated")
        if step == 1:  # rows may come and go as well
            gone = files[:5]
            after = after.where(~F.col("filename").isin(*[f for _, f in gone]))
            some = some.unionByName(log.where(F.col("filename").isin(*[f for _, f in gone])).select(*KEYS))
        after = stored_rows(spark, after)
        delta = SC.funnel_delta(SC.status_of(log, split, some), SC.status_of(after, split, some))
        counts = stored_rows(spark, SC.merged(counts, delta))
        fresh = V.funnel(V.file_status(after, split))
        cols = sorted(fresh.columns)
        assert sorted(map(tuple, counts.select(cols).collect())) == sorted(map(tuple, fresh.select(cols).collect()))
        log = after


def stored_rows(spark, df, n=None):
    """The first rows of a small table as a relation of its own."""
    return spark.createDataFrame((df.orderBy(*df.columns).limit(n) if n else df).collect(), df.schema)
