"""Sources and sinks on scratch folders."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from folio.operators import evaluation as EV
from folio.sources import files as SRC
from folio.sources import sinks as SNK
from folio.streaming.intake import start_intake


def _touch(path, size=3):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(b"x" * size)


def test_manifest_and_scan(spark):
    root = tempfile.mkdtemp(prefix="folio-vol-")
    _touch(f"{root}/inbox/202401/A1_one.pdf", 5)
    _touch(f"{root}/inbox/202401/B2_two.PDF", 7)
    _touch(f"{root}/ground_truth/202401/A1_one.json")
    m = SRC.manifest(spark, root)
    got = sorted((r["volume"], r["day_id"], r["filename"], r["ext"], r["size"]) for r in m.collect())
    assert got == [("ground_truth", "202401", "A1_one", "json", 3), ("inbox", "202401", "A1_one", "pdf", 5),
                   ("inbox", "202401", "B2_two", "pdf", 7)]
    assert sorted(r["filename"] for r in SRC.pdf_stems(m, "inbox").collect()) == ["A1_one", "B2_two"]
    assert SRC.manifest(spark, f"{root}/missing").count() == 0
    scanned = {r["filename"]: (r["folder_id"], r["length"]) for r in SRC.scan_files(spark, f"{root}/inbox").collect()}
    assert scanned == {"A1_one": ("A1", 5)}


def test_ground_truth_roundtrip(spark):
    root = tempfile.mkdtemp(prefix="folio-gt-")
    df = spark.createDataFrame([("A1_one", "A1", "202401", 9, [3, 0, 12, 5], "ann")],
                               "filename string, folder_id string, day_id string, total_pages int, "
                               "gt_starts array<int>, annotator string")
    gt = EV.build_ground_truth(df).withColumn("annotated_at", F.lit("2024-01-01T00:00:00+00:00"))
    SNK.write_ground_truth(gt, root)
    back = SRC.read_ground_truth(spark, root).first()
    assert back["predicted_starts"] == [1, 3, 5] and back["n_documents"] == 3 and back["is_multidoc"]
    assert [(d["start"], d["end"]) for d in back["documents"]] == [(1, 2), (3, 4), (5, 9)]
    assert back["file_stem"].startswith("part-")


def test_cut_lineage_reads_back_same_rows(spark):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    a = SNK.cut_lineage(df, "unit-test")
    b = SNK.cut_lineage(df)
    assert sorted(a.collect()) == sorted(df.collect()) == sorted(b.collect())


def test_streaming_intake_registers_each_file_once(spark):
    root = tempfile.mkdtemp(prefix="folio-stream-")
    _touch(f"{root}/inbox/202402/A1_a.pdf")
    _touch(f"{root}/inbox/202402/B2_b.pdf")
    log, parsed, ck = f"{root}/log", f"{root}/parsed", f"{root}/ck"
    start_intake(spark, f"{root}/inbox", log, parsed, ck, "r1").awaitTermination(120)
    _touch(f"{root}/inbox/202402/C3_c.pdf")
    start_intake(spark, f"{root}/inbox", log, parsed, ck, "r2").awaitTermination(120)
    from folio.schemas import PROCESSING_LOG
    rows = spark.read.schema(PROCESSING_LOG).parquet(log).select("day_id", "filename", "status").collect()
    assert sorted((r["day_id"], r["filename"], r["status"]) for r in rows) == [
        ("202402", "A1_a", "pending"), ("202402", "B2_b", "pending"), ("202402", "C3_c", "pending")]


def test_append_and_batch_prunes_partitions(spark, sf_small):
    from folio.plans import fixtures as fx
    from folio.schemas import PROCESSING_LOG
    root = tempfile.mkdtemp(prefix="folio-log-")
    log = fx.fx_log(spark, sf_small)
    SNK.append(log, root, PROCESSING_LOG)
    table = spark.read.schema(PROCESSING_LOG).parquet(root)
    one = SRC.batch(table, "199601")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day_id" in plan and "199601" in plan
    assert one.count() == log.where(F.col("day_id") == "199601").count()


def test_overwrite_partitions_replaces_only_touched_batches(spark):
    from folio.schemas import PROCESSING_LOG, conform
    root = tempfile.mkdtemp(prefix="folio-ow-")
    rows = spark.createDataFrame([("a", "d1", "pending"), ("b", "d2", "pending")], "filename string, day_id string, status string")
    SNK.overwrite_partitions(conform(rows, PROCESSING_LOG), root)
    upd = spark.createDataFrame([("a", "d1", "done")], "filename string, day_id string, status string")
    SNK.overwrite_partitions(conform(upd, PROCESSING_LOG), root)
    SNK.overwrite_partitions(conform(upd, PROCESSING_LOG), root)
    got = sorted((r["filename"], r["status"]) for r in spark.read.schema(PROCESSING_LOG).parquet(root).collect())
    assert got == [("a", "done"), ("b", "pending")]


def test_events_run_row_and_null_pages(spark, sf_small):
    from folio.operators import intake as IN
    from folio.plans import fixtures as fx
    root = tempfile.mkdtemp(prefix="folio-ev-")
    parsed = spark.createDataFrame([("d1", "A1_x", None), ("d1", "B2_y", 3)], "day_id string, filename string, n_pages int")
    ev = IN.flag_null_pages(parsed, F.lit("2024-01-01 00:00:00").cast("timestamp"), "r1")
    assert [r["filename"] for r in ev.collect()] == ["A1_x"] and ev.first()["event_type"] == "needs_review"
    assert SNK.append_events(ev, root) and spark.read.parquet(root).count() == 1
    assert SNK.append_events(ev.drop("event_id").withColumnRenamed("stage", "x"), "/proc/not-writable") is False
    out = IN.run_outcome(fx.fx_log(spark, sf_small).where(F.col("day_id") == "199601"))
    row = SNK.run_row(out, "r1", F.lit("2024-01-01 00:00:00").cast("timestamp"),
                      F.lit("2024-01-01 00:30:00").cast("timestamp"), F.col("total")).first()
    assert row["duration_min"] == 30.0 and row["notes"] == "day_id=199601" and row["status"] in (
        "success", "partial_failure", "failed")


def test_bucketed_state_tables_join_without_shuffle(spark, sf_small):
    from folio.operators import views as V
    from folio.plans import fixtures as fx
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # show the planned join, not a broadcast
    try:
        import uuid
        tag = uuid.uuid4().hex[:8]
        SNK.save_state_table(fx.fx_log(spark, sf_small), f"t_log_{tag}", 8)
        SNK.save_state_table(fx.fx_split(spark, sf_small), f"t_split_{tag}", 8)
        st = V.file_status(spark.table(f"t_log_{tag}"), spark.table(f"t_split_{tag}"))
        plan = st._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        ref = V.file_status(fx.fx_log(spark, sf_small), fx.fx_split(spark, sf_small))
        cols = ["day_id", "filename", "status", "log_seq", "split_seq"]
        assert sorted(map(tuple, st.select(*cols).collect())) == sorted(map(tuple, ref.select(*cols).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))


def test_rewrite_batches_touches_only_the_targets_partitions(spark, tmp_path):
    import os
    from folio.operators import state as ST
    from folio.sources.sinks import rewrite_batches
    path = str(tmp_path / "log")
    rows = [("202401", "a", "error", 0), ("202401", "b", "done", 0), ("202402", "c", "error", 0)]
    log = spark.createDataFrame(rows, "day_id string, filename string, status string, retry_count int") \
        .withColumns({c: F.lit(None).cast("string") for c in ("error_message", "error_stage")})
    log.write.partitionBy("day_id").parquet(path)
    files = lambda day: sorted(os.listdir(f"{path}/day_id={day}"))
    before = files("202402")
    target = spark.createDataFrame([("202401", "a")], "day_id string, filename string")
    rewrite_batches(path, target, lambda t: ST.retry_parse(t, target))
    got = {r["filename"]: (r["status"], r["retry_count"]) for r in spark.read.parquet(path).collect()}
    assert got == {"a": ("pending", 1), "b": ("done", 0), "c": ("error", 0)} and files("202402") == before
