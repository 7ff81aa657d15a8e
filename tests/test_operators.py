"""Operator properties checked against brute force on small inputs."""


from pyspark.sql import Window
from pyspark.sql import functions as F

from folio.functions.common import KEYS
from folio.operators import intake as IN
from folio.operators import prompts as PR
from folio.operators import sampling as SM
from folio.operators import segments as SE
from folio.operators import signals as SG
from folio.operators import state as ST
from folio.operators import views as V
from folio.plans import fixtures as fx


def loop_chunks(total, size=50, overlap=3):
    out, start, idx = [], 1, 0
    while start <= total:
        end = min(start + size - 1, total)
        out.append((idx, start, end))
        idx += 1
        if end >= total:
            break
        start = end + 1 - overlap
    return out


def test_chunk_plan_matches_loop(spark):
    pkg = spark.range(51, 1200).select(F.col("id").cast("string").alias("filename"),
                                       F.col("id").cast("int").alias("total_pages"))
    got = {}
    for r in PR.chunk_plan(pkg).collect():
        got.setdefault(int(r["filename"]), []).append((r["chunk_idx"], r["chunk_start"], r["chunk_end"]))
    for t in range(51, 1200):
        assert sorted(got[t]) == loop_chunks(t), t


def test_page_chunks_cover_exactly_the_chunk_ranges(spark):
    pages = (spark.range(51, 260).select(F.col("id").cast("string").alias("filename"),
                                         F.col("id").cast("int").alias("total_pages"))
             .select("*", F.explode(F.sequence(F.lit(1), F.col("total_pages"))).alias("page_num")))
    got = {(r["filename"], r["chunk_idx"], r["page_num"]) for r in PR.page_chunks(pages).collect()}
    want = {(str(t), i, p) for t in range(51, 260) for i, s, e in loop_chunks(t) for p in range(s, e + 1)}
    assert got == want


def test_ordered_text_equals_single_sort(spark):
    df = spark.range(0, 700).select((F.col("id") % 3).cast("string").alias("k"),
                                    (F.col("id") * 7 % 700).cast("int").alias("pos"),
                                    F.col("id").cast("string").alias("t"))
    got = {r["k"]: r["txt"] for r in SG.ordered_text(df, ["k"], "pos", "t", "txt").collect()}
    rows = sorted(df.collect(), key=lambda r: (r["k"], r["pos"], r["t"]))  # ties: by text, as sort_array does
    for k in "012":
        assert got[k] == "\n".join(r["t"] for r in rows if r["k"] == k)


def test_annotation_sample_is_exact_top_k_and_stable(spark, sf_small):
    split = fx.fx_split(spark, sf_small)
    for pct in (10, 37.5, 100):
        got = {(r["day_id"], r["filename"]) for r in SM.annotation_sample(split, pct).collect()}
        again = {(r["day_id"], r["filename"]) for r in SM.annotation_sample(split, pct).collect()}
        assert got == again
        files = split.select(*KEYS).distinct().withColumn("h", SM.sample_key(F.col("day_id"), F.col("filename")))
        n = files.groupBy("day_id").count().withColumnRenamed("count", "n")
        w = Window.partitionBy("day_id").orderBy("h", "filename")
        ranked = files.join(n, "day_id").withColumn("rn", F.row_number().over(w))
        from fractions import Fraction
        want = set()
        for r in ranked.collect():
            x = Fraction(r["n"]) * Fraction(str(pct)) / 100
            k = max(1, round(x))
            if r["rn"] <= k:
                want.add((r["day_id"], r["filename"]))
        assert got == want


def test_segments_partition_the_pages(spark):
    cand = spark.createDataFrame([("d", "a", 10, [1, 4, 9]), ("d", "b", 1, [1]), ("d", "c", 6, [1, 2, 3, 4, 5, 6])],
                                 "day_id string, filename string, total_pages int, predicted_starts array<int>")
    for r in cand.collect():
        segs = sorted((s["from_page"], s["to_page"]) for s in SE.segments(cand).where(
            F.col("filename") == r["filename"]).collect())
        pages = [p for a, b in segs for p in range(a, b + 1)]
        assert pages == list(range(r["total_pages"]))


def test_segments_ground_truth_wins_and_is_clipped(spark):
    cand = spark.createDataFrame([("d", "a", 8, [1, 5])], "day_id string, filename string, total_pages int, "
                                                          "predicted_starts array<int>")
    gt = spark.createDataFrame([("d", "a", [(1, 3, None), (4, 12, None), (9, 12, None)])],
                               "day_id string, filename string, documents array<struct<start:int,end:int,type:string>>")
    s = sorted((r["doc_index"], r["from_page"], r["to_page"], r["split_source"], r["out_name"])
               for r in SE.segments(cand, gt).collect())
    assert s == [(1, 0, 2, "ground_truth", "a_001.pdf"), (2, 3, 7, "ground_truth", "a_002.pdf")]


def test_guarded_update_idempotent_and_guarded(spark, sf_small):
    log = fx.fx_log(spark, sf_small)
    t = log.where(F.col("status") == "error").select(*KEYS)
    once = ST.retry_sftp(log, t).drop("updated")
    twice = ST.retry_sftp(once, t).drop("updated")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    changed = ST.mark_manual(log, t).where("updated").count()
    assert changed == log.join(t.distinct(), list(KEYS)).count()


def test_update_rejects_columns_outside_whitelist(spark, sf_small):
    import pytest
    log = fx.fx_log(spark, sf_small)
    with pytest.raises(ValueError):
        ST.guarded_update(log, log.select(*KEYS), {"filename": F.lit("x")})


def test_register_is_idempotent(spark):
    inbox = spark.createDataFrame(
        [("d1", "/in/d1/A1_x.pdf", 10), ("d1", "/in/d1/B2_y.pdf", 200 * 1024 * 1024)],
        "day_id string, path string, length long")
    files = IN.classify_size(IN.path_keys(inbox))
    empty = spark.createDataFrame([], "day_id string, filename string")
    first = IN.register(files, empty, empty, "r1", F.current_timestamp())
    rows = {r["filename"]: (r["status"], r["error_message"], r["folder_id"]) for r in first.collect()}
    assert rows == {"A1_x": ("pending", None, "A1"), "B2_y": ("skipped", "File exceeds 100MB limit", "B2")}
    assert IN.register(files, empty, first, "r2", F.current_timestamp()).count() == 0


def test_file_status_is_one_row_per_key(spark, sf_small):
    st = V.file_status(fx.fx_log(spark, sf_small), fx.fx_split(spark, sf_small))
    assert st.count() == st.select(*KEYS).distinct().count()
    f = V.funnel(st).agg(F.sum("n_files").alias("a"), F.sum(F.col("n_pending") + F.col("n_parsing") + F.col("n_parsed")
                                                           + F.col("n_predicted") + F.col("n_error") + F.col("n_skipped")
                                                           + F.col("n_manual")).alias("b")).first()
    assert f["a"] == f["b"]


def test_boundary_sets_contain_one_sorted_in_range(spark, sf_small):
    s = PR.starts_per_package(PR.rule_boundaries(SG.page_signals(SG.parse_elements(fx.fx_parsed(spark, sf_small)))))
    for r in s.collect():
        b = r["predicted_starts"]
        assert b[0] == 1 and b == sorted(set(b)) and b[-1] <= r["total_pages"]


def test_retyping_helpers(spark):
    from folio.functions.common import to_bool, to_float, to_int
    df = spark.createDataFrame([(" 12 ", "1.5", " TRUE "), ("", "x", "no"), (None, None, None), ("7x", " 2 ", "true")],
                               "a string, b string, c string")
    got = [tuple(r) for r in df.select(to_int(F.col("a")), to_float(F.col("b")), to_bool(F.col("c"))).collect()]
    assert got == [(12, 1.5, True), (None, None, False), (None, None, None), (None, 2.0, True)]


def test_scale_conf_sizes_partitions_to_input():
    from folio.session import scale_conf
    c = scale_conf(100 * 1024 ** 4, 8000)
    assert c["spark.sql.shuffle.partitions"] == "50000" and c["spark.sql.files.maxPartitionBytes"] == "512m"
    assert scale_conf(10 * 1024 ** 4, 800)["spark.sql.shuffle.partitions"] == str(10 * 1024 ** 4 // (512 * 1024 ** 2))
    assert scale_conf(10 * 1024 ** 2, 8)["spark.sql.shuffle.partitions"] == "24"


def test_same_file_names_in_two_batches_stay_apart(spark, sf_small):
    """Every step keyed on (day_id, filename) gives each batch what it gives that batch alone."""
    from folio.functions.common import KEYS
    from folio.operators import boundaries as BD
    from folio.operators import evaluation as EV
    from folio.operators import prompts as PR
    from folio.operators import signals as SG
    from folio.plans import fixtures as fx

    docs = fx.fx_doc_parsed(spark, sf_small)
    key = F.split("filename", "_")[0].cast("int")
    renamed = docs.where(key < 60).withColumn("day_id", F.when(key < 30, "202401").otherwise("202402")) \
        .withColumn("filename", F.concat((key % 30).cast("string"), F.lit("_F")))
    both = renamed

    def steps(parsed):
        signals = SG.page_signals(SG.parse_elements(parsed))
        rules = PR.starts_per_package(PR.rule_boundaries(signals))
        summary = SG.package_summary(signals)
        raw = F.concat(F.lit('{"predicted_starts": ['), F.array_join(F.transform("predicted_starts", lambda x: x.cast("string")), ","), F.lit("]}"))
        answers = PR.with_parsed(rules.select(*[c for c in KEYS if c in rules.columns], "total_pages", raw.alias("raw_response"),
                                              F.lit(None).cast("string").alias("error_message"), F.lit("S").alias("token_bucket")))
        resolved = BD.resolve_single(answers, answers.where("false"))
        batch = BD.verify_batch(BD.verify_windows(BD.proposed(resolved), signals))
        final = BD.final_boundaries(BD.apply_corrections(batch.withColumn("verify_response", F.lit("[]")).withColumn(
            "verify_error", F.lit(None).cast("string"))), resolved)
        ev = EV.evaluate(rules.withColumnRenamed("predicted_starts", "gt_starts"), final.withColumnRenamed("predicted_starts", "model_starts"))
        return signals, summary, batch, final, ev

    out = steps(both)
    for day in ("202401", "202402"):
        alone = steps(both.where(F.col("day_id") == day).drop("day_id"))
        for a, b in zip(out, alone):
            cols = sorted(c for c in b.columns if c != "run_id")
            got = sorted(map(repr, a.where(F.col("day_id") == day).select(cols).collect()))
            assert got == sorted(map(repr, b.select(cols).collect())) and got
