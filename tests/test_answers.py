"""The answer store: what is called, what is kept, and what a run after a killed one does."""

import json
import os

import pytest

from folio.operators import prompts as PR
from folio.plans.split_job import split_stage
from folio.sources.answers import AnswerStore, unanswered, with_question


def counting(folder, fails=(), kills=None):
    """A model that notes each call in ``folder``; fails the first time for prompts in ``fails``, and its
    process ends on the prompt ``kills``."""
    folder = str(folder)

    def model(prompt, budget):
        if kills is not None and kills in prompt:
            raise SystemExit("the executor is gone")
        with open(os.path.join(folder, "calls"), "a") as f:
            f.write(json.dumps(prompt) + "\n")
        if prompt in fails and not os.path.exists(os.path.join(folder, f"failed-{prompt}")):
            open(os.path.join(folder, f"failed-{prompt}"), "w").close()
            raise RuntimeError("busy")
        return f"answer to {prompt} in {budget}"
    return model


def calls(folder):
    path = os.path.join(str(folder), "calls")
    return [json.loads(x) for x in open(path)] if os.path.exists(path) else []


def asked(spark, n, budget=500):
    return spark.createDataFrame([(f"f{i}", f"p{i % 20}", budget) for i in range(n)], "filename string, prompt string, max_tokens int")


def test_equal_questions_are_called_once_and_never_again(spark, tmp_path):
    store = AnswerStore(spark, str(tmp_path / "store"))
    got = store.ask(asked(spark, 50), counting(tmp_path), ["filename"], "m", waves=3).collect()
    assert len(got) == 50 and all(r["llm_result"]["result"] == f"answer to p{int(r['filename'][1:]) % 20} in 500" for r in got)
    assert sorted(calls(tmp_path)) == sorted(f"p{i}" for i in range(20))
    again = AnswerStore(spark, str(tmp_path / "store")).ask(asked(spark, 50), counting(tmp_path), ["filename"], "m").collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got)) and len(calls(tmp_path)) == 20
    store.ask(asked(spark, 5, 800), counting(tmp_path), ["filename"], "m").collect()
    store.ask(asked(spark, 5), counting(tmp_path), ["filename"], "other").collect()
    assert len(calls(tmp_path)) == 30  # another budget and another model are other questions


def test_a_run_after_a_killed_one_calls_what_no_wave_stored(spark, tmp_path):
    store, questions = AnswerStore(spark, str(tmp_path / "store")), asked(spark, 20)
    with pytest.raises(Exception, match="the executor is gone|SystemExit|Python worker"):
        store.ask(questions, counting(tmp_path, kills="p7"), ["filename"], "m", waves=20)
    stored = store.read().count()
    assert 0 < stored < 20
    before = len(calls(tmp_path))
    got = store.ask(questions, counting(tmp_path), ["filename"], "m", waves=20).collect()
    assert len(calls(tmp_path)) - before == 20 - stored
    assert all(r["llm_result"]["errorMessage"] is None for r in got)


def test_failures_are_rows_and_are_asked_again(spark, tmp_path):
    store = AnswerStore(spark, str(tmp_path / "store"))
    first = {r["filename"]: r["llm_result"] for r in store.ask(asked(spark, 20), counting(tmp_path, fails=("p3",)), ["filename"], "m").collect()}
    assert first["f3"]["errorMessage"] == "RuntimeError: busy" and first["f3"]["result"] is None
    kept = store.ask(asked(spark, 20), counting(tmp_path), ["filename"], "m", retry_failed=False)
    assert kept.where("llm_result.errorMessage IS NOT NULL").count() == 1 and len(calls(tmp_path)) == 20
    then = {r["filename"]: r["llm_result"] for r in store.ask(asked(spark, 20), counting(tmp_path), ["filename"], "m").collect()}
    assert then["f3"]["result"] == "answer to p3 in 500" and len(calls(tmp_path)) == 21
    before = sorted(tuple(r) for r in store.read().where("error_message IS NULL").select("question", "result").collect())
    store.compact(least_files=1)
    rows = store.read().collect()
    assert len(rows) == 20 and sorted((r["question"], r["result"]) for r in rows) == before
    assert {r["tries"] for r in rows} == {1, 2}


def test_calls_are_tried_a_bounded_number_of_times(spark, tmp_path):
    rows = spark.createDataFrame([("a", "p1"), ("b", "p2")], "filename string, prompt string").coalesce(1)
    got = {r["filename"]: (r["llm_result"]["errorMessage"], r["tries"]) for r in PR.invoke(
        rows, counting(tmp_path, fails=("p1",)), ["filename"], tries=3, delay=0.01, with_tries=True).collect()}
    assert got == {"a": (None, 2), "b": (None, 1)}

    def broken(prompt, budget):
        raise ValueError("no")
    got = PR.invoke(rows, broken, ["filename"], tries=2, with_tries=True).collect()
    assert [(r["llm_result"]["errorMessage"], r["tries"]) for r in got] == [("ValueError: no", 2)] * 2


def test_null_and_empty_questions(spark, tmp_path):
    rows = spark.createDataFrame([("a", None, None), ("b", "", None), ("c", "x", None)], "filename string, prompt string, max_tokens int")
    keys = with_question(rows, "m").select("question").collect()
    assert keys[0] == keys[1] != keys[2]
    store = AnswerStore(spark, str(tmp_path / "store"))
    assert unanswered(with_question(rows, "m"), store.read()).count() == 2
    assert store.ask(rows.where("false"), counting(tmp_path), ["filename"], "m").collect() == [] and calls(tmp_path) == []


def test_split_stage_goes_on_where_a_killed_run_ended(spark, tmp_path):
    page = lambda i: {"id": i, "type": "text", "content": f"Page {i + 1} text", "bbox": [{"page_id": i}]}
    parsed = spark.createDataFrame([("d", f"f{k}", json.dumps({"document": {"elements": [page(i) for i in range(k + 1)]}})) for k in range(12)],
                                   "day_id string, filename string, parsed_content string")
    folder = str(tmp_path)

    def model(prompt, budget):
        if os.path.exists(os.path.join(folder, "kill")) and "=== PAGE 12 " in prompt:
            raise SystemExit("the executor is gone")
        with open(os.path.join(folder, "calls"), "a") as f:
            f.write("x")
        return json.dumps({"predicted_starts": [1]})

    def run(run_id):
        store = AnswerStore(spark, str(tmp_path / "store"))
        return split_stage(parsed, model, verifier=lambda p, t: "[]", run_id=run_id, day_id="d", answers=store, waves=12)

    (tmp_path / "kill").write_text("")
    with pytest.raises(Exception):
        run("r1")
    stored = AnswerStore(spark, str(tmp_path / "store")).read().count()
    assert 0 < stored < 12
    (tmp_path / "kill").rename(tmp_path / "healed")
    before = len((tmp_path / "calls").read_text())
    assert run("r2")["split_results"].count() == 12
    assert len((tmp_path / "calls").read_text()) - before == 12 - stored
    assert run("r3")["split_results"].count() == 12 and len((tmp_path / "calls").read_text()) - before == 12 - stored
