"""Response parsing and corrections: the literal cases of FIXTURES.md section 1."""

import pytest
from pyspark.sql import functions as F

from folio.functions.responses import apply_corrections, with_parsed_starts

PARSE_CASES = [
    (None, None), ("no json", None), ("{bad", None), ("{}", [1]), ('{"predicted_starts": null}', None),
    ('```json\n{"predicted_starts": [9,3,3]}\n```', [1, 3, 9]), ('{"predicted_starts": [2,"5"]}', [1, 2, 5]),
    ('{"predicted_starts": [0,4,11]}', [1, 4]), ('{"a":{"b":1},"predicted_starts":[4]}', None),
    ('{"predicted_starts": [7.9, true]}', [1, 7]), ('{"predicted_starts": "37"}', None),
    ('{"predicted_starts": [null]}', None), ('{"predicted_starts": [1,"99999999999",3]}', [1, 3]),
    ('{"predicted_starts": [99999999999999999999999, 4]}', [1, 4]), ('{"predicted_starts": ["3.5"]}', None),
    ('{"predicted_starts": ["99999999999999999999999999", " +6 "]}', [1, 6]), ('text {"predicted_starts": [3]} more {"x": 1}', [1, 3]),
]


def test_parse_starts_cases(spark):
    df = spark.createDataFrame([(i, raw, 10) for i, (raw, _) in enumerate(PARSE_CASES)],
                               "i int, raw_response string, total_pages int")
    got = {r["i"]: r["parsed_starts"] for r in with_parsed_starts(df).collect()}
    for i, (raw, want) in enumerate(PARSE_CASES):
        assert got[i] == want, raw


CORRECTION_CASES = [
    (None, [1, 5, 9]), ("not json", [1, 5, 9]), ("[]", [1, 5, 9]),
    ('[{"action":"move","from_page":5,"to_page":6}]', [1, 6, 9]),
    ('[{"action":"remove","from_page":9}]', [1, 5]),
    ('[{"action":"remove","from_page":1}]', [1, 5, 9]),
    ('[{"action":"move","from_page":7,"to_page":8}]', [1, 5, 8, 9]),
    ('[{"action":"move","from_page":9,"to_page":13}]', [1, 5]),
    ('```json\n[{"action":"MOVE","from_page":5,"to_page":4}, {"action":"confirm","from_page":9}]\n```', [1, 4, 9]),
    ('[{"action":"remove","from_page":5}, {"action":"move","from_page":9,"to_page":10}]', [1, 10]),
    ('[{"action":"remove","from_page":9}, 7]', [1, 5]), ('[null, "x", {"action":"remove","from_page":9.0}]', [1, 5]),
    ('[{"action":"remove","from_page":"9"}, {"action":"remove","from_page":5}]', [1, 9]),
]


@pytest.mark.parametrize("resp,want", CORRECTION_CASES)
def test_apply_corrections(spark, resp, want):
    df = spark.createDataFrame([([5, 9], resp, 12)], "p array<int>, r string, t int")
    got = df.select(apply_corrections(F.col("p"), F.col("r"), F.col("t")).alias("x")).first()["x"]
    assert got == want


def corrections_py(proposed, corrections, total):
    """The correction rule spelled out item by item (malformed items are no-ops)."""
    result = set([1] + list(proposed))
    for c in corrections:
        action = (c.get("action") or "").lower()
        frm, to = c.get("from_page"), c.get("to_page")
        if action in ("move", "remove") and frm and frm in result and frm != 1:
            result.discard(frm)
        if action == "move" and to and 1 <= to <= total:
            result.add(to)
    return sorted(result)


def test_apply_corrections_random(spark):
    import json
    import random
    rnd = random.Random(11)
    rows, want = [], []
    for i in range(2000):
        total = rnd.randint(1, 30)
        proposed = sorted(set(rnd.sample(range(2, 40), rnd.randint(0, 6))))
        items = []
        for _ in range(rnd.randint(0, 5)):
            c = {"action": rnd.choice(["move", "remove", "confirm", "MOVE", "Remove", "add"])}
            if rnd.random() < 0.9:
                c["from_page"] = rnd.randint(-1, total + 3)
            if rnd.random() < 0.7:
                c["to_page"] = rnd.randint(-1, total + 3)
            items.append(c)
        rows.append((i, proposed, "```json\n" + json.dumps(items) + "\n```" if i % 3 == 0 else json.dumps(items), total))
        want.append(corrections_py(proposed, items, total))
    df = spark.createDataFrame(rows, "i int, p array<int>, r string, t int")
    got = {r["i"]: r["x"] for r in df.select("i", apply_corrections(F.col("p"), F.col("r"), F.col("t")).alias("x")).collect()}
    for i in range(len(rows)):
        assert got[i] == want[i], rows[i]


def test_fixed_prompt_texts_are_unchanged():
    import hashlib
    from folio.functions import prompt_text as P
    assert hashlib.sha256(P.BOUNDARY_SYSTEM.encode()).hexdigest() == (
        "b4282329984bcf9b1a604c82cd5cfe0fe76c5f4a1835f5ef286af33630cbdbb6")
    assert hashlib.sha256(P.VERIFY_SYSTEM.encode()).hexdigest() == (
        "df78602a10dddd1f0337df64ea5628028085bb742d83cf00c7eaeb0b7750c69f")
