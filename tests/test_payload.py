"""Answers against shapes, and rounds that take their counts with their writes."""

import json
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import payload
from corpusloom.plans import barrier, pipelines
from corpusloom.plans.provider import SCHEMAS, StubProvider

KIND = {dict: "object", list: "list", str: "string", int: "integer", float: "number", bool: "boolean", type(None): "null"}


def slow(x, shape, path="$"):
    want, kind = "object" if isinstance(shape, dict) else "list" if isinstance(shape, list) else shape, KIND[type(x)]
    if kind != want and not (want == "number" and kind == "integer"):
        return [(path, "null" if kind == "null" else f"expected {want}, found {kind}")]
    if isinstance(shape, dict):
        return [e for k, inner in shape.items() for e in (slow(x[k], inner, f"{path}.{k}") if k in x else [(f"{path}.{k}", "missing")])]
    if isinstance(shape, list):
        return [e for i, y in enumerate(x) for e in slow(y, shape[0], f"{path}[{i}]")]
    return []


def checked(spark, texts, shape):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, a string").select("i", payload.errors(F.col("a"), shape).alias("e"))
    return [[tuple(e) for e in r.e] for r in rows.orderBy("i").collect()]


@pytest.mark.parametrize("kind", SCHEMAS)
def test_random_answers(spark, kind):
    """Right answers with something put out of order at a random place have that error, and no other."""
    r, shape = random.Random(kind), SCHEMAS[kind]

    def right(s):
        if isinstance(s, dict):
            return {k: right(v) for k, v in s.items()} | ({"more": 1} if r.random() < 0.3 else {})
        if isinstance(s, list):
            return [right(s[0]) for _ in range(r.randint(0, 3))]
        return {"string": '가 "q" \n', "integer": 3}[s]

    def wrong(x, s):
        if r.random() < 0.35 or not isinstance(s, dict | list) or not x:
            return r.choice([None, 7, 2.5, "text", True, [], {}, [1], {"a": None}])
        if isinstance(s, list):
            i = r.randrange(len(x))
            return [wrong(y, s[0]) if j == i else y for j, y in enumerate(x)]
        k = r.choice(list(s))
        return {a: b for a, b in x.items() if a != k} if r.random() < 0.3 else x | {k: wrong(x[k], s[k])}

    answers = [right(shape) for _ in range(20)] + [wrong(right(shape), shape) for _ in range(80)]
    got = checked(spark, [json.dumps(a, ensure_ascii=False) for a in answers], shape)
    assert got == [slow(a, shape) for a in answers] and not any(got[:20]) and sum(map(bool, got)) > 40


def test_answers_that_are_no_json(spark):
    shape = SCHEMAS["value"]
    texts = [None, "", "{", '{"value": 1', "{'value': 1}", "[1", "NaN", '{"value": 1.0}', '{"value": "1"}', '{"value": 1}', ' {"value":2} ', '{"value": 3} done']
    got = checked(spark, texts, shape)
    assert got[0] == [("$", "no answer")] and all(e == [("$", "no JSON")] for e in got[1:7]) and got[9] == got[10] == got[11] == []
    assert got[7][0][0] == got[8][0][0] == "$.value" and got[8][0][1] == "expected integer, found string"
    line = spark.createDataFrame([('{"a": 1, "b": [2, null]}',)], "a string").select(payload.said(payload.errors(F.col("a"), {"a": "string", "b": ["number"], "c": "boolean"}))).first()[0]
    assert line == "$.a: expected string, found integer; $.b[1]: null; $.c: missing"


def test_counts_by_path(spark):
    rows = spark.createDataFrame([('{"xs": [1, "a", "b"]}',), ('{"xs": [2]}',), ("?",), ('{"xs": []}',)], "a string")
    assert sorted(map(tuple, payload.error_counts(rows, "a", {"xs": ["string"]}).collect())) == [("$", "no JSON", 1), ("$.xs[]", "expected string, found integer", 2)]


def test_malformed_answers_are_asked_again(spark):
    """An answer of another shape is an error with its places, and the next round's answer takes its place."""

    class Ragged(StubProvider):
        def complete(self, task):
            answer = super().complete(task)
            if task["eval_type"] == "value" and task["round"] == 0:
                return {"value": str(answer["value"])}
            return {"questions": answer["questions"]} if task["eval_type"] == "mcqa" and task["round"] == 0 and task["index"] == "b_1" else answer

    refs = spark.createDataFrame([(f"b_{i}", "t", "c") for i in range(8)], "index string, title string, contents string")
    s = pipelines.Settings(n_datasets=1, max_step=1, tolerance=0.0, max_rounds=4)
    got = pipelines.mcqa(refs, s, Ragged()).collect()
    assert len(got) >= 7 and all(isinstance(r.value, int) for r in got)
    found = pipelines._called(s, Ragged(), "x", refs, "mcqa", 1, 0, 1, F.lit("s"), F.col("contents"), F.lit(4)).collect()
    assert {r["index"]: r.error for r in found if r.status == "error"} == {"b_1": "$.answers: missing"} and len(found) == 8


def test_a_round_is_two_writes(spark):
    """The calls, and the rows with their counts: no count runs beside them."""
    refs = spark.createDataFrame([(f"b_{i}", "t", f"c{i}") for i in range(12)], "index string, title string, contents string").withColumn("item_ord", F.lit(0))
    store = spark._jsparkSession.sharedState().statusStore()

    def done():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30000)
        return store.executionsCount()

    provider, s = StubProvider(seed=1, failing=0.5), pipelines.Settings(max_rounds=4)
    before, turns = done(), []

    def ask(todo, turn):
        turns.append(turn)
        got = pipelines._called(s, provider, "n", todo, "value", 1, turn, 1, F.lit("s"), F.col("contents"))
        return got.filter("status = 'ok'").select("index", "item_ord", F.from_json("response", "value int")["value"].alias("value"))

    found, rounds = pipelines.rounds(refs, ["index", "item_ord"], s, "n", ask, F.lit(True), None)
    assert 1 < rounds == len(turns) and done() - before == 2 * rounds
    assert found.count() + 0 >= 10


def test_observed_counts(spark):
    df = spark.range(1000).repartition(5)
    table, counts = barrier.observed(df, "seen", n=F.count(F.lit(1)), even=F.count_if(F.col("id") % 2 == 0), most=F.max("id"))
    assert counts == {"n": 1000, "even": 500, "most": 999} and table.count() == 1000
    table, counts = barrier.observed(df.filter("id < 0"), "seen", n=F.count(F.lit(1)))
    assert counts == {"n": 0} and table.count() == 0
