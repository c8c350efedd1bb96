"""Graphs: what they refuse, and that a stopped run goes on with the next node."""

import json

import pytest
from pyspark.sql import functions as F

from corpusloom.plans import pipelines
from corpusloom.plans.graph import END, Graph, GraphError
from corpusloom.plans.provider import StubProvider


def same(x):
    return {}


@pytest.mark.parametrize(
    ("graph", "why"),
    [
        (Graph("x", {"a": same}, {"a": END}), "entry 'x' is no node"),
        (Graph("a", {"a": same}, {}), "'a' leads to nothing"),
        (Graph("a", {"a": same}, {"a": "b"}), "'a' leads to 'b'"),
        (Graph("a", {"a": same}, {"a": END, "b": "a"}), "edge from 'b'"),
        (Graph("a", {"a": same, "b": same}, {"a": END, "b": END}), "'b' is never reached"),
        (Graph("a", {"a": same, "b": same}, {"a": "b", "b": "a"}), "'b' never ends"),
        (Graph("a", {"a": same, "b": same}, {"a": (lambda x: "b", ("b", END)), "b": "b"}), "'b' never ends"),
        (Graph("a", {"a": same, END: same}, {"a": END, END: "a"}), "a node is called"),
    ],
)
def test_graphs_that_cant_run(spark, graph, why):
    with pytest.raises(GraphError, match=why):
        graph.run(spark, {"n": 1})


def test_loops_and_conditions(spark):
    count = Graph("up", {"up": lambda x: {"n": x["n"] + 1}, "double": lambda x: {"n": 2 * x["n"]}}, {"up": (lambda x: "double" if x["n"] < 10 else END, ("double", END)), "double": "up"})
    assert count.run(spark, {"n": 0}) == {"n": 15} and count.problems() == []
    with pytest.raises(GraphError, match="3 nodes were visited"):
        count.run(spark, {"n": 0}, limit=3)
    with pytest.raises(GraphError, match="isn't declared"):
        Graph("a", {"a": same}, {"a": (lambda x: "a", (END,))}).run(spark, {})
    assert count.mermaid() == "graph TD\n    start --> up\n    up -->|if| double\n    up -->|if| end\n    double --> up"


def test_a_stopped_run_goes_on(spark, tmp_path):
    """Stopped before any of its nodes a run goes on there, with tables as they were; nodes that finished don't run again."""
    want = [0, 2, 6, 14, 30]

    def build(log, stop):
        def grow(x):
            log.append("grow")
            if len(log) == stop:
                raise KeyboardInterrupt
            return {"rows": x["rows"].withColumn("n", F.col("n") * 2), "turn": x["turn"] + 1}

        def note(x):
            log.append("note")
            if len(log) == stop:
                raise KeyboardInterrupt
            return {"seen": [*x["seen"], x["rows"].agg(F.sum("n")).first()[0]]}

        return Graph("grow", {"grow": grow, "note": note}, {"grow": "note", "note": (lambda x: "grow" if x["turn"] < 3 else END, ("grow", END))})

    state = {"rows": spark.createDataFrame([(i, i % 4) for i in range(10)], "i int, n int"), "fixed": spark.range(3), "turn": 0, "seen": []}
    whole = build([], None).run(spark, state)
    assert len(want) == 5 and whole["turn"] == 3 and whole["seen"] == [26, 52, 104]
    for stop in (1, 2, 4, 6):
        folder, log = str(tmp_path / str(stop)), []
        with pytest.raises(KeyboardInterrupt):
            build(log, stop).run(spark, state, folder)
        again = []
        got = build(again, None).run(spark, state, folder)
        assert got["seen"] == whole["seen"] and got["fixed"].count() == 3 and len(log) - 1 + len(again) == 6
        assert sorted(got["rows"].collect()) == sorted(whole["rows"].collect())
        assert build([], 1).run(spark, state, folder)["seen"] == whole["seen"]  # a finished run runs nothing
    fixed = {json.loads(p.read_text())["tables"]["fixed"][0] for p in (tmp_path / "4").glob("*.json")}
    assert len(fixed) == 1  # written once
    with pytest.raises(GraphError, match="no node of this graph"):
        (tmp_path / "odd").mkdir()
        (tmp_path / "odd" / "0001-x.json").write_text('{"visit": 1, "next": "gone", "values": {}, "tables": {}}')
        build([], None).run(spark, state, str(tmp_path / "odd"))


def test_a_pipeline_goes_on_with_its_second_step(spark, tmp_path, monkeypatch):
    """Stopped in step 2, a run of multiple-choice items generates nothing of step 1 again, and gives what an unbroken one gives."""
    refs = spark.createDataFrame([(f"b_{i}", "t", f"text {i}") for i in range(5)], "index string, title string, contents string")
    settings, provider = {"n_datasets": 1, "max_step": 2, "tolerance": 0.2, "max_rounds": 3}, StubProvider(seed=6, malformed=0.1)
    want = sorted(map(str, pipelines.mcqa(refs, pipelines.Settings(**settings), provider).drop("update_at").collect()))
    steps, own = [], pipelines.generate_mcqa

    def generate(rows, s, p, step):
        steps.append(step)
        if steps == [1, 2]:
            raise KeyboardInterrupt
        return own(rows, s, p, step)

    monkeypatch.setattr(pipelines, "generate_mcqa", generate)
    s = pipelines.Settings(**settings, state_dir=str(tmp_path / "state"))
    with pytest.raises(KeyboardInterrupt):
        pipelines.mcqa(refs, s, provider)
    got = pipelines.mcqa(refs, s, provider).drop("update_at")
    assert sorted(map(str, got.collect())) == want and steps == [1, 2, 2]


def test_graphs_of_the_pipelines():
    for kind in ("mcqa", "qa", "classification"):
        assert pipelines.workflow_graph(kind).startswith("graph TD\n    start --> ") and "--> end" in pipelines.workflow_graph(kind).replace("|if|", "")
