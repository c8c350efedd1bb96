"""Calls are made once, whatever stops a run, and keep to one rate."""

import glob
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusloom.plans import pipelines, provider, rate
from corpusloom.plans.ledger import Ledger, call_key
from corpusloom.plans.provider import HttpProvider, StubProvider


def refs(spark, n):
    return spark.createDataFrame([(f"b_{i}", "t", f"text {i}") for i in range(n)], "index string, title string, contents string")


def noting(folder, **settings):
    """A stub that leaves a line in a file for each call."""
    log = str(folder)

    class Noting(StubProvider):
        def complete(self, task):
            import os
            import time as clock

            with open(f"{log}/{os.getpid()}", "a") as f:
                f.write(f"{clock.time()} {'/'.join(str(task[k]) for k in ('eval_type', 'step', 'round', 'index', 'item_ord'))}/{hash(task['user'])}\n")
            return super().complete(task)

    return Noting(**settings)


def made(folder):
    return [line.split(maxsplit=1) for p in glob.glob(f"{folder}/*") for line in open(p).read().splitlines()]


class Stopped(Exception):
    pass


@pytest.mark.parametrize("after", [1, 5])
def test_a_run_that_stops_is_taken_up(spark, tmp_path, monkeypatch, after):
    """Stopped after some stages and started again, a run makes each call once and gives what an unbroken one gives."""
    logs, whole = tmp_path / "logs", tmp_path / "whole"
    logs.mkdir(), whole.mkdir()
    settings = {"n_datasets": 2, "tolerance": 0.1, "max_rounds": 4, "max_step": 2}
    want = pipelines.mcqa(refs(spark, 6), pipelines.Settings(**settings, ledger=Ledger(str(tmp_path / "one"))), noting(whole, seed=2, malformed=0.2, failing=0.1)).drop("update_at")
    kept, own, count = Ledger(str(tmp_path / "two"), slices=2), pipelines.completed, [0]

    def stopping(*args):
        if count[0] == after:
            raise Stopped
        count[0] += 1
        return own(*args)

    monkeypatch.setattr(pipelines, "completed", stopping)
    with pytest.raises(Stopped):
        pipelines.mcqa(refs(spark, 6), pipelines.Settings(**settings, ledger=kept), noting(logs, seed=2, malformed=0.2, failing=0.1))
    before = len(made(logs))
    monkeypatch.setattr(pipelines, "completed", own)
    got = pipelines.mcqa(refs(spark, 6), pipelines.Settings(**settings, ledger=kept), noting(logs, seed=2, malformed=0.2, failing=0.1)).drop("update_at")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    calls = [c.rpartition("/")[0] for _, c in made(logs)]
    assert 0 < before < len(calls) == len(made(whole)) and Counter(calls) == Counter(c.rpartition("/")[0] for _, c in made(whole))


def test_a_write_that_dies_loses_only_its_slice(spark, tmp_path):
    """Slices that were written stay; the others are made by the next run."""
    logs = tmp_path / "logs"
    logs.mkdir()
    tasks = pipelines._task(refs(spark, 40), pipelines.Settings(), "value", 1, 0, 1, F.lit("s"), F.col("contents"))
    keys = {r["index"]: r.key for r in tasks.select("index", call_key(*tasks.select("index", "item_ord", *provider.TASK).columns).alias("key")).collect()}
    slot = {r["index"]: r.slot for r in spark.createDataFrame(list(keys.items()), "index string, key string").selectExpr("index", "pmod(xxhash64(key), 4) AS slot").collect()}
    bad = next(i for i, s in slot.items() if s == 2)

    class Dying(type(noting(logs))):
        def complete(self, task):
            if task["index"] == bad:
                raise SystemExit("out of memory")
            return super().complete(task)

    kept = Ledger(str(tmp_path / "ledger"), slices=4)
    with pytest.raises(Exception, match="out of memory|SystemExit|Job aborted|exited"):
        provider.completed(tasks, Dying(), "x", ledger=kept, kind="value")
    assert kept.calls(spark, "value").count() == sum(s < 2 for s in slot.values())
    got = provider.completed(tasks, noting(logs), "x", ledger=kept, kind="value").collect()
    calls = Counter(c.split("/")[3] for _, c in made(logs))
    assert len(got) == 40 and {r.status for r in got} == {"ok"} and all(calls[i] == 1 for i, s in slot.items() if s < 2)


def test_ledger_rows_and_repeats(spark, tmp_path):
    """Equal tasks are one call with a row each; other contents, rounds, models and kinds are other calls; errors stay errors."""
    logs, kept = tmp_path / "logs", Ledger(str(tmp_path / "ledger"))
    logs.mkdir()
    rows = refs(spark, 3).unionByName(refs(spark, 2))
    task = lambda rows, turn=0, model="m", kind="value": pipelines._task(rows, pipelines.Settings(model=model), kind, 1, turn, 1, F.lit("s"), F.col("contents"))
    run = lambda t, kind="value", **k: provider.completed(t, noting(logs, **k), "x", ledger=kept, kind=kind).collect()
    assert len(run(task(rows))) == 5 and len(made(logs)) == 3
    assert len(run(task(refs(spark, 4)))) == 4 and len(made(logs)) == 4
    run(task(refs(spark, 2), 1)), run(task(refs(spark, 2), 0, "n")), run(task(refs(spark, 2).withColumn("contents", F.lit("other"))))
    assert len(made(logs)) == 10
    run(task(refs(spark, 2), kind="preference"), "preference")
    assert len(made(logs)) == 12 and run(task(spark.createDataFrame([], rows.schema))) == []
    failed = run(task(refs(spark, 2), 7), failing=1.0)
    assert {r.status for r in failed} == {"error"} == {r.status for r in run(task(refs(spark, 2), 7))} and len(made(logs)) == 14


def test_shares_of_a_budget():
    for budget in (0, 1, 3, 10):
        for busy in ([True] * 4, [True, False, True, False], [False] * 3 + [True], [False] * 4):
            for turn in range(5):
                got = [rate.share(budget, busy, i, turn) for i in range(4)]
                assert sum(got) == (budget if any(busy) else 0) and all(n == 0 or b for n, b in zip(got, busy))
                assert not any(busy) or max(got) - min(g for g, b in zip(got, busy) if b) <= 1
    assert {rate.share(1, [True] * 3, 0, t) for t in range(3)} == {0, 1}


@pytest.mark.parametrize(("tasks", "n", "skewed"), [(1, 30, False), (3, 60, False), (3, 60, True), (8, 60, False)])
def test_one_rate_for_all_tasks(spark, tmp_path, tasks, n, skewed):
    """Calls a second stay under the rate, and near it even if one task has all of them. Beyond the free cores tasks share evenly."""
    logs = tmp_path / "logs"
    logs.mkdir()
    rows = pipelines._task(refs(spark, n), pipelines.Settings(), "value", 1, 0, 1, F.lit("s"), F.col("contents"))
    if skewed:
        rows = rows.withColumns({"index": F.lit("one"), "item_ord": F.expr("cast(substring(user, 18) as int)")}).withColumn("item_ord", F.lit(0))
    made_by = provider.completed(rows, noting(logs), "x", partitions=tasks, rate=15.0, period=1.0).collect()
    at = sorted(float(t) for t, _ in made(logs))
    assert len(made_by) == n == len(at)
    # Any second may meet the end of one period and the start of the next: two budgets at most, one on the whole.
    assert max(sum(t <= x < t + 1 for x in at) for t in at) <= 2 * 15 + tasks and n <= 15 * (at[-1] - at[0] + 1) + tasks
    if tasks <= 4:
        assert at[-1] - at[0] < 3 * n / 15 + 3


def test_repeated_tries_take_permits(spark, tmp_path, monkeypatch):
    """What is tried again comes out of the same budget."""
    taken = []
    monkeypatch.setattr(provider, "permit", lambda: taken.append(1))
    monkeypatch.setattr(provider.time, "sleep", lambda s: None)

    def urlopen(request, timeout):
        raise OSError("closed")

    monkeypatch.setattr(provider, "urlopen", urlopen)
    with pytest.raises(OSError, match="closed"):
        HttpProvider("https://example.org", "k", "m", tries=4).complete({"eval_type": "value", "step": 1, "system": "", "user": "", "index": "i"})
    assert len(taken) == 3
    own = rate.Permits()
    assert not own.give()
    import threading

    t = threading.Thread(target=own.take)
    t.start()
    while not own.give():
        time.sleep(0.01)
    t.join(5)
    assert not t.is_alive()
    rate.permit()  # outside of a stage nothing waits


def test_speculation_is_refused(spark, monkeypatch):
    tasks = pipelines._task(refs(spark, 1), pipelines.Settings(), "value", 1, 0, 1, F.lit("s"), F.col("contents"))
    conf = type("Conf", (), {"get": lambda self, key, default=None: "true" if key == "spark.speculation" else default})()
    monkeypatch.setattr(type(spark.sparkContext), "getConf", lambda self: conf)
    with pytest.raises(RuntimeError, match="twice"):
        provider.calls(tasks, StubProvider())
