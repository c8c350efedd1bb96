"""Samples by group, interleaving and groups of any size."""

import hashlib
import random
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import curate, reshape


def md5(seed, i):
    return hashlib.md5(f"{seed}:{i}".encode()).hexdigest()


def test_sample_of_each_group(spark):
    """Exactly n of each value, null among them, the same whatever the partitions; a third of all rows in one value."""
    kinds = [random.Random(i).choice(["hot", "hot", "hot", "a", "b", None]) for i in range(3000)]
    df = spark.createDataFrame(list(enumerate(kinds)), "i int, type string")
    want = sorted(i for k in set(kinds) for i in sorted((i for i in range(3000) if kinds[i] == k), key=lambda i: (md5(4, i), i))[:20])
    for parts in (1, 7):
        got = curate.sample_by(df.repartition(parts), 20, "type", F.col("i"), 4)
        assert sorted(r.i for r in got.collect()) == want and got.columns == df.columns
    lines = curate.sample_by(df.repartition(7), 20, "type", F.col("i"), 4, True)._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in lines or "WindowGroupLimit" in curate.sample_by(df, 20, "type", F.col("i"), 4, True)._jdf.queryExecution().sparkPlan().toString()


def test_partial_samples_are_bounded(spark):
    """What a task shuffles is n rows of a value, not all it has."""
    df = spark.range(0, 100_000, 1, 4).select("id", F.lit("one").alias("type"))
    store, context = spark._jsparkSession.sharedState().statusStore(), spark.sparkContext
    context.setJobGroup("bounded", "bounded")
    assert curate.sample_by(df, 25, "type", F.col("id")).count() == 25
    context._jsc.sc().listenerBus().waitUntilEmpty(30000)
    written = [context.statusTracker().getJobInfo(j) for j in context.statusTracker().getJobIdsForGroup("bounded")]
    stages = {s for job in written for s in job.stageIds}
    records = [context._jsc.sc().statusStore().lastStageAttempt(s).shuffleWriteRecords() for s in stages]
    context.setLocalProperty("spark.jobGroup.id", None)
    assert store.executionsCount() > 0 and 0 < max(records) <= 4 * 25


def test_samples_that_are_short(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (3, "b")], "i int, type string")
    with pytest.raises(Exception, match="fewer than 3 rows of a value of type"):
        curate.sample_by(df, 3, "type", F.col("i")).collect()
    assert curate.sample_by(df, 3, "type", F.col("i"), keep_short=True).count() == 4 and curate.sample_by(df.limit(0), 3, "type", F.col("i")).collect() == []
    with pytest.raises(Exception, match="fewer than 5 rows"):
        curate.sample(df, 5, F.col("i")).collect()
    assert curate.sample(df, 4, F.col("i")).count() == 4 and [r.i for r in curate.sample(df, 1, F.col("i"), 9).collect()] == [min((1, 2, 3), key=lambda i: md5(9, i))]


def test_samples_to_show(spark):
    df = spark.createDataFrame([(i, "qa" if i % 3 else "mcqa", f"q{i}", "x", "hidden") for i in range(30)], "i int, type string, question string, answer string, index string")
    got = curate.show_samples(df, F.col("i"), 4)
    assert got.columns == ["type", "question", "answer"] and Counter(r.type for r in got.collect()) == {"qa": 4, "mcqa": 4}


@pytest.mark.parametrize("sizes", [{"a": 50, "b": 50}, {"a": 90, "b": 9, None: 1}, {"a": 300}, {"a": 7, "b": 5, "c": 3, None: 11}, {}])
def test_dispatch_interleaves_sources(spark, sizes):
    """Places are those of exact fractions, and between two of a source there is a bounded number of any other."""
    sources = [s for s, n in sizes.items() for _ in range(n)]
    df = spark.createDataFrame(list(enumerate(sources)), "i int, source string").repartition(5)
    got = curate.dispatch_order(df, F.col("i"), "source", 3).orderBy("turn").collect()
    assert [r.turn for r in got] == list(range(len(sources)))
    want = []
    for s, n in sizes.items():
        ranked = sorted((i for i, x in enumerate(sources) if x == s), key=lambda i: md5(3, i))
        want += [((Fraction(2 * j + 1, 2 * n), s is None, s or ""), i) for j, i in enumerate(ranked)]
    assert [r.i for r in got] == [i for _, i in sorted(want)]
    for s, m in sizes.items():
        at = [k for k, r in enumerate(got) if r.source == s]
        for other, n in sizes.items():
            if other != s:
                between = [sum(got[k].source == other for k in range(a, b)) for a, b in zip(at, at[1:])]
                assert max(between, default=0) <= n / m + 1


def test_groups_beyond_a_row(spark):
    """A group of a million items among small ones: bounded segments, whole again in order, with clashing names."""
    n = 1_000_000
    df = spark.range(n + 50).select(
        F.when(F.col("id") < n, "big").when(F.col("id") < n + 40, F.concat(F.lit("k"), (F.col("id") % 7).cast("string"))).alias("index"), F.col("id").alias("at"), F.concat(F.lit("x"), F.col("id").cast("string")).alias("segment_of"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("size")
    )
    lists = reshape.implode_segments(df, ["segment_of", "size", "at"], ["at"], max_bytes=1 << 20).cache()
    biggest = lists.select(F.max(F.octet_length(F.to_json(F.struct("segment_of", "size", "at"))))).first()[0]
    assert lists.filter("index = 'big'").count() > 30 and biggest < 1.5 * (1 << 20)
    known = {r["index"]: (r.segments, r.n, r.whole) for r in reshape.manifest(lists, "at").collect()}
    assert known["big"][1:] == (n, True) and known["k0"] == (1, sum(i % 7 == 0 for i in range(n, n + 40)), True) and len(known) == 8
    back = reshape.explode_segments(lists, ["segment_of", "size", "at"])
    big = back.filter("index = 'big'").agg(F.count("*"), F.count_if(F.col("item_ord") == F.col("at")), F.count_if(F.col("segment_of") == F.concat(F.lit("x"), F.col("at").cast("string"))), F.count("size")).first()
    assert tuple(big) == (n, n, n, n * 4 // 5)
    small = back.filter("index = 'k3'").orderBy("item_ord").collect()
    assert [(r.item_ord, r.at) for r in small] == list(enumerate(i for i in range(n, n + 40) if i % 7 == 3)) and back.count() == n + 40
    broken = reshape.manifest(lists.filter("NOT (index = 'big' AND segment = 3)"), "at").filter("NOT whole")
    assert [r["index"] for r in broken.collect()] == ["big"]
    lists.unpersist()


def test_small_groups_as_segments(spark):
    rows = [("a", 1, "x"), ("a", 0, None), ("b", 5, "y"), (None, 1, "z")]
    df = spark.createDataFrame(rows, "index string, ord int, v string")
    got = reshape.implode_segments(df, ["v"], ["ord"], max_bytes=1)
    assert sorted((r["index"], r.segment, r["first"], r.v) for r in got.collect()) == [("a", 0, 0, [None]), ("a", 2, 1, ["x"]), ("b", 0, 0, ["y"])]
    assert reshape.implode_segments(df.limit(0), ["v"], ["ord"]).collect() == []
