"""Mixing sources to target weights by pivotal dependent rounding (operator 2).

Every source gets a target number of words; each of its documents is then due
target / size of the source copies: a whole part, and a fraction p < 1 that is
rounded to 0 or 1. The rounding is pivotal: a residual mass of words meets the
next document, and mass moves at random between the two until the document is
integral, the rest staying in the residual, so the words taken keep their
expectation and each fold its sum. What a fold of FAN documents cannot settle
stays with its last one; these residuals are folded again, FAN at a time, in a
reduction tree up to one per source. DataFrame functions only.

Cases: null text has size 0; documents without words are taken 0 times; null is
a source of its own, the last; repeated rows are mixed each by itself; an empty
table gives none; extra columns are passed over; texts of any length count by their
words. Reruns draw the same, as draws are hashes of (seed, doc_id, size, level) and
of the place among rows in that order; rows that are alike change places at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD_SQL, table, written
from .running import running

FAN, MOST_COPIES, SEED, BROADCAST_SOURCES = 64, 3, 1, 20_000
#: Documents are rounded in this order: over 1024 words, over 64, the others.
PHASES = (None, 1024, 64, 0)


LIGHT = "transform(units, (x, i) -> named_struct('i', i + 1, 's', cast(-x.by as double), 'm', x.mass, 'u', x.u))"
#: One pivotal step: c, the residual (size s.s, mass s.m), meets e. Mass goes from e to c until e is empty or c full, or from c
#: to e until c is empty or e full, with odds that keep both expectations. The integral one is settled, the other is the residual.
FOLD = """
aggregate(slice(f, 2, size(f)),
  named_struct('i', f[0].i, 's', f[0].s, 'm', f[0].m, 'out', cast(array() as array<struct<i: int, up: int>>)),
  (c, e) -> if(e.u * (least(c.s - c.m, e.m) + least(c.m, e.s - e.m)) < least(c.m, e.s - e.m),
    if(e.m <= c.s - c.m,
      named_struct('i', c.i, 's', c.s, 'm', c.m + e.m, 'out', array_append(c.out, named_struct('i', e.i, 'up', 0))),
      named_struct('i', e.i, 's', e.s, 'm', e.m - (c.s - c.m), 'out', array_append(c.out, named_struct('i', c.i, 'up', 1)))),
    if(c.m <= e.s - e.m,
      named_struct('i', e.i, 's', e.s, 'm', c.m + e.m, 'out', array_append(c.out, named_struct('i', c.i, 'up', 0))),
      named_struct('i', c.i, 's', c.s, 'm', c.m - (e.s - e.m), 'out', array_append(c.out, named_struct('i', e.i, 'up', 1))))))
"""


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST_COPIES) -> DataFrame:
    """source, n, source_size, target of sizes(source, n, source_size).

    Weights repeat over the sources in code point order, null last. Targets share all words; those above `most` times
    their source stop there, and the excess is shared by weight among the others until none is above.
    """
    sizes = sizes.withColumn("_null", F.col("source").isNull().cast("int")).withColumn("_one", F.lit(1))
    ranked = running(sizes, [], ["_null", "source"], {"rank": "_one"}, "mix-sources") if sizes.limit(1).count() else sizes.withColumn("rank", F.lit(0))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = written(ranked.select("source", "n", "source_size", F.col("rank").cast("long").alias("sid"), weight.cast("double").alias("weight")), "mix-weights")
    total = float(ranked.agg(F.sum("source_size")).first()[0] or 0)
    level = float("inf")  # words for a weight of 1, falling as sources stop
    stop = F.col("source_size") * float(most)
    share, before = total / float(ranked.agg(F.sum("weight")).first()[0] or 1), -1.0
    while share > before:  # each pass stops at least one more source
        before = share
        full = stop <= F.col("weight") * F.lit(share)
        used, left = ranked.agg(F.sum(F.when(full, stop)), F.sum(F.when(~full, F.col("weight")))).first()
        if not left:
            share = level
            break
        share = max(before, (total - float(used or 0)) / float(left))
    full = stop <= F.col("weight") * F.lit(share)
    return ranked.withColumn("target", F.when(full, stop).otherwise(F.col("weight") * F.lit(share))).withColumn("copies", F.when(full, F.lit(float(most))).otherwise(F.col("target") / F.col("source_size")))


def rounded(rows: DataFrame, seed: int, salt: int, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """keep and up (0 or 1) of rows(sid, kind, place, mass, *keep), mass / size rounded; and (sid, rest), the mass not taken.

    Rows of a source and kind (a size within a factor of two) are folded by their place, FAN at a time, until one is left;
    these last ones of a source, one for each kind, are folded too.
    """
    draw = lambda level: F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), F.lit(level), "doc_id", "size", "place"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    wide, level, out = int(rows.agg(F.max(F.floor(F.col("place") / FAN))).first()[0] or 0) + 1, 0, None
    rows = rows.withColumn("bucket", F.floor(F.col("place") / FAN))
    while True:
        key = ["sid"] if wide <= 1 and level else ["sid", "kind", "bucket"]
        unit = F.struct((-F.col("size")).alias("by"), draw(level).alias("u"), "doc_id", "mass", *[c for c in keep if c != "doc_id"])
        folded = rows.groupBy(*key).agg(F.array_sort(F.collect_list(unit)).alias("units")).withColumn("f", F.expr(LIGHT))
        folded = written(folded.select(*key, "units", F.expr(FOLD).alias("s")), f"mix-level{level}")
        done = folded.select("units", F.explode("s.out").alias("x")).select(F.element_at("units", F.col("x.i")).alias("e"), F.col("x.up").alias("up"))
        done = done.select(*[F.col("e")[c].alias(c) for c in keep], "up")
        rest = folded.select(*key, F.element_at("units", F.col("s.i")).alias("e"), F.col("s.m").alias("mass"))
        rest = rest.select(*key, "mass", *[F.col("e")[c].alias(c) for c in keep])
        out = done if out is None else out.unionByName(done)
        level += 1
        if key == ["sid"]:
            last = rest.withColumn("up", (draw(level) * F.col("size") < F.col("mass")).cast("int"))
            return out.unionByName(last.select(*keep, "up")), last.select("sid", (F.col("mass") - F.col("up") * F.col("size")).alias("rest"))
        wide = -(-wide // FAN) if wide > 1 else 1
        rows = rest.withColumn("bucket", F.floor(F.col("bucket") / FAN))


def mix(docs: DataFrame, size, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST_COPIES, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, copies of docs(doc_id, source); `size` is a column of its words.

    Long documents are rounded before short ones: what their rounding leaves of a source's mass is first moved, in equal
    shares, to the fractions of its shorter ones, so a source ends within a few short documents of its target.
    """
    rows = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.coalesce(size, F.lit(0)).cast("long").alias("size")), "mix-docs")
    targets = source_targets(rows.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size")), weights, most)
    # Counted: beyond that many sources Spark joins by shuffle and splits the skewed ones.
    small = F.broadcast if targets.count() <= BROADCAST_SOURCES else lambda df: df
    plan = targets.select(F.col("source").alias("_source"), "sid", "source_size", "target", F.col("copies").alias("due"))
    rows = rows.join(small(plan), F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "source")
    whole = F.floor(F.col("due") + 1e-12).cast("int")
    # Places of the rows of a source and kind in a drawn order: any FAN neighbours meet, rows that are alike too.
    rows = rows.withColumn("kind", F.floor(F.log2(F.col("size").cast("double")))).withColumn("drawn", F.xxhash64(F.lit(seed), "doc_id", "size")).withColumn("one", F.lit(1).cast("long"))
    rows = written(running(rows, ["sid", "kind"], ["drawn", "doc_id", "size"], {"place": "one"}, "mix-order").drop("drawn", "one"), "mix-places")
    rows = rows.withColumn("whole", F.when(F.col("size") > 0, whole).otherwise(0)).withColumn("p", F.when(F.col("size") > 0, F.greatest(F.col("due") - whole, F.lit(0.0))).otherwise(0.0))
    keep = ["doc_id", "size", "source_size", "target", "whole", "place"]
    out = rows.filter("p = 0").select(*keep, F.lit(0).alias("up"))
    debt = targets.select("sid", F.lit(0.0).alias("rest"))
    for k, (low, high) in enumerate(zip(PHASES[1:], PHASES)):
        part = rows.filter("p > 0").filter(F.col("size") > low)
        part = part.filter(F.col("size") <= high) if high else part
        room = part.groupBy("sid").agg(F.sum("size").alias("room"), F.max("p").alias("_p")).join(small(debt), "sid", "right")
        shifted = F.least(F.greatest(F.col("_p") + F.col("rest") / F.col("room"), F.lit(0.0)), F.lit(1.0))
        room = written(room.select("sid", "rest", "room", "_p", shifted.alias("q")), f"mix-phase{k}")
        part = part.join(small(room.select("sid", "q")), "sid").withColumn("mass", F.col("q") * F.col("size"))
        got, left = rounded(part.select("sid", "kind", "mass", *keep), seed, k, keep)
        out = out.unionByName(got)
        debt = room.join(small(left.withColumnRenamed("rest", "left")), "sid", "left").select("sid", (F.coalesce(F.col("rest") - (F.col("q") - F.col("_p")) * F.col("room"), F.col("rest")) + F.coalesce("left", F.lit(0.0))).alias("rest"))
        debt = written(debt, f"mix-debt{k}")
    return out.select("doc_id", "size", "source_size", "target", (F.col("whole") + F.col("up")).alias("copies"))


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(table(spark, sf_dir, "documents"), F.regexp_count("text", F.lit(WORD_SQL)))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))
