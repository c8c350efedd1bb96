"""Running totals over a whole table with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import fresh, written


def running(df: DataFrame, group: list[str], order: list, totals: dict[str, str], name: str) -> DataFrame:
    """Adds, for each out -> column of `totals`, the sum of that column over the rows before this one in its group.

    Rows are dealt by ranges of (group, order) and of where they were read, so a group of any size, and rows that are alike,
    are spread over many tasks. Each task sums its own rows; the sums by range (as many rows as ranges and groups) are added
    up and broadcast. `order` must be total up to rows that are alike. Helper columns get names that df doesn't have.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part, tie, own_part, *more = fresh([*df.columns, *totals], "range", "tie", "own_range", *totals, *group)
    before, own_group = dict(zip(totals, more)), more[len(totals) :]
    dealt = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(n, *group, *order, tie)
    dealt = written(dealt.withColumn(part, F.spark_partition_id()), name)
    sums = dealt.groupBy(part, *group).agg(*[F.sum(c).alias(before[o]) for o, c in totals.items()])
    over = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(part, *group, *[F.coalesce(F.sum(b).over(over), F.lit(0)).alias(b) for b in before.values()])
    inner = Window.partitionBy(part, *group).orderBy(*order, tie).rowsBetween(Window.unboundedPreceding, -1)
    own = dealt.select("*", *[F.coalesce(F.sum(c).over(inner), F.lit(0)).alias(o) for o, c in totals.items()])
    # `offsets` has one row for each range and group that meet: at most ranges + groups.
    offsets = offsets.select(F.col(part).alias(own_part), *[F.col(g).alias(o) for g, o in zip(group, own_group)], *before.values())
    same = F.col(part) == F.col(own_part)
    for g, o in zip(group, own_group):  # null is a group like others
        same = same & F.col(g).eqNullSafe(F.col(o))
    out = own.join(F.broadcast(offsets), same)
    return out.select(*df.columns, *[(F.col(o) + F.col(b)).alias(o) for o, b in before.items()])
