"""Positions in a total order without bringing all rows to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.barrier import barrier, fresh


def numbered(df: DataFrame, order: list[str], out: str = "ord", weight: Column | None = None) -> DataFrame:
    """df with out: its 0-based position in `order`, or the sum of weight over the rows before it.

    Rows are dealt by ranges of the order (rows that are alike in it, by where they were read); each range is summed by
    itself, and the sums of the ranges before it (one row a range, broadcast) are added. Wide rows are better numbered by
    `positions`.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    add, part, tie, own, total, before = fresh([*df.columns, out], "weight", "part", "tie", "own", "total", "before")
    weight = F.lit(1).cast("long") if weight is None else weight.cast("long")
    dealt = df.withColumn(add, weight).withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(n, *order, tie)
    dealt = barrier(dealt.withColumn(part, F.spark_partition_id()), "numbered")
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy(part).agg(F.sum(add).alias(total)).select(part, F.coalesce(F.sum(total).over(earlier), F.lit(0)).alias(before))
    inner = Window.partitionBy(part).orderBy(*order, tie).rowsBetween(Window.unboundedPreceding, -1)
    rows = dealt.withColumn(own, F.coalesce(F.sum(add).over(inner), F.lit(0)))
    return rows.join(F.broadcast(sums), part).select(*df.columns, (F.col(own) + F.col(before)).alias(out))


def positions(df: DataFrame, order: list[str], out: str, weight: Column | None = None, name: str = "rows") -> DataFrame:
    """As `numbered`, for wide rows: they are written once with a row id, only ids and keys are numbered, and joined by id."""
    row, *keys, add = fresh([*df.columns, out], "row", *order, "weight")
    rows = barrier(df.withColumn(row, F.monotonically_increasing_id()), name)
    narrow = rows.select(row, *[F.col(o).alias(k) for o, k in zip(order, keys)], (F.lit(1) if weight is None else weight).alias(add))
    return rows.join(numbered(narrow, keys, out, F.col(add)).select(row, out), row).drop(row)


def tile(position: Column, total: int, n: int) -> Column:
    """The 0-based bucket of ntile(n) for a position among total rows: contiguous, the first total % n buckets one larger."""
    size, more = divmod(total, n)
    head = F.lit(more * (size + 1))
    rest = F.lit(more) + F.floor((position - head) / max(1, size))
    return F.when(position < head, F.floor(position / (size + 1))).otherwise(rest).cast("int")
