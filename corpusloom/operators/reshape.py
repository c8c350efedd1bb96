"""Numbering, chunking, and the change between batch and row form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.barrier import fresh
from .ordinal import numbered, tile


def make_index(df: DataFrame, prefix: str, order: list[str], position: str | None = None) -> DataFrame:
    """index = prefix_i for the i-th row in order; position: a column that has i already."""
    at = position or fresh(df.columns, "at")[0]
    rows = df if position else numbered(df, order, at)
    return rows.select(*[c for c in df.columns if c != "index"], F.concat(F.lit(prefix + "_"), F.col(at).cast("string")).alias("index"))


def reference_index(index: Column) -> Column:
    """index without its last _ part; '' if there is none."""
    parts = F.split(index, "_")
    return F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), "_")


def split_chunk(df: DataFrame, n: int, order: list[str], by: str = "num", out: str = "chunk_index", position: str | None = None) -> DataFrame:
    """by 'num': n contiguous chunks of equal count; by 'size': chunks of n rows. position: a column that has each row's place already."""
    if by not in ("num", "size"):
        raise ValueError(f"by is 'num' or 'size', not {by!r}")
    at = position or fresh([*df.columns, out], "at")[0]
    rows = df if position else numbered(df, order, at)
    chunk = F.floor(F.col(at) / n).cast("int") if by == "size" else tile(F.col(at), df.count(), n)
    return rows.select(*[c for c in df.columns if c != out], chunk.alias(out))


def explode_batches(df: DataFrame, lists: list[str], keep: list[str], position: str = "item_ord") -> DataFrame:
    """One row for each place of the lists, which must be of one length in a batch: a ragged batch raises."""
    same = F.array_distinct(F.array(*[F.size(c) for c in lists]))
    zipped = F.when(F.size(same) == 1, F.arrays_zip(*lists)).otherwise(F.raise_error(F.lit("lists of a batch differ in length")))
    one = fresh([*keep, position], "item")[0]
    rows = df.select(*keep, F.posexplode(zipped).alias(position, one))
    return rows.select(*keep, position, *[F.col(one)[c].alias(c) for c in lists])


def implode_rows(df: DataFrame, columns: list[str], order: list[str], index: str = "index") -> DataFrame:
    """One row for each index with every column as a list in order; rows without an index go. For groups beyond a row: `implode_segments`."""
    *places, unit = fresh([*columns, index], *order, "unit")
    one = F.struct(*[F.col(o).alias(p) for o, p in zip(order, places)], *columns)
    rows = df.filter(F.col(index).isNotNull()).groupBy(index).agg(F.array_sort(F.collect_list(one)).alias(unit))
    return rows.select(index, *[F.col(unit)[c].alias(c) for c in columns])


def implode_segments(df: DataFrame, columns: list[str], order: list[str], index: str = "index", max_bytes: int = 4 << 20) -> DataFrame:
    """index, segment, first, and the columns as lists in order: groups of any size, as segments of bounded bytes.

    A segment holds the rows of an index whose bytes before them (of their columns as JSON) lie in one stretch of max_bytes, so
    it is no larger than that and one row more; segment is the number of the stretch, first the place of its first row in the group. Rows
    are summed up by ranges of (index, order), so that no task has a whole group; rows without an index go.
    """
    size, at, start, place, segment, first = fresh([*df.columns], "size", "at", "start", "place", "segment", "first")
    rows = df.filter(F.col(index).isNotNull()).withColumn(size, F.octet_length(F.to_json(F.struct(*columns))))
    rows = numbered(numbered(rows, [index, *order], at), [at], start, F.col(size))
    begins = rows.groupBy(index).agg(F.min(at).alias(place), F.min(start).alias(first))
    rows = rows.join(begins, index).withColumn(segment, F.floor((F.col(start) - F.col(first)) / max_bytes))
    unit = F.struct((F.col(at) - F.col(place)).alias(at), *columns)
    lists = rows.groupBy(index, segment).agg(F.array_sort(F.collect_list(unit)).alias(at))
    return lists.select(index, F.col(segment).alias("segment"), F.get(F.col(at)[at], F.lit(0)).alias("first"), *[F.col(at)[c].alias(c) for c in columns])


def manifest(segments: DataFrame, column: str, index: str = "index") -> DataFrame:
    """index, segments, n: how many segments and rows a group of implode_segments() has; whole: none of them is missing."""
    size = F.size(column)
    found = segments.groupBy(index).agg(F.count(F.lit(1)).alias("segments"), F.sum(size).alias("n"), F.max(F.col("first") + size).alias("_end"))
    return found.select(index, "segments", "n", (F.col("n") == F.col("_end")).alias("whole"))


def explode_segments(segments: DataFrame, columns: list[str], index: str = "index", position: str = "item_ord") -> DataFrame:
    """The rows of implode_segments() again, with each row's place in its group."""
    one, at = fresh([*columns, index, position], "item", "at")
    rows = segments.select(index, "first", F.posexplode(F.arrays_zip(*columns)).alias(at, one))
    return rows.select(index, (F.col("first") + F.col(at)).alias(position), *[F.col(one)[c].alias(c) for c in columns])


def prev_example(question: Column, options: Column, reasoning: Column) -> Column:
    """An item as the example text that the next step's prompt shows."""
    return F.concat(F.lit("### 질문:\n"), question, F.lit("### 선택지:\n"), F.array_join(options, "\n"), F.lit("### 풀이:\n"), reasoning)


def with_previous(references: DataFrame, items: DataFrame, order: list[str]) -> DataFrame:
    """references left-joined with their items' examples, one text an index, joined by line breaks in order.

    Items that lack a question, options or reasoning give no example; references without any have none (null).
    """
    *places, text, unit = fresh([], *order, "text", "unit")
    one = F.struct(*[F.col(o).alias(p) for o, p in zip(order, places)], prev_example(F.col("question"), F.col("options"), F.col("reasoning_process")).alias(text))
    known = F.col(unit).getField(text).isNotNull()
    texts = items.select("index", one.alias(unit)).filter(known).groupBy("index").agg(F.array_sort(F.collect_list(unit)).alias(unit)).select("index", F.array_join(F.transform(unit, lambda u: u[text]), "\n").alias("prev_example"))
    return references.drop("prev_example").join(texts, "index", "left")


def with_table(question: Column, table_desc: Column) -> Column:
    """A question followed by its table's description, if there is one."""
    return F.when(F.length(table_desc) > 0, F.concat(question, F.lit("\n"), table_desc)).otherwise(question)
