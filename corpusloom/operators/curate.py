"""Curation: thresholds by source, duplicates, counts, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.barrier import fresh
from .ordinal import numbered

#: A mapper beyond this many keys is joined by shuffle.
BROADCAST_KEYS = 100_000


def _least(df: DataFrame, mapper: dict[str, int], by: str, name: str) -> DataFrame:
    small = df.sparkSession.createDataFrame(list(mapper.items()), f"`{by}` string, `{name}` int")
    return F.broadcast(small) if len(mapper) <= BROADCAST_KEYS else small


def value_control(df: DataFrame, mapper: dict[str, int], value: str = "value", by: str = "reference_index") -> DataFrame:
    """Rows whose source is mapped and whose value reaches the source's minimum."""
    least = fresh(df.columns, "least")[0]
    return df.join(_least(df, mapper, by, least), by).filter(F.col(value) >= F.col(least)).select(*df.columns)


def value_stats(df: DataFrame, mapper: dict[str, int], value: str = "value", by: str = "reference_index") -> DataFrame:
    """For each mapped source: rows, rows that reach its minimum."""
    least = fresh(df.columns, "least")[0]
    return df.join(_least(df, mapper, by, least), by).groupBy(by).agg(F.count("*").alias("total"), F.count_if(F.col(value) >= F.col(least)).alias("alive"))


def deduplicated(df: DataFrame, subset: list[str], order: list[str], keep: str | bool = "first") -> DataFrame:
    """keep 'first' or 'last' in order of each group of equal subset, or with False only rows that are alone.

    first and last are an aggregate (partial before the shuffle), so a group of any size is no burden to one task.
    """
    if keep is False:
        n = fresh(df.columns, "n")[0]
        alone = df.groupBy(*subset).agg(F.count("*").alias(n)).filter(F.col(n) == 1).drop(n)
        on = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in subset]
        return df.alias("l").join(alone.alias("r"), on, "left_semi")
    if keep not in ("first", "last"):
        raise ValueError(f"keep is 'first', 'last' or False, not {keep!r}")
    pick = F.min_by if keep == "first" else F.max_by
    row, one = F.struct(*df.columns), fresh(df.columns, "row")[0]
    return df.groupBy(*subset).agg(pick(row, F.struct(*order)).alias(one)).select(f"{one}.*")


def spec(df: DataFrame, column: str) -> DataFrame:
    """Rows of each value, without null."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


def first_seen(df: DataFrame, column: str, order: str) -> DataFrame:
    """Distinct values with the place where each comes first; null is a value."""
    return df.groupBy(column).agg(F.min(order).alias("first_ord"))


def _draw(key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def _enough(rows: DataFrame, n: int, what: str, *by: Column) -> DataFrame:
    """rows, unless a group of them has fewer than n: that raises. rows are few: n a group."""
    size = fresh(rows.columns, "size")[0]
    short = F.raise_error(F.concat(F.lit(f"fewer than {n} rows"), F.lit(what)))
    return rows.withColumn(size, F.count(F.lit(1)).over(Window.partitionBy(*by))).filter(F.when(F.col(size) >= n, True).otherwise(short.cast("boolean"))).drop(size)


def sample(df: DataFrame, n: int, key: Column, seed: int = 0) -> DataFrame:
    """n rows without replacement, drawn by hash of key, in that order; if there are fewer (but some) reading the result raises.

    One pass: each task keeps the n lowest of its rows.
    """
    draw, own = fresh(df.columns, "draw", "key")
    rows = df.withColumns({draw: _draw(key, seed), own: key}).orderBy(draw, own).limit(n)
    return _enough(rows, n, "").orderBy(draw, own).drop(draw, own)


def sample_by(df: DataFrame, n: int, by: str, key: Column, seed: int = 0, keep_short: bool = False) -> DataFrame:
    """n rows of each value of by (null is one), drawn by hash of key as `sample` does; values with fewer raise, or keep what they have.

    One pass over all values: each task keeps the n lowest draws of each value before anything is shuffled, and such partial
    samples merge to the sample of all, so that no task ever has more of a value than n rows of each other task.
    """
    draw, own, rank = fresh(df.columns, "draw", "key", "rank")
    rows = df.withColumns({draw: _draw(key, seed), own: key})
    rows = rows.withColumn(rank, F.row_number().over(Window.partitionBy(by).orderBy(draw, own))).filter(F.col(rank) <= n)
    return (rows if keep_short else _enough(rows, n, f" of a value of {by}", F.col(by))).drop(draw, own, rank)


def head(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def union_all(*frames: DataFrame) -> DataFrame:
    """Rows of all, by column name; what a frame lacks is null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def spec_report(df: DataFrame, column: str, most: int = 10_000) -> DataFrame:
    """One row: total (rows), distinct (the values in order, null first, null as well), counts (a map of the values but null).

    A column with more than `most` different values is nothing for one row and raises; `spec` and `first_seen` report any.
    """
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    pairs = F.array_sort(F.collect_list(F.struct(F.col(column).cast("string").alias("v"), "n")))
    known = lambda p: p["v"].isNotNull()
    # No task takes more than most + 1 values together, whatever the column holds.
    report = counts.limit(most + 1).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), pairs.alias("p"))
    fits = F.when(F.size("p") <= most, F.col("p")).otherwise(F.raise_error(F.lit(f"{column} has more than {most} values")))
    return report.withColumn("p", fits).select("total", F.transform("p", lambda p: p["v"]).alias("distinct"), F.map_from_entries(F.filter("p", known)).alias("counts"))


def graded(df: DataFrame, value: str = "value", low: int = 0, high: int = 5) -> DataFrame:
    """Rows whose grade is one: a number from low to high."""
    return df.filter(F.col(value).between(low, high))


def single_value(df: DataFrame, column: str = "type"):
    """The one value of a column; an error if there is none or another."""
    found = [r[0] for r in df.select(column).distinct().limit(2).collect()]
    if len(found) != 1:
        raise ValueError(f"{column} has {'no value' if not found else 'several values'}")
    return found[0]


def sample_columns(eval_type: str) -> list[str]:
    """Columns worth showing of an item or a reference."""
    shown = {
        "mcqa": ["question", "options", "reasoning_process", "answer", "hallucination", "hallucination_desc", "value"],
        "qa": ["question", "old_answer", "answer", "preference", "preference_desc", "value"],
        "references": ["title", "contents"],
        "classification": ["title", "contents", "classification"],
    }
    return shown[eval_type]


def show_sample(df: DataFrame, key: Column, n: int = 5, eval_type: str | None = None, all_columns: bool = False, drawn: bool = True, order: list[str] | None = None) -> DataFrame:
    """n rows, drawn by hash of key or the first in order, with the columns that their type (or the one given) has to show."""
    kind = eval_type or single_value(df)
    rows = sample(df, n, key) if drawn else head(df, n, order or df.columns[:1])
    return rows if all_columns else rows.select(*[c for c in sample_columns(kind) if c in df.columns])


def show_samples(df: DataFrame, key: Column, n: int = 5) -> DataFrame:
    """type and n rows of each, in one pass, with the columns that any of the types has to show."""
    shown = {c for kind in ("mcqa", "qa", "references", "classification") for c in sample_columns(kind)}
    return sample_by(df, n, "type", key, keep_short=True).select("type", *[c for c in df.columns if c in shown])


def dispatch_order(df: DataFrame, key: Column, source: str, seed: int = 0, out: str = "turn") -> DataFrame:
    """df with out, the turn of each row (from 0): the sources interleaved as evenly as their sizes allow, drawn by hash of key within each.

    Row j of a source of n rows has its place at (2 j + 1) / 2n of the whole, ties by source. Between two rows of a source of m
    rows there are then at most n / m + 1 of another, so no source's calls crowd together unless it outweighs all others. Rows
    are numbered by ranges, so a source of any size is no burden to one task.
    """
    draw, own, missing, at, first, n, place = fresh([*df.columns, out], "draw", "key", "missing", "at", "first", "n", "place")
    rows = df.withColumns({draw: _draw(key, seed), own: key, missing: F.col(source).isNull()})
    rows = numbered(rows, [missing, source, draw, own], at)
    sizes = rows.groupBy(source).agg(F.min(at).alias(first), F.count(F.lit(1)).alias(n)).withColumnRenamed(source, place)
    placed = rows.join(sizes, F.col(source).eqNullSafe(F.col(place)), "left").drop(place)
    placed = placed.withColumn(place, (2 * (F.col(at) - F.col(first)) + 1) / (2 * F.col(n)))
    return numbered(placed, [place, missing, source], out).select(*[c for c in df.columns if c != out], out)


def at_positions(df: DataFrame, order: list[str], start: int, stop: int | None = None) -> DataFrame:
    """The rows from position start on to before stop (the one at start if there is none), by 0-based place in order."""
    at = fresh(df.columns, "at")[0]
    return numbered(df, order, at).filter((F.col(at) >= start) & (F.col(at) < (start + 1 if stop is None else stop))).select(*df.columns)
