"""JSON, JSON Lines and text sources and sinks."""

from __future__ import annotations

import json
import re
from datetime import datetime
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.ordinal import positions, tile
from ..plans.barrier import fresh
from . import sink


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """One JSON object a line; a bad line raises."""
    reader = spark.read.option("mode", "FAILFAST")
    return (reader.schema(schema) if schema else reader).json(path)


def read_multi_jsonl(spark: SparkSession, folder: str, schema: StructType | str | None = None) -> DataFrame:
    """All *.jsonl files below folder, joined by column name; notebook checkpoints are passed over."""
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json*").option("mode", "FAILFAST")
    rows = (reader.schema(schema) if schema else reader).json(folder)
    path = F.col("_metadata.file_path")  # a .jsonl is a file, or the folder that Spark wrote
    return rows.filter(path.rlike(r"\.jsonl(/|$)") & ~path.contains(".ipynb_checkpoints"))


def write_json(obj, path: str, overwrite: bool = True) -> None:
    """A small object as one JSON file, on the driver."""
    with open(path, "w" if overwrite else "a", encoding="utf-8") as f:
        f.write(json.dumps(obj, ensure_ascii=False) + "\n")


def write_jsonl(df: DataFrame, path: str, overwrite: bool = True) -> None:
    """One JSON object a line, nulls written: a folder of as many parts as df has."""
    df.write.mode("overwrite" if overwrite else "append").option("ignoreNullFields", False).json(path)


def _line(columns: list[str]) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def write_jsonl_file(df: DataFrame, path: str, order: list[str] | None = None, overwrite: bool = True) -> None:
    """One JSON object a line in one file of that very name, which one task writes: for results of a size that is still read as a file.

    The file appears whole or not at all; appending replaces it by one that has the old lines before the new. order: of the
    lines; without one they come as they are.
    """
    folder, _, name = path.rpartition("/")
    file, line = fresh(df.columns, "file", "line")
    rows = df.withColumns({file: F.lit(name), line: _line(df.columns)})
    rows = rows.repartition(1).sortWithinPartitions(*order) if order else rows.coalesce(1)
    sink.write_lines(rows.select(F.col(file).alias("file"), F.col(line).alias("line")), folder or ".", overwrite=overwrite)


def write_jsonl_sized(df: DataFrame, path: str, order: list[str], max_mb: float = 256) -> int:
    """One file of that name as by `write_jsonl_file`, or where its lines take more than max_mb a folder of that name; returns the parts.

    The folder's parts take about max_mb each and are in order: the rows of the first come before those of the next. Readers of
    JSON Lines read both alike. df is read twice or thrice, so it should be a written table.
    """
    size = df.agg(F.sum(F.octet_length(_line(df.columns)) + 1)).first()[0] or 0
    if size <= max_mb * 2**20:
        write_jsonl_file(df, path, order)
        return 1
    n = int(size // (max_mb * 2**20)) + 1
    write_jsonl(df.repartitionByRange(n, *order).sortWithinPartitions(*order), path)
    return n


def file_split_plan(df: DataFrame, order: list[str], max_bytes: int) -> DataFrame:
    """df with file_idx: contiguous files of equal counts, as many as the JSON size takes at max_bytes each."""
    return _planned(df, order, max_bytes)[0]


def _planned(df: DataFrame, order: list[str], max_bytes: int) -> tuple[DataFrame, int]:
    at, size = fresh([*df.columns, "file_idx"], "at", "bytes")
    rows = positions(df.withColumn(size, F.octet_length(_line(df.columns)) + 1), order, at, name="split")
    total, n = rows.agg(F.sum(size), F.count("*")).first()
    files = int(total or 0) // max_bytes + 1
    return rows.withColumn("file_idx", tile(F.col(at), n, files)).drop(at, size), min(files, n)


def write_multi_jsonl(df: DataFrame, folder: str, name: str, order: list[str], max_size_mb: float = 10) -> int:
    """Writes the files of the split plan as folder/name_{i}.jsonl, each one file in order; returns how many.

    All appear, and files of that name with other numbers go, when the last one is written; if the write fails, none does.
    """
    plan, n = _planned(df, order, int(max_size_mb * 2**20))
    file, line = fresh([*df.columns, "file_idx"], "file", "line")
    rows = plan.repartition("file_idx").sortWithinPartitions("file_idx", *order)
    rows = rows.withColumns({file: F.concat(F.lit(f"{name}_"), F.col("file_idx").cast("string"), F.lit(".jsonl")), line: _line(df.columns)})
    sink.write_lines(rows.select(F.col(file).alias("file"), F.col(line).alias("line")), folder, re.escape(f"{name}_") + r"\d+\.jsonl")
    return n


def write_errors(df: DataFrame, folder: str, name: str, error: BaseException | str) -> str:
    """The rows of a step that failed as folder/error_{name}_{time}.jsonl, with the error in each; returns the path."""
    path = f"{folder}/error_{name}_{datetime.now():%Y%m%d%H%M%S%f}.jsonl"
    write_jsonl(df.withColumn("error", F.lit(str(error) or type(error).__name__)), path)
    return path


def fewshots(spark: SparkSession, folder: str, separator: str = "<SEP>") -> DataFrame:
    """file, pos, example of every few-shot text below folder."""
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(folder, wholetext=True).select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"), "value")
    return rows.select("file", F.posexplode(F.split("value", separator)).alias("pos", "example")).withColumn("example", F.trim("example"))


def find_file(name: str, start: str = ".") -> str | list[str]:
    """Where a file of that name lies below start: one place, or a list of several."""
    found = sorted(str(p) for p in Path(start).rglob(name))
    if not found:
        raise FileExistsError(f"{name} is not below {start}")
    return found[0] if len(found) == 1 else found


def load_env(key: str, path: str = ".env") -> str | None:
    """The value of key in a file of KEY=value lines."""
    for line in Path(path).read_text().splitlines():
        name, eq, value = line.partition("=")
        if eq and name.strip() == key:
            return value.strip().strip("'\"")
    return None


def file_size(path: str) -> float | str:
    """Megabytes of a file, or a note that there is none."""
    p = Path(path)
    return p.stat().st_size / 2**20 if p.exists() else "File Not exists."
