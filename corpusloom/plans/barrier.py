"""Materialisation barriers: what is written is computed once, and lineage ends there."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which driver and executors share. Where it is unset, a local folder, removed at exit, on a local master; else an error."""
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not path:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that driver and executors share")
        path = getattr(context, "_corpusloom_folder", None)
        if not path:
            path = context._corpusloom_folder = tempfile.mkdtemp(prefix="corpusloom-")
            atexit.register(shutil.rmtree, path, ignore_errors=True)
    return f"{path.rstrip('/')}/corpusloom-{context.applicationId}"


def barrier(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet under a new name in the application's own part of the shared folder, and read again."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def observed(df: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, dict]:
    """barrier(), and aggregates of the rows that were written, taken by the write itself."""
    seen = Observation()
    done = barrier(df.observe(seen, *[c.alias(k) for k, c in counts.items()]), name)
    return done, seen.get


def clear(spark: SparkSession) -> None:
    """Removes everything that this application has written at barriers: call it once no result is read any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fresh(taken: Iterable[str], *names: str) -> list[str]:
    """The names, each with as many underscores before it as keep it apart from those taken, in any case."""
    used, out = {t.lower() for t in taken}, []
    for name in names:
        name = "_" + name
        while name.lower() in used:
            name = "_" + name
        used.add(name.lower())
        out.append(name)
    return out
