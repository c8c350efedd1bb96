"""A ledger of calls: what was asked once is not asked again, in this run or in one started anew.

A call's key is the hash of everything that is sent and of the item it is for. The ledger
is a folder of Parquet files by kind of call; calls that have a key in it are left out
(an anti-join), those made are appended by one committed write. Failed calls count as
made: the next round asks under another key. A run that stops between two writes loses
nothing, one that stops within a write loses the calls of that write only; `slices` cuts
a stage into so many writes. What Spark itself runs again (a lost executor) is asked
again under the same key, which providers can pass on as an idempotency key.

One run at a time writes to a ledger. Its path has to be shared, like any output.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "key string, index string, item_ord int, round int, status string, error string, response string"


def call_key(*columns: str) -> Column:
    """sha256 of the columns, nulls included, as one JSON object."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


@dataclass(frozen=True)
class Ledger:
    path: str
    slices: int = 1

    def folder(self, kind: str) -> str:
        return f"{self.path.rstrip('/')}/kind={kind}"

    def calls(self, spark: SparkSession, kind: str) -> DataFrame:
        """What was made of a kind; empty before the first."""
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder(kind))
        there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
        return spark.read.schema(SCHEMA).parquet(self.folder(kind)) if there else spark.createDataFrame([], SCHEMA)

    def completed(self, tasks: DataFrame, kind: str, columns: list[str], make: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """index, item_ord, status, error, response of tasks(index, item_ord, round, ...): from the ledger, after make() of what it lacks.

        columns: what a key is made of. make(tasks with key) gives rows of SCHEMA and is written once for each slice.
        """
        spark = tasks.sparkSession
        keyed = tasks.withColumn("key", call_key(*columns))
        for i in range(self.slices):
            part = keyed if self.slices == 1 else keyed.filter(F.pmod(F.xxhash64("key"), F.lit(self.slices)) == i)
            todo = part.join(self.calls(spark, kind).select("key"), "key", "left_anti").dropDuplicates(["key"])
            make(todo).select("key", "index", "item_ord", "round", "status", "error", "response").write.mode("append").parquet(self.folder(kind))
        # Retries of failed writes can't double a call: files of a write that isn't committed are not seen.
        made = self.calls(spark, kind).select("key", "status", "error", "response")
        return keyed.select("key", "index", "item_ord").join(made, "key").drop("key")
