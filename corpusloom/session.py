"""Sessions, and sending this package to executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def session(name: str = "corpusloom", cpus: int | None = None, partitions: int = 8) -> SparkSession:
    """A local session, as tests and the benchmark use it."""
    return (
        SparkSession.builder.appName(name)
        .master(f"local[{cpus or '*'}]")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Lets executors import this package wherever it lies on the driver: once a session, through Spark's own file server."""
    context = spark.sparkContext
    if getattr(context, "_corpusloom_shipped", False):
        return
    here = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="corpusloom-")
    path = os.path.join(folder, "corpusloom.zip")
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(here.rglob("*")):
            if p.suffix in (".py", ".txt"):
                z.write(p, f"corpusloom/{p.relative_to(here)}")
    context.addPyFile(path)
    context._corpusloom_shipped = True
