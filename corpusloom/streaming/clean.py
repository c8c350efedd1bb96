"""The stateless part of quality filtering over a directory of JSON Lines that grows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T


def read_references(spark: SparkSession, folder: str, schema: str = "title string, contents string") -> DataFrame:
    return spark.readStream.schema(schema).json(folder)


def cleaned(stream: DataFrame, punctuation_ratio: float = 0.5, english_ratio: float = 0.5, number_ratio: float = 0.5, token_threshold: int = 200) -> DataFrame:
    c = F.col("contents")
    for ratio, most in ((T.punctuation_ratio, punctuation_ratio), (T.english_ratio, english_ratio), (T.number_ratio, number_ratio)):
        stream = stream.filter(T.keeps(ratio(c), most))
    rows = stream.withColumn("contents", T.normalize(T.remove_unicode(c)))
    return rows.withColumn("tokens", T.word_tokens(F.col("contents"))).filter(F.col("tokens") > token_threshold)


def write_references(stream: DataFrame, folder: str, checkpoint: str):
    """Writes what has arrived and stops."""
    return stream.writeStream.format("json").option("path", folder).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
