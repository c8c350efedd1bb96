"""From raw documents to token ids: toxicity, near-duplicates, repeated passages, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's docs. All but the last return the
columns of docs, whatever these are called.

Cases, the same in all stages: null and empty texts have no words, shingles, passages
or tokens; they are kept by the first three stages unless the model takes the empty
text for toxic, and by the mix never, as they add no words. Very long texts count
whole. Rows without a doc_id are rows like others. Repeated rows are each judged alike,
but for the passages, of which the later row loses its copy. Empty tables give none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import bpe, mixing, neardup, suffix_dedup, toxicity
from corpusloom.llm.common import WORD_SQL, table, written
from corpusloom.llm.repeats import keyed

#: SQL can't express a trained classifier; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without those that the classifier, learned from labels and docs, takes for toxic as operator 8 does.

    Null and empty texts score from the bias alone; without labels every text scores the prior.
    """
    return toxicity.flagged(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), toxicity.THRESHOLD)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group linked by a similarity of 0.8 on shingles of five words.

    Documents without words or without a doc_id are in no group and stay; repeated rows are one document and stay or go together.
    """
    gone = neardup.groups(docs, 5, 80).filter("not kept").select("doc_id").distinct()
    return docs.join(gone.hint("shuffle_hash"), "doc_id", "left_anti").select(*docs.columns)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without the bytes of passages of 100 bytes or more that start earlier; n_chars is counted again.

    A document that loses its whole text goes; one that had none stays.
    """
    return suffix_dedup.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix to the weights 1, 2, 3 takes it; those without words not at all."""
    rows = keyed(docs, True)
    sizes = rows.select(F.col("key").alias("doc_id"), F.col("row")["source"].alias("source"), "text")
    copies = mixing.mix(sizes, F.regexp_count("text", F.lit(WORD_SQL))).filter("copies > 0").select(F.col("doc_id").alias("key"), "copies")
    taken = rows.join(copies.hint("shuffle_hash"), "key").select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return taken.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, ids (little-endian 32-bit) of every row; null texts as empty ones."""
    return bpe.digests(docs, bpe.vocabulary(), with_ids=True)


STAGES = [("toxicity", drop_toxic), ("near_dedup", one_of_each_group), ("suffix_dedup", drop_repeats), ("mixing", mix_sources), ("bpe", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
