"""Sharding by a k-d tree over metadata (operator 9).

What is dealt are groups of rows with equal texts, each one item with the bytes of
all its rows. All nodes of a level are split at once: of the dimensions, each node
takes the one that is widest in it (its range as a share of the table's), and is cut
at the weighted median along it, or at the share that its leaves ask for. Medians are
exact: running weights over the node's items come from a range-dealt table (see
`running`). Splitting ends when leaves have the target weight; leaves are the shards.
DataFrame functions only.

Cuts lie between groups: the edge nearest to the median is taken. Only a group of
more than a tenth of the target, which would leave shards over a twentieth of the
target apart, may be cut itself; such groups (at most ten times as many as shards)
come as pieces of a twentieth of the target.

Dimensions are the language, the source (both by the code points they begin with),
the bytes and the bytes by character of a text; a group takes its least language and
source. Ties in a dimension are broken by the text's checksum and hash.

Cases: null text has no bytes (size 1, checksum 0) and equals the empty text; null
languages and sources come first; texts of any length count by their bytes; repeated
rows get slots of their own; fewer groups than shards leave shards without rows; an
empty table gives none; extra columns are passed over; a null doc_id comes first
among its ties. Texts with equal bytes, checksum and 64-bit hash are taken as equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, salted_join, table, written
from .running import running

SHARDS, SLACK = 8, 20  # cuts may miss the median by a SLACKth of the target to spare a group


def kd_leaves(items: DataFrame, dims: list[str], weight: str, ties: list[str], target: float, inside: str | None = None, out: str = "shard") -> DataFrame:
    """items with `out`: the leaf of a k-d tree over dims whose leaves have about the target weight.

    ties make the order total up to items that are alike. inside: a boolean column, whether a cut before this item, next to
    it in the order of any dimension, would divide a group.
    """
    span = items.agg(F.sum(weight).alias("total"), *[f(F.col(d).cast("double")).alias(f"{k}{i}") for i, d in enumerate(dims) for k, f in (("lo", F.min), ("hi", F.max))]).first()
    leaves = max(1, round(float(span["total"] or 0) / target))
    whole = [max(1e-12, (span[f"hi{i}"] or 0) - (span[f"lo{i}"] or 0)) for i in range(len(dims))]
    node, left, total, axis, value, before, cut = fresh([*items.columns, out], "node", "leaves", "total", "axis", "value", "before", "cut")
    rows = items.withColumn(node, F.lit(0)).withColumn(left, F.lit(leaves))
    for level in range((leaves - 1).bit_length()):
        ranges = [((F.max(F.col(d).cast("double")) - F.min(F.col(d).cast("double"))) / w) for d, w in zip(dims, whole)]
        widest = F.greatest(*ranges) if len(ranges) > 1 else ranges[0]
        chosen = F.coalesce(*[F.when(r == widest, F.lit(i)) for i, r in enumerate(ranges)], F.lit(0))
        # One row a node: at most as many as leaves.
        rows = rows.join(F.broadcast(rows.groupBy(node).agg(F.sum(weight).alias(total), chosen.alias(axis))), node)
        along = F.coalesce(*[F.when(F.col(axis) == i, F.col(d).cast("double")) for i, d in enumerate(dims)], F.lit(float("-inf")))
        rows = running(rows.withColumn(value, along), [node], [value, *ties], {before: weight}, f"kd-level{level}")
        few = F.floor(F.col(left) / 2).cast("int")
        miss = F.abs(F.col(before) - F.col(total) * few / F.col(left))
        cost = miss + F.when(F.col(inside), F.lit(target / SLACK)).otherwise(0.0) if inside else miss
        cuts = rows.filter(F.col(left) > 1).groupBy(node).agg(F.min_by(before, F.struct(cost, before)).alias(cut))
        rows = rows.join(F.broadcast(cuts), node, "left")
        stays = (F.col(left) == 1) | (F.col(before) < F.col(cut))
        rows = rows.select(
            *items.columns, F.when(stays, F.col(node)).otherwise(F.col(node) + few).alias(node),
            F.when(F.col(left) == 1, 1).when(stays, few).otherwise(F.col(left) - few).alias(left),
        )
    return rows.drop(left).withColumnRenamed(node, out)


def first_letters(col: Column) -> Column:
    """A number that orders strings by the six bytes they begin with."""
    return F.conv(F.rpad(F.hex(F.substring(col.cast("string").cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")


def text_metadata(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """doc_id, size (bytes + 1), text_crc32, hash, lang, source (as numbers) and wide of every row; columns that docs lacks are null."""
    text: Column = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    size = (F.octet_length(text) + 1).cast("long")
    names = [first_letters(F.col(c)) if c in docs.columns else F.lit(None).cast("double") for c in (lang_col, source_col)]
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), size.alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("hash"),
        names[0].alias("lang"), names[1].alias("source"), (size / (F.length(text) + 1)).alias("wide"),
    )


def kd_shards(rows: DataFrame, shards: int | None = SHARDS, target: float | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless from 0 in each shard) of rows as `text_metadata` makes them: so many
    shards, or as many as the target bytes ask for."""
    key = ["size", "text_crc32", "hash"]
    groups = rows.groupBy(*key).agg(F.count("*").alias("n"), F.min("lang").alias("lang"), F.min("source").alias("source"), F.min("wide").alias("wide"))
    groups = written(groups.withColumn("magnitude", F.log2(F.col("size").cast("double"))), "kd-groups")
    total = float(groups.agg(F.sum(F.col("n") * F.col("size"))).first()[0] or 0)
    target = target or max(1.0, total / shards)
    # Groups of over a tenth of the target: at most ten for each target in the total.
    pieces = F.ceil(F.col("n") * F.col("size") * SLACK / target).cast("int")
    groups = groups.withColumn("pieces", F.when(F.col("n") * F.col("size") * 10 > target, F.least(pieces, F.col("n")).cast("int")).otherwise(1))
    large = groups.filter("pieces > 1").select(*key, "n", "pieces")
    items = groups.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    # Row r of n is in piece floor(r * pieces / n): piece p begins with row ceil(p * n / pieces).
    begin = lambda p: F.ceil(p * F.col("n") / F.col("pieces"))
    items = items.withColumn("weight", (begin(F.col("piece") + 1) - begin(F.col("piece"))) * F.col("size")).withColumn("inside", F.col("piece") > 0)
    items = kd_leaves(items, ["magnitude", "wide", "lang", "source"], "weight", [*key, "piece"], target, "inside")
    shard_of = written(items.select(*key, "piece", "shard"), "kd-items")
    # Rows of the groups that have pieces are numbered; the broadcast is as bounded as these groups are.
    marked = rows.select("doc_id", *key).join(F.broadcast(large), key, "left").withColumn("one", F.lit(1).cast("long"))
    numbered = running(marked.filter("pieces > 1"), key, ["doc_id"], {"row": "one"}, "kd-large")
    numbered = numbered.withColumn("piece", F.floor(F.col("row") * F.col("pieces") / F.col("n")).cast("int"))
    placed = numbered.select("doc_id", *key, "piece").unionByName(marked.filter("pieces is null").select("doc_id", *key, F.lit(0).alias("piece")))
    placed = salted_join(placed, shard_of, [*key, "piece"], ["doc_id"], counted=rows.select(*key, F.lit(0).alias("piece")))
    out = running(placed.withColumn("one", F.lit(1).cast("long")), ["shard"], [*key, "doc_id"], {"slot": "one"}, "kd-slots")
    return out.select("doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"))


def op9_kd_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = kd_shards(written(text_metadata(table(spark, sf_dir, "documents")), "kd-docs"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
