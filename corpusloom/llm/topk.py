"""Exact top-k search by inner product over a pivot-distance index (operator 1).

Vectors x are lifted to x' = (x, sqrt(M^2 - |x|^2)), M the largest norm, so that
|q' - x'|^2 = M^2 + |q|^2 - 2 q.x and the best scores are the nearest neighbours.
Each vector is keyed by its nearest pivot and its distance to it; rows of one
pivot are cut into annuli of equal width, sorted by distance and packed into
blocks. A query first searches the annuli around itself at its own pivot; its
k-th score so far is a radius r, and by the triangle inequality a vector of
pivot p can only be better if its distance to p lies within r of the query's.
The annuli that such a range meets are searched; rows outside it are cut off by
bisection. Everything beyond is proven worse, so the result is exact.

Pivots come from a bounded sample (SAMPLE vectors, a draw by hash); all rows are
indexed, at most PIVOTS times ANNULI annuli (the bound of what the driver keeps of
it). Blocks hold about BLOCK rows: a crowded annulus is salted by vec_id, queries go
to each of its blocks, packed in groups, and each block returns its own k best.

Cases: vectors that are null, empty, or hold null or non-finite components take
no part, nor do rows without a vec_id; equal vec_ids are one vector for "not the
query's own" and stay rows of their own otherwise; ties go to the smaller vec_id;
fewer than k candidates give all of them; vectors of unequal length are padded
with zeros; an empty table, no queries or no candidates give no rows; repeated rows
are candidates each; extra columns are passed over. Scores are exact: a best score
that does not fit a long, or a component of 2^53 or more, raises OverflowError.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

SCALE, K, EVERY = 1024, 10, 100
PIVOTS, ANNULI, SAMPLE, BLOCK, GROUP = 16, 8, 2048, 2048, 128
_SLACK, LOWEST = 1e-6, 1 - 2**63


def _scaled(col: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """floor(1024 x) of every vector that counts, as rows of int64, and which rows those are."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    flat = col.flatten().cast(pa.float64())
    values = flat.to_numpy(zero_copy_only=False)
    if flat.null_count:
        values = np.where(flat.is_null().to_numpy(zero_copy_only=False), np.nan, values)
    sizes = col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(n), sizes)
    at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    ok = (sizes > 0) & ~np.isin(np.arange(n), row[~np.isfinite(values)])
    out = np.zeros((n, dim), np.int64)
    use = ok[row] & (at < dim)
    whole = np.floor(SCALE * values[use])
    if len(whole) and np.abs(whole).max() >= 2.0**63:
        raise OverflowError("a component of 2^53 or more in magnitude: its scores do not fit a long")
    out[row[use], at[use]] = whole.astype(np.int64)
    return out[ok], np.flatnonzero(ok)


def lifted(x: np.ndarray, most: float) -> np.ndarray:
    x = x.astype(np.float64)
    return np.concatenate([x, np.sqrt(np.maximum(0.0, most * most - (x * x).sum(1)))[:, None]], 1)


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, (x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None] - 2 * x @ pivots.T))


def chosen_pivots(sample: np.ndarray, n: int, rounds: int = 6) -> np.ndarray:
    """Centres of n groups of the sample, from starts far apart."""
    if not len(sample):
        return np.zeros((1, sample.shape[1]))
    pick, far = [0], np.full(len(sample), np.inf)
    for _ in range(min(n, len(sample)) - 1):
        far = np.minimum(far, distances(sample, sample[pick[-1] :][:1])[:, 0])
        pick.append(int(far.argmax()))
    centres = sample[pick]
    for _ in range(rounds):
        own = distances(sample, centres).argmin(1)
        centres = np.stack([sample[own == i].mean(0) if (own == i).any() else centres[i] for i in range(len(centres))])
    return centres


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of long integers: in floats or longs where no sum can leave them, else in unbounded integers."""
    bound = float(np.abs(x.astype(np.float64)).max(initial=0)) * float(np.abs(q.astype(np.float64)).max(initial=0)) * max(1, x.shape[1])
    if bound < 2**53:
        return (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)
    return q @ x.T if bound < 2**62 else q.astype(object) @ x.T.astype(object)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the k highest scores, ties to the smaller id, in order."""
    if scores.dtype == object:
        return np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k], np.int64)
    if len(ids) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= least)
        return keep[np.lexsort((ids[keep], -scores[keep]))[:k]]
    return np.lexsort((ids, -scores))[:k]


class Index:
    """The pivot-distance index of a table of vectors: blocks(pivot, annulus, ids, dists, data), and what is needed to search it."""

    def __init__(self, vectors: DataFrame, vec_col: str = "embedding", id_col: str = "vec_id", pivots: int = PIVOTS, annuli: int = ANNULI, block: int = BLOCK):
        self.spark, self.annuli = vectors.sparkSession, annuli
        rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v")).filter("vec_id is not null and v is not null")
        self.dim = dim = int(rows.agg(F.max(F.size("v"))).first()[0] or 1)

        def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x, ok = _scaled(b.column(1), dim)
                small = x.astype(np.int32) if not len(x) or np.abs(x).max() < 2**31 else x
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(ok)), pa.array((x.astype(float) ** 2).sum(1)), pa.array([r.tobytes() for r in small], pa.binary())], ["vec_id", "norm2", "x"])

        self.scaled = written(rows.mapInArrow(scale, "vec_id long, norm2 double, x binary"), "topk-scaled")
        n, most2 = self.scaled.agg(F.count("*"), F.max("norm2")).first()
        self.most = most = float(most2 or 0.0) ** 0.5
        drawn = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE / max(1, n)))
        sample = lifted(self.decode(self.scaled.filter(drawn).select("x").toPandas()["x"], dim), most)
        self.pivots = centres = chosen_pivots(sample[np.lexsort(sample.T)], pivots)
        self.width = width = max(1e-9, float(distances(sample, centres).min(1).max()) if len(sample) else 1.0) / annuli
        decode = self.decode

        def key(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                d = distances(lifted(decode(f["x"], dim), most), centres)
                own = d.argmin(1)
                near = d[np.arange(len(d)), own]
                yield pd.DataFrame({"pivot": own.astype(np.int32), "annulus": np.minimum(near / width, annuli - 1).astype(np.int32), "vec_id": f["vec_id"], "dist": near, "x": f["x"]})

        keyed = self.scaled.select("vec_id", "x").mapInPandas(key, "pivot int, annulus int, vec_id long, dist double, x binary")
        # One row for each pivot and annulus: a bound of the index.
        crowd = keyed.groupBy("pivot", "annulus").agg(F.ceil(F.count("*") / block).cast("int").alias("salts")).collect()
        self.salts = np.zeros((len(centres), annuli), np.int32)
        for r in crowd:
            self.salts[r.pivot, r.annulus] = r.salts
        salts = F.element_at(F.array(*[F.lit(int(x)) for x in self.salts.reshape(-1)]), F.col("pivot") * annuli + F.col("annulus") + 1)
        keyed = keyed.withColumn("salt", F.pmod(F.xxhash64("vec_id"), salts).cast("int"))

        def pack(f: pd.DataFrame) -> pd.DataFrame:
            f = f.sort_values(["dist", "vec_id"])
            return pd.DataFrame({"pivot": f["pivot"].iloc[:1], "annulus": f["annulus"].iloc[:1], "salt": f["salt"].iloc[:1], "ids": [f["vec_id"].to_numpy(np.int64).tobytes()], "dists": [f["dist"].to_numpy().tobytes()], "data": [decode(f["x"], dim).tobytes()]})

        self.blocks = written(keyed.groupBy("pivot", "annulus", "salt").applyInPandas(pack, "pivot int, annulus int, salt int, ids binary, dists binary, data binary"), "topk-blocks")

    @staticmethod
    def decode(col: pd.Series, dim: int) -> np.ndarray:
        return np.stack([np.frombuffer(x, np.int32 if len(x) == 4 * dim else np.int64).astype(np.int64) for x in col]) if len(col) else np.zeros((0, dim), np.int64)

    def visit(self, queries: DataFrame, first: bool) -> DataFrame:
        """Joins queries(vec_id, x, least) to the blocks of the annuli they have to search; packed, a row for each block."""
        dim, most, centres, width, annuli, decode, salts = self.dim, self.most, self.pivots, self.width, self.annuli, self.decode, self.salts

        def plan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                if not len(f):
                    continue
                q = decode(f["x"], dim)
                q2 = np.concatenate([q.astype(float), np.zeros((len(q), 1))], 1)
                d = distances(q2, centres)
                ring = np.clip(d / width, 0, annuli - 1).astype(np.int64)
                own = d.argmin(1)
                least = f["least"].to_numpy(float)
                if first:
                    low, high = np.full_like(d, np.inf), np.full_like(d, -np.inf)
                    r = np.arange(len(q))
                    low[r, own], high[r, own] = (ring[r, own] - 1) * width, (ring[r, own] + 2) * width
                    low[r, own], high[r, own] = np.minimum(low[r, own], (annuli - 2) * width), np.where(ring[r, own] >= annuli - 2, np.inf, high[r, own])
                else:
                    reach = np.where(np.isfinite(least), np.sqrt(np.maximum(0.0, most * most + (q2 * q2).sum(1) - 2 * np.where(np.isfinite(least), least, 0))), np.inf)
                    # Squares of the norms cancel out in distances and reach: their rounding is a share of the norms.
                    reach = reach * (1 + _SLACK) + _SLACK + 1e-7 * (most + np.sqrt((q2 * q2).sum(1)))
                    low, high = d - reach[:, None], d + reach[:, None]
                ids = f["vec_id"].to_numpy(np.int64)
                for p in range(len(centres)):
                    for a in range(annuli):
                        hit = np.flatnonzero((low[:, p] < (a + 1) * width if a < annuli - 1 else low[:, p] < np.inf) & (high[:, p] >= a * width))
                        for i in range(0, len(hit), GROUP):
                            h = hit[i : i + GROUP]
                            yield pd.DataFrame({"pivot": np.int32([p]), "annulus": np.int32([a]), "salts": salts[p, a : a + 1], "q_ids": [ids[h].tobytes()], "q_data": [q[h].tobytes()], "q_low": [low[h, p].tobytes()], "q_high": [high[h, p].tobytes()]})

        asked = queries.mapInPandas(plan, "pivot int, annulus int, salts int, q_ids binary, q_data binary, q_low binary, q_high binary")
        asked = asked.filter("salts > 0").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
        return self.blocks.join(asked.hint("merge"), ["pivot", "annulus", "salt"])

    def search(self, queries: DataFrame, k: int, first: bool) -> DataFrame:
        """query_id, ids, scores, scored: the k best of each visited block, and how many of its rows were compared."""
        dim = self.dim

        def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                out = []
                for r in f.itertuples(index=False):
                    ids, dist, x = np.frombuffer(r.ids, np.int64), np.frombuffer(r.dists), np.frombuffer(r.data, np.int64).reshape(-1, dim)
                    qi, q, low, high = np.frombuffer(r.q_ids, np.int64), np.frombuffer(r.q_data, np.int64).reshape(-1, dim), np.frombuffer(r.q_low), np.frombuffer(r.q_high)
                    i, j = np.searchsorted(dist, low.min(), "left"), np.searchsorted(dist, high.max(), "right")
                    ids, dist, x = ids[i:j], dist[i:j], x[i:j]
                    if not len(ids):
                        continue
                    s = products(q, x)
                    for t in range(len(qi)):
                        a, b = np.searchsorted(dist, low[t], "left"), np.searchsorted(dist, high[t], "right")
                        own, sc = ids[a:b], s[t, a:b]
                        other = own != qi[t]
                        if not other.all():
                            own, sc = own[other], sc[other]
                        top = best(own, sc, k)
                        if len(top):
                            # A score that is too low for a long counts in none but the shortest lists: see `merged`.
                            sc = np.array([max(s, LOWEST) for s in sc[top]], object) if sc.dtype == object else sc[top]
                            if sc.dtype == object and max(sc) >= 2**63:
                                raise OverflowError("a score among the best does not fit a long")
                            out.append((qi[t], own[top].tobytes(), sc.astype(np.int64).tobytes(), b - a))
                yield pd.DataFrame(out, columns=["query_id", "ids", "scores", "scored"])

        return self.visit(queries, first).mapInPandas(score, "query_id long, ids binary, scores binary, scored long")


def merged(found: DataFrame, k: int, last: bool = True) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all blocks of a query; last: these are results, and have to fit a long."""

    def top(f: pd.DataFrame) -> pd.DataFrame:
        ids, scores = (np.concatenate([np.frombuffer(x, np.int64) for x in f[c]]) for c in ("ids", "scores"))
        order = best(ids, scores, k)
        if last and len(order) and scores[order].min() == LOWEST:
            raise OverflowError("a score among the best does not fit a long")
        return pd.DataFrame({"query_id": f["query_id"].iloc[0], "rank": np.arange(1, len(order) + 1, dtype=np.int32), "vec_id": ids[order], "score": scores[order]})

    return found.groupBy("query_id").applyInPandas(top, "query_id long, rank int, vec_id long, score long")


def top_k(vectors: DataFrame, is_query, k: int = K, **index) -> DataFrame:
    """The k best candidates of every query row (a condition on vec_id), exactly."""
    built, _, found = searched(vectors, is_query, k, **index)
    return merged(found, k)


def searched(vectors: DataFrame, is_query, k: int = K, **index) -> tuple[Index, DataFrame, DataFrame]:
    """The index, what the first pass found, which only bounds the second, and what the second found."""
    built = Index(vectors, **index)
    queries = built.scaled.filter(is_query).groupBy("vec_id").agg(F.min("x").alias("x"))
    seeds = built.search(queries.withColumn("least", F.lit(float("-inf"))), k, True)
    least = merged(seeds, k, False).filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("least"))
    bounded = written(queries.join(least, "vec_id", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf")))), "topk-bounds")
    return built, seeds, built.search(bounded, k, False)


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0, K)


OP1_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS c FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, x.vec_id, CAST(list_sum([a[1] * a[2] for a in list_zip(q.c, x.c)]) AS BIGINT) AS score
  FROM v q JOIN v x ON q.vec_id % 100 = 0 AND q.vec_id <> x.vec_id
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
