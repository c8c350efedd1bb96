"""Nearest neighbours from randomly rotated one-bit codes (operator 11).

Rows belong to the nearest of a few centres c. With d = |x - c| and u = (x - c) / d,
u is filled up with zeros to BITS dimensions and turned by one random rotation R; its
code is the signs of Ru, packed, b = signs / sqrt(BITS) is a unit vector, and the
correction scalar is a = <b, Ru>. For a query's unit vector v about the same centre,
<b, Rv> / a estimates <u, v> without bias, as what b misses of u points anywhere across
it: the error is about normal with a deviation of sqrt((1 - a^2) / (a^2 (BITS - 1))).
EPSILON deviations bound it, so the squared distance d^2 + e^2 - 2 d e <u, v> has a
lower bound from the code and three numbers, and only rows whose bound is within the
reach of the query's k best so far are compared in full.

Passes: each query searches the rows of its own centre; its k-th distance there is a
reach r; other centres are visited unless the triangle inequality puts all their rows
beyond r. Rows are packed by centre and cut into slices, queries into groups, and every
(slice, group) that has to meet is one cogroup of bounded size: no task holds a centre.
Within a cogroup the reach shrinks as slices of LEAF rows are compared. Each cogroup
gives the k best of each query; a window by query takes the k best of these.

The fit (centres) uses a bounded sample of SAMPLE vectors; every row is indexed. The
chance that a bound fails is below 3e-7 for each of the true neighbours, so the result is
in practice the exact one; `tests/llm` measures its recall against brute force.

Cases: vectors that are null, empty, all zero, or hold null or non-finite components take
no part, nor do rows without a vec_id; vectors of unequal length are filled up with zeros;
equal vec_ids are one query (the smallest vector) and one row for "not the query's own", and
candidates each; repeated rows are candidates each; ties go to the smaller vec_id; fewer than k
candidates give all of them; an empty table, no queries or no candidates give no rows; extra
columns are passed over. Distances beyond a double are infinite and come last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written
from .vectors import gathered, kept, matrix, shape

K, EVERY = 10, 100
BITS, EPSILON = 256, 5.0
CENTRES, SAMPLE = 64, 4096
#: Bytes of vectors to a partition of the index; rows to a slice, which may have one pack more, and to a step in a cogroup; queries to a group.
BYTES, SLICE, LEAF, GROUP = 1 << 23, 8192, 1024, 1024
#: Shares of the largest norms that rounding stays below: of doubles, and of the codes' products in floats.
_SLACK, _LOOSE = 1e-9, 1e-5


def rotation(dim: int, bits: int, seed: int = 11) -> np.ndarray:
    """dim orthonormal rows of `bits` columns: the part of a random rotation that acts on vectors filled up with zeros."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(seed)).standard_normal((bits, dim)))
    return (q * np.sign(np.where(r.diagonal() == 0, 1, r.diagonal()))).T


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, (x * x).sum(1)[:, None] + (c * c).sum(1)[None] - 2 * x @ c.T))


def exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Euclidean distances of paired rows, added up in the order of the dimensions."""
    total = np.zeros(len(x))
    for j in range(x.shape[1]):
        total += (x[:, j] - q[:, j]) ** 2
    return np.sqrt(total)


def centres_of(sample: np.ndarray, n: int, rounds: int = 5) -> np.ndarray:
    """Means of n groups of the sample, at most one for every 32 vectors."""
    n = max(1, min(n, len(sample) // 32))
    c = sample[np.linspace(0, len(sample) - 1, n).astype(int)] if len(sample) else np.zeros((1, sample.shape[1]))
    for _ in range(rounds if n > 1 else 0):
        own = distances(sample, c).argmin(1)
        c = np.stack([sample[own == i].mean(0) if (own == i).any() else c[i] for i in range(n)])
    return c if n > 1 or not len(sample) else sample.mean(0, keepdims=True)


def coded(x: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, distance to the centre and alignment <b, Ru> of each row."""
    rest = x - centre
    d = np.sqrt((rest * rest).sum(1))
    turned = (rest / np.where(d > 0, d, 1.0)[:, None]) @ turn
    align = np.where(d > 0, np.abs(turned).sum(1) / np.sqrt(turn.shape[1]), 1.0)
    return np.packbits(turned >= 0, axis=1), d, align


def lower_bounds(signs: np.ndarray, d: np.ndarray, align: np.ndarray, q: np.ndarray, centre: np.ndarray, turn: np.ndarray, epsilon: float = EPSILON) -> np.ndarray:
    """Of the distances of all queries (rows) to all coded vectors (columns), from bits and scalars."""
    bits = turn.shape[1]
    rest = q - centre
    e = np.sqrt((rest * rest).sum(1))
    turned = ((rest / np.where(e > 0, e, 1.0)[:, None]) @ turn).astype(np.float32)
    # <b, Rv> = (2 * sum of Rv over the bits that are set - sum of Rv) / sqrt(bits)
    product = (2 * (turned @ np.unpackbits(signs, axis=1, count=bits).astype(np.float32).T) - turned.sum(1)[:, None]) / np.float32(np.sqrt(bits))
    error = epsilon * np.sqrt(np.maximum(0.0, 1 - align * align) / max(1, bits - 1)) / align + _LOOSE
    cosine = np.minimum(1.0, product / align[None] + error[None])
    return np.sqrt(np.maximum(0.0, (d * d)[None] + (e * e)[:, None] - 2 * e[:, None] * d[None] * cosine)) * (1 - _SLACK)


class Best:
    """The k best candidates so far of each of a group of queries."""

    def __init__(self, q_ids: np.ndarray, reach: np.ndarray, k: int):
        self.q_ids, self.k, self.reach = q_ids, k, reach.copy()
        self.rows, self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def add(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        rows, ids, scores = np.concatenate([self.rows, rows]), np.concatenate([self.ids, ids]), np.concatenate([self.scores, scores])
        order = np.lexsort((ids, scores, rows))
        rows, ids, scores = rows[order], ids[order], scores[order]
        start = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else np.zeros(0, np.int64)
        place = np.arange(len(rows)) - np.repeat(start, np.diff(np.r_[start, len(rows)]))
        last = place == self.k - 1
        self.reach[rows[last]] = np.minimum(self.reach[rows[last]], scores[last])
        top = place < self.k
        self.rows, self.ids, self.scores = rows[top], ids[top], scores[top]


class Index:
    """The one-bit index of a table of vectors: packs(pack, centre, n, far, near, ids, x, signs, d, align), one row for each partition and centre."""

    def __init__(self, vectors: DataFrame, vec_col: str = "embedding", id_col: str = "vec_id", bits: int = BITS, centres: int = CENTRES, sample: int = SAMPLE):
        self.spark = vectors.sparkSession
        rows = kept(vectors, vec_col, F.col(id_col).cast("long").alias("id")).filter(F.col("id").isNotNull() & F.exists("v", lambda x: x != 0))
        n, self.dim, _ = shape(rows)
        self.bits = -(-max(bits, self.dim) // 64) * 64
        self.turn = turn = rotation(self.dim, self.bits)
        drawn = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, sample / max(1, n)))
        few = rows.filter(drawn).select("v").limit(2 * sample).toArrow()
        few = matrix(few.column("v"), self.dim) if len(few) else np.zeros((0, self.dim))
        self.centres = c = centres_of(few[np.lexsort(few.T)], centres)
        dim, self.rows = self.dim, rows
        most = max(64, BYTES // (8 * dim))

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in gathered(batches, most):
                ids, x = b.column(0).to_numpy(zero_copy_only=False), matrix(b.column(1), dim)
                own = distances(x, c).argmin(1)
                out = []
                for i in np.unique(own):
                    at = np.flatnonzero(own == i)
                    signs, d, align = coded(x[at], c[i], turn)
                    out.append((int(i), len(at), float(d.min()), float(d.max()), ids[at].tobytes(), x[at].tobytes(), signs.tobytes(), d.tobytes(), align.tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate([pa.int32(), pa.int32(), pa.float64(), pa.float64(), *[pa.binary()] * 5])], ["centre", "n", "near", "far", "ids", "x", "signs", "d", "align"])

        dealt = rows.repartition(max(1, -(-n // most)))
        packs = dealt.mapInArrow(pack, "centre int, n int, near double, far double, ids binary, x binary, signs binary, d binary, align binary")
        packs = written(packs.withColumn("pack", F.monotonically_increasing_id()), "onebit-packs")
        # Slices: packs of a centre, counted up in any order. Only numbers of packs go through the window, not their contents.
        counted = packs.select("pack", "centre", "n").withColumn("slice", F.floor((F.sum("n").over(Window.partitionBy("centre").orderBy("pack")) - F.col("n")) / SLICE).cast("int"))
        self.packs = written(packs.join(counted.select("pack", "slice"), "pack"), "onebit-index")
        # One row a centre: a bound of the index.
        known = {r.centre: (r.slices, r.near, r.far) for r in self.packs.groupBy("centre").agg((F.max("slice") + 1).alias("slices"), F.min("near").alias("near"), F.max("far").alias("far")).collect()}
        self.slices, self.near, self.far = (np.array([known.get(i, (0, np.inf, -np.inf))[k] for i in range(len(c))]) for k in range(3))

    def grouped(self, queries: DataFrame) -> DataFrame:
        """queries(id, v) in groups of up to GROUP of like ones: grp, home (nearest centres), q_ids, q."""
        c, dim = self.centres, self.dim

        def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in gathered(batches):
                own = distances(matrix(b.column(1), dim), c).argmin(1)
                yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), b.column(0), b.column(1)], ["home", "id", "v"])

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in gathered(batches, GROUP):
                own, ids, q = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False), matrix(b.column(2), dim)
                for i in range(0, len(ids), GROUP):
                    s = slice(i, i + GROUP)
                    yield pa.RecordBatch.from_arrays([pa.array([a[s].tobytes()], pa.binary()) for a in (own, ids, q)], ["home", "q_ids", "q"])

        homed = queries.mapInArrow(home, "home int, id long, v array<double>")
        near = homed.repartitionByRange(max(1, -(-queries.count() // GROUP)), "home", "id").sortWithinPartitions("home", "id")
        return written(near.mapInArrow(pack, "home binary, q_ids binary, q binary").withColumn("grp", F.monotonically_increasing_id()), "onebit-queries")

    def search(self, groups: DataFrame, k: int, first: bool) -> DataFrame:
        """query_id, vec_id, score: the k best of each query in each cogroup; compared: how many rows that cogroup compared, on its first row.

        groups: grp, home, q_ids, q; after the first pass reach too. first: queries visit their own centre, else all others in reach.
        """
        c, dim, turn, near, far, slices = self.centres, self.dim, self.turn, self.near, self.far, self.slices

        def plan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                for r in f.itertuples(index=False):
                    q, ids = np.frombuffer(r.q).reshape(-1, dim), np.frombuffer(r.q_ids, np.int64)
                    reach = np.full(len(q), np.inf) if first else np.frombuffer(r.reach)
                    d = distances(q, c)
                    slack = _LOOSE * (d + np.where(np.isfinite(far), far, 0.0)[None])
                    # |q - x| is at least |q - c| - far and near - |q - c|; not(beyond) keeps what isn't a number.
                    beyond = (d - far[None] - slack > reach[:, None]) | (near[None] - d - slack > reach[:, None])
                    visit = np.zeros(d.shape, bool)
                    visit[np.arange(len(q)), np.frombuffer(r.home, np.int32)] = True
                    visit = visit if first else ~visit & ~beyond
                    for i in np.flatnonzero(visit.any(0) & (slices > 0)):
                        at = np.flatnonzero(visit[:, i])
                        yield pd.DataFrame({"centre": np.int32([i]), "slices": np.int32([slices[i]]), "grp": [r.grp], "q_ids": [ids[at].tobytes()], "q": [q[at].tobytes()], "reach": [reach[at].tobytes()]})

        def meet(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            out, compared = [], 0
            for g in left.itertuples(index=False):
                q, q_ids = np.frombuffer(g.q).reshape(-1, dim), np.frombuffer(g.q_ids, np.int64)
                best = Best(q_ids, np.frombuffer(g.reach), k)
                for p in right.itertuples(index=False):
                    ids, x, d, align = np.frombuffer(p.ids, np.int64), np.frombuffer(p.x).reshape(-1, dim), np.frombuffer(p.d), np.frombuffer(p.align)
                    signs = np.frombuffer(p.signs, np.uint8).reshape(len(ids), -1)
                    for i in range(0, len(ids), LEAF):
                        s = slice(i, i + LEAF)
                        low = lower_bounds(signs[s], d[s], align[s], q, c[p.centre], turn)
                        if np.isinf(best.reach).any() and len(ids[s]) > k:
                            # Without a reach the rows of the k + 1 lowest bounds (one may be the query itself) give one.
                            some = np.argpartition(low, k, 1)[:, : k + 1]
                            trial = np.sort(exact(np.repeat(q, k + 1, 0), x[s][some.ravel()]).reshape(len(q), -1) + np.where(ids[s][some] == q_ids[:, None], np.inf, 0), 1)[:, k - 1]
                            compared += some.size
                            best.reach = np.minimum(best.reach, trial)
                        row, at = np.nonzero(~(low > best.reach[:, None]) & (ids[s][None] != q_ids[:, None]))
                        compared += len(row)
                        score = exact(q[row], x[s][at])
                        fine = ~(score > best.reach[row])
                        best.add(row[fine], ids[s][at[fine]], score[fine])
                out.append(pd.DataFrame({"query_id": q_ids[best.rows], "vec_id": best.ids, "score": best.scores}))
            found = pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
            found["compared"] = np.where(np.arange(len(found)) == 0, compared, 0)
            return found.astype({"query_id": np.int64, "vec_id": np.int64, "compared": np.int64})

        columns = "centre int, slices int, grp long, q_ids binary, q binary, reach binary"
        asked = written(groups.mapInPandas(plan, columns), "onebit-asked").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        # The packs of a slice go to each group that asks for it: as many copies as groups of queries, which are bounded.
        pairs = asked.select(F.col("centre").alias("at_centre"), F.col("slice").alias("at_slice"), F.col("grp").alias("for_grp"))
        wanted = pairs.join(self.packs.drop("pack", "n", "near", "far"), (F.col("at_centre") == F.col("centre")) & (F.col("at_slice") == F.col("slice")))
        return asked.drop("slices").groupBy("centre", "slice", "grp").cogroup(wanted.groupBy("at_centre", "at_slice", "for_grp")).applyInPandas(meet, "query_id long, vec_id long, score double, compared long")


def ranked(found: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of each query."""
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def searched(vectors: DataFrame, is_query: Column, k: int = K, vec_col: str = "embedding", id_col: str = "vec_id", **index) -> tuple[Index, DataFrame]:
    """The index, and what both passes found: query_id, vec_id, score, compared. is_query: a condition on id."""
    built = Index(vectors, vec_col, id_col, **index)
    groups = built.grouped(built.rows.filter(is_query).groupBy("id").agg(F.min("v").alias("v")))
    seeds = written(built.search(groups, k, True), "onebit-first")
    reach = ranked(seeds, k).filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("reach"))

    def ids(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.itertuples(index=False):
                own = np.frombuffer(r.q_ids, np.int64)
                yield pd.DataFrame({"grp": np.full(len(own), r.grp), "id": own, "at": np.arange(len(own), dtype=np.int32)})

    def reached(f: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"grp": f["grp"].iloc[:1], "reach": [f.sort_values("at")["reach"].fillna(np.inf).to_numpy(float).tobytes()]})

    bounds = groups.select("grp", "q_ids").mapInPandas(ids, "grp long, id long, at int").join(reach, "id", "left").groupBy("grp").applyInPandas(reached, "grp long, reach binary")
    return built, seeds.unionByName(built.search(written(groups.join(bounds, "grp"), "onebit-reach"), k, False))


def nearest(vectors: DataFrame, is_query: Column, k: int = K, **settings) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest candidates of every query row."""
    return ranked(searched(vectors, is_query, k, **settings)[1], k)


def op11_one_bit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every row of embeddings whose vec_id is divisible by 100."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % EVERY == 0, K)


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS c FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0 AND len([x for x in embedding if x <> 0]) > 0
), s AS (
  SELECT q.vec_id AS query_id, x.vec_id, sqrt(list_reduce([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(q.c, x.c)], lambda a, b: a + b)) AS score FROM v q JOIN v x ON q.vec_id % 100 = 0 AND q.vec_id <> x.vec_id
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
