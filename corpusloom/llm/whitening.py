"""Embedding whitening from an exact scatter matrix in residues (operator 13).

Components c become longs x = floor(SCALE * c) + SHIFT. Each task adds up X'X of its
rows, a column of ones before them, modulo several primes below 2^20: products of
residues stay below 2^40, so that a float GEMM of 4,096 rows is exact. The residues
of a task are rows by prime and line of the matrix; Spark adds them up by (prime,
line, column). Chinese remaindering then gives the count, the sums S and the scatter
T as integers of any size, as many primes as the largest component and the count ask
for, and n T - S S' is n^2 times the covariance without any rounding. Its eigenvectors
are found twice: the matrix turned by the first ones, in longer floats, is nearly
diagonal, and the second ones correct the first.

Only the matrices come to the driver: their size follows the dimensions, not the rows.

Cases: vectors that are null or hold null or non-finite components are left out; empty
or shorter ones count as filled up with zeros; rows without a vec_id count and come
back without one; repeated rows count as often as they come; extra columns are passed
over; an empty table gives no rows. Directions without variance (equal vectors, more
dimensions than vectors) have no unit scale: they whiten to 0 and are left out of
identity_error. Of equal eigenvalues any eigenvectors are taken. A component of 2^52 or
more after scaling raises OverflowError. deviation is null where it fits no long;
deviation_exact holds it, to 38 digits.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written
from .vectors import as_lists, gathered, kept, matrix, scaled, shape

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
#: Residues are below 2^20; so many rows keep a sum of their products below 2^53.
LIMIT, ROWS = 1 << 20, 4096


def primes(least: int) -> list[int]:
    """The largest primes below LIMIT whose product is beyond least, falling."""
    found, product, p = [], 1, LIMIT - 1
    while product <= least:
        if all(p % q for q in range(3, int(p**0.5) + 1, 2)):
            found.append(p)
            product *= p
        p -= 2
    return found


def residues(x: np.ndarray, moduli: list[int]) -> list[np.ndarray]:
    """X'X of rows of longs modulo each prime."""
    out = []
    for p in moduli:
        total = np.zeros((x.shape[1], x.shape[1]), np.int64)
        for i in range(0, len(x), ROWS):
            r = (x[i : i + ROWS] % p).astype(np.float64)
            total = (total + (r.T @ r).astype(np.int64)) % p
        out.append(total)
    return out


def remaindered(parts: list[np.ndarray], moduli: list[int]) -> np.ndarray:
    """The integers, of magnitudes below half the product of the primes, that have these residues."""
    product = 1
    for p in moduli:
        product *= p
    total = np.zeros(parts[0].shape, object)
    for part, p in zip(parts, moduli):
        rest = product // p
        total = total + part.astype(object) * (rest * pow(rest, -1, p))
    total = total % product
    return np.where(total > product // 2, total - product, total)


def scatter(rows: DataFrame, dim: int, most: int, n: int, scale: int = SCALE, shift: int = SHIFT) -> np.ndarray:
    """Sums of products of (1, x) with itself over rows(v), exactly: the count, the sums, the scatter. most: a bound of |x|."""
    moduli = primes(2 * max(1, n) * max(1, most) ** 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros((dim + 1, dim + 1), np.int64) for _ in moduli]
        for b in gathered(batches):
            x = np.ones((b.num_rows, dim + 1), np.int64)
            x[:, 1:] = scaled(matrix(b.column(0), dim), scale, shift)
            total = [(t + r) % p for t, r, p in zip(total, residues(x, moduli), moduli)]
        for k, t in enumerate(total):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(dim + 1, k, np.int32)), pa.array(np.arange(dim + 1, dtype=np.int32)), as_lists(t)], ["prime", "line", "line_sums"])

    # Sums of residues of up to 2^43 tasks fit a long.
    parts = rows.select("v").mapInArrow(run, "prime int, line int, line_sums array<long>").select("prime", "line", F.posexplode("line_sums"))
    found = parts.groupBy("prime", "line", "pos").agg(F.sum("col").alias("r")).toPandas()
    grid = np.zeros((len(moduli), dim + 1, dim + 1), np.int64)
    grid[found["prime"], found["line"], found["pos"]] = found["r"].to_numpy() % np.array(moduli)[found["prime"]]
    return remaindered(list(grid), moduli)


def covariance(total: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """The count, the sums, and n^2 times the covariance, as exact integers, of what scatter() gives."""
    n, s = int(total[0, 0]), total[0, 1:]
    return n, s, n * total[1:, 1:] - s[:, None] * s[None, :]


def eigen(exact: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Falling eigenvalues and eigenvectors (columns) of exact / n^2, and its trace."""
    v = np.array([[x / (n * n) for x in line] for line in exact], np.float64).reshape(exact.shape)
    _, q = np.linalg.eigh(v)
    turned = (q.T.astype(np.longdouble) @ v.astype(np.longdouble) @ q.astype(np.longdouble)).astype(np.float64)
    e, again = np.linalg.eigh((turned + turned.T) / 2)
    q = (q.astype(np.longdouble) @ again.astype(np.longdouble)).astype(np.float64)
    q /= np.sqrt((q * q).sum(0))
    order = np.argsort(-e, kind="stable")
    e, q = e[order], q[:, order]
    sign = np.sign(q[np.abs(q).argmax(0), np.arange(q.shape[1])])  # an eigenvector has two; the largest entry is positive
    return e, q * np.where(sign == 0, 1, sign), float(sum(exact.diagonal()) / (n * n))


class Whitener:
    """What whitens vectors: the exact count, sums and covariance of the fit list, and its first components."""

    def __init__(self, rows: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT):
        """rows(v): the fit list, as kept() gives it."""
        n, self.dim, largest = shape(rows)
        if scale * largest + shift >= 2**52:
            raise OverflowError("a component of 2^52 or more in magnitude after scaling")
        self.scale, self.shift, self.most = scale, shift, int(scale * largest) + abs(shift) + 1
        total = scatter(rows, self.dim, self.most, n, scale, shift)
        self.n, self.sums, exact = covariance(total)
        k = min(components, self.dim) if self.n else 0
        e, q, self.trace = eigen(exact, self.n) if self.n else (np.zeros(0), np.zeros((self.dim, 0)), 0.0)
        self.values, self.axes = e[:k], q[:, :k]
        self.varies = self.values > 64 * np.finfo(float).eps * self.dim * max(self.trace, 0.0)
        self.weights = np.where(self.varies, self.axes / np.sqrt(np.where(self.varies, self.values, 1.0)), 0.0)
        self.explained = [float(x / self.trace) if self.trace > 0 else 0.0 for x in self.values]

    def apply(self, rows: DataFrame) -> DataFrame:
        """rows(id, v) as id, deviation_exact (sum of (n x - S)^2), whitened (one number a component)."""
        n, dim, scale, shift, weights = self.n, self.dim, self.scale, self.shift, self.weights
        # |n x - S| is at most 2 n most, in longs or else in integers of any size.
        sums, narrow = self.sums, 2 * n * self.most < 2**31 and dim * (2 * n * self.most) ** 2 < 2**63
        fits = 2 * n * self.most < 2**63

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in gathered(batches):
                x = scaled(matrix(b.column(1), dim), scale, shift)
                d = n * x - sums.astype(np.int64) if fits else n * x.astype(object) - sums
                if narrow or fits and float(np.abs(d).max(initial=0)) ** 2 * dim < 2**62:
                    squares = (d * d).sum(1)
                else:
                    squares = (d.astype(object) ** 2).sum(1)
                centred = d.astype(np.float64) / n
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([Decimal(int(s)) for s in squares], pa.decimal128(38, 0)), as_lists(centred @ weights)], ["id", "deviation_exact", "whitened"])

        return rows.select("id", "v").mapInArrow(run, "id long, deviation_exact decimal(38,0), whitened array<double>")

    def identity_error(self, whitened: DataFrame) -> float:
        """The largest absolute entry of the covariance of whitened(whitened), centred by Spark's own means, less the identity."""
        use = np.flatnonzero(self.varies)
        pairs = [(int(i), int(j)) for i in use for j in use if i <= j]
        if not pairs:
            return 0.0
        got = whitened.agg(*[F.covar_pop(F.get("whitened", F.lit(i)), F.get("whitened", F.lit(j))).alias(f"c{i}_{j}") for i, j in pairs]).first()
        return max(abs(got[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whitened(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error, deviation_exact: a row for each vector and component."""
    rows = kept(vectors, vec_col, F.col(id_col).cast("long").alias("id"))
    fitted = Whitener(rows, components, scale, shift)
    done = written(fitted.apply(rows), "whitened")
    error = fitted.identity_error(done)
    explained = F.element_at(F.array(*[F.lit(x) for x in fitted.explained or [0.0]]), F.col("component"))
    return done.select("id", "deviation_exact", F.posexplode("whitened").alias("at", "whitened")).withColumn("component", (F.col("at") + 1).cast("int")).select(
        F.col("id").alias("vec_id"), "component", F.lit(fitted.n).cast("long").alias("n"), F.expr("try_cast(deviation_exact AS long)").alias("deviation"),
        "whitened", explained.alias("explained"), F.lit(error).alias("identity_error"), "deviation_exact",
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector of embeddings on the first 8 whitened components."""
    return whitened(table(spark, sf_dir, "embeddings"))
