"""Vector code compression with annular norm pruning (operator 12).

Vectors of longs floor(SCALE * c) are cut into PARTS equal parts, each coded by the
nearest of ENTRIES codebook entries of its position. A codebook is sorted by norm.
For a part of norm r whose best distance so far is d, an entry can only be as near if
its norm lies in [r - d, r + d] (the triangle inequality), ends included as ties count.
The entry of the nearest norm gives the first d; bisection gives the annulus; entries
are taken from its middle outwards and d shrinks, until the next norm on either side
is outside. All that is inside is compared exactly, in longs.

Rounds: assign all parts, then replace each entry by the floors of its parts' means.
Tasks send sums and counts by (part, entry) only. The codebooks, PARTS x ENTRIES parts,
are on the driver and in each task: their size follows the dimensions, not the rows.

Cases: vectors that are null or hold null or non-finite components are dropped; shorter
and empty ones, and dimensions that PARTS doesn't divide, are filled up with zeros at the
end; rows without a vec_id come last in the first codebook; of equal vec_ids the smaller
vector first; fewer vectors than entries give as many entries; repeated rows count as often
as they come, and a codebook may start with equal entries, of which the first is used; rows
without a label are a label of their own; an empty table gives no rows; extra columns are
passed over. Components whose squared distances could leave a long raise OverflowError.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import long_or_last, salted_join, table, written
from .vectors import as_lists, gathered, kept, matrix, scaled, shape

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
#: A share of a norm that its rounding stays well below.
_SLACK = 1e-9


class Codebook:
    """The entries of one part position, sorted by norm."""

    def __init__(self, entries: np.ndarray):
        norms = np.sqrt((entries.astype(np.float64) ** 2).sum(1))
        self.order = np.lexsort((np.arange(len(entries)), norms))
        self.entries, self.norms = entries[self.order], norms[self.order]
        self.compared = 0

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (ties: the lower one) and squared distance, of each row of longs."""
        k, norms = len(self.norms), self.norms
        r = np.sqrt((x.astype(np.float64) ** 2).sum(1))
        slack = _SLACK * (r + norms[-1] + 1)
        middle = np.clip(np.searchsorted(norms, r), 0, k - 1)
        before = np.maximum(middle - 1, 0)
        middle = np.where(np.abs(norms[before] - r) < np.abs(norms[middle] - r), before, middle)
        best, label = np.full(len(x), np.iinfo(np.int64).max), np.full(len(x), np.iinfo(np.int64).max)

        def compare(rows: np.ndarray, at: np.ndarray) -> None:
            d = x[rows] - self.entries[at]
            d, own = (d * d).sum(1), self.order[at]
            self.compared += len(rows)
            better = (d < best[rows]) | (d == best[rows]) & (own < label[rows])
            best[rows[better]], label[rows[better]] = d[better], own[better]

        rows = np.arange(len(x))
        compare(rows, middle)
        low, high = middle - 1, middle + 1
        while len(rows):
            reach = np.sqrt(best[rows].astype(np.float64)) + slack[rows]
            first = np.searchsorted(norms, r[rows] - reach, "left")
            last = np.searchsorted(norms, r[rows] + reach, "right") - 1
            # From the middle outwards, the nearer norm of both sides first.
            down, up = low[rows] >= first, high[rows] <= last
            gap_down = np.where(down, r[rows] - norms[np.maximum(low[rows], 0)], np.inf)
            gap_up = np.where(up, norms[np.minimum(high[rows], k - 1)] - r[rows], np.inf)
            some = down | up
            rows, take_down = rows[some], (gap_down <= gap_up)[some]
            at = np.where(take_down, low[rows], high[rows])
            compare(rows, at)
            low[rows[take_down]] -= 1
            high[rows[~take_down]] += 1
        return label, best


def assigned(x: np.ndarray, books: list[Codebook]) -> tuple[np.ndarray, np.ndarray]:
    """Entry numbers by row and part, and squared distances."""
    width = x.shape[1] // len(books)
    found = [book.nearest(x[:, i * width : (i + 1) * width]) for i, book in enumerate(books)]
    return np.stack([c for c, _ in found], 1), np.stack([d for _, d in found], 1)


def digest(books: np.ndarray) -> str:
    """sha256 of all components in decimal, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


class Coder:
    """Codebooks (parts, entries, width) trained on rows(id, v)."""

    def __init__(self, rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE):
        _, dim, most = shape(rows)
        self.parts, self.scale, self.dim = parts, scale, -(-dim // parts) * parts
        width = self.dim // parts
        # The floor of a mean is no larger than the largest component, so no distance is beyond this.
        if self.dim * (2 * (scale * most + 1)) ** 2 >= 2**63:
            raise OverflowError("components so large that squared distances may leave a long")
        first = rows.orderBy(long_or_last("id"), F.col("id").isNull(), "v").limit(entries).select("v").toArrow()
        self.books = scaled(matrix(first.column("v"), self.dim), scale).reshape(-1, parts, width).transpose(1, 0, 2).copy()
        for _ in range(rounds if self.books.size else 0):
            self.books = self.moved(rows)

    def moved(self, rows: DataFrame) -> np.ndarray:
        """The codebooks with each entry that is used replaced by the floors of the means of its parts."""
        dim, scale, books = self.dim, self.scale, self.books
        parts, entries, width = books.shape

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = [Codebook(b) for b in books]
            total = np.zeros((parts * entries, width + 1), np.int64)
            for b in gathered(batches):
                x = scaled(matrix(b.column(0), dim), scale)
                code, _ = assigned(x, own)
                key = (code + np.arange(parts) * entries).ravel()
                np.add.at(total, key, np.concatenate([np.ones((len(key), 1), np.int64), x.reshape(-1, width)], 1))
            used = np.flatnonzero(total[:, 0])
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), as_lists(total[used])], ["key", "sums"])

        sums = rows.select("v").mapInArrow(run, "key int, sums array<long>").select("key", F.posexplode("sums")).groupBy("key", "pos").agg(F.sum("col").alias("s")).toPandas()
        total = np.zeros((parts * entries, width + 1), np.int64)
        total[sums["key"], sums["pos"]] = sums["s"]
        used = total[:, 0] > 0
        new = books.reshape(parts * entries, width).copy()
        new[used] = total[used, 1:] // total[used, :1]
        return new.reshape(books.shape)

    def encode(self, rows: DataFrame, *carried: str) -> DataFrame:
        """rows(*carried, v) as carried, codes (one byte a part), error (squared distances summed over parts), compared (entries)."""
        dim, scale, books = self.dim, self.scale, self.books
        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*carried).schema)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = [Codebook(b) for b in books]
            for b in gathered(batches):
                code, d = assigned(scaled(matrix(b.column(len(carried)), dim), scale), own)
                yield pa.RecordBatch.from_arrays([*b.columns[: len(carried)], pa.array([c.tobytes() for c in code.astype(np.uint8)], pa.binary()), pa.array(d.sum(1))], [*carried, "codes", "error"])

        return rows.select(*carried, "v").mapInArrow(run, f"{fields}, codes binary, error long")


def compressed(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", **settings) -> DataFrame:
    """vec_id, code (hex), error, label_error, codebooks_sha256 of every vector that counts."""
    label = F.col(label_col)
    # Nulls are one label: a key of two columns that are never null.
    unlabelled, key = label.isNull().alias("unlabelled"), F.coalesce(label, F.lit(0).cast(vectors.schema[label_col].dataType)).alias("key")
    rows = kept(vectors, vec_col, F.col(id_col).cast("long").alias("id"), unlabelled, key)
    coder = Coder(rows, **settings)
    coded = written(coder.encode(rows, "id", "unlabelled", "key"), "codes")
    by_label = coded.groupBy("unlabelled", "key").agg(F.sum("error").alias("label_error"))
    joined = salted_join(coded, by_label, ["unlabelled", "key"], ["id", "codes"], "inner")
    return joined.select(F.col("id").alias("vec_id"), F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(digest(coder.books)).alias("codebooks_sha256"))


def op12_annular(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of every vector of embeddings: 16 parts, 64 entries, 2 rounds."""
    return compressed(table(spark, sf_dir, "embeddings"))


def _assign(books: str, name: str) -> str:
    """CTE name: vec_id, part, k, d, x, nearest entries of all parts in books(part, k, c)."""
    return f"""{name} AS (SELECT row, part, arg_min(k, d * 64 + k) AS k, min(d) AS d, any_value(x) AS x FROM (
  SELECT p.row, p.part, b.k, p.x, CAST(list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(p.x, b.c)]) AS BIGINT) AS d FROM p JOIN {books} b ON b.part = p.part) GROUP BY row, part)"""


def _move(books: str, found: str, name: str) -> str:
    return f"""{name}_s AS (SELECT part, k, j, CAST(sum(v) - (sum(v) % count(*) + count(*)) % count(*) AS BIGINT) // count(*) AS v FROM (SELECT part, k, unnest(x) AS v, unnest(range(1, len(x) + 1)) AS j FROM {found}) GROUP BY part, k, j),
{name} AS (SELECT b.part, b.k, coalesce(m.c, b.c) AS c FROM {books} b LEFT JOIN (SELECT part, k, list(v ORDER BY j) AS c FROM {name}_s GROUP BY part, k) m USING (part, k))"""


OP12_SQL = f"""
WITH e AS (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS row, vec_id, label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), p AS (SELECT row, part, v[part * (len(v) // 16) + 1:(part + 1) * (len(v) // 16)] AS x FROM (SELECT *, unnest(range(0, 16)) AS part FROM e)),
b0 AS (SELECT part, row AS k, x AS c FROM p WHERE row < 64),
{_assign("b0", "a1")}, {_move("b0", "a1", "b1")}, {_assign("b1", "a2")}, {_move("b1", "a2", "b2")}, {_assign("b2", "a3")},
r AS (SELECT row, string_agg(printf('%02x', k), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a3 GROUP BY row),
s AS (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, k, j)) AS codebooks_sha256 FROM (SELECT part, k, unnest(c) AS v, unnest(range(1, len(c) + 1)) AS j FROM b2))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM e JOIN r USING (row), s
"""
