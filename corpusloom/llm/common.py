"""What the operators share: written intermediate tables and numpy text kernels."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.barrier import barrier as written
from ..plans.barrier import fresh

__all__ = ["fresh", "written"]

#: The words of every contract: runs without these six bytes.
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows from which on a key can be hot.
HOT_ROWS = 64
WORD_SQL = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of sf_dir. Where the session leaves Arrow's batch size as it comes, batches are made smaller: texts may be long."""
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, "500")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def buckets(spark: SparkSession) -> int:
    """Buckets that packed rows are dealt to: several for each shuffle partition, so that they follow the cluster's setting."""
    return max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))


def hot_keys(df: DataFrame, keys: list[str]) -> DataFrame | None:
    """keys and __pieces of the keys that hold more than an average partition's share of df, and into how many pieces to split each.

    There are fewer than shuffle partitions (they come to the driver, as one local table), and their pieces are at most twice as
    many, whatever the size of df. None: there are none.
    """
    parts, total = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.count()
    if total < parts * HOT_ROWS:
        return None
    found = df.groupBy(*keys).agg(F.count("*").alias("__rows")).filter(F.col("__rows") * parts > total).select(*keys, F.ceil(F.col("__rows") * parts / total).cast("int").alias("__pieces"))
    rows = found.collect()
    return df.sparkSession.createDataFrame(rows, found.schema) if rows else None


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], spread: list[str], how: str = "inner", hot: DataFrame | None = None, counted: DataFrame | None = None) -> DataFrame:
    """left joined with right, which has one row a key; rows of left with a hot key are split by a hash of `spread`.

    counted: a written table with about the keys of left, where left is not; hot: the hot keys, where they are known.
    """
    hot = hot_keys(left if counted is None else counted, keys) if hot is None else hot
    if hot is None:
        return left.join(right, keys, how)
    pieces = F.coalesce("__pieces", F.lit(1))
    split = left.join(F.broadcast(hot), keys, "left").withColumn("__piece", F.pmod(F.xxhash64(*spread), pieces).cast("int")).drop("__pieces")
    copies = right.join(F.broadcast(hot), keys, "left").withColumn("__piece", F.explode(F.sequence(F.lit(0), pieces - 1))).drop("__pieces")
    return split.join(copies, [*keys, "__piece"], how).drop("__piece")


# --- numpy kernels ---------------------------------------------------------


def _odd_inverse(x: int) -> int:
    y = x
    for _ in range(6):
        y = y * (2 - x * y) % 2**64
    return y


_R = 0x9E3779B97F4A7C15 | 1
_RINV = _odd_inverse(_R)
_TABLE = np.random.Generator(np.random.PCG64(20240229)).integers(0, 2**64, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    key = str(base)
    if key not in _powers or len(_powers[key]) < n:
        size = max(1 << 16, int(n) + (int(n) >> 3))
        p = np.full(size, base, np.uint64)
        p[0] = 1
        _powers[key] = np.multiply.accumulate(p)
    return _powers[key][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class RangeHash:
    """64-bit hashes of any range of a token array, from one prefix sum (polynomial, modulo 2^64, over random token codes)."""

    def __init__(self, codes: np.ndarray):
        self.prefix = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * _power(_R, len(codes)), out=self.prefix[1:])
        self.inverse = _power(_RINV, len(codes) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * self.inverse[start] + (end - start).astype(np.uint64))

    def sliding(self, k: int) -> np.ndarray:
        n = len(self.prefix) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.prefix[k:] - self.prefix[:n]) * self.inverse[:n])


def byte_codes(data: np.ndarray) -> np.ndarray:
    return _TABLE[data]


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the len + 1 offsets; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()) if not pa.types.is_large_string(col.type) else col
    if col.null_count:
        col = col.fill_null("")
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `most` bytes each, or of one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j


IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACE_BYTES)] = True


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of concatenated texts, and len + 1 offsets of the texts into them."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~IS_SPACE[data]
    start = inside[1:-1] & ~inside[:-2]
    last = inside[1:-1] & ~inside[2:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    start[cut] = inside[cut + 1]
    last[cut - 1] = inside[cut]
    starts, ends = np.flatnonzero(start), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets, "left")


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


class Packer:
    """Gathers rows of a numpy dtype by bucket and gives them out as (bucket, bytes) batches: a few Spark rows instead of millions."""

    SCHEMA = "b int, data binary"

    def __init__(self, dtype: np.dtype, n: int, most: int = 24 << 20):
        self.dtype, self.n, self.most, self.parts, self.size = dtype, n, most, [], 0

    def add(self, rows: np.ndarray, key: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(rows):
            self.parts.append((rows, (key % np.uint64(self.n)).astype(np.int32)))
            self.size += rows.nbytes
        if self.size >= self.most:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        rows, b = np.concatenate([x for x, _ in self.parts]), np.concatenate([x for _, x in self.parts])
        self.parts, self.size = [], 0
        order = np.argsort(b, kind="stable")
        rows, b = rows[order], b[order]
        at = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
        ends = np.r_[at[1:], len(b)]
        yield pa.RecordBatch.from_arrays([pa.array(b[at]), pa.array([rows[i:j].tobytes() for i, j in zip(at, ends)], pa.binary())], ["b", "data"])


def unpack(blobs: Iterable[bytes], dtype: np.dtype) -> np.ndarray:
    got = [np.frombuffer(x, dtype) for x in blobs if x]
    return np.concatenate(got) if got else np.zeros(0, dtype)


def runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal keys in sorted arrays."""
    n = len(keys[0])
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    at = np.flatnonzero(new)
    return at, np.r_[at[1:], n]


def by_bucket(packed: DataFrame, kernel, schema: str) -> DataFrame:
    """Applies kernel(list of blobs) -> pandas frame to the blobs of each bucket."""

    def run(pdf):
        return kernel(list(pdf["data"]))

    return packed.groupBy("b").applyInPandas(run, schema)


def long_or_last(col: str):
    """doc_id for ordering: null comes after every number."""
    return F.coalesce(F.col(col).cast("long"), F.lit(2**63 - 1))
