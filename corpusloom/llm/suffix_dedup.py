"""Suffix-array dedup of byte strings by external induced sorting (operator 10).

Texts are UTF-8 bytes; a byte goes if a `window`-byte string that covers it also
starts earlier. Fragments that share an anchor are joined into a block with a
separator after each (see `repeats`), all suffixes of the block, of any size, are
sorted with their common prefixes by external induced sorting (see `induced`), and in
each stretch of neighbours that share `window` bytes or more all but the first in
place repeat.

Cases: null or empty texts have no bytes; texts shorter than a window keep all;
of rows with one doc_id the later in order of text counts as later, and so does
a repeated row; rows without a doc_id come last; extra columns are passed over;
texts of any length are covered whole; an empty table gives none. A cut may fall inside a UTF-8 character:
`deduplicated` then drops the stray bytes of that character from the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .induced import Scratch, suffix_order
from .repeats import Unit, covered, keyed

#: Beyond a few MB a sort at once costs several times as much a byte: more levels of names.
BYTES = Unit(window=100, gram=32, words=False, most=2 << 20)


def repeated(values: np.ndarray, sizes: np.ndarray, window: int, scratch: Scratch | None = None) -> Iterator[np.ndarray]:
    """Places in the fragments' bytes at which a window starts that also starts earlier, in rising order, a piece at a time."""
    scratch = scratch or Scratch()
    n, k = len(values), len(sizes)
    if not n:
        return
    ends = np.cumsum(sizes)
    t = scratch.array(n + k, np.int16)
    for a, b in scratch.pieces(n):  # a separator after each fragment
        t[np.arange(a, b) + np.searchsorted(ends, np.arange(a, b), "right")] = values[a:b].astype(np.int16) + 1
    t[ends + np.arange(k)] = 0
    order, prefix = suffix_order(t, window, scratch)
    # In each stretch of suffixes that share a window all but the first in place are marked.
    mark = scratch.array(n + k, bool)
    mark[:] = False
    least = -1  # the first in place of the stretch that the pieces so far end with
    for a, b in scratch.pieces(n + k):
        part, new = np.asarray(order[a:b]), np.asarray(prefix[a:b]) < window
        head = np.flatnonzero(np.append(True, new[1:]))
        firsts = np.minimum.reduceat(part, head)
        if not new[0] and least >= 0:  # goes on from the last piece
            mark[max(least, int(firsts[0]))] = True
            firsts[0] = min(least, int(firsts[0]))
        mark[part[part > np.repeat(firsts, np.diff(head, append=len(part)))]] = True
        least = int(firsts[-1])
    for a, b in scratch.pieces(n):
        at = np.arange(a, b)
        f = np.searchsorted(ends, at, "right")
        yield at[mark[at + f] & (ends[f] - at >= window)]


def _cut(data: bytes, ranges: bytes | None) -> tuple[bytes, int, int]:
    """What stays of data, the bytes removed, and the number of runs removed."""
    if not ranges:
        return data, 0, 0
    r = np.frombuffer(ranges, np.uint32).reshape(-1, 2).tolist()
    stay, last, gone = [], 0, 0
    for a, b in r:
        stay.append(data[last:a])
        gone += b - a
        last = b
    return b"".join([*stay, data[last:]]), gone, len(r)


def spans(docs: DataFrame, unit: Unit = BYTES) -> DataFrame:
    """key, doc_id, text, ranges (packed pairs of byte numbers to remove, or null)."""
    return _with_ranges(keyed(docs), unit, "text")


def _with_ranges(rows: DataFrame, unit: Unit, text: str) -> DataFrame:
    """rows(key, text, ...) with ranges. Fetching and this join need the same rows by key: one shuffle serves both."""
    rows = rows.filter("key is not null")  # no key is; an inner join asks for that, and with it both sides are the same plan
    return rows.join(covered(rows, unit, repeated, text).hint("shuffle_hash"), "key", "left")


def deduplicated(docs: DataFrame, unit: Unit = BYTES, recount: str = "n_chars") -> DataFrame:
    """docs with the repeated bytes of text removed; columns unchanged, but for `recount`, the characters left.

    Documents that lose their whole text go; those that had none stay.
    """
    schema, at = docs.schema, {c: i for i, c in enumerate(docs.columns)}
    count = docs.schema[recount].dataType.simpleString() if recount in at else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 1024):
                part = batch.slice(i, 1024)
                columns = part.columns[: len(at)]
                texts, keep = part.column(at["text"]).to_pylist(), []
                for k, r in enumerate(part.column(len(at)).to_pylist()):
                    if r:
                        texts[k] = _cut(texts[k].encode(), r)[0].decode("utf-8", "ignore")
                    keep.append(not r or bool(texts[k]))
                columns[at["text"]] = pa.array(texts, pa.string())
                if count:
                    columns[at[recount]] = pa.array([None if t is None else len(t) for t in texts], columns[at[recount]].type)
                yield pa.RecordBatch.from_arrays(columns, list(at)).filter(pa.array(keep, pa.bool_()))

    own = [f"_{i}" for i in range(len(docs.columns))]
    rows = keyed(docs, True).select("key", *[F.col("row")[c].alias(o) for c, o in zip(docs.columns, own)])
    return _with_ranges(rows, unit, own[at["text"]]).select(*own, "ranges").mapInArrow(run, schema)


def op10_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.slice(at, 1024)
                n, got = [], []
                for t, r in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    data = (t or "").encode()
                    n.append(len(data))
                    got.append(_cut(data, r))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array([g[1] for g in got], pa.int64()), pa.array([g[2] for g in got], pa.int64()), pa.array([hashlib.sha256(g[0]).hexdigest() for g in got], pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return spans(table(spark, sf_dir, "documents")).select("doc_id", "text", "ranges").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
