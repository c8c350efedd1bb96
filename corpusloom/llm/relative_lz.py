"""Substring dedup by relative Lempel-Ziv parsing (operator 5).

Texts are word sequences. The reference blocks are indexed by a suffix array;
every fragment of a document is factored greedily against all earlier text of
its block: at each place the longest factor that also starts earlier is taken.
Factors of `window` words or more are duplicate spans; windows that begin in a
factor and reach over its end are checked one by one at the boundary. Which block
a fragment meets is routed by content (see `repeats`), so it is factored against
every block that can hold one of its windows, and no other.

Cases: null or empty texts have no words; texts shorter than a window keep all;
of rows with one doc_id the later in order of text counts as later, and so does
a repeated row; rows without a doc_id come last; extra columns are passed over;
texts of any length are covered whole; an empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import SPACE_BYTES, table
from .induced import Scratch
from .repeats import Unit, covered, keyed

WORDS = Unit(window=20, gram=8, words=True, most=1 << 18)


class BlockIndex:
    """Suffix array of a block of fragments, sorted up to `depth` tokens; common prefixes end at fragment ends."""

    def __init__(self, values: np.ndarray, sizes: np.ndarray, depth: int):
        n = len(values)
        ends = np.cumsum(sizes)
        left = np.repeat(ends, sizes) - np.arange(n)
        rank = np.unique(values, return_inverse=True)[1].astype(np.int64) + 1
        self.levels, step = [rank], 1
        while step < depth:
            nxt = np.where(left > step, np.r_[rank[step:], np.zeros(min(step, n), np.int64)][:n], 0)
            rank = np.unique(rank * np.int64(n + 2) + nxt, return_inverse=True)[1].astype(np.int64) + 1
            self.levels.append(rank)
            step *= 2
        self.depth, self.left = 2 * step - 1, left
        self.order = np.argsort(rank, kind="stable")
        a, b = self.order[:-1], self.order[1:]
        lcp = np.zeros(max(0, n - 1), np.int64)
        while step:
            level = self.levels[step.bit_length() - 1]
            x, y = a + lcp, b + lcp
            ok = (lcp + step <= left[a]) & (lcp + step <= left[b])
            ok[ok] = level[x[ok]] == level[y[ok]]
            lcp[ok] += step
            step //= 2
        self.lcp = lcp

    def previous_factors(self, least: int, most: int) -> np.ndarray:
        """Of each place, the longest prefix in least..most that also starts at an earlier place (0 if shorter)."""
        out = np.zeros(len(self.order), np.int64)
        for k in range(least, most + 1):
            joined = self.lcp >= k
            if not joined.any():
                break
            head = np.flatnonzero(np.r_[True, ~joined])
            first = np.minimum.reduceat(self.order, head)
            first = np.repeat(first, np.diff(np.r_[head, len(self.order)]))
            hit = self.order[self.order > first]
            out[hit] = k
        return out


def parsed(values: np.ndarray, sizes: np.ndarray, window: int, scratch: Scratch | None = None) -> Iterator[np.ndarray]:
    """The places in the fragments at which a window starts that also starts earlier, from a greedy parse."""
    if not len(values):
        return
    index = BlockIndex(values, sizes, int(sizes.max()))
    longest = index.previous_factors(1, int(sizes.max()))
    ends = np.cumsum(sizes)
    out = np.zeros(len(values), bool)
    at, end = ends - sizes, ends
    while len(at):
        factor = np.maximum(longest[at], 1)
        long = factor >= window
        # Windows inside a long factor.
        inside = (factor[long] - window + 1).astype(np.int64)
        out[np.repeat(at[long] - (np.cumsum(inside) - inside), inside) + np.arange(int(inside.sum()))] = True
        # Windows over the boundary at the factor's end.
        for back in range(1, window):
            place = at + factor - back
            ok = (place > at) & (place + window <= end)
            place = place[ok]
            out[place[longest[place] >= window]] = True
        at = at + factor
        ok = at + window <= end
        at, end = at[ok], end[ok]
    yield np.flatnonzero(out)


def kept_words(docs: DataFrame, unit: Unit = WORDS) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay, joined by one space) of docs(doc_id, text)."""
    rows = keyed(docs)
    return _applied(rows, covered(rows.select("key", "text"), unit, parsed), False)


def _applied(rows: DataFrame, ranges: DataFrame, digest: bool) -> DataFrame:
    space = bytes(SPACE_BYTES)
    table_ = bytes.maketrans(space, b" " * len(space))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.slice(at, 1024)
                n, removed, kept = [], [], []
                for t, r in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    w = (t or "").encode().translate(table_).split()
                    n.append(len(w))
                    gone = 0
                    if r:
                        stay, last = [], 0
                        for a, b in np.frombuffer(r, np.uint32).reshape(-1, 2).tolist():
                            stay += w[last:a]
                            gone += b - a
                            last = b
                        w = stay + w[last:]
                    removed.append(gone)
                    kept.append(hashlib.sha256(b" ".join(w)).hexdigest() if digest else b" ".join(w).decode())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", name])

    name = "kept_sha256" if digest else "kept"
    joined = rows.join(ranges.hint("shuffle_hash"), "key", "left").select("doc_id", "text", "ranges")
    return joined.mapInArrow(run, f"doc_id long, n_words long, n_removed long, {name} string")


def op5_relative_lz(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = keyed(table(spark, sf_dir, "documents"))
    return _applied(rows, covered(rows.select("key", "text"), WORDS, parsed), True)
