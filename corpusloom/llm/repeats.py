"""Windows that repeat in a corpus: routing that substring operators share.

A text is a sequence of tokens (bytes, words). Of the k-grams of every window of
`window` tokens the leftmost with the smallest hash is its anchor, which depends
on the window's content alone; neighbouring windows with one anchor make a
fragment. All places of a window thus lie in fragments with the same anchor:
- fragments are dealt by anchor, in packed rows; copies of a whole fragment are
  folded to the first (inside a task before the shuffle, so a passage in a third
  of all texts stays small), and every later copy is covered;
- where an anchor has fragments that differ, their contents are fetched and given
  to the operator's own method (`decide`), block by block, some whole anchors at a
  time, which finds the windows that start earlier elsewhere;
- covered ranges come back by document.
Nothing is sampled or capped: an anchor with more than CROWD different fragments
is split into its single windows, dealt by their content; copies of a window in one
slice of texts are folded to the first before they are dealt.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Packer, RangeHash, buckets, buffers, by_bucket, byte_codes, mix, runs, slices, unpack, words, written
from .induced import MEMORY, Scratch, Spool
from .running import running

CROWD, PIECE = 50_000, 1 << 20
BLOCK_MEMORY = MEMORY
_POS = np.uint64((1 << 24) - 1)

FRAGMENT = np.dtype([("h", "<u8"), ("c", "<u8"), ("key", "<i8"), ("s", "<u4"), ("m", "<u2")])
WANT = np.dtype([("key", "<i8"), ("h", "<u8"), ("s", "<u4"), ("m", "<u2"), ("crowd", "u1")])
COVER = np.dtype([("key", "<i8"), ("a", "<u4"), ("b", "<u4")])
HEAD = np.dtype([("by", "<u8"), ("key", "<i8"), ("s", "<u4"), ("n", "<u2")])


@dataclass(frozen=True)
class Unit:
    """What a token is. `values` are compared by the operator's method: bytes, or 64-bit hashes of words. `most`: tokens of whole
    anchors that the method is given at once, so its cost follows the number of anchors and not the size of a block; an anchor
    that has more is given whole."""

    window: int
    gram: int
    words: bool
    most: int

    def __post_init__(self):
        if not 0 < self.gram <= self.window <= 1 << 15:
            raise ValueError("windows have 1 to 32768 tokens and are not shorter than their grams")

    def tokens(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes for hashing, values, and len + 1 offsets of the texts into them."""
        if not self.words:
            return byte_codes(data), data, offsets
        starts, ends, cut = words(data, offsets)
        w = RangeHash(byte_codes(data)).of(starts, ends)
        return w, w, cut


def fragments(codes: np.ndarray, offsets: np.ndarray, unit: Unit) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, first window, number of windows, anchor hash and content hash of every fragment."""
    w, k = unit.window, unit.gram
    span = w - k + 1
    none = np.zeros(0, np.int64)
    if len(codes) < w:
        return none, none, none, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    ranges = RangeHash(codes)
    end_of = np.repeat(offsets[1:], np.diff(offsets))
    got = []
    for a in range(0, len(codes) - w + 1, PIECE):
        windows = min(PIECE, len(codes) - w + 1 - a)
        n = windows + span - 1
        at = np.arange(a, a + n)
        g = mix((ranges.prefix[at + k] - ranges.prefix[at]) * ranges.inverse[at])
        packed = np.full(-(-n // span) * span, np.uint64(2**64 - 1))
        packed[:n] = (g & ~_POS) | np.arange(n, dtype=np.uint64)
        rows = packed.reshape(-1, span)
        before = np.minimum.accumulate(rows, 1).reshape(-1)
        after = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].reshape(-1)
        anchor = (np.minimum(after[:windows], before[span - 1 : span - 1 + windows]) & _POS).astype(np.int64)
        ok = at[:windows] + w <= end_of[a : a + windows]
        new = np.r_[True, (anchor[1:] != anchor[:-1]) | ~ok[:-1]] & ok
        start = np.flatnonzero(new)
        if not len(start):
            continue
        stop = np.flatnonzero(np.r_[new[1:] | ~ok[1:], True] & ok) + 1
        got.append((start + a, stop - start, g[anchor[start]]))
    if not got:
        return none, none, none, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    start, m, h = (np.concatenate(x) for x in zip(*got))
    doc = np.searchsorted(offsets, start, "right") - 1
    return doc, start - offsets[doc], m, h, ranges.of(start, start + m + w - 1)


def keyed(docs: DataFrame, whole: bool = False) -> DataFrame:
    """doc_id, text, key: a long that is unique and ordered as (doc_id, text), doc_ids null last. whole: and row, all columns."""
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if whole else []
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *row)
    n, distinct, null = rows.agg(F.count("*"), F.count_distinct("doc_id"), F.count_if(F.col("doc_id").isNull())).first()
    if n == distinct and not null:
        return rows.withColumn("key", F.col("doc_id"))
    order = rows.withColumn("_null", F.col("doc_id").isNull().cast("int")).withColumn("_hash", F.md5("text")).withColumn("_one", F.lit(1).cast("long"))
    out = running(order, [], ["_null", "doc_id", "_hash"], {"key": "_one"}, "repeat-keys")
    return written(out.select("doc_id", "text", *(["row"] if whole else []), "key"), "repeat-docs")


def _joined(ranges: np.ndarray) -> np.ndarray:
    """Ranges sorted by key and start, those of a key that touch merged."""
    ranges = ranges[np.lexsort((ranges["a"], ranges["key"]))]
    if not len(ranges):
        return ranges
    step = np.r_[0, np.cumsum(ranges["key"][1:] != ranges["key"][:-1])].astype(np.int64) << 33  # keeps maxima of one key from the next
    reach = np.maximum.accumulate(ranges["b"].astype(np.int64) + step)
    new = np.r_[True, ranges["a"][1:].astype(np.int64) + step[1:] > reach[:-1]]
    at = np.flatnonzero(new)
    out = ranges[at].copy()
    out["b"] = (reach - step)[np.r_[at[1:], len(ranges)] - 1]
    return out


def anchors_at_once(head: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows(by, n), sorted by anchor, of whole anchors with up to `most` tokens, or of one anchor with more."""
    last, i = runs(head["by"])[1], 0
    total = np.cumsum(head["n"].astype(np.int64))[last - 1] if len(head) else last
    while i < len(head):
        k = int(np.searchsorted(last, i, "right"))  # the anchor that starts at i
        before = total[k - 1] if k else 0
        j = int(last[max(k, int(np.searchsorted(total, before + most, "right")) - 1)])
        yield i, j
        i = j


def _frame(batches: Iterator[pa.RecordBatch], kind: int) -> pd.DataFrame:
    parts = [b.to_pandas() for b in batches]
    out = pd.concat(parts) if parts else pd.DataFrame({"b": np.zeros(0, np.int32), "data": np.zeros(0, object)})
    return out.assign(kind=np.int32(kind))[["kind", "b", "data"]]


def covered(docs: DataFrame, unit: Unit, decide: Callable[[np.ndarray, np.ndarray, int, Scratch], Iterable[np.ndarray]], text: str = "text") -> DataFrame:
    """key and ranges (packed pairs of token numbers) of docs(key, text): the tokens in windows that also start earlier.

    Other columns of docs go through the shuffle of the texts by key, so that a join of docs with the result can use it again.

    decide(values of fragments in order of place, their sizes, window, scratch) gives the places in these values at which
    windows start that start earlier too, in rising order, in pieces; it is called for some whole anchors of a block at a time. A block comes as a
    stream of batches: its contents go to scratch files beyond a share of the memory, only 22 bytes a fragment stay.
    """
    spark = docs.sparkSession
    n, blocks = buckets(spark), max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    window = unit.window

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, done = Packer(FRAGMENT, n), Packer(COVER, n)
        shift = lambda bs: (pa.RecordBatch.from_arrays([pa.array(b.column(0).to_numpy() + np.int32(n)), b.column(1)], ["b", "data"]) for b in bs)
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            data, offsets = buffers(batch.column(1))
            for i, j in slices(offsets, PIECE):
                codes, _, own = unit.tokens(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                doc, s, m, h, c = fragments(codes, own, unit)
                rows = np.zeros(len(doc), FRAGMENT)
                rows["key"], rows["s"], rows["m"], rows["h"], rows["c"] = keys[i:j][doc], s, m, h, c
                rows = rows[np.lexsort((rows["s"], rows["key"], rows["c"], rows["h"]))]
                first = np.zeros(len(rows), bool)
                first[runs(rows["h"], rows["c"])[0]] = True
                yield from pack.add(rows[first], rows["h"][first])
                yield from shift(done.add(*_cover(rows[~first], window)))
        yield from pack.flush()
        yield from shift(done.flush())

    def meet(f: pd.DataFrame) -> pd.DataFrame:
        b = int(f["b"].iloc[0])
        if b >= n:  # ranges covered before the shuffle pass through
            return f.assign(kind=np.int32(0), b=np.int32(b - n))[["kind", "b", "data"]]
        rows = unpack(f["data"], FRAGMENT)
        rows = rows[np.lexsort((rows["s"], rows["key"], rows["c"], rows["h"]))]
        at, _ = runs(rows["h"], rows["c"])
        first = np.zeros(len(rows), bool)
        first[at] = True
        done = Packer(COVER, n)
        out = [_frame([*done.add(*_cover(rows[~first], window)), *done.flush()], 0)]
        reps = rows[first]
        a, e = runs(reps["h"])
        many = np.repeat(e - a, e - a)
        ask = reps[many > 1]
        want = np.zeros(len(ask), WANT)
        for name in ("key", "h", "s", "m"):
            want[name] = ask[name]
        want["crowd"] = many[many > 1] > CROWD
        asked = Packer(WANT, n)
        out.append(_frame([*asked.add(want, mix(want["key"].view(np.uint64))), *asked.flush()], 1))
        return pd.concat(out)

    dealt = docs.select("key", F.col(text).cast("string")).mapInArrow(cut, Packer.SCHEMA)
    met = written(dealt.groupBy("b").applyInPandas(meet, "kind int, b int, data binary"), "repeat-met")

    def wants(blobs):
        rows = np.sort(unpack(blobs, WANT), order=["key", "s"])
        a, e = runs(rows["key"])
        return pd.DataFrame({"key": rows["key"][a], "wants": [rows[i:j].tobytes() for i, j in zip(a, e)]})

    asked = by_bucket(met.filter("kind = 1").select("b", "data"), wants, "key long, wants binary")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Contents of the wanted fragments, packed by block."""
        heads, bodies, where, size = [], [], [], 0

        def flush():
            nonlocal heads, bodies, where, size
            if heads:
                head, block, body = np.concatenate(heads), np.concatenate(where), np.concatenate(bodies)
                start = np.cumsum(head["n"].astype(np.int64)) - head["n"]
                order = np.argsort(block, kind="stable")
                a, e = runs(block[order])
                body_of = lambda o: body[np.repeat(start[o] - (np.cumsum(head["n"][o].astype(np.int64)) - head["n"][o]), head["n"][o]) + np.arange(int(head["n"][o].sum()))]
                parts = [order[i:j] for i, j in zip(a, e)]
                yield pa.RecordBatch.from_arrays([pa.array(block[order][a].astype(np.int32)), pa.array([head[o].tobytes() for o in parts], pa.binary()), pa.array([body_of(o).tobytes() for o in parts], pa.binary())], ["b", "head", "body"])
            heads, bodies, where, size = [], [], [], 0

        for batch in batches:
            data, offsets = buffers(batch.column(0))
            lists = batch.column(1).to_pylist()
            for i, j in slices(offsets, PIECE):
                codes, values, own = unit.tokens(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                got = [np.frombuffer(x, WANT) for x in lists[i:j]]
                w = np.concatenate(got)
                base = np.repeat(own[:-1], [len(x) for x in got])
                by, copy = w["h"], None
                if w["crowd"].any():  # one row for each window, dealt by content
                    times = np.where(w["crowd"] > 0, w["m"], 1)
                    step = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
                    w, base = np.repeat(w, times), np.repeat(base, times)
                    crowd = w["crowd"] > 0
                    w["s"] += step.astype(np.uint32)
                    w["m"][crowd] = 1
                    start = base + w["s"]
                    by = np.where(crowd, RangeHash(codes).of(start, start + window), w["h"])
                    own_crowd = np.flatnonzero(crowd)
                    own_crowd = own_crowd[np.lexsort((w["s"][own_crowd], w["key"][own_crowd], by[own_crowd]))]
                    copy = np.zeros(len(w), bool)
                    copy[own_crowd] = True
                    copy[own_crowd[runs(by[own_crowd])[0]]] = False
                head = np.zeros(len(w), HEAD)
                head["by"], head["key"], head["s"], head["n"] = by, w["key"], w["s"], w["m"] + window - 1
                if copy is not None:  # the first of them is in the slice, so these are covered: they go without contents
                    head["n"][copy] = 0
                n_ = head["n"].astype(np.int64)
                index = np.repeat(base + w["s"] - (np.cumsum(n_) - n_), n_) + np.arange(int(n_.sum()))
                heads.append(head)
                bodies.append(values[index])
                where.append((mix(by + np.uint64(1)) % np.uint64(blocks)).astype(np.int64))
                size += head.nbytes + bodies[-1].nbytes
                if size > 16 << 20:
                    yield from flush()
        yield from flush()

    texts = docs.join(asked.hint("shuffle_hash"), "key").select(F.col(text).cast("string").alias(text), "wants", *[c for c in docs.columns if c != text])
    fetched = texts.mapInArrow(fetch, "b int, head binary, body binary")

    def decided(heads: list[bytes], spool: Spool) -> Iterator[pa.RecordBatch]:
        head, body, scratch, done_ = unpack(heads, HEAD), spool.all(np.uint64 if unit.words else np.uint8), spool.scratch, Packer(COVER, n)
        folded, head = head[head["n"] == 0], head[head["n"] > 0]
        rows = np.zeros(len(folded), COVER)
        rows["key"], rows["a"], rows["b"] = folded["key"], folded["s"], folded["s"] + np.uint32(window)
        rows = _joined(rows)
        yield from done_.add(rows, mix(rows["key"].view(np.uint64)))
        sizes = head["n"].astype(np.int64)
        start = np.cumsum(sizes) - sizes
        # Fragments of different anchors share no window: anchors are worked off together up to `most` tokens.
        order = np.lexsort((head["s"], head["key"], head["by"]))
        head, sizes, start = head[order], sizes[order], start[order]
        for i, j in anchors_at_once(head, unit.most):
            own = np.lexsort((head["s"][i:j], head["key"][i:j])) + i
            ends = np.cumsum(sizes[own])
            flat = scratch.array(int(ends[-1]), body.dtype)
            shift = start[own] - (ends - sizes[own])
            for a, b in scratch.pieces(len(flat)):
                at = np.arange(a, b)
                flat[a:b] = body[at + shift[np.searchsorted(ends, at, "right")]]
            found = []
            for at in decide(flat, sizes[own], window, scratch):
                frag = np.searchsorted(ends, at, "right")
                rows = np.zeros(len(at), COVER)
                rows["key"], rows["a"] = head["key"][own][frag], head["s"][own][frag] + (at - (ends - sizes[own])[frag])
                rows["b"] = rows["a"] + window
                found.append(_joined(rows))
            rows = _joined(np.concatenate(found)) if found else np.zeros(0, COVER)
            yield from done_.add(rows, mix(rows["key"].view(np.uint64)))
        yield from done_.flush()

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of a block follow each other."""
        block, heads, spool = None, [], None
        for batch in batches:
            for b, head, body in zip(*batch.columns):
                if b.as_py() != block:
                    if heads:
                        yield from decided(heads, spool)
                    block, heads, spool = b.as_py(), [], Spool(Scratch(BLOCK_MEMORY))
                heads.append(head.as_py())
                spool.add(body.as_buffer().to_pybytes())
        if heads:
            yield from decided(heads, spool)

    late = fetched.repartition(blocks, "b").sortWithinPartitions("b").mapInArrow(streamed, "b int, data binary")

    def ranges(blobs):
        rows = _joined(unpack(blobs, COVER))
        a, e = runs(rows["key"])
        both = np.stack([rows["a"], rows["b"]], 1)
        return pd.DataFrame({"key": rows["key"][a], "ranges": [both[i:j].tobytes() for i, j in zip(a, e)]})

    all_covers = met.filter("kind = 0").select("b", "data").unionByName(late)
    return by_bucket(all_covers, ranges, "key long, ranges binary")


def _cover(rows: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    out = np.zeros(len(rows), COVER)
    out["key"], out["a"], out["b"] = rows["key"], rows["s"], rows["s"] + rows["m"] + np.uint32(window - 1)
    return out, mix(out["key"].view(np.uint64))


