"""Quality filtering of reference texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .ordinal import positions

_SLICE, _PIECE = 1 << 20, 1 << 20


def _filtered(rows: DataFrame, punctuation: float | None, english: float | None, unicode: bool, normalize: bool, on_empty: str) -> DataFrame:
    """rows(..., contents) whose ratios are below the limits (None: no such filter), cleaned, with their runs of other than spaces as `_words`.

    What T's ratios, T.remove_unicode, T.normalize and T.word_tokens say, in one look at each character, a slice of texts at a time.
    """
    *others, _ = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = T.kinds()
        for batch in batches:
            sizes = np.cumsum(batch.column(len(others)).cast(pa.binary()).fill_null(b"").to_pandas().map(len).to_numpy(np.int64))
            at = 0
            while at < len(batch):
                end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + _SLICE, "right")))
                part = batch.slice(at, end - at)
                at = end
                column = part.column(len(others)).cast(pa.binary())
                texts = [(x or b"").decode("utf-8", "replace") for x in column.to_pylist()]
                known = column.is_valid().to_numpy(zero_copy_only=False)
                codes = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
                n = np.array([len(x) for x in texts], np.int64)
                own, kind = np.repeat(np.arange(len(n)), n), kinds[codes]
                counted = lambda bit: np.bincount(own[(kind & bit) > 0], minlength=len(n))  # noqa: B023, E731
                ok = np.ones(len(n), bool)
                for most, bit, total in ((punctuation, T.IS_PUNCTUATION, n), (english, T.IS_LATIN, n - counted(T.IS_WHITE))):
                    if most is None:
                        continue
                    if on_empty == "error" and (ok & known & (total == 0)).any():
                        raise ValueError("a text is empty")
                    ok &= known & (total > 0) & (counted(bit) / np.maximum(total, 1) < most)
                keep = ok[own]
                if unicode:
                    keep &= (kind & (T.IS_KEPT | T.IS_WHITE)) > 0
                codes, kind, own = codes[keep], kind[keep], own[keep]
                if normalize and len(codes):
                    white = (kind & T.IS_WHITE) > 0
                    codes = np.where(white, 0x20, codes).astype("<u4")
                    first = ~white
                    first[0] = True
                    first[1:] |= ~white[:-1] | (own[1:] != own[:-1])
                    codes, own = codes[first], own[first]
                word = codes != 0x20
                begins = word.copy()
                begins[1:] &= ~word[:-1] | (own[1:] != own[:-1])
                cut, whole = np.r_[0, np.cumsum(np.bincount(own, minlength=len(n)))].tolist(), codes.tobytes().decode("utf-32-le")
                clean = [whole[i:j] if k else None for i, j, k in zip(cut, cut[1:], known.tolist())]
                words = pa.array(np.bincount(own[begins], minlength=len(n)).astype(np.int32), mask=~known)
                out = pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(clean, pa.string()), words], [*others, "contents", "_words"])
                yield out.filter(pa.array(ok))

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{types}, _words int")


def _pieces(rows: DataFrame, keys: list[str], size: int) -> DataFrame:
    """seq, contents: the text of all contents in the order of keys, cut into pieces of `size` characters.

    Made from running lengths, so no task holds the whole text."""
    placed = positions(rows.withColumn("n", F.length("contents")).filter("n > 0"), keys, "at", F.col("n"), "quality")
    first, last = F.floor(F.col("at") / size), F.floor((F.col("at") + F.col("n") - 1) / size)
    parts = placed.withColumn("seq", F.explode(F.sequence(first, last)))
    start = F.greatest(F.col("seq") * size - F.col("at"), F.lit(0))
    stop = F.least((F.col("seq") + 1) * size - F.col("at"), F.col("n").cast("long"))
    parts = parts.select("seq", "at", F.substring(F.col("contents"), (start + 1).cast("int"), (stop - start).cast("int")).alias("part"))
    return parts.groupBy("seq").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "part"))), lambda u: u["part"]), "").alias("contents"))


def _joined(batches: Iterator[pa.RecordBatch], title: str) -> Iterator[pa.RecordBatch]:
    """One row, as it is to be, as each projection of it in Spark takes twice its size: title, the pieces put together, and their runs of other than spaces. The text is held as bytes, not as a list of its tokens."""
    whole, n, after = bytearray(), 0, True
    for batch in batches:
        for piece in batch.column(1).cast(pa.binary()):
            data = piece.as_buffer()
            word = np.frombuffer(data, np.uint8) != 0x20 if data.size else np.zeros(0, bool)
            if len(word):
                n += int(np.count_nonzero(word[1:] & ~word[:-1])) + int(word[0] and after)
                after = not word[-1]
            whole += memoryview(data)
            if len(whole) >= 1 << 31:
                raise ValueError("the text is longer than a row can hold (2^31 bytes): take return_type 'chunk'")
    ends = pa.py_buffer(np.array([0, len(whole)], np.int32))
    yield pa.RecordBatch.from_arrays([pa.array([title]), pa.StringArray.from_buffers(1, ends, pa.py_buffer(whole)), pa.array([n], pa.int32())], ["title", "contents", "tokens"])


def quality_filter(
    df: DataFrame, title: str, order: list[str], punctuation: bool = True, english: bool = True, number: bool = True, unicode: bool = True, normalize: bool = True, token: bool = True,
    punctuation_ratio: float = 0.5, english_ratio: float = 0.5, number_ratio: float = 0.5, token_threshold: int = 200, return_type: str = "split", chunk_size: int = 10_000,
    tokens: Callable[[Column], Column] = T.word_tokens, on_empty: str = "drop",
) -> DataFrame:
    """Ratio filters on the raw contents, cleaning, then the token filter (strictly more than the threshold).

    split: seq, title, contents, tokens of each row left; full: one row of all contents in order; chunk: that text cut into
    pieces of chunk_size characters, with no task that holds the whole text. Filters come before the tokenizer. on_empty 'error' raises for an empty text, 'drop' lets it fail the filters.
    """
    if missing := {"contents"} - set(df.columns):
        raise ValueError(f"missing columns: {missing}")
    if return_type not in ("split", "full", "chunk"):
        raise ValueError(f"return_type is split, full or chunk, not {return_type!r}")
    if number:
        df = df.filter(T.keeps(T.number_ratio(F.col("contents"), on_empty), number_ratio))
    keys = [f"_{o}" for o in order]
    rows = df.select(*[F.col(o).alias(k) for o, k in zip(order, keys)], F.col("contents").cast("string").alias("contents"))
    rows = _filtered(rows, punctuation_ratio if punctuation else None, english_ratio if english else None, unicode, normalize, on_empty)
    rows = rows.withColumn("tokens", F.col("_words") if tokens is T.word_tokens else tokens(F.col("contents")).cast("int")).drop("_words")
    if token:
        rows = rows.filter(F.col("tokens") > token_threshold)
    if return_type == "split":
        return positions(rows, keys, "seq", name="quality").select(F.col("seq").cast("int").alias("seq"), F.lit(title).alias("title"), "contents", "tokens")
    if return_type == "full":  # one text by definition: bounded by what a row can hold, 2^31 bytes
        none = df.sparkSession.range(1).select(F.lit(-1).cast("long").alias("seq"), F.lit("").alias("contents"))  # an empty text has its row too
        pieces = _pieces(rows, keys, _PIECE).unionByName(none).repartition(1).sortWithinPartitions("seq")
        whole = pieces.mapInArrow(lambda batches: _joined(batches, title), "title string, contents string, tokens int")
        return whole if tokens is T.word_tokens else whole.withColumn("tokens", tokens(F.col("contents")).cast("int"))
    joined = _pieces(rows, keys, chunk_size)
    return joined.select(F.col("seq").cast("int").alias("seq"), F.lit(title).alias("title"), "contents", tokens(F.col("contents")).cast("int").alias("tokens"))
