"""Text predicates, cleaning, chunking and token counts as columns.

Lengths and positions are code points. White space is the full Unicode set (29
code points), which neither Java's \\s nor its (?U) form matches exactly.
"""

from __future__ import annotations

import functools
import re
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed values.
WHITE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
PUNCTUATION = r"[!-/:-@\[-`{-~]"
GPT_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KEPT = r"\uac00-\ud7a3\u3131-\u318e\u1100-\u11ffa-zA-Z0-9.,!?'\""

IS_WHITE, IS_PUNCTUATION, IS_LATIN, IS_KEPT = 1, 2, 4, 8


@functools.cache
def kinds() -> np.ndarray:
    """Of each code point, which of the classes above it is in, as bits."""
    out = np.zeros(sys.maxunicode + 1, np.uint8)
    for bit, chars in ((IS_WHITE, WHITE[1:-1]), (IS_PUNCTUATION, PUNCTUATION[1:-1]), (IS_LATIN, "a-zA-Z"), (IS_KEPT, KEPT)):
        out[[m.start() for m in re.finditer(f"[{chars}]", "".join(map(chr, range(0xD800))))]] |= bit
    return out


def _share(text: Column, others: str, total: Column, on_empty: str) -> Column:
    """Characters not in the class `others` per total; on_empty 'error' raises for a total of 0, 'drop' gives null.

    What is left after runs of others are cut out is measured, which makes no list of matches.
    """
    ratio = F.try_divide(F.length(F.regexp_replace(text, others + "+", "")).cast("double"), total.cast("double"))
    if on_empty == "error":
        return F.when(total == 0, F.raise_error(F.lit("a text is empty")).cast("double")).otherwise(ratio)
    return ratio


def english_ratio(text: Column, on_empty: str = "drop") -> Column:
    """Latin letters per character that is not white space."""
    return _share(text, "[^A-Za-z]", F.length(F.regexp_replace(text, WHITE + "+", "")), on_empty)


def number_ratio(text: Column, on_empty: str = "drop") -> Column:
    """Decimal digits per character."""
    return _share(text, r"\P{Nd}", F.length(text), on_empty)


def punctuation_ratio(text: Column, on_empty: str = "drop") -> Column:
    """ASCII punctuation per character."""
    return _share(text, "[^" + PUNCTUATION[1:], F.length(text), on_empty)


def keeps(ratio: Column, most: float) -> Column:
    """A ratio has to be below the limit; a missing one fails."""
    return F.coalesce(ratio < most, F.lit(False))


def remove_unicode(text: Column) -> Column:
    """Deletes what is not Hangul, Latin letters, digits, white space or . , ! ? ' \"."""
    return F.regexp_replace(text, f"[^{KEPT}{WHITE[1:-1]}]", "")


def normalize(text: Column) -> Column:
    """Runs of white space become one space; ends are not trimmed."""
    return F.regexp_replace(text, WHITE + "+", " ")


def char_chunks(text: Column, size: int) -> Column:
    """Consecutive pieces of `size` characters, the last one shorter; none of an empty text."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))


def word_tokens(text: Column) -> Column:
    """The stand-in token count: runs of other than spaces (no tokenizer file is needed, and none is matched)."""
    return F.regexp_count(text, F.lit("[^ ]+"))


def sliced(texts: list[str], most: int = 1 << 18) -> Iterator[list[str]]:
    """Runs of texts of at most `most` characters together, or of one text: an encoding takes many times the memory of its text."""
    part, size = [], 0
    for x in texts:
        if part and size + len(x) > most:
            yield part
            part, size = [], 0
        part.append(x)
        size += len(x)
    if part:
        yield part


def bpe_tokens(spark: SparkSession, path: str, name: str = "own", pattern: str = GPT_PATTERN):
    """A pandas UDF that counts tokens by a vocabulary file: token ranks (*.tiktoken) or a tokenizers file (*.json).

    The file is read on the driver and sent to the executors (a few MB, whatever the data); each worker builds one encoder
    and has the encodings of one run of `sliced` texts at a time, however many rows a batch has.
    Special-token text is plain text; null has no tokens.
    """
    import base64
    from pathlib import Path

    if path.endswith(".json"):
        sent = spark.sparkContext.broadcast(Path(path).read_text())
    else:
        sent = spark.sparkContext.broadcast({base64.b64decode(a): int(b) for a, b in (x.split() for x in Path(path).read_bytes().splitlines() if x)})

    @F.pandas_udf("int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            encoder = Tokenizer.from_str(sent.value)
            encoder.encode_special_tokens = True
            encoder.no_truncation()
            encoder.no_padding()
            sizes = lambda texts: [len(x.ids) for x in encoder.encode_batch_fast(texts, add_special_tokens=False)]
        else:
            import tiktoken

            encoder = tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=sent.value, special_tokens={})
            sizes = lambda texts: [len(encoder.encode_ordinary(x)) for x in texts]
        for texts in batches:
            yield pd.Series([n for part in sliced(texts.fillna("").tolist()) for n in sizes(part)], dtype="int32")

    return count
