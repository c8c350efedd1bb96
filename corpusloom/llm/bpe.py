"""BPE encoding and decoding with forced boundaries (operator 4).

A pair of neighbouring bytes that occurs inside no vocabulary token can never
be merged over, so every such pair is a certain cut. A word is cut there, each
fragment is merged on its own, and the ids are concatenated. Only the last
fragment of a word carries the end-of-word suffix.

The tokenizer file (a parameter) is read on the driver and sent to the workers
as a broadcast; its size does not grow with the data. Caches are bounded.

Cases: null or empty text gives no ids, the decoded text is empty; repeated
rows give equal rows; extra columns are passed over; a table without rows gives
none; a text of any length is encoded whole (long fragments use a heap).
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import struct
import sys
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import table

# The white space of Unicode, and the split pattern of this kind of tokenizer file.
WHITE = "[\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[{L}]+|[{N}]|[^\s{L}{N}]+"

SCHEMA = "doc_id long, n_tokens long, ids binary, decoded string"

# Letters and numbers that Unicode 16 added, which the tokenizers library knows and Python 3.13 does not.
LETTERS_16 = r"\u1c89-\u1c8a\ua7cb-\ua7cd\ua7da-\ua7dc\U000105c0-\U000105f3\U00010d4a-\U00010d65\U00010d6f-\U00010d85\U00010ec2-\U00010ec4\U00011380-\U00011389\U0001138b\U0001138e\U00011390-\U000113b5\U000113b7\U000113d1\U000113d3\U00011bc0-\U00011be0\U00013460-\U000143fa\U00016100-\U0001611d\U00016d40-\U00016d6c\U00018cff\U0001e5d0-\U0001e5ed\U0001e5f0"
NUMBERS_16 = r"\U00010d40-\U00010d49\U000116d0-\U000116e3\U00011bf0-\U00011bf9\U00016130-\U00016139\U00016d70-\U00016d79\U0001ccf0-\U0001ccf9\U0001e5f1-\U0001e5fa"

# Capitals newer than Python 3.13's tables, and their small letters.
SMALL = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
SMALL |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}


@functools.cache
def split_pattern() -> str:
    """SPLIT with the letters and numbers of Python's Unicode tables, which str.isalpha() goes by as well."""
    found: dict[str, list[str]] = {"L": [], "N": []}
    start, last = 0, ""
    for c in range(sys.maxunicode + 2):
        kind = unicodedata.category(chr(c))[0] if c <= sys.maxunicode else ""
        if kind != last:
            if last in found:
                found[last].append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start, last = c, kind
    return SPLIT.replace("{L}", "".join(found["L"]) + LETTERS_16).replace("{N}", "".join(found["N"]) + NUMBERS_16)


def byte_alphabet() -> dict[int, str]:
    """Byte -> the printable character that stands for it: itself if printable, else the next free one from U+0100."""
    out, free = {}, 0x100
    for b in range(256):
        if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF:
            out[b] = chr(b)
        else:
            out[b] = chr(free)
            free += 1
    return out


class ForcedBoundaryBpe:
    """Encoder and decoder of one tokenizer file with word ends."""

    CACHE = 700_000
    NONE = 1 << 60

    def __init__(self, spec: str):
        spec = json.loads(spec)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        # Ranks and results of merges by a pair of ids.
        self.rank: dict[int, int] = {}
        self.result: list[int] = []
        for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            self.rank.setdefault(self.vocab[a] << 32 | self.vocab[b], len(self.result))
            self.result.append(self.vocab[a + b])
        self.token = {i: t for t, i in self.vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token |= {i: t for t, i in self.special.items()}
        alphabet = byte_alphabet()
        byte_of = {c: b for b, c in alphabet.items()}
        self.inner = [self.vocab[alphabet[b]] for b in range(256)]
        self.last = [self.vocab[alphabet[b] + self.suffix] for b in range(256)]
        self.joined = bytearray(1 << 16)
        for t in self.vocab:
            codes = [byte_of[c] for c in t.removesuffix(self.suffix)]
            for x, y in zip(codes, codes[1:]):
                self.joined[x << 8 | y] = 1
        self.special_at = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.capitals = regex.compile("[" + "".join(map(chr, SMALL)) + "]")
        self.white, self.split = regex.compile(WHITE + "+"), regex.compile(split_pattern())
        self.pieces: dict[str, tuple[bytes, str]] = {}
        self.fragments: dict[tuple[bytes, bool], list[int]] = {}

    def cuts(self, word: bytes) -> list[bytes]:
        """The fragments of a word: it is cut between bytes that no token holds side by side."""
        joined = self.joined
        at = [i for i, (x, y) in enumerate(zip(word, word[1:]), 1) if not joined[x << 8 | y]]
        return [word[i:j] for i, j in zip([0, *at], [*at, len(word)])] if at else [word]

    def merged(self, ids: list[int]) -> list[int]:
        if len(ids) > 64:
            return self._merged_long(ids)
        get, none, result = self.rank.get, self.NONE, self.result
        ranks = [get(x << 32 | y, none) for x, y in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            new = ids[i] = result[best]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get(ids[i - 1] << 32 | new, none)
            if i < len(ranks):
                ranks[i] = get(new << 32 | ids[i + 1], none)
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        """The same in n log n: a heap of pairs over a linked list."""
        n, rank = len(ids), self.rank
        after, before, dead = list(range(1, n + 1)), list(range(-1, n - 1)), [False] * n
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if dead[i] or j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], dead[j], after[i] = self.result[r], True, after[j]
            if after[j] < n:
                before[after[j]] = i
                if (r := rank.get(ids[i] << 32 | ids[after[j]])) is not None:
                    heapq.heappush(heap, (r, i, ids[i], ids[after[j]]))
            if before[i] >= 0 and (r := rank.get(ids[before[i]] << 32 | ids[i])) is not None:
                heapq.heappush(heap, (r, before[i], ids[before[i]], ids[i]))
        return [s for s, d in zip(ids, dead) if not d]

    def fragment(self, text: bytes, last: bool) -> list[int]:
        ids = [self.inner[b] for b in text]
        if last:
            ids[-1] = self.last[text[-1]]
        return self.merged(ids)

    def word(self, word: str) -> list[int]:
        """Ids of one word: its fragments, each encoded by itself, put together."""
        parts = self.cuts(word.encode())
        if len(parts) == 1:
            return self.fragment(parts[0], True)
        ids: list[int] = []
        for i, part in enumerate(parts, 1):
            key = (part, i == len(parts))
            got = self.fragments.get(key)
            if got is None:
                got = self.fragment(*key)
                if len(part) <= 64:
                    if len(self.fragments) >= self.CACHE // 4:
                        self.fragments.clear()
                    self.fragments[key] = got
            ids += got
        return ids

    def piece(self, text: str) -> tuple[bytes, str]:
        """Ids and decoded text of a piece without white space."""
        if text.isalpha():
            ids = self.word(text)
        elif text[:-1].isalpha() and text[-1] in ".,":  # most pieces that are no word; the word is likely known
            (a, x), (b, y) = (self.pieces.get(t) or self.piece(t) for t in (text[:-1], text[-1]))
            return a + b, f"{x} {y}"
        else:
            ids = [i for w in self.split.findall(text) for i in self.word(w)]
        got = struct.pack(f"<{len(ids)}I", *ids), self.decode(ids)
        if len(text) <= 64:
            if len(self.pieces) >= self.CACHE:
                self.pieces.clear()
            self.pieces[text] = got
        return got

    def normal(self, text: str) -> str:
        """Composed, white space as single spaces, each letter lower-cased by itself."""
        text = self.white.sub(" ", unicodedata.normalize("NFC", text))
        if text.isascii():
            return text.lower()
        return self.capitals.sub(lambda m: chr(SMALL[ord(m[0])]), text.replace("Σ", "σ")).lower()

    def encode_and_decode(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian 32-bit integers, and their decoded text."""
        ids, said = [], []
        for k, part in enumerate(self.special_at.split(text) if self.special_at else [text]):
            if k % 2:
                ids.append(self.special[part].to_bytes(4, "little"))
                said.append(part)
                continue
            part = self.normal(part)
            get, piece = self.pieces.get, self.piece
            for w in part.split(" "):
                if w:
                    a, b = get(w) or piece(w)
                    if a:
                        ids.append(a)
                        said.append(b)
        return b"".join(ids), " ".join(said)

    def decode(self, ids) -> str:
        """Without a decoder in the file, tokens are joined by single spaces."""
        return " ".join([self.token[i] for i in ids])


def encode(docs: DataFrame, tokenizer_path: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, ids (packed 32-bit), decoded for every row."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ForcedBoundaryBpe(spec.value)
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                got = [bpe.encode_and_decode(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(a) // 4 for a, _ in got], pa.int64()), pa.array([a for a, _ in got], pa.binary()), pa.array([b for _, b in got], pa.string())], ["doc_id", "n_tokens", "ids", "decoded"])

    return docs.selectExpr(f"cast({id_col} as long) doc_id", f"cast({text_col} as string) text").mapInArrow(run, SCHEMA)


def digests(docs: DataFrame, tokenizer_path: str, with_ids: bool = False) -> DataFrame:
    """As encode(), but the decoded text leaves the worker as SHA-256 only, and ids too unless they are asked for."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ForcedBoundaryBpe(spec.value)
        for batch in batches:
            for at in range(0, len(batch), 2048):
                part = batch.slice(at, 2048)
                n, x, y, z = [], [], [], []
                for t in part.column(1):
                    ids, said = bpe.encode_and_decode(t.as_py() or "")
                    n.append(len(ids) // 4)
                    x.append(hashlib.sha256(ids).hexdigest())
                    y.append(hashlib.sha256(said.encode()).hexdigest())
                    if with_ids:
                        z.append(ids)
                columns = [part.column(0), pa.array(n, pa.int64()), pa.array(x, pa.string()), pa.array(y, pa.string()), pa.array(z, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns[: len(names)], names)

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids)


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), vocabulary())
