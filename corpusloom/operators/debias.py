"""Removing the bias of answer positions, and closing sentences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Closing sentences; {} is the answer's letter.
CONCLUSIONS = tuple(f"{a} {{}}{b}" for a in ("이 풀이대로라면 정답은", "그러므로 고를 답은", "앞의 계산에 비추어 정답은", "위 내용에 따라 정답은", "종합하면 정답은") for b in ("입니다.", "이다.", " 입니다.", "가 됩니다."))


def drawn(key: Column, n: int | Column) -> Column:
    """A number below n, by hash of key."""
    return F.pmod(F.conv(F.left(F.md5(key), F.lit(8)), 16, 10).cast("long"), F.lit(n) if isinstance(n, int) else n).cast("int")


def permutation(key: Column, n: Column) -> Column:
    """A permutation of 0..n-1 drawn by hash from key: the same on every run and retry."""
    drawn = F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.struct(F.md5(F.concat(key, F.lit(":"), k.cast("string"))).alias("h"), k.alias("k")))
    return F.transform(F.array_sort(drawn), lambda s: s["k"])


def shuffled(options: Column, answer: Column, key: Column, most: int = 7) -> tuple[Column, Column]:
    """Options in a new order with new letters, and the answer's new letter. Items that cannot be shuffled stay as they are."""
    n, old = F.size(options), F.ascii(answer) - 65
    ok = n.between(1, most) & old.between(0, n - 1) & (F.length(answer) == 1)
    perm = permutation(key, F.greatest(n, F.lit(1)))
    moved = F.transform(perm, lambda p, j: F.concat(F.char(F.lit(65) + j), F.substring(F.get(options, p), F.lit(2), F.length(F.get(options, p)))))
    letter = F.char(F.lit(64) + F.array_position(perm, old.cast("int")))
    return F.when(ok, moved).otherwise(options), F.when(ok, letter).otherwise(answer)


def concluded(reasoning: Column, answer: Column, key: Column) -> Column:
    """reasoning followed by one of the closing sentences, drawn by hash from key."""
    pick = drawn(key, len(CONCLUSIONS)) + 1
    return F.concat(reasoning, F.lit(" "), F.replace(F.element_at(F.array(*[F.lit(t) for t in CONCLUSIONS]), pick), F.lit("{}"), answer))
