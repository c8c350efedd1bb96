"""Structural validators of generated items as boolean columns: true is bad, and so is what cannot be judged.

Removal is by index: one bad item takes every row of its index with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
LETTERS = tuple("ABCDEFG")
HALLUCINATION = ("fake_answer", "fake_references", "deficient_question", "deficient_answer", "usable")
PREFERENCE = ("A", "B", "E")
CLASSIFICATION = ("knowledge_accounting", "knowledge_market", "math_accounting", "math_market", "quant", "law", "no")


def _or_bad(x: Column) -> Column:
    return F.coalesce(x, F.lit(True))


def option_errors(options: Column) -> Column:
    """A batch: some question has not 4 to 7 options, or its j-th option does not start with the j-th letter, a dot and a space."""
    one = lambda x, j: _or_bad(~x.rlike("^[A-G]\\. ") | (F.left(x, F.lit(1)) != F.char(F.lit(65) + j)))
    wrong = lambda o: _or_bad(~F.size(o).between(4, 7) | F.exists(F.transform(o, one), lambda b: b))
    return _or_bad(F.exists(options, wrong))


def answer_errors(answer: Column, options: Column) -> Column:
    """A batch: an answer, as far as both lists reach, is no letter of its options, or an option is empty."""
    def wrong(i: Column) -> Column:
        a, o = F.get(answer, i), F.get(options, i)
        return _or_bad(~a.isin(*LETTERS) | ~F.array_contains(F.transform(o, lambda x: F.left(x, F.lit(1))), a) | F.exists(o, lambda x: x.isNull() | (x == "")))

    n = F.least(F.size(answer), F.size(options))
    places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).when(n == 0, F.array().cast("array<int>"))
    return _or_bad(F.exists(places, wrong))


def num_matching_errors(*lists: Column) -> Column:
    """A batch: its lists differ in length."""
    sizes = [F.size(c) for c in lists]
    wrong = F.lit(False)
    for s in sizes[1:]:
        wrong = wrong | (s != sizes[0])
    return _or_bad(wrong)


def deficient_errors(n: int, *lists: Column) -> Column:
    """A batch: some list has not n items."""
    wrong = F.lit(False)
    for c in lists:
        wrong = wrong | (F.size(c) != n)
    return _or_bad(wrong)


def reasoning_errors(reasoning: Column, options: Column) -> Column:
    """An item: its reasoning names a letter of its options that stands by itself among ASCII letters and digits."""
    n = F.size(options)
    pattern = F.concat(F.lit("(^|[^A-Za-z0-9])[A-"), F.char(F.lit(64) + F.least(n, F.lit(26))), F.lit("]([^A-Za-z0-9]|$)"))
    return F.when(n == 0, F.lit(False)).otherwise(_or_bad(F.regexp_like(reasoning, pattern)))


def label_errors(label: Column, allowed: tuple[str, ...]) -> Column:
    return ~F.coalesce(label.isin(*allowed), F.lit(False))


def preference_errors(preference: Column) -> Column:
    """A batch: some choice is not among the three."""
    return _or_bad(F.exists(preference, lambda p: _or_bad(~p.isin(*PREFERENCE))))


def unusable(label: Column, compat: bool = False) -> Column:
    """Not judged usable. compat: any part of the word passes too, as '' or 'us'."""
    return ~F.coalesce(F.call_function("instr", F.lit("usable"), label) > 0 if compat else label == "usable", F.lit(False))


def survivors(df: DataFrame, bad: Column, index: str = "index") -> tuple[DataFrame, DataFrame]:
    """Rows whose index has no bad row, and the distinct bad indexes."""
    gone = df.filter(bad).select(index).distinct()
    return df.join(gone, index, "left_anti"), gone


def bad_indexes(df: DataFrame, bad: Column, index: str = "index") -> DataFrame:
    """The distinct indexes of bad rows, in order."""
    return df.filter(bad).select(index).distinct().orderBy(index)


def mcqa_batch_error(n: int) -> Column:
    """All batch validators in order of cost, as one pass; the first that fails decides."""
    c = F.col
    return (
        option_errors(c("options"))
        | answer_errors(c("answer"), c("options"))
        | num_matching_errors(c("question"), c("answer"), c("options"), c("reasoning_process"))
        | deficient_errors(n, c("question"), c("answer"), c("options"), c("reasoning_process"))
        | F.exists(F.sequence(F.lit(0), F.greatest(F.size("options"), F.lit(1)) - 1), lambda i: reasoning_errors(F.get(c("reasoning_process"), i), F.coalesce(F.get(c("options"), i), F.array().cast("array<string>"))))
    )


def over_tolerance(errors, total, ratio: float):
    """More errors than the tolerated share, of which at least one is always tolerated: of numbers, or of columns."""
    if isinstance(errors, Column):
        return errors > F.greatest(F.lit(1), F.floor(F.lit(ratio) * total))
    return errors > max(1, int(ratio * total))
