"""Answers of models checked against a shape, with a path and a reason for everything that is wrong.

A shape is a dict of fields, a list with the shape of its items, or the name of a type
(string, integer, number, boolean). Answers are parsed once, to VARIANT, and the checks
are compiled from the shape to one column of (path, reason) pairs: no answer is thrown
away whole because one item of it is wrong, and nothing turns into null unseen.

Reasons: `no answer`, `no JSON` (cut off, or not JSON at all), `missing`, `null`, and
`expected T, found U`. Fields that a shape doesn't have are passed over,
and so is text after an answer's end, which models like to add.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERRORS = "array<struct<path string, reason string>>"
Shape = dict | list | str
#: Beginnings of what schema_of_variant says of a value, and the names that shapes use; the first that fits counts.
_KINDS = (("OBJECT", "object"), ("ARRAY", "list"), ("STRING", "string"), ("BIGINT", "integer"), ("BOOLEAN", "boolean"), ("DECIMAL", "number"), ("DOUBLE", "number"), ("FLOAT", "number"), ("VOID", "null"))


def _kind(v: Column) -> Column:
    said, out = F.schema_of_variant(v), F.lit("other")
    for start, name in reversed(_KINDS):
        out = F.when(F.startswith(said, F.lit(start)), name).otherwise(out)
    return out


def _one(path: Column, reason: Column | str) -> Column:
    return F.array(F.struct(path.alias("path"), (F.lit(reason) if isinstance(reason, str) else reason).alias("reason")))


def _none() -> Column:
    return F.array().cast(ERRORS)


def _expected(shape: Shape) -> str:
    return "object" if isinstance(shape, dict) else "list" if isinstance(shape, list) else shape


def _checked(v: Column, shape: Shape, path: Column) -> Column:
    """Errors of a variant that is there."""
    want, kind = _expected(shape), _kind(v)
    fits = kind.isin("integer", "number") if want == "number" else kind == want
    wrong = F.when(kind == "null", _one(path, "null")).otherwise(_one(path, F.concat(F.lit(f"expected {want}, found "), kind)))
    if isinstance(shape, dict):
        fields = []
        for name, inner in shape.items():
            at, own = F.concat(path, F.lit(f".{name}")), F.try_variant_get(v, f"$.{name}", "variant")
            fields.append(F.when(own.isNull(), _one(at, "missing")).otherwise(_checked(own, inner, at)))
        below = F.concat(*fields) if fields else _none()
    elif isinstance(shape, list):
        items = F.try_variant_get(v, "$", "array<variant>")
        below = F.flatten(F.transform(items, lambda x, i: _checked(x, shape[0], F.concat(path, F.lit("["), i.cast("string"), F.lit("]")))))
    else:
        below = _none()
    return F.when(fits, below).otherwise(wrong)


def errors(answer: Column, shape: Shape) -> Column:
    """(path, reason) of everything in an answer (JSON text) that isn't as the shape says; none: it is right."""
    v, top = F.try_parse_json(answer), F.lit("$")
    return F.when(answer.isNull(), _one(top, "no answer")).when(v.isNull(), _one(top, "no JSON")).otherwise(_checked(v, shape, top))


def said(found: Column) -> Column:
    """errors() as one line of text; null where there are none."""
    return F.when(F.size(found) > 0, F.array_join(F.transform(found, lambda e: F.concat(e["path"], F.lit(": "), e["reason"])), "; "))


def error_counts(answers: DataFrame, answer: str, shape: Shape) -> DataFrame:
    """path (positions in lists left open), reason, n: how many errors of a kind there are."""
    rows = answers.select(F.explode(errors(F.col(answer), shape)).alias("e"))
    return rows.select(F.regexp_replace("e.path", r"\[\d+\]", "[]").alias("path"), "e.reason").groupBy("path", "reason").agg(F.count("*").alias("n"))
