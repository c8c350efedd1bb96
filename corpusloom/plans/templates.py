"""Prompt templates: text files compiled to one column expression each.

A template has {{ expressions }}, {% if %} with {% elif %} and {% else %}, {% block %}s,
{% extends "file" %}, {% include "file" %} and {# notes #}; a minus sign inside a tag cuts
the white space on that side, and the last line break of a file does not count.
Expressions know names, texts, numbers, + - * // %, comparisons, and, or, not, `a if b
else c`, and the filters join, upper, lower, trim, length and default. `super()` in a
block is the same block of the template it extends.

Compiling happens on the driver, once a template; what comes out is concat and CASE over
the columns given, so that rendering stays in generated code and no row meets Python.
Everything that can be wrong is an error while compiling: names that nobody gave, files
that don't exist, files that extend or include themselves, tags without an end, and
expressions that are none of the above.

Null is the empty text where it is printed, and false where it is a condition, as are
the empty text, the empty list and zero. Names may be given as None: then they are null.
"""

from __future__ import annotations

import ast
import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import cache, reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, NumericType

_TAG = re.compile("|".join(rf"\{{{a}(?P<left_{k}>-?)(?P<{k}>.*?)(?P<right_{k}>-?){b}\}}" for k, a, b in (("print", r"\{", r"\}"), ("tag", "%", "%"), ("note", "#", "#"))), re.S)


class TemplateError(ValueError):
    """A template that can't be compiled."""


# --- files to nodes ----------------------------------------------------------


@dataclass
class Node:
    """kind: text, print, if, block, include. parts: of an if, (condition, nodes) pairs, the last condition None for else."""

    kind: str
    value: str = ""
    nodes: list = field(default_factory=list)
    parts: list = field(default_factory=list)


@dataclass
class Parsed:
    parent: str | None
    nodes: list[Node]
    blocks: dict[str, Node]


def tokens(text: str) -> list[tuple[str, str]]:
    """(kind, contents) of texts and tags, white space cut where a tag asks for it."""
    out, at, cut = [], 0, False
    text = text.removesuffix("\n")
    for m in _TAG.finditer(text):
        kind = next(k for k in ("print", "tag", "note") if m[k] is not None)
        before = text[at : m.start()]
        before = before.lstrip() if cut else before
        out.append(("text", before.rstrip() if m[f"left_{kind}"] else before))
        if kind != "note":
            out.append((kind, m[kind].strip()))
        at, cut = m.end(), bool(m[f"right_{kind}"])
    rest = text[at:]
    out.append(("text", rest.lstrip() if cut else rest))
    stray = next((x for k, x in out if k == "text" and re.search(r"\{[{%]|[}%]\}", x)), None)
    if stray is not None:
        raise TemplateError(f"half a tag in {stray!r}")
    return [(k, x) for k, x in out if x or k != "text"]


def _named(rest: str, tag: str) -> str:
    m = re.fullmatch(r"""(['"])(.+)\1""", rest)
    if not m:
        raise TemplateError(f"{tag} takes the name of a file in quotes, not {rest!r}")
    return m.group(2)


def parsed(text: str) -> Parsed:
    root = Node("root")
    # Open tags: (node, where its nodes go).
    stack, parent, blocks = [(root, root.nodes)], None, {}

    def close(kind: str, tag: str) -> Node:
        if stack[-1][0].kind != kind:
            raise TemplateError(f"{tag} without {kind}")
        return stack.pop()[0]

    for kind, value in tokens(text):
        to = stack[-1][1]
        if kind != "tag":
            to.append(Node(kind, value))
            continue
        tag, _, rest = value.partition(" ")
        rest = rest.strip()
        if tag == "extends":
            if parent or len(stack) > 1:
                raise TemplateError("extends comes once, and not inside a tag")
            parent = _named(rest, tag)
        elif tag == "include":
            to.append(Node("include", _named(rest, tag)))
        elif tag == "block":
            if not rest.isidentifier() or rest in blocks:
                raise TemplateError(f"a block needs a name of its own, not {rest!r}")
            node = blocks[rest] = Node("block", rest)
            to.append(node)
            stack.append((node, node.nodes))
        elif tag == "endblock":
            node = close("block", value)
            if rest not in ("", node.value):
                raise TemplateError(f"endblock {rest} ends block {node.value}")
        elif tag == "if":
            node = Node("if", parts=[(rest, [])])
            to.append(node)
            stack.append((node, node.parts[-1][1]))
        elif tag in ("elif", "else"):
            node = close("if", value)
            if node.parts[-1][0] is None or (tag == "else" and rest):
                raise TemplateError(f"{value} after else")
            node.parts.append((rest if tag == "elif" else None, []))
            stack.append((node, node.parts[-1][1]))
        elif tag == "endif":
            close("if", value)
        else:
            raise TemplateError(f"unknown tag {tag!r}")
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0].kind} without an end")
    return Parsed(parent, root.nodes, blocks)


# --- nodes to columns ----------------------------------------------------------


@dataclass
class Value:
    """A column and what it is: text, number, truth, list or null."""

    column: Column
    kind: str

    def text(self) -> Column:
        if self.kind == "null":
            return F.lit("")
        if self.kind == "list":
            raise TemplateError("a list is printed by way of join")
        return F.coalesce(self.column.cast("string"), F.lit(""))

    def truth(self) -> Column:
        column = {"text": lambda c: F.length(c) > 0, "number": lambda c: c != 0, "list": lambda c: F.size(c) > 0, "truth": lambda c: c, "null": lambda c: F.lit(False)}[self.kind](self.column)
        return F.coalesce(column, F.lit(False))


_ARITHMETIC = {ast.Sub: lambda a, b: a - b, ast.Mult: lambda a, b: a * b, ast.FloorDiv: lambda a, b: F.floor(a / b), ast.Mod: lambda a, b: F.pmod(a, b)}
_COMPARED = {ast.Eq: lambda a, b: a == b, ast.NotEq: lambda a, b: a != b, ast.Lt: lambda a, b: a < b, ast.LtE: lambda a, b: a <= b, ast.Gt: lambda a, b: a > b, ast.GtE: lambda a, b: a >= b}


def _filtered(name: str, x: Value, args: list[Value]) -> Value:
    if name == "join":
        if x.kind not in ("list", "null"):
            raise TemplateError("join takes a list")
        return Value(F.call_function("array_join", x.column, args[0].column if args else F.lit("")), "text") if x.kind == "list" else Value(F.lit(""), "text")
    if name == "default":
        return Value(F.when(x.column.isNotNull(), x.text()).otherwise(args[0].text()), "text")
    if name == "length":
        return Value(F.size(x.column) if x.kind == "list" else F.length(x.text()), "number")
    if name in ("upper", "lower", "trim"):
        return Value(getattr(F, name)(x.text()), "text")
    raise TemplateError(f"unknown filter {name!r}")


def expression(text: str, names: Mapping[str, Value], above: Callable[[], Column] | None = None) -> Value:
    """The value of an expression. above: what super() is."""
    try:
        tree = ast.parse(text.strip(), mode="eval").body
    except SyntaxError as e:
        raise TemplateError(f"no expression: {text!r}") from e

    def of(node: ast.expr) -> Value:
        match node:
            case ast.Name(id=name):
                if name not in names:
                    raise TemplateError(f"nothing is given for {name!r}")
                return names[name]
            case ast.Constant(value=bool() as x):
                return Value(F.lit(x), "truth")
            case ast.Constant(value=int() | float() as x):
                return Value(F.lit(x), "number")
            case ast.Constant(value=str() as x):
                return Value(F.lit(x), "text")
            case ast.Constant(value=None):
                return Value(F.lit(None), "null")
            case ast.UnaryOp(op=ast.Not(), operand=x):
                return Value(~of(x).truth(), "truth")
            case ast.UnaryOp(op=ast.USub(), operand=x):
                return Value(-of(x).column, "number")
            case ast.BoolOp(op=op, values=values):
                return Value(reduce(lambda a, b: a & b if isinstance(op, ast.And) else a | b, [of(v).truth() for v in values]), "truth")
            case ast.Compare(left=a, ops=ops, comparators=others) if all(type(op) in _COMPARED for op in ops):
                chain = [of(a), *map(of, others)]
                return Value(reduce(lambda x, y: x & y, [_COMPARED[type(op)](x.column, y.column) for op, x, y in zip(ops, chain, chain[1:])]), "truth")
            case ast.IfExp(test=test, body=a, orelse=b):
                return Value(F.when(of(test).truth(), of(a).text()).otherwise(of(b).text()), "text")
            case ast.BinOp(op=ast.BitOr(), left=x, right=ast.Name(id=name)) if not isinstance(x, ast.BinOp) or isinstance(x.op, ast.BitOr):
                return _filtered(name, of(x), [])
            case ast.BinOp(op=ast.BitOr(), left=x, right=ast.Call(func=ast.Name(id=name), args=args, keywords=[])) if not isinstance(x, ast.BinOp) or isinstance(x.op, ast.BitOr):
                return _filtered(name, of(x), [of(a) for a in args])
            case ast.BinOp(op=ast.Add(), left=a, right=b):
                a, b = of(a), of(b)
                return Value(F.concat(a.text(), b.text()), "text") if "text" in (a.kind, b.kind) else Value(a.column + b.column, "number")
            case ast.BinOp(op=op, left=a, right=b) if type(op) in _ARITHMETIC:
                return Value(_ARITHMETIC[type(op)](of(a).column, of(b).column), "number")
            case ast.Call(func=ast.Name(id="super"), args=[], keywords=[]) if above:
                return Value(above(), "text")
        raise TemplateError(f"an expression that templates don't know: {text!r}")

    return of(tree)


def _joined(parts: list[Column]) -> Column:
    return F.lit("") if not parts else parts[0] if len(parts) == 1 else F.concat(*parts)


def _kind(dtype: DataType) -> str:
    return "number" if isinstance(dtype, NumericType) else "truth" if isinstance(dtype, BooleanType) else "list" if isinstance(dtype, ArrayType) else "text"


class Library:
    """Templates by file name."""

    def __init__(self, texts: Mapping[str, str]):
        self.texts = dict(texts)
        self._parsed: dict[str, Parsed] = {}

    @staticmethod
    def of_folder(folder: str | Path) -> Library:
        """The .txt files of a folder of the driver."""
        return Library({p.name: p.read_text(encoding="utf-8") for p in sorted(Path(folder).glob("*.txt"))})

    @staticmethod
    def of_path(spark: SparkSession, path: str) -> Library:
        """The .txt files below any path that Spark reads: templates are few and small, and come to the driver to be compiled."""
        rows = spark.read.option("pathGlobFilter", "*.txt").option("recursiveFileLookup", True).text(path, wholetext=True).selectExpr("element_at(split(_metadata.file_path, '/'), -1) AS name", "value").collect()
        if len({r.name for r in rows}) < len(rows):
            raise TemplateError(f"several templates of one name below {path}")
        return Library({r.name: r.value for r in rows})

    def file(self, name: str) -> Parsed:
        if name not in self.texts:
            raise TemplateError(f"no template {name!r}")
        if name not in self._parsed:
            self._parsed[name] = parsed(self.texts[name])
        return self._parsed[name]

    def lineage(self, name: str) -> list[Parsed]:
        """The template and those it extends, the root last."""
        seen, out = [], []
        while name is not None:
            if name in seen:
                raise TemplateError(f"{' extends '.join([*seen, name])}")
            seen.append(name)
            out.append(self.file(name))
            name = out[-1].parent
        return out

    def names(self, name: str) -> set[str]:
        """The names a template, its parents and what it includes ask for."""
        found: set[str] = set()

        class All(dict):
            def __contains__(self, key):
                found.add(key)
                return True

            def __missing__(self, key):
                return Value(F.lit(None), "null")

        self.compiled(name, All())
        return found

    def compiled(self, name: str, names: Mapping[str, Value], within: tuple[str, ...] = ()) -> Column:
        """The text of a template as a column."""
        if name in within:
            raise TemplateError(f"{' includes '.join([*within, name])}")
        family, within = self.lineage(name), (*within, name)
        # The versions of each block, that of the template itself first.
        versions: dict[str, list[Node]] = {}
        for p in family:
            for key, node in p.blocks.items():
                versions.setdefault(key, []).append(node)

        def block(key: str, level: int) -> Column:
            if level >= len(versions[key]):
                raise TemplateError(f"super() in block {key} of a template that has nothing above")
            return body(versions[key][level].nodes, lambda: block(key, level + 1))

        def body(nodes: list[Node], above: Callable[[], Column] | None) -> Column:
            return _joined([one(n, above) for n in nodes])

        def one(node: Node, above: Callable[[], Column] | None) -> Column:
            if node.kind == "text":
                return F.lit(node.value)
            if node.kind == "print":
                return expression(node.value, names, above).text()
            if node.kind == "include":
                return self.compiled(node.value, names, within)
            if node.kind == "block":
                return block(node.value, 0)
            out = F.lit("")
            for condition, inside in reversed(node.parts):
                inside = body(inside, above)
                out = inside if condition is None else F.when(expression(condition, names, above).truth(), inside).otherwise(out)
            return out

        return body(family[-1].nodes, None)

    def column(self, name: str, given: Mapping[str, tuple[Column, str] | Column | str | int | float | bool | None]) -> Column:
        """A template as a column. given: constants, None, texts as columns, or (column, kind) with kind text, number, truth or list."""

        def value(x) -> Value:
            if x is None:
                return Value(F.lit(None).cast("string"), "null")
            if isinstance(x, tuple):
                return Value(*x)
            if isinstance(x, Column):
                return Value(x, "text")
            return Value(F.lit(x), "truth" if isinstance(x, bool) else "number" if isinstance(x, int | float) else "text")

        return self.compiled(name, {k: value(v) for k, v in given.items()})

    def render(self, df: DataFrame, name: str, to: str = "prompt", **given: Column | str | int | float | bool | None) -> DataFrame:
        """df with a column of rendered texts. Names are those of given, and else of df's columns; kinds come from df's types."""
        columns = {k: v for k, v in given.items() if isinstance(v, Column)}
        own = {c: F.col(f"`{c}`") for c in df.columns if c not in given and c.isidentifier()}
        types = df.select(*[c.alias(k) for k, c in (own | columns).items()]).schema
        return df.withColumn(to, self.column(name, given | {f.name: ((own | columns)[f.name], _kind(f.dataType)) for f in types}))


@cache
def library() -> Library:
    """The templates that come with this package."""
    return Library.of_folder(Path(__file__).with_suffix(""))
