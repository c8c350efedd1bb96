"""Markup as rows: elements as intervals of token positions, and questions about structure as conditions on these.

A document becomes tokens (tags, texts, the rest), numbered in order. Running sums over a
document give each token its depth and how many elements of some name are open around
it; an element is the interval from its start tag to the next tag of the same level, which
is its end. "Inside" is then a position within an interval, the nearest ancestor is the
containing interval that starts last, and "not in a table" is a running count of zero: no
tree is built, and no strings meet elements in pairs. All of it is SQL functions and
windows by document; what they sort are names and places of tags, and texts.

What isn't well formed (an end without its start, a start without its end) is told by the
same rows, and goes through the lenient reader of `extract` instead.

A null or empty document has no text; so has one without the title or a section around it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import WHITE
from ..plans.barrier import barrier, fresh
from . import extract

_QUOTED = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
#: Comments, marked sections, instructions, tags, texts; a < that opens none of these is a text of its own.
TOKEN = rf"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<[?!][^>]*+>|</?[A-Za-z]{_QUOTED}>|[^<]++|<"
# The entities that XML itself has.
_KNOWN = r"&(?!(?:amp|lt|gt|quot|apos|#[0-9]{1,7}|#x[0-9A-Fa-f]{1,6});)"
_EDGE = WHITE + "+"


def decoded(text: Column) -> Column:
    """Character references of a text resolved by Spark's own XML reader; those that XML doesn't have stay as they are."""
    marked = F.concat(F.lit("<r><v>|"), F.regexp_replace(F.regexp_replace(text, _KNOWN, "&amp;"), "<", "&lt;"), F.lit("|</v></r>"))
    read = F.from_xml(marked, "v string", {"ignoreSurroundingSpaces": "false"})["v"]
    return F.when(F.contains(text, F.lit("&")), F.coalesce(F.regexp_replace(read, r"(?s)^\|(.*)\|$", "$1"), text)).otherwise(text)


def trimmed(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{_EDGE}|{_EDGE}$", "")


def tokens(documents: DataFrame, key: str, markup: str, around: tuple[str, ...] = (), texts: bool = True) -> DataFrame:
    """key, pos, kind (start, end, text; all else is left out), tag, token (of texts), level, and in_{name}: how many such elements are open, for each name of around.

    texts False: without token, so that only names and places are shuffled; a text is then the token at pos of its document.
    """
    rows = documents.select(F.col(key).alias("key"), F.posexplode(F.regexp_extract_all(F.col(markup), F.lit(TOKEN), F.lit(0))).alias("pos", "token"))
    opens, void = F.startswith("token", F.lit("<")), sorted(extract._VOID)
    tag = F.lower(F.regexp_extract("token", r"^</?([A-Za-z][^\s/>]*)", 1))
    rows = rows.withColumn("tag", F.when(opens, tag).otherwise(""))
    named = (F.col("tag") != "") & ~F.col("tag").isin(*void)
    kind = (
        F.when(named & F.startswith("token", F.lit("</")), "end").when(named & ~F.endswith("token", F.lit("/>")), "start")
        .when(~opens | F.startswith("token", F.lit("<![CDATA[")) | (F.col("token") == "<"), "text")
    )
    rows = rows.withColumn("kind", kind).filter("kind IS NOT NULL")
    rows = rows.withColumns({"token": F.when(F.col("kind") == "text", F.col("token")), "tag": F.when(F.col("kind") != "text", F.col("tag"))})
    rows = rows if texts else rows.drop("token")
    step = F.when(F.col("kind") == "start", 1).when(F.col("kind") == "end", -1).otherwise(0)
    so_far = Window.partitionBy("key").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    depth = F.sum(step).over(so_far)
    opened = {f"in_{name}": F.sum(F.when(F.col("tag") == name, step).otherwise(0)).over(so_far) for name in around}
    return rows.withColumns({"level": F.when(F.col("kind") == "end", depth + 1).otherwise(depth), **opened})


def elements(rows: DataFrame, *carried: str) -> DataFrame:
    """key, tag, level, first, last, closed of tokens(): an interval for each element; closed: its end is of the same name. carried: columns of its start."""
    within = Window.partitionBy("key", "level").orderBy("pos")
    tags = rows.filter("kind IN ('start', 'end')").select("key", "tag", "level", "kind", *carried, F.col("pos").alias("first"), F.lead("pos").over(within).alias("last"), F.lead("kind").over(within).alias("next_kind"), F.lead("tag").over(within).alias("next_tag"))
    closed = (F.col("next_kind") == "end") & (F.col("next_tag") == F.col("tag"))
    return tags.filter("kind = 'start'").select("key", "tag", "level", "first", "last", F.coalesce(closed, F.lit(False)).alias("closed"), *carried)


def well_formed(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The keys of tokens() whose tags pair up, with elements() of the same."""
    ends = rows.filter("kind = 'end'").groupBy("key").agg(F.count("*").alias("ends"), F.min("level").alias("lowest"))
    starts = found.groupBy("key").agg(F.count_if("closed").alias("closed"), F.count("*").alias("starts"))
    return starts.join(ends, "key").filter("closed = starts AND ends = starts AND lowest > 0").select("key")


def nearest(points: DataFrame, found: DataFrame, tag: str) -> DataFrame:
    """key, first, last: of points(key, at), one a document, the innermost element of a name around it."""
    around = points.join(found.filter(F.col("tag") == tag), "key").filter("first < at AND at < last")
    return around.groupBy("key").agg(F.max_by(F.struct("first", "last"), "first").alias("x")).select("key", "x.first", "x.last")


def section_texts(documents: DataFrame, markup: str, to: str = "text", title: str = "사업의 내용", section: str = "section-1", by: str | None = None) -> DataFrame:
    """documents with the text, without tables, of the nearest section around the first title that has the words; strings are lines.

    by: a column that tells documents apart (unique, never null); without one they are numbered and written first.
    """
    key, taken = fresh([*documents.columns, to], "key", "found")
    keyed = documents.withColumn(key, F.col(by)) if by else barrier(documents.withColumn(key, F.monotonically_increasing_id()), "filings")
    each = keyed.filter(F.col(markup).isNotNull()).select(key, markup)
    rows = barrier(tokens(each, key, markup, ("title", "table"), texts=False), "tokens")
    found = barrier(elements(rows, "in_table"), "elements")
    good = well_formed(rows, found)
    # A string in a title belongs to the title that starts last before it.
    owned = rows.filter("in_title > 0 OR kind = 'start' AND tag = 'title'").withColumn("at", F.max(F.when((F.col("kind") == "start") & (F.col("tag") == "title"), F.col("pos"))).over(Window.partitionBy("key").orderBy("pos")))
    titles = owned.filter("kind = 'text'").groupBy("key", "at").agg(F.array_sort(F.collect_list("pos")).alias("places")).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("at", "places"))).alias("titles"))
    sections = found.filter(F.col("tag") == section).groupBy("key").agg(F.collect_list(F.struct("first", "last", "in_table")).alias("sections"))
    strings = rows.filter("kind = 'text'").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("pos", "in_table"))).alias("strings"))
    # What is known of a document's structure is one row of places; its texts are looked up where the document is.
    shape = good.join(titles, "key").join(sections, "key").join(strings, "key").select(F.col("key").alias(key), F.struct("titles", "sections", "strings").alias(taken))
    joined = keyed.filter(F.col(markup).isNotNull()).join(shape, key, "left")
    token, spot, span = fresh([*joined.columns], "token", "spot", "span")

    def string(place: Column) -> Column:
        x = F.get(F.col(token), place)
        return trimmed(F.when(F.startswith(x, F.lit("<![CDATA[")), F.regexp_extract(x, r"(?s)^<!\[CDATA\[(.*)\]\]>$", 1)).otherwise(decoded(x)))

    def lines(places: Column) -> Column:
        return F.filter(F.transform(places, string), lambda x: x != "")

    read = joined.filter(F.col(taken).isNotNull()).withColumn(token, F.regexp_extract_all(F.col(markup), F.lit(TOKEN), F.lit(0)))
    told = F.filter(F.col(taken)["titles"], lambda t: F.contains(F.array_join(lines(t["places"]), " "), F.lit(title)))
    read = read.withColumn(spot, F.get(told, F.lit(0))["at"])
    # The innermost section around it is the one that starts last. Tables around the section don't count: as many are open at its start.
    read = read.withColumn(span, F.array_max(F.filter(F.col(taken)["sections"], lambda x: (x["first"] < F.col(spot)) & (F.col(spot) < x["last"]))))
    inside = F.filter(F.col(taken)["strings"], lambda x: (x["pos"] > F.col(span)["first"]) & (x["pos"] < F.col(span)["last"]) & (x["in_table"] == F.col(span)["in_table"]))
    text = F.when(F.col(span).isNotNull(), F.array_join(lines(F.transform(inside, lambda x: x["pos"])), "\n"))
    columns = [c for c in documents.columns if c != to]
    lenient = joined.filter(F.col(taken).isNull()).withColumn(taken, extract.extract_report(F.col(markup), "xml"))
    out = read.select(*columns, text.alias(to)).unionByName(lenient.select(*columns, F.col(taken).alias(to)))
    return out.unionByName(keyed.filter(F.col(markup).isNull()).select(*columns, F.lit(None).cast("string").alias(to)))
