"""Markup as intervals, against the reader that builds trees."""

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.sources import elements, extract


def filing(r, depth=0):
    """A random document: nested sections, tables and titles, attributes with angle brackets, references, comments."""
    words = ["사업의 내용", "II. 사업의 내용", "개요", " a&amp;b ", "&#44032;&lt;x&gt;", "x & y", "\n", " ", "5 > 3", "&nbsp;", "&unknown;", "끝"]
    out = []
    for _ in range(r.randint(1, 4)):
        tag = r.choice(["SECTION-1", "section-1", "SECTION-2", "P", "TABLE", "TITLE", "B"])
        inside = filing(r, depth + 1) if depth < 5 and tag != "TITLE" and r.random() < 0.7 else r.choice(words)
        attrs = r.choice(["", "", ' A="1>2"', " B='<'", " c=d "])
        out.append(r.choice([f"<{tag}{attrs}>{inside}</{tag.lower() if r.random() < 0.3 else tag}>", r.choice(words), "<BR>", "<img src='a'/>", "<!-- <TITLE>사업의 내용</TITLE> -->"]) if r.random() < 0.5 else f"<{tag}{attrs}>{inside}</{tag}>")
    return "".join(out)


def texts(spark, docs):
    rows = spark.createDataFrame(list(enumerate(docs)), "i int, m string")
    return [r.text for r in elements.section_texts(rows, "m").orderBy("i").collect()]


def test_sections_of_random_filings(spark, monkeypatch):
    """Intervals give what the tree gives; what isn't well formed goes through the tree."""
    r = random.Random(8)
    docs = [filing(r) for _ in range(300)]
    # References that XML doesn't know stay as they are in the structured way: compare where there are none.
    docs = [d.replace("&nbsp;", "-").replace("&unknown;", "-") for d in docs]
    want = [extract.section_text(d) for d in docs]
    assert texts(spark, docs) == want and sum(w is not None for w in want) >= 20
    rows = elements.tokens(spark.createDataFrame(list(enumerate(docs)), "key int, m string"), "key", "m")
    good = {x.key for x in elements.well_formed(rows, elements.elements(rows)).collect()}
    assert good == {x.key for x in rows.filter("kind = 'start'").select("key").distinct().collect()}


@pytest.mark.parametrize(
    ("doc", "want"),
    [
        (None, None),
        ("", None),
        ("no markup", None),
        ("<SECTION-1><TITLE>사업의 내용</TITLE></SECTION-1>", "사업의 내용"),
        ("<TITLE>사업의 내용</TITLE>", None),
        ("<SECTION-1><TITLE>다른</TITLE>x</SECTION-1>", None),
        ("<SECTION-1>a<SECTION-1>b<TITLE>1. 사업의 내용</TITLE>c</SECTION-1>d</SECTION-1>", "b\n1. 사업의 내용\nc"),
        ("<SECTION-1><TABLE><TR><TD><TITLE>사업의 내용</TITLE></TD></TR></TABLE>out</SECTION-1>", "out"),
        ("<SECTION-1><TITLE>사업의 <B>내용</B></TITLE>a</SECTION-1>", "사업의\n내용\na"),
        ("<SECTION-1><TITLE>사업의 내용</TITLE>a<SECTION-1><TITLE>사업의 내용</TITLE>b</SECTION-1></SECTION-1>", "사업의 내용\na\n사업의 내용\nb"),
        ("<SECTION-1><TITLE>사업의 내용</TITLE>1 < 2 &amp; 3 &gt; 2 &bogus; &#x41;</SECTION-1>", "사업의 내용\n1\n<\n2 & 3 > 2 &bogus; A"),
        ("<SECTION-1><TITLE>사업의 내용</TITLE><P>open</SECTION-1>", "사업의 내용\nopen"),
        ("</P><SECTION-1><TITLE>사업의 내용</TITLE></SECTION-1>", "사업의 내용"),
        ("<SECTION-1><TITLE>사업의 내용</TITLE><![CDATA[<b> & ]]>z</SECTION-1>", "사업의 내용\n<b> &\nz"),
        ("<SECTION-1><TITLE>사업의 내용</TITLE> 　 \xa0x </SECTION-1>", "사업의 내용\nx"),
    ],
)
def test_sections(spark, doc, want):
    assert texts(spark, [doc, doc]) == [want, want]
    named = spark.createDataFrame([(7, doc)], "i int, m string")
    assert [tuple(r) for r in elements.section_texts(named, "m", by="i").select("i", "text").collect()] == [(7, want)]


def test_intervals(spark):
    rows = elements.tokens(spark.createDataFrame([(1, "<a><b>x</b><c/><b><b>y</b></b></a>"), (2, "<a><b></a></b>"), (3, "</a><a>")], "key int, m string"), "key", "m")
    found = elements.elements(rows)
    assert sorted((r.tag, r.first, r.last, r.level) for r in found.filter("key = 1").collect()) == [("a", 0, 10, 1), ("b", 1, 3, 2), ("b", 5, 9, 2), ("b", 6, 8, 3)]
    assert [r.key for r in elements.well_formed(rows, found).collect()] == [1]
    points = spark.createDataFrame([(1, 7)], "key int, at int")
    assert tuple(elements.nearest(points, found, "b").first()) == (1, 6, 8) and elements.nearest(points, found, "c").collect() == []


def test_long_documents_and_clashing_names(spark):
    """A hundred thousand elements, and columns named as the helpers' own."""
    doc = "<SECTION-1><TITLE>사업의 내용</TITLE>" + "<P>a<TABLE>t</TABLE></P>" * 50_000 + "</SECTION-1>"
    rows = spark.createDataFrame([(doc, 1, 2, "old")], "m string, key int, pos int, text string")
    got = elements.section_texts(rows, "m")
    assert got.columns == ["m", "key", "pos", "text"]
    assert got.select("key", "pos", F.length("text")).first()[:] == (1, 2, len("사업의 내용") + 2 * 50_000)
