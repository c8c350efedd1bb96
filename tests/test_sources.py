"""Readers against files made here, byte by byte."""

import io
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators import curate, validate
from corpusloom.operators.ordinal import numbered, positions
from corpusloom.plans import barrier
from corpusloom.sources import extract, files, pdf, rest, sheet


def pdf_file(pages, flate=True, packed=False):
    """A file of pages of content streams; packed: dictionaries lie in an object stream."""
    font = b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica >>"
    table = b"2 beginbfchar <0001> <AC00> <0002> <00E9> endbfchar 1 beginbfrange <0010> <0012> <0041> endbfrange"
    plain = {1: b"<< /Type /Catalog /Pages 2 0 R >>", 3: font, 4: b"<< /Type /Font /Subtype /Type0 /ToUnicode 5 0 R >>"}
    streams, kids = {5: table}, []
    for i, content in enumerate(pages):
        page, stream = 10 + 2 * i, 11 + 2 * i
        own = b"" if i else b" /Resources << /Font << /F1 3 0 R /F2 4 0 R >> >>"
        plain[page], streams[stream] = b"<< /Type /Page /Parent 2 0 R%s /Contents %d 0 R >>" % (own, stream), content
        kids.append(b"%d 0 R" % page)
    plain[2] = b"<< /Type /Pages /Kids [%s] /Count %d /Resources << /Font << /F1 3 0 R /F2 4 0 R >> >> >>" % (b" ".join(kids), len(pages))
    if packed:
        body, head = b"", b""
        for n, text in plain.items():
            head += b"%d %d " % (n, len(body))
            body += text + b" "
        streams[90] = head + body
    out = b"%PDF-1.7\n"
    if not packed:
        out += b"".join(b"%d 0 obj\n%s\nendobj\n" % x for x in plain.items())
    for n, data in streams.items():
        more = b" /Type /ObjStm /N %d /First %d" % (len(plain), len(head)) if n == 90 else b""
        data = zlib.compress(data) if flate else data
        out += b"%d 0 obj\n<< /Length %d%s%s >>\nstream\n%s\nendstream\nendobj\n" % (n, len(data), b" /Filter /FlateDecode" if flate else b"", more, data)
    return out + b"trailer << /Root 1 0 R >>\n%%EOF"


PAGES = [b"BT /F1 12 Tf 72 700 Td (Hello \\(a\\) \\101) Tj 0 -14 Td [(Wor) 20 (ld) -300 (again)] TJ ET", b"", b"BT /F2 12 Tf 1 0 0 1 72 700 Tm <00010002> Tj T* <001000110012> Tj ET"]


@pytest.mark.parametrize(("flate", "packed"), [(False, False), (True, False), (True, True)])
def test_pdf(spark, tmp_path, flate, packed):
    data = pdf_file(PAGES, flate, packed)
    assert pdf.pages(data) == ["Hello (a) A\nWorld again\n", "", "가é\nABC\n"]
    (tmp_path / "a.pdf").write_bytes(data)
    rows = extract.pdf_pages(spark, str(tmp_path / "*.pdf"), "t")
    assert sorted((r.page, r.title, r.contents) for r in rows.collect()) == [(0, "t", "Hello (a) A\nWorld again\n"), (2, "t", "가é\nABC\n")]
    assert extract.pdf_full_text(rows).first().contents == "Hello (a) A\nWorld again\n\n가é\nABC\n"


def test_pdf_that_is_none():
    for data in (b"", b"%PDF-1.4", b"1 0 obj << /Type /Catalog >> endobj", pdf_file(PAGES)[:300], b"1 0 obj <</Type/Catalog/Pages 2 0 R>> endobj 2 0 obj <</Kids[2 0 R]>> endobj"):
        assert isinstance(pdf.pages(data), list)


def workbook(rows, shared):
    cell = lambda r, c, v: f'<c r="{chr(65 + c)}{r}" t="s"><v>{shared.index(v)}</v></c>' if isinstance(v, str) and v in shared else f'<c r="{chr(65 + c)}{r}"><v>{v}</v></c>' if not isinstance(v, str) else f'<c r="{chr(65 + c)}{r}" t="inlineStr"><is><t>{v}</t></is></c>'
    body = "".join(f'<row r="{r}">' + "".join(cell(r, c, v) for c, v in enumerate(row) if v is not None) + "</row>" for r, row in enumerate(rows, 1))
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="other" sheetId="1" r:id="r1"/><sheet name="terms" sheetId="2" r:id="r2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/s1.xml"/><Relationship Id="r2" Target="/xl/worksheets/s2.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}>" + "".join(f"<si><r><t>{x[:1]}</t></r><r><t>{x[1:]}</t></r></si>" for x in shared) + "</sst>")
        z.writestr("xl/worksheets/s1.xml", f"<worksheet {ns}><sheetData/></worksheet>")
        z.writestr("xl/worksheets/s2.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")
    return out.getvalue()


def test_sheet(spark, tmp_path):
    rows = [["용어", "설명", None, "n"], ["금리", "돈의 값", None, 3], [None, None], ["환율", None, "x", 4.5]]
    (tmp_path / "g.xlsx").write_bytes(workbook(rows, ["용어", "설명", "금리"]))
    df = sheet.read_sheet(spark, str(tmp_path / "g.xlsx"), "terms", {"용어": "title", "설명": "contents"})
    assert df.columns == ["title", "contents", "column_2", "n"]
    assert [tuple(r) for r in df.collect()] == [("금리", "돈의 값", None, "3"), ("환율", None, "x", "4.5")]


def test_filings_need_not_be_well_formed():
    filing = '<DOCUMENT><SECTION-1><TITLE>I. 회사의 개요</TITLE><P>no</SECTION-1><SECTION-1 A=x><TITLE ATOC="Y">II. 사업의 내용</TITLE><P>첫 & 둘<BR>셋<TABLE><TR><TD>no</TD></TR></TABLE><SECTION-2><TITLE>세부</TITLE><P>끝</SECTION-2></SECTION-1><SECTION-1>no</SECTION-1>'
    assert extract.section_text(filing) == "II. 사업의 내용\n첫 & 둘\n셋\n세부\n끝"
    assert extract.section_text("<title>사업의 내용</title>") is None and extract.section_text("") is None


def test_search_asks_once_and_keeps_errors(spark, tmp_path):
    log = str(tmp_path / "calls")

    def transport(url, headers):
        with open(log, "a") as f:
            f.write(url + "\n")
        if "query=b" in url:
            raise OSError("down")
        return b'{"items": [{"a": 1}, {"a": 2}]}'

    got = rest.search(spark, "https://example.org/search", ["a", "b"], {}, transport=transport)
    assert got.filter("status = 'ok'").count() == 2 and got.filter("status = 'error'").first().error == "OSError: down"
    assert len(open(log).readlines()) == 2


def test_split_files_and_error_files(spark, tmp_path):
    df = spark.createDataFrame([(i, "x" * 50_000) for i in range(100)], "i int, s string")
    n = files.write_multi_jsonl(df, str(tmp_path), "out", ["i"], 1)
    assert n == 5 and sorted(p.name for p in tmp_path.iterdir()) == [f"out_{i}.jsonl" for i in range(n)]
    assert [r.i for r in files.read_jsonl(spark, str(tmp_path / "out_0.jsonl"), "i int").orderBy("i").collect()] == list(range(20))
    assert files.read_multi_jsonl(spark, str(tmp_path), "i int").distinct().count() == 100
    path = files.write_errors(df.limit(2), str(tmp_path / "logs"), "step", ValueError("bad"))
    assert [r.error for r in files.read_jsonl(spark, path).collect()] == ["bad"] * 2


def test_token_counts_by_vocabulary(spark):
    import base64

    import public_tokenizers as public
    import tiktoken
    from tokenizers import Tokenizer

    texts = ["Hello world", "", None, "가나다 <|endoftext|> 12345 été", " " * 9 + "x\n\n", "a" * 5000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    t = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    want = [len(t.encode(x or "", add_special_tokens=False).ids) for x in texts]
    assert [r.n for r in df.select("i", T.bpe_tokens(spark, public.path("byte_bpe_50k.json"))("t").alias("n")).orderBy("i").collect()] == want
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in open(public.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    e = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = df.select("i", T.bpe_tokens(spark, public.path("byte_bpe_multi_50k.tiktoken"))("t").alias("n")).orderBy("i").collect()
    assert [r.n for r in got] == [len(e.encode_ordinary(x or "")) for x in texts]


def test_reports_and_positions(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2] if i else None, "qa", "x") for i in range(7)], "i int, v string, type string, _at string")
    r = curate.spec_report(df, "v").first()
    assert (r.total, r.distinct, r.counts) == (7, [None, "a", "b"], {"a": 3, "b": 3})
    with pytest.raises(Exception, match="more than 2 values"):
        curate.spec_report(df, "v", 2).collect()
    assert curate.single_value(df) == "qa"
    for bad in (df.filter("false"), df.withColumn("type", F.col("v"))):
        with pytest.raises(ValueError, match="value"):
            curate.single_value(bad)
    assert [x.i for x in curate.at_positions(df, ["i"], 2, 4).orderBy("i").collect()] == [2, 3] and curate.at_positions(df, ["i"], 3).first().i == 3
    assert curate.at_positions(df, ["i"], 2).columns == df.columns
    shown = curate.show_sample(df.withColumnRenamed("v", "question"), F.col("i"), 3)
    assert shown.columns == ["question"] and shown.count() == 3
    assert curate.show_sample(df, F.col("i"), 3, "qa", all_columns=True, drawn=False, order=["i"]).columns == df.columns
    assert [x.i for x in validate.bad_indexes(df, F.col("v") == "a", "i").collect()] == [2, 4, 6]


def test_numbers_of_rows_that_are_alike(spark):
    df = spark.createDataFrame([(i % 3, "w" * 10, 1, 2, 3) for i in range(200)], "k int, t string, _tie int, _part int, _row int")
    for f in (numbered, positions):
        got = f(df, ["k"], "at")
        assert got.columns == [*df.columns, "at"]
        rows = sorted((r.at, r.k) for r in got.collect())
        assert [a for a, _ in rows] == list(range(200)) and [k for _, k in rows] == sorted(i % 3 for i in range(200))
        sums = sorted(r.at for r in f(df, ["k"], "at", F.col("_part")).collect())
        assert sums == list(range(0, 400, 2))


def test_shared_folder(spark, tmp_path):
    df = barrier.barrier(spark.range(5), "x")
    folder = barrier.shared_folder(spark)
    assert df.count() == 5 and folder.startswith(spark.conf.get("spark.checkpoint.dir"))

    class Context:
        master, applicationId = "spark://host:7077", "app"

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="share"):
        barrier.shared_folder(Session())
    Context.master = "local[2]"
    assert barrier.shared_folder(Session()).endswith("corpusloom-app")
