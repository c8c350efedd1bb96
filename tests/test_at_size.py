"""Queries whose results or tasks went wrong on larger tables."""

import json

import duckdb
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusloom import catalog
from corpusloom.functions import text as T
from corpusloom.operators import quality
from corpusloom.plans.pipelines import Settings
from corpusloom.sources import extract, files


def oracle(name, tmp_path, table):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    return con.execute(catalog.oracle_sql()[name]).fetchall()


def test_html_extract_leaves_references_that_were_cut(spark, tmp_path):
    """Its SQL decodes references with their semicolon only; a text cut within one has none."""
    bodies = ["a &amp; b&amp", "x&am", "c&copy d&copy;", "&amp;lt; &lt;i&gt; &ampx; &#39;q&#x27;&#39", "AT&T &&amp;", ""]
    pages = [(i, f"<html><head><title>t</title></head><body class='k'><p>{b}</p><b>{b}</b><script>&amp</script></body></html>") for i, b in enumerate(bodies)]
    spark.createDataFrame(pages, "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r.text for r in catalog.html_extract(spark, str(tmp_path)).collect()}
    assert got == dict(oracle("html_extract", tmp_path, "pages")) and got[0] == "a & b&amp a & b&amp"
    assert extract.body_text(pages[0][1]) == "a & b&\na & b&"  # the operator reads as browsers do, unless asked not to


TEXTS = ["", None, " \t", "가 나　다 abc", "a" * 9 + " \n b", "😀 x😀y é!", "a  b", "한글!?'\"", "1234", "...a", " end ", "١٢ x", "\x1c\x85k "]


@pytest.mark.parametrize("unicode, normalize", [(True, True), (True, False), (False, True), (False, False)])
def test_quality_filter_says_what_the_columns_say(spark, unicode, normalize):
    df = spark.createDataFrame(list(enumerate(TEXTS * 3)), "i int, contents string")
    c = F.col("contents")
    clean = T.remove_unicode(c) if unicode else c
    clean = T.normalize(clean) if normalize else clean
    for limits in ({"punctuation": 0.4, "english": 0.8, "number": 0.6}, {"english": 0.5}, {"punctuation": 0.2}, {}):
        ratios = {"punctuation": T.punctuation_ratio, "english": T.english_ratio, "number": T.number_ratio}
        want = df
        for name, most in limits.items():
            want = want.filter(T.keeps(ratios[name](c), most))
        want = [tuple(r) for r in want.orderBy("i").select(clean, F.regexp_count(clean, F.lit("[^ ]+"))).collect()]
        options = {k: k in limits for k in ratios} | {f"{k}_ratio": v for k, v in limits.items()} | {"unicode": unicode, "normalize": normalize, "token": False}
        got = quality.quality_filter(df, "t", ["i"], **options)
        assert [tuple(r) for r in got.orderBy("seq").select("contents", "tokens").collect()] == want
        full = quality.quality_filter(df, "t", ["i"], return_type="full", **options).collect()
        whole = "".join(x for x, _ in want if x is not None)
        assert [(r.title, r.contents, r.tokens) for r in full] == [("t", whole, sum(1 for x in whole.split(" ") if x))]


def test_whole_text_is_put_together_from_pieces(spark, monkeypatch):
    """quality_full collected its rows, and the tokens of the whole text, as lists in one task."""
    monkeypatch.setattr(quality, "_PIECE", 7)
    df = spark.createDataFrame([(i, f"가{i} 나 " if i % 3 else f" x{i}") for i in range(50)], "i int, contents string")
    full = quality.quality_filter(df, "t", ["i"], token=False, english=False, number=False, return_type="full")
    plan = full._jdf.queryExecution().executedPlan().toString()
    assert "mapInArrow" in plan or "MapInArrow" in plan
    assert "regexp_extract_all" not in plan
    text = "".join(r.contents for r in df.orderBy("i").collect())
    assert [(r.contents, r.tokens) for r in full.collect()] == [(text, len(text.split()))]


def test_an_empty_text_raises_if_asked(spark):
    df = spark.createDataFrame([(0, "a"), (1, "")], "i int, contents string")
    with pytest.raises(PySparkException, match="a text is empty"):
        quality.quality_filter(df, "t", ["i"], number=False, on_empty="error", token=False).collect()


def test_encodings_are_held_for_a_slice_of_a_batch(spark):
    """token_count_bpe held the encodings of all texts of a batch, 10,000 of them, with their offsets."""
    texts = ["ab" * 50, "", "c" * 1000, "d" * 10] * 3
    parts = list(T.sliced(texts, 120))
    assert [x for p in parts for x in p] == texts and all(len(p) == 1 or sum(map(len, p)) <= 120 for p in parts) and list(T.sliced([])) == []
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    df = spark.createDataFrame([(x,) for x in [*texts, "Ünï 가나 <|endoftext|>", None]], "t string")
    got = [r.n for r in df.select(T.bpe_tokens(spark, path)("t").alias("n")).collect()]
    assert got == [len(plain.encode(r.t or "", add_special_tokens=False).ids) for r in df.collect()]


def test_results_beyond_a_file_are_parts_in_order(spark, tmp_path):
    """resumed_calls saved all its rows by one task, which read as much as they are."""
    df = spark.createDataFrame([(f"d_{i:04}", "가" * (i % 50), None) for i in range(900, 0, -1)], "index string, contents string, x string").repartition(3)
    for name, most in (("small", 1), ("large", 0.02)):
        path = f"{tmp_path}/{name}.jsonl"
        Settings(file_mb=most).save(df, path, ["index"])
        rows = files.read_jsonl(spark, path, df.schema)
        assert sorted(rows.collect()) == sorted(df.collect())
        parts = sorted(p for p in (tmp_path / f"{name}.jsonl").glob("part-*.json")) or [tmp_path / f"{name}.jsonl"]
        lines = [x for p in parts for x in p.read_text().splitlines()]
        assert [json.loads(x)["index"] for x in lines] == [f"d_{i:04}" for i in range(1, 901)] and '"x":null' in lines[0]
        assert (len(parts) == 1) == (name == "small") and max(p.stat().st_size for p in parts) < 2 * most * 2**20
    Settings(file_mb=1).save(df, f"{tmp_path}/large.jsonl", ["index"])  # a folder gives way to a file, and the other way round
    Settings(file_mb=0.02).save(df, f"{tmp_path}/small.jsonl", ["index"])
    assert (tmp_path / "large.jsonl").is_file() and (tmp_path / "small.jsonl").is_dir()
    assert files.read_multi_jsonl(spark, str(tmp_path), df.schema).count() == 1800
