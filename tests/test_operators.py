import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators import curate, debias, quality, reshape, training, validate
from corpusloom.plans import pipelines
from corpusloom.plans.provider import StubProvider, completed
from corpusloom.sources import extract, files, registry, rest
from corpusloom.streaming import clean


def test_white_space_is_all_of_unicode(spark):
    white = [chr(c) for c in range(0xD800) if chr(c).isspace()]
    df = spark.createDataFrame([(c,) for c in white] + [("x",), ("​",)], "t string")
    assert df.filter(F.regexp_like("t", F.lit(f"^{T.WHITE}$"))).count() == len(white) == 29


def test_ratios_are_strict_and_empty_texts_fail(spark):
    df = spark.createDataFrame([("ab!!",), ("",), ("abc!",), (None,)], "t string")
    assert [r.t for r in df.filter(T.keeps(T.punctuation_ratio(F.col("t")), 0.5)).collect()] == ["abc!"]
    with pytest.raises(PySparkException):
        df.filter(T.keeps(T.punctuation_ratio(F.col("t"), "error"), 0.5)).collect()


def test_cleaning(spark):
    row = spark.createDataFrame([("가　나*a²😀\n b ㄱ",)], "t string").select(T.normalize(T.remove_unicode(F.col("t"))).alias("t")).first()
    assert row.t == "가 나a b ㄱ"


def test_char_chunks(spark):
    got = spark.createDataFrame([("abcdefg",), ("",), ("😀bc",)], "t string").select(T.char_chunks(F.col("t"), 3).alias("c")).collect()
    assert [r.c for r in got] == [["abc", "def", "g"], [], ["😀bc"]]


@pytest.mark.parametrize(("n", "k"), [(10, 4), (2, 4), (0, 3), (7, 7), (23, 5)])
def test_tiles_differ_by_one(spark, n, k):
    got = [r.chunk_index for r in reshape.split_chunk(spark.range(n), k, ["id"]).orderBy("id").collect()]
    size, more = divmod(n, k)
    assert got == [i for i in range(k) for _ in range(size + (i < more))]


def test_ragged_batches_raise(spark):
    df = spark.createDataFrame([("a", ["x", "y"], ["z"])], "index string, q array<string>, a array<string>")
    with pytest.raises(PySparkException):
        reshape.explode_batches(df, ["q", "a"], ["index"]).collect()


def test_explode_and_implode_are_inverse(spark):
    df = spark.createDataFrame([("p_10", ["x", "y"], ["1", None]), ("p_2", ["z"], ["3"])], "index string, q array<string>, a array<string>")
    back = reshape.implode_rows(reshape.explode_batches(df, ["q", "a"], ["index"]), ["q", "a"], ["item_ord"])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_reference_index_without_underscore(spark):
    got = spark.createDataFrame([("a_b_3",), ("a",)], "i string").select(reshape.reference_index(F.col("i")).alias("r")).collect()
    assert [r.r for r in got] == ["a_b", ""]


def test_option_and_answer_errors(spark):
    good = [f"{c}. x" for c in "ABCD"]
    cases = [
        ([good], ["A"], False, False), ([good[:3]], ["A"], True, False), ([[*good, "E. x", "F. x", "G. x", "H. x"]], ["A"], True, False), ([["A.x", *good[1:]]], ["A"], True, False),
        ([[good[0], good[2], good[1], good[3]]], ["B"], True, False), ([[*good[:3], None]], ["A"], True, True), ([[*good[:3], ""]], ["A"], True, True), (None, ["A"], True, True), ([good], None, False, True),
        ([good], ["a"], False, True), ([good], ["E"], False, True), ([good], [None], False, True), ([good, good], ["A"], False, False), ([], [], False, False),
    ]
    df = spark.createDataFrame([(i, o, a) for i, (o, a, _, _) in enumerate(cases)], "i int, options array<array<string>>, answer array<string>")
    got = df.select("i", validate.option_errors(F.col("options")), validate.answer_errors(F.col("answer"), F.col("options"))).orderBy("i").collect()
    assert [tuple(r)[1:] for r in got] == [c[2:] for c in cases]


def test_reasoning_errors(spark):
    cases = [("A는 답", True), ("CFA 기준", False), ("A", True), ("", False), (None, True), ("E가 답", False), ("(D)", True), ("B1", False)]
    df = spark.createDataFrame([(i, r, list("wxyz")) for i, (r, _) in enumerate(cases)], "i int, r string, o array<string>")
    got = df.select("i", validate.reasoning_errors(F.col("r"), F.col("o")).alias("b")).orderBy("i").collect()
    assert [r.b for r in got] == [b for _, b in cases]


def test_one_bad_item_takes_its_index(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "index string, x int")
    ok, bad = validate.survivors(df, F.col("x") == 2)
    assert [r["index"] for r in ok.collect()] == ["b"] and [r["index"] for r in bad.collect()] == ["a"]


def test_shuffle_keeps_the_right_option(spark):
    rows = [(f"k{i}", [f"{chr(65 + j)}. t{j}" for j in range(4 + i % 4)], chr(65 + i % 4)) for i in range(40)] + [("bad", ["A. x"], "Z")]
    df = spark.createDataFrame(rows, "k string, o array<string>, a string")
    o, a = debias.shuffled(F.col("o"), F.col("a"), F.col("k"))
    got = df.select("k", F.col("o").alias("o0"), F.col("a").alias("a0"), o.alias("o"), a.alias("a")).collect()
    for r in got[:-1]:
        assert r.o[ord(r.a) - 65][3:] == r.o0[ord(r.a0) - 65][3:]
        assert [x[0] for x in r.o] == [chr(65 + i) for i in range(len(r.o))] and sorted(x[3:] for x in r.o) == sorted(x[3:] for x in r.o0)
    assert got[-1].a == "Z" and len({r.a for r in got}) > 3


def test_deduplicate(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", 4)], "t string, o int")
    pick = lambda k: sorted(r.o for r in curate.deduplicated(df, ["t"], ["o"], k).collect())
    assert (pick("first"), pick("last"), pick(False)) == ([1, 3, 4], [2, 3, 4], [3, 4])


def test_tolerance():
    assert [validate.over_tolerance(e, n, 0.3) for e, n in ((1, 2), (2, 2), (3, 10), (4, 10))] == [False, True, False, True]


def test_chunks_join_to_the_full_text(spark):
    df = spark.createDataFrame([(i, f"word{i} " * (i % 5 + 1)) for i in range(30)] + [(99, "")], "ord int, contents string")
    options = {"title": "t", "order": ["ord"], "token": False, "number": False, "english": False}
    full = quality.quality_filter(df, return_type="full", **options).first().contents
    parts = quality.quality_filter(df, return_type="chunk", chunk_size=37, **options).orderBy("seq").collect()
    assert "".join(p.contents for p in parts) == full and {len(p.contents) for p in parts[:-1]} == {37}


def test_training_rows(spark):
    df = spark.createDataFrame([("mcqa", "q", ["A. x", "B. y"], "r", "A"), ("qa", "q", None, None, "a")], "k string, q string, o array<string>, r string, a string")
    got = [r[0] for r in df.select(training.sft_text(F.col("k"), F.col("q"), F.col("o"), F.col("r"), F.col("a"), "repr")).collect()]
    assert got == ["### 질문: q\n### 선택지:\n['A. x', 'B. y']\n### 정답: r### 정답: A", "### 질문: q\n### 정답: a"]


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(i, None if i % 2 else "x") for i in range(50)], "i int, s string")
    n = files.write_multi_jsonl(df, str(tmp_path), "out", ["i"], 1)
    back = files.read_multi_jsonl(spark, str(tmp_path), "i int, s string")
    assert back.count() == 50
    files.write_jsonl_file(df, str(tmp_path / "one.jsonl"))
    assert n == 1 and files.read_jsonl(spark, str(tmp_path / "one.jsonl"), "i int, s string").count() == 50
    assert '"s":null' in (tmp_path / "one.jsonl").read_text()
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.jsonl").write_text('{"i": 1}\n')
    (tmp_path / "a" / "y.jsonl").write_text('{"s": "u"}\n')
    assert files.read_multi_jsonl(spark, str(tmp_path / "a")).count() == 2
    (tmp_path / "few.txt").write_text("one <SEP> two")
    assert [r.example for r in files.fewshots(spark, str(tmp_path)).orderBy("pos").collect()] == ["one", "two"]
    files.write_json({"가": 1}, str(tmp_path / "o.json"))
    assert json.loads((tmp_path / "o.json").read_text()) == {"가": 1} and files.find_file("o.json", str(tmp_path)).endswith("o.json")


def test_extract(spark):
    page = "<html><head><title>x</title></head><body><p>a&amp;b</p><table><tr><td>no</td></tr></table> <b>c</b></body></html>"
    filing = "<d><section-1><title>II. 사업의 내용</title><p>본문 <b>x</b> 끝</p><table><p>no</p></table></section-1></d>"
    df = spark.createDataFrame([(page, filing), (None, "<d/>"), ("", "<broken")], "h string, x string")
    got = df.select(extract.extract_report(F.col("h"), "html").alias("h"), extract.extract_report(F.col("x"), "xml").alias("x")).collect()
    assert [r.h for r in got] == ["a&b c", None, ""] and [r.x for r in got] == ["II. 사업의 내용\n본문\nx\n끝", None, None]


def test_registries(tmp_path):
    r = registry.DatasetRegister(str(tmp_path / "d.jsonl"))
    r.add_config("가", "a", "u", "MIT")
    r.add_config("나", "b", "u", "MIT")
    assert [x["en_name"] for x in r.exclude_config("a")] == ["b"]
    v = registry.ValidationSetRegister(str(tmp_path / "v.jsonl"))
    v.add_validation("fin_ratio", "q", ["A. x"], "r", "A")
    assert [x["seq"] for x in v.add_validation("fin_ratio", "q2", ["A. x"], "r", "A")] == [0, 1]
    assert [(x["seq"], x["question"]) for x in v.exclude_config(0)] == [(0, "q2")]
    with pytest.raises(ValueError, match="unknown"):
        v.add_validation("other", "q", [], "r", "A")


def test_search(spark):
    def transport(url, headers):
        return json.dumps({"items": [{"url": url}]}).encode()

    got = rest.search(spark, "https://example.org/search", ["a", "b"], {}, pages=2, transport=transport).collect()
    assert len(got) == 4 and all("query=" in r.item for r in got)


def _refs(spark, n=12):
    return spark.createDataFrame([(f"b_{i}", "t", f"text {i}") for i in range(n)], "index string, title string, contents string")


def test_each_task_is_called_once(spark, tmp_path):
    log = str(tmp_path / "calls")

    class Counting(StubProvider):
        def complete(self, task):
            with open(log, "a") as f:
                f.write("x\n")
            return super().complete(task)

    tasks = pipelines._task(_refs(spark), pipelines.Settings(), "value", 1, 0, 1, F.lit("s"), F.col("contents"))
    done = completed(tasks, Counting(failing=0.4), "once")
    assert done.count() == done.select("status").count() == 12 and 0 < done.filter("status = 'error'").count() < 12
    assert len(open(log).readlines()) == 12


def test_mcqa_without_errors_makes_all_items(spark, tmp_path):
    s = pipelines.Settings(name="t", n_datasets=2, save_dir=str(tmp_path))
    got = pipelines.mcqa(_refs(spark), s, StubProvider()).collect()
    assert len(got) == 12 * 2 * 2 and {len(r.options) for r in got} == {4, 5, 6, 7}
    assert (tmp_path / "t_common_mcqa_common_step_2.jsonl").exists() and all(r.answer in r.reasoning_process for r in got)


def test_errors_are_regenerated(spark):
    s = pipelines.Settings(name="t", n_datasets=2, tolerance=0.01, max_rounds=12)
    got = pipelines.qa(_refs(spark), s, StubProvider(malformed=0.3, failing=0.1)).toPandas()
    assert got["reference_index"].nunique() >= 10 and set(got["preference"]) <= set("ABE") and got["value"].between(0, 5).all()


def test_failed_calls_lose_no_item(spark):
    """Value grading and closed-book answers are asked until each has one, within whatever tolerance."""

    class Failing(StubProvider):
        def complete(self, task):
            if (task["eval_type"], task["step"]) in {("value", 1), ("qa", 2)} and self._draw(task, "fail") < 0.3:
                raise TimeoutError("no answer")
            return super().complete(task)

    s = pipelines.Settings(name="t", n_datasets=2, max_step=1, tolerance=0.5, max_rounds=20)
    assert pipelines.qa(_refs(spark), s, Failing()).count() == 12 * 2
    assert pipelines.mcqa(_refs(spark), s, Failing()).count() == 12 * 2


def test_streaming(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps({"title": "t", "contents": "가 " * 300}) + "\n" + json.dumps({"title": "t", "contents": "짧다"}) + "\n")
    q = clean.write_references(clean.cleaned(clean.read_references(spark, str(tmp_path / "in"))), str(tmp_path / "out"), str(tmp_path / "state"))
    q.awaitTermination(60)
    assert spark.read.json(str(tmp_path / "out")).count() == 1
