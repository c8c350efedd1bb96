"""The REST sources: what they ask, and what they don't."""

import json
import os
import sys
from urllib.parse import parse_qs, urlsplit

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from corpusloom.sources import rest

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers don't import tests


class Server:
    """Answers three items a page, fails for the query `down` and once for every `shaky` page; notes what it is asked."""

    def __init__(self, folder):
        self.folder = str(folder)

    def __call__(self, url, headers):
        asked = {k: v[0] for k, v in parse_qs(urlsplit(url).query).items()}
        with open(f"{self.folder}/{os.getpid()}", "a") as f:
            f.write(json.dumps({"path": urlsplit(url).path, "headers": headers} | asked) + "\n")
        if asked.get("query") == "down":
            raise OSError("no route")
        if asked.get("query") == "shaky" and self.asked().count(asked | {"path": urlsplit(url).path, "headers": headers}) < 2:
            raise TimeoutError("late")
        if "query" not in asked:
            return json.dumps(asked).encode()
        if asked["query"] == "broken":
            return b"<html>"
        n = 0 if asked["query"] == "none" else 3
        return json.dumps({"items": [{"title": f"{asked['query']}-{int(asked['start']) + i} 가"} for i in range(n)]}).encode()

    def asked(self):
        return [json.loads(x) for name in os.listdir(self.folder) for x in open(f"{self.folder}/{name}")]


@pytest.fixture
def server(spark, tmp_path):
    (tmp_path / "asked").mkdir()
    s = Server(tmp_path / "asked")
    rest.register(spark, s)
    return s


def load(spark, queries, reader=None, **options):
    return (reader or spark.read).format("rest_search").options(url="https://example.org/v1", queries=json.dumps(queries), display=3, **options).load()


def titles(rows):
    return sorted((r["query"], r.page, r.pos, json.loads(r["item"])["title"]) for r in rows)


def test_pages_are_rows(spark, server):
    got = load(spark, ["a", "b"], pages=2, category="blog", sort="date", headers='{"X-Id": "7"}').collect()
    assert titles(got) == sorted((q, p, i, f"{q}-{1 + 3 * p + i} 가") for q in "ab" for p in range(2) for i in range(3))
    assert sorted((x["query"], x["start"]) for x in server.asked()) == [("a", "1"), ("a", "4"), ("b", "1"), ("b", "4")]
    assert {(x["path"], x["sort"], x["display"], str(x["headers"])) for x in server.asked()} == {("/v1/blog.json", "date", "3", "{'X-Id': '7'}")}


@pytest.mark.parametrize(
    ("condition", "want"),
    [
        ("query = 'b' AND page >= 1 AND page < 3", {("b", 1), ("b", 2)}),
        ("query IN ('a', 'c') AND page = 0", {("a", 0), ("c", 0)}),
        ("query != 'a' AND query IS NOT NULL AND page > 2", {("b", 3), ("c", 3)}),
        ("query <=> 'a' AND page <= 0", {("a", 0)}),
        ("startswith(query, 'c') AND NOT page IN (0, 1, 2)", {("c", 3)}),
        ("query = 'x'", set()),
        ("page = 1 AND query = 'a' AND item LIKE '%4%'", {("a", 1)}),
    ],
)
def test_filters_keep_requests_from_being_made(spark, server, condition, want):
    df = load(spark, ["a", "b", "c"], pages=4).filter(condition)
    rows = df.collect()
    assert {(x["query"], (int(x["start"]) - 1) // 3) for x in server.asked()} == want
    assert {(r["query"], r.page) for r in rows} == want
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter (" in line and ("page" in line or "query" in line)], plan  # nothing is left for Spark to check


def test_filters_on_answers_stay_in_spark(spark, server):
    rows = load(spark, ["a"], pages=2).filter("item LIKE '%a-4%' OR page = 7").collect()
    assert titles(rows) == [("a", 1, 0, "a-4 가")] and len(server.asked()) == 2


def test_errors_are_rows(spark, server):
    got = {r["query"]: r for r in load(spark, ["down", "broken"]).collect()}
    assert got["down"].error == "OSError: no route" and got["broken"].status == "error" and got["down"]["item"] is None
    assert load(spark, ["none"]).collect() == []
    assert load(spark, ["shaky"], tries=1).first().error == "TimeoutError: late"
    assert load(spark, ["shaky"], tries=3).count() == 3
    assert load(spark, []).collect() == []


def test_requests_are_dealt_over_partitions(spark, server):
    assert load(spark, ["a", "b", "c"], pages=4).rdd.getNumPartitions() == 12
    df = load(spark, ["a", "b", "c"], pages=4, partitions=5)
    assert df.rdd.getNumPartitions() == 5 and df.count() == 36


def test_unknown_options(spark, server):
    for bad in ({"category": "shop"}, {"sort": "price"}):
        with pytest.raises(Exception, match="unknown category or sort"):
            load(spark, ["a"], **bad).collect()
        with pytest.raises(ValueError, match="unknown"):
            rest.search(spark, "u", ["a"], {}, **bad)


def test_a_stream_goes_on_from_its_page(spark, server, tmp_path):
    """The same checkpoint with more pages asks only for the new ones."""

    def run(pages):
        stream = load(spark, ["a", "b"], spark.readStream, pages=pages)
        q = stream.writeStream.option("checkpointLocation", str(tmp_path / "check")).format("parquet").option("path", str(tmp_path / "out")).trigger(availableNow=True).start()
        q.awaitTermination(120)
        assert q.exception() is None
        q.stop()

    run(1)
    assert sorted((x["query"], x["start"]) for x in server.asked()) == [("a", "1"), ("b", "1")]
    run(3)
    assert sorted((x["query"], x["start"]) for x in server.asked()) == [(q, s) for q in "ab" for s in "147"]
    assert titles(spark.read.parquet(str(tmp_path / "out")).collect()) == sorted((q, p, i, f"{q}-{1 + 3 * p + i} 가") for q in "ab" for p in range(3) for i in range(3))


def test_search_and_get_ask_once(spark, server):
    found = rest.search(spark, "https://example.org/v1", ["a", "down"], {}, display=3, pages=2, transport=server)
    assert found.count() == 8 and found.filter("status = 'error'").count() == 2 and len(server.asked()) == 4
    got = rest.get_requests(spark, "https://example.org/open", [{"year": "2024", "q": "가 나"}, {"year": "2025"}], service_key="k", transport=server)
    assert [json.loads(r["item"]) for r in got.orderBy("request").collect()] == [{"serviceKey": "k", "year": "2024", "q": "가 나"}, {"serviceKey": "k", "year": "2025"}]
    assert got.filter(F.col("request") == 1).count() == 1 and len(server.asked()) == 6
