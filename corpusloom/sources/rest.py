"""REST interfaces as Spark data sources, with a transport that can be replaced.

`rest_search` reads pages of a search interface, a row an item; `rest_get` reads one
response for each of a list of parameters. Both plan their requests before making any:
filters on a request's own columns (query, page; request) are pushed into the source, so
that what they exclude is never asked, and the requests left are dealt over partitions.
As a stream, `rest_search` goes on from the page of its checkpoint.

A request that fails, after its tries, is a row with status 'error' and no item; it fails
no stage. Every action on such a table asks again: `search` and `get_requests` write what
came at a barrier and read that.
"""

from __future__ import annotations

import json
import operator
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import urlencode
from urllib.request import Request, urlopen

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringStartsWith,
)

from ..plans.barrier import barrier

Transport = Callable[[str, dict], bytes]
# Fixed values of the interface.
CATEGORIES, SORTS = ("blog", "news", "kin", "encyc", "cafearticle", "webkr"), ("sim", "date")
AGENT = "Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0 Safari/537.36"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def fetch(url: str, headers: dict, timeout: float = 60) -> bytes:
    with urlopen(Request(url, headers={"User-Agent": AGENT} | headers), timeout=timeout) as r:  # noqa: S310
        return r.read()


def get_request(url: str, params: dict | None = None, headers: dict | None = None, transport: Transport = fetch) -> bytes:
    return transport(url + ("?" + urlencode(params) if params else ""), headers or {})


def public_data(base_url: str, service_key: str, params: dict | None = None, transport: Transport = fetch) -> bytes:
    """A GET with the key among the parameters; the response as it comes."""
    return get_request(base_url, {"serviceKey": service_key} | (params or {}), transport=transport)


_COMPARED = {EqualTo: operator.eq, EqualNullSafe: operator.eq, GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge, LessThan: operator.lt, LessThanOrEqual: operator.le, In: lambda x, values: x in values, StringStartsWith: lambda x, start: x.startswith(start)}


def holds(f: Filter, request: dict) -> bool | None:
    """Whether a request's columns, which are never null, meet a filter; None: it is no filter on these, or of a kind that isn't known."""
    if isinstance(f, Not):
        inner = holds(f.child, request)
        return None if inner is None else not inner
    if len(f.attribute) != 1 or f.attribute[0] not in request:
        return None
    if isinstance(f, IsNotNull):
        return True
    return _COMPARED[type(f)](request[f.attribute[0]], f.value) if type(f) in _COMPARED else None


@dataclass
class Requests(InputPartition):
    """The requests of one task, each a dict of its own columns."""

    asked: list[dict]


class Asking:
    """How a source makes its requests. Subclasses say which there are, their URLs and the rows of a response."""

    def __init__(self, options: dict, transport: Transport):
        self.options, self.transport = dict(options), transport
        self.headers = json.loads(options.get("headers", "{}"))
        self.tries, self.pause = int(options.get("tries", 1)), float(options.get("pause", 0))
        self.most = int(options.get("partitions", 32))

    def dealt(self, asked: list[dict]) -> list[Requests]:
        n = min(len(asked), self.most)
        return [Requests(asked[i::n]) for i in range(n)]

    def response(self, url: str) -> bytes:
        for i in range(self.tries):
            try:
                return self.transport(url, self.headers)
            except Exception:
                if i == self.tries - 1:
                    raise
                time.sleep(self.pause * 2**i)
        raise AssertionError

    def rows(self, partition: Requests) -> Iterator[pa.RecordBatch]:
        """A batch for each request, so that a task holds one response at a time."""
        for request in partition.asked:
            try:
                items = self.parsed(self.response(self.url(request)))
                n, said = len(items), {"pos": range(len(items)), "status": ["ok"] * len(items), "error": [None] * len(items), "item": items}
            except Exception as e:  # noqa: BLE001
                n, said = 1, {"pos": [None], "status": ["error"], "error": [f"{type(e).__name__}: {e}"], "item": [None]}
            own = {k: [v] * n for k, v in request.items()}
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int32() if k in ("page", "pos", "request") else pa.string()) for k, v in (own | said).items()], [*own, *said])


class Search(Asking):
    """Options: url, queries (JSON list), category, sort, display, start, pages, headers (JSON), tries, pause, partitions."""

    SCHEMA = "query string, page int, pos int, status string, error string, item string"

    def __init__(self, options: dict, transport: Transport):
        super().__init__(options, transport)
        self.queries, self.category, self.sort = json.loads(options["queries"]), options.get("category", "news"), options.get("sort", "sim")
        self.display, self.start, self.pages = (int(options.get(k, v)) for k, v in (("display", 20), ("start", 1), ("pages", 1)))
        if self.category not in CATEGORIES or self.sort not in SORTS:
            raise ValueError("unknown category or sort")

    def requests(self, first: int, last: int) -> list[dict]:
        return [{"query": q, "page": p} for p in range(first, last) for q in self.queries]

    def url(self, request: dict) -> str:
        params = {"query": request["query"], "display": self.display, "start": self.start + request["page"] * self.display, "sort": self.sort}
        return f"{self.options['url']}/{self.category}.json?{urlencode(params)}"

    @staticmethod
    def parsed(body: bytes) -> list[str]:
        return [json.dumps(x, ensure_ascii=False) for x in json.loads(body).get("items", [])]


class Get(Asking):
    """Options: url, params (JSON list of objects, a request each), headers (JSON), tries, pause, partitions. item is the body, as text."""

    SCHEMA = "request int, pos int, status string, error string, item string"

    def __init__(self, options: dict, transport: Transport):
        super().__init__(options, transport)
        self.params = json.loads(options["params"])

    def requests(self, *_) -> list[dict]:
        return [{"request": i} for i in range(len(self.params))]

    def url(self, request: dict) -> str:
        params = self.params[request["request"]]
        return self.options["url"] + ("?" + urlencode(params) if params else "")

    @staticmethod
    def parsed(body: bytes) -> list[str]:
        return [body.decode("utf-8", "replace")]


class Reader(DataSourceReader):
    def __init__(self, asking: Asking):
        self.asking, self.asked = asking, asking.requests(0, getattr(asking, "pages", 0))

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            if self.asked and holds(f, self.asked[0]) is None:
                yield f
            else:
                self.asked = [r for r in self.asked if holds(f, r)]

    def partitions(self) -> list[Requests]:
        return self.asking.dealt(self.asked) or [Requests([])]

    def read(self, partition: Requests) -> Iterator[pa.RecordBatch]:
        return self.asking.rows(partition)


class Stream(DataSourceStreamReader):
    """Offsets are pages: a batch asks all queries for the pages that are new since the last one, so more pages can be asked for later."""

    def __init__(self, asking: Search):
        self.asking = asking

    def initialOffset(self) -> dict:  # noqa: N802
        return {"page": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"page": self.asking.pages}

    def partitions(self, start: dict, end: dict) -> list[Requests]:
        return self.asking.dealt(self.asking.requests(start["page"], end["page"]))

    def read(self, partition: Requests) -> Iterator[pa.RecordBatch]:
        return self.asking.rows(partition)


class _Source(DataSource):
    asking, transport = Asking, staticmethod(fetch)

    def schema(self) -> str:
        return self.asking.SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.asking(self.options, type(self).transport))


class SearchSource(_Source):
    asking = Search

    @classmethod
    def name(cls) -> str:
        return "rest_search"

    def streamReader(self, schema) -> Stream:  # noqa: N802
        return Stream(self.asking(self.options, type(self).transport))


class GetSource(_Source):
    asking = Get

    @classmethod
    def name(cls) -> str:
        return "rest_get"


def register(spark: SparkSession, transport: Transport = fetch, suffix: str = "") -> None:
    """Makes the formats rest_search and rest_get known to a session, by a transport; suffix: after their names, for several.

    Filters only reach Python sources where the session says so: that is switched on.
    """
    for source in (SearchSource, GetSource):
        name = source.name() + suffix
        spark.dataSource.register(type(source.__name__, (source,), {"transport": staticmethod(transport), "name": classmethod(lambda cls, name=name: name)}))
    spark.conf.set(PUSHDOWN, "true")


def _loaded(spark: SparkSession, name: str, transport: Transport, options: dict) -> DataFrame:
    suffix = f"_{uuid.uuid4().hex}"
    register(spark, transport, suffix)
    return barrier(spark.read.format(name + suffix).options(**options).load(), name)


def search(spark: SparkSession, base_url: str, queries: list[str], headers: dict, category: str = "news", display: int = 20, start: int = 1, sort: str = "sim", pages: int = 1, transport: Transport = fetch, **options) -> DataFrame:
    """query, page, pos, status, error, item (JSON) of a search interface, each request made once and what came written."""
    if category not in CATEGORIES or sort not in SORTS:
        raise ValueError("unknown category or sort")
    more = {"url": base_url, "queries": json.dumps(queries), "headers": json.dumps(headers), "category": category, "display": display, "start": start, "sort": sort, "pages": pages}
    return _loaded(spark, "rest_search", transport, more | options)


def get_requests(spark: SparkSession, base_url: str, params: list[dict], headers: dict | None = None, service_key: str | None = None, transport: Transport = fetch, **options) -> DataFrame:
    """request (its number), pos, status, error, item (the body) of a GET for each of params; service_key goes among them."""
    params = [({"serviceKey": service_key} if service_key else {}) | p for p in params]
    return _loaded(spark, "rest_get", transport, {"url": base_url, "params": json.dumps(params), "headers": json.dumps(headers or {})} | options)
