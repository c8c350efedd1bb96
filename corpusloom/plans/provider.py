"""Language-model providers, and the map stage that calls them."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Protocol
from urllib.request import Request, urlopen

import pandas as pd
from pyspark.sql import DataFrame

from .barrier import barrier
from .ledger import Ledger
from .rate import one_budget, paced, permit


class CompletionProvider(Protocol):
    def complete(self, task: dict) -> dict:
        """task has eval_type, model, step, round, n_datasets, n_options, system, user, index, item_ord."""


@dataclass(frozen=True)
class StubProvider:
    """Answers by hash: the same for the same task, with errors at a known rate that further rounds may mend."""

    seed: int = 0
    malformed: float = 0.0
    failing: float = 0.0

    def _draw(self, task: dict, what: str) -> float:
        key = f"{self.seed}:{what}:{task['eval_type']}:{task['step']}:{task['round']}:{task['index']}:{task['item_ord']}"
        return int(hashlib.md5(key.encode()).hexdigest()[:8], 16) / 2**32

    def complete(self, task: dict) -> dict:
        if self._draw(task, "fail") < self.failing:
            raise TimeoutError("no answer")
        kind, bad, n = task["eval_type"], self._draw(task, "bad") < self.malformed, task["n_datasets"]
        if kind == "mcqa":
            k = task["n_options"]
            options = [f"{chr(65 + i)}. 보기 {i}" for i in range(k)]
            rows = [{"question": f"{task['index']} 문제 {i}", "options": options[: 2 if bad else k]} for i in range(n)]
            return {"questions": rows, "answers": [{"reasoning_process": "자료를 읽고 계산한다.", "answer": chr(65 + i % k)} for i in range(n)]}
        if kind == "qa" and task["step"] == 1:
            return {"questions": [{"question": f"{task['index']} 질문 {i}"} for i in range(n)], "answers": [{"answer": f"답 {i}"} for i in range(n - bad)]}
        if kind == "qa":
            return {"answer": "자료 없이 쓴 답"}
        pick = self._draw(task, "pick")
        if kind == "hallucination":
            return {"hallucination": "unknown" if bad else "Usable", "hallucination_desc": ""}
        if kind == "preference":
            return {"choice": "C" if bad else "ABE"[int(pick * 3)], "preference_desc": ""}
        if kind == "value":
            return {"value": 9 if bad else int(pick * 6)}
        return {"classification": "other" if bad else ("quant", "law", "no")[int(pick * 3)]}


#: JSON schemas of the answers by kind of task; qa by step.
SCHEMAS = {
    "mcqa": {"questions": [{"question": "string", "options": ["string"]}], "answers": [{"reasoning_process": "string", "answer": "string"}]},
    "qa": {"questions": [{"question": "string"}], "answers": [{"answer": "string"}]},
    "qa2": {"answer": "string"},
    "hallucination": {"hallucination": "string", "hallucination_desc": "string"},
    "preference": {"choice": "string", "preference_desc": "string"},
    "value": {"value": "integer"},
    "classification": {"classification": "string"},
}


def json_schema(shape) -> dict:
    """A strict JSON schema of a shape like those of SCHEMAS."""
    if isinstance(shape, str):
        return {"type": shape}
    if isinstance(shape, list):
        return {"type": "array", "items": json_schema(shape[0])}
    return {"type": "object", "properties": {k: json_schema(v) for k, v in shape.items()}, "required": list(shape), "additionalProperties": False}


@dataclass
class HttpProvider:
    """A chat interface over HTTPS. `rate` is what a stage of calls keeps to, all tasks together; each call is tried `tries`
    times, with a pause that doubles and a permit of the stage, and asks for an answer by the schema of its kind."""

    url: str
    key: str
    model: str
    rate: float = 10.0
    timeout: float = 60.0
    tries: int = 3
    pause: float = 1.0

    def complete(self, task: dict) -> dict:
        kind = "qa2" if task["eval_type"] == "qa" and task["step"] == 2 else task["eval_type"]
        form = {"type": "json_schema", "json_schema": {"name": kind, "strict": True, "schema": json_schema(SCHEMAS[kind])}}
        body = {"model": task.get("model") or self.model, "messages": [{"role": "system", "content": task["system"]}, {"role": "user", "content": task["user"]}], "response_format": form}
        head = {"Content-Type": "application/json", "Authorization": f"Bearer {self.key}", "Idempotency-Key": hashlib.sha1(json.dumps(task, sort_keys=True).encode()).hexdigest()}
        for i in range(self.tries):
            if i:
                permit()
            try:
                with urlopen(Request(self.url, json.dumps(body).encode(), head), timeout=self.timeout) as r:  # noqa: S310
                    return json.loads(json.loads(r.read())["choices"][0]["message"]["content"])
            except (OSError, ValueError, KeyError):
                if i == self.tries - 1:
                    raise
                time.sleep(self.pause * 2**i)
        raise AssertionError


TASK = ("eval_type", "model", "step", "round", "n_datasets", "n_options", "system", "user")


def calls(tasks: DataFrame, provider: CompletionProvider, threads: int = 8, partitions: int | None = None, rate: float | None = None, period: float = 5.0) -> DataFrame:
    """tasks with status, error and response (JSON) of one call each. Lazy: it has to be written before it is used.

    A task that raises gives a row with status 'error'; it never fails the stage. rate: calls a second of the whole stage.
    """
    context, rate = tasks.sparkSession.sparkContext, rate or getattr(provider, "rate", None)
    if context.getConf().get("spark.speculation", "false") == "true":
        raise RuntimeError("spark.speculation would make calls twice")
    if rate and not partitions:
        partitions = context.defaultParallelism
    if partitions:
        tasks = tasks.repartition(partitions, "index", "item_ord")
    shared = bool(rate) and one_budget(context, partitions)

    def one(task: dict) -> tuple:
        try:
            return *task.values(), "ok", None, json.dumps(provider.complete(task), ensure_ascii=False)
        except Exception as e:  # noqa: BLE001
            return *task.values(), "error", f"{type(e).__name__}: {e}", None

    columns = [*tasks.columns, "status", "error", "response"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if rate:
            rows = (row for f in frames for row in f.to_dict("records"))
            for done in paced(rows, one, rate, threads, period, partitions, shared):
                yield pd.DataFrame(done, columns=columns)
            return
        with ThreadPoolExecutor(threads) as pool:
            for f in frames:
                yield pd.DataFrame(list(pool.map(one, f.to_dict("records"))), columns=columns)

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tasks.schema)
    return tasks.mapInPandas(run, f"{types}, status string, error string, response string", barrier=shared)


def completed(tasks: DataFrame, provider: CompletionProvider, name: str, threads: int = 8, partitions: int | None = None, ledger: Ledger | None = None, kind: str = "call", rate: float | None = None, period: float = 5.0) -> DataFrame:
    """index, item_ord, status, error, response (JSON) of tasks(index, item_ord, *TASK), one call each, written before it is used.

    ledger: calls that are in it, among those of their kind, are not made again, and all that are made go into it; without
    one they are written at a barrier.
    """
    tasks = tasks.select("index", "item_ord", *TASK)
    make = lambda rows: calls(rows, provider, threads, partitions, rate, period)
    if ledger is None:
        return barrier(make(tasks).select("index", "item_ord", "status", "error", "response"), name)
    return ledger.completed(tasks, kind, ["index", "item_ord", *TASK], make)
