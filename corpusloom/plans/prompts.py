"""Prompts of every stage: template files, and what they are given. The wording is our own; names and output contracts are those of the pipelines."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.debias import drawn
from .barrier import fresh
from .templates import Library, library

ROLES = {"accounting": "회계 전문가", "market": "금융시장 전문가", "law": "금융법규 전문가", "quant": "퀀트 전문가", "common": "금융 전문가"}
TASKS = {"knowledge": "지식 이해", "math": "계산과 추론", "common": "종합"}
LEVELS = ("기초에서 중급", "고급")

DOMAINS = tuple(ROLES)
#: Roles, tasks and levels are looked up for these stages; judges have none.
WRITERS = ("mcqa", "qa")

# Styles of answers, by three choices of our own: for whom, how long, what comes first.
READERS = ("", "고등학생도 알 수 있는 말로 쓰세요. ", "현업 실무자에게 보고하듯 쓰세요. ")
LENGTHS = ("세 문장 안으로 짧게 답하세요.", "한 문단 정도로 답하세요.", "예를 들어 가며 길게 답하세요.")
ORDERS = ("free", "answer", "reasons")


@dataclass(frozen=True)
class PathConfig:
    """Folders of a run below one root."""

    root: str = "."

    def get(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def logs(self) -> str:
        return self.get("logs")

    @property
    def fewshots(self) -> str:
        return self.get("fewshots")


def _files(templates: Library | None) -> Library:
    return library() if templates is None else templates


def _level(step: int) -> str:
    """Steps beyond the last level stay at the last."""
    return LEVELS[min(step, len(LEVELS)) - 1]


def _number(x: Column | None) -> tuple[Column, str]:
    return (F.lit(4) if x is None else x), "number"


def generate_fewshot(prompt: Column, eval_type: str, n_options: Column | None = None, task: str = "common", domain: str = "common", n_datasets: int = 1, step: int = 2, templates: Library | None = None) -> Column:
    """What asks a model for few-shot examples: the generator's system text at the level of a step, and the user's description."""
    given = {"role": ROLES[domain], "task": TASKS[task], "level": _level(step), "n_options": _number(n_options)}
    return F.concat(_files(templates).column(f"fewshot_{eval_type}.txt", given), F.lit(f"\n\n아래 설명에 맞는 예시를 {n_datasets}개 쓰세요.\n### 설명:\n"), prompt)


def generate_validation(prompt: Column, eval_type: str, n_options: Column | None = None, task: str = "common", domain: str = "common", n_datasets: int = 5, templates: Library | None = None) -> Column:
    """What asks a model for items of a validation set; they have no level."""
    given = {"role": ROLES[domain], "task": TASKS[task], "level": None, "n_options": _number(n_options)}
    return F.concat(_files(templates).column(f"fewshot_{eval_type}.txt", given), F.lit(f"\n\n아래 설명에 맞는 검증 문항을 {n_datasets}개 쓰세요.\n### 설명:\n"), prompt)


def fewshot_from_reference(title: Column, contents: Column, **settings) -> Column:
    """generate_fewshot with a reference as its description."""
    return generate_fewshot(_files(settings.get("templates")).column("reference.txt", {"title": title, "contents": contents}), **settings)


def style(number: Column, templates: Library | None = None) -> Column:
    """The style instruction of a number from 0 on: readers, lengths and orders in turn, and again from the first."""
    pick = lambda texts, n: F.element_at(F.array(*[F.lit(t) for t in texts]), F.pmod(n, F.lit(len(texts))).cast("int") + 1)
    given = {"reader": pick(READERS, number), "length": pick(LENGTHS, F.floor(number / len(READERS))), "order": pick(ORDERS, F.floor(number / (len(READERS) * len(LENGTHS))))}
    return _files(templates).column("style.txt", given)


#: What the user's template of a stage is given from the columns of items, by kind; the other names of the template are empty.
ITEM = {
    "mcqa": ("title", "contents", "prev_example", "table"),
    "qa": ("title", "contents"),
    "qa_answer": ("question",),
    "hallucination": ("question", "options"),
    "hallucination qa": ("title", "contents", "question", "answer"),
    "preference": ("question",),
    "value": ("question", "options", "reasoning_process", "answer"),
    "value qa": ("question", "answer"),
    "value references": ("contents",),
    "classification": ("title", "contents"),
}


def user_template(eval_type: str, step: int = 1) -> str:
    """The file of a stage's user prompt. Steps beyond the second stay at the second."""
    if eval_type == "mcqa":
        return f"user_mcqa_step{min(step, 2)}.txt"
    return "user_qa_answer.txt" if eval_type == "qa" and step == 2 else f"user_{eval_type}.txt"


def user_prompt_for(eval_type: str, step: int = 1, n_datasets: int = 5, kind: str = "mcqa", table: bool = False, templates: Library | None = None) -> Column:
    """The user prompt of a stage from an item's or a reference's columns. kind: what is judged, mcqa, qa or references.

    table: items have a column of that name. A step beyond the first needs its examples: without one the prompt is null.
    """
    key = "qa_answer" if eval_type == "qa" and step == 2 else f"{eval_type} {kind}" if f"{eval_type} {kind}" in ITEM else eval_type
    if key not in ITEM:
        raise ValueError(f"unknown stage {eval_type!r}")
    files, name = _files(templates), user_template(eval_type, step)
    asked = files.names(name)
    own = [c for c in ITEM[key] if c != "table" or table]
    given = {c: (F.col(c), "list" if c == "options" else "text") for c in own if c in asked} | ({"answer1": F.col("old_answer"), "answer2": F.col("answer")} if eval_type == "preference" else {})
    text = files.column(name, {c: None for c in asked} | {"n_datasets": n_datasets} | given)
    return F.when(F.col("prev_example").isNotNull(), text) if "prev_example" in given else text


def system_template(eval_type: str, step: int = 1) -> str:
    """The file of a stage's system prompt."""
    if eval_type == "mcqa":
        return f"system_mcqa_step{min(step, 2)}.txt"
    return "system_qa_answer.txt" if eval_type == "qa" and step == 2 else f"system_{eval_type}.txt"


def system_prompt(eval_type: str, step: int = 1, domain: str = "common", task: str = "common", n_options: Column | None = None, example: Column | None = None, templates: Library | None = None) -> Column:
    """The system prompt of a stage, by its template."""
    given = {"role": ROLES[domain], "task": TASKS[task], "level": _level(step), "n_options": _number(n_options), "example": example} if eval_type in WRITERS else {}
    return _files(templates).column(system_template(eval_type, step), given)


FEWSHOTS = {
    (task, n): "### question:\n" + ("다음 중 유동자산에 속하는 것은?" if task == "knowledge" else "원금 100만원을 연 5% 단리로 2년 맡기면 이자는?")
    + "\n### options:\n" + "\n".join(f"{chr(65 + i)}. {x}" for i, x in enumerate((["현금", "토지", "건물", "특허권", "영업권", "기계", "선박"] if task == "knowledge" else ["10만원", "5만원", "15만원", "20만원", "25만원", "2만원", "1만원"])[:n]))
    + "\n### reasoning_process:\n" + ("일 년 안에 현금이 되는 자산을 고른다." if task == "knowledge" else "100만원에 0.05와 2를 곱한다.") + "\n### answer:\nA"
    for task in ("knowledge", "math") for n in (4, 5, 6, 7)
}


def fewshot(task: str, n_options: Column, key: Column) -> Column:
    """The example with as many options; for the common task knowledge or math, drawn by hash of key."""
    table = lambda t: F.element_at(F.create_map(*[x for n in (4, 5, 6, 7) for x in (F.lit(n), F.lit(FEWSHOTS[t, n]))]), n_options)
    if task != "common":
        return table(task)
    return F.when(drawn(key, 2) == 0, table("knowledge")).otherwise(table("math"))


def with_fewshot(rows: DataFrame, shots: DataFrame, file: Column, key: Column) -> DataFrame:
    """rows with example, one of the examples in the file named, drawn by hash of key; null where there is no such file.

    shots: file, pos (from 0), example, as `sources.files.fewshots` reads them.
    """
    name, n, pos, own = fresh([*rows.columns, "example"], "file", "n", "pos", "own")
    counts = shots.groupBy(F.col("file").alias(name)).agg(F.count("*").alias(n))
    asked = rows.withColumn(name, file).join(counts, name, "left").withColumn(pos, drawn(key, F.col(n)))
    given = shots.select(F.col("file").alias(name), F.col("pos").alias(own), "example")
    return asked.join(given.withColumnRenamed(own, pos), [name, pos], "left").select(*[c for c in rows.columns if c != "example"], "example")
