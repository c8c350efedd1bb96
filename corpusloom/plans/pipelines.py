"""Round drivers: generate, validate, regenerate what failed, judge, remove answer bias, grade, save.

Nodes are functions from DataFrame to DataFrame; each call stage ends in a
barrier, and only counts come back to the driver. References whose call failed
count as errors and are tried again. Rounds are bounded by max_rounds.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import curate, debias, payload, reshape, validate
from ..sources.files import write_errors, write_jsonl, write_jsonl_sized
from . import prompts
from .barrier import barrier, fresh, observed
from .graph import END, Graph, State
from .ledger import Ledger
from .provider import SCHEMAS, CompletionProvider, completed
from .templates import Library

MCQA = "questions array<struct<question string, options array<string>>>, answers array<struct<reasoning_process string, answer string>>"
QA = "questions array<struct<question string>>, answers array<struct<answer string>>"
JUDGES = {"hallucination": "hallucination string, hallucination_desc string", "preference": "choice string, preference_desc string", "value": "value int", "classification": "classification string"}


@dataclass
class Settings:
    name: str = "run"
    domain: str = "common"
    task: str = "common"
    n_datasets: int = 5
    max_step: int = 2
    tolerance: float = 0.03
    max_rounds: int = 10
    model: str | dict[str, str] = "stub"  # one for all stages, or by stage
    save_dir: str | None = None
    save_parts: bool = False  # results are folders of parts, whatever their size
    file_mb: float = 256  # results of more MB than that are folders of parts in order, as one task writes a file
    log_dir: str | None = None  # where the items of a failed step go; beside save_dir if none is named
    drop_unusable: bool = False
    if_fewshot: bool = True
    threads: int = 8
    templates: Library | None = None  # prompts by other files than the package's own
    state_dir: str | None = None  # where the state is kept after each node, so that a stopped run goes on with the next
    ledger: Ledger | None = None  # where calls are kept, so that a run started again makes none twice
    rate: float | None = None  # calls a second, all tasks together; else the provider's own
    partitions: int | None = None  # tasks of a stage of calls

    def save(self, df: DataFrame, path: str, order: list[str]) -> None:
        if self.save_parts:
            write_jsonl(df, path)
        else:
            write_jsonl_sized(df, path, order, self.file_mb)

    def model_of(self, stage: str) -> str:
        """The model of a stage: mcqa, qa, hallucination, preference, value or classification."""
        if isinstance(self.model, str):
            return self.model
        if stage not in self.model:
            raise ValueError(f"no model for stage {stage!r}")
        return self.model[stage]


def _task(rows: DataFrame, s: Settings, kind: str, step: int, turn: int, n: int, system: Column, user: Column, n_options: Column | None = None, item: Column | None = None) -> DataFrame:
    return rows.select(
        "index", (F.lit(0) if item is None else item).cast("int").alias("item_ord"), F.lit(kind).alias("eval_type"), F.lit(s.model_of(kind)).alias("model"), F.lit(step).alias("step"), F.lit(turn).alias("round"), F.lit(n).alias("n_datasets"),
        (F.lit(0) if n_options is None else n_options).cast("int").alias("n_options"), F.coalesce(system, F.lit("")).alias("system"), F.coalesce(user, F.lit("")).alias("user"),
    )


def _called(s: Settings, provider: CompletionProvider, name: str, rows: DataFrame, kind: str, *task, **more) -> DataFrame:
    """What a stage of calls gives; answers of another shape than asked for are errors, with the places that are wrong."""
    done = completed(_task(rows, s, kind, *task, **more), provider, name, s.threads, s.partitions, s.ledger, kind, s.rate)
    wrong = payload.said(payload.errors(F.col("response"), SCHEMAS["qa2" if kind == "qa" and task[0] == 2 else kind]))
    return done.withColumns({"status": F.when((F.col("status") == "ok") & wrong.isNotNull(), "error").otherwise(F.col("status")), "error": F.when(F.col("status") == "ok", wrong).otherwise(F.col("error"))})


def _stamped(df: DataFrame, s: Settings, kind: str) -> DataFrame:
    return df.withColumns({"oai_model": F.lit(s.model_of(kind)), "update_at": F.date_format(F.current_date(), "yyyy-MM-dd")})


def rounds(rows: DataFrame, keys: list[str], s: Settings, name: str, ask: Callable[[DataFrame, int], DataFrame], good: Column, share: float | None) -> tuple[DataFrame, int]:
    """rows with the columns of what ask(todo, round) gives for their keys, once that is good; and how many rounds it took.

    A row without an answer (its call failed) is an error like one with a bad answer, and a bad row takes all of its index with
    it. Errors are asked again as long as they are more than a share of all, or with share None any, and rounds are left. A
    round is two writes: its calls, and its rows with what came of them, whose counts are taken by that write.
    """
    total, todo, turn, found = 0, rows, 0, None
    while True:
        got = ask(todo, turn).dropDuplicates(keys)
        there, ok = fresh([*todo.columns, *got.columns], "there", "ok")
        own = todo.drop(*[c for c in got.columns if c not in keys])
        fine = F.coalesce(good & F.col(there), F.lit(False))
        flagged = own.join(got.withColumn(there, F.lit(True)), keys, "left").withColumn(ok, fine if len(keys) > 1 else F.min(fine).over(Window.partitionBy(*keys))).drop(there)
        table, counts = observed(flagged, f"{name}-round{turn}", total=F.count(F.lit(1)), left=F.count_if(~F.col(ok)))
        done = table.filter(ok).drop(ok)
        found = done if found is None else found.unionByName(done)
        todo, total, turn = table.filter(~F.col(ok)).select(*own.columns), total or counts["total"], turn + 1
        if turn >= s.max_rounds or not (counts["left"] if share is None else validate.over_tolerance(counts["left"], total, share)):
            return found, turn


def generate_mcqa(references: DataFrame, s: Settings, provider: CompletionProvider, step: int) -> DataFrame:
    """Batches of questions; four buckets of references get 4 to 7 options, anew for what is regenerated."""

    def make(rows: DataFrame, turn: int) -> DataFrame:
        rows = reshape.split_chunk(rows, 4, ["index"])
        n = F.col("chunk_index") + 4
        example = prompts.fewshot(s.task, n, F.col("index")) if s.if_fewshot else None
        user = prompts.user_prompt_for("mcqa", step, s.n_datasets, table="table" in rows.columns, templates=s.templates)
        done = _called(s, provider, f"{s.name}-mcqa{step}-{turn}", rows, "mcqa", step, turn, s.n_datasets, prompts.system_prompt("mcqa", step, s.domain, s.task, n, example, s.templates), user, n)
        x = F.from_json("response", MCQA)
        got = done.filter("status = 'ok'").select("index", F.lit(step).alias("step"), x["questions"]["question"].alias("question"), x["questions"]["options"].alias("options"), x["answers"]["reasoning_process"].alias("reasoning_process"), x["answers"]["answer"].alias("answer"))
        return got

    return rounds(references, ["index"], s, f"{s.name}-mcqa{step}", make, ~validate.mcqa_batch_error(s.n_datasets), s.tolerance)[0]


def judged(items: DataFrame, kind: str, s: Settings, provider: CompletionProvider, user: Column, bad: Column | None = None) -> DataFrame:
    """items(index, item_ord, ...) with a judge's columns; labels that are none are asked for again, by twice the strictness.

    Without bad only calls fail, and all that failed are made again: no share of them is tolerated.
    """

    def ask(todo: DataFrame, turn: int) -> DataFrame:
        done = _called(s, provider, f"{s.name}-{kind}-{turn}", todo, kind, 1, turn, 1, prompts.system_prompt(kind, templates=s.templates), user, item=F.col("item_ord"))
        x = F.from_json("response", JUDGES[kind])
        got = done.filter("status = 'ok'").select("index", "item_ord", x.alias("x")).select("index", "item_ord", "x.*")
        if kind in ("hallucination", "classification"):
            got = got.withColumn(kind, F.lower(kind))
        if kind == "preference":
            got = got.select("index", "item_ord", F.upper(F.left("choice", F.lit(1))).alias("preference"), "preference_desc")
        return got

    return rounds(items, ["index", "item_ord"], s, f"{s.name}-{kind}", ask, F.lit(True) if bad is None else ~bad, None if bad is None else s.tolerance / 2)[0]


def _saved(make, items: DataFrame, s: Settings, kind: str, step: int) -> DataFrame:
    """Writes and returns make(), the graded items. If that fails, the items go to an error file and the error on to the caller."""
    name = f"{s.name}_{s.task}_{kind}_{s.domain}_step_{step}"
    try:
        df = make()
        if s.save_dir:
            s.save(df, f"{s.save_dir}/{name}.jsonl", ["index", "item_ord"])
        return df
    except Exception as e:
        if s.log_dir or s.save_dir:
            write_errors(items, s.log_dir or prompts.PathConfig(s.save_dir).logs, name, e)
        raise


def mcqa_graph(s: Settings, provider: CompletionProvider) -> Graph:
    """Steps of multiple-choice items over a state of rows (index, title, contents) and step: generate, judge, grade, and again."""

    def generate(x: State) -> State:
        batches = generate_mcqa(x["rows"], s, provider, x["step"])
        return {"items": reshape.explode_batches(batches, ["question", "options", "reasoning_process", "answer"], ["index", "title", "contents", "step"])}

    def judge(x: State) -> State:
        items = judged(x["items"], "hallucination", s, provider, prompts.user_prompt_for("hallucination", templates=s.templates), validate.label_errors(F.col("hallucination"), validate.HALLUCINATION))
        return {"items": items.filter(~validate.unusable(F.col("hallucination"))) if s.drop_unusable else items}

    def grade(x: State) -> State:
        step, key = x["step"], F.concat("index", F.lit(":"), F.col("item_ord").cast("string"), F.lit(f":{x['step']}"))
        options, answer = debias.shuffled(F.col("options"), F.col("answer"), key)
        final = x["items"].withColumns({"options": options, "answer": answer})
        final = final.withColumn("reasoning_process", debias.concluded(F.col("reasoning_process"), F.col("answer"), key)).withColumn("type", F.lit("mcqa"))

        def graded() -> DataFrame:
            rows = judged(final, "value", s, provider, prompts.user_prompt_for("value", templates=s.templates))
            return barrier(_stamped(curate.graded(rows), s, "mcqa"), f"{s.name}-step{step}")

        saved = _saved(graded, final, s, "mcqa", step)
        return {"result": x["result"].unionByName(saved) if "result" in x else saved}

    def advance(x: State) -> State:
        # Items as they were before the shuffle are the next step's examples; references without any stay out.
        return {"rows": reshape.with_previous(x["rows"], x["items"], ["item_ord"]).filter("prev_example is not null"), "step": x["step"] + 1}

    more = (lambda x: "advance" if x["step"] < s.max_step else END, ("advance", END))
    return Graph("generate", {"generate": generate, "judge": judge, "grade": grade, "advance": advance}, {"generate": "judge", "judge": "grade", "grade": more, "advance": "generate"})


def mcqa(references: DataFrame, s: Settings, provider: CompletionProvider) -> DataFrame:
    """All steps of multiple-choice items from references(index, title, contents)."""
    return mcqa_graph(s, provider).run(references.sparkSession, {"rows": references, "step": 1}, s.state_dir)["result"]


def answered(items: DataFrame, s: Settings, provider: CompletionProvider) -> DataFrame:
    """items(index, item_ord, question, ...) with a closed-book answer; all without one are asked again, up to max_rounds."""

    def ask(todo: DataFrame, turn: int) -> DataFrame:
        done = _called(s, provider, f"{s.name}-qa2-{turn}", todo, "qa", 2, turn, 1, prompts.system_prompt("qa", 2, templates=s.templates), prompts.user_prompt_for("qa", 2, templates=s.templates), item=F.col("item_ord"))
        return done.filter("status = 'ok'").select("index", "item_ord", F.from_json("response", "answer string")["answer"].alias("answer"))

    return rounds(items, ["index", "item_ord"], s, f"{s.name}-qa2", ask, F.col("answer").isNotNull(), None)[0]


def qa_graph(s: Settings, provider: CompletionProvider) -> Graph:
    """Question and grounded answer, closed-book answer, preference and value, over a state of rows (index, title, contents)."""

    def make(rows: DataFrame, turn: int) -> DataFrame:
        user = prompts.user_prompt_for("qa", 1, s.n_datasets, templates=s.templates)
        done = _called(s, provider, f"{s.name}-qa1-{turn}", rows, "qa", 1, turn, s.n_datasets, prompts.system_prompt("qa", 1, s.domain, s.task, templates=s.templates), user)
        x = F.from_json("response", QA)
        return done.filter("status = 'ok'").select("index", x["questions"]["question"].alias("question"), x["answers"]["answer"].alias("old_answer"))

    def generate(x: State) -> State:
        lists = F.col("question"), F.col("old_answer")
        batches, _ = rounds(x["rows"], ["index"], s, f"{s.name}-qa", make, ~(validate.num_matching_errors(*lists) | validate.deficient_errors(s.n_datasets, *lists)), s.tolerance)
        items = reshape.explode_batches(batches, ["question", "old_answer"], ["index", "title", "contents"]).withColumnRenamed("index", "reference_index")
        return {"items": items.withColumn("index", F.concat("reference_index", F.lit("_"), F.col("item_ord").cast("string")))}

    def answer(x: State) -> State:
        return {"items": answered(x["items"], s, provider)}

    def compare(x: State) -> State:
        items = judged(x["items"], "preference", s, provider, prompts.user_prompt_for("preference", templates=s.templates), validate.label_errors(F.col("preference"), validate.PREFERENCE))
        return {"items": items.withColumn("type", F.lit("qa"))}

    def grade(x: State) -> State:
        def graded() -> DataFrame:
            rows = judged(x["items"], "value", s, provider, prompts.user_prompt_for("value", kind="qa", templates=s.templates))
            return barrier(_stamped(curate.graded(rows), s, "qa"), f"{s.name}-qa-final")

        return {"result": _saved(graded, x["items"], s, "qa", 4)}

    return Graph("generate", {"generate": generate, "answer": answer, "compare": compare, "grade": grade}, {"generate": "answer", "answer": "compare", "compare": "grade", "grade": END})


def qa(references: DataFrame, s: Settings, provider: CompletionProvider) -> DataFrame:
    """Question, grounded answer, closed-book answer, preference and value of items from references."""
    return qa_graph(s, provider).run(references.sparkSession, {"rows": references}, s.state_dir)["result"]


def classification_graph(s: Settings, provider: CompletionProvider) -> Graph:
    """Topics of references, over a state of rows (index, title, contents): classify, then save."""

    def classify(x: State) -> State:
        rows = x["rows"].withColumns({"item_ord": F.lit(0), "type": F.lit("references")})
        return {"items": judged(rows, "classification", s, provider, prompts.user_prompt_for("classification", templates=s.templates), validate.label_errors(F.col("classification"), validate.CLASSIFICATION))}

    def save(x: State) -> State:
        out = barrier(_stamped(x["items"].drop("item_ord"), s, "classification"), f"{s.name}-classification")
        if s.save_dir:
            s.save(out, f"{s.save_dir}/{s.name.removesuffix('.jsonl')}.jsonl", ["index"])
        return {"result": out}

    return Graph("classify", {"classify": classify, "save": save}, {"classify": "save", "save": END})


def classification(references: DataFrame, s: Settings, provider: CompletionProvider) -> DataFrame:
    """references with their topic."""
    return classification_graph(s, provider).run(references.sparkSession, {"rows": references}, s.state_dir)["result"]


def workflow_graph(kind: str = "mcqa") -> str:
    """The nodes of a pipeline as Mermaid text."""
    return {"mcqa": mcqa_graph, "qa": qa_graph, "classification": classification_graph}[kind](Settings(), None).mermaid()
