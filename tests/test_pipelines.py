"""The generation pipelines against plain loops over the same provider."""

import hashlib
import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import debias
from corpusloom.plans import pipelines, prompts
from corpusloom.plans.provider import HttpProvider, StubProvider, json_schema

GOOD = {"hallucination": {"fake_answer", "fake_references", "deficient_question", "deficient_answer", "usable"}, "preference": set("ABE"), "classification": {"knowledge_accounting", "knowledge_market", "math_accounting", "math_market", "quant", "law", "no"}}


def refs(spark, n):
    return spark.createDataFrame([(f"b_{i}", "t", f"text {i}") for i in range(n)], "index string, title string, contents string")


def ask(provider, **task):
    try:
        return provider.complete({"item_ord": 0, "n_options": 0, "n_datasets": 1, **task})
    except TimeoutError:
        return None


def again(errors, total, ratio):
    return errors > max(1, int(ratio * total))


def judge(provider, kind, keys, s, allowed=None):
    """Per (index, item_ord), a label that is allowed; keys without one are asked for again."""
    found, todo, turn = {}, list(keys), 0
    while True:
        for index, k in todo:
            got = ask(provider, eval_type=kind, step=1, round=turn, index=index, item_ord=k)
            if got is not None:
                label = {"hallucination": lambda g: g["hallucination"].lower(), "preference": lambda g: g["choice"][:1].upper(), "value": lambda g: g["value"], "classification": lambda g: g["classification"].lower()}[kind](got)
                if allowed is None or label in allowed:
                    found[index, k] = label
        todo, turn = [x for x in todo if x not in found], turn + 1
        if turn >= s.max_rounds or not (todo if allowed is None else again(len(todo), len(keys), s.tolerance / 2)):
            return found


def generate(provider, indexes, s, step, kind, make):
    good, todo, turn = {}, list(indexes), 0
    while True:
        rows = sorted(todo)
        size, more = divmod(len(rows), 4)
        bucket = [b for b in range(4) for _ in range(size + (b < more))]
        for index, b in zip(rows, bucket):
            got = ask(provider, eval_type=kind, step=step, round=turn, n_datasets=s.n_datasets, n_options=b + 4 if kind == "mcqa" else 0, index=index)
            batch = got and make(got)
            if batch:
                good[index] = batch
        todo, turn = [x for x in todo if x not in good], turn + 1
        if turn >= s.max_rounds or not again(len(todo), len(indexes), s.tolerance):
            return good


def mcqa_batch(s):
    def make(got):
        q, a = got["questions"], got["answers"]
        ok = len(q) == len(a) == s.n_datasets and all(4 <= len(x["options"]) <= 7 and y["answer"] in [o[0] for o in x["options"]] for x, y in zip(q, a))
        return [(x["question"], x["options"], y["reasoning_process"], y["answer"]) for x, y in zip(q, a)] if ok else None

    return make


def slow_mcqa(provider, indexes, s):
    out = []
    for step in range(1, s.max_step + 1):
        batches = generate(provider, indexes, s, step, "mcqa", mcqa_batch(s))
        items = {(index, k): item for index, batch in batches.items() for k, item in enumerate(batch)}
        labels = judge(provider, "hallucination", items, s, GOOD["hallucination"])
        items = {key: item for key, item in items.items() if key in labels}
        values = judge(provider, "value", items, s)
        for (index, k), (question, options, why, answer) in items.items():
            key = f"{index}:{k}:{step}"
            order = [i for _, i in sorted((hashlib.md5(f"{key}:{i}".encode()).hexdigest(), i) for i in range(len(options)))]
            moved = [chr(65 + j) + options[i][1:] for j, i in enumerate(order)]
            letter = chr(65 + order.index(ord(answer) - 65))
            closing = debias.CONCLUSIONS[int(hashlib.md5(key.encode()).hexdigest()[:8], 16) % len(debias.CONCLUSIONS)]
            if 0 <= values.get((index, k), -1) <= 5:
                out.append((index, k, step, question, moved, f"{why} {closing.format(letter)}", letter, labels[index, k], values[index, k]))
        indexes = sorted({index for index, _ in items})
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_mcqa(spark, seed):
    provider = StubProvider(seed=seed, malformed=0.25, failing=0.1)
    s = pipelines.Settings(name="brute", n_datasets=2, tolerance=0.1, max_rounds=5)
    rows = pipelines.mcqa(refs(spark, 13), s, provider).select("index", "item_ord", "step", "question", "options", "reasoning_process", "answer", "hallucination", "value").collect()
    want = slow_mcqa(provider, [f"b_{i}" for i in range(13)], s)
    assert sorted(map(str, (tuple(r) for r in rows))) == sorted(map(str, want)) and len(want) > 20


def test_qa(spark):
    provider = StubProvider(seed=4, malformed=0.25, failing=0.1)
    s = pipelines.Settings(name="brute", n_datasets=3, tolerance=0.1, max_rounds=6)

    def make(got):
        q, a = got["questions"], got["answers"]
        return [(x["question"], y["answer"]) for x, y in zip(q, a)] if len(q) == len(a) == s.n_datasets else None

    items = {(f"{i}_{k}", k): item for i, batch in generate(provider, [f"b_{i}" for i in range(13)], s, 1, "qa", make).items() for k, item in enumerate(batch)}
    answers, todo, turn = {}, list(items), 0
    while todo and turn < s.max_rounds:
        for index, k in todo:
            got = ask(provider, eval_type="qa", step=2, round=turn, index=index, item_ord=k)
            if got:
                answers[index, k] = got["answer"]
        todo, turn = [x for x in todo if x not in answers], turn + 1
    labels = judge(provider, "preference", answers, s, GOOD["preference"])
    values = judge(provider, "value", labels, s)
    want = [(i, k, *items[i, k], answers[i, k], labels[i, k], v) for (i, k), v in values.items() if 0 <= v <= 5]
    rows = pipelines.qa(refs(spark, 13), s, provider).select("index", "item_ord", "question", "old_answer", "answer", "preference", "value").collect()
    assert sorted(map(str, (tuple(r) for r in rows))) == sorted(map(str, want)) and len(want) > 20


def test_classification(spark):
    provider = StubProvider(seed=5, malformed=0.3, failing=0.1)
    s = pipelines.Settings(name="brute", tolerance=0.1, max_rounds=6)
    want = judge(provider, "classification", [(f"b_{i}", 0) for i in range(30)], s, GOOD["classification"])
    got = pipelines.classification(refs(spark, 30), s, provider).collect()
    assert {(r["index"], 0): r.classification for r in got} == want and len(got) == len(want)


def test_models_by_stage(spark, tmp_path):
    log = str(tmp_path / "calls")

    class Noting(StubProvider):
        def complete(self, task):
            with open(log, "a") as f:
                f.write(f"{task['eval_type']} {task['model']}\n")
            return super().complete(task)

    models = {"mcqa": "m1", "hallucination": "m2", "value": "m3"}
    days = [datetime.now(UTC).date().isoformat()]
    got = pipelines.mcqa(refs(spark, 3), pipelines.Settings(name="m", n_datasets=1, max_step=1, model=models), Noting()).collect()
    assert {r.update_at for r in got} <= {*days, datetime.now(UTC).date().isoformat()}
    assert {tuple(x.split()) for x in open(log)} == set(models.items()) and {r.oai_model for r in got} == {"m1"}
    with pytest.raises(ValueError, match="no model"):
        pipelines.Settings(model=models).model_of("qa")


def test_items_of_a_failed_step_are_kept(spark, tmp_path, monkeypatch):
    """Grading that breaks leaves the items and the error in a file, and raises."""

    def broken(items, kind, *rest, own=pipelines.judged):
        if kind == "value":
            raise RuntimeError("out of order")
        return own(items, kind, *rest)

    monkeypatch.setattr(pipelines, "judged", broken)
    for run in (pipelines.mcqa, pipelines.qa):
        folder = tmp_path / run.__name__
        with pytest.raises(RuntimeError):
            run(refs(spark, 3), pipelines.Settings(name="x", n_datasets=2, save_dir=str(folder)), StubProvider())
        rows = [json.loads(x) for p in (folder / "logs").glob("error_x_*/part*") for x in p.read_text().splitlines()]
        assert len(rows) == 6 and all(r["error"] == "out of order" and r["question"] for r in rows)


def test_user_prompts_by_stage(spark):
    row = spark.createDataFrame([("t", "c", "q", ["A. x", "B. y"], "r", "A", "o", "p")], "title string, contents string, question string, options array<string>, reasoning_process string, answer string, old_answer string, prev_example string")
    say = lambda *a, **k: row.select(prompts.user_prompt_for(*a, **k)).first()[0]
    assert say("qa", 2) == "q" and say("value", kind="references") == "### 내용:\nc\n"
    assert say("hallucination") == "### 질문:\nq\n### 선택지:\nA. x\nB. y\n" and "### 답:\nA" in say("hallucination", kind="qa")
    assert say("preference").index("o") < say("preference").index("A") and say("mcqa", 2).endswith("### 예시:\np\n") and "예시" not in say("mcqa", 1)
    assert say("classification") == "### 제목:\nt\n### 내용:\nc\n"
    with pytest.raises(ValueError, match="unknown"):
        prompts.user_prompt_for("other")
    text = row.select(prompts.generate_fewshot(F.lit("d"), "qa", step=1, domain="law")).first()[0]
    assert prompts.ROLES["law"] in text and prompts.LEVELS[0] in text and text.endswith("### 설명:\nd") and "{" not in text
    styles = [r[0] for r in spark.range(54).select(prompts.style(F.col("id"))).collect()]
    assert len(set(styles)) == 27 and styles[:27] == styles[27:] and all(styles)


def test_http_provider_pauses_and_asks_by_schema(monkeypatch):
    from corpusloom.plans import provider

    sent, slept = [], []

    class Answer:
        def __init__(self, text):
            self.text = text

        def __enter__(self):
            return self

        def __exit__(self, *_):
            pass

        def read(self):
            return json.dumps({"choices": [{"message": {"content": self.text}}]}).encode()

    def urlopen(request, timeout):
        sent.append(json.loads(request.data))
        return Answer("no json" if len(sent) < 3 else '{"value": 4}')

    monkeypatch.setattr(provider, "urlopen", urlopen)
    monkeypatch.setattr(provider.time, "sleep", slept.append)
    task = {"eval_type": "value", "step": 1, "model": "m9", "system": "s", "user": "u", "index": "i"}
    assert HttpProvider("https://example.org", "k", "m", rate=1000, pause=0.5).complete(task) == {"value": 4}
    assert [x for x in slept if x >= 0.5] == [0.5, 1.0] and {b["model"] for b in sent} == {"m9"}
    assert sent[0]["response_format"]["json_schema"]["schema"] == json_schema({"value": "integer"}) == {"type": "object", "properties": {"value": {"type": "integer"}}, "required": ["value"], "additionalProperties": False}
