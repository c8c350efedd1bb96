"""Each stage of the pipeline against a brute-force version on what the stage before has kept."""

import math
import struct
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from test_queries import WORD, docs, in_order, near_groups, sha, windows_gone

from corpusloom.llm import bpe, toxicity
from corpusloom.llm.common import table, written

STAGE = dict(corpus_pipeline.STAGES)


def plain(df):
    return Counter(map(str, df.collect()))


def slow_score(model, weights, text):
    """The sum of the weights of a text's different grams, one after the other."""
    b = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    found = {b[i : i + 5] for i in range(len(b) - 4)} | {b[i : i + 8] for i in range(len(b) - 7) if b[i] in b" \t\n\x0b\x0c\r"}
    return 1 / (1 + math.exp(-(model.bias + sum(weights(g) for g in found))))


def hash_of(gram):
    """The hash of one gram by itself."""
    _, h = toxicity.grams(np.frombuffer(gram, np.uint8), np.array([0, len(gram)]))
    return int(h[-1] if len(gram) == toxicity.STEM else h[0])


def test_stages():
    assert [k for k, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "suffix_dedup", "mixing", "bpe"] and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("which", ["odd", "repeated"])
def test_toxicity_stage(spark, request, which, monkeypatch):
    d = request.getfixturevalue(which)
    start = table(spark, d, "documents")
    grams = sorted({hash_of(w) for w in (b" abcdefg", b"abcde", b" the ", b"zzzzz", *((t or "").encode()[i : i + 5] for _, t, _ in docs(spark, d)[:60] for i in (0, 7, 30) if len((t or "").encode()[i : i + 5]) == 5))})
    model = toxicity.Model(np.array(grams, np.uint64), np.random.default_rng(1).standard_normal(len(grams)) * 2, -1.0)
    by_hash = dict(zip(grams, model.weights))
    monkeypatch.setattr(toxicity, "fit", lambda *_: model)
    got = plain(STAGE["toxicity"](spark, start, d))
    weights = lambda g: by_hash.get(hash_of(g), 0.0)
    want = Counter(str(r) for r in start.collect() if len(r.text or "") > 2000 or slow_score(model, weights, r.text) < toxicity.THRESHOLD)
    long = Counter(str(r) for r in start.collect() if len(r.text or "") > 2000)
    assert got - long == want - long and 0 < sum(got.values()) < start.count()


def test_toxicity_stage_learns_from_labels_that_may_be_used(spark, odd):
    start = table(spark, odd, "documents")
    kept = STAGE["toxicity"](spark, start, odd)
    model = toxicity.fit(start, table(spark, odd, "labels").filter(toxicity.remainder() != 2))
    assert kept.columns == start.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in toxicity.score(start, model).collect() if r.score < 0.3}


@pytest.mark.parametrize("which", ["odd", "repeated"])
def test_stages_after_the_first(spark, request, which):
    d = request.getfixturevalue(which)
    start, rows = table(spark, d, "documents"), docs(spark, d)
    near = written(STAGE["near_dedup"](spark, start, d), "t")
    group = near_groups(rows, 5, 80)
    assert sorted(str(r.doc_id) for r in near.collect()) == sorted(str(i) for i, _, _ in rows if i is None or group[i] == i)

    cut = written(STAGE["suffix_dedup"](spark, near, d), "t")
    kept = in_order([(r.doc_id, r.text) for r in near.collect()])
    seqs = [(i, (t or "").encode()) for i, t in kept]
    want = Counter()
    for (i, b), g, (_, t) in zip(seqs, windows_gone(seqs, 100), kept):
        left = bytes(x for x, y in zip(b, g) if not y).decode("utf-8", "ignore")
        if left or not any(g):
            want[i, t if not any(g) else left] += 1
    assert Counter((r.doc_id, r.text) for r in cut.collect()) == want and cut.columns == start.columns
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in cut.collect())

    mixed = written(STAGE["mixing"](spark, cut, d), "t")
    before, after = cut.collect(), plain(mixed)
    sizes, sources = lambda r: len(WORD.findall(r.text or "")), defaultdict(list)
    for r in before:
        sources[r.source].append(r)
    order = sorted(sources, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    own = {s: sum(map(sizes, sources[s])) for s in order}
    total, full = sum(own.values()), set()
    while True:  # targets stop at three times their source
        level = (total - sum(3 * own[s] for s in full)) / max(1e-9, sum(weight[s] for s in order if s not in full))
        more = {s for s in order if s not in full and weight[s] * level > 3 * own[s]}
        if not more:
            break
        full |= more
    for s in order:
        target = 3 * own[s] if s in full else weight[s] * level
        taken = sum(after[str(r)] / Counter(map(str, before))[str(r)] * sizes(r) for r in sources[s])
        assert abs(taken - target) <= max(map(sizes, sources[s]))
        for text, n in Counter(map(str, sources[s])).items():
            size = next(sizes(r) for r in sources[s] if str(r) == text)
            assert after[text] <= 3 * n and (size or not after[text])
    assert set(after) <= {str(r) for r in before} and mixed.columns == start.columns

    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.vocabulary())
    want = Counter()
    for r in mixed.collect():
        ids = t.encode(r.text or "", add_special_tokens=False).ids
        raw = struct.pack(f"<{len(ids)}I", *ids)
        want[r.doc_id, len(ids), sha(raw), sha(t.decode(ids, skip_special_tokens=False).encode()), raw] += 1
    got = STAGE["bpe"](spark, mixed, d)
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, bytes(r.ids)) for r in got.collect()) == want


def test_run(spark, odd, repeated, none):
    assert corpus_pipeline.run(spark, odd).count() > 0 and corpus_pipeline.run(spark, repeated).count() > 0 and corpus_pipeline.run(spark, none).count() == 0
