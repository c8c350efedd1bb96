"""Registered queries against brute force, on tables with every awkward case."""

import hashlib
import math
import re
import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from corpusloom.llm import bpe, queries, toxicity

WORD = re.compile("[^\x20\x09-\x0d]+")
Q = queries.queries()


def docs(spark, d):
    return [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]


def sha(x):
    return hashlib.sha256(x).hexdigest()


def windows_gone(sequences, size):
    """sequences: (order key, list); per sequence, which items a window covers that starts earlier too."""
    seen, out = set(), []
    for _, s in sequences:
        gone = [False] * len(s)
        for i in range(len(s) - size + 1):
            w = bytes(s[i : i + size]) if isinstance(s, bytes) else tuple(s[i : i + size])
            if w in seen:
                gone[i : i + size] = [True] * size
            seen.add(w)
        out.append(gone)
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, hashlib.md5(r[1].encode()).hexdigest() if r[1] is not None else ""))


@pytest.mark.parametrize("name", [*Q, "pipeline"])
def test_empty_tables_give_no_rows(spark, none, name):
    run = corpus_pipeline.run if name == "pipeline" else Q[name]
    assert run(spark, none).count() == 0


def slow_topk(rows, every, k):
    want = []
    for q, x in {i: v for i, v in rows if i % every == 0}.items():
        best = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in rows if i != q)[:k]
        want += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(want)


def test_topk_of_large_components(spark):
    """Beyond floats and beyond longs scores stay exact; what can't be stored raises."""
    import random

    from pyspark.sql import functions as F

    from corpusloom.llm import topk

    r = random.Random(9)
    rows = [(i, [r.choice([-1, 1]) * r.random() * 2.0 ** r.choice([0, 10, 20, 21]) for _ in range(4)]) for i in range(120)]
    found = lambda rows: topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 10 == 0, 5).collect()
    assert sorted(tuple(x) for x in found(rows)) == slow_topk([(i, [math.floor(1024 * x) for x in v]) for i, v in rows], 10, 5)
    wide = [(0, [2.0**30, 1.0, 0.0]), (1, [0.0, 3.0, 5.0]), (2, [-(2.0**30), 2.0, 1.0]), (3, [1.0, 0.0, 0.0])]
    assert [tuple(x)[2:] for x in topk.top_k(spark.createDataFrame(wide, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, 2).collect()] == [(3, 2**50), (1, 3 * 2**20)]
    for bad in ([(0, [2.0**31]), (1, [2.0**31])], [(0, [2.0**54]), (1, [0.0])]):
        with pytest.raises(Exception, match="fit a long"):
            found(bad)


def test_topk_compares_few_rows(spark):
    """On vectors in clusters most rows are cut off by the bounds."""
    from pyspark.sql import functions as F

    from corpusloom.llm import topk

    rng = np.random.default_rng(1)
    centres = rng.standard_normal((12, 16))
    x = centres[rng.integers(0, 12, 6000)] + 0.05 * rng.standard_normal((6000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    _, seeds, found = topk.searched(df, F.col("vec_id") % 100 == 0)
    compared = sum(d.agg(F.sum("scored")).first()[0] for d in (seeds, found))
    assert compared < 0.5 * 60 * 6000
    rows = [(i, [math.floor(1024 * c) for c in v]) for i, v in enumerate(x.tolist())]
    assert sorted(tuple(r) for r in topk.merged(found, 10).collect()) == slow_topk(rows, 100, 10)


def test_topk(spark, odd):
    rows = [(r.vec_id, [math.floor(1024 * x) for x in r.embedding]) for r in spark.read.parquet(f"{odd}/embeddings.parquet").collect() if r.vec_id is not None and r.embedding and all(x is not None and math.isfinite(x) for x in r.embedding)]
    want = slow_topk(rows, 100, 10)
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in Q["op1_topk"](spark, odd).collect()]
    assert sorted(got) == want and len(got) == 50


@pytest.mark.parametrize("which", ["odd", "repeated"])
def test_mix(spark, request, which):
    d = request.getfixturevalue(which)
    got, rows = Q["op2_mix"](spark, d).collect(), docs(spark, d)
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(i), len(WORD.findall(t or ""))) for i, t, _ in rows)
    sizes, total = defaultdict(int), 0
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
        total += len(WORD.findall(t or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    full: set = set()
    while True:
        share = (total - sum(3 * sizes[s] for s in full)) / max(1, sum(weight[s] for s in order if s not in full))
        more = {s for s in order if s not in full and weight[s] * share > 3 * sizes[s]}
        if not more:
            break
        full |= more
    target = {s: 3 * sizes[s] if s in full else weight[s] * share for s in order}
    assert {(r.source_size, round(r.target, 3)) for r in got} == {(sizes[s], round(target[s], 3)) for s in order}
    assert all(r.taken <= 3 * r.size and r.taken % max(1, r.size) == 0 for r in got)
    taken = defaultdict(int)
    for r in got:
        taken[r.source_size, round(r.target, 3)] += r.taken
    biggest = max(r.size for r in got)
    assert all(abs(taken[k] - k[1]) <= biggest for k in taken)
    assert sorted(map(str, got)) == sorted(map(str, Q["op2_mix"](spark, d).collect()))


def test_rounding_keeps_expectations(spark):
    """Of many small documents the words taken are near the target whatever the seed, and each is taken as often as it is due."""
    from pyspark.sql import functions as F

    from corpusloom.llm.mixing import mix

    df = spark.range(3000).selectExpr("id doc_id", "if(id % 4 = 0, 'a', 'b') source", "1 + id % 50 n")
    long = 0.0
    for seed in range(4):
        got = mix(df, F.col("n"), seed=seed).toPandas()
        got["taken"] = got["copies"] * got["size"]
        assert all(abs(g["taken"].sum() - g["target"].iloc[0]) <= 50 for _, g in got.groupby("source_size"))
        own = got[got["source_size"] > got["target"]]
        long += own[own["size"] > 25]["taken"].sum() / own[own["size"] > 25]["size"].sum() / (own["target"] / own["source_size"]).iloc[0] / 4
    assert abs(long - 1) < 0.05


def test_bpe(spark, odd):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.vocabulary())
    want = {}
    for i, text, _ in docs(spark, odd):
        e = t.encode(text or "", add_special_tokens=False).ids
        want[i] = (len(e), sha(struct.pack(f"<{len(e)}I", *e)), sha(t.decode(e, skip_special_tokens=False).encode()))
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in Q["op4_bpe"](spark, odd).collect()} == want


def test_bpe_property():
    from hypothesis import given, settings
    from hypothesis import strategies as st
    from tokenizers import Tokenizer

    t, b = Tokenizer.from_file(bpe.vocabulary()), bpe.ForcedBoundaryBpe(open(bpe.vocabulary()).read())

    @settings(max_examples=300, deadline=None)
    @given(st.text(max_size=200))
    def same(text):
        e = t.encode(text, add_special_tokens=False).ids
        assert b.encode_and_decode(text) == (struct.pack(f"<{len(e)}I", *e), t.decode(e, skip_special_tokens=False))

    same()


@pytest.mark.parametrize("which", ["odd", "repeated"])
def test_relative_lz(spark, request, which):
    d = request.getfixturevalue(which)
    rows = in_order(docs(spark, d))
    seqs = [(r[0], WORD.findall(r[1] or "")) for r in rows]
    want = [(i, len(w), sum(g), sha(" ".join(x for x, y in zip(w, g) if not y).encode())) for (i, w), g in zip(seqs, windows_gone(seqs, 20))]
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in Q["op5_relative_lz"](spark, d).collect())


@pytest.mark.parametrize("which", ["odd", "repeated"])
def test_suffix(spark, request, which):
    d = request.getfixturevalue(which)
    rows = in_order(docs(spark, d))
    seqs = [(r[0], (r[1] or "").encode()) for r in rows]
    want = []
    for (i, b), g in zip(seqs, windows_gone(seqs, 100)):
        want.append((i, len(b), sum(g), sum(y and not x for x, y in zip([False, *g], g)), sha(bytes(x for x, y in zip(b, g) if not y))))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in Q["op10_suffix"](spark, d).collect())


def test_crowded_anchor_is_split(spark, odd, monkeypatch):
    from corpusloom.llm import repeats

    monkeypatch.setattr(repeats, "CROWD", 3)
    test_suffix(spark, type("R", (), {"getfixturevalue": lambda self, n: odd})(), "odd")


def shingles(text, size):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset([tuple(w)] if 0 < len(w) < size else [tuple(w[i : i + size]) for i in range(len(w) - size + 1)])


def near_groups(rows, size, percent):
    sets = defaultdict(set)
    for i, t, *_ in rows:
        sets[i].add(shingles(t, size))
    ids, up = sorted(i for i in sets if i is not None), {}
    find = lambda x: x if up.get(x, x) == x else find(up[x])
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("which", ["odd", "repeated"])
def test_near(spark, request, which):
    d = request.getfixturevalue(which)
    rows = docs(spark, d)
    group = near_groups(rows, 3, 85)
    want = [(i, len(shingles(t, 3)), group.get(i), i is None or group[i] == i) for i, t, _ in rows]
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in Q["op7_near"](spark, d).collect())


@pytest.mark.parametrize(("size", "percent"), [(5, 80), (3, 85)])
def test_small_sets(spark, size, percent):
    """Sets of a few shingles, where one more or less decides."""
    from corpusloom.llm.neardup import groups

    w = [f"w{i}" for i in range(40)]
    rows = [(100 * n + k, " ".join(x)) for n in range(1, 20) for k, x in enumerate((w[:n], w[: n + 1], w[1 : n + 1], [*w[:n], "z"]))]
    got = {r.doc_id: r.component_id for r in groups(spark.createDataFrame(rows, "doc_id long, text string"), size, percent).collect()}
    assert got == near_groups(rows, size, percent)


def test_grams():
    texts = [b"", b"ab", b"Some Text of many bytes, some text", "réeux".encode(), b"x" * 20, b"12345678"]
    doc, h = toxicity.grams(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
    want = [(i, t.lower()[a : a + k]) for k in (5, 8) for i, t in enumerate(texts) for a in range(len(t) - k + 1) if k == 5 or t[a : a + 1] == b" "]
    assert doc.tolist() == [i for i, _ in want]
    assert len(set(h.tolist())) == len({g for _, g in want}) == len(set(zip(h.tolist(), [g for _, g in want])))


def test_risk_and_gradient():
    """The risk by its definition, text by text; the direction is its gradient, and leads back where the negative part is held."""
    rng = np.random.default_rng(2)
    for prior, lift in ((0.1, 0.0), (0.4, 0.0), (0.4, 6.0)):
        positive = rng.random(60) < 0.3
        z = rng.standard_normal(60) + lift * positive - lift * ~positive
        loss = lambda x, y: math.log1p(math.exp(-x if y else x))
        mean = lambda xs: sum(xs) / len(xs)

        def parts(z):
            below = mean([loss(x, False) for x in z[~positive]]) - prior * mean([loss(x, False) for x in z[positive]])  # noqa: B023
            return prior * mean([loss(x, True) for x in z[positive]]), below  # noqa: B023

        risk, g, held = toxicity.pu_risk(z, positive, prior)
        assert held == (parts(z)[1] < 0) == (lift > 0) and abs(risk - parts(z)[0] - max(0, parts(z)[1])) < 1e-9
        for i in range(60):
            up, down = z.copy(), z.copy()
            up[i] += 1e-5
            down[i] -= 1e-5
            a, b = parts(up), parts(down)
            slope = (b[1] - a[1]) / 2e-5 if held else (sum(a) - sum(b)) / 2e-5
            assert abs(slope - g[i]) < 1e-6


def test_logistic_curve():
    rng = np.random.default_rng(3)
    z = rng.standard_normal(20_000) * 3
    y = (rng.random(20_000) < 1 / (1 + np.exp(-0.7 * z + 1.5))).astype(float)
    slope, shift = toxicity.logistic_curve(z, y)
    assert abs(slope - 0.7) < 0.05 and abs(shift + 1.5) < 0.1
    assert toxicity.logistic_curve(np.zeros(0), np.zeros(0)) == toxicity.logistic_curve(z, np.ones(len(z))) == (1.0, 0.0)


def test_gram_counts(spark):
    """Counts by fold of every gram that enough positives hold, others may go; long texts are counted once each."""
    import random

    r = random.Random(4)
    rows = [("".join(r.choices("ab ", k=r.choice([0, 4, 40, 300]))) + ("" if i % 20 else "c" * 3000), i % 3 == 0, i % 5 % 3, None) for i in range(300)]
    got = {x.h: (list(x.p), list(x.u)) for x in toxicity.counted(spark.createDataFrame(rows, "text string, positive boolean, fold int, label int"), 4).collect()}
    want = defaultdict(lambda: ([0] * 3, [0] * 3))
    for text, positive, fold, _ in rows:
        _, h = toxicity.grams(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
        for g in set(h.view(np.int64).tolist()):
            want[g][not positive][fold] += 1
    assert got == {g: c for g, c in want.items() if sum(c[0]) >= 4}


def test_scores_are_calibrated(spark):
    """Where words tell only partly, scores of held-out rows are near the share of label 1."""
    import random

    r = random.Random(6)
    rows, labels = [], []
    for i in range(6000):
        bad = r.random() < 0.2
        w = ["".join(r.choices("abcdefgh", k=5)) for _ in range(12)] + (["vilesome"] if r.random() < (0.7 if bad else 0.1) else [])
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = [x for x in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect() if x.held_out]
    with_word = [x.score for x in got if "vilesome" in rows[x.doc_id][1]]
    without = [x.score for x in got if "vilesome" not in rows[x.doc_id][1]]
    assert abs(np.mean(with_word) - 0.14 / 0.22) < 0.12 and abs(np.mean(without) - 0.06 / 0.78) < 0.05


def test_toxicity(spark, tmp_path):
    import random

    r = random.Random(3)
    vocab = ["".join(r.choices("abcdefghijklmnop", k=r.randint(2, 8))) for _ in range(1500)]
    rows, labels = [], []
    for i in range(1500):
        w = r.choices(vocab, k=60)
        bad = r.random() < 0.15
        for _ in range(3 * bad):
            w[r.randrange(60)] = r.choice(["vilesome", "wretchful", "scornly"])
        rows.append((i, " ".join(w)))
        if i % 2:
            labels.append((i, int(bad)))
    truth = dict(labels)
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = toxicity.score(spark.createDataFrame([*rows, (-1, None), (None, "")], "doc_id long, text string"), model).collect()
    assert all(x.held_out == (x.doc_id is not None and zlib.crc32(str(x.doc_id).encode()) % 4 == 2) and 0 <= x.score <= 1 for x in got)
    held = [(x.score >= 0.3, truth[x.doc_id] == 1) for x in got if x.held_out and x.doc_id in truth]
    assert sum(p == t for p, t in held) / len(held) > 0.95


def test_toxicity_on_odd_tables(spark, odd, repeated):
    for d in (odd, repeated):
        assert Q["op8_toxicity"](spark, d).count() == len(docs(spark, d))


@pytest.mark.parametrize("which", ["odd", "repeated", "none"])
def test_kd_tree(spark, request, which):
    d = request.getfixturevalue(which)
    got, rows = Q["op9_kd_tree"](spark, d).collect(), docs(spark, d)
    want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == want
    shards, groups = defaultdict(list), defaultdict(list)
    for r in got:
        shards[r.shard].append(r)
        groups[r.size, r.text_crc32].append(r.shard)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 8
    for s in shards.values():
        assert sorted(r.slot for r in s) == list(range(len(s)))
    target = sum(r.size for r in got) / 8
    assert all(len(set(s)) == 1 for (size, _), s in groups.items() if size * len(s) * 10 <= target)


def kd_slowly(items, dims, weight, leaves, target):
    """Leaves of lists of dicts, cut at the edge nearest to the weighted share along the widest dimension."""
    span = [max(1e-12, max(x[d] for x in items) - min(x[d] for x in items)) for d in dims]

    def split(own, first, leaves):
        if leaves == 1:
            return {first: own}
        wide = [(max(x[d] for x in own) - min(x[d] for x in own)) / s if own else 0 for d, s in zip(dims, span)]
        own = sorted(own, key=lambda x: (x[dims[wide.index(max(wide))]], x["id"]))
        total, few, before, cuts = sum(x[weight] for x in own), leaves // 2, 0, []
        for k, x in enumerate(own):
            cuts.append((abs(before - total * few / leaves) + (target / 20 if x["inside"] else 0), before, k))
            before += x[weight]
        k = min(cuts)[2] if cuts else 0
        return split(own[:k], first, few) | split(own[k:], first + few, leaves - few)

    return split(items, 0, leaves)


def test_kd_tree_by_brute_force(spark):
    from corpusloom.llm.sharding import kd_leaves

    df = spark.range(900).selectExpr("id", "1 + pmod(id * 7919, 97) size", "double(id % 7) a", "double(if(id % 3 = 0, 5, id)) b", "id % 4 = 1 inside", "'x' shard_", "id node", "id leaves", "id `_total`")
    for leaves in (1, 6, 8):
        target = df.agg({"size": "sum"}).first()[0] / leaves
        got = kd_leaves(df, ["a", "b"], "size", ["id"], target, "inside")
        assert got.columns == [*df.columns, "shard"]
        want = kd_slowly([r.asDict() for r in df.collect()], ["a", "b"], "size", leaves, target)
        assert {(r.id, r.shard) for r in got.collect()} == {(x["id"], k) for k, xs in want.items() for x in xs}
        sizes = [sum(x["size"] for x in xs) for xs in want.values()]
        assert max(sizes) - min(sizes) <= 3 * 97 + target / 10


def test_kd_tree_splits_only_groups_larger_than_a_share(spark):
    """One text in a third of the rows, all with one doc_id; groups of five."""
    from corpusloom.llm.sharding import kd_shards, text_metadata

    rows = [(7, "the same " * 20, "en", "s")] * 3000 + [(i, f"text {i // 5} " + "x" * (i // 5 * 7919 % 300), None, f"s{i % 3}") for i in range(4000)]
    got = kd_shards(text_metadata(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))).collect()
    sizes, groups = defaultdict(int), defaultdict(set)
    for r in got:
        sizes[r.shard] += r.size
        groups[r.size, r.text_crc32].add(r.shard)
    target = sum(sizes.values()) / 8
    assert len(sizes) == 8 and all(abs(s - target) < target / 8 for s in sizes.values())
    assert [len(g) > 1 for g in groups.values()].count(True) == 1
    assert len({(r.shard, r.slot) for r in got}) == len(got) == len(rows)
    assert len({r.shard for r in kd_shards(text_metadata(spark.createDataFrame(rows[3000:], "doc_id long, text string, lang string, source string")), None, 50_000).collect()}) > 8


def test_mix_divides_a_repeated_row(spark):
    """A row that repeats 100,000 times is folded FAN at a time, and hits its target."""
    from pyspark.sql import functions as F

    from corpusloom.llm.mixing import mix

    df = spark.range(120_000).selectExpr("if(id < 100000, null, id) doc_id", "if(id < 100000, 'a', 'b') source", "if(id < 100000, 5L, 1 + id % 9) n")
    got = mix(df, F.col("n")).groupBy("source_size").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("target").alias("target"), F.count("*").alias("n")).collect()
    assert sum(r.n for r in got) == 120_000 and all(abs(r.taken - r.target) <= 10 for r in got)
    again = [sorted(map(str, mix(df, F.col("n")).groupBy("doc_id", "copies").count().collect())) for _ in range(2)]
    assert again[0] == again[1]


def test_pipeline_drops_what_is_predicted_toxic(spark, odd, monkeypatch):
    from corpusloom.llm.common import table

    start = table(spark, odd, "documents")
    for score, kept in ((0.4, 0), (0.29, start.count())):
        monkeypatch.setattr(toxicity, "fit", lambda *_: toxicity.Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(score / (1 - score)))))  # noqa: B023
        assert corpus_pipeline.drop_toxic(spark, start, odd).count() == kept
