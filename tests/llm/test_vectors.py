"""Operators 11 to 13 against brute force, on vectors with every awkward case."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import annular, onebit, vectors, whitening

SCHEMA = "vec_id long, embedding array<double>, label int, id long, v int, key string, unlabelled int, code string, error long, centre int, grp int, score double, n int, component int"
NAN, INF = float("nan"), float("inf")


def odd_rows(dim=16, n=260, seed=0):
    """Vectors with nulls, non-finite components, zeros, other lengths, ties, repeated rows and ids, and no id."""
    r = random.Random(seed)
    vec = lambda: [r.choice([r.uniform(-2, 2), r.randint(-2, 2) / 2]) for _ in range(dim)]
    same = vec()
    rows = [(i, same if i % 5 == 0 else vec(), r.choice([None, 1, 2, 2, 2])) for i in range(n)]
    rows += rows[:7] + [(100, vec(), 1), (None, vec(), 2), (None, same, None), (n, None, 1), (n + 1, [NAN] * dim, 1), (n + 2, [1.0, None], 2), (n + 3, [-INF], 1), (n + 4, [], 1), (n + 5, [0.0] * dim, None), (n + 6, [1.5], 3), (200, same, 1)]
    r.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*x, 1, 2, "k", 3, "c", 4, 5, 6, 0.5, 7, 8) for x in rows], SCHEMA).repartition(3)


def whole(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


# --- 11 ----------------------------------------------------------------------


def slow_nearest(rows, every, k):
    rows = [(i, v) for i, v, *_ in rows if i is not None and whole(v) and any(v)]
    dim = max((len(v) for _, v in rows), default=0)
    rows = [(i, [*v, *[0.0] * (dim - len(v))]) for i, v in rows]
    asked = {}
    for i, v in rows:
        if i % every == 0:
            asked[i] = min(asked.get(i, v), v)

    def distance(a, b):
        total = 0.0
        for x, y in zip(b, a):
            total += (x - y) * (x - y)
        return math.sqrt(total)

    out = []
    for q, v in asked.items():
        best = sorted((distance(v, w), i) for i, w in rows if i != q)[:k]
        out += [(q, rank, i, d) for rank, (d, i) in enumerate(best, 1)]
    return sorted(out)


def found(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


@pytest.mark.parametrize(("every", "k"), [(20, 10), (1, 3), (50, 1000)])
def test_nearest_of_odd_vectors(spark, every, k):
    rows = odd_rows()
    assert found(onebit.nearest(frame(spark, rows), F.col("id") % every == 0, k, centres=3)) == slow_nearest(rows, every, k)


@pytest.mark.parametrize("rows", [[], [(100, [1.0, 2.0], 1)], [(1, [1.0], 1), (2, [2.0], 1)], [(0, [0.0, 0.0], 1), (1, [1.0, 0.0], 1)], [(0, [1.0], 1), (0, [2.0], 1), (7, [2.0, 0.5], 1)]])
def test_nearest_of_few_vectors(spark, rows):
    assert found(onebit.nearest(frame(spark, rows), F.col("id") % 100 == 0)) == slow_nearest(rows, 100, 10)


def test_one_bit_estimates_hold_their_bounds():
    """Lower bounds are below the true distances, but not by much, and estimates have no bias."""
    g = np.random.default_rng(3)
    x, q, centre, turn = g.standard_normal((2000, 48)), g.standard_normal((40, 48)), 0.1 * g.standard_normal(48), onebit.rotation(48, 256)
    assert np.allclose(turn @ turn.T, np.eye(48))
    signs, d, align = onebit.coded(x, centre, turn)
    assert signs.shape == (2000, 32) and 0.7 < align.min() and align.max() < 0.9
    true = np.sqrt(((q[:, None] - x[None]) ** 2).sum(2))
    low = onebit.lower_bounds(signs, d, align, q, centre, turn)
    assert (low <= true).all()
    assert (onebit.lower_bounds(signs, d, align, q, centre, turn, 2.0) <= true).mean() < 0.995
    middle = onebit.lower_bounds(signs, d, align, q, centre, turn, 0.0)
    assert abs((middle**2 - true**2).mean()) < 0.02 * (true**2).mean() and (true - low).mean() < 0.35 * true.mean()


def test_nearest_compares_few_rows_and_finds_all(spark):
    """On vectors in groups whole centres are out of reach; on random ones the codes cut most rows off. Recall is 1 on both."""
    g = np.random.default_rng(5)
    groups = g.standard_normal((12, 32))[g.integers(0, 12, 6000)] * 10 + g.standard_normal((6000, 32)) * 0.3
    for x, most in ((groups, 0.1), (g.standard_normal((6000, 64)), 0.5)):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
        _, both = onebit.searched(df, F.col("id") % 100 == 0, 10)
        both = both.cache()
        assert both.agg(F.sum("compared")).first()[0] < most * 60 * 6000
        got = {(r.query_id, r.vec_id) for r in onebit.ranked(both, 10).collect()}
        true = {(q, int(i)) for q in range(0, 6000, 100) for i in np.argsort(np.where(np.arange(6000) == q, np.inf, ((x - x[q]) ** 2).sum(1)), kind="stable")[:10]}
        assert got == true
        both.unpersist()


def test_copies_of_one_vector_are_spread(spark):
    """A third of all rows alike make slices of bounded size, and all of them count."""
    g = np.random.default_rng(6)
    x = [[1.0] * 8] * 2000 + g.standard_normal((4000, 8)).tolist()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    built = onebit.Index(df)
    assert built.packs.agg(F.sum("n")).first()[0] == 6000
    got = onebit.nearest(df, F.col("id") == 1000, 10).collect()
    assert [(r.vec_id, r.score) for r in got] == [(i, 0.0) for i in range(10)]


# --- 12 ----------------------------------------------------------------------


def slow_codes(rows, parts=16, entries=64, rounds=2, scale=256):
    rows = [r for r in rows if whole(r[1])]
    dim = -(-max([len(r[1]) for r in rows] + [1]) // parts) * parts
    ints = [[math.floor(scale * x) for x in v] + [0] * (dim - len(v)) for _, v, _ in rows]
    # floors of the filled up vectors; equal ids by vector, as they come from the table
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))
    w = dim // parts
    cut = [[x[p * w : (p + 1) * w] for p in range(parts)] for x in ints]
    books = [[cut[i][p] for i in order[:entries]] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for x in cut:
                own.setdefault(near(x[p], books[p])[1], []).append(x[p])
            books[p] = [[sum(col) // len(own[k]) for col in zip(*own[k])] if k in own else c for k, c in enumerate(books[p])]
    done = [[near(x[p], books[p]) for p in range(parts)] for x in cut]
    errors = [sum(d for d, _ in x) for x in done]
    label = {}
    for r, e in zip(rows, errors):
        label[r[2]] = label.get(r[2], 0) + e
    sha = hashlib.sha256(",".join(str(v) for book in books for c in book for v in c).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{k:02x}" for _, k in x), e, label[r[2]], sha) for r, x, e in zip(rows, done, errors)), key=str)


def codes(df, **settings):
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in annular.compressed(df, **settings).collect()), key=str)


@pytest.mark.parametrize(("dim", "n"), [(16, 260), (32, 300), (7, 90), (20, 30)])
def test_codes_of_odd_vectors(spark, dim, n):
    rows = odd_rows(dim, n)
    assert codes(frame(spark, rows)) == slow_codes(rows)


def test_codes_of_none_few_and_settings(spark):
    assert codes(frame(spark, [])) == [] and codes(frame(spark, [(1, None, 1)])) == []
    for rows in ([(5, [1.0, 2.0], None)], [(1, [], 1), (2, [], 1)], [(i, [float(i % 3)] * 8, i % 2) for i in range(40)]):
        assert codes(frame(spark, rows)) == slow_codes(rows)
    rows = odd_rows(12, 200, 4)
    assert codes(frame(spark, rows), parts=3, entries=20, rounds=3, scale=8) == slow_codes(rows, 3, 20, 3, 8)
    with pytest.raises(OverflowError):
        codes(frame(spark, [(1, [1e30], 1)]))


def test_labels_may_be_hot(spark):
    """A label of most rows is split: the sums stay whole."""
    rows = [(i, [float(i % 11), i % 7 / 3], 1 if i % 10 else None) for i in range(2000)]
    assert codes(frame(spark, rows)) == slow_codes(rows)


@pytest.mark.parametrize("width", [1, 2, 4, 8])
def test_annulus_finds_what_a_full_scan_finds(width):
    g = np.random.default_rng(width)
    for spread in (3, 1000, 10**6):
        book = g.integers(-spread, spread, (64, width))
        book[9] = book[40]
        x = np.concatenate([g.integers(-2 * spread, 2 * spread, (3000, width)), book])
        b = annular.Codebook(book)
        label, best = b.nearest(x)
        full = ((x[:, None] - book[None]) ** 2).sum(2)
        assert (label == full.argmin(1)).all() and (best == full.min(1)).all()
        assert b.compared < 0.97 * full.size


# --- 13 ----------------------------------------------------------------------


def test_primes_and_remainders():
    ps = whitening.primes(10**60)
    assert len(set(ps)) == len(ps) == 10 and all(p < 2**20 and all(p % q for q in range(2, 1025)) for p in ps)
    g = random.Random(1)
    want = [g.randint(-(10**59), 10**59) for _ in range(50)] + [0, 1, -1]
    assert whitening.remaindered([np.array([w % p for w in want]) for p in ps], ps).tolist() == want


def slow_whitening(rows):
    rows = [(i, v) for i, v, *_ in rows if whole(v)]
    dim, n = max([len(v) for _, v in rows] + [1]), len(rows)
    x = [[math.floor(1024 * c) + 100000 for c in [*v, *[0.0] * (dim - len(v))]] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    v = [[sum((n * r[i] - sums[i]) * (n * r[j] - sums[j]) for r in x) / n**3 for j in range(dim)] for i in range(dim)]
    return rows, n, np.array(v), [sum((n * c - s) ** 2 for c, s in zip(r, sums)) for r in x], np.array([[(n * c - s) / n for c, s in zip(r, sums)] for r in x])


def test_whitening_of_odd_vectors(spark):
    rows = odd_rows(12, 200)
    kept, n, v, deviation, centred = slow_whitening(rows)
    got = whitening.whitened(frame(spark, rows)).collect()
    assert len(got) == 8 * len(kept) and {r.n for r in got} == {n} and {r.component for r in got} == set(range(1, 9))
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1], axes[:, ::-1]
    by_row = {}
    for r in got:
        by_row.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r)
    assert sorted(map(str, by_row)) == sorted({str((i, d)) for (i, _), d in zip(kept, deviation)})
    e = np.array([next(r.explained for r in got if r.component == c) for c in range(1, 9)])
    assert np.allclose(e, values[:8] / np.trace(v), rtol=1e-9) and {r.identity_error for r in got}.pop() < 1e-9
    for (i, _), d, x in zip(kept, deviation, centred):
        mine = np.array([by_row[i, d][c][0].whitened for c in range(1, 9)])
        assert np.allclose(np.abs(mine), np.abs(x @ axes[:, :8] / np.sqrt(values[:8])), atol=1e-7)
    assert all(r.deviation == int(r.deviation_exact) for r in got)


def test_scatter_is_exact(spark):
    """Sums that neither longs nor doubles can hold, of components of either sign."""
    g = random.Random(2)
    rows = [[g.uniform(-1, 1) * 2.0 ** g.choice([0, 20, 38]) for _ in range(5)] for _ in range(300)]
    df = vectors.kept(spark.createDataFrame([(v,) for v in rows], "embedding array<double>").repartition(5), "embedding")
    n, dim, most = vectors.shape(df)
    x = [[1] + [math.floor(1024 * c) - 7 for c in v] for v in rows]
    got = whitening.scatter(df, dim, int(1024 * most) + 8, n, 1024, -7)
    assert got.tolist() == [[sum(r[i] * r[j] for r in x) for j in range(6)] for i in range(6)]


def test_whitening_without_variance_and_rows(spark):
    assert whitening.whitened(frame(spark, [])).collect() == [] == whitening.whitened(frame(spark, [(1, None, 1)])).collect()
    flat = whitening.whitened(frame(spark, [(i, [1.0, 2.0], 1) for i in range(5)])).collect()
    assert len(flat) == 10 and {(r.deviation, r.whitened, r.explained, r.identity_error) for r in flat} == {(0, 0.0, 0.0, 0.0)}
    line = whitening.whitened(frame(spark, [(i, [float(i), 2.0 * i, 1.0], 1) for i in range(9)])).collect()
    assert {r.component for r in line} == {1, 2, 3} and {r.whitened for r in line if r.component > 1} == {0.0} and line[0].identity_error < 1e-9
    wide = whitening.whitened(frame(spark, [(i, [i * 2.0**36, 1.0], 1) for i in range(4)])).collect()
    assert all(r.deviation is None and r.deviation_exact > 2**63 for r in wide)
    with pytest.raises(OverflowError):
        whitening.whitened(frame(spark, [(1, [2.0**43], 1)]))
