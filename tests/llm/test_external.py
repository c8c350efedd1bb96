"""Induced sorting on disk, and windows that repeat, against brute force."""

from collections import Counter

import numpy as np
import pytest

from corpusloom.llm import common, induced, neardup, repeats, suffix_dedup

from test_queries import docs, in_order, near_groups, windows_gone
from test_queries import test_suffix as suffix_query


def sorted_slowly(t):
    order = sorted(range(len(t)), key=lambda i: t[i:])
    prefix = [0]
    for a, b in zip(order, order[1:]):
        k = 0
        while max(a, b) + k < len(t) and t[a + k] == t[b + k]:
            k += 1
        prefix.append(k)
    return order, prefix


@pytest.mark.parametrize("memory", [0, 3000, 1 << 20])
@pytest.mark.parametrize("symbols", [3, 1024])
def test_suffix_order(monkeypatch, memory, symbols):
    """Any alphabet, with recursion down to single names, by digits or not."""
    monkeypatch.setattr(induced, "SYMBOLS", symbols)
    rng = np.random.default_rng(memory + symbols)
    for k in range(120):
        t = rng.integers(0, int(rng.choice([1, 2, 3, 6, 60, 3000])), int(rng.integers(1, 150)))
        t = np.concatenate([np.tile(t[: max(1, len(t) // 5)], 6), t[:3]]) if k % 3 == 0 else t
        order, prefix = induced.suffix_order(t, scratch=induced.Scratch(memory))
        assert (order.tolist(), prefix.tolist()) == sorted_slowly(t.tolist())


def fragments_with_copies(rng, n):
    """Byte strings of which many share passages of 30 to 700 bytes, runs of one byte among them."""
    base = rng.integers(97, 123, 6000).astype(np.uint8)
    base[1000:1700] = 97
    out = []
    for _ in range(n):
        parts = [rng.integers(97, 123, int(rng.integers(0, 60))).astype(np.uint8)]
        for _ in range(int(rng.integers(0, 3))):
            a = int(rng.integers(0, 5000))
            parts += [base[a : a + int(rng.integers(30, 700))], rng.integers(97, 123, int(rng.integers(0, 40))).astype(np.uint8)]
        out.append(np.concatenate(parts))
    return out


@pytest.mark.parametrize("window", [100, 300])
def test_blocks_larger_than_memory(window):
    """Memory of a fiftieth of the block: all long arrays go to files, and the windows are those that brute force finds."""
    frags = fragments_with_copies(np.random.default_rng(window), 400)
    values, sizes = np.concatenate(frags), np.array([len(f) for f in frags])
    scratch = induced.Scratch(len(values) // 50)
    got = np.concatenate(list(suffix_dedup.repeated(values, sizes, window, scratch)))
    want, seen, at = [], set(), 0
    for f in frags:
        b = f.tobytes()
        for i in range(len(b) - window + 1):
            if b[i : i + window] in seen:
                want.append(at + i)
            seen.add(b[i : i + window])
        at += len(b)
    assert got.tolist() == want and len(want) > 1000
    assert scratch.spilled > 10 * len(values)


def test_spool():
    scratch = induced.Scratch(1000)
    spool = induced.Spool(scratch)
    data = [bytes([i % 256]) * (i % 7 * 8) for i in range(300)]
    for d in data:
        spool.add(d)
    assert spool.all(np.uint8).tobytes() == b"".join(data) and scratch.spilled > 0


@pytest.mark.parametrize("which", ["odd", "repeated"])
def test_query_with_little_memory(spark, request, which, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK_MEMORY", 2000)
    suffix_query(spark, request, which)


@pytest.mark.parametrize("window", [100, 300, 1000])
def test_other_windows(spark, odd, window):
    unit = repeats.Unit(window=window, gram=32, words=False, most=1 << 30)
    rows = in_order(docs(spark, odd))
    seqs = [(r[0], (r[1] or "").encode()) for r in rows]
    want = {i: sum(g) for (i, _), g in zip(seqs, windows_gone(seqs, window))}
    got = {r.doc_id: int(np.diff(np.frombuffer(r.ranges or b"", np.uint32).reshape(-1, 2), axis=1).sum()) for r in suffix_dedup.spans(spark.read.parquet(f"{odd}/documents.parquet"), unit).collect()}
    assert got == want and (window > 300 or sum(want.values()) > 0)


def test_blocks_are_worked_off_by_whole_anchors():
    """A block of 24 MB goes to the sort in parts of at most `most`, but for an anchor that has more by itself."""
    head = np.zeros(200_000, repeats.HEAD)
    head["by"], head["n"] = np.sort(np.random.default_rng(1).integers(0, 50_000, len(head))), 120
    head["by"][60_000:90_000] = head["by"][60_000]  # 3.6 MB
    most = suffix_dedup.BYTES.most
    parts = list(repeats.anchors_at_once(head, most))
    assert [i for i, _ in parts] == [0, *[j for _, j in parts[:-1]]] and parts[-1][1] == len(head) and 12 <= len(parts) <= 14
    assert all(head["by"][j - 1] != head["by"][j] for _, j in parts[:-1])
    assert all(int(head["n"][i:j].sum(dtype=np.int64)) <= most or len(set(head["by"][i:j])) == 1 for i, j in parts)
    assert list(repeats.anchors_at_once(head[:0], most)) == [] and list(repeats.anchors_at_once(head[:3], 1))[-1][1] == 3


def test_copies_of_a_crowded_window_go_without_contents(spark, monkeypatch, tmp_path):
    """A line in 300 texts that differ around it: its windows are given to the method a few times, not 300 times."""
    monkeypatch.setattr(repeats, "CROWD", 20)
    rng = np.random.default_rng(3)
    letters = lambda n: rng.integers(97, 123, n).astype(np.uint8).tobytes()
    line = letters(160)
    texts = [letters(150) + line + letters(150) for _ in range(300)]

    def noted(values, sizes, window, scratch):
        with open(tmp_path / "given", "a") as f:
            f.writelines(f"{values[e - n : e].tobytes().decode()}\n" for n, e in zip(sizes, np.cumsum(sizes)))
        yield from suffix_dedup.repeated(values, sizes, window, scratch)

    rows = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(texts)], "key long, text string").repartition(2)
    got = {r.key: np.frombuffer(r.ranges, np.uint32).reshape(-1, 2).tolist() for r in repeats.covered(rows, suffix_dedup.BYTES, noted).collect()}
    gone = windows_gone(list(enumerate(texts)), 100)
    assert all(sum(b - a for a, b in got.get(i, [])) == sum(g) for i, g in enumerate(gone)) and sum(map(sum, gone)) >= 299 * 160
    given = Counter((tmp_path / "given").read_text().split())
    inside = {w: n for w, n in given.items() if len(w) == 100 and w.encode() in line}
    assert inside and max(inside.values()) <= 8


@pytest.mark.parametrize("which", ["odd", "repeated"])
def test_texts_are_shuffled_once(spark, request, which):
    """Fetching contents and the join with the ranges read one shuffle of the texts."""
    start = spark.read.parquet(f"{request.getfixturevalue(which)}/documents.parquet")
    for df in (suffix_dedup.spans(start).select("doc_id", "text", "ranges"), suffix_dedup.deduplicated(start)):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
        assert plan.count("ReusedExchange") == 1


def test_members_of_lists_are_joined_once(spark):
    """Dealing members to blocks reads what their join made, and makes the join not again for either side."""
    members = spark.range(1200).selectExpr("id % 2 key", "id node", "id % 3 = 0 minor", "600L m", "200L o")
    blocks = neardup.in_blocks(members.join(spark.range(1200).selectExpr("id node", "id n").hint("merge"), "node"))
    assert "Join" not in blocks._jdf.queryExecution().optimizedPlan().toString()
    dealt = blocks.groupBy("key", "node").agg({"*": "count"}).collect()
    assert len(dealt) == 1200 and {(r.node % 3 == 0, r[2]) for r in dealt} == {(True, 3), (False, 1)}


def test_lists_with_the_same_members_are_dealt_to_blocks_once(spark, monkeypatch):
    """400 copies of a text with few changes each, of which most stay apart: about the pairs of the group are compared, not those of each list."""
    monkeypatch.setattr(neardup, "BLOCK", 64)
    dealt, in_blocks = [], neardup.in_blocks

    def counted(rows):
        blocks = in_blocks(rows)
        dealt.append(blocks.count())
        return blocks

    monkeypatch.setattr(neardup, "in_blocks", counted)
    rng = np.random.default_rng(9)
    base, texts = [f"w{i}" for i in range(120)], []
    for i in range(400):
        words = list(base)
        for x in rng.choice(120, int(rng.integers(1, 5)), replace=False):
            words[x] = f"x{i}.{x}"
        texts.append((i, " ".join(words)))
    got = {r.doc_id: r.component_id for r in neardup.groups(spark.createDataFrame(texts, "doc_id long, text string"), 5, 80).collect()}
    assert got == near_groups(texts, 5, 80) and 100 < len(set(got.values())) < 400
    assert dealt and dealt[0] <= 4 * 2 * 400 * 7  # both sides of all pairs in blocks of 64, four times


def test_lists_put_together_lose_no_pair(spark):
    """Two members of a list of several components are in one list after; the pairs to compare are no more, and not of lists that have little in common."""
    rng = np.random.default_rng(2)
    lists = {k: rng.choice(60, 45, replace=False) + 60 * (k % 2) for k in range(-20, 20)} | {100 + k: [1, *range(1000 + 30 * k, 1030 + 30 * k)] for k in range(6)} | {300: [7, 8], 301: [2000, 2001]}
    component = {2001: 2000} | {i: i - i % 3 for i in range(30)}
    rows = spark.createDataFrame([(k, int(x), int(component.get(int(x), x))) for k, xs in lists.items() for x in xs], "key long, node long, component long")
    after = {}
    for r in neardup.together(neardup.written(rows, "t")).collect():
        after.setdefault(r.key, set()).add(r.node)
    for xs in lists.values():
        if len({component.get(int(x), int(x)) for x in xs}) > 1:
            assert any(set(map(int, xs)) <= s for s in after.values())
    assert sum(len(after.get(100 + k, ())) == 31 for k in range(6)) == 6
    assert len([k for k in after if k < 100]) < 10 and sum(len(s) ** 2 for s in after.values()) < sum(len(xs) ** 2 for xs in lists.values()) / 2


def test_members_of_lists_put_together_are_joined_once(spark, monkeypatch):
    """Turns look at lists; the members, hot keys among them, are joined with what their lists became once, not twice a turn."""
    monkeypatch.setattr(common, "HOT_ROWS", 1)
    joined, salted_join = [], neardup.salted_join

    def counted(left, right, *args, **more):
        joined.append(left.count())
        return salted_join(left, right, *args, **more)

    monkeypatch.setattr(neardup, "salted_join", counted)
    rows = spark.createDataFrame([(k, i, i - i % 2) for k in range(3) for i in range(60) if i % 20 != k], "key long, node long, component long")
    got = neardup.together(neardup.written(rows, "t")).collect()
    assert joined == [171] and {r.key for r in got} == {0} and sorted(r.node for r in got) == list(range(60))


@pytest.mark.parametrize("hot_rows", [1, 64])
def test_lists_put_together_by_a_draw_lose_no_pair(spark, monkeypatch, hot_rows):
    """Lists of more members than are drawn, hot and other ones: each is in one list after, and those that are alike in one of them."""
    monkeypatch.setattr(common, "HOT_ROWS", hot_rows)
    monkeypatch.setattr(neardup, "DRAWN", 8)
    rng = np.random.default_rng(4)
    lists = {k: rng.choice(80, 60, replace=False) for k in range(12)} | {50: rng.choice(9000, 900, replace=False), 51: [100, 101]}
    rows = spark.createDataFrame([(k, int(x), int(x)) for k, xs in lists.items() for x in xs], "key long, node long, component long")
    after = {}
    for r in neardup.together(neardup.written(rows, "t")).collect():
        after.setdefault(r.key, set()).add(r.node)
    assert all(any(set(map(int, xs)) <= s for s in after.values()) for xs in lists.values())
    assert len(after) < 10


def test_windows_that_are_no_windows():
    with pytest.raises(ValueError, match="windows"):
        repeats.Unit(window=20, gram=32, words=False, most=1)
