"""MinHash near-dedup with bottom-k sketches of one hash function (operator 7).

Every document is the set of its word shingles, hashed once to 64 bits. Sets
that are equal are folded to one representative. A sketch keeps the KEEP
smallest hashes; inverted lists over runs of RUN neighbouring retained values
bring together documents whose sketches overlap. (Of two sets with a similarity
of 0.85, the KEEP smallest hashes of the union hold such a run but for odds of
about 1e-13, at 0.8 of about 1e-10; where sketches hold the whole sets there
always is one, or one of two values if a set has no more than FEW, which are
listed as well. The similarity asked for is to be 0.8 or more.) Pairs
of compatible sizes pass if the estimate from the sketch of the union is near
enough, and are confirmed by the exact Jaccard similarity of their full sets.

Lists of more than PAIRED members are never turned into pairs of rows. Their
members are first compared with the list's representative, the member of most long
lists, as that has many runs in common with others (each member in the FIRST of its
lists only). What that links counts as one; only lists whose members are still apart go on. Documents of one group have most of their lists in common: such lists are put
together where their union has fewer pairs to compare than they have one by one, which
is found from the lists, long ones by a draw of their members. Then
the members outside the largest part of a list are compared with all of it, in
blocks of about BLOCK by BLOCK, first by sketch, and those with a partner by full
sets, of which a spanning forest of each block's links leaves the task. So work grows
with the members apart times the list, and every pair of a list that is not joined
otherwise is compared (a pair in several lists at least in that of its smallest run).
A list too long for one task (an estimate from a draw of the documents; it decides on
the way, not on the result) is dealt to several; joins split hot keys.

Cases: null or empty texts have empty sets, link with nothing and are kept;
rows without a doc_id link with nothing, have no component and are kept; rows
with one doc_id are one document to others; repeated rows give equal rows; extra
columns are passed over; texts of any length count whole; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Packer, RangeHash, buckets, buffers, by_bucket, byte_codes, hot_keys, lower_ascii, mix, runs, salted_join, slices, table, unpack, words, written
from .components import components

KEEP, RUN, FEW, FIRST, PAIRED, BLOCK, SLACK, SIGMAS, DRAW, TURNS, DRAWN = 64, 3, 6, 3, 16, 512, 0.28, 6.5, 16, 8, 4096
_A, _B, _C = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)

_POST = np.dtype([("key", "<u8"), ("node", "<i8"), ("n", "<i4"), ("low", "u1"), ("part", "u1")])


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Per text, the sorted distinct hashes of its shingles of `size` words (fewer words: the whole sequence is one)."""
    low = lower_ascii(data)
    starts, ends, cut = words(low, offsets)
    w = RangeHash(byte_codes(low)).of(starts, ends)
    roll = RangeHash(w)
    many = roll.sliding(size)
    out = []
    for i, j in zip(cut.tolist(), cut[1:].tolist()):
        if j - i >= size:
            s = np.sort(many[i : j - size + 1])
            out.append(s[np.r_[True, s[1:] != s[:-1]]])
        elif j > i:
            out.append(roll.of(np.array([i]), np.array([j])) ^ _A)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def each_text(batch: pa.RecordBatch, column: int, size: int) -> list[np.ndarray]:
    data, offsets = buffers(batch.column(column))
    return [s for i, j in slices(offsets) for s in shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], size)]


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n (set size), sig1 and sig2 (128 bits of the set), sketch (the upper halves of its smallest hashes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 2048):
                part = batch.slice(at, 2048)
                sets = each_text(part, 1, size)
                one = [int(mix(s).sum(dtype=np.uint64).view(np.int64)) for s in sets]
                two = [int((mix(s ^ _B) * _C).sum(dtype=np.uint64).view(np.int64)) for s in sets]
                sk = [(s[:KEEP] >> np.uint64(32)).astype(np.uint32).tobytes() for s in sets]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(sk, pa.binary())], ["doc_id", "n", "sig1", "sig2", "sketch"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, "doc_id long, n long, sig1 long, sig2 long, sketch binary")


def _compatible(a, b, percent: int):
    return 100 * np.minimum(a, b) >= percent * np.maximum(a, b)


def _runs_of(sketches_: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of each sketch the keys of its runs, and the number of its row."""
    sk = [np.frombuffer(x, np.uint32).astype(np.uint64) for x in sketches_.to_pylist()]
    if not sk:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    flat, sizes = np.concatenate(sk), np.array([len(x) for x in sk])
    own = np.repeat(np.arange(len(sk)), sizes)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    ok = np.flatnonzero(at + RUN <= sizes[own])
    pair = np.flatnonzero((at + 2 <= sizes[own]) & (sizes[own] <= FEW))
    triples = mix(mix(mix(flat[ok] + _A) + flat[ok + 1]) + flat[ok + 2]) if len(ok) else np.zeros(0, np.uint64)
    pairs = mix(mix(flat[pair] + _B) + flat[pair + 1]) if len(pair) else np.zeros(0, np.uint64)
    return np.concatenate([triples, pairs]), own[np.r_[ok, pair]]


def long_runs(reps: DataFrame, parts: int) -> tuple[np.ndarray, int]:
    """Keys of lists with more postings than a bucket has on average, by a draw of one document in DRAW; at most `parts` of them."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_runs_of(batch.column(0))[0].view(np.int64))], ["key"])

    drawn = reps.filter(F.pmod(F.xxhash64("node", F.lit(7)), F.lit(DRAW)) == 0).select("sketch").mapInArrow(keys, "key long").groupBy("key").count()
    total, most = drawn.agg(F.sum("count"), F.max("count")).first()
    if not total or most * parts <= total or most <= PAIRED:
        return np.zeros(0, np.uint64), 1
    hot = drawn.filter(F.col("count") * parts > int(total)).filter(F.col("count") > PAIRED).select("key")
    return np.sort(np.array([r.key for r in hot.collect()], np.int64).view(np.uint64)), min(255, -(-int(most) * parts // int(total)))


def listed(reps: DataFrame, percent: int) -> DataFrame:
    """Members of the inverted lists: (key, node, m = 2), a pair of a short one; (key, node, m = 0 or 1), a member of a long one,
    1 for each set in the few of its runs that are lowest by hash."""
    n_buckets = buckets(reps.sparkSession)
    hot, split = long_runs(reps, n_buckets)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = Packer(_POST, n_buckets)
        for batch in batches:
            nodes, ns = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            keys, own = _runs_of(batch.column(2))
            if not len(keys):
                continue
            rows = np.zeros(len(keys), _POST)
            rows["key"], rows["node"], rows["n"] = keys, nodes[own], ns[own]
            order = np.lexsort((keys, own))
            first, last = runs(own[order])
            rows["low"][order] = np.arange(len(order)) - np.repeat(first, last - first) < FIRST
            if len(hot):
                at = np.minimum(np.searchsorted(hot, keys), len(hot) - 1)
                rows["part"] = np.where(hot[at] == keys, 1 + mix(rows["node"].view(np.uint64)) % np.uint64(split), 0)
            yield from pack.add(rows, rows["key"] + mix(rows["part"].astype(np.uint64)) * (rows["part"] > 0))
        yield from pack.flush()

    def lists(blobs):
        rows = unpack(blobs, _POST)
        rows = rows[np.lexsort((rows["node"], rows["part"], rows["key"]))]
        at, end = runs(rows["key"], rows["part"])
        count = end - at
        count[rows["part"][at] > 0] = PAIRED + 1
        a, b = [], []
        for m in range(2, PAIRED + 1):
            i = at[count == m]
            for x in range(m):
                for y in range(x + 1, m):
                    ok = i[_compatible(rows["n"][i + x].astype(np.int64), rows["n"][i + y].astype(np.int64), percent) & (rows["node"][i + x] != rows["node"][i + y])]
                    a.append(rows["node"][ok + x])
                    b.append(rows["node"][ok + y])
        pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], 1), axis=0) if a else np.zeros((0, 2), np.int64)
        own = rows[np.repeat(count > PAIRED, end - at)]
        return pd.DataFrame({"key": np.r_[pairs[:, 0], own["key"].view(np.int64)], "node": np.r_[pairs[:, 1], own["node"]], "m": np.r_[np.full(len(pairs), 2), own["low"]].astype(np.int64)})

    return by_bucket(reps.select("node", "n", "sketch").mapInArrow(post, Packer.SCHEMA), lists, "key long, node long, m long")


def spread(rows: DataFrame) -> DataFrame:
    """key, m, o (members, and those outside the largest component), major (that component) of the lists of more than one component."""
    parts = rows.groupBy("key", "component").agg(F.count("*").alias("c"))
    lists = parts.groupBy("key").agg(F.sum("c").alias("m"), F.max("c").alias("c"), F.max_by("component", F.struct("c", "component")).alias("major")).filter("m > c")
    return lists.select("key", "m", (F.col("m") - F.col("c")).alias("o"), "major")


def drawn_lists(rows: DataFrame, hot: DataFrame | None) -> DataFrame:
    """key, m, o, rate, and h, nodes, components of the members, of the lists of more than one component; of one with over DRAWN members of a draw.

    Rates are powers of two and nodes are drawn by one hash, so of two draws the thinner one is in both. Those of hot keys are
    thinned before they are collected.
    """
    classes, h = {}, F.xxhash64("node", F.lit(11))
    if hot:
        piece = rows.count() // int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        for r in hot.collect():
            classes.setdefault(1 << (r["__pieces"] * piece // DRAWN).bit_length(), []).append(r["key"])
    thinned = F.coalesce(*[F.when(F.col("key").isin(keys), F.lit(n)) for n, keys in classes.items()], F.lit(1))
    members = rows.filter(F.pmod(h, thinned) == 0).groupBy("key").agg(F.collect_list(F.struct(h.alias("h"), "node", "component")).alias("s"))
    m = F.col("m").cast("double")
    lists = spread(rows).join(members, "key", "left").withColumn("rate", F.greatest(thinned, F.pow(F.lit(2.0), F.ceil(F.log2(m / DRAWN)))).cast("long"))
    drawn = F.filter(F.coalesce("s", F.array()), lambda x: F.pmod(x["h"], F.col("rate")) == 0)
    return lists.withColumn("s", drawn).select("key", m.alias("m"), F.col("o").cast("double").alias("o"), "rate", F.col("s.h").alias("h"), F.col("s.node").alias("nodes"), F.col("s.component").alias("components"))


def _put_together(f: pd.DataFrame) -> pd.DataFrame:
    """Lists with one head: under the smallest of their keys, if their union has no more pairs to compare than they have."""
    f = f.drop(columns="head").assign(into=f["key"])
    if len(f) == 1:
        return f
    rate, into = int(f["rate"].max()), f["key"].min()
    h, nodes, parts = (np.concatenate(f[c].to_list()) for c in ("h", "nodes", "components"))
    at = np.flatnonzero(h % rate == 0)
    at = at[np.unique(nodes[at], return_index=True)[1]]
    counts = np.unique(parts[at], return_counts=True)[1]
    m, o = float(rate * len(at)), float(rate * (len(at) - counts.max(initial=0)))
    if m * o > (f["m"] * f["o"]).sum():
        return f
    while len(at) > DRAWN:
        rate, at = 2 * rate, at[h[at] % (2 * rate) == 0]
    only = lambda x: [x[at] if k == into else None for k in f["key"]]
    return pd.DataFrame({"key": f["key"], "m": m, "o": o, "rate": rate, "h": only(h), "nodes": only(nodes), "components": only(parts), "into": into})


def together(rows: DataFrame) -> DataFrame:
    """rows(key, node, component), written, with lists that have most members in common as one list under the smallest of their keys.

    Lists with the same first member by a hash, another one each turn, are put together if their union has no more pairs to compare
    than they have. Two members of a list stay in a list; lists of one component go. A turn that saves little is the last. What is put
    together is found from the lists (at most as many of a turn have one head as runs are in its sketch); the rows are joined once.
    """
    hot = hot_keys(rows, ["key"])
    lists, under = written(drawn_lists(rows, hot), "near-heads"), None
    if not lists.limit(1).count():
        return rows.limit(0)
    for turn in range(TURNS):
        head = F.array_min(F.transform("nodes", lambda x: F.struct(F.xxhash64(x, F.lit(turn)).alias("by"), x.alias("node"))))["node"]  # noqa: B023
        put = written(
            lists.withColumn("head", F.coalesce(head, "key")).groupBy("head").applyInPandas(_put_together, "key long, m double, o double, rate long, h array<long>, nodes array<long>, components array<long>, into long"), "near-together"
        )
        to = put.select("key", "into")
        under = to if under is None else under.select(F.col("key").alias("list"), F.col("into").alias("key")).join(to, "key").select(F.col("list").alias("key"), "into")
        pairs = F.sum(F.col("m") * F.col("o"))
        total, left = lists.agg(pairs).first()[0], (lists := put.filter("key = into").drop("into")).agg(pairs).first()[0]
        if 20 * (total - left) <= total:
            break
    joined = salted_join(rows, under, ["key"], ["node"], hot=hot) if hot else rows.join(under, "key")
    return written(joined.select(F.col("into").alias("key"), "node", "component").distinct(), "near-parts")


def apart(long: DataFrame, known: DataFrame, merge: bool = False) -> DataFrame:
    """key, node, component, minor (outside the largest component of its list), m, o (members, and those outside) of the lists
    whose members are not all linked by known(node, component); merge: of such lists put together."""
    rows = long.select("key", "node").distinct().join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    rows = written(rows, "near-parts")
    rows = together(rows) if merge else rows
    return salted_join(rows, spread(rows), ["key"], ["node"]).withColumn("minor", F.col("component") != F.col("major"))


def in_blocks(rows: DataFrame) -> DataFrame:
    """Deals rows(key, node, minor, m, o, ...) to blocks (key, i, j) so that any two members of a list of which one is minor meet in one.

    rows, of which a document has no more than runs in its sketch, are written: both sides read them, and what they come from is joined once.
    """
    rows = written(rows, "near-members")
    many, few = F.ceil(F.col("m") / BLOCK).cast("int"), F.ceil(F.col("o") / BLOCK).cast("int")
    own = lambda wide: F.pmod(F.xxhash64("node"), wide).cast("int")
    right = rows.withColumn("i", F.explode(F.sequence(F.lit(0), few - 1))).withColumn("j", own(many))
    left = rows.filter("minor").withColumn("j", F.explode(F.sequence(F.lit(0), many - 1))).withColumn("i", own(few))
    return left.select(right.columns).unionByName(right)


def shared(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, as the product of the incidence matrix with itself, a slab of values at a time."""
    m = len(sets)
    if not any(len(s) for s in sets):
        return np.zeros((m, m), np.float32)
    flat, own = np.concatenate(sets), np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, own = flat[order], own[order]
    at, end = runs(flat)
    many = end - at > 1  # a value of one set meets nothing
    value = np.repeat(np.cumsum(many) - 1, end - at)
    keep = np.repeat(many, end - at)
    own, value = own[keep], value[keep]
    out = np.zeros((m, m), np.float32)
    top = int(many.sum())
    for a in range(0, top, 2048):
        i, j = np.searchsorted(value, [a, a + 2048])
        x = np.zeros((min(2048, top - a), m), np.float32)
        x[value[i:j] - a, own[i:j]] = 1
        out += x.T @ x
    return out


def forest(links: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric boolean matrix."""
    left, out = np.ones(len(links), bool), []
    while left.any():
        todo = [int(np.flatnonzero(left)[0])]
        left[todo[0]] = False
        while todo:
            x = todo.pop()
            new = np.flatnonzero(links[x] & left)
            left[new] = False
            out += [(x, int(y)) for y in new]
            todo += new.tolist()
    return out


def _estimated(percent: int):
    """Passes pairs whose sizes are compatible and whose estimate from the sketch of the union is near enough."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            ok = []
            for x, y in zip(f["x"], f["y"]):
                x, y = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
                union = np.union1d(x, y)[:KEEP]
                both = np.intersect1d(np.intersect1d(x, y, True), union, True)
                ok.append(len(both) >= (percent / 100 - SLACK) * len(union))
            yield f.loc[np.array(ok, bool), ["a", "b"]]

    return run


def _confirmed(percent: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            ok = []
            for x, y in zip(f["x"], f["y"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both) and both > 0)
            yield f.loc[np.array(ok, bool), ["a", "b"]]

    return run


def near_links(docs: DataFrame, size: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Sketches of all documents (doc_id, n, sig1, sig2), and (node, component) of the representatives that are linked by
    100 |A and B| >= percent |A or B|."""
    all_docs = written(sketches(docs, size), "near-sketches")
    reps = all_docs.filter("n > 0 and doc_id is not null").groupBy("n", "sig1", "sig2").agg(F.min("doc_id").alias("node"), F.min("sketch").alias("sketch"))
    reps = written(reps.select("node", "n", "sketch"), "near-reps")
    lists = written(listed(reps, percent), "near-lists")
    text = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([s.tobytes() for s in each_text(part, 1, size)], pa.binary())], ["node", "shingles"])

    def sets_of(nodes: DataFrame, name: str) -> DataFrame:
        return written(text.join(nodes.hint("shuffle_hash"), "doc_id").mapInArrow(full, "node long, shingles binary"), name)

    # Short lists: their pairs. Long lists: each member in its lowest runs with the list's representative.
    long = lists.filter("m < 2")
    first = long.filter("m = 1").select("key", "node")
    central = long.withColumn("lists", F.count("*").over(Window.partitionBy("node")))
    heads = central.groupBy("key").agg(F.max("m").alias("m"), F.min_by("node", F.struct(-F.col("lists"), F.xxhash64("node"))).alias("a")).filter("m = 1").drop("m")
    starred = salted_join(first, heads, ["key"], ["node"]).select("a", F.col("node").alias("b")).filter("a <> b")
    pairs = written(lists.filter("m = 2").select(F.col("key").alias("a"), F.col("node").alias("b")).unionByName(starred).distinct(), "near-pairs")
    # Only a, the representative, can be hot: b is in few lists.
    x = reps.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("x"))
    y = reps.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("y"))
    near = salted_join(pairs, x, ["a"], ["b"]).join(y, "b").filter(f"100 * least(na, nb) >= {percent} * greatest(na, nb)").select("a", "b", "x", "y")
    near = written(near.mapInPandas(_estimated(percent), "a long, b long"), "near-estimated")
    sets = sets_of(near.select(F.col("a").alias("doc_id")).union(near.select("b")).distinct(), "near-sets")
    x, y = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    links = written(salted_join(near, x, ["a"], ["b"]).join(y, "b").select("a", "b", "x", "y").mapInPandas(_confirmed(percent), "a long, b long"), "near-links")
    known = components(links)
    left = written(apart(long, known, True), "near-apart")
    if not left.limit(1).count():
        return all_docs, known

    # By sketch: members with a partner in another component of the list.
    def partnered(f: pd.DataFrame) -> pd.DataFrame:
        f = f.drop_duplicates("node").sort_values("node")
        sk, n, nodes, part = [np.frombuffer(x, np.uint32) for x in f["sketch"]], f["n"].to_numpy(), f["node"].to_numpy(), f["component"].to_numpy()
        size, key = np.array([len(s) for s in sk]), f["key"].iloc[:1].to_numpy(np.int64)
        both, low, high = shared(sk), np.minimum(n[:, None], n[None]), np.maximum(n[:, None], n[None])
        # Of similar sets, each of the values that the larger one keeps is in both with odds of at least `rate`.
        rate = percent / 100 * (1 + low / high) / (1 + percent / 100)
        enough = (rate - SIGMAS * np.sqrt(np.maximum(rate * (1 - rate), 0) / KEEP)) * np.minimum(size[:, None], size[None])
        links = (both >= enough) & (both > 0) & _compatible(n[:, None], n[None], percent) & (part[:, None] != part[None])
        if links.any():  # pairs with a run in common that is smaller than all of the list's are compared there
            keys, at = _runs_of(pa.array(f["sketch"]))
            keys, at = keys[keys.view(np.int64) < key[0]], at[keys.view(np.int64) < key[0]]
            order = np.argsort(at, kind="stable")
            links &= shared(np.split(keys[order], np.searchsorted(at[order], np.arange(1, len(sk))))) == 0
        some = np.flatnonzero(links.any(1))
        return pd.DataFrame({"key": np.repeat(key, len(some)), "node": nodes[some]})

    blocks = in_blocks(left.select("key", "node", "component", "minor", "m", "o").join(reps, "node"))
    found = written(blocks.groupBy("key", "i", "j").applyInPandas(partnered, "key long, node long"), "near-partnered")
    left = written(apart(found, known), "near-apart")
    if not left.limit(1).count():
        return all_docs, known

    def spanned(f: pd.DataFrame) -> pd.DataFrame:
        f = f.drop_duplicates("node")
        own = [np.frombuffer(x, np.uint64) for x in f["shingles"]]
        nodes, n = f["node"].to_numpy(), np.array([len(s) for s in own])
        both = shared(own).astype(np.int64)
        ok = (100 * both >= percent * (n[:, None] + n[None] - both)) & (both > 0)
        np.fill_diagonal(ok, False)
        edges = forest(ok)
        return pd.DataFrame({"a": [nodes[x] for x, _ in edges], "b": [nodes[y] for _, y in edges]}, dtype=np.int64)

    sets = sets_of(left.select(F.col("node").alias("doc_id")).distinct(), "near-left-sets")
    dense = in_blocks(left.select("key", "node", "minor", "m", "o").join(sets, "node")).groupBy("key", "i", "j").applyInPandas(spanned, "a long, b long")
    return all_docs, components(written(links.unionByName(dense).distinct(), "near-links"))


def groups(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs."""
    all_docs, known = near_links(docs, size, percent)
    there = all_docs.filter("n > 0 and doc_id is not null")
    n, distinct = there.agg(F.count("*"), F.count_distinct("doc_id")).first()
    if n != distinct:  # texts that share a doc_id are one document
        first = there.groupBy("n", "sig1", "sig2").agg(F.min("doc_id").alias("b"))
        shared_ids = there.groupBy("doc_id").agg(F.count("*").alias("_n")).filter("_n > 1").select("doc_id")
        same = salted_join(there.join(shared_ids, "doc_id"), first, ["n", "sig1", "sig2"], ["doc_id"]).select(F.col("doc_id").alias("a"), "b").filter("a <> b")
        known = components(known.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(same))
    small = known.withColumnRenamed("node", "rep")
    rep = all_docs.filter("n > 0 and doc_id is not null").groupBy("n", "sig1", "sig2").agg(F.min("doc_id").alias("rep")).join(small, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    out = salted_join(all_docs.select("doc_id", "n", "sig1", "sig2"), rep, ["n", "sig1", "sig2"], ["doc_id"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def op7_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "documents"), 3, 85)
