"""Toxicity by non-negative positive-unlabelled learning (operator 8).

Positives are texts confirmed toxic; the other class is never named: unlabelled
texts stand in for the mixture, and the risk of a linear numpy classifier is
corrected by the class prior p, with its negative part held at zero or above:
  risk = p E_pos[l(+)] + max(0, E_unl[l(-)] - p E_pos[l(-)]).

Features are the 5-byte grams of the lower-cased text, and its 8-byte grams that
begin with a space, which tell a stem at the start of a word from the same letters
inside another (hashed to 64 bits, counted once a text). Grams of 3 to 8
positives or more (by their number) are marked in a bitmap of a fixed size, and only grams that it
holds are counted in both samples, on the executors; the MOST_FEATURES most telling
ones make the model. The samples are bounded by the documented parameters POSITIVES
and UNLABELLED (expected sizes of a draw by hash); scoring covers every text.

Scores are calibrated: FOLDS models, each with features and weights from the other
folds, score the labelled rows of their own fold (training rows only), and a logistic
curve through these scores makes the last model's scores probabilities of label 1.

Cases: without positives or texts every score is the prior; without labels 0 scores
stay uncalibrated; null and empty texts score from the bias alone; texts of any
length count whole, in slices; several labels of one document count as toxic if any
is; rows without a doc_id get a score too and are not learned from; repeated rows
give equal rows; an empty table gives none; extra columns are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import IS_SPACE, RangeHash, Packer, buckets, buffers, by_bucket, byte_codes, lower_ascii, runs, slices, table, unpack, written

GRAM, STEM, MOST_FEATURES, LEAST_COUNTS, LEAST_SHARE = 5, 8, 4096, (3, 8), 40
POSITIVES, UNLABELLED = 20_000, 40_000
LIFT, CHANCE, PRIOR_GRAMS = 2.0, 3.0, 64
EPOCHS, DECAY, LEAST_DECAY, THRESHOLD = 250, 0.06, 1e-4, 0.3
FOLDS, MARKS = 3, 1 << 24

#: Texts with a gram by fold: positives and unlabelled ones.
_COUNT = np.dtype([("h", "<u8"), ("p", "<u2", (FOLDS,)), ("u", "<u2", (FOLDS,))])


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of every gram that lies in one text: of GRAM bytes anywhere, of STEM bytes from a space on."""
    low = lower_ascii(data)
    rolling, own = RangeHash(byte_codes(low)), np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    docs, hashes = [], []
    for size, at in ((GRAM, np.arange(max(0, len(low) - GRAM + 1))), (STEM, np.flatnonzero(IS_SPACE[low[: max(0, len(low) - STEM + 1)]]))):
        doc = own[at]
        ok = at + size <= offsets[doc + 1]
        docs.append(doc[ok])
        hashes.append(rolling.sliding(size)[at[ok]])
    return np.concatenate(docs), np.concatenate(hashes)


@dataclass
class Model:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float

    def __post_init__(self):
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.features >> np.uint64(44)] = True

    def present(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text and feature numbers, each pair once."""
        doc, h = grams(data, offsets)
        hit = self.maybe[h >> np.uint64(44)]
        doc, h = doc[hit], h[hit]
        if not len(h) or not len(self.features):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.features, h), len(self.features) - 1)
        hit = self.features[at] == h
        pairs = np.unique(doc[hit] * len(self.features) + at[hit])
        return pairs // len(self.features), pairs % len(self.features)

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        doc, f = self.present(data, offsets)
        z = self.bias + np.bincount(doc, self.weights[f], len(offsets) - 1)
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _by_gram(batches: Iterator[pa.RecordBatch], n: int, marked: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Packed counts of the grams of (text, positive, fold), of those that are marked if marks are given."""
    pack = Packer(_COUNT, n)
    for batch in batches:
        data, offsets = buffers(batch.column(0))
        pos, fold = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), bool), batch.column(2).to_numpy(zero_copy_only=False)
        for i, j in slices(offsets):
            doc, h = grams(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            if marked is not None:
                at = h % np.uint64(len(marked) * 8)
                hit = marked[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1 > 0
                doc, h = doc[hit], h[hit]
            order = np.lexsort((doc, h))
            doc, h = doc[order], h[order]
            at, _ = runs(h, doc)
            doc, h = doc[at], h[at]
            at, _ = runs(h)
            rows = np.zeros(len(at), _COUNT)
            rows["h"] = h[at]
            if len(at):
                kind = fold[i:j][doc] + FOLDS * ~pos[i:j][doc]
                for k in range(FOLDS):
                    rows["p"][:, k], rows["u"][:, k] = (np.add.reduceat((kind == x).astype(np.int64), at) for x in (k, k + FOLDS))
            yield from pack.add(rows, rows["h"])
    yield from pack.flush()


def _summed(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows = unpack(blobs, _COUNT)
    rows = rows[np.argsort(rows["h"], kind="stable")]
    at, _ = runs(rows["h"])
    p, u = (np.add.reduceat(rows[k].astype(np.int64), at, axis=0) if len(at) else np.zeros((0, FOLDS), np.int64) for k in ("p", "u"))
    return rows["h"][at], p, u


def marks(sample: DataFrame, least: int, size: int = MARKS) -> np.ndarray:
    """A bitmap of `size` bits (or up to a bucket's less) with the grams of at least `least` positives of sample(text, positive, fold)."""
    import pandas as pd

    n = buckets(sample.sparkSession)
    each = max(8, size // n // 8 * 8)  # a bucket holds the hashes of one remainder by n, and sends the bits of its own

    def bits(blobs):
        h, p, _ = _summed(blobs)
        h = h[p.sum(1) >= least]
        out = np.zeros(each, np.uint8)
        out[(h // np.uint64(n) % np.uint64(each)).astype(np.int64)] = 1
        return pd.DataFrame({"b": [int(h[0] % np.uint64(n))], "bits": [np.packbits(out, bitorder="little").tobytes()]}) if len(h) else pd.DataFrame({"b": np.zeros(0, np.int64), "bits": np.zeros(0, object)})

    packed = sample.filter("positive").select("text", "positive", "fold").mapInArrow(lambda bs: _by_gram(bs, n, None), Packer.SCHEMA)
    whole = np.zeros((each, n), bool)
    for r in by_bucket(packed, bits, "b long, bits binary").toLocalIterator():
        whole[:, r.b] = np.unpackbits(np.frombuffer(r.bits, np.uint8), bitorder="little")[:each]
    return np.packbits(whole.reshape(-1), bitorder="little")


def counted(sample: DataFrame, least: int) -> DataFrame:
    """h, p and u (arrays by fold): in how many positive and unlabelled texts of sample(text, positive, fold) a gram stands."""
    import pandas as pd

    n, sent = buckets(sample.sparkSession), sample.sparkSession.sparkContext.broadcast(marks(sample, least))

    def total(blobs):
        h, p, u = _summed(blobs)
        ok = p.sum(1) >= least
        return pd.DataFrame({"h": h[ok].view(np.int64), "p": list(p[ok]), "u": list(u[ok])})

    packed = sample.select("text", "positive", "fold").mapInArrow(lambda bs: _by_gram(bs, n, sent.value), Packer.SCHEMA)
    return by_bucket(packed, total, "h long, p array<long>, u array<long>")


def pu_risk(z: np.ndarray, positive: np.ndarray, prior: float) -> tuple[float, np.ndarray, bool]:
    """The non-negative risk of the logits z with the logistic loss, the descent direction by logit, and whether its
    negative part is held: the direction then leads back from what was fitted below zero."""
    s = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    n_pos, n_unl = max(1, int(positive.sum())), max(1, int((~positive).sum()))
    as_negative, as_positive = np.logaddexp(0, z), np.logaddexp(0, -z)
    below = as_negative[~positive].sum() / n_unl - prior * as_negative[positive].sum() / n_pos
    g = np.zeros(len(z))
    if below < 0:
        g[positive], g[~positive] = prior * s[positive] / n_pos, -s[~positive] / n_unl
    else:
        g[positive], g[~positive] = -prior / n_pos, s[~positive] / n_unl  # d l(+) - d l(-) of a positive is -1
    return float(prior * as_positive[positive].sum() / n_pos + max(0.0, below)), g, bool(below < 0)


def nonnegative_pu(rows: np.ndarray, cols: np.ndarray, positive: np.ndarray, n_features: int, prior: float, epochs: int = EPOCHS, decay: float = DECAY) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk (Adam, full batch); rows and cols are the places of the ones."""
    w, b = np.zeros(n_features), float(np.log(prior / (1 - prior))) - 1.0
    n, n_pos = len(positive), max(1, int(positive.sum()))
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for t in range(1, epochs + 1):
        g = pu_risk(b + np.bincount(rows, w[cols], n), positive, prior)[1]
        grad = np.append(np.bincount(cols, g[rows], n_features) + max(LEAST_DECAY, decay / n_pos) * w, g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        step = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def logistic_curve(z: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift so that 1 / (1 + exp(-slope z - shift)) is about the share of label 1; (1, 0) if that can't be told."""
    ones = int(label.sum())
    if ones < 5 or len(label) - ones < 5:
        return 1.0, 0.0
    y = np.where(label > 0, (ones + 1) / (ones + 2), 1 / (len(label) - ones + 2))
    x, t = np.stack([np.clip(z, -30, 30), np.ones(len(z))], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ t, -40, 40)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (p - y) + 1e-3 * (t - [1.0, 0.0]))
        t = t - step * min(1.0, 2.0 / max(1e-12, float(np.abs(step).max())))
    return (float(t[0]), float(t[1])) if t[0] > 0.01 else (1.0, 0.0)


def _telling(counts, prior: float, size: tuple[int, int], folds: list[int], least: int) -> tuple[np.ndarray, float]:
    """The features that tell most by their counts in these folds, sorted, and the prior that they bear out."""
    h, p, u = counts[0], counts[1][:, folds].sum(1), counts[2][:, folds].sum(1)
    rate_p, rate_u = (p + 0.5) / (size[0] + 1.0), (u + 0.5) / (size[1] + 1.0)
    telling = p * np.log(rate_p / rate_u)
    ok = np.flatnonzero((p >= least) & (rate_p > LIFT * rate_u) & (telling > CHANCE))
    order = ok[np.lexsort((h[ok], -telling[ok]))][:MOST_FEATURES]
    first = order[:PRIOR_GRAMS]
    # A gram that only toxic texts hold is in the mixture p times as often as in them, so the most telling grams measure p.
    if len(first):
        prior = min(prior, max(0.002, float(((u[first] + 0.5) / max(1, size[1])).sum() / ((p[first] + 0.5) / max(1, size[0])).sum())))
    return np.sort(h[order]), prior


def learned(sample: DataFrame, prior: float, decay: float = DECAY) -> tuple[Model, dict]:
    """Fits the model to sample(text, positive, fold, label), bounded by its maker; and z, label of the labelled rows by models
    that have not seen their folds."""
    sizes = {(r.positive, r.fold): r.n for r in sample.groupBy("positive", "fold").agg(F.count("*").alias("n")).collect()}
    size = lambda folds: tuple(sum(sizes.get((k, f), 0) for f in folds) for k in (True, False))
    every, unseen = list(range(FOLDS)), {"z": np.zeros(0), "label": np.zeros(0)}
    none = Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(prior / (1 - prior))))
    if not all(size(every)):
        return none, unseen
    least = max(LEAST_COUNTS[0], min(LEAST_COUNTS[1], size(every)[0] // LEAST_SHARE))
    # The most telling grams of all folds and of all but one: at most (FOLDS + 1) * MOST_FEATURES come to the driver.
    total, tops = written(counted(sample, least), "toxicity-counts"), None
    for folds in [every, *([f for f in every if f != k] for k in every)]:
        n_pos, n_unl = size(folds)
        p, u = (sum((F.col(c)[f] for f in folds), F.lit(0)) for c in "pu")
        rate_p, rate_u = (p + 0.5) / F.lit(n_pos + 1.0), (u + 0.5) / F.lit(n_unl + 1.0)
        telling = p * (F.log(rate_p) - F.log(rate_u))
        top = total.filter((p >= least) & (rate_p > LIFT * rate_u) & (telling > CHANCE)).orderBy(telling.desc(), "h").limit(MOST_FEATURES)
        tops = top if tops is None else tops.unionByName(top)
    tops = tops.distinct().toPandas()
    if not len(tops):
        return none, unseen
    counts = tops["h"].to_numpy(np.int64).view(np.uint64), np.array(tops["p"].tolist()), np.array(tops["u"].tolist())
    features = np.sort(counts[0])
    blank = Model(features, np.zeros(len(features)), 0.0)

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(0))
            lists: list[bytes] = []
            for i, j in slices(offsets):
                doc, f = blank.present(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                cut = np.searchsorted(doc, np.arange(j - i + 1))
                lists += [f[a:b].astype(np.int16).tobytes() for a, b in zip(cut, cut[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(lists, pa.binary())], ["positive", "fold", "label", "f"])

    got = sample.select("text", "positive", "fold", "label").mapInArrow(sparse, "positive boolean, fold int, label int, f binary").toPandas().sort_values(["positive", "f", "fold"])
    lists = [np.frombuffer(x, np.int16).astype(np.int64) for x in got["f"]]
    rows, cols = np.repeat(np.arange(len(lists)), [len(c) for c in lists]), np.concatenate(lists)
    positive, fold, label = got["positive"].to_numpy(bool), got["fold"].to_numpy(), got["label"].to_numpy(float)

    def fitted(folds: list[int]) -> tuple[np.ndarray, np.ndarray, float]:
        own, p = _telling(counts, prior, size(folds), folds, least)
        place = np.full(len(features), -1)
        place[np.searchsorted(features, own)] = np.arange(len(own))
        seen = np.isin(fold, folds)
        number, ok = np.cumsum(seen) - 1, seen[rows] & (place[cols] >= 0)
        w, b = nonnegative_pu(number[rows[ok]], place[cols[ok]], positive[seen], len(own), p, decay=decay)
        return own, w, b

    parts = []
    for k in every:
        others = [f for f in every if f != k]
        asked = np.flatnonzero((fold == k) & ~positive & ~np.isnan(label))
        if not all(size(others)) or not len(asked):
            continue
        own, w, b = fitted(others)
        weight = np.zeros(len(features))
        weight[np.searchsorted(features, own)] = w
        z = b + np.bincount(rows, weight[cols], len(lists))
        parts.append((z[asked], label[asked]))
    if parts:
        unseen = {"z": np.concatenate([z for z, _ in parts]), "label": np.concatenate([y for _, y in parts])}
    slope, shift = logistic_curve(unseen["z"], unseen["label"])
    own, w, b = fitted(every)
    return Model(own, slope * w, slope * b + shift), unseen


def remainder(col: str = "doc_id"):
    return F.crc32(F.col(col).cast("long").cast("string").cast("binary")) % 4


def samples(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> tuple[DataFrame, float]:
    """text, positive, fold, label of the drawn rows, of those whose remainder is not 2; and the share of label 1 among their labels."""
    labels = labels.filter("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic")).filter(F.coalesce(remainder() != 2, F.lit(False)))
    n, n_pos = (int(x or 0) for x in labels.agg(F.count("*"), F.count_if(F.col("toxic") == 1)).first())
    prior = min(0.9, max(0.005, (n_pos + 0.5) / (n + 1.0)))
    rows = docs.filter(F.coalesce(remainder() != 2, F.lit(False)))
    n_docs = rows.select("doc_id").count()
    drawn = lambda n, most, salt: F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, most / max(1, n)))
    confirmed = labels.filter("toxic = 1").filter(drawn(n_pos, positives, 1)).select("doc_id")
    text = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    fold = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(FOLDS)).cast("int").alias("fold")
    # At most about `positives` and `unlabelled` ids: the draws bound what is broadcast.
    pos = text.join(F.broadcast(confirmed), "doc_id").select("text", F.lit(True).alias("positive"), fold, F.lit(1).alias("label"))
    told = labels.filter(drawn(n_docs, unlabelled, 2)).select("doc_id", F.col("toxic").cast("int").alias("label"))
    unl = text.filter(drawn(n_docs, unlabelled, 2)).join(F.broadcast(told), "doc_id", "left").select("text", F.lit(False).alias("positive"), fold, "label")
    return written(pos.unionByName(unl), "toxicity-sample"), prior


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """Learns from documents whose remainder is not 2."""
    return learned(*samples(docs, labels, positives, unlabelled))[0]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score for every row of docs."""
    sent = docs.sparkSession.sparkContext.broadcast((model.features, model.weights, model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*sent.value)
        for batch in batches:
            data, offsets = buffers(batch.column(2))
            parts = [m.score(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in slices(offsets)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.concatenate(parts) if parts else np.zeros(0))], ["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(remainder() == 2, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double")


def flagged(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """docs without the rows that score at or above threshold; columns unchanged."""
    sent = docs.sparkSession.sparkContext.broadcast((model.features, model.weights, model.bias))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*sent.value)
        for batch in batches:
            data, offsets = buffers(batch.column(at))
            parts = [m.score(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in slices(offsets)]
            yield batch.filter(pa.array((np.concatenate(parts) if parts else np.zeros(0)) < threshold))

    return docs.mapInArrow(run, docs.schema)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
