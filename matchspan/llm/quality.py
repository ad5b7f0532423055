"""Quality classifier: a linear SVM on n-gram indicators scaled by naive Bayes ratios.

Features are indicators (present or not) of byte trigrams and of 1- to 3-grams
of word shapes (character classes at the ends, upper case, length, whether the
word before, or the line before, is the same), hashed into ``DIMENSIONS``.  The
class log-count ratio of feature f is

    r_f = log((a + n_f of class 1) / |class 1|) - log((a + n_f of class 0) / |class 0|)

over all training documents, counted by Spark in partial sums.  A hinge-loss
linear model on x_f = r_f is fitted by dual coordinate descent on a sample of at
most ``SAMPLE`` documents a class (those with the smallest hash of the id),
half of which calibrate the margin to a probability.

Results: labels, language, source and id are never inputs.  Null or empty texts
have no features and get the score of the bias.  Documents with several labels
count with the larger one; labels that are null or without document are
ignored.  With no or one class among the labels the score is that share.
Repeated rows are each returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchspan.llm.common import slices, text_or_empty
from matchspan.llm.jaccard_join import _word_hashes

DIMENSIONS = 1 << 17
#: Labelled documents a class that the linear model and its calibration see, with all their features
#: (DIMENSIONS numbers at most each).
SAMPLE = 1500
SMOOTH, C, EPOCHS = 1.0, 1.0, 8

_CLASS = np.full(256, 7, np.uint32)  # 7: beyond ASCII
for _c in range(128):
    _ch = chr(_c)
    _CLASS[_c] = 0 if _ch.islower() else 1 if _ch.isupper() else 2 if _ch.isdigit() else 3 if _ch in ".,;:" else 4 if _ch in "!?" else 5 if _c > 32 else 6
_M = np.uint32(0x9E3779B1)
_BLANKS = bytes(32 if 9 <= c <= 13 else c for c in range(256))


def features(text: str) -> np.ndarray:
    """The distinct feature numbers of a text, ascending."""
    data = text.encode("utf-8")
    raw = np.frombuffer(data, np.uint8).astype(np.uint32)
    found = np.zeros(DIMENSIONS, bool)
    if len(raw) >= 3:
        found[_bucket(raw[:-2] | raw[1:-1] << 8 | raw[2:] << 16)] = True
    blanks = np.frombuffer(data.translate(_BLANKS), np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate(([False], blanks, [False]))))
    starts, ends = edge[::2], edge[1::2]
    if len(starts):
        words = np.concatenate([_word_hashes(data[lo:hi].translate(_BLANKS)) for lo, hi in _pieces(starts, ends)])
        lines = np.frombuffer(data, np.uint8)
        size = np.minimum(3, np.log2(ends - starts).astype(np.uint32))
        upper = (_CLASS[raw[np.minimum(starts + 1, len(raw) - 1)]] == 1).astype(np.uint32)
        same = np.append(False, words[1:] == words[:-1]).astype(np.uint32)
        near = np.append([False, False], words[2:] == words[:-2])[: len(words)].astype(np.uint32)
        first = np.append(True, np.array([b"\n"[0]], np.uint8)[0] == lines[np.maximum(starts[1:] - 1, 0)])
        heads = np.flatnonzero(first)
        again = np.zeros(len(words), np.uint32)
        again[heads[1:]] = words[heads[1:]] == words[heads[:-1]]
        shape = _CLASS[raw[starts]] | _CLASS[raw[ends - 1]] << 3 | size << 6 | upper << 8 | same << 9 | near << 10 | again << 11
        for n in (1, 2, 3):
            if len(shape) >= n:
                code = np.full(len(shape) - n + 1, n * 77, np.uint32)
                for j in range(n):
                    code = code * np.uint32(4099) + shape[j: len(shape) - n + 1 + j]
                found[_bucket(code ^ np.uint32(0x5BD1E995))] = True
    return np.flatnonzero(found).astype(np.int32)


def _pieces(starts: np.ndarray, ends: np.ndarray, size: int = 1 << 20) -> list[tuple[int, int]]:
    """Byte ranges between words of about ``size`` bytes."""
    cuts = [0, *(np.flatnonzero(np.diff(starts // size)) + 1), len(starts)]
    return [(int(starts[a]), int(ends[b - 1])) for a, b in zip(cuts, cuts[1:])]


def _bucket(code: np.ndarray) -> np.ndarray:
    h = code * _M
    h ^= h >> np.uint32(15)
    return (h * np.uint32(0x85EBCA77)) >> np.uint32(32 - DIMENSIONS.bit_length() + 1)


def hinge_fit(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of the L1-loss SVM by dual coordinate descent; each row
    is scaled to unit length, ``weight`` are costs by row."""
    xs = [ratio[r] for r in rows]
    xs = [x / max(1e-9, np.sqrt((x * x).sum())) for x in xs]
    sign, alpha = np.where(y > 0, 1.0, -1.0), np.zeros(len(rows))
    w, b, order = np.zeros(len(ratio)), 0.0, np.random.default_rng(7)
    norm = np.array([(x * x).sum() + 1 for x in xs])
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            g = sign[i] * (w[rows[i]] @ xs[i] + b) - 1
            new = min(max(alpha[i] - g / norm[i], 0.0), weight[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                w[rows[i]] += step * xs[i]
                b += step
                alpha[i] = new
    return w, b


def logistic_fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Coefficients of weighted logistic regression, the last one the intercept (Newton steps)."""
    x = np.column_stack([x, np.ones(len(x))])
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(h, x.T @ (weight * (y - p)) - ridge * beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def training_labels(labels: DataFrame, label: str, held: Column, id_col: str = "doc_id") -> DataFrame:
    """id, y: one row per labelled document outside the held-out part."""
    rows = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & ~held)
    return rows.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label)).cast("int").alias("y"))


def sampled(labels: DataFrame, most: int) -> DataFrame:
    """id, y, half, share: at most ``most`` documents of either class, by the hash of the id."""
    totals = {r["y"]: r["count"] for r in labels.groupBy("y").count().collect()}
    one = [labels.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(most).withColumn("cost", F.lit(max(1.0, totals.get(y, 0) / most))) for y in (0, 1)]
    return one[0].unionByName(one[1]).withColumn("half", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2)))


class Model:
    """What scoring needs: weights by feature, bias, calibration, share of label 1."""

    def __init__(self, weights: np.ndarray, ratio: np.ndarray, bias: float, beta: np.ndarray | None, share: float):
        self.weights, self.ratio, self.bias, self.beta, self.share = weights, ratio, bias, beta, share

    def score(self, text: str) -> float:
        if self.beta is None:
            return self.share
        return float(1 / (1 + np.exp(-np.clip(self.beta[0] * self.margin(features(text)) + self.beta[1], -30, 30))))

    def margin(self, row: np.ndarray) -> float:
        r = self.ratio[row]
        return float(self.weights[row] @ r / max(1e-9, np.sqrt(r @ r)) + self.bias)


def fit(docs: DataFrame, labels: DataFrame, label: str, held: Column, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Model:
    known = training_labels(labels, label, held, id_col)
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    some = sampled(known, sample)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = [features(t).tobytes() for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), *b.columns[1:]], names=["f", "y", "cost", "half"])

    # at most 2 x sample ids: broadcast
    rows = texts.join(F.broadcast(some), "id").select("text", "y", "cost", "half").mapInArrow(vectors, "f binary, y int, cost double, half long").collect()
    y, cost, half = (np.array([r[c] for r in rows]) for c in ("y", "cost", "half"))
    if not len(rows) or y.min() == y.max():
        share = float(y.mean()) if len(rows) else 0.5
        return Model(np.zeros(1), np.zeros(1), 0.0, None, share)
    ratio = _ratios(texts, known)
    vecs = [np.frombuffer(r["f"], np.int32) for r in rows]
    first = np.flatnonzero(half == 0) if len(np.unique(y[half == 0])) == 2 else np.arange(len(y))
    rest = np.flatnonzero(half == 1) if len(np.unique(y[half == 1])) == 2 else np.arange(len(y))
    even = np.where(y == 1, 0.5 / max(1, (y[first] == 1).sum()), 0.5 / max(1, (y[first] == 0).sum())) * len(first)
    w, b = hinge_fit([vecs[i] for i in first], y[first], ratio, C * even[first])
    model = Model(w, ratio, b, None, 0.0)
    margins = np.array([model.margin(vecs[i]) for i in rest])
    model.beta = logistic_fit(margins[:, None], y[rest].astype(float), cost[rest])
    return model


def _ratios(texts: DataFrame, known: DataFrame) -> np.ndarray:
    """The class log-count ratio of every feature, over all training documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = np.zeros((2, DIMENSIONS), np.int64), [0, 0]
        for b in slices(batches):
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                sums[1 if y > 0 else 0][features(t)] += 1
                n[1 if y > 0 else 0] += 1
        at = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(sums[0][at], n[0])), pa.array(np.append(sums[1][at], n[1]))], names=["f", "n0", "n1"])

    # the same join at every size; labels grow with the table
    met = texts.join(known.hint("merge"), "id").select("text", "y").mapInArrow(count, "f int, n0 long, n1 long")
    # at most DIMENSIONS + 1 rows
    got = met.groupBy("f").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).collect()
    counts, n = np.zeros((2, DIMENSIONS)), [1.0, 1.0]
    for f, a, b in got:
        if f < 0:
            n = [a, b]
        else:
            counts[:, f] = a, b
    return np.log((counts[1] + SMOOTH) / (n[1] + 2 * SMOOTH)) - np.log((counts[0] + SMOOTH) / (n[0] + 2 * SMOOTH))


def score(docs: DataFrame, model: Model, held: Column, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, held_out, score, predicted of every row."""
    source = docs.select(F.col(id_col).alias("id"), held.alias("held_out"), text_or_empty(text_col).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for b in slices(batches):
            s = np.array([own.score(t) for t in b.column(2).to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=[id_col, "held_out", "score", "predicted"])

    return source.mapInArrow(apply, f"{id_col} {source.schema['id'].dataType.simpleString()}, held_out boolean, score double, predicted int")
