"""Toxicity by compression distance: zstandard dictionaries of toxic and of
ordinary text.

A text is cut into overlapping windows of ``WINDOW`` words.  Each window is
compressed with the ordinary dictionary and with each of three toxic ones; the
difference of the lengths is how much toxic text explains it better.

* ``windows``: trained on the windows of toxic documents, as large as the body
  of the ordinary dictionary, which is trained on those of ordinary documents.
* ``words``: that ordinary body, and every word that toxic documents use
  significantly more often (a two-sample test of document shares: at least
  ``LEAST_Z`` deviations), the most telling one last.
* ``telling``: that ordinary body, and a short tail trained on such words of at
  least ``TOP_Z`` of the most telling one's deviations.  The other two hold the
  words that this one leaves out; with a few frequent words it measures them
  with less noise.

The ordinary dictionary ends with a short tail of the words that ordinary
documents use more often.  A logistic model of a document's window differences
under each toxic dictionary (largest, mean, mean of the five largest, shares
above two lengths) is calibrated on documents that the dictionaries have not
seen.

Training sees at most ``SAMPLE`` labelled documents a class, those with the
smallest hash of the id; half of them make the dictionaries, half calibrate.

Results: labels, language, source and id are never inputs of a score.  A-Z count
as a-z; words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.  Null or empty texts, or texts
without words, have one empty window and the score of no difference.  Documents
with several labels count with the larger; with no or one class among the
labels the score is that share.  Repeated rows are each returned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchspan.llm.common import WORDS, slices, text_or_empty, written
from matchspan.llm.quality import logistic_fit, sampled, training_labels
from matchspan.operators.aggregates import quoted

WINDOW, STEP = 8, 4
SAMPLE, SAMPLE_WINDOWS = 4000, 60_000
BODY_BYTES, TAIL_BYTES, LEAST_Z, TOP_Z = 65_536, 1024, 4.0, 0.25
#: Bytes of a training window, and training lines of a class, at most.
LINE_BYTES, LINES = 512, 40_000


def windows(text: str) -> list[bytes]:
    words = text.encode("utf-8").translate(WORDS).split()
    return [b" " + b" ".join(words[i: i + WINDOW]) + b" " for i in range(0, max(1, len(words) - STEP), STEP)]


def _compressor(dictionary: bytes):
    bits = len(dictionary).bit_length()  # a larger dictionary is found whole, too
    level = zstandard.ZstdCompressionParameters(
        format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0, compression_level=1,
        strategy=zstandard.STRATEGY_DFAST, min_match=5, window_log=max(19, bits + 1), hash_log=max(17, bits), chain_log=max(17, bits))
    content = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    content.precompute_compress(compression_params=level)
    return zstandard.ZstdCompressor(dict_data=content, compression_params=level)


class Distance:
    """Window length differences under the ordinary dictionary and each toxic one."""

    def __init__(self, toxic: list[bytes], ordinary: bytes):
        self.toxic, self.ordinary = [_compressor(d).compress for d in toxic], _compressor(ordinary).compress

    def measures(self, text: str) -> np.ndarray:
        ordinary, cut, found = self.ordinary, windows(text), []
        plain = np.array([len(ordinary(w)) for w in cut], np.float64)
        for toxic in self.toxic:
            gain = plain - np.array([len(toxic(w)) for w in cut], np.float64)
            top = np.sort(gain)[-5:]
            found += [gain.max(), gain.mean(), top.mean(), (gain >= 3).mean(), (gain >= 5).mean(), math.log1p((gain >= 4).sum())]
        return np.array(found)


class Model:
    """Dictionaries and calibration; plain data, so that it can be sent to tasks."""

    def __init__(self, toxic: list[bytes], ordinary: bytes, beta: np.ndarray | None, share: float):
        self.toxic, self.ordinary, self.beta, self.share = toxic, ordinary, beta, share

    def scorer(self):
        if self.beta is None:
            return lambda text: self.share
        distance = Distance(self.toxic, self.ordinary)

        def score(text: str) -> float:
            return float(1 / (1 + np.exp(-np.clip(distance.measures(text) @ self.beta[:-1] + self.beta[-1], -30, 30))))

        return score


def _trained(lines: list[bytes], size: int) -> bytes:
    """A trained dictionary's bytes; the lines themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, lines).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(lines))[-size:]


def fit(docs: DataFrame, labels: DataFrame, label: str, held: Column, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Model:
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    some = sampled(training_labels(labels, label, held, id_col), sample)
    # at most 2 x sample ids: broadcast
    rows = written(texts.join(F.broadcast(some), "id").select("id", "text", "y", "cost", "half"))
    made = rows.where("half = 0")
    totals = {r["y"]: r["count"] for r in made.groupBy("y").count().collect()}
    if len(totals) < 2:
        known = rows.agg(F.avg("y")).first()[0]
        return Model([], b"", None, 0.5 if known is None else float(known))
    body = _trained(_body_lines(made, 0), BODY_BYTES)
    words = _significant(made, totals, 1)
    every = b" " + b"".join(w + b" " for w, _ in reversed(words))
    toxic = [_trained(_body_lines(made, 1), BODY_BYTES) or body, body + every, body + _tail(made, words, 1)]
    model = Model(toxic, body + _tail(made, _significant(made, totals, 0), 0), None, 0.0)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distance = Distance(model.toxic, model.ordinary)
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array([distance.measures(t).tolist() for t in b.column(0).to_pylist()], pa.list_(pa.float64())), *b.columns[1:]], names=["x", "y", "cost"])

    rest = rows.where("half = 1").select("text", "y", "cost").mapInArrow(measure, "x array<double>, y int, cost double").collect()
    if len({r["y"] for r in rest}) < 2:
        return Model([], b"", None, totals.get(1, 0) / sum(totals.values()))
    model.beta = logistic_fit(np.array([r["x"] for r in rest]), np.array([r["y"] for r in rest], float), np.array([r["cost"] for r in rest]), ridge=1.0)
    return model


def _body_lines(made: DataFrame, y: int) -> list[bytes]:
    """At most SAMPLE_WINDOWS windows of the documents of class ``y``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 64):
            out = [w for t in b.column(0).to_pylist() for w in windows(t) if len(w) <= LINE_BYTES]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["w"])

    found = made.where(F.col("y") == y).select("text").mapInArrow(cut, "w binary")
    return [bytes(r["w"]) for r in found.orderBy(F.xxhash64("w"), "w").limit(SAMPLE_WINDOWS).collect()]


def _significant(made: DataFrame, totals: dict[int, int], y: int) -> list[tuple[bytes, float]]:
    """The words that class ``y`` uses significantly more often and their
    deviations, the most telling first.  All of them: the documents are a bounded
    sample, and a word must be in many of them."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            words, ys = [], []
            for t, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = {w for w in t.encode("utf-8").translate(WORDS).split() if len(w) <= 64}
                words += own
                ys += [k] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(ys, pa.int32())], names=["w", "y"])

    n, m = float(totals[y]), float(totals[1 - y])
    counts = made.select("text", "y").mapInArrow(distinct, "w binary, y int").groupBy("w").agg(F.count_if(F.col("y") == y).alias("a"), F.count_if(F.col("y") != y).alias("b"))
    p = (F.col("a") + F.col("b") + 1) / (n + m + 2)
    z = (F.col("a") / n - F.col("b") / m) / F.sqrt(p * (1 - p) * (1 / n + 1 / m))
    found = [(bytes(r["w"]), r["z"]) for r in counts.withColumn("z", z).where(F.col("z") >= LEAST_Z).select("w", "z").collect()]
    return sorted(found, key=lambda f: (-f[1], f[0]))


def _tail(made: DataFrame, words: list[tuple[bytes, float]], y: int) -> bytes:
    """A short dictionary of the most telling of class ``y``'s words."""
    chosen = {w for w, z in words if z >= TOP_Z * words[0][1]}
    if not chosen:
        return b""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out = []
            for t in b.column(0).to_pylist():
                own = [b" " + w + b" " for w in t.encode("utf-8").translate(WORDS).split() if w in chosen]
                out += [b"".join(own[i: i + 8]) for i in range(0, len(own), 8)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["l"])

    found = made.where(F.col("y") == y).select("text").mapInArrow(lines, "l binary")
    return _trained([bytes(r["l"]) for r in found.orderBy(F.xxhash64("l"), "l").limit(LINES).collect()], TAIL_BYTES)


def score(docs: DataFrame, model: Model, held: Column, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, held_out, score, predicted of every row."""
    source = docs.select(F.col(id_col).alias("id"), held.alias("held_out"), text_or_empty(text_col).alias("text"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rate = model.scorer()
        for b in slices(batches):
            s = np.array([rate(t) for t in b.column(2).to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=[id_col, "held_out", "score", "predicted"])

    return source.mapInArrow(apply, f"{id_col} {source.schema['id'].dataType.simpleString()}, held_out boolean, score double, predicted int")


def keep_ordinary(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``threshold``."""
    columns = docs.columns
    plain = docs.select(*[quoted(c).alias(f"c{i}") for i, c in enumerate(columns)])
    at = columns.index(text_col)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rate = model.scorer()
        for b in slices(batches):
            yield b.filter(pa.array([rate(t or "") < threshold for t in b.column(at).to_pylist()], pa.bool_()))

    return plain.mapInArrow(judge, plain.schema).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])
