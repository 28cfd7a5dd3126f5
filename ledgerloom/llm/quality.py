"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage of the whole text is encoded as
figures of its bytes and words and a hashed bag of words; a gated attention

    a_k = softmax_k(w . (tanh(V h_k) * sigmoid(U h_k)))

learned from document labels alone weighs the passages, and the weighted passage
representation is scored by a logistic unit. Training takes a bounded sample of
labelled documents; scoring runs over all documents where they lie.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import textkit

# the documented bound of the training sample: labelled documents of each label
TRAIN_ROWS = 1000
# a document scores as good from here on
THRESHOLD = 0.3
# words of a passage
PASSAGE = 64
# buckets of the hashed bag of words
BUCKETS = 64
HIDDEN, ATTENTION, STEPS, RATE, DECAY = 32, 16, 200, 0.015, 1e-3
# longer documents are not drawn into the training sample, which is held in memory; scoring reads all texts whole
TRAIN_BYTES = 64 << 10

# counted classes of bytes: upper, lower, digit, non-ASCII, white space; and every ASCII mark on its own
_MARKS = [c for c in range(33, 127) if not chr(c).isalnum()]
_CLASS = np.zeros(256, np.int64)
for _c in range(256):
    _t = chr(_c)
    _CLASS[_c] = 1 if "A" <= _t <= "Z" else 2 if "a" <= _t <= "z" else 3 if "0" <= _t <= "9" else 4 if _c > 127 else 0
for _i, _c in enumerate(_MARKS):
    _CLASS[_c] = 5 + _i
CLASSES = 5 + len(_MARKS)
FEATURES = CLASSES + 5 + BUCKETS


def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(features of all passages, passage bounds of each text); a text without words has one passage of zeros."""
    words = textkit.Words(texts, lower=False)
    n = np.diff(words.bounds)
    passages = np.maximum(1, -(-n // PASSAGE))
    bounds = np.concatenate(([0], np.cumsum(passages)))
    found = np.zeros((bounds[-1], FEATURES))
    if not len(words):
        return found, bounds
    doc = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(words)) - words.bounds[:-1][doc]
    passage = bounds[:-1][doc] + place // PASSAGE
    lengths = np.diff(words.offsets)
    size = np.bincount(passage, minlength=bounds[-1]).clip(1)
    letters = np.bincount(passage, lengths, minlength=bounds[-1]).clip(1)
    byte_passage = np.repeat(passage, lengths)
    kinds = np.bincount(byte_passage * CLASSES + _CLASS[words.bytes], minlength=bounds[-1] * CLASSES).reshape(-1, CLASSES)
    # marks weigh by word, letters by byte
    found[:, :5] = kinds[:, :5] / letters[:, None]
    found[:, 5:CLASSES] = np.sqrt(kinds[:, 5:] / size[:, None])
    hashes = words.hashes()
    same = np.concatenate(([False], (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])))
    order = np.lexsort((hashes, passage))
    again = (hashes[order][1:] == hashes[order][:-1]) & (passage[order][1:] == passage[order][:-1])
    distinct = size - np.bincount(passage[order][1:][again], minlength=bounds[-1])
    only_marks = np.bincount(passage, (lengths == 1) & (_CLASS[words.bytes[words.offsets[:-1]]] >= 5), minlength=bounds[-1])
    found[:, CLASSES] = np.bincount(passage, same, minlength=bounds[-1]) / size
    found[:, CLASSES + 1] = distinct / size
    found[:, CLASSES + 2] = only_marks / size
    found[:, CLASSES + 3] = np.log1p(letters / size)
    found[:, CLASSES + 4] = np.log1p(size) / 5
    bucket = (hashes % np.uint64(BUCKETS)).astype(np.int64)
    bags = np.bincount(passage * BUCKETS + bucket, minlength=bounds[-1] * BUCKETS).reshape(-1, BUCKETS)
    found[:, CLASSES + 5 :] = np.sqrt(bags / size[:, None])
    return found, bounds


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Model:
    """Encoder, gated attention and scoring unit."""

    weights: dict[str, np.ndarray]
    mean: np.ndarray
    scale: np.ndarray

    def _forward(self, x: np.ndarray, bounds: np.ndarray) -> tuple:
        w = self.weights
        h = np.tanh(x @ w["E"] + w["e"])
        t, g = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
        raw = (t * g) @ w["w"]
        starts, bag = bounds[:-1], np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        a = np.exp(raw - np.maximum.reduceat(raw, starts)[bag])
        a /= np.add.reduceat(a, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return h, t, g, a, z, bag, z @ w["c"] + w["b"]

    def score(self, texts: pa.Array) -> np.ndarray:
        """One score from 0 to 1 for each text."""
        scores = [np.empty(0)]
        for _, part in textkit.pieces(texts):
            x, bounds = encode(part)
            scores.append(_sigmoid(self._forward((x - self.mean) / self.scale, bounds)[-1]))
        return np.concatenate(scores)

    @classmethod
    def fit(cls, texts: list[str], labels: list[int]) -> Model:
        """Full-batch Adam on the balanced logistic loss; a fixed seed, so reruns agree."""
        if len(set(labels)) < 2:  # nothing to tell apart
            model = cls._start(np.zeros(FEATURES), np.ones(FEATURES))
            model.weights["c"][:] = 0
            model.weights["b"] = np.array(6.0 if set(labels) == {1} else -6.0 if labels else 0.0)
            return model
        x, bounds = encode(pa.array(texts, pa.large_string()))
        mean, scale = x.mean(axis=0), x.std(axis=0) + 0.05
        model = cls._start(mean, scale)
        x, y = (x - mean) / scale, np.array(labels, float)
        weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
        first = {k: np.zeros_like(v) for k, v in model.weights.items()}
        second = {k: np.zeros_like(v) for k, v in model.weights.items()}
        for step in range(1, STEPS + 1):
            for k, g in model._gradients(x, bounds, y, weight).items():
                g = g + DECAY * model.weights[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                model.weights[k] = model.weights[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        return model

    @classmethod
    def _start(cls, mean: np.ndarray, scale: np.ndarray) -> Model:
        rng = np.random.default_rng(7)
        draw = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s)
        weights = {"E": draw(FEATURES, HIDDEN), "e": np.zeros(HIDDEN), "V": draw(HIDDEN, ATTENTION), "U": draw(HIDDEN, ATTENTION),
                   "w": draw(ATTENTION), "c": draw(HIDDEN), "b": np.zeros(())}
        return cls(weights, mean, scale)

    def _gradients(self, x: np.ndarray, bounds: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        h, t, g, a, z, bag, logit = self._forward(x, bounds)
        d = weight * (_sigmoid(logit) - y) / len(y)
        dz = d[bag, None] * w["c"]
        da = (dz * h).sum(axis=1)
        draw = a * (da - np.add.reduceat(a * da, bounds[:-1])[bag])
        dt = draw[:, None] * w["w"] * g * (1 - t * t)
        dg = draw[:, None] * w["w"] * t * g * (1 - g)
        dh = a[:, None] * dz + dt @ w["V"].T + dg @ w["U"].T
        de = dh * (1 - h * h)
        return {"E": x.T @ de, "e": de.sum(axis=0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ draw, "c": z.T @ d, "b": d.sum()}


def held_out(id_column: str):
    """Documents kept from training: one in five by a checksum of the id; a null id is held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> Model:
    """A model from at most TRAIN_ROWS labelled documents of each label, chosen by a hash of the id; held-out rows never enter."""
    usable = labels.filter(F.col("quality").isin(0, 1) & ~held_out(id_column)).select(F.col(id_column).alias("id"), F.col("quality").cast("int").alias("quality"))
    chosen = None
    for label in (0, 1):
        # the smallest hashes: a bounded heap in every task
        part = usable.filter(F.col("quality") == label).orderBy(F.xxhash64("id"), "id").limit(TRAIN_ROWS)
        chosen = part if chosen is None else chosen.union(part)
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).filter(F.octet_length("text") <= TRAIN_BYTES)
    # a bounded number of rows: 2 * TRAIN_ROWS
    sample = texts.join(F.broadcast(chosen), "id").select("id", "text", "quality").orderBy("id", "text").limit(2 * TRAIN_ROWS)
    rows = sample.collect()
    return Model.fit([r["text"] for r in rows], [r["quality"] for r in rows])


def score_quality(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, held_out, score, predicted)`` for every row of ``docs``, from its whole text and nothing else.

    Null and empty texts are scored as a passage without words. Rows with equal
    ids are scored each. Other columns are ignored.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(model.score(batch.column(2)))], names=[id_column, "held_out", "score"])

    kind = docs.schema[id_column].dataType.simpleString()
    slim = docs.select(id_column, held_out(id_column).alias("held_out"), text_column)
    scored = slim.mapInArrow(score, f"{id_column} {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """``docs`` without the documents whose score is below the threshold; all columns are kept."""
    at = docs.columns.index(text_column)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.score(batch.column(at)) >= THRESHOLD))

    return docs.mapInArrow(keep, docs.schema)
