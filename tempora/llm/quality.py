"""Quality by naive Bayes support vectors.

Features of a text are indicators, hashed to ``FEATURES`` places: runs of three bytes, single words, pairs
of words, and pairs and triples of word shapes (letter case, the characters behind the word, whether it
repeats the word before).  Each is scaled by its class log-count ratio, texts are brought to length 1, and a
linear model with hinge loss is fitted by dual coordinate descent; its weights are drawn towards their mean
size, as far as naive Bayes is to be trusted.  Margins become scores by a logistic curve, fitted to margins of
texts that the model of the other folds hasn't seen, classes weighed as the labels have them.

Learned from at most ``PER_CLASS`` labelled texts of each class, of ``TRAIN_BYTES`` bytes at most (the bounds
of the sample), picked by hash of the id among the rows that aren't left for the test; texts
are turned into features by the tasks, and whole.  Every text is scored whole, however long.

Defined results: null and empty texts have no features and get the score of the bias alone; a null id counts
as empty text in the crc32; repeated rows get equal scores; contradicting labels of one id count as 0 (a text
once found poor); where the labels name one class only every score is that label, without labels 1, so that
nothing is thrown away unjudged; an empty table gives no rows; further columns aren't looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempora.llm.common import (byte_slices, documents, mix64, scratch, utf8, word_hashes, words,
                                written)

PER_CLASS, TRAIN_BYTES, FEATURES = 3000, 16_384, 1 << 20
SMOOTHING, COST, TRUST, EPOCHS, FOLDS = 0.3, 1.0, 0.5, 30, 3

_CLASS = np.full(256, 5, np.uint64)  # of a byte: 1 upper, 2 lower, 3 digit, 4 part of a longer character
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 4


def held_out(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every indicator, each once, by text."""
    data, offsets = utf8(texts)
    start, end, doc = words(data, offsets)
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    found = []

    def add(kind: int, key: np.ndarray, of: np.ndarray) -> None:
        place = mix64(key.astype(np.uint64) * np.uint64(8) + np.uint64(kind)) % np.uint64(FEATURES)
        found.append(of.astype(np.int64) * FEATURES + place.astype(np.int64))

    if len(data) > 2:
        b = data.astype(np.uint64)
        whole = owner[:-2] == owner[2:]
        add(0, ((b[:-2] << np.uint64(16)) + (b[1:-1] << np.uint64(8)) + b[2:])[whole], owner[:-2][whole])
    if len(start):
        h = word_hashes(data, start, end)
        add(1, h, doc)
        # shape: classes of the first two bytes, the last two bytes unless letters, the repeat
        last, before = data[end - 1], data[np.maximum(end - 2, start)]
        second = data[np.minimum(start + 1, end - 1)]
        tail = np.where(_CLASS[last] == 5, last, 0).astype(np.uint64) * np.uint64(256)
        tail += np.where((_CLASS[last] == 5) & (_CLASS[before] == 5), before, 0).astype(np.uint64)
        again = np.zeros(len(h), np.uint64)
        again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
        shape = ((tail * np.uint64(8) + _CLASS[data[start]]) * np.uint64(8) + _CLASS[second]) * np.uint64(2) + again
        pair = doc[1:] == doc[:-1]
        add(2, (mix64(h[:-1]) + h[1:])[pair], doc[1:][pair])
        add(3, (mix64(shape[:-1]) + shape[1:])[pair], doc[1:][pair])
        three = doc[2:] == doc[:-2]
        add(4, (mix64(mix64(shape[:-2]) + shape[1:-1]) + shape[2:])[three], doc[2:][three])
    each = np.concatenate(found) if found else np.empty(0, np.int64)
    each.sort()
    if len(each):  # sorting whole numbers is much faster than a set of them
        each = each[np.append(True, each[1:] != each[:-1])]
    return each // FEATURES, each % FEATURES


@dataclass(frozen=True)
class Model:
    """``weight``: of an indicator, its ratio included; ``square``: of its ratio; score = logistic curve."""

    weight: np.ndarray
    square: np.ndarray
    bias: float
    slope: float
    shift: float

    def margins(self, texts: pa.Array) -> np.ndarray:
        of, feature = features(texts)
        total = np.bincount(of, self.weight[feature], len(texts))
        length = np.sqrt(np.bincount(of, self.square[feature], len(texts)))
        return total / np.where(length > 0, length, 1) + self.bias

    def scores(self, texts: pa.Array) -> np.ndarray:
        return 0.5 * (1 + np.tanh(0.5 * (self.slope * self.margins(texts) + self.shift)))


def ratios(rows: list[np.ndarray], label: np.ndarray) -> np.ndarray:
    """Class log-count ratio of every feature: by how much more of label 1's indicators it is."""
    count = np.full((2, FEATURES), SMOOTHING)
    for row, y in zip(rows, label):
        count[y, row] += 1
    share = count / count.sum(axis=1, keepdims=True)
    return np.log(share[1] / share[0]).astype(np.float32)


def descend(rows: list[np.ndarray], values: list[np.ndarray], label: np.ndarray, cost: np.ndarray,
            epochs: int = EPOCHS, seed: int = 3, tolerance: float = 1e-3) -> tuple[np.ndarray, float]:
    """(weights, bias) of least |w|**2 / 2 + sum of cost * hinge loss, by dual coordinate descent; the bias is
    the weight of a constant feature."""
    y = np.where(label == 1, 1.0, -1.0)
    w, bias, alpha = np.zeros(FEATURES), 0.0, np.zeros(len(rows))
    diagonal = np.array([float(v @ v) + 1 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(rows)).tolist():
            slope = y[i] * (float(values[i] @ w[rows[i]]) + bias) - 1
            new = min(max(alpha[i] - slope / diagonal[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            if step:
                worst = max(worst, abs(step) * diagonal[i])
                alpha[i] = new
                w[rows[i]] += step * values[i]
                bias += step
        if worst < tolerance:
            break
    return w, bias


def linear(rows: list[np.ndarray], label: np.ndarray, weigh: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(weight of each indicator, square of its ratio, bias); ``weigh``: what a text of each class counts."""
    ratio = ratios(rows, label)
    values = []
    for row in rows:
        v = ratio[row].astype(np.float64)
        length = np.sqrt(v @ v)
        values.append(v / length if length > 0 else v)
    w, bias = descend(rows, values, label, COST * weigh[label])
    met = np.zeros(FEATURES, bool)
    for row in rows:
        met[row] = True
    mean = np.abs(w[met]).mean() if met.any() else 0.0
    w = np.where(met, (1 - TRUST) * mean + TRUST * w, 0.0) / TRUST
    return (w * ratio).astype(np.float32), ratio * ratio, bias


def logistic_curve(margin: np.ndarray, label: np.ndarray, weigh: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """(slope, shift) of the logistic curve of greatest likelihood, targets drawn in by one text a class."""
    many = np.bincount(label, minlength=2)
    target = np.where(label == 1, (many[1] + 1) / (many[1] + 2), 1 / (many[0] + 2))
    x, c = np.stack([margin, np.ones(len(margin))]), weigh[label]
    curve = np.array([1.0, 0.0])

    def loss(v: np.ndarray) -> float:
        z = v @ x
        return float(c @ (np.logaddexp(0, z) - target * z))

    for _ in range(rounds):  # Newton steps, halved until they help
        p = 0.5 * (1 + np.tanh(0.5 * (curve @ x)))
        slope = x @ (c * (p - target))
        step = np.linalg.solve((x * (c * p * (1 - p))) @ x.T + 1e-9 * np.eye(2), slope)
        size = 1.0
        while size > 1e-6 and loss(curve - size * step) > loss(curve):
            size /= 2
        curve = curve - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return float(curve[0]), float(curve[1])


def train(rows: list[np.ndarray], label: np.ndarray, totals: np.ndarray) -> Model:
    """A model of texts given by their features; ``totals``: labelled texts of each class at large."""
    many = np.bincount(label, minlength=2)
    even = len(label) / (2 * many)  # both classes count alike for the line, as they occur for the curve
    fold = np.random.default_rng(9).permutation(len(rows)) % FOLDS
    margin = np.zeros(len(rows))
    seen = np.zeros(len(rows), bool)
    for k in range(FOLDS):
        mine = np.flatnonzero(fold != k)
        if len(np.unique(label[mine])) < 2:
            continue
        weight, square, bias = linear([rows[i] for i in mine], label[mine], even)
        for i in np.flatnonzero(fold == k):
            length = np.sqrt(square[rows[i]].sum())
            margin[i] = weight[rows[i]].sum() / (length if length > 0 else 1) + bias
            seen[i] = True
    weight, square, bias = linear(rows, label, even)
    slope, shift = 2.0, 0.0
    if len(np.unique(label[seen])) == 2:
        slope, shift = logistic_curve(margin[seen], label[seen], totals / many)
    return Model(weight, square.astype(np.float32), bias, slope, shift)


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_bytes: int = TRAIN_BYTES
                    ) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(features of at most ``per_class`` texts of each class that aren't held out, labels, texts of each
    class at large); texts picked by hash of the id."""
    known = (labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").filter(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    size = F.octet_length("text")
    short = docs.select("doc_id", "text").filter(size.between(1, max_bytes))
    pool = short.select("doc_id").join(known, "doc_id").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", 1 << 20):
            of, feature = features(batch.column("text"))
            cut = np.searchsorted(of, np.arange(batch.num_rows + 1))
            kept = [feature[a:b].astype(np.int32).tobytes() for a, b in zip(cut, cut[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"),
                                              pa.array(kept, pa.binary())], names=["doc_id", "quality", "row"])

    with scratch(docs.sparkSession):
        pool = written(pool, "quality")
        by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
        picked = written(pool.filter("quality = 0").orderBy(*by_hash).limit(per_class).unionAll(
            pool.filter("quality = 1").orderBy(*by_hash).limit(per_class)), "quality")
        totals = {r.quality: r["count"] for r in pool.groupBy("quality").count().collect()}
        # at most 2 * per_class ids: a bounded side, and a bounded number of short texts; of rows that
        # repeat an id the least text counts
        kind = docs.schema["doc_id"].dataType.simpleString()
        got = (short.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
               .mapInArrow(run, f"doc_id {kind}, quality int, row binary").collect())
    got.sort(key=lambda r: r.doc_id)
    return ([np.frombuffer(r.row, np.int32) for r in got], np.array([r.quality for r in got], np.int64),
            np.array([totals.get(0, 0), totals.get(1, 0)], np.float64))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    rows, label, totals = training_sample(docs, labels)
    if len(np.unique(label)) == 2:
        return train(rows, label, totals)
    nothing = np.zeros(FEATURES, np.float32)
    return Model(nothing, nothing, 0.0, 0.0, -40.0 if totals[0] else 40.0)


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id_col>, score`` per row."""
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    schema = T.StructType([T.StructField(id_col, rows.schema["id"].dataType),
                           T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", 1 << 20):
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(model.scores(batch.column("text")))],
                                             names=schema.names)

    return rows.mapInArrow(run, schema)


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                      (F.col("score") >= 0.7).cast("int").alias("predicted"))
