"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

Input of each word: an embedding of the word (hashed) and the mean embedding of its runs of
three characters.  A text is cut into all windows of ``WINDOW`` words, ``STRIDE`` apart, so that neighbours
overlap and every word stands in the middle of one; each window goes through a forward and a
backward gated recurrent layer, attention weighs the states, and a logistic unit scores the pooled
state.  A text scores as its worst window does.

The network is trained on the driver on at most ``PER_CLASS`` labelled texts of each class, of
``TRAIN_BYTES`` bytes at most (the bounds of the sample; a text for training is used whole), taken
by hash of the id among the rows whose crc32 is not left for the test.  First coordinate of a word's
embedding at the start: how far its document counts differ between the classes of that sample; words
in fewer than ``SELDOM`` of its texts share one embedding and differ by their characters only.  Each step of the training takes the worst window of every text of a batch.

Defined results: a text without words scores 0, null texts too; a null id counts as empty text in the
crc32; repeated rows get equal scores; contradicting labels of one id count as toxic; without a
labelled row of both classes every score is 0.  The features come from the text alone.  Texts are scored whole,
however long; an empty table gives no rows; further columns aren't looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempora.llm.common import (BASE, byte_slices, documents, inverse, mix64, powers, prefix_hashes,
                                scratch, utf8, written)

WINDOW, STRIDE = 48, 24
PER_CLASS, TRAIN_BYTES, SELDOM = 3000, 16_384, 4
WORDS, WORD_DIM, GRAMS, GRAM_DIM, HIDDEN, ATTENTION = 1 << 15, 10, 1 << 13, 6, 8, 8

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)  # letters, digits and every byte of a longer character
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def held_out(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


class Text:
    """Words of a batch of texts: distinct words, their character runs, and the windows."""

    def __init__(self, texts: pa.Array):
        data, offsets = utf8(texts)
        data = _LOWER[data]
        solid = np.zeros(len(data) + 2, bool)
        solid[1:-1] = _LETTER[data]
        first, last = solid[1:-1] & ~solid[:-2], solid[1:-1] & ~solid[2:]
        edge = offsets[1:-1]
        edge = edge[(edge > 0) & (edge < len(data))]
        first[edge] |= solid[1:-1][edge]
        last[edge - 1] |= solid[1:-1][edge - 1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        prefix = prefix_hashes(data.astype(np.uint64) + np.uint64(1))
        back = powers(inverse(BASE), len(prefix))
        h = mix64((prefix[end] - prefix[start]) * back[start])
        self.keys, example, of = np.unique(h, return_index=True, return_inverse=True)
        self.n_words = len(start)
        # runs of three characters of the distinct words, with a mark at both ends
        s, size = start[example], end[example] - start[example]
        at = np.concatenate([[0], np.cumsum(size + 2)])
        padded = np.zeros(at[-1] + 2, np.uint64)
        step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        padded[np.repeat(at[:-1] + 1, size) + step] = data[np.repeat(s, size) + step].astype(np.uint64) + np.uint64(1)
        gram = (padded[:-2] << np.uint64(18)) + (padded[1:-1] << np.uint64(9)) + padded[2:]
        inner = np.ones(len(gram), bool)
        inner[at[1:] - 1] = inner[at[1:] - 2] = False  # these run into the next word
        self.gram = (mix64(gram[inner]) % np.uint64(GRAMS)).astype(np.int64)
        self.gram_at = np.concatenate([[0], np.cumsum(size)])
        # windows: places in the sequence of words, -1 beyond the end of the text
        per = np.bincount(np.searchsorted(offsets, start, "right") - 1, minlength=len(texts))
        many = np.where(per > 0, 1 + np.maximum(0, -(-(per - WINDOW) // STRIDE)), 0)
        self.owner = np.repeat(np.arange(len(texts)), many)
        base = np.concatenate([[0], np.cumsum(per)])
        step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        place = (base[:-1][self.owner] + step * STRIDE)[:, None] + np.arange(WINDOW)
        self.live = place < base[1:][self.owner][:, None]
        self.word = np.where(self.live, np.append(of, 0)[np.minimum(place, max(len(of) - 1, 0))], 0)

    @property
    def bucket(self) -> np.ndarray:
        """Rows of the word table; row 0 is for words that the training met too seldom."""
        return 1 + (self.keys % np.uint64(WORDS - 1)).astype(np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Network:
    """Parameters and passes; arrays are float32."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        d = WORD_DIM + GRAM_DIM
        self.p = {"words": normal(WORDS, WORD_DIM, scale=0.05), "grams": normal(GRAMS, GRAM_DIM, scale=0.1),
                  "A": normal(2 * HIDDEN, ATTENTION, scale=0.3), "v": normal(ATTENTION, scale=0.3),
                  "o": normal(2 * HIDDEN, scale=0.3), "c": np.zeros(1, np.float32)}
        self.known = np.ones(WORDS, bool)
        for side in "fb":
            self.p["W" + side] = normal(d, 3 * HIDDEN, scale=0.3)
            self.p["U" + side] = normal(HIDDEN, 3 * HIDDEN, scale=0.3)
            self.p["b" + side] = np.zeros(3 * HIDDEN, np.float32)

    def row(self, t: Text) -> np.ndarray:
        return np.where(self.known[t.bucket], t.bucket, 0)

    def inputs(self, t: Text) -> np.ndarray:
        """The vector of each distinct word of ``t``."""
        if not len(t.keys):
            return np.zeros((1, WORD_DIM + GRAM_DIM), np.float32)
        grams = np.add.reduceat(self.p["grams"][t.gram], t.gram_at[:-1], axis=0)
        grams /= np.diff(t.gram_at)[:, None]
        return np.concatenate([self.p["words"][self.row(t)], grams], axis=1)

    def _layer(self, side: str, gates: np.ndarray, live: np.ndarray, keep: list | None) -> np.ndarray:
        """States (steps, windows, HIDDEN) for the input gates (words, 3 HIDDEN) picked by ``live``."""
        word, on = live
        n, steps = word.shape
        out = np.zeros((steps, n, HIDDEN), np.float32)
        h = np.zeros((n, HIDDEN), np.float32)
        for t in range(steps) if side == "f" else reversed(range(steps)):
            x, m = gates[word[:, t]], on[:, t, None]
            u = h @ self.p["U" + side]
            zr = _sigmoid(x[:, :2 * HIDDEN] + u[:, :2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            new = np.tanh(x[:, 2 * HIDDEN:] + r * u[:, 2 * HIDDEN:])
            if keep is not None:
                keep.append((t, h, z, r, new, u[:, 2 * HIDDEN:], m))
            h = np.where(m, new + z * (h - new), h)
            out[t] = h
        return out

    def scores(self, t: Text, inputs: np.ndarray, rows: np.ndarray | None = None,
               cache: dict | None = None) -> np.ndarray:
        """The logits of the windows ``rows`` (all by default)."""
        live = (t.word, t.live) if rows is None else (t.word[rows], t.live[rows])
        states, kept = [], {"f": [], "b": []}
        for side in "fb":
            gates = inputs @ self.p["W" + side] + self.p["b" + side]
            states.append(self._layer(side, gates, live, kept[side] if cache is not None else None))
        h = np.concatenate(states, axis=2)
        a = np.tanh(h @ self.p["A"])
        e = np.where(live[1].T, a @ self.p["v"], np.float32(-1e9))
        w = np.exp(e - e.max(axis=0))
        w /= w.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", w, h)
        if cache is not None:
            cache |= {"live": live, "kept": kept, "h": h, "a": a, "w": w, "pooled": pooled}
        return pooled @ self.p["o"] + self.p["c"][0]

    def gradients(self, t: Text, inputs: np.ndarray, cache: dict, d_logit: np.ndarray) -> dict:
        """Gradients of a loss whose derivative by the logits of the cached pass is ``d_logit``."""
        g = {"c": np.array([d_logit.sum()], np.float32), "o": cache["pooled"].T @ d_logit}
        h, a, w = cache["h"], cache["a"], cache["w"]
        d_pooled = d_logit[:, None] * self.p["o"]
        d_w = np.einsum("nh,tnh->tn", d_pooled, h)
        d_e = w * (d_w - (w * d_w).sum(axis=0))
        g["v"] = np.einsum("tn,tna->a", d_e, a)
        d_a = d_e[:, :, None] * self.p["v"] * (1 - a * a)
        g["A"] = np.einsum("tnh,tna->ha", h, d_a)
        d_h = w[:, :, None] * d_pooled + d_a @ self.p["A"].T
        word, on = cache["live"]
        d_in = np.zeros_like(inputs)
        for k, side in enumerate("fb"):
            d_out = d_h[:, :, k * HIDDEN:(k + 1) * HIDDEN]
            d_gates = np.zeros((len(inputs), 3 * HIDDEN), np.float32)
            d_u, carry = np.zeros_like(self.p["U" + side]), np.zeros((word.shape[0], HIDDEN), np.float32)
            for step, before, z, r, new, un, m in reversed(cache["kept"][side]):
                total = d_out[step] + carry
                now = np.where(m, total, 0)
                d_new = now * (1 - z) * (1 - new * new)
                d_z = now * (before - new) * z * (1 - z)
                d_r = d_new * un * r * (1 - r)
                x = np.concatenate([d_z, d_r, d_new], axis=1)
                u = np.concatenate([d_z, d_r, d_new * r], axis=1)
                np.add.at(d_gates, word[:, step], x)
                d_u += before.T @ u
                carry = np.where(m, now * z + u @ self.p["U" + side].T, total)
            g["W" + side], g["b" + side], g["U" + side] = inputs.T @ d_gates, d_gates.sum(axis=0), d_u
            d_in += d_gates @ self.p["W" + side].T
        g["words"] = np.zeros_like(self.p["words"])
        np.add.at(g["words"], self.row(t), d_in[:, :WORD_DIM])
        g["grams"] = np.zeros_like(self.p["grams"])
        size = np.diff(t.gram_at)
        np.add.at(g["grams"], t.gram, np.repeat(d_in[:, WORD_DIM:] / size[:, None], size, axis=0))
        return g


def train(texts: list[str], toxic: np.ndarray, epochs: int = 4, batch: int = 64, rate: float = 0.01,
          seed: int = 7, steps: int = 250) -> Network:
    """Fit a network to whole texts with 0/1 labels: logistic loss of the worst window, Adam; ``epochs``
    passes, or more on few texts, for about ``steps`` steps."""
    net, rng = Network(seed), np.random.default_rng(seed)
    epochs = max(epochs, -(-steps * batch // len(texts)))
    # in how many texts of each class a row of the word table occurs
    found = []
    for a in range(0, len(texts), 256):
        t = Text(pa.array(texts[a:a + 256], pa.string()))
        if len(t.owner):
            doc = np.repeat(t.owner, t.live.sum(axis=1)) + a
            found.append(np.unique(doc * WORDS + t.bucket[t.word[t.live]]))
    pair = np.concatenate(found) if found else np.empty(0, np.int64)
    label = toxic[pair // WORDS]
    ones = np.bincount(pair[label == 1] % WORDS, minlength=WORDS) + 0.5
    zeros = np.bincount(pair[label == 0] % WORDS, minlength=WORDS) + 0.5
    net.known = ones + zeros >= SELDOM + 1
    odds = np.log(ones / (toxic.sum() + 1)) - np.log(zeros / ((1 - toxic).sum() + 1))
    net.p["words"][:, 0] = net.known * np.clip(odds / np.sqrt(1 / ones + 1 / zeros) / 4, -2, 2)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for a in range(0, len(order), batch):
            pick = order[a:a + batch]
            t = Text(pa.array([texts[i] for i in pick], pa.string()))
            if not len(t.owner):
                continue
            inputs = net.inputs(t)
            logit = net.scores(t, inputs)
            # the worst window of each text: the last of its windows in order of (text, score)
            by = np.lexsort((logit, t.owner))
            rows = by[np.append(t.owner[by][1:] != t.owner[by][:-1], True)]
            cache: dict = {}
            p = _sigmoid(net.scores(t, inputs, rows, cache))
            d = (p - toxic[pick][t.owner[rows]]).astype(np.float32) / len(rows)
            step += 1
            lr = rate * (1 if epoch < epochs - 1 else 0.3)
            for k, g in net.gradients(t, inputs, cache, d).items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                net.p[k] -= (lr * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)
                             ).astype(np.float32)
    return net


def score_texts(texts: pa.Array, net: Network, at_once: int = 4096) -> np.ndarray:
    t = Text(texts)
    out = np.full(len(texts), -np.inf)
    inputs = net.inputs(t)
    for a in range(0, len(t.owner), at_once):
        rows = np.arange(a, min(a + at_once, len(t.owner)))
        np.maximum.at(out, t.owner[rows], net.scores(t, inputs, rows))
    return np.where(np.isinf(out), 0.0, _sigmoid(out))


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS,
                    max_bytes: int = TRAIN_BYTES) -> tuple[list[str], np.ndarray]:
    """At most ``per_class`` texts of each class that aren't held out, by hash of the id."""
    known = (labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    size = F.octet_length("text")
    pool = docs.select("doc_id", size.alias("size")).filter(size.between(1, max_bytes)).join(known, "doc_id")
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    texts, toxic = [], []
    for label in (0, 1):
        with scratch(docs.sparkSession):
            picked = written(pool.filter(F.col("toxic") == label).select("doc_id").distinct()
                             .orderBy(*by_hash).limit(per_class), "toxicity")
            # at most per_class ids: a bounded side, and a bounded number of texts for the driver
            got = (docs.filter(size.between(1, max_bytes)).join(F.broadcast(picked), "doc_id")
                   .groupBy("doc_id").agg(F.min("text").alias("text")).select("text").collect())
        texts += sorted(r.text for r in got)
        toxic += [label] * len(got)
    return texts, np.array(toxic, np.int64)


def fit(docs: DataFrame, labels: DataFrame) -> Network | None:
    texts, toxic = training_sample(docs, labels)
    return train(texts, toxic) if 0 < toxic.sum() < len(toxic) else None


def scored(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id_col>, score`` per row."""
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    schema = T.StructType([T.StructField(id_col, rows.schema["id"].dataType),
                           T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", 1 << 20):
            score = score_texts(batch.column("text"), net) if net else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(score, pa.float64())],
                                             names=schema.names)

    return rows.mapInArrow(run, schema)


def accepted(docs: DataFrame, net: Network | None, text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score below ``limit``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, text_col, 1 << 20):
            score = score_texts(batch.column(text_col), net) if net else np.zeros(batch.num_rows)
            yield batch.filter(pa.array(score < limit))

    return docs.mapInArrow(run, docs.schema)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    net = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored(docs, net).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
