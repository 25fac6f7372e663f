import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_data import EDGES, docs  # noqa: F401

from tempora.llm import toxicity as tox

SF = "/root/testdata/sf0.1"


def synthetic(n, seed):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(300)]
    texts, labels = [], []
    for i in range(n):
        t = [words[j] for j in rng.integers(0, 300, rng.integers(0, 200))]
        bad = i % 4 == 0 and bool(t)
        if bad:
            t[rng.integers(0, len(t))] = ["scum", "idiot!", "Moron"][i % 3]
        texts.append(" ".join(t))
        labels.append(int(bad))
    return texts, np.array(labels)


def test_gradients_equal_differences():
    net = tox.Network(3)
    for k, v in net.p.items():
        net.p[k] = v.astype(np.float64)
    t = tox.Text(pa.array(["some words here are few", "a b c d e f g " * 12]))
    inputs, cache = net.inputs(t), {}
    weight = np.arange(1, len(t.owner) + 1) / 3.0

    def loss():
        return float((net.scores(t, net.inputs(t)) * weight).sum())

    net.scores(t, inputs, np.arange(len(t.owner)), cache)
    grads = net.gradients(t, inputs, cache, weight)
    rng = np.random.default_rng(0)
    for k, g in grads.items():
        value = net.p[k]
        spots = np.flatnonzero(g.ravel())
        assert len(spots), k
        for at in rng.choice(spots, min(5, len(spots)), replace=False):
            at = np.unravel_index(at, value.shape)
            was = value[at]
            value[at] = was + 1e-3
            up = loss()
            value[at] = was - 1e-3
            down = loss()
            value[at] = was
            assert g[at] == pytest.approx((up - down) / 2e-3, rel=0.05, abs=2e-3), (k, at)


def test_windows_overlap_and_cover_every_word():
    for n in (1, 47, 48, 49, 72, 73, 500):
        t = tox.Text(pa.array([" ".join(f"w{i}" for i in range(n)), None, "", "..."]))
        assert t.n_words == n and set(t.owner.tolist()) == {0}
        seen = np.bincount(np.concatenate([np.arange(s * tox.STRIDE, min(s * tox.STRIDE + tox.WINDOW, n))
                                           for s in range(len(t.owner))]), minlength=n)
        assert seen.min() >= 1 and t.live.sum() == seen.sum()
        if n > 2 * tox.WINDOW:
            assert (seen[tox.STRIDE:n - tox.WINDOW] == 2).all()


def test_learns_words_and_ignores_batches():
    texts, labels = synthetic(600, 1)
    net = tox.train(texts, labels)
    new, truth = synthetic(200, 2)
    score = tox.score_texts(pa.array(new), net)
    assert ((score >= 0.5) == truth).mean() > 0.97
    alone = np.concatenate([tox.score_texts(pa.array([t]), net) for t in new])
    assert np.allclose(score, alone, atol=1e-5)
    assert np.array_equal(tox.train(texts, labels).p["words"], net.p["words"])


@pytest.mark.parametrize("net", [None, tox.Network(1)])
def test_edges(spark, docs, net):
    rows = tox.scored(docs(EDGES, "score id predicted"), net).collect()
    assert len(rows) == len(EDGES)
    assert all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in rows if r.doc_id in (3, 4, 5)} == {0.0}
    assert tox.scored(docs(EDGES).limit(0), net).count() == 0
    kept = tox.accepted(docs(EDGES, "score"), net, limit=2.0)
    assert kept.columns[-1] == "score" and kept.count() == len(EDGES)


def test_sample_is_bounded_and_leaves_the_test_rows_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    texts, toxic = tox.training_sample(docs, labels, per_class=50)
    assert (toxic == 0).sum() == (toxic == 1).sum() == 50
    held = {r.text for r in docs.join(labels, "doc_id").collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    apart = {r.text for r in docs.join(labels, "doc_id").collect() if zlib.crc32(str(r.doc_id).encode()) % 5 != 0}
    assert set(texts) <= apart and not set(texts) & (held - apart)
    assert all(len(t.encode()) <= tox.TRAIN_BYTES for t in texts)
    one = labels.filter("toxic = 1")
    assert tox.fit(docs, one) is None


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = tox.op10_toxicity(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(r.predicted == int(r.score >= 0.5) for r in rows)
    test = [(r, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == y for r, y in test]) > 0.96
    assert np.mean([r.predicted for r, y in test if y]) > 0.7
    assert np.mean([r.predicted for r, y in test if not y]) < 0.02


def plain_score(text, net):
    """The score of a text by loops over its windows, words, characters and gates."""
    import math
    import re

    from tempora.llm.common import BASE

    full = (1 << 64) - 1

    def mix(x):
        for _ in range(2):
            x ^= x >> 32
            x = x * 0xD6E8FEB86659FD93 & full
        return x ^ x >> 32

    def sigmoid(x):
        return 1 / (1 + math.exp(-x)) if x > -700 else 0.0

    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    words = re.findall(rb"[0-9a-z\x80-\xff]+", raw)
    p = {k: v.astype(float).tolist() for k, v in net.p.items() if k not in ("words", "grams")}
    vectors = []
    for w in words:
        key = mix(sum((b + 1) * pow(BASE, i, 1 << 64) for i, b in enumerate(w)) & full)
        row = 1 + key % (tox.WORDS - 1)
        row = row if net.known[row] else 0
        chars = [0, *[b + 1 for b in w], 0]
        grams = [mix((chars[i] << 18) + (chars[i + 1] << 9) + chars[i + 2]) % tox.GRAMS for i in range(len(w))]
        mean = [sum(float(net.p["grams"][g][k]) for g in grams) / len(grams) for k in range(tox.GRAM_DIM)]
        vectors.append([float(v) for v in net.p["words"][row]] + mean)
    if not words:
        return 0.0
    h_dim, best = tox.HIDDEN, -math.inf
    starts = range(0, max(1, len(words) - tox.WINDOW + tox.STRIDE), tox.STRIDE)
    for s in starts:
        window = vectors[s:s + tox.WINDOW]
        states = {}
        for side in "fb":
            h, out = [0.0] * h_dim, [None] * len(window)
            order = range(len(window)) if side == "f" else range(len(window) - 1, -1, -1)
            for t in order:
                x = [p["b" + side][j] + sum(window[t][i] * p["W" + side][i][j] for i in range(len(window[t])))
                     for j in range(3 * h_dim)]
                u = [sum(h[i] * p["U" + side][i][j] for i in range(h_dim)) for j in range(3 * h_dim)]
                new = []
                for j in range(h_dim):
                    z, r = sigmoid(x[j] + u[j]), sigmoid(x[h_dim + j] + u[h_dim + j])
                    c = math.tanh(x[2 * h_dim + j] + r * u[2 * h_dim + j])
                    new.append(c + z * (h[j] - c))
                h = new
                out[t] = h
            states[side] = out
        both = [states["f"][t] + states["b"][t] for t in range(len(window))]
        e = []
        for v in both:
            a = [math.tanh(sum(v[i] * p["A"][i][j] for i in range(2 * h_dim))) for j in range(tox.ATTENTION)]
            e.append(sum(x * y for x, y in zip(a, p["v"])))
        w = [math.exp(x - max(e)) for x in e]
        pooled = [sum(wt * v[i] for wt, v in zip(w, both)) / sum(w) for i in range(2 * h_dim)]
        best = max(best, sum(x * y for x, y in zip(pooled, p["o"])) + p["c"][0])
    return sigmoid(best)


def test_scores_equal_plain_loops():
    texts, labels = synthetic(120, 5)
    net = tox.train(texts, labels, steps=40)
    some = [*texts[:25], "", None, "...", "Ünïcode ÄÖ 123 scum!", " ".join(texts[:9]), "a" * 300]
    got = tox.score_texts(pa.array(some, pa.string()), net)
    for t, g in zip(some, got):
        assert g == pytest.approx(plain_score(t, net), abs=2e-5), t
    assert max(got) - min(got) > 0.2


def test_very_long_text_scores_as_its_worst_window(spark, docs):  # noqa: F811
    texts, labels = synthetic(200, 9)
    net = tox.train(texts, labels, steps=60)
    calm = " ".join(f"w{i % 300}" for i in range(40_000))
    at = calm.index(" ", len(calm) // 2)
    loud = calm[:at] + " scum idiot! Moron" * 6 + calm[at:]
    got = {r.doc_id: r.score for r in tox.scored(docs([(1, calm), (2, loud), (2, loud)]), net).collect()}
    assert got[2] > got[1] and got[2] >= max(tox.score_texts(pa.array(["scum idiot! Moron " * 6]), net)) * 0.5
    assert tox.scored(docs([(1, calm)]).limit(0), net).count() == 0
