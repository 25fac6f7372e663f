import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_data import EDGES, docs  # noqa: F401

from tempora.llm import quality as q

SF = "/root/testdata/sf0.1"


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def plain_features(text):
    """Indicators of a text by plain loops, as tuples."""
    def cls(b):
        return 1 if 65 <= b <= 90 else 2 if 97 <= b <= 122 else 3 if 48 <= b <= 57 else 4 if b > 127 else 5

    raw = (text or "").encode()
    found = {("c", raw[i:i + 3]) for i in range(len(raw) - 2)}
    w = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    shape = []
    for i, x in enumerate(w):
        tail = x[-1] if cls(x[-1]) == 5 else 0
        tail2 = x[max(len(x) - 2, 0)] if tail and cls(x[max(len(x) - 2, 0)]) == 5 else 0
        shape.append((tail, tail2, cls(x[0]), cls(x[min(1, len(x) - 1)]), i > 0 and w[i - 1] == x))
    found |= {("w", x) for x in w} | {("p", *w[i:i + 2]) for i in range(len(w) - 1)}
    found |= {("s", *shape[i:i + 2]) for i in range(len(w) - 1)}
    return found | {("t", *shape[i:i + 3]) for i in range(len(w) - 2)}


TEXTS = ["Aé b!! b!! 12", "x", "", None, " \t ", "a b c a b c", "the the the", "ab", "漢字 !? !?"]


def test_features_are_those_of_plain_loops():
    of, feature = q.features(pa.array(TEXTS, pa.string()))
    place = {}
    for i, t in enumerate(TEXTS):
        mine = set(feature[of == i].tolist())
        plain = plain_features(t)
        assert len(mine) == len(plain), t  # no two of so few fall on one place
        for k in plain:
            place.setdefault(k, []).append(mine)
    for k, texts in place.items():
        common = set.intersection(*texts)
        assert common, k  # an indicator has one place in all texts that have it


def problem(n=120, seed=0):
    rng = np.random.default_rng(seed)
    label = rng.integers(0, 2, n)
    label[:2] = 0, 1
    rows = [np.unique(np.concatenate([rng.integers(0, 60, 12), rng.integers(100, 130, 3) + 40 * y])).astype(np.int32)
            for y in label]
    return rows, label


def test_ratios_equal_counts():
    rows, label = problem()
    got = q.ratios(rows, label)
    for f in (3, 105, 150, 9999):
        p = [q.SMOOTHING + sum(f in r for r, y in zip(rows, label) if y == k) for k in (0, 1)]
        size = [q.SMOOTHING * q.FEATURES + sum(len(r) for r, y in zip(rows, label) if y == k) for k in (0, 1)]
        assert got[f] == pytest.approx(np.log(p[1] / size[1] / (p[0] / size[0])), rel=1e-5)


def test_descent_reaches_the_least_loss():
    rows, label = problem()
    rng = np.random.default_rng(1)
    values = [rng.normal(size=len(r)) / 3 for r in rows]
    cost = np.full(len(rows), 0.7)
    w, bias = q.descend(rows, values, label, cost, epochs=3000, tolerance=1e-9)
    y = np.where(label == 1, 1.0, -1.0)

    def primal(w, bias):
        m = np.array([v @ w[r] + bias for r, v in zip(rows, values)])
        return (w @ w + bias * bias) / 2 + float(cost @ np.maximum(0, 1 - y * m))

    best = primal(w, bias)
    for _ in range(300):  # the problem is convex: nothing near is better
        d = np.zeros(q.FEATURES)
        d[:200] = rng.normal(size=200) * 10.0 ** rng.uniform(-5, -1)
        assert primal(w + d, bias + rng.normal() * 1e-3) >= best - 1e-9
    alpha_bound = sum(cost)  # weak duality: the loss of nothing is above
    assert best <= alpha_bound


def test_curve_is_of_greatest_likelihood():
    rng = np.random.default_rng(2)
    margin = rng.normal(size=500)
    label = (rng.random(500) < 1 / (1 + np.exp(-(3 * margin + 1)))).astype(int)
    weigh = np.array([2.0, 0.5])
    slope, shift = q.logistic_curve(margin, label, weigh)
    many = np.bincount(label)
    t = np.where(label == 1, (many[1] + 1) / (many[1] + 2), 1 / (many[0] + 2))

    def loss(a, b):
        z = a * margin + b
        return float(weigh[label] @ (np.logaddexp(0, z) - t * z))

    assert all(loss(slope + a, shift + b) >= loss(slope, shift) for a in (-.01, 0, .01) for b in (-.01, 0, .01))


def test_scores_equal_plain_sums():
    rows, label = problem()
    model = q.train(rows, label, np.array([50.0, 500.0]))
    rng = np.random.default_rng(8)
    model = q.Model(rng.normal(size=q.FEATURES).astype(np.float32), rng.random(q.FEATURES).astype(np.float32), 0.25,
                    model.slope, model.shift)
    texts = pa.array(TEXTS, pa.string())
    got = model.scores(texts)
    of, feature = q.features(texts)
    for i in range(len(TEXTS)):
        total, square = 0.0, 0.0
        for f in feature[of == i].tolist():
            total += float(model.weight[f])
            square += float(model.square[f])
        margin = total / (square ** 0.5 or 1.0) + 0.25
        assert got[i] == pytest.approx(1 / (1 + np.exp(-(model.slope * margin + model.shift))), rel=1e-9)
        # alone or beside others, a text scores the same
        assert model.scores(texts.slice(i, 1))[0] == pytest.approx(got[i], rel=1e-12)


def test_held_out_labels_are_never_used(spark, docs):  # noqa: F811
    texts = [(i, f"good text number {i} of some words" if i % 2 else f"bad%% text$$ {i}&& of## words%%")
             for i in range(200)]
    held = {i for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2}
    good = [(i, i % 2, 0) for i in range(200)]
    lies = [(i, y if i not in held else 1 - y, 1) for i, y, _ in good]
    results = []
    for rows in (good, lies):
        model = q.fit(docs(texts), labels_of(spark, rows))
        results.append({r.doc_id: r.score for r in q.scored(docs(texts), model).collect()})
    assert results[0] == results[1]
    assert all((results[0][i] >= 0.7) == (i % 2 == 1) for i in range(200))


def test_edge_rows(spark, docs):  # noqa: F811
    extra = [(100 + i, "fine words stand here " * (1 + i % 3)) for i in range(20)]
    extra += [(200 + i, "bad%%% stuff!!! " * (1 + i % 4)) for i in range(20)]
    df = docs(EDGES + extra, extra="quality toxic score id row")
    lab = labels_of(spark, [(r[0], int(r[0] < 200), 0) for r in extra]
                    + [(100, 0, None), (None, 1, 1), (5, None, None), (6, 7, 0), (999, 1, 1)])
    model = q.fit(df, lab)
    got = q.scored(df, model).collect()
    assert len(got) == len(EDGES) + len(extra) and all(0 <= r.score <= 1 for r in got)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add(r.score)
    assert len(by[2]) == 1 and by[3] == by[4]  # repeated rows; null and empty
    assert q.scored(df.limit(0), model).count() == 0
    # labels of one class, or none
    for rows, want in (([(100 + i, 1, 0) for i in range(20)], 1.0),
                       ([(100 + i, 0, 0) for i in range(20)], 0.0), ([], 1.0)):
        m = q.fit(df, labels_of(spark, rows))
        assert {round(r.score, 6) for r in q.scored(df, m).collect()} == {want}
    assert q.fit(df.limit(0), lab).scores(pa.array(["x"]))[0] > 0.99


def test_query_finds_poor_texts(spark):
    got = q.op12_quality(spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    lab = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    held = got.filter("held_out").join(lab, "doc_id").toPandas()
    assert (held.predicted == (held.score >= 0.7)).all()
    right = held.predicted == held.quality
    assert right[held.quality == 0].mean() > 0.95 and right[held.quality == 1].mean() > 0.99
    for r in got.select("doc_id", "held_out").limit(200).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
