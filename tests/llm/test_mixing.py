import re
from collections import defaultdict

import pytest
from llm_data import EDGES, docs  # noqa: F401

from tempora.llm.mixing import copies, mixed, op9_mixing, targets

SF = "/root/testdata/sf0.01"


def water(sizes, weights=(3.0, 1.0, 2.0), share=1.5, cap=2.0):
    """Share by weight, give the excess over the caps to the others, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, got, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        level = total / sum(w[s] for s in open_)
        over = {s for s in open_ if w[s] * level > cap * sizes[s]}
        if not over:
            return got | {s: w[s] * level for s in open_}
        for s in over:
            got[s] = cap * sizes[s]
            total -= got[s]
        open_ -= over
    return got


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 500, "c": 7, "d": 90, None: 1000}, {"z": 3}, {"a": 0, "b": 5},
                                   {"é": 100, "z": 1, "a": 10_000, "b": 10, "c": 20, "d": 1, "e": 3}])
def test_targets_equal_the_loop(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in targets(df).collect()}
    assert got == pytest.approx(water(sizes))


def test_mix_comes_near_its_targets_and_repeats(spark):
    rows = op9_mixing(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    taken, target, largest = defaultdict(int), {}, defaultdict(int)
    for r in rows:
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
        s = source[r.doc_id]
        taken[s] += r.taken
        target[s] = r.target
        largest[s] = max(largest[s], r.size)
    for s in target:  # the last residual alone is rounded
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1
    assert abs(sum(taken.values()) / sum(target.values()) - 1) < 0.01
    assert sorted(rows) == sorted(op9_mixing(spark, SF).collect())


def test_every_bin_size_keeps_the_sum(spark):
    from pyspark.sql import functions as F

    from tempora.llm.mixing import rounded

    items = spark.range(700).select(F.lit("s").alias("source"), F.lit(700).alias("n"),
                                    F.xxhash64("id").alias("u"), F.lit(0.3).alias("p"),
                                    (F.col("id") % 13 + 1).alias("size"))
    size = {r.u: r.size for r in items.collect()}
    for bins in (2, 7, 64, 1000):
        got = rounded(items, bins).collect()
        assert sorted(r.u for r in got) == sorted(size)
        assert abs(sum(r.take * size[r.u] for r in got) - 0.3 * sum(size.values())) <= 6.5


def test_mixed_rows(spark, docs):
    rows = [(i, " ".join(["w"] * (i % 7)), "ab"[i % 2]) for i in range(200)] + [(5, "w w w w w", "b")] * 3
    df = docs(rows, "llm_key copies rep")
    out = mixed(df)
    assert out.columns == df.columns
    many = defaultdict(int)
    for r in out.collect():
        many[r.doc_id] += 1
    assert max(v for k, v in many.items() if k != 5) <= 2 and many[5] <= 8
    words = sum(len(re.findall(r"\S+", r.text)) for r in out.collect())
    assert words == pytest.approx(1.5 * sum(len(t.split()) for _, t, _ in rows), rel=0.05)


def test_edges(spark, docs):
    out = mixed(docs(EDGES)).collect()
    assert {r.doc_id for r in out} <= {i for i, _ in EDGES}
    df = docs(EDGES).selectExpr("doc_id", "xxhash64(text) AS text_key", "source", "cast(3 as long) AS size")
    assert copies(df).count() == len(EDGES)
    assert copies(df.limit(0)).count() == 0
    assert mixed(docs(EDGES).limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = op9_mixing(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
