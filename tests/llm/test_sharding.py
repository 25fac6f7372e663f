import zlib
from collections import defaultdict

import numpy as np
import pytest
from llm_data import EDGES, docs  # noqa: F401

from tempora.llm.sharding import Runs, minimax_cuts, op4_sharding, sharded

SF = "/root/testdata/sf0.01"


def smallest(sizes, k):
    low, high = max(max(sizes), -(-sum(sizes) // k)), sum(sizes)
    while low < high:
        mid = (low + high) // 2
        n, x = 1, 0
        for s in sizes:
            if x + s > mid:
                n, x = n + 1, 0
            x += s
        low, high = (low, mid) if n <= k else (mid + 1, high)
    return low


@pytest.mark.parametrize("n,hot,pieces", [(300, 0, 20), (300, 0.3, 20), (40, 0.05, 5), (10, 0, 100), (1, 0, 5)])
def test_capacity_is_the_smallest(spark, n, hot, pieces):
    rng = np.random.default_rng(n)
    sizes = rng.integers(8, 4000, n)
    if hot:
        sizes[n // 3] = int(sizes.sum() * hot)
    df = spark.createDataFrame([(i, int(s)) for i, s in enumerate(sizes)], "g long, bytes long")
    capacity, cuts = minimax_cuts(df, n, 24, pieces)
    assert capacity == smallest(sizes.tolist(), 24)
    edges = [0, *cuts, n]
    assert len(cuts) == 23 and edges == sorted(edges)
    assert max(int(sizes[a:b].sum()) for a, b in zip(edges, edges[1:])) <= capacity


def test_query(spark):
    rows = op4_sharding(spark, SF).collect()
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(text)
    shard, slots, size = defaultdict(set), defaultdict(list), defaultdict(int)
    for r in rows:
        raw = text[r.doc_id].encode()
        assert r.size == len(raw) + 8 and r.text_crc32 == zlib.crc32(raw)
        assert r.law == "bytes" and r.grown_shard is None
        shard[text[r.doc_id]].add(r.shard)
        slots[r.shard].append(r.slot)
        size[r.shard] += r.size
    assert all(len(s) == 1 for s in shard.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sorted(size) == list(range(24)) and max(size.values()) < 1.1 * sum(size.values()) / 24


def test_edges(spark, docs):
    rows = sharded(docs(EDGES, "shard slot size digest g")).collect()
    assert len(rows) == len(EDGES)
    per = defaultdict(list)
    for r in rows:
        per[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in per.values())
    assert {r.shard for r in rows if r["size"] == 8} == {next(r.shard for r in rows if r.doc_id == 3)}
    assert sharded(docs(EDGES).limit(0)).count() == 0


def test_divisible_runs_reach_further():
    runs = Runs(np.array([0, 5, 10]), np.array([50, 50]))
    assert runs.reach(0, 70, True) == 70 and runs.reach(0, 70, False) == 50
