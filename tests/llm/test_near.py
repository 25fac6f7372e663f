"""Jaccard and vector joins against comparing everything."""

import random
from collections import Counter

import numpy as np
import pytest
from llm_data import EDGES, docs  # noqa: F401

from tempora.llm import embedding_dedup, jaccard_join


def shingles(text, k=5):
    w = [x for x in (text or "").replace("\t", " ").replace("\n", " ").split(" ") if x]
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def classes(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


def brute(rows, threshold=0.8):
    sets = [shingles(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
             and len(sets[i] & sets[j]) * 1000 >= round(threshold * 1000) * len(sets[i] | sets[j])]
    many = Counter(x for p in links for x in p)
    part = classes(len(rows), links)
    name = {}
    for k, (i, _) in enumerate(rows):
        ids = [rows[m][0] for m in range(len(rows)) if part[m] == part[k] and rows[m][0] is not None]
        name[k] = min(ids) if ids else None
    return sorted((str(i), str(name[k]), many[k]) for k, (i, _) in enumerate(rows)), links


def near_copies(n_groups=12, size=8, long=300):
    rng = random.Random(4)
    rows = []
    for g in range(n_groups):
        base = [f"{rng.randrange(3000)}" for _ in range(rng.randint(6, long))]
        for _ in range(size):
            t = list(base)
            for _ in range(rng.randint(0, max(1, len(t) // 60))):
                t[rng.randrange(len(t))] = f"n{rng.randrange(10 ** 6)}"
            rows.append((len(rows) * 7 % 1000, " ".join(t)))
    return rows


def result(df):
    return sorted((str(r.id), str(r.class_id), r.n_links) for r in df.collect())


def test_links_equal_brute_force(spark, docs):
    rows = near_copies()
    want, links = brute(rows)
    assert len(links) > 100
    assert result(jaccard_join.near_duplicates(docs(rows))) == want


def test_large_buckets_are_split_and_lose_no_link(spark, docs, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BUCKET", 4)
    monkeypatch.setattr(jaccard_join.buckets, "__defaults__", (4,))
    rows = near_copies(3, 25)
    assert result(jaccard_join.near_duplicates(docs(rows))) == brute(rows)[0]


def test_split_buckets_of_unlike_sets_keep_their_near_copies(spark, docs, monkeypatch):
    monkeypatch.setattr(jaccard_join, "ALIKE", 2)
    monkeypatch.setattr(jaccard_join.buckets, "__defaults__", (1,))  # all buckets are split to the end
    line = " ".join(f"all{i}" for i in range(27))  # 23 of the 45 shingles of every text: a similarity of 0.34
    rows = []
    for g in range(1000):  # 40 common shingles of 50 in a pair
        own = " ".join(f"g{g}w{i}" for i in range(17))
        rows += [(2 * g + k, f"{line} {own} " + " ".join(f"g{g}k{k}w{i}" for i in range(5))) for k in (0, 1)]
    got = {r.id: (r.class_id, r.n_links) for r in jaccard_join.near_duplicates(docs(rows)).collect()}
    assert {i: v for i, v in got.items() if v != (i - i % 2, 1)} == {}


def test_chance_to_miss_a_pair():
    rng = np.random.default_rng(5)
    lost = {4: 0, 8: 0, 12: 0}
    n = 2000
    for _ in range(2):  # pairs whose min-hashes are equal with a chance of 0.8 each
        a = rng.integers(0, 2 ** 32, (n, 128), dtype=np.uint32)
        b = np.where(rng.random((n, 128)) < 0.8, a, a + np.uint32(1))
        row, path = jaccard_join.roots(n)
        row, path = row.astype(np.int32), path.copy()
        for depth in lost:
            if depth > 4:
                row, path = jaccard_join.reruns(row, path)
            mine, other = jaccard_join.descend(a, row, path), jaccard_join.descend(b, row, path)
            # nodes are told apart by the pair, too
            key = [jaccard_join.mix64(p ^ jaccard_join.mix64(r.astype(np.uint64))) for r, p in (mine, other)]
            met = np.isin(key[0], key[1])
            row, path = mine[0][met], mine[1][met]  # a node that one of them alone is at is lost for good
            lost[depth] += n - len(np.unique(row))
    assert max(lost.values()) <= 3  # of 4,000; one run in a split bucket loses 6 and 40
    chances = [jaccard_join.miss_chance(0.8, d, jaccard_join.AGAIN) for d in lost]
    assert sorted(chances) == chances and chances[-1] <= jaccard_join.MISS
    assert jaccard_join.miss_chance(0.8, 12, 1) > 0.01


def test_edges(spark, docs):
    df = docs(EDGES, "id th class_id n_links c path")
    assert result(jaccard_join.near_duplicates(df)) == brute(EDGES)[0]
    out = jaccard_join.deduplicated(df)
    assert out.columns == df.columns
    kept = sorted((str(r.doc_id), r.text) for r in out.collect() if (r.text or "").strip())
    assert kept == sorted((str(i), t) for i, t in {(1, "a b c"), *EDGES[7:9], (8, "a b d")})
    assert sum(not (r.text or "").strip() for r in out.collect()) == 4  # nothing to compare: they stay
    assert jaccard_join.near_duplicates(df.limit(0)).count() == 0


def test_min_hashes_estimate_the_similarity():
    rng = np.random.default_rng(0)
    common, a, b = (rng.integers(0, 2 ** 63, n).astype(np.uint64) for n in (400, 50, 50))
    m = jaccard_join.min_hashes(np.concatenate([common, a, common, b]), np.array([450, 450]))
    assert abs((m[0] == m[1]).mean() - 0.8) < 0.12


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def vectors(n=400, dim=24, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for i in range(60, 200):  # around earlier ones, at about the threshold
        x[i] = x[i % 60] + rng.normal(size=dim) * rng.choice([0.1, 0.25, 0.35])
    x[200] = x[10]
    x[201] = x[10] * 3
    return x, (np.arange(n) % 60 % 5).astype(int)


def test_vectors_equal_brute_force(spark):
    x, label = vectors()
    rows = [(i * 3, [float(v) for v in x[i]], int(label[i])) for i in range(len(x))]
    bad = [(2001, None, 1), (2002, [], 1), (2003, [0.0] * 24, 1), (2004, [float("nan")] + [1.0] * 23, 1),
           (2005, [None] + [1.0] * 23, 1), (2006, rows[0][1], None), (2007, [1.0, 2.0], 1),
           (2008, [float("inf")] + [1.0] * 23, 1), (2009, [0.0] * 24, 1), (2010, None, 1)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(df).collect()}
    near = (unit(x) @ unit(x).T >= 0.93) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    part = classes(len(x), list(zip(*np.nonzero(near))))
    assert near.sum() > 200
    for i in range(len(x)):
        assert got[i * 3] == (near[i].sum(), part[i] * 3, part[i] == i)
    for i, *_ in bad:
        assert got[i] == (0, i, True)


def test_blocks_of_a_large_filter(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup.links, "__defaults__", (0.93, 48, 16, 6))
    rng = np.random.default_rng(1)
    x = rng.normal(size=16) + rng.normal(size=(90, 16)) * 0.1
    df = spark.createDataFrame([(i, [float(v) for v in x[i]], 1) for i in range(90)],
                               "vec_id long, embedding array<double>, label int")
    near = unit(x) @ unit(x).T >= 0.93
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(df).collect()}
    assert [got[i] for i in range(90)] == (near.sum(axis=1) - 1).tolist()
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_repeated_rows_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], 1, "x"), (1, [1.0, 2.0], 1, "y"), (0, [1.0, 2.01], 1, "z")],
                               "vec_id long, embedding array<float>, label int, n_links string")
    got = [(r.vec_id, r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(df).collect()]
    assert sorted(got) == [(0, 2, 0), (1, 2, 0), (1, 2, 0)]


def test_decoding_finds_all_exceeding_filters():
    code = embedding_dedup.ProductCode(12, 16, 40)
    x = unit(np.random.default_rng(3).normal(size=(20, 12)))
    row, got = code.decode(x)
    turned = x @ code.rotation
    a, b, c = (turned[:, s:e] @ book.T for book, s, e in zip(code.books, code.edges, code.edges[1:]))
    total = a[:, :, None, None] + b[:, None, :, None] + c[:, None, None, :]
    want = np.argwhere(total.reshape(20, -1) >= code.threshold - 1e-12)
    assert sorted(zip(row.tolist(), got.tolist())) == sorted(map(tuple, want.tolist()))


@pytest.mark.parametrize("i,j,want", [([0, 1], [1, 2], 1), ([0, 3], [1, 4], 2)])
def test_spanning_forest(i, j, want):
    from tempora.llm.common import spanning_edges

    tree = spanning_edges(5, np.array(i), np.array(j))
    assert len(tree) == 2 and len(set(classes(5, tree))) == 3 and want


def test_components_of_a_chain_and_a_star(spark):
    from tempora.llm.common import components

    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**dict.fromkeys(range(51), 0), **dict.fromkeys(range(100, 160), 100)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("words", [16, 95, 97])
def test_vectors_of_one_component_share_filters(words):
    row, code = embedding_dedup.ProductCode(1, words).decode(np.array([[1.0], [-1.0]]))
    of = [set(code[row == i].tolist()) for i in (0, 1)]
    assert of[0] and of[1] and not of[0] & of[1]


def test_one_component(spark):
    df = spark.createDataFrame([(1, [2.0], 1), (2, [-1.0], 1), (3, [0.5], 1), (4, [0.0], 1), (5, [1.0], 2)],
                               "vec_id long, embedding array<double>, label int")
    got = sorted(tuple(r) for r in embedding_dedup.near_duplicates(df).collect())
    assert got == [(1, 1, 1, True), (2, 0, 2, True), (3, 1, 1, False), (4, 0, 4, True), (5, 0, 5, True)]


def test_thresholds_that_the_search_is_not_made_for_are_refused():
    from tempora.llm import embedding_dedup, jaccard_join

    with pytest.raises(ValueError, match="0.8"):
        jaccard_join.near_duplicates(None, threshold=0.5)
    with pytest.raises(ValueError, match="0.93"):
        embedding_dedup.near_duplicates(None, threshold=0.9)
