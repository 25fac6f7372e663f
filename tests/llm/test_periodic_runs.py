import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from llm_data import EDGES, docs  # noqa: F401

from tempora.llm import periodic_runs as pr

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0D]+")


def brute_runs(w, least=24, times=3):
    """All runs by comparing every word with the one p further, for every p."""
    n, out, seen = len(w), [], {}
    number = np.array([seen.setdefault(x, len(seen)) for x in w])
    for p in range(1, n // times + 1):
        same = np.concatenate([[0], (number[p:] == number[:-p]).astype(int), [0]])
        up, down = np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1)
        for a, b in zip(up.tolist(), down.tolist()):
            length = b - a + p
            if length >= max(least, times * p):
                out.append((a, length, p))
    # a period is the smallest one: none of its stretch is the stretch of a divisor of it
    out = [r for r in out if not any(q[2] < r[2] and q[0] <= r[0] and q[0] + q[1] >= r[0] + r[1] for q in out)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def changed(doc_id, w):
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    n, g = len(w), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def expected(doc_id, text):
    w = changed(doc_id, WORD.findall(text or ""))
    runs = brute_runs(w)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, sha("".join(f"{s},{n},{p}\n" for s, n, p in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def by_id(rows):
    return sorted(rows, key=repr)


def test_lyndon_array_of_all_short_texts():
    def longest(s, i):
        def is_lyndon(u):
            return all(u < u[k:] for k in range(1, len(u)))
        return max(k for k in range(1, len(s) - i + 1) if is_lyndon(s[i:i + k]))

    rng = np.random.default_rng(1)
    for _ in range(400):
        texts = [rng.integers(0, rng.integers(1, 5), rng.integers(1, 14)).tolist() for _ in range(3)]
        flat = [x for t in texts for x in t]
        ranks = np.unique(flat, return_inverse=True)[1].tolist()
        first = [i == 0 for t in texts for i in range(len(t))]
        want = [longest(tuple(t), i) for t in texts for i in range(len(t))]
        assert list(pr.lyndon(ranks, first)) == want, texts


@pytest.mark.parametrize("least,times", [(2, 2), (6, 2), (6, 3), (24, 3)])
def test_runs_equal_all_comparisons(least, times):
    rng = np.random.default_rng(least)
    for k in range(150):
        texts = []
        for _ in range(rng.integers(1, 5)):
            parts = []
            for _ in range(rng.integers(0, 6)):
                piece = rng.integers(0, rng.integers(1, 9), rng.integers(1, 12)).tolist()
                parts += (piece * int(rng.integers(1, 12)))[:rng.integers(1, 80)]
            texts.append(parts)
        flat = np.array([x for t in texts for x in t], np.int64)
        edge = np.cumsum([0] + [len(t) for t in texts])
        got = list(zip(*(v.tolist() for v in pr.runs_in(flat, edge[np.append(np.diff(edge) > 0, True)], least, times))))
        want = [(e + s, n, p) for e, t in zip(edge, texts) for s, n, p in brute_runs(t, least, times)]
        assert got == want, texts


def test_collision_of_hashes_is_noticed(monkeypatch):
    w = np.array([1, 2, 3] * 9 + [7, 8, 9] + [1, 2, 3] * 10)
    edge = np.array([0, len(w)])
    want = [tuple(r) for r in brute_runs(w.tolist())]
    real = pr.slice_hashes
    for tries in (1, 2):  # the first base, then both, take all slices for equal
        bad = set(pr._BASES[:tries])
        now = []
        monkeypatch.setattr(pr, "prefix_hashes", lambda v, base: now.append(base) or (v, base))
        monkeypatch.setattr(pr, "slice_hashes", lambda prefix, a, b: np.zeros(len(a)) if prefix[1] in bad
                            else real(real_prefix(prefix[0], prefix[1]), a, b, prefix[1]))
        assert list(zip(*(v.tolist() for v in pr.runs_in(w, edge, 24, 3)))) == want
        assert now == list(pr._BASES[:2][:tries + 1])


def real_prefix(v, base):
    from tempora.llm.common import prefix_hashes
    return prefix_hashes(v, base)


def test_rows_equal_brute_force(spark, docs):  # noqa: F811
    rng = np.random.default_rng(3)
    rows = []
    for i in range(400):
        w = [f"w{x}" for x in rng.integers(0, 30, rng.integers(0, 120))]
        for _ in range(rng.integers(0, 4)):
            piece = [f"ü{x}" for x in rng.integers(0, 3, rng.integers(1, 15))]
            w += (piece * 9)[:rng.integers(1, 100)] + ["x"] * int(rng.integers(0, 2))
        rows.append((i, "\n \t".join(w)))
    got = pr.digests(pr.periodic_runs(docs(rows).repartition(3), plant=True)).collect()
    assert by_id(tuple(r) for r in got) == by_id(expected(*r) for r in rows)
    assert sum(r.n_runs for r in got) > 300


def test_edge_rows(spark, docs):  # noqa: F811
    long = " ".join(f"w{i}" for i in range(3000)) + " a b" * 3000
    rows = [r for r in EDGES if len(r[1] or "") < 1000] + [(9, long), (9, long), (None, "a " * 50)]
    df = docs(rows, extra="runs collapsed id start")
    got = pr.digests(pr.periodic_runs(df, plant=True)).collect()
    assert by_id(tuple(r) for r in got) == by_id(expected(*r) for r in rows)
    assert pr.digests(pr.periodic_runs(df.limit(0), plant=True)).count() == 0
    kept = {r.doc_id: r for r in pr.periodic_runs(docs([(1, "x  y " * 12 + "z")])).collect()}
    assert [tuple(r) for r in kept[1].runs] == [(0, 24, 2)] and kept[1].collapsed == "x y z"


def test_query_on_the_whole_table(spark):
    got = [tuple(r) for r in pr.op13_periodic_runs(spark, SF).collect()]
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert by_id(got) == by_id(expected(*r) for r in table)
