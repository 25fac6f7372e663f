"""Suffix and substring deduplication against counting every window."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from llm_data import EDGES, docs  # noqa: F401

from tempora.llm import anchors, substring_dedup, suffix_dedup


def brute(texts, window, cut, join):
    parts = [cut((t or "").encode()) for t in texts]
    seen = Counter(bytes(p[s:s + window]) if isinstance(p, bytes) else tuple(p[s:s + window])
                   for p in parts for s in range(len(p) - window + 1))
    out = []
    for p in parts:
        gone = bytearray(len(p))
        for s in range(len(p) - window + 1):
            key = bytes(p[s:s + window]) if isinstance(p, bytes) else tuple(p[s:s + window])
            if seen[key] > 1:
                gone[s:s + window] = b"\1" * window
        kept = join([x for x, g in zip(p, gone) if not g])
        out.append((len(p), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def by_bytes(texts, window):
    return brute(texts, window, bytes, bytes)


def by_words(texts, window):
    return brute(texts, window, lambda b: re.findall(rb"[^\x20\x09-\x0D]+", b), b" ".join)


def corpus(seed, n=60):
    """Texts with shared passages, near copies, periodic parts and exact copies."""
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdefgh" for b in ("", "x", "yz", "é")]

    def text(k):
        return [rng.choice(words) for _ in range(k)]

    shared = [text(rng.randint(20, 90)) for _ in range(4)]
    out = []
    for _ in range(n):
        t = text(rng.randint(0, 120))
        kind = rng.random()
        if kind < 0.4:
            at = rng.randint(0, len(t))
            t[at:at] = rng.choice(shared)
        elif kind < 0.6 and out:
            t = rng.choice(out).split(" ")
            for _ in range(3):
                t[rng.randrange(len(t))] = rng.choice(words)
        elif kind < 0.7:
            t += ["q"] * rng.randint(1, 200)
        elif kind < 0.75 and out:
            t = rng.choice(out).split(" ")
        out.append((" " if rng.random() < 0.8 else " ").join(t))
    return out


@pytest.mark.parametrize("seed,group", [(1, 4096), (2, 4096), (3, 2)])
def test_bytes_equal_brute_force(spark, docs, monkeypatch, seed, group):
    monkeypatch.setattr(anchors.repeated, "__defaults__", (group,))  # 2: all through single windows
    texts = corpus(seed)
    got = suffix_dedup.without_repeats(docs(list(enumerate(texts))), 40, 8).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == by_bytes(texts, 40)
    assert sum(r.n_removed for r in got) > 1000


@pytest.mark.parametrize("seed,group", [(1, 4096), (2, 4096), (3, 2)])
def test_words_equal_brute_force(spark, docs, monkeypatch, seed, group):
    monkeypatch.setattr(anchors.repeated, "__defaults__", (group,))
    texts = corpus(seed)
    got = substring_dedup.without_repeats(docs(list(enumerate(texts))), 12, 3).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_removed, r.kept_sha256) for r in got] == \
        [(a, b, d) for a, b, _, d in by_words(texts, 12)]
    assert sum(r.n_removed for r in got) > 300


@pytest.mark.parametrize("op", ["bytes", "words"])
def test_queries_equal_brute_force(spark, op):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    texts = [r.text for r in rows]
    if op == "bytes":
        got = suffix_dedup.op1_suffix_dedup(spark, sf).orderBy("doc_id").collect()
        assert [tuple(r)[1:] for r in got] == by_bytes(texts, 200)
    else:
        got = substring_dedup.op6_substring_dedup(spark, sf).orderBy("doc_id").collect()
        assert [tuple(r)[1:] for r in got] == [(a, b, d) for a, b, _, d in by_words(texts, 35)]


def test_edges(spark, docs):
    df = docs(EDGES, "id th runs spans piece")
    texts = [t for _, t in EDGES]
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                 for r in suffix_dedup.without_repeats(df, 4, 2).drop("kept").collect())
    assert got == sorted((str(i), *x) for (i, _), x in zip(EDGES, by_bytes(texts, 4)))
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256)
                 for r in substring_dedup.without_repeats(df, 3, 1).drop("kept").collect())
    assert got == sorted((str(i), a, b, d) for (i, _), (a, b, _, d) in zip(EDGES, by_words(texts, 3)))
    assert suffix_dedup.without_repeats(df.limit(0)).count() == 0
    assert substring_dedup.without_repeats(df.limit(0)).count() == 0


def test_repeated_ids_with_other_texts(spark, docs):
    rows = [(1, "abcdefgh" * 2), (1, "xyz"), (1, "abcdefgh"), (None, "abcdefgh!")]
    got = sorted((r.n_bytes, r.n_removed) for r in suffix_dedup.without_repeats(docs(rows), 8, 3).collect())
    assert got == [(3, 0), (8, 8), (9, 8), (16, 16)]


def test_suffix_order_equals_sorting():
    rng = np.random.default_rng(5)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    at = rng.integers(0, 2900, 500)
    length = rng.integers(0, 90, 500)
    group = np.sort(rng.integers(0, 40, 500))
    order, agree = suffix_dedup.suffix_order(data, at, length, group)
    cut = [bytes(data[a:a + n]) for a, n in zip(at, length)]
    assert [(group[i], cut[i]) for i in order] == sorted((g, c) for g, c in zip(group, cut))
    for k in range(1, 500):
        i, j = order[k - 1], order[k]
        if group[i] == group[j]:
            same = next((n for n, (x, y) in enumerate(zip(cut[i], cut[j])) if x != y), min(len(cut[i]), len(cut[j])))
            assert agree[k] == same


def test_a_lying_hash_is_noticed():
    """Modulo 2**64, strings of the Thue-Morse kind of over 1,024 signs collide for every odd base."""
    def thue(n):
        return np.array([bin(i).count("1") & 1 for i in range(n)], np.uint8)

    data = np.concatenate([thue(2048), 1 - thue(2048)])
    at, length, group = np.array([0, 2048]), np.array([2048, 2048]), np.zeros(2, np.int64)
    suffixes = suffix_dedup.Suffixes(data, at, length, suffix_dedup.BASE)
    assert suffixes.agreements(np.array([0, 1]), group) is None or suffixes.common(at[:1] * 0, at[:1] * 0 + 1)[0] == 0


def test_backward_search_counts_occurrences():
    rng = np.random.default_rng(3)
    body = rng.integers(1, 5, 400)
    text = np.concatenate([body[:150], [0], body[150:], [0]])
    index = substring_dedup.FMIndex(text)
    for _ in range(200):
        n = int(rng.integers(1, 8))
        pattern = rng.integers(1, 5, n)
        low, high = np.array([0]), np.array([len(text)])
        for s in pattern[::-1]:
            low, high = index.step(np.array([s]), low, high)
        want = sum((text[i:i + n] == pattern).all() for i in range(len(text) - n + 1))
        assert max(0, int(high[0] - low[0])) == want


def test_cut_points_are_spans():
    values = np.random.default_rng(1).integers(0, 3, 500).astype(np.uint64)
    offsets = np.array([0, 200, 210, 500])
    doc, anchor, low, high, _, _ = anchors.spans(values, offsets, 30, 5)
    seen = sorted(w for a, b in zip(low, high) for w in range(a, b + 1))
    assert seen == [*range(0, 171), *range(210, 471)]
    assert ((anchor >= high) & (anchor <= low + 25)).all()
    assert isinstance(pa.array(doc), pa.Array)


def test_wide_windows(spark, docs):
    """Windows of more bytes or words than ten bits count, in a passage that two texts share."""
    rng = random.Random(5)
    shared = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    texts = ["x" * 50 + shared + "y" * 40, "".join(rng.choice("klmn ") for _ in range(700)) + shared]
    for window in (200, 1000, 1300, 2500):
        got = suffix_dedup.without_repeats(docs(list(enumerate(texts))), window=window).collect()
        want = brute(texts, window, bytes, bytes)
        assert [r.n_removed for r in sorted(got, key=lambda r: r.doc_id)] == [w[1] for w in want], window
    words = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(40)) for _ in range(600)) for _ in range(3)]
    texts = [words[0] + " " + words[1], words[2] + " " + words[1]]
    for window in (35, 100, 300):
        got = substring_dedup.without_repeats(docs(list(enumerate(texts))), window=window).collect()
        want = by_words(texts, window)
        assert [r.n_removed for r in sorted(got, key=lambda r: r.doc_id)] == [w[1] for w in want], window
    with pytest.raises(ValueError, match="too long"):
        suffix_dedup.without_repeats(docs(list(enumerate(texts))), window=70_000)


def test_equal_rows_get_their_runs_once(spark, docs):
    """1,500 equal rows: every row has the runs of one row, not those of all of them."""
    rng = random.Random(6)
    text = "".join(rng.choice("abcdefgh ") for _ in range(2000))
    rows = docs([(7, text)] * 1500)
    found = suffix_dedup.repeated_bytes(rows).selectExpr("max(size(runs)) AS n").first().n
    assert 0 < found < 100
    out = suffix_dedup.without_repeats(rows)
    assert [tuple(r) for r in out.select("doc_id", "n_removed").distinct().collect()] == [(7, 2000)]
    assert out.count() == 1500


def thue_words(n, a="aa", b="bb"):
    return [a if bin(i).count("1") % 2 == 0 else b for i in range(n)]


def test_texts_that_collide_modulo_every_power_of_two(spark, docs):
    """Two words in the order of Thue and Morse, and with the words exchanged, have equal polynomial hashes for every
    base; behind a common beginning, which holds the anchor, their spans would be of one kind."""
    rng = random.Random(8)
    head = [f"h{rng.randrange(10 ** 6)}" for _ in range(700)]
    one, other = head + thue_words(2048), head + thue_words(2048, "bb", "aa")
    window = len(one)
    for texts in ([" ".join(one), " ".join(other)], [" ".join(one), " ".join(other), " ".join(one)],
                  [" ".join([*one, "x", *other])]):
        got = substring_dedup.without_repeats(docs(list(enumerate(texts))), window=window).orderBy("doc_id").collect()
        assert [r.n_removed for r in got] == [w[1] for w in by_words(texts, window)]


def test_witnesses_that_differ_are_noticed(spark, docs):
    """Under hashes that take capitals for small letters, texts that differ in capitals are of one kind; the text itself
    decides all the same, in both operators."""
    rng = random.Random(10)

    def lying_words(texts):
        return substring_dedup._words(pc.utf8_lower(texts.cast(pa.string())))

    def lying_bytes(texts):
        return suffix_dedup._bytes(pc.utf8_lower(texts.cast(pa.string())))

    body = [f"w{rng.randrange(900)}" for _ in range(150)]
    loud = body[:]
    loud[75] = loud[75].upper()
    tail = [f"t{rng.randrange(900)}" for _ in range(60)]
    texts = [" ".join(body), " ".join(loud), " ".join([*tail, *body[:60], *tail[:10]])]
    for tokens, cut, matched, window, gram, brute_force, n in (
            (lying_words, substring_dedup._cut, substring_dedup.matched, 35, 6, by_words, 1),
            (lying_bytes, anchors.cut_bytes, suffix_dedup.matched, 150, 32, by_bytes, 1)):
        rows = anchors.rows_of(docs(list(enumerate(texts))), "doc_id", "text")
        got = anchors.with_runs(rows, window, gram, tokens, cut, matched(window)).collect()
        sizes = {r.id: len({p for run in r.runs or [] for p in range(run.s, run.e)}) for r in got}
        assert [sizes[i] for i in range(3)] == [w[n] for w in brute_force(texts, window)]
        assert 0 < sizes[0] < len(texts[0])


def test_copies_are_confirmed_by_the_sort_and_the_index(spark, docs, monkeypatch):
    """Rows that a comparison doesn't confirm aren't removed: without it exact copies stay."""
    rng = random.Random(9)
    text = " ".join(f"w{rng.randrange(500)}" for _ in range(300))
    df = docs([(1, text), (2, text), (3, "y" + text)])

    def blind(window):
        return lambda table: (np.empty(0, np.int64),) * 3

    for module, name in ((suffix_dedup, "n_removed"), (substring_dedup, "n_removed")):
        seen = module.without_repeats(df).select(name).collect()
        assert all(r[0] > 0 for r in seen)
        monkeypatch.setattr(module, "matched", blind)
        assert all(r[0] == 0 for r in module.without_repeats(df).select(name).collect())
        monkeypatch.undo()
