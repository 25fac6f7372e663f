from collections import Counter

import pytest

import __spark_entry__ as E
import corpus_pipeline
from oracle import compare
from tempora.llm import queries
from tempora.llm.common import written
from test_near import shingles

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_equal_their_sql(spark, name):
    r = compare(queries.QUERIES[name](spark, SF), queries.ORACLE[name], SF)
    assert r["exact"], r


def test_registration():
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op")) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "jaccard_join", "mixing", "sentencepiece"]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.collect()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), "test")
        after = docs.collect()
        assert docs.columns == columns and {r.doc_id for r in after} <= {r.doc_id for r in before}
        full = {r.doc_id: r for r in before}
        assert all(full[r.doc_id] == r for r in after)
        if name == "exact_dedup":
            last = {}
            for r in before:
                last[r.text] = max(r.doc_id, last.get(r.text, -1))
            assert sorted(r.doc_id for r in after) == sorted(last.values())
        if name == "jaccard_join":
            sets = {r.doc_id: shingles(r.text) for r in before}
            index = {}
            for i, s in sets.items():
                for g in s:
                    index.setdefault(g, []).append(i)
            left = {r.doc_id for r in after}
            for i, s in sets.items():
                near = {j for g in s for j in index[g] if j != i and len(s & sets[j]) * 10 >= 8 * len(s | sets[j])}
                assert i in left or near  # who goes has a near copy
                assert not near or min(near) > i or i not in left  # of two linked ones the first stays alone
        if name == "mixing":
            many = Counter(r.doc_id for r in after)
            words = {r.doc_id: len([w for w in r.text.split(" ")]) for r in before}
            assert max(many.values()) == 2
            got = sum(words[i] * n for i, n in many.items()) / sum(words.values())
            assert got == pytest.approx(1.5, rel=0.02)
        before = after
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert Counter(r.doc_id for r in tokens) == Counter(r.doc_id for r in before)
    assert all(len(r.ids) == r.n_tokens > 0 for r in tokens)


def small_folder(spark, folder, rows, labels, extra=""):
    from llm_data import make

    make(spark, rows, extra).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_edge_rows_go_through_all_stages(spark, workdir):
    """Null and empty texts, a null id, repeated rows, a very long text, columns that the stages use themselves."""
    from llm_data import EDGES

    near = " ".join(f"n{i}" for i in range(60))
    rows = [*EDGES, (30, near), (31, near + " tail"), (32, near)]
    sf = small_folder(spark, workdir, rows, [(1, 1, 0), (8, 0, 0), (None, 1, 1)], "keep_id sketch copies take ids target")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, sf), "test")
        left = [(r.doc_id, r.text) for r in docs.collect()]
        assert docs.columns == columns and set(left) <= set(rows), name
        if name == "toxicity":  # labels of one class: nothing is rejected
            assert sorted(left, key=repr) == sorted(rows, key=repr)
        if name == "exact_dedup":
            assert sorted(t or "" for _, t in left) == sorted({t or "" for _, t in rows})
        if name == "jaccard_join":
            assert [i for i, _ in left if i in (30, 31, 32)] == [31]  # 30 is an earlier copy of 32
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert Counter(r.doc_id for r in tokens) == Counter(i for i, _ in left)
    assert all(r.n_tokens == len(r.ids) for r in tokens)
    assert corpus_pipeline.run(spark, sf).count() == len(tokens)


def test_empty_tables_go_through_all_stages(spark, workdir):
    sf = small_folder(spark, workdir, [], [])
    assert corpus_pipeline.run(spark, sf).count() == 0
    none = small_folder(spark, f"{workdir}/labels", [], [(1, 1, 0), (2, 0, 1)])
    assert corpus_pipeline.run(spark, none).count() == 0
    for name, query in queries.QUERIES.items():
        if name not in ("op5_embedding_dedup", "op11_whitening", "sharding_law"):
            assert query(spark, sf).count() == 0, name
