import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from llm_data import EDGES, docs  # noqa: F401

from tempora.llm import exact_dedup
from tempora.llm.exact_dedup import DigestIndex, deduplicated, mark, mark_batches


def test_marks_equal_brute_force(spark, docs):
    got = mark(docs(EDGES, "keep_id kept group_size text_sha256"), DigestIndex.create(spark)).collect()
    groups = defaultdict(list)
    for i, text in EDGES:
        groups[text or ""].append(i)
    assert len(got) == len(EDGES)
    kept = defaultdict(int)
    for r in got:
        text = next(t for t in groups if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        ids = [i for i in groups[text] if i is not None]
        assert r.group_size == len(groups[text])
        assert r.keep_id == (max(ids) if ids else None)
        kept[text] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1}  # repeated rows too: one of them stays


def test_second_batch_loses_to_the_index(spark, docs):
    index = DigestIndex.create(spark, buckets=4)
    first = mark(docs([(1, "x"), (2, "y")]), index).collect()
    assert all(r.kept for r in first)
    second = {r.doc_id: r for r in mark(docs([(9, "x"), (10, "z"), (11, "z")]), index).collect()}
    assert not second[9].kept and second[9].keep_id == 1
    assert not second[10].kept and second[11].kept
    assert index.table().count() == 3
    again = DigestIndex.attach(spark, index.path)
    assert again.buckets == 4 and sorted(r.keep_id for r in again.table().collect()) == [1, 2, 11]
    third = {r.doc_id: r.kept for r in mark(docs([(12, "x"), (13, "new")]), again).collect()}
    assert third == {12: False, 13: True}


def test_a_batch_that_runs_again_keeps_what_it_kept(spark, docs):
    """The first attempt dies after its digests were appended: the second gives the same result."""
    index = DigestIndex.create(spark, buckets=4)
    mark(docs([(1, "x")]), index, name="zero")
    batch = docs([(5, "x"), (6, "y"), (7, "y"), (8, "z"), (8, "z")])
    runs = [sorted(tuple(r) for r in mark(batch, index, name="one").collect()) for _ in range(3)]
    assert runs[0] == runs[1] == runs[2] and sum(r[3] for r in runs[0]) == 2
    for _ in range(2):
        assert sorted(r.text for r in deduplicated(batch, index, name="one").collect()) == ["y", "z"]
    assert index.table().count() == 3
    assert not any(r.kept for r in mark(batch, index, name="another").collect())


def test_another_number_of_buckets_is_refused(spark, docs):
    index = DigestIndex.create(spark, buckets=8)
    mark(docs([(i, f"t{i}") for i in range(50)]), index)
    with pytest.raises(ValueError, match="8 buckets"):
        DigestIndex.attach(spark, index.path, 4)
    with pytest.raises(ValueError, match="no digest index"):
        DigestIndex.attach(spark, index.path + "x")


def test_compaction_keeps_the_digests_and_sorts_each_bucket_into_one_file(spark, docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "APPENDS", 3)
    index = DigestIndex.create(spark, buckets=2)
    for n in range(5):
        mark(docs([(100 * n + i, f"t{i + 7 * n}") for i in range(20)]), index, name=str(n))
    assert index._files() <= 3 * 2 and index.table().count() == 48
    index.compact(rows_per_bucket=10)
    assert index.buckets == 8 and index._files() <= 8
    again = DigestIndex.attach(spark, index.path)
    assert again.buckets == 8 and again.table().count() == 48
    assert not any(r.kept for r in mark(docs([(9, "t3")]), again).collect())
    path = index.path
    index.drop()
    with pytest.raises(ValueError):
        DigestIndex.attach(spark, path)


def test_batches_of_one_table(spark, docs):
    rows = [(i, f"text {i * i % 17}") for i in range(60)] + [(None, "text 1"), (None, None), (3, "text 9")]
    one = by_row(mark(docs(rows), DigestIndex.create(spark)))
    lower = F.when(F.col("doc_id") > 30, 0).otherwise(1)
    index = DigestIndex.create(spark, buckets=4)
    assert by_row(mark_batches(docs(rows), lower, ["a", "b"], index)) == one
    assert by_row(mark_batches(docs(rows), lower, ["a", "b"], index)) == one  # both again
    third = F.when(F.col("doc_id") > 40, 0).when(F.col("doc_id") > 20, 1).otherwise(2)
    assert by_row(mark_batches(docs(rows), third, ["a", "b", "c"], DigestIndex.create(spark))) == one


def by_row(marked):
    return sorted((tuple(r) for r in marked.collect()), key=repr)


def test_the_query_leaves_no_table_behind(spark):
    before = {t.name for t in spark.catalog.listTables()}
    out = exact_dedup.op3_exact_dedup(spark, "/root/testdata/sf0.001")
    assert {t.name for t in spark.catalog.listTables()} == before
    assert out.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()


def test_survivors_keep_their_columns(spark, docs):
    df = docs(EDGES, "llm_sha LLM_KEEP")
    out = deduplicated(df, DigestIndex.create(spark))
    assert out.columns == df.columns
    assert sorted((r.text or "") for r in out.collect()) == sorted({t or "" for _, t in EDGES})


def test_empty_table(spark, docs):
    index = DigestIndex.create(spark)
    assert mark(docs([(1, "a")]).limit(0), index).count() == 0
    assert index.table().count() == 0


def test_anti_join_is_a_sort_merge_on_the_buckets(spark, docs):
    index = DigestIndex.create(spark, buckets=4)
    groups = docs([(1, "a")]).selectExpr("sha2(text, 256) AS text_sha256").repartition(4, "text_sha256")
    plan = groups.join(index.table().hint("merge"), "text_sha256", "left_anti")._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
