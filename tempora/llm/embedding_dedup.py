"""Near-duplicate vectors by spherical-cap filters from a structured random product code.

A seeded rotation spreads every vector over ``BLOCKS`` blocks of coordinates; each block has a code
book of random unit vectors.  A filter is one code word per block, its direction the blocks on end;
a vector exceeds it if the inner products of its blocks add up to the threshold.  List decoding
finds all exceeding filters of a vector without trying them all: the words of each block are sorted
by inner product, and a prefix is given up as soon as the best words of the other blocks can't lift
it to the threshold.  Vectors with equal label that exceed a common filter are compared exactly.

``CODES`` codes with rotations of their own are used side by side; of each a vector exceeds about
``FILTERS`` filters.  The books grow with the table (its ``BLOCKS``-th root), so that a filter holds
about the same number of unrelated vectors at every size.  A filter with more than
``BLOCK`` vectors is dealt as pairs of blocks of its vectors to as many tasks.  A pair that shares
several filters counts in the first one only, so links are counted without being written out; edges
leave a task as a spanning forest.

Defined results: vectors that are null, empty or zero, hold null or non-finite components, or have no
label link with nothing and are their own component; vectors of different length don't link; rows
that repeat a vec_id are told apart by number and link as equal vectors do; cosines are taken in
double precision; an empty table gives an empty result.  Further columns aren't looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.common import (blocks_of, components, first_common, first_common_pairs, group_starts,
                                list_array, pairs_within, scratch, spanning_edges, whole_groups,
                                written)

THRESHOLD, BLOCKS, CODES, FILTERS, SPREAD, BLOCK, SMALL, SEED = 0.93, 3, 6, 48, 64, 512, 32, 11


class ProductCode:
    """Code books for vectors of ``dim`` coordinates; ``words`` per book, one book per block."""

    def __init__(self, dim: int, words: int, filters: int = FILTERS, blocks: int = BLOCKS, seed: int = SEED):
        rng = np.random.default_rng([seed, dim])
        blocks = min(blocks, dim)
        self.rotation = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        self.edges = np.linspace(0, dim, blocks + 1).astype(int)
        self.words = words
        self.size = words ** blocks
        self.books = []
        for a, b in zip(self.edges, self.edges[1:]):
            book = rng.normal(size=(words, b - a))
            self.books.append(book / np.linalg.norm(book, axis=1, keepdims=True))
        # the threshold that a random direction passes for about ``filters`` of the filters
        probe = rng.normal(size=(200, dim))
        probe /= np.linalg.norm(probe, axis=1, keepdims=True)
        dots = [(probe @ self.rotation)[:, a:b] @ book.T
                for book, a, b in zip(self.books, self.edges, self.edges[1:])]
        low, high = 0.0, float(np.mean(sum(d.max(axis=1) for d in dots)))
        while True:  # from the top, so that no list is long
            self.threshold = high - (high - low) / 16
            if self.threshold < 1e-6 or len(self._decoded(dots)[0]) > filters * len(probe):
                break  # in one or two coordinates few words may pass any threshold above 0
            high = self.threshold
        low = self.threshold
        for _ in range(12):
            self.threshold = (low + high) / 2
            n = len(self._decoded(dots)[0]) / len(probe)
            low, high = (self.threshold, high) if n > filters else (low, self.threshold)

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) of all filters that rows of unit vectors exceed."""
        turned = unit @ self.rotation
        return self._decoded([turned[:, a:b] @ book.T
                              for book, a, b in zip(self.books, self.edges, self.edges[1:])])

    def _decoded(self, dots: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        best = np.stack([d.max(axis=1) for d in dots], axis=1)
        rest = np.cumsum(best[:, ::-1], axis=1)[:, ::-1]  # the most that blocks k, k+1, ... can add
        row = np.arange(len(best))
        code, total = np.zeros(len(best), np.int64), np.zeros(len(best))
        for k, d in enumerate(dots):
            after = rest[row, k + 1] if k + 1 < len(dots) else np.zeros(len(row))
            order = np.argsort(-d, axis=1)
            # how many of the sorted words still lead on
            many = _count_at_least(-np.take_along_axis(d, order, axis=1), row, self.threshold - total - after)
            place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            row = np.repeat(row, many)
            word = order[row, place]
            total = np.repeat(total, many) + d[row, word]
            code = np.repeat(code, many) * self.words + word
        return row, code


def decode_all(codes: list[ProductCode], unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) over several codes, their filters numbered on; by row, then filter."""
    rows, found, base = [], [], 0
    for c in codes:
        row, code = c.decode(unit)
        rows.append(row)
        found.append(code + base)
        base += c.size
    row, code = np.concatenate(rows), np.concatenate(found)
    order = np.lexsort((code, row))
    return row[order], code[order]


def _count_at_least(negated: np.ndarray, row: np.ndarray, need: np.ndarray) -> np.ndarray:
    """For each i: how many entries of the ascending row ``negated[row[i]]`` are <= -need[i]."""
    low = np.zeros(len(row), np.int64)
    high = np.full(len(row), negated.shape[1], np.int64)
    while (low < high).any():
        mid = (low + high) // 2
        go = (low < high) & (negated[row, np.minimum(mid, negated.shape[1] - 1)] <= -need)
        high = np.where((low < high) & ~go, mid, high)
        low = np.where(go, mid + 1, low)
    return low


def usable(column: pa.Array) -> np.ndarray:
    """Which vectors can link: not null, not empty, not zero, all components finite numbers."""
    at = np.concatenate([[0], np.cumsum(_lengths(column))])
    flat = column.flatten()
    null = flat.is_null().to_numpy(zero_copy_only=False)
    x = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
    bad = np.concatenate([[0], np.cumsum(null | ~np.isfinite(x))])
    some = np.concatenate([[0], np.cumsum(x != 0)])
    return (bad[at[1:]] == bad[at[:-1]]) & (some[at[1:]] > some[at[:-1]])


def _lengths(column: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _stack(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def decoded(vectors: DataFrame, words: int, filters: int = FILTERS, codes: int = CODES) -> DataFrame:
    """``n, label, copies, dim, vector, codes`` of the vectors that can link: ``codes`` are the filters
    that the vector exceeds, ascending."""
    # the lists of filters are most of what is shuffled: 32 bits a filter where they are enough
    small = codes * words ** BLOCKS < 1 << 31
    code_type, code_name = (pa.int32(), "int") if small else (pa.int64(), "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books: dict[int, list[ProductCode]] = {}
        for batch in batches:
            batch = batch.filter(pa.array(usable(batch.column("vector"))))
            size = _lengths(batch.column("vector"))
            for dim in np.unique(size).tolist():
                same = batch.filter(pa.array(size == dim))
                if dim not in books:
                    books[dim] = [ProductCode(dim, words, filters, seed=SEED + k) for k in range(codes)]
                step = max(1, min(1000, (1 << 20) // words))
                for a in range(0, same.num_rows, step):
                    part = same.slice(a, step)
                    row, code = decode_all(books[dim], _unit(_stack(part.column("vector"), dim)))
                    lists = list_array(pa.array(code.astype(code_type.to_pandas_dtype())), np.bincount(row, minlength=part.num_rows))
                    yield pa.RecordBatch.from_arrays(
                        [part.column("n"), part.column("label"), part.column("copies"),
                         pa.array(np.full(part.num_rows, dim), pa.int32()), part.column("vector"), lists],
                        names=["n", "label", "copies", "dim", "vector", "codes"])

    kind = vectors.schema["vector"].dataType.simpleString()
    return vectors.select("n", "label", "copies", "vector").mapInArrow(
        run, f"n long, label long, copies long, dim int, vector {kind}, codes array<{code_name}>")


def _compare(table: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Links of one (filter, pair of blocks) group: nodes, how many vectors they link with, spanning
    edges."""
    dim = table.column("dim")[0].as_py()
    code, halves = table.column("code")[0].as_py(), table.column("i")[0].as_py() != table.column("j")[0].as_py()
    n = table.column("n").to_numpy()
    copies = table.column("copies").to_numpy()
    x = _unit(_stack(table.column("vector").chunk(0), dim))
    block = table.column("block").to_numpy()
    left = np.flatnonzero(block == block.min()) if halves else np.arange(len(n))
    right = np.flatnonzero(block == block.max()) if halves else left
    if halves and block.min() == block.max():
        return n[:0], n[:0], []
    near = x[left] @ x[right].T >= threshold
    if not halves:
        near &= np.arange(len(left))[:, None] < np.arange(len(right))
    if not near.any():
        return n[:0], n[:0], []
    near &= first_common(table.column("codes").chunk(0), code, left, right)
    a, b = np.nonzero(near)
    if not len(a):
        return n[:0], n[:0], []
    links = (np.bincount(left[a], copies[right[b]], len(n))
             + np.bincount(right[b], copies[left[a]], len(n))).astype(np.int64)
    tree = spanning_edges(len(n), left[a], right[b])
    hit = np.flatnonzero(links)
    return n[hit], links[hit], [(int(n[p]), int(n[q])) for p, q in tree]


def _compare_small(table: pa.Table, starts: np.ndarray, ends: np.ndarray, threshold: float
                   ) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """``_compare`` for many small groups at once."""
    n, copies = table.column("n").to_numpy(), table.column("copies").to_numpy()
    dims, codes = table.column("dim").to_numpy(), table.column("code").to_numpy()
    vectors, lists = table.column("vector").chunk(0), table.column("codes").chunk(0)
    left, right = [], []
    for dim in np.unique(dims[starts]).tolist():
        of = np.flatnonzero(dims == dim)
        x = _unit(_stack(vectors if len(of) == table.num_rows else vectors.take(pa.array(of)), dim))
        place = np.zeros(table.num_rows, np.int64)
        place[of] = np.arange(len(of))
        i, j = pairs_within(starts[dims[starts] == dim], ends[dims[starts] == dim])
        for a in range(0, len(i), 1 << 15):
            p, q = i[a:a + (1 << 15)], j[a:a + (1 << 15)]
            near = np.einsum("ij,ij->i", x[place[p]], x[place[q]]) >= threshold
            left.append(p[near])
            right.append(q[near])
    i, j = (np.concatenate(z) if z else np.empty(0, np.int64) for z in (left, right))
    first = first_common_pairs(lists, codes[i], i, j)
    i, j = i[first], j[first]
    many = (np.bincount(i, copies[j], len(n)) + np.bincount(j, copies[i], len(n))).astype(np.int64)
    hit = np.flatnonzero(many)
    return n[hit], many[hit], [(int(n[p]), int(n[q])) for p, q in spanning_edges(len(n), i, j)]


def links(vectors: DataFrame, words: int, threshold: float = THRESHOLD, filters: int = FILTERS,
          block: int = BLOCK, codes: int = CODES) -> DataFrame:
    """``a, b, links`` of all groups of ``vectors(n, label, copies, vector)``: with ``b`` null, numbers
    of linked vectors to be added up by ``a``; else spanning edges."""
    caps = written(decoded(vectors, words, filters, codes), "caps")
    keys = ["label", "dim", "code"]
    light = caps.select("label", "dim", F.explode("codes").alias("code"), "n")
    dealt = written(blocks_of(light, keys, "n", block), "caps")
    # of a vector's filters only those that another vector exceeds go along
    shared = dealt.groupBy("n").agg(F.sort_array(F.collect_set("code")).alias("codes"))
    dealt = dealt.join(caps.select("n", "copies", "vector").join(shared, "n"), "n")
    group = [*keys, "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, group, 4096):
            starts = group_starts(table, group)
            ends = np.append(starts[1:], table.num_rows)
            small = (ends - starts <= SMALL) & (table.column("i").to_numpy() == table.column("j").to_numpy())[starts]
            ids, many, tree = _compare_small(table, starts[small], ends[small], threshold)
            node, count, a, b = [ids], [many], [p for p, _ in tree], [q for _, q in tree]
            for s, e in zip(starts[~small].tolist(), ends[~small].tolist()):
                if e - s > 1:
                    ids, many, tree = _compare(table.slice(s, e - s).combine_chunks(), threshold)
                    node.append(ids)
                    count.append(many)
                    a += [p for p, _ in tree]
                    b += [q for _, q in tree]
            node, count = np.concatenate(node), np.concatenate(count)
            yield pa.RecordBatch.from_pydict({
                "a": pa.array(np.concatenate([node, np.array(a, np.int64)]), pa.int64()),
                "b": pa.array(np.concatenate([np.zeros(len(node), np.int64), np.array(b, np.int64)]), pa.int64(),
                              mask=np.arange(len(node) + len(a)) < len(node)),
                "links": pa.array(np.concatenate([count, np.zeros(len(a), np.int64)]), pa.int64())})

    return written(dealt.repartition(*group).sortWithinPartitions(*group)
                   .mapInArrow(run, "a long, b long, links long"), "caps")


def near_duplicates(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """``<id_col>, n_links, component_id, kept`` for every row.  Thresholds below ``THRESHOLD`` are refused: the
    filters of a vector are too few for pairs further apart."""
    if threshold < THRESHOLD:
        raise ValueError(f"the filters are made for cosines of {THRESHOLD} or more")
    with scratch(table.sparkSession):
        rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                            F.col(vector_col).alias("vector"))
        # rows are numbered in order of the id, so the smallest number has the smallest id
        rows = written(rows.repartitionByRange(F.col("id").asc_nulls_last())
                       .sortWithinPartitions(F.col("id").asc_nulls_last())
                       .withColumn("n", F.monotonically_increasing_id()), "caps")
        # equal vectors of a label go on as one with a count
        known = rows.filter("label IS NOT NULL AND vector IS NOT NULL")
        first = written(known.groupBy("label", "vector").agg(F.min("n").alias("first"), F.count("*").alias("copies")),
                        "caps")
        rows = written(rows.join(first, ["label", "vector"], "left").select("n", "id", "first"), "caps")
        size = first.count()
        words = max(16, int(np.ceil((SPREAD * max(size, 1)) ** (1 / BLOCKS))))
        vectors = first.withColumnRenamed("first", "n")
        # more books of more words pass fewer of the pairs at the threshold: a code more each time the
        # table grows fourfold makes up for it
        found = links(vectors, words, threshold, codes=CODES + int(np.log2(max(1, size / 50_000)) / 2))
        alone = (first.filter("copies > 1").mapInArrow(_only_usable, first.schema)
                 .select("first", (F.col("copies") - 1).alias("links")))
        count = (found.filter("b IS NULL").select(F.col("a").alias("first"), "links").unionAll(alone)
                 .groupBy("first").agg(F.sum("links").alias("n_links")))
        part = components(found.filter("b IS NOT NULL").select("a", "b"))
        # without links a vector that has copies is named by the first of them, if they can link at all
        part = count.select("first").join(part.withColumnRenamed("node", "first"), "first", "left").select(
            "first", F.coalesce("component", "first").alias("n"))
        part = part.join(rows.select("n", F.col("id").alias("name")), "n").drop("n")
        out = rows.join(count, "first", "left").join(part, "first", "left")
        own = F.coalesce("name", "id")
        n_links = F.coalesce("n_links", F.lit(0).cast("long"))
        out = out.select(F.col("id").alias(id_col), n_links.alias("n_links"), own.alias("component_id"),
                         F.col("id").eqNullSafe(own).alias("kept"))
        return written(out, "caps", outer=True)


def _only_usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pa.array(usable(batch.column("vector"))))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP5_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
reach(x, y) AS (SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x),
low AS (SELECT x, min(y) AS y FROM reach GROUP BY x),
many AS (SELECT x, count(*) AS n FROM link GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low.y, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(low.y, vec_id)) AS kept
FROM embeddings LEFT JOIN many ON many.x = vec_id LEFT JOIN low ON low.x = vec_id
"""
