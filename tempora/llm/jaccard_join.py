"""Near-duplicate texts: a Jaccard join of word shingles by chosen paths.

A text is the set of its runs of ``SHINGLE`` words.  ``COORDINATES`` min-hashes stand for the set, the
pairs (coordinate, min-hash) are its tokens.  In every one of ``RUNS`` runs, sets are split from one
root: a node picks one or two coordinates at random (seeded by its path, 1 / THRESHOLD of them on
average) and sends each set to the child named by its token there.  Two sets of similarity at the
threshold share one child of each shared node on average, dissimilar ones soon none.  After ``DEPTH``
levels the buckets of up to ``BUCKET`` sets are compared by brute force.  A larger one whose sets are
alike (their mean similarity is ``ALIKE`` or more) gains nothing from splits; it is dealt as pairs of
blocks to as many tasks.  Other large ones are split ``DEPTH`` levels further, down to ``DEEPEST``, in
``AGAIN`` runs of their own each: as many as keep the chance to miss a pair under ``MISS`` even if all
its buckets are split to the end (``miss_chance``, averaged over the min-hashes, which all runs share).
A pair at 0.8 is missed with a chance of 2.1 in 100,000, of 5.9 if all its buckets had to be split
once more and of 8.9 if twice; at 0.82 these are 0.4, 1.4 and 2.0.

Within a bucket, pairs whose min-hashes agree in far fewer coordinates than the threshold are left
out, and only sets that have a partner go on, with their shingles, to the exact comparison.  A pair
that shares several buckets counts in the first one only, so links are counted without being written
out.  Texts with equal sets are one node with a count from the start.

Defined results: words are runs of other bytes than x20 and x09 to x0D; a text of one to four words
has them all as its only shingle; null texts and texts without words link with nothing; rows that
repeat an id are told apart by their text; whole texts are read; an empty table gives an empty result.  Columns
that the work adds are named apart from those of the input.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.common import (blocks_of, byte_slices, components, documents, first_common, first_common_pairs,
                                fresh_name, group_starts, list_array, mix64, pairs_within, scratch, signed,
                                spanning_edges, utf8, whole_groups, word_hashes, words, written)

SHINGLE, THRESHOLD = 5, 0.8
COORDINATES, RUNS, DEPTH, DEEPEST, BUCKET = 128, 16, 4, 12, 512
PROBES, ALIKE, SMALL, MISS = 8, 0.4, 32, 1e-4
#: Below this share of equal min-hashes a pair isn't compared: 4.5 standard deviations under 0.8.
HOPE = THRESHOLD - 4.5 * (THRESHOLD * (1 - THRESHOLD) / COORDINATES) ** 0.5


def miss_chance(similarity: float, depth: int, again: int, runs: int = RUNS) -> float:
    """That a pair isn't compared if all its buckets are split to ``depth``, in ``again`` runs each time."""
    equal = np.arange(COORDINATES + 1)
    one, two = equal / COORDINATES, equal * (equal - 1) / (COORDINATES * (COORDINATES - 1))
    lost, more = np.zeros(len(equal)), 1 / THRESHOLD - 1  # lost: by a node, given the equal min-hashes
    for level in range(depth):
        if level and level % DEPTH == 0:
            lost = lost ** again
        lost = ((1 - more) * (1 - one + one * lost)
                + more * (1 - 2 * one + two + 2 * (one - two) * lost + two * lost ** 2))
    chance = np.array([comb(COORDINATES, k) * similarity ** k * (1 - similarity) ** (COORDINATES - k)
                       for k in equal.tolist()])
    return float(chance @ np.where(equal < int(HOPE * COORDINATES), 1, lost ** runs))


#: Runs in a bucket that is split.
AGAIN = next(k for k in count(1) if miss_chance(THRESHOLD, DEEPEST, k) <= MISS)

_ODD = mix64(np.arange(1, COORDINATES + 1, dtype=np.uint64)) | np.uint64(1)
_STEP = [np.uint64(x) for x in (0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def shingle_sets(texts: pa.Array, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the distinct shingles of all texts on end, ascending in a text; how many each has)."""
    data, offsets = utf8(texts)
    start, end, of = words(data, offsets)
    h = word_hashes(data, start, end)
    per = np.bincount(of, minlength=len(texts))
    some = np.where(per > 0, np.maximum(per - k + 1, 1), 0)
    base = np.cumsum(per) - per
    owner = np.repeat(np.arange(len(texts)), some)
    at = base[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(some) - some, some)
    last = (base + per)[owner]
    out = np.zeros(len(at), np.uint64)
    for i in range(k):  # a short text has fewer words than k
        there = at + i < last
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15)
                    + np.where(there, h[np.minimum(at + i, max(len(h) - 1, 0))], np.uint64(i + 1)))
    order = np.argsort(out)
    order = order[np.argsort(owner[order].astype(np.uint16 if len(texts) < 1 << 16 else np.int64),
                             kind="stable")]
    out, owner = out[order], owner[order]
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])
    return out[new], np.bincount(owner[new], minlength=len(texts))


def min_hashes(values: np.ndarray, many: np.ndarray) -> np.ndarray:
    """``COORDINATES`` min-hashes (32 bits) of each set that isn't empty, as rows."""
    full = np.flatnonzero(many)
    out = np.zeros((len(many), COORDINATES), np.uint32)
    if len(full):
        start = (np.cumsum(many) - many)[full]
        for i in range(COORDINATES):
            out[full, i] = np.minimum.reduceat(values * _ODD[i], start) >> np.uint64(32)
    return out


def roots(n: int, runs: int = RUNS) -> tuple[np.ndarray, np.ndarray]:
    """(set, path) of ``n`` sets at the roots of all runs."""
    start = mix64(np.arange(1, runs + 1, dtype=np.uint64))
    return np.repeat(np.arange(n), runs), np.tile(start, n)


def reruns(row: np.ndarray, path: np.ndarray, times: int = AGAIN) -> tuple[np.ndarray, np.ndarray]:
    """Sets ``row`` at nodes ``path``, to the roots of ``times`` runs below each."""
    start = mix64(np.arange(1, times + 1, dtype=np.uint64))
    return np.repeat(row, times), mix64((path[:, None] ^ start).ravel())


def descend(sketch: np.ndarray, row: np.ndarray, path: np.ndarray, levels: int = DEPTH
            ) -> tuple[np.ndarray, np.ndarray]:
    """Split further: sets ``row`` at nodes ``path``, to the nodes ``levels`` below."""
    more = np.uint64(round((1 / THRESHOLD - 1) * 2 ** 32))
    for _ in range(levels):
        one = mix64(path ^ _STEP[0])
        first = (one % np.uint64(COORDINATES)).astype(np.int64)
        second = (first + 1 + (mix64(path ^ _STEP[1]) % np.uint64(COORDINATES - 1)).astype(np.int64)) % COORDINATES
        two = (mix64(path ^ _STEP[2]) >> np.uint64(32)) < more
        pick = np.concatenate([first, second[two]])
        row, parent = np.concatenate([row, row[two]]), np.concatenate([path, path[two]])
        token = sketch[row, pick].astype(np.uint64) + (pick.astype(np.uint64) << np.uint64(32))
        path = mix64(parent * np.uint64(0x9E3779B97F4A7C15) + mix64(token))
    return row, path


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, th, d1, d2, size, sketch`` per row: ``th`` tells texts of one id apart, the digests and the
    size tell sets apart."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("th"),
                       F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", 1 << 20):
            values, many = shingle_sets(batch.column("text"))
            at = np.concatenate([[0], np.cumsum(many)])
            sums = []
            for salt in (1, 2):
                total = np.zeros(len(values) + 1, np.uint64)
                np.cumsum(mix64(values + np.uint64(salt)), out=total[1:])
                sums.append(signed(total[at[1:]] - total[at[:-1]]))
            sketch = min_hashes(values, many)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("th"), *sums, pa.array(many, pa.int32()), _binary(sketch)],
                names=["id", "th", "d1", "d2", "size", "sketch"])

    return rows.mapInArrow(run, "id long, th long, d1 long, d2 long, size int, sketch binary")


def _binary(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets),
                                                          pa.py_buffer(np.ascontiguousarray(rows))])


def _sketch(column: pa.Array) -> np.ndarray:
    data, _ = utf8(column)
    return data.view(np.uint32).reshape(-1, COORDINATES) if data.flags.aligned else \
        np.frombuffer(data.tobytes(), np.uint32).reshape(-1, COORDINATES)


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(c, sketch) to the nodes of all runs; with a column ``path``, from there on in runs of their own."""
    for whole in batches:
        for a in range(0, whole.num_rows, 4096):
            batch = whole.slice(a, 4096)
            sketch = _sketch(batch.column("sketch"))
            if "path" in batch.schema.names:
                row, path = reruns(np.arange(len(sketch)), batch.column("path").to_numpy().view(np.uint64))
            else:
                row, path = roots(len(sketch))
            row, path = descend(sketch, row, path)
            yield pa.RecordBatch.from_arrays(
                [batch.column("c").take(pa.array(row)), signed(path)], names=["c", "path"])


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first ``PROBES`` tokens of every set of a bucket."""
    for batch in batches:
        sketch = _sketch(batch.column("sketch"))[:, :PROBES].astype(np.int64)
        token = sketch + (np.arange(PROBES, dtype=np.int64) << 32)
        path = batch.column("path").take(pa.array(np.repeat(np.arange(batch.num_rows), PROBES)))
        yield pa.RecordBatch.from_arrays([path, pa.array(token.ravel())], names=["path", "token"])


def dense(large: DataFrame, sketch: DataFrame) -> DataFrame:
    """The paths of buckets whose sets are alike, by the mean similarity of all their pairs: the chance
    that two members have a token in common, from counts of the tokens."""
    counts = (large.join(sketch, "c").select("path", "sketch").mapInArrow(_tokens, "path long, token long")
              .groupBy("path", "token").agg(F.count("*").cast("double").alias("n")))
    return (counts.groupBy("path").agg((F.sum(F.col("n") * F.col("n")) * PROBES / F.sum("n") ** 2).alias("j"))
            .filter(F.col("j") >= ALIKE).select("path"))


def buckets(classes: DataFrame, size: int = BUCKET) -> DataFrame:
    """``path, c`` of the buckets in which the recursion ends."""
    sketch = classes.select("c", "sketch")
    rows = written(sketch.mapInArrow(_paths, "c long, path long"), "jaccard")
    done = None

    def end(part: DataFrame) -> DataFrame:
        part = part.select("path", "c")
        return part if done is None else done.unionAll(part)

    for depth in range(DEPTH, DEEPEST + 1, DEPTH):
        many = rows.groupBy("path").agg(F.count("*").alias("many")).filter("many > 1")
        counted = written(rows.join(written(many, "jaccard"), "path"), "jaccard")
        large = counted.filter(F.col("many") > size)
        if depth == DEEPEST or not large.limit(1).count():
            return end(counted)
        done = end(counted.filter(F.col("many") <= size))
        alike = written(dense(large, sketch), "jaccard")
        done = end(large.join(alike, "path", "left_semi"))
        large = large.join(alike, "path", "left_anti")
        rows = written(large.join(sketch, "c").select("c", "sketch", "path")
                       .mapInArrow(_paths, "c long, path long"), "jaccard")
    return done


def _halves(table: pa.Table) -> tuple[np.ndarray, np.ndarray, bool] | None:
    """Members of the two blocks of a group (twice the same for a block with itself)."""
    if table.column("i")[0] == table.column("j")[0]:
        every = np.arange(table.num_rows)
        return (every, every, True) if table.num_rows > 1 else None
    block = table.column("block").to_numpy()
    low, high = block.min(), block.max()
    return None if low == high else (np.flatnonzero(block == low), np.flatnonzero(block == high), False)


def _hopeful(table: pa.Table) -> np.ndarray:
    """Members of a group that may have a partner whose pair counts here."""
    halves = _halves(table)
    if halves is None:
        return np.empty(0, np.int64)
    left, right, same = halves
    sketch = _sketch(table.column("sketch").chunk(0)).astype(np.uint8)  # 8 bits a coordinate
    need = int(HOPE * COORDINATES)
    near = np.zeros((len(left), len(right)), bool)
    turned = np.ascontiguousarray(sketch[right])
    for a in range(0, len(left), 16):
        near[a:a + 16] = (sketch[left[a:a + 16], None, :] == turned[None]).sum(axis=2, dtype=np.uint8) >= need
    if same:
        near &= np.arange(len(left))[:, None] < np.arange(len(right))
    if not near.any():
        return np.empty(0, np.int64)
    near &= first_common(table.column("paths").chunk(0), table.column("path")[0].as_py(), left, right)
    return np.union1d(left[near.any(axis=1)], right[near.any(axis=0)])


def shared_counts(values: np.ndarray, many: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers of common values of the sets ``left`` x ``right`` (exact, a piece of the values at a time)."""
    owner = np.repeat(np.arange(len(many)), many)
    names, at, count = np.unique(values, return_inverse=True, return_counts=True)
    common = np.flatnonzero(count > 1)
    place = np.full(len(names), -1)
    place[common] = np.arange(len(common))
    at = place[at]
    keep = at >= 0
    at, owner = at[keep], owner[keep]
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for a in range(0, len(common), 4096):
        lo, hi = np.searchsorted(at, [a, a + 4096])
        has = np.zeros((len(many), min(4096, len(common) - a)), np.float32)
        has[owner[lo:hi], at[lo:hi] - a] = 1
        out += has[left] @ has[right].T
    return out


def _linked(table: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Of one group: nodes, how many texts they link with, spanning edges."""
    c = table.column("c").to_numpy()
    halves = _halves(table)
    if halves is None:
        return c[:0], c[:0], []
    left, right, same = halves
    sets = table.column("shingles").chunk(0)
    many = np.diff(sets.offsets.to_numpy()).astype(np.int64)
    common = shared_counts(sets.flatten().to_numpy(), many, left, right)
    # |A & B| >= t |A | B|, in whole numbers where t is a decimal fraction
    union = many[left][:, None] + many[right] - common
    near = common * 1000 >= round(threshold * 1000) * union
    if same:
        near &= np.arange(len(left))[:, None] < np.arange(len(right))
    if not near.any():
        return c[:0], c[:0], []
    near &= first_common(table.column("paths").chunk(0), table.column("path")[0].as_py(), left, right)
    a, b = np.nonzero(near)
    copies = table.column("copies").to_numpy()
    links = (np.bincount(left[a], copies[right[b]], len(c))
             + np.bincount(right[b], copies[left[a]], len(c))).astype(np.int64)
    hit = np.flatnonzero(links)
    tree = spanning_edges(len(c), left[a], right[b])
    return c[hit], links[hit], [(int(c[p]), int(c[q])) for p, q in tree]


_GROUP = ["path", "i", "j"]


def _groups(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, whether small) of the groups of a table."""
    starts = group_starts(table, _GROUP)
    ends = np.append(starts[1:], table.num_rows)
    same = (table.column("i").to_numpy() == table.column("j").to_numpy())[starts]
    return starts, ends, (ends - starts <= SMALL) & same


def _hopeful_small(table: pa.Table, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``_hopeful`` for many small groups at once."""
    i, j = pairs_within(starts, ends)
    sketch = _sketch(table.column("sketch").chunk(0)).astype(np.uint8)
    need = int(HOPE * COORDINATES)
    near = np.zeros(len(i), bool)
    for a in range(0, len(i), 1 << 14):
        part = slice(a, a + (1 << 14))
        near[part] = (sketch[i[part]] == sketch[j[part]]).sum(axis=1, dtype=np.uint8) >= need
    i, j = i[near], j[near]
    first = first_common_pairs(table.column("paths").chunk(0), table.column("path").to_numpy()[i], i, j)
    return np.union1d(i[first], j[first])


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in whole_groups(batches, _GROUP, 8192):
        starts, ends, small = _groups(table)
        hit = [_hopeful_small(table, starts[small], ends[small])]
        for s, e in zip(starts[~small].tolist(), ends[~small].tolist()):
            if e - s > 1:
                hit.append(s + _hopeful(table.slice(s, e - s).combine_chunks()))
        rows = table.select([*_GROUP, "block", "c"]).take(pa.array(np.sort(np.concatenate(hit))))
        yield from rows.combine_chunks().to_batches()


def links(classes: DataFrame, texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``a, b, links``: with ``b`` null numbers of linked texts to be added up by ``a``, else spanning
    edges, for ``classes(c, id, th, copies, sketch)`` and the rows ``texts(id, th, text)``."""
    dealt = written(blocks_of(buckets(classes), ["path"], "c", BUCKET), "jaccard")
    paths = written(dealt.groupBy("c").agg(F.sort_array(F.collect_set("path")).alias("paths")), "jaccard")
    first = (dealt.join(classes.select("c", "sketch").join(paths, "c"), "c")
             .repartition(*_GROUP).sortWithinPartitions(*_GROUP))
    hopeful = written(first.mapInArrow(_candidates, "path long, i int, j int, block int, c long"), "jaccard")
    wanted = hopeful.select("c").distinct().join(classes.select("c", "id", "th", "copies"), "c")
    of = texts.select(F.col("id").alias("tid"), F.col("th").alias("tth"), "text")
    sets = (wanted.join(of, F.col("id").eqNullSafe(F.col("tid")) & (F.col("th") == F.col("tth")))
            .select("c", "copies", "text").mapInArrow(_sets, "c long, copies long, shingles array<long>"))
    sets = written(sets.dropDuplicates(["c"]).join(paths, "c"), "jaccard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in whole_groups(batches, _GROUP, 1024):
            starts, ends, _ = _groups(whole)
            for s, e in zip(starts.tolist(), ends.tolist()):
                node, count, tree = _linked(whole.slice(s, e - s).combine_chunks(), threshold)
                if not len(node):
                    continue
                a = np.concatenate([node, np.array([p for p, _ in tree], np.int64)])
                b = np.concatenate([np.zeros(len(node), np.int64), np.array([q for _, q in tree], np.int64)])
                yield pa.RecordBatch.from_pydict({
                    "a": pa.array(a, pa.int64()),
                    "b": pa.array(b, pa.int64(), mask=np.arange(len(a)) < len(node)),
                    "links": pa.array(np.concatenate([count, np.zeros(len(tree), np.int64)]), pa.int64())})

    second = hopeful.join(sets, "c").repartition(*_GROUP).sortWithinPartitions(*_GROUP)
    return written(second.mapInArrow(run, "a long, b long, links long"), "jaccard")


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in byte_slices(batches, "text", 1 << 20):
        values, many = shingle_sets(batch.column("text"))
        yield pa.RecordBatch.from_arrays([batch.column("c"), batch.column("copies"),
                                          list_array(signed(values), many)], names=["c", "copies", "shingles"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """``id, th, class_id, n_links, first`` per row.  ``class_id``: the smallest id that links reach,
    the row's own id included; ``first``: the row is the one of its class that stays, or a repetition
    of it (same id and text).  Thresholds below ``THRESHOLD`` are refused: the number of runs, the
    branching and the candidate cut would lose their pairs."""
    if threshold < THRESHOLD:
        raise ValueError(f"the paths and the candidate cut are made for similarities of {THRESHOLD} or more")
    with scratch(docs.sparkSession):
        rows = written(sketches(docs, id_col, text_col), "jaccard")
        key = ["d1", "d2", "size"]
        who = F.struct(F.col("id").isNull().alias("none"), "id", "th")
        classes = (rows.filter("size > 0").groupBy(*key)
                   .agg(F.min(F.struct(who.alias("who"), "sketch")).alias("m"), F.count("*").alias("copies"))
                   .select(*key, "m.who", "m.who.id", "m.who.th", "m.sketch", "copies",
                           F.monotonically_increasing_id().alias("c")))
        classes = written(classes, "jaccard")
        texts = docs.select(F.col(id_col).cast("long").alias("id"),
                            F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("th"),
                            F.col(text_col).alias("text"))
        found = links(classes, texts, threshold)
        count = found.filter("b IS NULL").groupBy("a").agg(F.sum("links").alias("others"))
        part = components(found.filter("b IS NOT NULL").select("a", "b"))
        part = classes.select("c", "who").join(part, F.col("c") == F.col("node"))
        name = part.groupBy("component").agg(F.min("who").alias("name"))
        part = part.join(name, "component").select("c", "name")
        classes = (classes.join(count, F.col("c") == F.col("a"), "left").join(part, "c", "left")
                   .select(*key, F.coalesce("name", "who").alias("name"),
                           (F.coalesce("others", F.lit(0).cast("long")) + F.col("copies") - 1).alias("n_links")))
        out = rows.drop("sketch").join(written(classes, "jaccard"), key, "left")
        class_id = F.when(F.col("name").isNull(), F.col("id")).otherwise(F.col("name.id"))
        out = out.select("id", "th", class_id.alias("class_id"),
                         F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                         F.coalesce(F.col("name") == who, F.lit(True)).alias("first"))
        return written(out, "jaccard", outer=True)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stay: of each class the one with the smallest id, every text without
    words."""
    keys = near_duplicates(docs, id_col, text_col, threshold).filter("first").select("id", "th").distinct()
    mine = fresh_name(docs, "llm_th")
    named = docs.withColumn(mine, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    keys = keys.select(F.col("id").alias(mine + "i"), F.col("th").alias(mine + "t"))
    wordless = ~F.coalesce(F.col(text_col), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    kept = named.join(keys, F.col(id_col).cast("long").eqNullSafe(F.col(mine + "i"))
                      & (F.col(mine) == F.col(mine + "t")), "left_semi")
    return kept.filter(~wordless).dropDuplicates([id_col, mine]).unionAll(kept.filter(wordless)).drop(mine)


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir))
    return found.select(F.col("id").alias("doc_id"), "class_id", "n_links", F.col("first").alias("kept"))


OP2_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b USING (shingle)
      WHERE a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
         WHERE k * 1000 >= 800 * (a.n + b.n - k)),
reach(x, y) AS (SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x),
low AS (SELECT x, min(y) AS y FROM reach GROUP BY x),
many AS (SELECT x, count(*) AS n FROM link GROUP BY x)
SELECT doc_id, least(doc_id, coalesce(low.y, doc_id)) AS class_id, coalesce(many.n, 0) AS n_links,
       doc_id = least(doc_id, coalesce(low.y, doc_id)) AS kept
FROM documents LEFT JOIN low ON low.x = doc_id LEFT JOIN many ON many.x = doc_id
"""
