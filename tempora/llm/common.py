"""Helpers shared by the operators: names, written tables, Arrow batches, components."""

from __future__ import annotations

import ctypes
import threading
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.session import delete_path, scratch_path


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh_name(df: DataFrame, base: str) -> str:
    """``base``, lengthened until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


_OPEN = threading.local()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables ``written`` within are deleted at the end, but for those written with ``outer``."""
    scopes = _OPEN.__dict__.setdefault("scopes", [])
    scopes.append([])
    try:
        yield
    finally:
        for path in scopes.pop():
            delete_path(spark, path)


def written(df: DataFrame, *parts: str, outer: bool = False) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage and survives lost executors.

    It lives as long as the innermost ``scratch``; with ``outer`` as long as the one around that, and
    without one it stays."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", *parts)
    df.write.parquet(path)
    scopes = _OPEN.__dict__.get("scopes", [])
    if len(scopes) > outer:
        scopes[-1 - outer].append(path)
    return spark.read.schema(df.schema).parquet(path)


# --- Arrow ------------------------------------------------------------------------------------

def byte_slices(batches: Iterator[pa.RecordBatch], column: str,
                budget: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a piece hold about ``budget`` bytes (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        piece = np.cumsum(size.astype(np.int64)) // budget
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)
    release()


def release() -> None:
    """Give freed memory back to the system: a worker lives on for tasks of other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all values on end, offsets of the values); a null counts as empty."""
    arr = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(arr.buffers()[1], np.int64, len(arr) + 1, arr.offset * 8)
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def binary_array(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Arrow binaries of the slices ``data[starts[i]:ends[i]]``."""
    length = (ends - starts).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(length)])
    take = np.repeat(starts - offsets[:-1], length) + np.arange(offsets[-1])
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(length),
        [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[take]))],
    ).cast(pa.binary())


def list_array(values: pa.Array, lengths: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str],
                 rows: int = 20_000) -> Iterator[pa.Table]:
    """Tables of about ``rows`` rows that never cut a group; the input is sorted by ``keys``."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n < rows:
            continue
        table = pa.Table.from_batches(held)
        change = group_starts(table, keys)
        cut = int(change[-1])  # the last group may go on in the next batch
        if cut:
            yield table.slice(0, cut).combine_chunks()
            rest = table.slice(cut).combine_chunks()
            held, n = rest.to_batches(), rest.num_rows
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
    release()


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """First row of each run of equal keys (integers)."""
    if not table.num_rows:
        return np.empty(0, np.int64)
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for k in keys:
        v = table.column(k).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (multiply and shift)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64), pa.int64())


# --- text -------------------------------------------------------------------------------------

#: The white space of the contracts, as bytes: x20 and x09 to x0D.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept between calls."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length() if n > 1 else 1)
        p = np.ones(size, np.uint64)
        k = 1
        while k < size:  # doubling: p[k:2k] = p[:k] * base**k
            p[k:2 * k] = p[:k] * np.uint64(pow(base, k, 1 << 64))
            k *= 2
        _POWERS[base] = have = p
    return have[:n]


def prefix_hashes(values: np.ndarray, base: int = BASE) -> np.ndarray:
    """S[i] = sum over j < i of values[j] * base**j, modulo 2**64."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values.astype(np.uint64) * powers(base, len(values)), out=out[1:])
    return out


def inverse(base: int = BASE) -> int:
    return pow(base, -1, 1 << 64)


def slice_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray,
                 base: int = BASE) -> np.ndarray:
    """Polynomial hashes of values[start:end], the same wherever the slice stands."""
    n = len(prefix)
    return (prefix[end] - prefix[start]) * powers(inverse(base), n)[start]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of every run of bytes that are no white space."""
    solid = np.zeros(len(data) + 2, bool)
    solid[1:-1] = ~_SPACE[data]
    first = solid[1:-1] & ~solid[:-2]
    last = solid[1:-1] & ~solid[2:]
    edges = offsets[1:-1]
    inner = edges[(edges > 0) & (edges < len(data))]
    if len(inner):  # a word never goes on in the next document
        first[inner] |= solid[1:-1][inner]
        last[inner - 1] |= solid[1:-1][inner - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of words; the length and a final scramble are part of them."""
    h = slice_hashes(prefix_hashes(data.astype(np.uint64) + np.uint64(1)), start, end)
    return mix64(h + (end - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


# --- groups ---------------------------------------------------------------------------------

def blocks_of(rows: DataFrame, keys: list[str], member: str, size: int) -> DataFrame:
    """Deal groups as pairs of blocks: adds ``i, j`` (the pair) and ``block``; drops lone members.

    A group of up to ``size`` rows is the one pair (0, 0).  Larger ones are cut by hash into blocks of
    about ``size``, and a member goes to every pair that has its block."""
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("members")).filter("members > 1")
    with_size = rows.join(sizes, keys)
    with_size = with_size.withColumn("blocks", F.ceil(F.col("members") / size).cast("int"))
    with_size = with_size.withColumn(
        "block", F.pmod(F.xxhash64(F.lit(5), member), F.col("blocks").cast("long")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return with_size.select("*", other).select(
        *rows.columns, "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))


def first_common(lists: pa.Array, now: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For members left x right with lists of group ids: True where ``now`` is the least id that both
    have (it is in all the lists).  A pair that meets in several groups counts in that one only."""
    owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    ids = lists.flatten().to_numpy()
    below = ids < now
    out = np.ones((len(left), len(right)), bool)
    if below.any():
        names, at = np.unique(ids[below], return_inverse=True)
        owner = owner[below]
        for a in range(0, len(names), 2048):  # a bounded table at a time
            some = (at >= a) & (at < a + 2048)
            has = np.zeros((len(lists), min(2048, len(names) - a)), np.float32)
            has[owner[some], at[some] - a] = 1
            out &= has[left] @ has[right].T == 0
    return out


def pairs_within(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows i < j of the same group, for groups [starts, ends) of a few rows each."""
    size = ends - starts
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for s in np.unique(size[size > 1]).tolist():
        a, b = np.triu_indices(s, 1)
        at = starts[size == s][:, None]
        left.append((at + a).ravel())
        right.append((at + b).ravel())
    return np.concatenate(left), np.concatenate(right)


def first_common_pairs(lists: pa.Array, now: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``first_common`` for single pairs of rows: both ascending lists are walked side by side until
    they meet or reach ``now``, for all pairs at once."""
    ids, start = lists.flatten().to_numpy(), lists.offsets.to_numpy().astype(np.int64)
    start = start - start[0]
    a, b = start[i], start[j]
    out = np.ones(len(i), bool)
    live = np.arange(len(i))
    while len(live):
        x, y = ids[a[live]], ids[b[live]]
        less = np.minimum(x, y) < now[live]  # ``now`` itself is in both lists
        out[live[(x == y) & less]] = False
        on = less & (x != y)
        step = live[on & (x < y)]
        a[step] += 1
        step = live[on & (y < x)]
        b[step] += 1
        live = live[on]
    return out


# --- graph ------------------------------------------------------------------------------------

def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """Connected components of ``edges(a, b)`` (longs): ``(node, component)``, smallest node as name.

    Alternating large-star and small-star rounds as joins and groupings.  Stars are taken by the
    smallest neighbour as an aggregate and joined back, so that no neighbourhood is gathered; every
    round is written to the shared folder.  Ends when a round changes nothing.
    """
    def star(links: DataFrame, large: bool) -> DataFrame:
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if not large:
            both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        out = both.join(low, "a")
        moved = out.filter(F.col("b") > F.col("a")) if large else out
        moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
        if not large:
            moved = moved.unionAll(low.select("a", F.col("m").alias("b")))
        return moved.filter("a <> b").distinct()

    with scratch(edges.sparkSession):
        links = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"),
                                                      F.least("a", "b").alias("b")).distinct(), "cc")
        mark = None
        for _ in range(rounds if links.limit(1).count() else 0):
            links = written(star(star(links, True), False), "cc")
            now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
            if tuple(now) == mark:
                break
            mark = tuple(now)
        else:
            if mark is not None:
                raise RuntimeError(f"components did not settle in {rounds} rounds")
        links = written(links, "cc", outer=True)
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def spanning_edges(n: int, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the graph with edges (i[k], j[k]) on n nodes: at most n - 1 edges."""
    label = np.arange(n)
    while True:  # hooking and pointer jumping on whole arrays
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        while True:
            jumped = new[new]
            if (jumped == new).all():
                break
            new = jumped
        if (new == label).all():
            break
        label = new
    own = np.flatnonzero(label != np.arange(n))
    return list(zip(own.tolist(), label[own].tolist()))
