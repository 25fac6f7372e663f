"""Periodic runs of words by Lyndon roots.

Phase one of a grouping suffix sorter puts the suffixes of a text into groups that share their longest
Lyndon prefix; the size of a suffix's group context is its entry of the Lyndon array.  ``lyndon`` does that in
linear time: places are blocks of one word; the highest group leaves first, and what
is left takes the blocks of it that follow at once, so it moves to a new group just above its own.  It is
run under the order of the words and under the opposite one: by the runs theorem the root of every
run is an entry of one of the two arrays.  Every root is extended to both sides by longest common extensions (prefix
polynomial hashes and binary search on whole arrays), and what is long enough is a run; runs are then
compared word by word, so that hashes decide nothing.

In a run of length >= max(``LEAST``, ``TIMES`` * period) every word stands in a stretch of
``GRAM`` words that starts twice in the text, so only such stretches need the Lyndon arrays: a run lies within one of
them, and no word beyond can extend it.

Words are runs of other bytes than x20 and x09 to x0D, compared as bytes.  Defined results: null and empty
texts have no words and no run, their digests are those of empty strings; repeated rows are texts of their own; texts are
taken whole, however long; a null id counts as empty text in the crc32 of ``planted``; an empty table
gives no rows; further columns aren't looked at.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tempora.llm.common import (binary_array, byte_slices, documents, prefix_hashes, slice_hashes, utf8,
                                word_hashes, words)

LEAST, TIMES, GRAM = 24, 3, 8


# --- Lyndon arrays ---------------------------------------------------------------------------------

def lyndon(symbols: list[int], first: list[bool]) -> array:
    """Length of the longest Lyndon word that starts at each place; texts start where ``first`` says.

    Symbols are ranks 0..k-1.  Groups are a chain from low to high; all texts share them."""
    n, k = len(symbols), max(symbols, default=-1) + 1
    members: list[list[int]] = [[] for _ in range(k)]
    for i, s in enumerate(symbols):
        members[s].append(i)
    group, size = array("q", symbols), array("q", [1]) * n
    below, above = list(range(-1, k - 1)), list(range(1, k + 1))
    before = array("q", (-1 if f else i - 1 for i, f in enumerate(first)))
    after = array("q", (-1 if i + 1 == n or first[i + 1] else i + 1 for i in range(n)))
    now = k - 1
    while now >= 0:
        stay = [i for i in members[now] if group[i] == now]  # ascending; the others moved up
        members[now] = []
        takers: dict[tuple[int, int], list[int]] = {}
        at, many = 0, len(stay)
        while at < many:
            start = i = stay[at]
            at += 1
            chain = 1
            while at < many and after[i] == stay[at]:  # blocks of this group on end
                i = stay[at]
                at += 1
                chain += 1
            j, behind = before[start], after[i]
            if behind >= 0:
                before[behind] = j
            if j >= 0:
                after[j] = behind
                size[j] += chain * size[start]
                takers.setdefault((group[j], chain), []).append(j)
        # a longer chain makes the higher group; all are just above the one they come from
        low = last = -1
        for old, chain in sorted(takers):
            new = len(members)
            low, last = old if old != last else low, old
            high = above[low]  # at most the group that leaves
            members.append(takers[old, chain])
            for j in takers[old, chain]:
                group[j] = new
            below.append(low)
            above.append(high)
            above[low] = below[high] = new
            low = new
        now = below[now]
    return size


# --- extensions ---------------------------------------------------------------------------------------

def _extension(prefix: np.ndarray, a: np.ndarray, b: np.ndarray, room: np.ndarray, back: bool) -> np.ndarray:
    """How many symbols agree from a and b on (``back``: before a and b), at most ``room``."""
    low, high = np.zeros(len(a), np.int64), room.astype(np.int64)
    live = np.flatnonzero(high > low)
    while len(live):
        half = (low[live] + high[live] + 1) // 2
        x, y = a[live], b[live]
        if back:
            same = slice_hashes(prefix, x - half, x) == slice_hashes(prefix, y - half, y)
        else:
            same = slice_hashes(prefix, x, x + half) == slice_hashes(prefix, y, y + half)
        low[live] = np.where(same, half, low[live])
        high[live] = np.where(same, high[live], half - 1)
        live = live[high[live] > low[live]]
    return low


def runs_in(number: np.ndarray, edge: np.ndarray, least: int, times: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of the runs of the texts number[edge[k]:edge[k + 1]], by start, then period."""
    none = np.empty(0, np.int64)
    n = len(number)
    if not n:
        return none, none, none
    of = np.searchsorted(edge, np.arange(n), "right") - 1
    begin, end = edge[of], edge[of + 1]
    first = np.zeros(n, bool)
    first[edge[:-1]] = True
    ranks = np.unique(number, return_inverse=True)[1]
    place, root = [], []
    for order in (ranks, ranks.max() - ranks):
        size = np.array(lyndon(order.tolist(), first.tolist()), np.int64)
        # the root of a run long enough is repeated at least ``times`` - 1 times less than one symbol
        at = np.flatnonzero((np.arange(n) + size <= end) & (times * size <= end - begin))
        place.append(at)
        root.append(size[at])
    i, p = np.concatenate(place), np.concatenate(root)
    for base in _BASES:
        prefix = prefix_hashes(ranks.astype(np.uint64) + np.uint64(1), base) if base else None
        right = _extension(prefix, i, i + p, end[i] - i - p, False) if base else _plain(ranks, i, p, end[i], 1)
        left = (_extension(prefix, i, i + p, i - begin[i], True) if base
                else _plain(ranks, i - 1, p, begin[i] - 1, -1))
        start, length = i - left, left + p + right
        long = length >= np.maximum(least, times * p)
        found = np.unique(np.stack([start[long], p[long], length[long]], axis=1), axis=0)
        start, period, length = found.T
        if base is None or _verified(ranks, begin, end, start, period, length):
            return start, length, period
    raise AssertionError("the last base compares symbols")


#: Bases of the hashes; if one is caught out the next is taken, at last plain comparison.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, None)


def _plain(ranks: np.ndarray, at: np.ndarray, p: np.ndarray, stop: np.ndarray, step: int) -> np.ndarray:
    """Extensions by comparing symbols: those of at, at + step, ... with the ones p further."""
    out = np.zeros(len(at), np.int64)
    x = at.copy()
    last = stop if step < 0 else stop - p
    live = np.flatnonzero(x != last)
    while len(live):
        live = live[ranks[x[live]] == ranks[x[live] + p[live]]]
        out[live] += 1
        x[live] += step
        live = live[x[live] != last[live]]
    return out


def _verified(ranks: np.ndarray, begin: np.ndarray, end: np.ndarray, start: np.ndarray, period: np.ndarray,
              length: np.ndarray) -> bool:
    """The runs are periodic word by word, and no neighbour extends them."""
    stop = start + length
    for s, t, p in zip(start.tolist(), stop.tolist(), period.tolist()):
        if not np.array_equal(ranks[s:t - p], ranks[s + p:t]):
            return False
    grows = (start > begin[start]) & (ranks[start - 1] == ranks[np.minimum(start - 1 + period, len(ranks) - 1)])
    beyond = np.minimum(stop, len(ranks) - 1)
    grows |= (stop < end[start]) & (ranks[beyond] == ranks[beyond - period])
    return not grows.any()


# --- texts -----------------------------------------------------------------------------------------------

def stretches(h: np.ndarray, doc: np.ndarray, gram: int) -> np.ndarray:
    """Marks the words that a run of ``gram`` words covers which starts twice in its text (by hashes)."""
    n = len(h)
    mark = np.zeros(n + 1, np.int64)
    if n > gram:
        prefix = prefix_hashes(h)
        start = np.arange(n - gram + 1)
        start = start[doc[start] == doc[start + gram - 1]]
        key = slice_hashes(prefix, start, start + gram)
        order = np.lexsort((key, doc[start]))
        key, at = key[order], start[order]
        same = (key[1:] == key[:-1]) & (doc[at[1:]] == doc[at[:-1]])
        twice = np.zeros(len(at), bool)
        twice[1:] |= same
        twice[:-1] |= same
        np.add.at(mark, at[twice], 1)
        np.add.at(mark, at[twice] + gram, -1)
    return np.cumsum(mark[:-1]) > 0


def find_runs(data: np.ndarray, start: np.ndarray, end: np.ndarray, h: np.ndarray, doc: np.ndarray,
              least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of the runs over a sequence of words, places in the sequence.

    ``start, end``: each word in ``data``; ``h``: its hash; ``doc``: its text, ascending."""
    if times < 2:
        raise ValueError("a run repeats its period at least twice")
    # a run repeats all of itself but one period, at least (1 - 1/times) of its length
    gram = max(1, min(GRAM, least - least // times))
    inside = stretches(h, doc, gram)
    at = np.flatnonzero(inside)
    if not len(at):
        return at, at, at
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (doc[at[1:]] != doc[at[:-1]])
    edge = np.append(np.flatnonzero(new), len(at))
    # equal words, compared as bytes, get one number
    number = binary_array(data, start[at], end[at]).dictionary_encode().indices.to_numpy().astype(np.int64)
    s, length, period = runs_in(number, edge, least, times)
    return at[s], length, period


def planted(ids: pa.Array, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word to replace, period) per document, -1 where it stays: for a tenth of the ids, told by
    the crc32, the words from a place on become the first few of them again and again."""
    first, period = np.full(len(many), -1, np.int64), np.zeros(len(many), np.int64)
    for k, (v, n) in enumerate(zip(ids.to_pylist(), many.tolist())):
        h = zlib.crc32(("" if v is None else str(v)).encode())
        if h % 10 == 0 and n > 0:
            g = h // 10
            first[k] = g % n
            period[k] = 1 + (n - first[k]) // (3 + g % 8)
    return first, period


def _joined(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(all words, each with a space behind it; where each begins)."""
    size = end - start
    put = np.concatenate([[0], np.cumsum(size + 1)])
    out = np.full(put[-1], 0x20, np.uint8)
    step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(put[:-1], size) + step] = data[np.repeat(start, size) + step]
    return out, put


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False,
                  least: int = LEAST, times: int = TIMES) -> DataFrame:
    """Per row ``<id_col>, runs, collapsed``: the runs (start, length, period), ascending, and the words that
    stay when every run keeps its first period only, joined by single spaces.

    ``plant`` makes the texts of a tenth of the ids periodic first (see ``planted``)."""
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", 2 << 20):
            data, offsets = utf8(batch.column("text"))
            start, end, doc = words(data, offsets)
            h = word_hashes(data, start, end)
            base = np.searchsorted(start, offsets)
            if plant:
                first, period = planted(batch.column("id"), np.diff(base))
                place = np.arange(len(start))
                a = first[doc] + base[doc]
                some = np.flatnonzero((first[doc] >= 0) & (place >= a))
                place[some] = a[some] + (some - a[some]) % period[doc[some]]
                start, end, h = start[place], end[place], h[place]
            s, length, period = find_runs(data, start, end, h, doc, least, times)
            gone = np.zeros(len(start) + 1, np.int64)
            np.add.at(gone, s + period, 1)
            np.add.at(gone, s + length, -1)
            stay = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
            text, put = _joined(data, start[stay], end[stay])
            left = put[np.searchsorted(stay, base)]
            per = np.searchsorted(s, base)
            own = s - base[doc[s]] if len(s) else s
            runs = pa.ListArray.from_arrays(
                pa.array(per, pa.int32()),
                pa.StructArray.from_arrays([pa.array(own), pa.array(length), pa.array(period)],
                                           fields=list(run_type.value_type)))
            collapsed = [text[x:max(x, y - 1)].tobytes() for x, y in zip(left, left[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), runs, pa.array(collapsed, pa.binary()).cast(pa.string())],
                names=[id_col, "runs", "collapsed"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, runs array<struct<start:long,length:long,period:long>>, "
                                "collapsed string")


def strongest(runs: list[dict]) -> tuple[int | None, ...]:
    """(start, length, period, exponent_milli) of the run with the greatest length / period; ties go to the
    smallest start, then period; four nulls without runs."""
    if not runs:
        return None, None, None, None
    r = max(runs, key=lambda r: (Fraction(r["length"], r["period"]), -r["start"], -r["period"]))
    return r["start"], r["length"], r["period"], 1000 * r["length"] // r["period"]


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``<id_col>, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256`` per row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = batch.column("runs").to_pylist()
            best = list(zip(*map(strongest, runs))) or [()] * 4
            lines = ("".join(f"{r['start']},{r['length']},{r['period']}\n" for r in own) for own in runs)
            texts = batch.column("collapsed").cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.array([len(own) for own in runs], pa.int64()),
                 *(pa.array(column, pa.int64()) for column in best),
                 pa.array([hashlib.sha256(v.encode()).hexdigest() for v in lines], pa.string()),
                 pa.array([hashlib.sha256(v.as_buffer()).hexdigest() for v in texts], pa.string())],
                names=[id_col, "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                       "collapsed_sha256"])

    kind = found.schema[id_col].dataType.simpleString()
    return found.mapInArrow(run, f"`{id_col}` {kind}, n_runs long, start long, length long, period long, "
                                 "exponent_milli long, runs_sha256 string, collapsed_sha256 string")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(periodic_runs(documents(spark, sf_dir), plant=True))
