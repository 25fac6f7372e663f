"""Substring deduplication on bytes by a suffix sort that compares through hashes.

Prefix sums of a polynomial hash give the hash of any substring; a binary search over lengths finds
how far two suffixes agree in a logarithmic number of comparisons, and a merge sort built on that
comparison sorts suffixes without reading them through.  All of it works on arrays: a merge finds the
places of all elements of all runs at once by binary search in the sibling run.

The suffixes sorted are those at the anchors of ``tempora.llm.anchors``, not all: every window of
``WINDOW`` bytes that stands twice has its anchor in common.  The texts to the right of the anchors
are sorted, and those to the left, read backwards.  A window that reaches ``o`` bytes back from its
anchor equals another one if the two neighbourhoods agree for ``WINDOW - o`` bytes to the right and
``o`` bytes to the left: both are runs of neighbours in the two orders.  The agreements of neighbours
are then read byte by byte; if a hash has lied, the sort is done again with another base.

Removed is every byte covered by a window that also starts anywhere else, in the same text or another
one, judged on the input.  Defined results: a null text counts as empty; texts under ``WINDOW`` bytes
keep everything; repeated rows are texts of their own, so each loses what the other has; all texts
are read whole, however long, as UTF-8 bytes; matches never go across texts; an empty table gives no rows.
Of the table the id and the text are read, so that no other column's name can clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.anchors import covered, cut_bytes, rows_of, with_runs
from tempora.llm.common import BASE, byte_slices, documents, inverse, powers, prefix_hashes, utf8

WINDOW, GRAM = 200, 32


class Suffixes:
    """Suffixes of a byte buffer: each starts at ``at`` and ends before ``at + length``."""

    def __init__(self, data: np.ndarray, at: np.ndarray, length: np.ndarray, base: int):
        self.data, self.at, self.length = np.append(data, 0), at, length
        self.prefix = prefix_hashes(data.astype(np.uint64) + np.uint64(1), base)
        self.back = powers(inverse(base), len(self.prefix))[at]

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many bytes suffixes i and j share: binary search over equal hashes."""
        low = np.zeros(len(i), np.int64)
        high = np.minimum(self.length[i], self.length[j])
        a, b, p = self.at[i], self.at[j], self.prefix
        pa_, pb, ba, bb = p[a], p[b], self.back[i], self.back[j]
        for _ in range(int(high.max(initial=0)).bit_length()):
            mid = (low + high + 1) >> 1
            same = (p[a + mid] - pa_) * ba == (p[b + mid] - pb) * bb
            low = np.where(same, mid, low)
            high = np.where(same, high, np.maximum(mid - 1, low))
        return low

    def less(self, i: np.ndarray, j: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """suffix i < suffix j (or <=, where told)."""
        n = self.common(i, j)
        ends_i, ends_j = n == self.length[i], n == self.length[j]
        smaller = self.data[self.at[i] + np.where(ends_i, 0, n)] < self.data[self.at[j] + np.where(ends_j, 0, n)]
        return np.where(ends_i & ends_j, or_equal, ends_i | (~ends_j & smaller))

    def sorted_in(self, group: np.ndarray) -> np.ndarray:
        """The suffixes in order within each group (``group`` ascends): bottom-up merge sort."""
        n = len(self.at)
        order = np.arange(n)
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if n else order
        size = np.diff(np.append(first, n))
        start, many = np.repeat(first, size), np.repeat(size, size)
        width = 1
        while width < size.max(initial=0):
            x = np.flatnonzero(many > width)  # elements of groups that are not yet one run
            rel = x - start[x]
            right = (rel // width) % 2 == 1
            pair = start[x] + rel // (2 * width) * 2 * width
            middle = np.minimum(pair + width, start[x] + many[x])
            end = np.minimum(pair + 2 * width, start[x] + many[x])
            low, high = np.where(right, pair, middle), np.where(right, middle, end)
            begin = low.copy()
            live = np.flatnonzero(low < high)
            while len(live):  # how many of the sibling run come before
                mid = (low[live] + high[live]) >> 1
                other = order[mid]
                # equal elements of the left run stay before those of the right one
                before = self.less(other, order[x[live]], right[live])
                low[live] = np.where(before, mid + 1, low[live])
                high[live] = np.where(before, high[live], mid)
                live = live[low[live] < high[live]]
            own = np.where(right, x - middle, x - pair)
            new = order.copy()
            new[pair + own + low - begin] = order[x]
            order = new
            width *= 2
        return order

    def agreements(self, order: np.ndarray, group: np.ndarray) -> np.ndarray | None:
        """For each place in ``order``: bytes in common with the suffix before it, -1 at the start of a
        group; None if the bytes tell that a hash lied."""
        out = np.full(len(order), -1, np.int64)
        x = np.flatnonzero(group[1:] == group[:-1]) + 1
        i, j = order[x - 1], order[x]
        out[x] = n = self.common(i, j)
        for a in range(0, len(x), 4096):
            part = slice(a, a + 4096)
            of = np.repeat(np.arange(len(n[part])), n[part])
            step = np.arange(len(of)) - np.repeat(np.cumsum(n[part]) - n[part], n[part])
            if (self.data[self.at[i[part]][of] + step] != self.data[self.at[j[part]][of] + step]).any():
                return None
        ends_i, ends_j = n == self.length[i], n == self.length[j]
        differ = self.data[self.at[i] + np.where(ends_i, 0, n)] < self.data[self.at[j] + np.where(ends_j, 0, n)]
        return out if (ends_i | (~ends_j & differ)).all() else None


def suffix_order(data: np.ndarray, at: np.ndarray, length: np.ndarray, group: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray]:
    """(order within groups, agreement of each place with the one before), verified."""
    base = BASE
    for _ in range(4):
        s = Suffixes(data, at, length, base)
        order = s.sorted_in(group)
        agree = s.agreements(order, group)
        if agree is not None:
            return order, agree
        base = (base * 0xD1342543DE82EF95 + 2) % (1 << 64) | 1
    # texts made for it (over a thousand bytes, so not within windows of 200) collide under every base
    raise RuntimeError("suffixes of different text have equal hashes under four bases")


def matched(window: int) -> Callable[[pa.Table], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of windows of pieces that stand in another piece of the group too."""
    def match(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data, offsets = utf8(table.column("piece").chunk(0))
        group = table.column("a").to_numpy()
        left = table.column("left").to_numpy().astype(np.int64)
        n = table.column("n").to_numpy().astype(np.int64)
        size = np.diff(offsets)
        anchor = offsets[:-1] + left
        right_order, right = suffix_order(data, anchor, size - left, group)
        left_order, back = suffix_order(data[::-1], len(data) - anchor, left, group)
        rows = len(n)
        marks = np.zeros((rows, int(n.max(initial=0)) + 1), bool)
        least = left - n + 1
        for o in range(int(least.min(initial=0)), int(left.max(initial=-1)) + 1):
            live = np.flatnonzero((least <= o) & (o <= left))
            if len(live) < 2:
                continue
            r, b = np.empty(rows, np.int64), np.empty(rows, np.int64)
            r[right_order] = np.cumsum(right < window - o)
            b[left_order] = np.cumsum(back < o)
            key = r[live] * (rows + 1) + b[live]
            by = np.argsort(key)
            twice = key[by][1:] == key[by][:-1]
            hit = live[by[np.append(twice, False) | np.append(False, twice)]]
            marks[hit, left[hit] - o] = True
        flat = np.diff(marks.astype(np.int8), axis=1, prepend=0)
        row, first = np.nonzero(flat == 1)
        _, after = np.nonzero(flat == -1)
        return row, first, after - 1

    return match


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = utf8(texts)
    return data.astype(np.uint64), offsets


def repeated_bytes(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``id, th, text, runs``: each row with the byte ranges that repeated windows cover."""
    return with_runs(rows_of(docs, id_col, text_col), window, gram, _bytes, cut_bytes, matched(window))


def without_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``<id_col>, n_bytes, n_removed, n_spans, kept_sha256, kept`` per row; ``kept`` are the bytes that
    stay."""
    found = repeated_bytes(docs, window, gram, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            gone = covered(batch.column("runs"), offsets)
            total = np.concatenate([[0], np.cumsum(gone)])
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            edge = offsets[:-1][offsets[:-1] < len(gone)]
            begins[edge] = gone[edge]  # a run ends with its text
            begun = np.concatenate([[0], np.cumsum(begins)])
            kept = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.diff(offsets), pa.int64()),
                 pa.array(np.diff(total[offsets]), pa.int64()), pa.array(np.diff(begun[offsets]), pa.int64()),
                 pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                 pa.array(kept, pa.binary())],
                names=[id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    kind = found.schema["id"].dataType.simpleString()
    return found.mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, "
                                 "kept_sha256 string, kept binary")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(documents(spark, sf_dir)).drop("kept")


OP1_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, s, md5(substr(h, 2 * s + 1, 400)) AS k
      FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 199)) AS s FROM d) u),
r AS (SELECT doc_id, s FROM w JOIN (SELECT k FROM w GROUP BY k HAVING count(*) > 1) t USING (k)),
i AS (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 200 THEN 0 ELSE 1 END AS new
      FROM r),
g AS (SELECT doc_id, s, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS g FROM i),
runs AS (SELECT doc_id, min(s) AS a, max(s) + 200 AS b FROM g GROUP BY doc_id, g),
gaps AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS z FROM runs),
kept AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed,
                string_agg(substr(h, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS h
         FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
