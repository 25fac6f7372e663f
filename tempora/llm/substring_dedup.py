"""Substring deduplication on words by compressed FM-indexes and backward search.

The pieces of ``tempora.llm.anchors`` are dealt to shards by the hash of their anchor, so that equal
windows are in one shard.  Each shard is indexed: words get numbers, the pieces on end are sorted by
their first ``DEPTH`` words or twice the window (prefix doubling; no pattern is longer), and the last column goes into a
wavelet matrix of packed bits with counts per 64.  The pieces then stream through their shard's index,
all side by side: backward search adds a word in front of every pattern at a time and gives up where
fewer than two occurrences are left, which yields the longest repeated stretch before each end (the
matching statistics); windows within it are repeated, those that hold it and the next word aren't, and
the search jumps on behind them.  After a success the next pattern covers twice as many windows.

Words are runs of other bytes than x20 and x09 to x0D, unchanged.  Removed is every word covered by a
window of ``WINDOW`` words that also starts anywhere else, in the same text or another one, judged on
the input.  Defined results: a null text has no words; texts under ``WINDOW`` words keep everything;
repeated rows are texts of their own, so each loses what the other has; all texts are read whole, however
long; an empty table gives no rows.  Of the table the id and the text are read, so that no other column's name can clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tempora.llm.anchors import covered, rows_of, with_runs
from tempora.llm.common import (binary_array, byte_slices, documents, utf8, word_hashes, words)

WINDOW, GRAM, DEPTH = 35, 6, 128


class FMIndex:
    """Index of sequences of numbers >= 1, each followed by 0; finds patterns of up to ``depth`` - 1."""

    def __init__(self, text: np.ndarray, depth: int = DEPTH):
        n = len(text)
        order, rank, step = np.argsort(text, kind="stable"), text, 1
        while step < depth:
            after = np.zeros(n, np.int64)
            after[:-step] = rank[step:] + 1 if step < n else 0
            key = rank.astype(np.int64) * (n + int(text.max(initial=0)) + 3) + after
            order = np.argsort(key, kind="stable")
            new = np.zeros(n, np.int64)
            new[order[1:]] = np.cumsum(key[order[1:]] != key[order[:-1]])
            rank, step = new, step * 2
            if n and new.max() == n - 1:
                break
        self.n = n
        last = text[order - 1] if n else text  # the word before each suffix; before the first the last one
        top = int(text.max(initial=0))
        self.levels = max(1, top.bit_length())
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))]).astype(np.int64)
        self.bits, self.ones, self.zeros = [], [], []
        for level in reversed(range(self.levels)):
            bit = (last >> level) & 1 == 1
            packed = np.zeros((n // 64 + 1) * 64, bool)
            packed[:n] = bit
            word = np.packbits(packed, bitorder="little").view(np.uint64)
            self.bits.append(word)
            self.ones.append(np.concatenate([[0], np.cumsum(np.bitwise_count(word), dtype=np.int32)]).astype(np.int32))
            self.zeros.append(int(n - bit.sum()))
            last = np.concatenate([last[~bit], last[bit]])
        self.first = self._down(np.arange(top + 1), np.zeros(top + 1, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, level in enumerate(reversed(range(self.levels))):
            block = at >> 6
            mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.ones[k][block] + np.bitwise_count(self.bits[k][block] & mask)
            at = np.where((symbol >> level) & 1 == 1, self.zeros[k] + ones, at - ones)
        return at

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of the pattern with ``symbol`` put in front, for ranges [low, high)."""
        both = self._down(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        shift = self.before[symbol] - self.first[symbol]
        return both[:len(symbol)] + shift, both[len(symbol):] + shift


def repeated_windows(index: FMIndex, text: np.ndarray, start: np.ndarray, n: np.ndarray, window: int
                     ) -> np.ndarray:
    """Marks (piece, window) for the windows of the pieces that the index holds twice or more.

    ``start``: where each piece begins in ``text``, ``n``: its windows."""
    marks = np.zeros((len(start), int(n.max(initial=0)) + 1), bool)
    s = np.zeros(len(start), np.int64)  # the window to decide next
    more = np.zeros(len(start), np.int64)  # windows after it that the pattern covers too
    live = np.flatnonzero(n > 0)
    end = s + window  # of the pattern, exclusive
    at = end.copy()
    low, high = np.zeros(len(start), np.int64), np.full(len(start), index.n)
    while len(live):
        lo, hi = index.step(text[start[live] + at[live] - 1], low[live], high[live])
        on = hi - lo >= 2
        go = live[on]
        low[go], high[go] = lo[on], hi[on]
        at[go] -= 1
        done = go[at[go] == s[go]]  # the pattern stands twice: so do all windows in it
        for k in range(int(more[done].max(initial=-1)) + 1):
            some = done[more[done] >= k]
            marks[some, s[some] + k] = True
        s[done] += more[done] + 1
        more[done] = more[done] * 2 + 1
        failed = live[~on]
        # text[at-1 : end] stands once only; windows that hold all of it are out
        single = failed[more[failed] == 0]
        s[single] = at[single]
        more[failed] = 0
        fresh = np.concatenate([done, failed])
        more[fresh] = np.maximum(np.minimum(more[fresh], n[fresh] - 1 - s[fresh]), 0)
        end[fresh] = s[fresh] + more[fresh] + window
        at[fresh], low[fresh], high[fresh] = end[fresh], 0, index.n
        live = live[s[live] < n[live]]
    return marks


def matched(window: int) -> Callable[[pa.Table], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of windows of single pieces that stand in the shard twice or more."""
    def match(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data, ends = utf8(table.column("piece").chunk(0))
        start, end, _ = words(data, ends)
        offsets = np.searchsorted(start, ends)
        # equal words, compared as bytes, get one number
        number = binary_array(data, start, end).dictionary_encode().indices.to_numpy().astype(np.int64) + 1
        many = np.diff(offsets)
        text = np.zeros(len(number) + len(many), np.int64)
        place = np.arange(len(number)) + np.repeat(np.arange(len(many)), many)
        text[place] = number
        at = offsets[:-1] + np.arange(len(many))
        n = table.column("n").to_numpy().astype(np.int64)
        marks = repeated_windows(FMIndex(text, max(DEPTH, 2 * window)), text, at, n, window)
        flat = np.diff(marks.astype(np.int8), axis=1, prepend=0)
        row, first = np.nonzero(flat == 1)
        _, after = np.nonzero(flat == -1)
        return row, first, after - 1

    return match


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, offsets of the texts in them)."""
    data, offsets = utf8(texts)
    start, end, _ = words(data, offsets)
    return word_hashes(data, start, end), np.searchsorted(start, offsets)


def _cut(texts: pa.Array, doc: np.ndarray, first: np.ndarray, after: np.ndarray) -> pa.Array:
    data, offsets = utf8(texts)
    start, end, _ = words(data, offsets)
    base = np.searchsorted(start, offsets)[doc]
    return binary_array(data, start[base + first], end[base + after - 1])


def repeated_words(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``id, th, text, runs``: each row with the ranges of words that repeated windows cover."""
    return with_runs(rows_of(docs, id_col, text_col), window, gram, _words, _cut, matched(window))


def without_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``<id_col>, n_words, n_removed, kept_sha256, kept`` per row; ``kept`` is the text of the words
    that stay, joined by single spaces."""
    found = repeated_words(docs, window, gram, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            start, end, _ = words(data, offsets)
            at = np.searchsorted(start, offsets)
            gone = covered(batch.column("runs"), at)
            total = np.concatenate([[0], np.cumsum(gone)])
            # the words that stay, each with a space behind it
            stay = np.flatnonzero(~gone)
            size = end[stay] - start[stay]
            put = np.concatenate([[0], np.cumsum(size + 1)])
            out = np.full(put[-1], 0x20, np.uint8)
            of = np.repeat(np.arange(len(stay)), size)
            step = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
            out[put[of] + step] = data[start[stay][of] + step]
            left = put[np.searchsorted(stay, at)]
            kept = [out[a:max(a, b - 1)].tobytes() for a, b in zip(left, left[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.diff(at), pa.int64()),
                 pa.array(np.diff(total[at]), pa.int64()),
                 pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                names=[id_col, "n_words", "n_removed", "kept_sha256", "kept"])

    kind = found.schema["id"].dataType.simpleString()
    return found.mapInArrow(run, f"`{id_col}` {kind}, n_words long, n_removed long, kept_sha256 string, "
                                 "kept string")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(documents(spark, sf_dir)).drop("kept")


OP6_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
k AS (SELECT doc_id, s, md5(array_to_string(w[s:s + 34], ' ')) AS k
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS s FROM d) u),
r AS (SELECT doc_id, s FROM k JOIN (SELECT k FROM k GROUP BY k HAVING count(*) > 1) t USING (k)),
i AS (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 35 THEN 0 ELSE 1 END AS new
      FROM r),
g AS (SELECT doc_id, s, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS g FROM i),
runs AS (SELECT doc_id, min(s) AS a, max(s) + 35 AS b FROM g GROUP BY doc_id, g),
gaps AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 1) AS z FROM runs),
kept AS (SELECT doc_id, sum(b - a) AS n_removed,
                list_concat(flatten(list(w[z:a - 1] ORDER BY a)), any_value(w)[max(b):]) AS w
         FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(coalesce(kept.w, d.w), ' ')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
