"""Repeated windows of token sequences: which windows can be equal, and the pieces to compare.

All windows of ``window`` tokens are told apart by their anchor: the last of the runs of ``gram``
tokens with the smallest hash in the window.  Equal windows have equal anchors at equal places, so
windows with different anchors never need to meet.  Consecutive windows with one anchor make a span,
about 2 / (window - gram) spans a token.

Spans that a document holds several times (as "la la la ..." does) are compared token by token where they stand
and go on as one with a count, and as
the range that they cover.  The spans of all documents are counted by anchor, then those with a shared
anchor by content, which makes kinds.  Of each kind that stands once its span goes, with its text, to the task that compares the
windows of that anchor; of a kind that stands several times two go there as witnesses: only if the comparison finds
all of their windows repeated is the kind repeated wherever it stands.  If witnesses differ, a hash has lied, and
all spans of that kind are compared by their text.  Anchors with more than ``GROUP`` kinds (a third of all documents may share
a line) are compared by two hashes of their single windows instead, counted with partial sums.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.llm.common import (BASE, binary_array, byte_slices, inverse, mix64, powers, prefix_hashes,
                                scratch, signed, utf8, whole_groups, written)

GROUP = 4096
_BITS = 16  # of each of the two lengths in ``loc``; the rest is for places of up to 2**31 tokens


_PRIME, _PRIME_BASE = (1 << 31) - 1, 1_103_515_247
_PRIME_POWERS: dict[int, np.ndarray] = {}


def _prime_powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo the prime, kept between calls."""
    have = _PRIME_POWERS.get(base)
    if have is None or len(have) < n:
        p, k = np.ones(1 << max(16, n.bit_length()), np.uint64), 1
        while k < len(p):
            p[k:2 * k] = p[:k] * np.uint64(pow(base, k, _PRIME)) % np.uint64(_PRIME)
            k *= 2
        _PRIME_POWERS[base] = have = p
    return have[:n]


def prime_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hashes of slices modulo a prime: texts that collide modulo 2**64 under every base (those in the order
    of Thue and Morse) don't here."""
    prime, n = np.uint64(_PRIME), len(values)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(values % prime * _prime_powers(_PRIME_BASE, n) % prime, out=prefix[1:])  # below 2**64 up to 2**33 tokens
    back = _prime_powers(pow(_PRIME_BASE, -1, _PRIME), n + 1)[start]
    return (prefix[end] - prefix[start]) % prime * back % prime


def spans(values: np.ndarray, offsets: np.ndarray, window: int, gram: int
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, anchor, first window, last window, anchor hash, content hash) of the spans of
    sequences on end; places count from the start of ``values``."""
    none = np.empty(0, np.int64)
    grams = window - gram + 1
    n = len(values) - window + 1
    if n <= 0:
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    prefix = prefix_hashes(values)
    back = powers(inverse(BASE), len(prefix))
    h = mix64((prefix[gram:] - prefix[:-gram]) * back[:len(prefix) - gram])
    best, at = h, np.arange(len(h), dtype=np.int32)
    width = 1

    def least(step: int) -> tuple[np.ndarray, np.ndarray]:  # of two ranges, the later one if equal
        later = best[step:] <= best[:-step]
        return np.where(later, best[step:], best[:-step]), np.where(later, at[step:], at[:-step])

    while width * 2 <= grams:
        best, at = least(width)
        width *= 2
    if width < grams:
        best, at = least(grams - width)
    start = np.arange(n)
    of = np.searchsorted(offsets, start, "right") - 1
    inside = start + window <= offsets[of + 1]
    start, of, at = start[inside], of[inside], at[inside].astype(np.int64)
    if not len(start):
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    new = np.ones(len(start), bool)
    new[1:] = (at[1:] != at[:-1]) | (of[1:] != of[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    doc, anchor, low, high = of[first], at[first], start[first], start[last]
    content = (prefix[high + window] - prefix[low]) * back[low]
    content ^= mix64(prime_hashes(values, low, high + window))
    content = mix64(content ^ mix64(((anchor - low) << 20 | (high - low)).astype(np.uint64)))
    return doc, anchor, low, high, h[anchor], content


Tokens = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]
#: (texts, documents, first tokens, last tokens + 1) -> the bytes of those pieces
Cutter = Callable[[pa.Array, np.ndarray, np.ndarray, np.ndarray], pa.Array]
#: pieces of whole groups -> (row of the table, first window, last window) of runs of repeated windows
Matcher = Callable[[pa.Table], tuple[np.ndarray, np.ndarray, np.ndarray]]


def _within(doc: np.ndarray, key: np.ndarray, content: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the spans of a few documents: (the first of each kind in its document, the last of it; how many of its kind
    its document has and which is the first of it, for every span)."""
    order = np.lexsort((content, key, doc))
    new = np.ones(len(order), bool)
    for x in (doc, key, content):
        new[1:] &= x[order][1:] == x[order][:-1]
    new[1:] = ~new[1:]
    kind = np.cumsum(new) - 1
    at = np.flatnonzero(new)
    first, last = order[at], order[np.append(at[1:], len(order)) - 1] if len(order) else order
    many, of = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    if len(order):
        many[order], of[order] = np.bincount(kind)[kind], first[kind]
    by = np.argsort(first)
    return first[by], last[by], many, of


def _unlike(values: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray, at_once: int = 1 << 20) -> np.ndarray:
    """Which of the slices of ``length`` tokens from a and from b on differ in any token."""
    out = np.zeros(len(a), bool)
    start = 0
    ends = np.cumsum(length)
    while start < len(a):  # about ``at_once`` tokens at a time
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + at_once)))
        n = length[start:stop]
        row = np.repeat(np.arange(len(n)), n)
        step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        differ = values[a[start:stop][row] + step] != values[b[start:stop][row] + step]
        out[start + np.unique(row[differ])] = True
        start = stop
    return out


def _merged(doc: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, document) of the unions of ranges that overlap or touch; both ends ascend."""
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (begin[1:] > end[:-1])
    last = np.append(new[1:], True) if len(doc) else new
    return begin[new], end[last], doc[new]


def _span_rows(batch: pa.RecordBatch, doc: np.ndarray, loc: np.ndarray, loc2: np.ndarray | None, key: np.ndarray | None,
               content: np.ndarray | None, many: np.ndarray | None, end: np.ndarray | None) -> pa.RecordBatch:
    take, none = pa.array(doc), pa.nulls(len(doc), pa.int64())
    return pa.RecordBatch.from_arrays(
        [none if key is None else signed(key), none if content is None else signed(content),
         batch.column("id").take(take), batch.column("th").take(take), pa.array(loc, pa.int64()),
         none if loc2 is None else pa.array(loc2, pa.int64(), mask=many < 2),
         none if many is None else pa.array(many, pa.int64()), none if end is None else pa.array(end, pa.int64())],
        names=["a", "h", "id", "th", "loc", "loc2", "n", "e"])


def rows_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, th, text``: the hash tells apart rows that repeat an id with another text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.hash(text).alias("th"),
                       text.alias("text"))


def _same(left: str, right: str):
    return F.col(left + "id").eqNullSafe(F.col(right + "id")) & (F.col(left + "th") == F.col(right + "th"))


def repeated(rows: DataFrame, window: int, gram: int, tokens: Tokens, cut: Cutter, match: Matcher,
             group: int = GROUP) -> DataFrame:
    """``id, th, runs`` for ``rows(id, th, text)``: the token ranges covered by windows that start
    elsewhere too."""
    if window - gram >= 1 << _BITS:
        raise ValueError(f"windows of {window} tokens are too long: places in a span have {_BITS} bits")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", 1 << 20):
            values, offsets = tokens(batch.column("text"))
            doc, anchor, low, high, key, content = spans(values, offsets, window, gram)
            first, last, many, of = _within(doc, key, content)
            # spans of a kind that differ from its first one become kinds of their own
            check = np.flatnonzero(of != np.arange(len(of)))
            lie = check[_unlike(values, low[check], low[of[check]], high[check] - low[check] + window)]
            if len(lie):
                content[lie] = mix64(content[lie] ^ mix64(lie.astype(np.uint64) + np.uint64(1)))
                first, last, many, of = _within(doc, key, content)
            again = many > 1
            begin, end, where = _merged(doc[again], low[again], high[again] + window)
            loc = ((low - offsets[doc]) << 2 * _BITS) | ((anchor - low) << _BITS) | (high - low)
            yield _span_rows(batch, doc[first], loc[first], loc[last], key[first], content[first], many[first], None)
            yield _span_rows(batch, where, begin - offsets[where], None, None, None, None, end - offsets[where])

    kind = rows.schema["id"].dataType.simpleString()
    with scratch(rows.sparkSession):  # the spans of anchors that stand once aren't kept beyond this
        every = written(rows.mapInArrow(
            find, f"a long, h long, id {kind}, th int, loc long, loc2 long, n long, e long"), "spans")
        counted = every.filter("e IS NULL").drop("e")
        shared = written(counted.groupBy("a").agg(F.sum("n").alias("n")).filter("n > 1").select("a"), "spans")
        live = written(counted.join(shared, "a"), "spans", outer=True)
        inner = written(every.filter("e IS NOT NULL").select("id", "th", F.col("loc").alias("s"), "e"), "spans",
                        outer=True)
    kinds = written(live.groupBy("a", "h").agg(
        F.sum("n").alias("c"), F.min(F.struct("id", "th", "loc", "loc2")).alias("m"),
        F.max(F.struct("id", "th", "loc")).alias("x")), "spans")
    # witnesses: two rows, or two places of one row; rows that repeat id and text need none
    rows_differ = ~(F.col("m.id").eqNullSafe(F.col("x.id")) & (F.col("m.th") == F.col("x.th")))
    one = F.struct("m.id", "m.th", "m.loc")
    two = (F.when(rows_differ, F.struct("x.id", "x.th", "x.loc"))
           .when(F.col("m.loc2").isNotNull(), F.struct("m.id", "m.th", F.col("m.loc2").alias("loc"))))
    pair = F.when(F.col("c") > 1, two)
    per = kinds.groupBy("a").agg(F.count("*").alias("kinds"), F.max(pair.isNotNull()).alias("doubt"))
    members = (kinds.join(per.filter("kinds > 1 OR doubt"), "a")
               .select("a", "h", "c", "kinds", F.explode(F.filter(F.array(one, pair), lambda w: w.isNotNull())).alias("w"))
               .select("a", "h", "c", "kinds", "w.*"))
    runs = f"id {kind}, th int, s long, e long"

    def compare(table: pa.Table) -> Iterator[pa.RecordBatch]:
        row, first, last = match(table)
        alone = table.column("c").to_numpy()[row] == 1
        sure = row[~alone & (first == 0) & (last == table.column("n").to_numpy()[row] - 1)]
        row, first, last = row[alone], first[alone], last[alone]
        at = table.column("low").to_numpy()[row]
        for take, s, e in ((row, at + first, at + last + window), (sure, None, None)):
            part = table.select(["a", "h", "id", "th"]).take(pa.array(take)).combine_chunks()
            for batch in part.to_batches():
                no = pa.nulls(batch.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, no if s is None else pa.array(s, pa.int64()),
                     no if e is None else pa.array(e, pa.int64()), no, no, no], names=names)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "piece", 1 << 18):
            values, offsets = tokens(batch.column("piece"))
            n = batch.column("n").to_numpy().astype(np.int64)
            row = np.repeat(np.arange(len(n)), n)
            w = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = offsets[row] + w
            h = []
            for b in (BASE, 0xD1342543DE82EF95):
                prefix = prefix_hashes(values + np.uint64(1), b)
                h.append(signed((prefix[at + window] - prefix[at]) * powers(inverse(b), len(prefix))[at]))
            take, no = pa.array(row), pa.nulls(len(row), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [no, no, *[batch.column(c).take(take) for c in ("id", "th")],
                 pa.array(batch.column("low").to_numpy()[row] + w, pa.int64()), no, *h, batch.column("c").take(take)],
                names=names)

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["a"], 4096):
            wide = pc.greater(table.column("kinds"), group)
            few = table.filter(pc.invert(wide)).combine_chunks()
            if few.num_rows:
                yield from compare(few)
            yield from windows(table.filter(wide).to_batches())

    names = ["a", "h", "id", "th", "s", "e", "h1", "h2", "c"]

    def compared_in(some: DataFrame) -> DataFrame:
        # anchors of many kinds are dealt to many tasks; their text goes through one shuffle and no table
        salt = F.when(F.col("kinds") > group, F.pmod(F.hash("id", "low"), F.lit(1024))).otherwise(0)
        return written(some.repartition("a", salt).sortWithinPartitions("a").mapInArrow(
            both, f"a long, h long, {runs}, h1 long, h2 long, c long"), "spans")

    compared = compared_in(_pieces(members, rows, window, cut))
    # kinds that stand several times: told by witnesses, by one row that repeats, or by hashes of windows
    sure = compared.filter("s IS NULL AND h1 IS NULL").select("a", "h").distinct().withColumn("sure", F.lit(True))
    several = kinds.filter("c > 1").select("a", "h", pair.isNotNull().alias("doubt")).join(
        per.select("a", "kinds"), "a").join(sure, ["a", "h"], "left")
    several = written(several, "spans")
    lie = several.filter(F.col("doubt") & (F.col("kinds") <= group) & F.col("sure").isNull()).select("a", "h")
    if lie.limit(1).count():  # witnesses differ: all spans of their kinds go by their text
        lie = written(lie, "spans")
        these = lie.select("a").distinct()
        each = live.join(lie, ["a", "h"]).join(per.select("a", "kinds"), "a").select(
            "a", "h", F.lit(1).cast("long").alias("c"), "kinds", "id", "th", "loc")
        rest = members.join(lie, ["a", "h"], "left_anti").join(these, "a", "left_semi")
        compared = compared.join(these, "a", "left_anti").unionByName(  # (rows of windows have no anchor)
            compared_in(_pieces(rest.unionByName(each.select(rest.columns)), rows, window, cut)))
        several = several.join(lie, ["a", "h"], "left_anti")
    large = compared.filter("h1 IS NOT NULL").select("h1", "h2", "id", "th", "c", "s")
    again = written(large.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter("n > 1"), "spans")
    found = [compared.filter("s IS NOT NULL AND h1 IS NULL").select("id", "th", "s", "e"),
             large.filter("c = 1").join(again, ["h1", "h2"])
             .select("id", "th", "s", (F.col("s") + window).alias("e"))]
    low = F.shiftright("loc", 2 * _BITS)
    span = F.col("loc").bitwiseAND(F.lit((1 << _BITS) - 1))
    found.append(live.join(several.select("a", "h"), ["a", "h"])
                 .select("id", "th", low.alias("s"), (low + span + window).alias("e")))
    found.append(inner)
    return (reduce(DataFrame.unionAll, found)
            # equal rows have equal runs: each once, so that n of them don't get n times n
            .groupBy("id", "th").agg(F.collect_set(F.struct("s", "e")).alias("runs")))


def _pieces(members: DataFrame, rows: DataFrame, window: int, cut: Cutter) -> DataFrame:
    """``a, h, c, kinds, id, th, low, n, left, piece``: the tokens of each span; ``n`` windows from token
    ``low`` of the document on, the anchor ``left`` tokens into the piece."""
    of = members.groupBy("id", "th").agg(F.collect_list(F.struct("loc", "a", "h", "c", "kinds")).alias("spans"))
    of = of.select(F.col("id").alias("oid"), F.col("th").alias("oth"), "spans")
    text = rows.join(of, _same("", "o")).select("id", "th", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", 1 << 20):
            lists = batch.column("spans")
            doc = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            loc, a, h, c, kinds = lists.flatten().flatten()
            loc = loc.to_numpy()
            low = loc >> 2 * _BITS
            left = (loc >> _BITS) & ((1 << _BITS) - 1)
            n = (loc & ((1 << _BITS) - 1)) + 1
            take = pa.array(doc)
            piece = cut(batch.column("text"), doc, low, low + n - 1 + window)
            yield pa.RecordBatch.from_arrays(
                [a, h, c, kinds, batch.column("id").take(take), batch.column("th").take(take),
                 pa.array(low, pa.int64()), pa.array(n, pa.int32()), pa.array(left, pa.int32()), piece],
                names=["a", "h", "c", "kinds", "id", "th", "low", "n", "left", "piece"])

    kind = rows.schema["id"].dataType.simpleString()
    got = text.mapInArrow(run, f"a long, h long, c long, kinds long, id {kind}, th int, low long, n int, left int, "
                               "piece binary")
    return got


def cut_bytes(texts: pa.Array, doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    data, offsets = utf8(texts)
    return binary_array(data, offsets[doc] + start, offsets[doc] + end)


def covered(lists: pa.Array, offsets: np.ndarray) -> np.ndarray:
    """Which tokens of sequences on end the runs of each cover."""
    n = int(offsets[-1])
    step = np.zeros(n + 1, np.int64)
    lists = lists.fill_null([]) if lists.null_count else lists
    doc = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    s, e = (x.to_numpy() for x in lists.flatten().flatten())
    np.add.at(step, offsets[doc] + s, 1)
    np.add.at(step, offsets[doc] + e, -1)
    return np.cumsum(step[:-1]) > 0


def with_runs(rows: DataFrame, window: int, gram: int, tokens: Tokens, cut: Cutter, match: Matcher
              ) -> DataFrame:
    """``rows`` with the ``runs`` of tokens that ``repeated`` finds (null: none)."""
    with scratch(rows.sparkSession):
        runs = written(repeated(rows, window, gram, tokens, cut, match), "spans", outer=True)
    runs = runs.select(F.col("id").alias("oid"), F.col("th").alias("oth"), "runs")
    return rows.join(runs, _same("", "o"), "left").select("id", "th", "text", "runs")
