"""Minimax contiguous sharding: rows with equal texts are atomic groups, in digest order.

The smallest capacity for which a greedy pass over the ordered group sizes needs no more than
``shards`` shards is found by binary search; the cuts then keep to that capacity.  The groups stay
in Spark: the driver holds at most ``PIECES`` runs of consecutive groups per round, with their bytes.
A pass that may cut a run anywhere bounds the capacity and each cut from one side, a pass that may
not cut runs from the other; only runs between the two bounds can hold a cut, and only they are
split in the next round, until those are single groups and the search is exact.  Below the
capacity, each cut goes where it leaves the remaining shards most equal.

Defined results: the size of a row is its UTF-8 bytes plus ``OVERHEAD``; a null text has no bytes and
is in one group with the empty ones; a group larger than an equal share sets the capacity; with
fewer groups than shards some shards stay empty; repeated rows get slots of their own; slots count
from 0 without gaps in each shard, by digest and id; an empty table gives an empty result.  Further columns aren't looked at.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.common import documents, scratch, written
from tempora.llm.exact_dedup import digest

SHARDS, OVERHEAD, PIECES = 24, 8, 20_000
_IN_PARTITION = (1 << 33) - 1  # the low bits of monotonically_increasing_id()


def _numbered(df: DataFrame, *order: str) -> DataFrame:
    """``df`` in ``order``, written, with ``pid`` and the row's place ``nth`` in its partition."""
    rid = F.monotonically_increasing_id()
    return written(df.repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn("rid", rid), "sharding") \
        .withColumn("pid", F.shiftright("rid", 33)).withColumn(
            "nth", F.col("rid").bitwiseAND(F.lit(_IN_PARTITION))).drop("rid")


class Runs:
    """Ordered runs of groups: boundaries ``at`` (group numbers), bytes before each, single or not."""

    def __init__(self, at: np.ndarray, size: np.ndarray):
        self.at, self.before = at, np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        self.single = np.diff(at) == 1

    def reach(self, x: int, capacity: int, divisible: bool) -> int:
        """Where a shard that starts at byte ``x`` must end; runs that aren't single may be cut."""
        end = min(x + capacity, int(self.before[-1]))
        j = int(np.searchsorted(self.before, end, "right")) - 1
        if j == len(self.single) or not divisible or self.single[j]:
            return int(self.before[j])
        return end

    def passed(self, capacity: int, shards: int, divisible: bool, x: int = 0) -> list[int]:
        """The ends of a greedy pass from byte ``x``."""
        ends = []
        for _ in range(shards):
            x = max(x, self.reach(x, capacity, divisible))
            ends.append(x)
        return ends

    def smallest(self, shards: int, divisible: bool, low: int, high: int) -> int:
        """Binary search for the smallest capacity that is enough."""
        total = int(self.before[-1])
        while low < high:
            mid = (low + high) // 2
            if self.passed(mid, shards, divisible)[-1] >= total:
                high = mid
            else:
                low = mid + 1
        return low

    def undecided(self, shards: int, largest: int) -> np.ndarray:
        """The runs of more than one group that a cut could fall into."""
        total = int(self.before[-1])
        least = max(largest, -(-total // shards))
        low = self.smallest(shards, True, least, total)
        wide = np.flatnonzero(~self.single & (np.diff(self.before) > low))
        if len(wide):  # no shard can hold these whole, so they must be split before anything else
            return wide
        high = self.smallest(shards, False, low, total)
        if low == high:  # enough with runs kept whole, and nothing smaller is
            return np.empty(0, np.int64)
        first, last = self.passed(low, shards, False), self.passed(high, shards, True)
        hit = np.zeros(len(self.single), bool)
        for a, b in zip(first, last):
            hit |= (self.before[1:] > a) & (self.before[:-1] < b)
            j = int(np.searchsorted(self.before, a, "right")) - 1
            if j < len(hit):
                hit[j] = True
        return np.flatnonzero(hit & ~self.single)

    def cuts(self, shards: int, largest: int) -> tuple[int, list[int]]:
        """(capacity, group numbers at which shards 1, 2, ... begin)."""
        total = int(self.before[-1])
        capacity = self.smallest(shards, False, max(largest, -(-total // shards)), total)
        x, out = 0, []
        for left in range(shards, 1, -1):
            even = x + (total - x) / left
            far = self.reach(x, capacity, False)
            j = int(np.searchsorted(self.before, even))
            near = sorted({int(self.before[k]) for k in (j - 1, j) if 0 <= k < len(self.before)},
                          key=lambda y: abs(y - even))
            near = [y for y in near if x <= y <= far
                    and self.passed(capacity, left - 1, False, y)[-1] >= total]
            x = near[0] if near else max(x, far)
            out.append(int(self.at[np.searchsorted(self.before, x)]))
        return capacity, out


def _split(groups: DataFrame, runs: Runs | None, picked: np.ndarray, n: int, pieces: int) -> Runs:
    """One job: the bytes of ``picked`` runs (or of all groups) in at most ``pieces`` parts."""
    if runs is None:
        width = -(-n // pieces)
        got = groups.groupBy(F.floor(F.col("g") / width).alias("k"), F.lit(0).alias("r"))
        spans = [(0, n)]
    else:
        spans = [(int(runs.at[i]), int(runs.at[i + 1])) for i in picked]
        # narrower than the longest of them, so that every round splits something
        width = max(1, min(-(-sum(b - a for a, b in spans) // max(1, pieces - len(spans))),
                           max(b - a for a, b in spans) // 2))
        # the steps of ``width`` groups that a span meets, so that the join goes by the step's number;
        # at most PIECES of them and two more per span: a bounded side
        of = groups.sparkSession.createDataFrame(
            [(k, i, a, b) for i, (a, b) in enumerate(_merged(spans)) for k in range(a // width, (b - 1) // width + 1)],
            "k long, r int, a long, b long")
        got = groups.withColumn("k", F.floor(F.col("g") / width)).join(F.broadcast(of), "k")
        got = got.filter((F.col("g") >= F.col("a")) & (F.col("g") < F.col("b"))).groupBy("k", "r")
    rows = got.agg(F.min("g").alias("a"), F.max("g").alias("b"), F.sum("bytes").alias("s")).collect()
    new = sorted((x.a, x.b + 1, x.s) for x in rows)
    if runs is not None:
        gone = set(picked.tolist())
        new += [(int(runs.at[i]), int(runs.at[i + 1]), int(runs.before[i + 1] - runs.before[i]))
                for i in range(len(runs.single)) if i not in gone]
        new.sort()
    return Runs(np.array([x[0] for x in new] + [n], np.int64), np.array([x[2] for x in new], np.int64))


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and out[-1][1] == a:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def minimax_cuts(groups: DataFrame, n: int, shards: int, pieces: int = PIECES) -> tuple[int, list[int]]:
    """(smallest capacity, first groups of shards 1, 2, ...) of ``groups(g, bytes)``, g = 0 .. n-1."""
    largest = groups.agg(F.max("bytes")).first()[0]
    runs = _split(groups, None, np.empty(0), n, pieces)
    while len(open_ := runs.undecided(shards, largest)):
        runs = _split(groups, runs, open_, n, max(pieces, 2 * len(open_)))
    return runs.cuts(shards, largest)


def sharded(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
            pieces: int = PIECES) -> DataFrame:
    """``<id_col>, size, text_crc32, shard, slot`` for every row."""
    text = F.col(text_col)
    raw = F.coalesce(text, F.lit("")).cast("binary")
    with scratch(docs.sparkSession):
        rows = written(docs.select(F.col(id_col).alias("id"), F.octet_length(raw).cast("long").alias("n"),
                                   F.crc32(raw).alias("crc"), digest(text).alias("digest"))
                       .withColumn("size", F.col("n") + OVERHEAD).drop("n"), "sharding")
        spark = docs.sparkSession
        groups = _numbered(written(rows.groupBy("digest").agg(F.sum("size").alias("bytes")), "sharding"),
                           "digest")
        counts = sorted(groups.groupBy("pid").count().collect())  # a row per partition
        n, firsts = 0, []
        for pid, c in counts:
            firsts.append((pid, n))
            n += c
        first = spark.createDataFrame(firsts, "pid long, first long")
        groups = written(groups.join(F.broadcast(first), "pid").select(
            "digest", "bytes", (F.col("first") + F.col("nth")).alias("g")), "sharding")
        cuts = minimax_cuts(groups, n, shards, pieces)[1] if n else []
        shard = F.lit(0)
        for c in cuts:
            shard = shard + (F.col("g") >= F.lit(c)).cast("int")
        placed = written(rows.join(groups.select("digest", shard.alias("shard")), "digest"), "sharding")
        placed = _numbered(placed, "shard", "digest", "id")
        parts = sorted(placed.groupBy("shard", "pid").agg(F.count("*").alias("c"), F.min("nth").alias("m"))
                       .collect())  # partitions + shards rows at most
        offsets, seen = [], {}
        for s, pid, c, m in parts:
            offsets.append((s, pid, seen.get(s, 0) - m))
            seen[s] = seen.get(s, 0) + c
        offset = spark.createDataFrame(offsets, "shard int, pid long, shift long")
        return written(placed.join(F.broadcast(offset), ["shard", "pid"]).select(
            F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard",
            (F.col("nth") + F.col("shift")).alias("slot")), "sharding", outer=True)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def sharding_law(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds for every shard: ``shard, rows, bytes`` of the whole table are told by ``total_rows, total_bytes``;
    ``together`` (no text of it is in another shard), ``gapless`` (slots from 0), ``even`` (no larger than an equal
    share and one group of equal texts)."""
    rows = documents(spark, sf_dir).select("doc_id", digest(F.col("text")).alias("digest"))
    placed = sharded(documents(spark, sf_dir)).join(
        rows.groupBy("doc_id").agg(F.min("digest").alias("digest")), "doc_id")
    groups = placed.groupBy("digest").agg(F.sum("size").alias("bytes"), F.min("shard").alias("a"), F.max("shard").alias("z"))
    whole = groups.agg(F.sum("bytes").alias("total"), F.max("bytes").alias("largest"))
    apart = groups.filter("a <> z").select(F.explode(F.array("a", "z")).alias("shard")).distinct().withColumn(
        "apart", F.lit(True))
    per = placed.groupBy("shard").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"),
                                      F.max("slot").alias("last"), F.countDistinct("slot").alias("slots"))
    even = F.col("bytes") <= F.ceil(whole.select("total").scalar() / SHARDS) + whole.select("largest").scalar()
    return per.join(apart, "shard", "left").select(
        "shard", F.coalesce(~F.col("apart"), F.lit(True)).alias("together"),
        ((F.col("last") == F.col("rows") - 1) & (F.col("slots") == F.col("rows"))).alias("gapless"), even.alias("even"),
        placed.agg(F.count("*")).scalar().alias("total_rows"), whole.select("total").scalar().alias("total_bytes"))


LAW_SQL = """
SELECT CAST(s.shard AS INTEGER) AS shard, true AS together, true AS gapless, true AS even, total_rows, total_bytes
FROM unnest(range(0, 24)) AS s(shard),
     (SELECT count(*) AS total_rows, CAST(sum(strlen(coalesce(text, '')) + 8) AS BIGINT) AS total_bytes FROM documents) t
"""
