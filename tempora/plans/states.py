"""Continuous aggregates kept as mergeable partial states.

The table holds, per (bucket, keys), what can be put together with further rows: counts, minima, maxima,
the first and last value with their order, mean and squared deviations, quantile sketches.  A
batch of new rows is aggregated alone, merged with the states of its own dates, and published as one version
of a store: a refresh reads the new rows and those states, never the raw history.  A batch that runs
again is known by its writer and number and changes nothing; late rows of any age count.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempora.functions import aggs, timefns
from tempora.plans import cagg
from tempora.sources.versioned import Conflict, Store

CHUNK = "1 day"


@dataclass(frozen=True)
class Measure:
    """A result column and the state it is read from.

    ``partial``: state columns as aggregates of raw rows; ``merge``: the same columns as
    aggregates of states; ``final``: the result from the state columns."""

    name: str
    partial: dict[str, Column]
    merge: dict[str, Column]
    final: Column


def count_rows(name: str) -> Measure:
    n = f"{name}_n"
    return Measure(name, {n: F.count(F.lit(1))}, {n: F.sum(n)}, F.col(n))


def lowest(name: str, value: str) -> Measure:
    s = f"{name}_s"
    return Measure(name, {s: F.min(value)}, {s: F.min(s)}, F.col(s))


def highest(name: str, value: str) -> Measure:
    s = f"{name}_s"
    return Measure(name, {s: F.max(value)}, {s: F.max(s)}, F.col(s))


def _edge(name: str, value: str, time: str, ties: Iterable[str], pick: Callable, last: bool) -> Measure:
    """The value at the first or last (time, ties), kept beside its order."""
    s = f"{name}_s"
    order = F.struct(F.col(time).alias("t"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(ties)])
    state = F.struct(order.alias("at"), F.col(value).alias("value"))
    state = pick(F.when(F.col(time).isNotNull(), state), F.when(F.col(time).isNotNull(), order))
    return Measure(name, {s: state}, {s: pick(F.col(s), F.col(f"{s}.at"))}, F.col(f"{s}.value"))


def first(name: str, value: str, time: str, ties: Iterable[str] = ()) -> Measure:
    return _edge(name, value, time, ties, F.min_by, False)


def last(name: str, value: str, time: str, ties: Iterable[str] = ()) -> Measure:
    return _edge(name, value, time, ties, F.max_by, True)


def counter_delta(name: str, value: str, time: str, ties: Iterable[str] = ()) -> Measure:
    a, z = first(f"{name}_first", value, time, ties), last(f"{name}_last", value, time, ties)
    return Measure(name, a.partial | z.partial, a.merge | z.merge,
                   F.rint((z.final - a.final) * F.lit(100.0)) / F.lit(100.0))


def _moments(value: str) -> tuple[str, dict[str, Column], dict[str, Column]]:
    """State (n, mean, squared deviations).  Two states meet by their means' distance, which loses
    nothing where the mean is large; a group has the old state and the new one, so its list is short.
    Mean and deviation of a value share one state."""
    s = f"{value}_moments"
    v = F.col(value).cast("double")
    partial = F.struct(F.count(v).alias("n"), F.coalesce(F.avg(v), F.lit(0.0)).alias("mean"),
                       F.coalesce(F.var_pop(v) * F.count(v), F.lit(0.0)).alias("m2"))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def add(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        some = F.greatest(n, F.lit(1))
        d = b["mean"] - a["mean"]
        return F.struct(n.alias("n"), (a["mean"] + d * b["n"] / some).alias("mean"),
                        (a["m2"] + b["m2"] + d * d * a["n"] * b["n"] / some).alias("m2"))

    return s, {s: partial}, {s: F.aggregate(F.collect_list(s), zero, add)}


def average(name: str, value: str) -> Measure:
    s, partial, merge = _moments(value)
    return Measure(name, partial, merge, F.when(F.col(f"{s}.n") > 0, F.col(f"{s}.mean")))


def deviation(name: str, value: str) -> Measure:
    """Sample standard deviation; null for one row."""
    s, partial, merge = _moments(value)
    return Measure(name, partial, merge,
                   F.when(F.col(f"{s}.n") > 1, F.sqrt(F.col(f"{s}.m2") / (F.col(f"{s}.n") - 1))))


def median(name: str, value: str) -> Measure:
    """Median of a quantile sketch; its rank is off by the sketch's error at most."""
    s = f"{name}_s"
    return Measure(name, {s: aggs.kll_sketch(value)}, {s: aggs.kll_merge(s)}, aggs.kll_median(s))


def temperature_measures(value: str = "temperature") -> list[Measure]:
    return [count_rows("reading_count"), average(f"avg_{value}", value), lowest(f"min_{value}", value),
            highest(f"max_{value}", value), deviation(f"stddev_{value}", value)]


def candle_measures() -> list[Measure]:
    ties = ["day_volume", "price"]
    return [first("open", "price", "time", ties), highest("high", "price"), lowest("low", "price"),
            last("close", "price", "time", ties), last("day_volume", "day_volume", "time", ties)]


def measures_of(name: str) -> list[Measure]:
    """The states of the reference's aggregate of that name."""
    if name.startswith("kwh"):
        return [counter_delta("value", "value", "created", ["value"])]
    return candle_measures() if name.endswith("candle") else temperature_measures()


@dataclass
class StateAggregate:
    """A declared continuous aggregate whose table holds states."""

    spec: cagg.ContinuousAggregate
    measures: list[Measure]
    store: Store

    @property
    def _group(self) -> list[str]:
        return [self.spec.bucket_name, *self.spec.keys]

    def partial(self, rows: DataFrame) -> DataFrame:
        spec = self.spec
        rows = rows if spec.where is None else rows.filter(spec.where())
        bucket = timefns.bucket(spec.time_col, spec.width, spec.tz).alias(spec.bucket_name)
        states = {c: v for m in self.measures for c, v in m.partial.items()}
        return rows.groupBy(bucket, *spec.keys).agg(*[v.alias(c) for c, v in states.items()])

    def merged(self, states: DataFrame) -> DataFrame:
        merge = {c: v for m in self.measures for c, v in m.merge.items()}
        return states.groupBy(*self._group).agg(*[v.alias(c) for c, v in merge.items()])

    def absorb(self, rows: DataFrame, writer: str, batch: int) -> int | None:
        """Count new rows in; None if this batch of the writer has been counted before."""
        store, table = self.store, self.spec.name
        if store.committed(writer, batch):
            return None
        commit = store.begin()
        # the batch's own states, written once: what follows reads these few rows
        fresh = commit.add_chunked(table, self.partial(rows), self.spec.bucket_name, None, CHUNK)
        while True:
            state = store.state()
            chunks = {p.chunk for p in fresh}
            old = [p for p in state.parts(table) if p.chunk in chunks]
            commit.added, commit.removed, commit.expected = list(fresh), [], []
            commit.expect(table, chunks, old)
            if old:
                commit.added = []
                state.schemas |= commit.schemas
                both = store.frame(table, [*fresh, *old], state)
                commit.add_chunked(table, self.merged(both), self.spec.bucket_name, None, CHUNK)
                commit.remove(old)
            try:
                return commit.commit(writer, batch)
            except Conflict:  # another writer merged into the same dates: do it on top of theirs
                continue

    def read(self, as_of: datetime | None = None, after: datetime | None = None) -> DataFrame:
        """The results; with ``as_of`` of the buckets that the policy has closed by then, ``after``
        of later buckets only (older chunks aren't listed)."""
        hi = self.spec.window(as_of)[1] if as_of is not None else None
        df = self.store.read(self.spec.name, None, self.spec.bucket_name, after, hi)
        if after is not None:
            df = df.filter(F.col(self.spec.bucket_name) > timefns.ntz_literal(after))
        return df.select(*self._group, *[m.final.alias(m.name) for m in self.measures])

    def stream(self, raw_stream: DataFrame, checkpoint: str, writer: str = "stream", trigger: dict | None = None):
        """Absorb a stream of raw rows; without a watermark, as states take late rows of any age."""
        w = (raw_stream.writeStream.foreachBatch(lambda df, n: self.absorb(df, writer, n) and None)
             .option("checkpointLocation", checkpoint))
        return w.trigger(**(trigger or {"processingTime": self.spec.policy.trigger})).start()


def define(name: str, root: str, spark) -> StateAggregate:
    """One of the reference's seven aggregates as states below ``root``."""
    return StateAggregate(cagg.define(name, f"{root}/{name}"), measures_of(name), Store(spark, root))
