"""Continuous aggregates: a declared time-bucket GROUP BY materialised as a
table, kept current by range refreshes under a policy (K8, W1-W3).

Two runners share one spec:

* batch: ``create`` materialises everything; ``refresh(raw, as_of)``
  recomputes exactly the buckets wholly inside
  [as_of - start_offset, as_of - end_offset) and rewrites only the
  ``bucket_date`` partitions those buckets live in (dynamic partition
  overwrite).  Rows older than the window never change; the newest bucket
  is held back - the late-data rule of the reference.
* streaming: ``stream`` runs the same aggregate as a Structured Streaming
  ``window`` aggregation with the watermark at ``start_offset``, merged
  into the same table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime, time, timedelta, timezone
from functools import reduce
from operator import and_, or_
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tempora.functions import aggs, timefns
from tempora.operators import layout
from tempora.session import checkpointed, delete_path, exists, list_dirs, read_text, write_text


@dataclass(frozen=True)
class RefreshPolicy:
    start_offset: timedelta | None      # None = unbounded (refresh all history)
    end_offset: timedelta
    schedule_interval: timedelta

    @staticmethod
    def of(start, end, schedule) -> "RefreshPolicy":
        p = timefns.parse_width
        return RefreshPolicy(None if start is None else p(start), p(end), p(schedule))

    @property
    def trigger(self) -> str:
        return f"{int(self.schedule_interval.total_seconds())} seconds"

    @property
    def watermark(self) -> str:
        if self.start_offset is None:
            raise ValueError("an unbounded policy keeps every late row; no watermark can: "
                             "run it by run_policy, or stream it with an explicit lateness")
        return f"{int(self.start_offset.total_seconds())} seconds"


def _floor(t: datetime, width, tz: str | None) -> datetime:
    if not tz:
        return timefns.bucket_floor(t, width)
    z = ZoneInfo(tz)
    local = t.replace(tzinfo=timezone.utc).astimezone(z).replace(tzinfo=None)
    start = timefns.bucket_floor(local, width)
    return start.replace(tzinfo=z).astimezone(timezone.utc).replace(tzinfo=None)


def _ceil(t: datetime, width, tz: str | None) -> datetime:
    f = _floor(t, width, tz)
    if f == t:
        return f
    return _floor(t + timefns.parse_width(width), width, tz)


def _dates(rows: DataFrame, day: Column) -> list[date]:
    """The distinct dates of some rows: at most one per day of history goes to the driver."""
    got = rows.select(day.alias("d")).distinct().collect()
    return sorted(r["d"] for r in got if r["d"] is not None)


def _stretches(dates: list[date], most: int = 100) -> list[tuple[date, date]]:
    """Runs of consecutive dates; of more than ``most`` the shortest gaps are closed."""
    gaps = sorted(range(1, len(dates)), key=lambda i: dates[i - 1] - dates[i])[:most - 1]
    cuts = [0, *sorted(i for i in gaps if (dates[i] - dates[i - 1]).days > 1), len(dates)]
    return [(dates[a], dates[b - 1]) for a, b in zip(cuts, cuts[1:])]


def _on(dates: list[date], most: int = 1000) -> Column:
    """Partition predicate of those dates (their span, if they are more than ``most``)."""
    d = F.col("bucket_date")
    if not dates:
        return F.lit(False)
    if len(dates) <= most:
        return d.isin(dates)
    return (d >= F.lit(dates[0])) & (d <= F.lit(dates[-1]))


@dataclass
class ContinuousAggregate:
    name: str
    time_col: str
    width: str
    keys: Sequence[str]
    measures: Callable[[], list[Column]]
    policy: RefreshPolicy
    path: str
    tz: str | None = None
    where: Callable[[], Column] | None = None
    bucket_name: str = "bucket"
    raw_chunk_interval: str | None = None  # where known (layout.known_interval), prunes its chunks

    # -- the declared query ------------------------------------------------
    def compute(self, raw: DataFrame, lo: datetime | None = None,
                hi: datetime | None = None) -> DataFrame:
        rows = raw
        if self.where is not None:
            rows = rows.filter(self.where())
        if lo is not None:  # lo/hi are bucket starts: bucket in [lo,hi) <=> ts in [lo,hi)
            rows = rows.filter(F.col(self.time_col) >= timefns.ntz_literal(lo))
        if hi is not None:
            rows = rows.filter(F.col(self.time_col) < timefns.ntz_literal(hi))
        if self.raw_chunk_interval and "chunk" in raw.columns and (lo is not None or hi is not None):
            # a raw table whose interval is known: skip whole chunk directories as well
            rows = rows.filter(layout.chunk_range_filter(lo, hi, self.raw_chunk_interval))
        b = timefns.bucket(self.time_col, self.width, self.tz).alias(self.bucket_name)
        out = rows.groupBy(b, *[F.col(k) for k in self.keys]).agg(*self.measures())
        return out.withColumn("bucket_date", F.to_date(F.col(self.bucket_name)))

    def window(self, as_of: datetime) -> tuple[datetime | None, datetime]:
        """[lo, hi): the buckets a refresh at ``as_of`` may rewrite."""
        p = self.policy
        lo = None if p.start_offset is None else _ceil(as_of - p.start_offset, self.width, self.tz)
        hi = _floor(as_of - p.end_offset, self.width, self.tz)
        return lo, hi

    # -- batch runner ------------------------------------------------------
    def _clustered(self, df: DataFrame) -> DataFrame:
        """Range-partition and sort on (date, keys, bucket): few files per date, a date or key holding
        most rows is still split across tasks, and a key's buckets stand in few row groups of a date."""
        order = ["bucket_date", *self.keys, self.bucket_name]
        return df.repartitionByRange(*order).sortWithinPartitions(*order)

    def create(self, raw: DataFrame) -> None:
        """CREATE MATERIALIZED VIEW .. WITH DATA: full materialisation."""
        self._write_new(self.compute(raw))

    def _write_new(self, rows: DataFrame) -> None:
        (self._clustered(rows).write.mode("overwrite").option("compression", "zstd")
         .partitionBy("bucket_date").parquet(self.path))
        # without a row there is no file that would tell the columns
        schema = StructType([StructField(f.name, f.dataType, True) for f in rows.schema.fields])
        write_text(rows.sparkSession, f"{self.path}/_columns", schema.json())

    def _table(self, spark: SparkSession) -> DataFrame:
        """The materialised rows with their ``bucket_date``."""
        columns = read_text(spark, f"{self.path}/_columns")
        reader = spark.read.schema(StructType.fromJson(json.loads(columns))) if columns else spark.read
        return reader.parquet(self.path)

    def refresh(self, raw: DataFrame, as_of: datetime) -> tuple[datetime | None, datetime]:
        spark = raw.sparkSession
        lo, hi = self.window(as_of)
        if lo is not None and lo >= hi:
            return lo, hi
        fresh = self.compute(raw, lo, hi)
        first_day = None if lo is None else lo.date()
        last_day = (hi - timedelta(microseconds=1)).date()
        touched = F.col("bucket_date") <= F.lit(last_day)
        if first_day is not None:
            touched = touched & (F.col("bucket_date") >= F.lit(first_day))
        b = F.col(self.bucket_name)
        in_window = b < timefns.ntz_literal(hi)
        if lo is not None:
            in_window = in_window & (b >= timefns.ntz_literal(lo))
        table = self._table(spark).filter(touched)
        dates = _dates(table, F.col("bucket_date"))
        kept = table.filter(~in_window)
        self._overwrite_dates(spark, kept.unionByName(fresh.select(*kept.columns)), dates)
        return lo, hi

    # -- invalidation log --------------------------------------------------
    @property
    def _log(self) -> str:
        return f"{self.path}/_invalidated"  # readers skip names with a leading underscore

    def invalidate(self, changed: DataFrame, batch: int | None = None) -> None:
        """Note the buckets that ``changed`` rows fall into, until a refresh covers them.

        One folder of distinct buckets for each call; ``batch`` names it, so that a batch noted
        twice is noted once."""
        rows = changed if self.where is None else changed.filter(self.where())
        b = timefns.bucket(self.time_col, self.width, self.tz)
        name = f"new-{uuid.uuid4().hex}" if batch is None else f"batch-{batch}"
        (rows.select(b.alias(self.bucket_name)).filter(F.col(self.bucket_name).isNotNull()).distinct()
         .write.mode("overwrite").parquet(f"{self._log}/{name}"))

    def invalidated(self, spark: SparkSession) -> DataFrame | None:
        """The noted buckets that no refresh has covered yet; None if nothing was ever noted."""
        names = list_dirs(spark, self._log)
        return self._entries(spark, names) if names else None

    def _entries(self, spark: SparkSession, names: list[str]) -> DataFrame:
        return spark.read.parquet(*[f"{self._log}/{n}" for n in names]).distinct()

    def refresh_changed(self, raw: DataFrame, changed: DataFrame | None, as_of: datetime,
                        batch: int | None = None) -> tuple[datetime | None, datetime]:
        """Refresh driven by invalidation: recompute only the buckets inside
        the policy window that received rows since a refresh covered them.

        ``changed`` (e.g. the ingest's newest batch) is noted first.  Buckets the
        window doesn't cover - those not closed at ``as_of`` - stay noted for a later run.
        Equivalent to ``refresh`` when every other bucket's rows are unchanged, but its
        cost follows the new data, not the history - the point for policies whose window
        is unbounded.  A run that dies before its end is repeated by the next one.
        """
        spark = raw.sparkSession
        if changed is not None:
            self.invalidate(changed, batch)
        lo, hi = self.window(as_of)
        names = list_dirs(spark, self._log)
        if not names or (lo is not None and lo >= hi):
            return lo, hi
        noted = F.col(self.bucket_name)
        covered = noted < timefns.ntz_literal(hi)
        if lo is not None:
            covered = covered & (noted >= timefns.ntz_literal(lo))
        entries = checkpointed(self._entries(spark, names))
        due = entries.filter(covered)
        dates = _dates(due, F.to_date(self.bucket_name))
        if dates:
            t = F.col(self.time_col)
            width = timefns.parse_width(self.width) + timedelta(hours=3)  # a change of the clock
            ranges = [(datetime.combine(a, time()) - timedelta(hours=3),
                       datetime.combine(z, time()) + timedelta(days=1) + width)
                      for a, z in _stretches(dates)]
            spans = [(t >= timefns.ntz_literal(a)) & (t < timefns.ntz_literal(z)) for a, z in ranges]
            if self.raw_chunk_interval and "chunk" in raw.columns:
                spans = [s & layout.chunk_range_filter(a, z, self.raw_chunk_interval)
                         for s, (a, z) in zip(spans, ranges)]
            # raw rows of the dates of noted buckets only, in the scan; of those the noted buckets
            cand = raw.filter(reduce(or_, spans)).withColumn(
                "_b", timefns.bucket(self.time_col, self.width, self.tz))
            cand = cand.join(due.withColumnRenamed(self.bucket_name, "_b"), "_b", "left_semi").drop("_b")
            self._replace(spark, self.compute(cand), due, [self.bucket_name], dates)
        left = entries.filter(~covered)
        left.write.parquet(f"{self._log}/open-{uuid.uuid4().hex}")
        for name in names:  # what was noted meanwhile is not among them
            delete_path(spark, f"{self._log}/{name}")
        return lo, hi

    def run_policy(self, raw: DataFrame, changed: DataFrame | None, as_of: datetime,
                   batch: int | None = None) -> tuple[datetime | None, datetime]:
        """What the schedule runs: a bounded window is recomputed, an
        unbounded one only where rows have changed (see ``refresh_changed``)."""
        if self.policy.start_offset is None:
            return self.refresh_changed(raw, changed, as_of, batch)
        return self.refresh(raw, as_of)

    def _replace(self, spark: SparkSession, fresh: DataFrame, gone: DataFrame,
                 keys: list[str], dates: list[date]) -> None:
        """Replace the rows whose ``keys`` are in ``gone`` by ``fresh``, and rewrite only
        the ``dates`` of either: they are literals, so the scan skips all other partitions
        (but that of rows without a time).  Null keys are equal to each other."""
        old = self._table(spark).filter(_on(dates) | F.col("bucket_date").isNull())
        names = {k: f"_gone_{i}" for i, k in enumerate(keys)}
        marks = gone.select(*[F.col(k).alias(n) for k, n in names.items()])
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
        kept = old.join(marks, same, "left_anti")
        self._overwrite_dates(spark, kept.unionByName(fresh.select(*kept.columns)), dates)

    def _overwrite_dates(self, spark: SparkSession, rows: DataFrame, dates: list[date]) -> None:
        # The table is both read and overwritten: cut the lineage first.
        staged = checkpointed(self._clustered(rows))
        (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .option("compression", "zstd").partitionBy("bucket_date").parquet(self.path))
        # A rewritten date whose buckets all vanished is not replaced by a
        # dynamic overwrite; remove those (rare) directories one by one.
        for d in sorted(set(dates) - set(_dates(staged, F.col("bucket_date")))):
            delete_path(spark, f"{self.path}/bucket_date={d.isoformat()}")

    def read(self, spark: SparkSession, after: datetime | None = None) -> DataFrame:
        """The materialised rows; ``after`` keeps buckets later than it and
        prunes the ``bucket_date`` partitions that cannot hold them."""
        df = self._table(spark)
        if after is not None:
            df = df.filter((F.col("bucket_date") >= F.lit(after.date()))
                           & (F.col(self.bucket_name) > timefns.ntz_literal(after)))
        return df.drop("bucket_date")

    def drop(self, spark: SparkSession) -> None:
        delete_path(spark, self.path)

    # -- streaming runner --------------------------------------------------
    def stream_frame(self, raw_stream: DataFrame, lateness=None) -> DataFrame:
        """The windowed streaming aggregate.  Rows later than the watermark -
        ``lateness``, else the policy's start offset - no longer count."""
        delay = (self.policy.watermark if lateness is None
                 else f"{int(timefns.parse_width(lateness).total_seconds())} seconds")
        t = F.col(self.time_col)
        rows = raw_stream
        if self.where is not None:
            rows = rows.filter(self.where())
        if self.tz:
            # Watermark and window on local wall-clock time, then back to UTC.
            rows = rows.withColumn("_evt", timefns.ntz_to_instant(timefns.at_time_zone(t, self.tz)))
        else:
            rows = rows.withColumn("_evt", timefns.ntz_to_instant(t))
        rows = rows.withWatermark("_evt", delay)
        agg = rows.groupBy(F.window("_evt", f"{timefns._micros(self.width) // 1_000_000} seconds"),
                           *[F.col(k) for k in self.keys]).agg(*self.measures())
        start = timefns.instant_to_ntz(F.col("window.start"))
        if self.tz:
            start = timefns.from_local(start, self.tz)
        return agg.select(start.alias(self.bucket_name),
                          *[c for c in agg.columns if c != "window"])

    def merge(self, fresh: DataFrame) -> None:
        """Put rows of the aggregate into its table, replacing those with the
        same bucket and keys: repeating a merge changes nothing."""
        spark = fresh.sparkSession
        if fresh.isEmpty():
            return
        rows = checkpointed(fresh.withColumn("bucket_date", F.to_date(F.col(self.bucket_name))))
        if not exists(spark, self.path):
            self._write_new(rows)
            return
        self._replace(spark, rows, rows, [self.bucket_name, *self.keys],
                      _dates(rows, F.col("bucket_date")))

    def stream(self, raw_stream: DataFrame, checkpoint: str, output_mode: str = "append",
               trigger: dict | None = None, lateness=None):
        """Start the streaming runner.  It merges into the same table that
        ``create`` writes and ``refresh`` rewrites; a replayed micro-batch
        replaces its own rows.  Mode ``update`` also shows open windows."""
        writer = (self.stream_frame(raw_stream, lateness).writeStream.outputMode(output_mode)
                  .foreachBatch(lambda df, _: self.merge(df))
                  .option("checkpointLocation", checkpoint))
        return writer.trigger(**(trigger or {"processingTime": self.policy.trigger})).start()


# -- the reference's seven aggregates, declared -----------------------------

POLICIES = {
    "kwh_day_by_day": RefreshPolicy.of(None, "1 hour", "1 hour"),
    "kwh_hour_by_hour": RefreshPolicy.of(None, "1 hour", "1 hour"),
    "one_hour_candle": RefreshPolicy.of("3 hours", "1 hour", "1 hour"),
    "ten_min_candle": RefreshPolicy.of("30 minutes", "10 minutes", "10 minutes"),
    "sensor_temp_10min": RefreshPolicy.of("3 hours", "10 minutes", "5 minutes"),
    "sensor_temp_30min": RefreshPolicy.of("12 hours", "30 minutes", "15 minutes"),
    "sensor_temp_1h": RefreshPolicy.of("2 days", "1 hour", "30 minutes"),
}


def sensor_temp(name: str, width: str, path: str) -> ContinuousAggregate:
    return ContinuousAggregate(
        name=name, time_col="time", width=width, keys=["sensor_id"],
        measures=lambda: aggs.temperature_stats("temperature"), policy=POLICIES[name],
        path=path, where=lambda: F.col("temperature").isNotNull(), bucket_name="bucket_time")


def candle(name: str, width: str, path: str) -> ContinuousAggregate:
    return ContinuousAggregate(
        name=name, time_col="time", width=width, keys=["symbol"],
        measures=lambda: aggs.ohlc("price", "time", "day_volume", ["day_volume", "price"]), policy=POLICIES[name],
        path=path, bucket_name="bucket")


def kwh(name: str, width: str, path: str, type_id: int = 5,
        tz: str = "Europe/Berlin") -> ContinuousAggregate:
    return ContinuousAggregate(
        name=name, time_col="created", width=width, keys=[],
        measures=lambda: [aggs.counter_delta("value", "created", "value").alias("value")],
        policy=POLICIES[name], path=path, tz=tz,
        where=lambda: F.col("type_id") == type_id, bucket_name="time")


def define(name: str, path: str) -> ContinuousAggregate:
    widths = {"kwh_day_by_day": "1 day", "kwh_hour_by_hour": "01:00:00",
              "one_hour_candle": "1 hour", "ten_min_candle": "10 minutes",
              "sensor_temp_10min": "10 minutes", "sensor_temp_30min": "30 minutes",
              "sensor_temp_1h": "1 hour"}
    w = widths[name]
    if name.startswith("kwh"):
        return kwh(name, w, path)
    if name.endswith("candle"):
        return candle(name, w, path)
    return sensor_temp(name, w, path)
