"""Bucketed aggregations over time-stamped rows.

Each operator is one ``groupBy(bucket, key).agg(...)``: Spark plans it as a
partial aggregate in every map task, one shuffle on (bucket, key), and a
final aggregate - so the shuffle carries one buffer per group per task,
whatever the skew of the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempora.functions import aggs, timefns


def bucket_agg(df: DataFrame, time_col: str, width, keys: Sequence[str], measures: Sequence[Column],
               tz: str | None = None, bucket_name: str = "bucket") -> DataFrame:
    b = timefns.bucket(time_col, width, tz).alias(bucket_name)
    return df.groupBy(b, *[F.col(k) for k in keys]).agg(*measures)


def candles(ticks: DataFrame, width, time_col: str = "time", symbol_col: str = "symbol",
            price_col: str = "price", volume_col: str | None = "day_volume") -> DataFrame:
    """OHLC(V) candles per (bucket, symbol)."""
    return bucket_agg(ticks, time_col, width, [symbol_col],
                      aggs.ohlc(price_col, time_col, volume_col,
                                [c for c in (volume_col, price_col) if c]), bucket_name="bucket")


def sensor_stats(readings: DataFrame, width, time_col: str = "time",
                 key_col: str = "sensor_id", value_col: str = "temperature") -> DataFrame:
    """reading_count, avg/min/max/stddev per (bucket_time, sensor) over
    non-NULL readings."""
    rows = readings.filter(F.col(value_col).isNotNull())
    return bucket_agg(rows, time_col, width, [key_col], aggs.temperature_stats(value_col),
                      bucket_name="bucket_time")


def counter_deltas(metrics: DataFrame, width, tz: str | None = None, time_col: str = "created",
                   value_col: str = "value", out_time: str = "time") -> DataFrame:
    """Per-bucket consumption of a cumulative counter: last - first, to the
    cent (half-even)."""
    return bucket_agg(metrics, time_col, width, [],
                      [aggs.counter_delta(value_col, time_col, value_col).alias("value")],
                      tz=tz, bucket_name=out_time)


def series_avg(df: DataFrame, time_col: str, keys: Sequence[str], value_col: str,
               out: str) -> DataFrame:
    """AVG(value) GROUP BY time, keys - collapses rows sharing an instant."""
    return df.groupBy(F.col(time_col), *[F.col(k) for k in keys]).agg(
        F.avg(value_col).alias(out))


def pivot_series(df: DataFrame, time_col: str, key_col: str, value_col: str,
                 values: Sequence[str], label: str) -> DataFrame:
    """Long → wide: one column per series value, named "<label> <value>".

    The series values are passed in (no extra job to discover them), and
    Spark pre-aggregates per (time, key) before pivoting.
    """
    wide = df.groupBy(time_col).pivot(key_col, list(values)).agg(F.avg(value_col))
    return wide.select(F.col(time_col),
                       *[F.col(f"`{v}`").alias(f"{label} {v}") for v in values])
