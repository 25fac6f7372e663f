"""Aggregate building blocks.

All of them are partial-aggregatable (map-side combine before the shuffle),
so a hot key holding a third of the rows is reduced inside every map task and
reaches its reducer as one buffer per task - except the exact percentile,
whose buffer holds the distinct values of the group; use the KLL sketch for
groups that are large.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _order(time, tiebreak=None) -> Column:
    """Sort key: the time, or (time, tie-break columns) with NULL times left out."""
    if tiebreak is None:
        return _col(time)
    ties = tiebreak if isinstance(tiebreak, (list, tuple)) else [tiebreak]
    return F.when(_col(time).isNotNull(), F.struct(_col(time), *[_col(t) for t in ties]))


def first_at(value, time, tiebreak=None) -> Column:
    """first(value, time): the value at the earliest time (NULL time ignored,
    a NULL value at that time is returned)."""
    return F.min_by(_col(value), _order(time, tiebreak))


def last_at(value, time, tiebreak=None) -> Column:
    """last(value, time): the value at the latest time."""
    return F.max_by(_col(value), _order(time, tiebreak))


def round_half_even(x, scale: int = 0) -> Column:
    """PostgreSQL round(double precision): half to even."""
    return F.bround(_col(x), scale) if scale else F.rint(_col(x))


def counter_delta(value, time, tiebreak=None) -> Column:
    """round((last(value, time) - first(value, time)) * 100.) / 100."""
    delta = last_at(value, time, tiebreak) - first_at(value, time, tiebreak)
    return F.rint(delta * F.lit(100.0)) / F.lit(100.0)


def ohlc(price="price", time="time", volume="day_volume", tiebreak=None) -> list[Column]:
    """Candle: open, high, low, close and the last day volume."""
    cols = [
        first_at(price, time, tiebreak).alias("open"),
        F.max(_col(price)).alias("high"),
        F.min(_col(price)).alias("low"),
        last_at(price, time, tiebreak).alias("close"),
    ]
    if volume is not None:
        cols.append(last_at(volume, time, tiebreak).alias("day_volume"))
    return cols


def temperature_stats(value="temperature", prefix: str = "temperature") -> list[Column]:
    """COUNT(*), AVG, MIN, MAX, STDDEV (sample; NULL for one row)."""
    v = _col(value)
    return [
        F.count(F.lit(1)).alias("reading_count"),
        F.avg(v).alias(f"avg_{prefix}"),
        F.min(v).alias(f"min_{prefix}"),
        F.max(v).alias(f"max_{prefix}"),
        F.stddev_samp(v).alias(f"stddev_{prefix}"),
    ]


def median_exact(value) -> Column:
    """Continuous (interpolated) median."""
    return F.percentile(_col(value), F.lit(0.5))


def median_approx(value, accuracy: int = 10000) -> Column:
    return F.percentile_approx(_col(value), F.lit(0.5), F.lit(accuracy))


def kll_sketch(value) -> Column:
    """Mergeable quantile sketch (binary); merge with kll_merge_agg_double."""
    return F.kll_sketch_agg_double(_col(value).cast("double"))


def kll_merge(sketch) -> Column:
    return F.kll_merge_agg_double(_col(sketch))


def kll_median(sketch) -> Column:
    return F.kll_sketch_get_quantile_double(_col(sketch), F.lit(0.5))
