"""Calendar profiles of bucketed values: median per weekday, median and
maximum per hour of day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.functions import aggs, timefns


def _median(value, method: str):
    if method == "exact":
        return aggs.median_exact(value)
    if method == "approx":
        return aggs.median_approx(value)
    if method == "sketch":
        return aggs.kll_median(aggs.kll_sketch(value))
    raise ValueError(method)


def within_year_of_month(time_col: str, tz: str):
    """The reference's predicate: local time > start of the row's month
    minus one year.  As written it holds for every row."""
    local = timefns.at_time_zone(time_col, tz)
    return local > timefns.month_start(time_col) - F.expr("INTERVAL 1 YEAR")


def weekday_calendar(spark: SparkSession) -> DataFrame:
    """unnest(array['Sun', .., 'Sat']) WITH ORDINALITY (1-based)."""
    arr = F.array(*[F.lit(d) for d in timefns.WEEKDAYS])
    return spark.range(1).select(F.posexplode(arr).alias("pos", "day")).select(
        F.col("day"), (F.col("pos") + 1).cast("bigint").alias("ordinal"))


def trailing_year(time_col: str, as_of):
    """The evident intent of the reference's predicate: the year before
    ``as_of``."""
    return timefns.trailing(time_col, as_of, "365 days")


def _window(time_col: str, tz: str, as_of):
    return within_year_of_month(time_col, tz) if as_of is None else trailing_year(time_col, as_of)


def weekday_median(per_day: DataFrame, tz: str = "Europe/Berlin", label_tz: str | None = None,
                   time_col: str = "time", value_col: str = "value",
                   method: str = "exact", as_of=None) -> DataFrame:
    """Median of daily values per weekday; all seven weekdays are returned,
    NULL where there is no data.  Labels use ``label_tz`` (default: the
    UTC session, as the reference computes them).  Rows are kept by the
    reference's predicate as written, or - given ``as_of`` - by the
    trailing year."""
    spark = per_day.sparkSession
    rows = per_day.filter(_window(time_col, tz, as_of))
    label_time = timefns.at_time_zone(time_col, label_tz) if label_tz else F.col(time_col)
    daily = rows.select(timefns.weekday_abbrev(label_time).alias("day"), F.col(value_col))
    pct = daily.groupBy("day").agg(_median(value_col, method).alias("value"))
    cal = weekday_calendar(spark)
    # Seven calendar rows against at most seven aggregate rows (one per
    # weekday label): a fixed size bound, so the aggregate is broadcast.
    return (cal.join(F.broadcast(pct), F.lower(pct["day"]) == F.lower(cal["day"]), "left")
            .select(cal["day"], cal["ordinal"], pct["value"]))


def hour_profile(per_hour: DataFrame, tz: str = "Europe/Berlin", label_tz: str | None = None,
                 time_col: str = "time", value_col: str = "value", method: str = "exact",
                 as_interval: bool = False, as_of=None) -> DataFrame:
    """Median and maximum of hourly values per hour of day."""
    rows = per_hour.filter(_window(time_col, tz, as_of))
    label_time = timefns.at_time_zone(time_col, label_tz) if label_tz else F.col(time_col)
    hour = (timefns.hour_interval(label_time) if as_interval
            else timefns.hour_of_day(label_time))
    hourly = rows.select(hour.alias("hour"), F.col(value_col))
    return hourly.groupBy("hour").agg(_median(value_col, method).alias("median"),
                                      F.max(value_col).alias("maximum"))
