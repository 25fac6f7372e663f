"""The reference's report queries, as DataFrame plans.

Each function takes the input tables as DataFrames plus explicit parameters
(``as_of`` stands for NOW(), so filters are literals and reach the scan).
Orderings are kept where the reference states them; Spark sorts with a
range-partitioned shuffle, and ORDER BY .. LIMIT becomes a per-partition
top-k followed by a merge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.functions import timefns
from tempora.operators import calendar, timeseries

BERLIN = "Europe/Berlin"


# -- energy (R1-R4) -------------------------------------------------------

def kwh_by_day(metrics: DataFrame, type_id: int = 5, tz: str = BERLIN) -> DataFrame:
    """Consumption per local day (counter delta)."""
    rows = metrics.filter(F.col("type_id") == type_id)
    return timeseries.counter_deltas(rows, "1 day", tz)


def kwh_by_hour(metrics: DataFrame, type_id: int = 5, tz: str = BERLIN) -> DataFrame:
    """R2: consumption per local hour."""
    rows = metrics.filter(F.col("type_id") == type_id)
    return timeseries.counter_deltas(rows, "01:00:00", tz)


def kwh_weekday_median(per_day: DataFrame, tz: str = BERLIN, label_tz: str | None = None,
                       method: str = "exact") -> DataFrame:
    """Median daily consumption per weekday, all seven weekdays."""
    return calendar.weekday_median(per_day, tz, label_tz, method=method)


def kwh_hour_profile(per_hour: DataFrame, tz: str = BERLIN, label_tz: str | None = None,
                     method: str = "exact", as_interval: bool = False) -> DataFrame:
    """Median and maximum hourly consumption per hour of day."""
    return calendar.hour_profile(per_hour, tz, label_tz, method=method,
                                 as_interval=as_interval).orderBy("hour")


# -- market ticks (R5-R8) ---------------------------------------------------

def candles(ticks: DataFrame, width, since=None) -> DataFrame:
    """OHLCV candles; ``since`` (a bucket bound, inclusive) restricts the
    raw rows read to those that can fall into such buckets."""
    if since is not None:
        first = timefns.earliest_time_for_bucket(timefns.as_of_dt(since), width, inclusive=True)
        ticks = ticks.filter(F.col("time") >= timefns.ntz_literal(first))
    return timeseries.candles(ticks, width)


def candles_for(candle_table: DataFrame, symbol: str) -> DataFrame:
    """SELECT * FROM candles WHERE symbol = s ORDER BY bucket."""
    return candle_table.filter(F.col("symbol") == symbol).orderBy(F.col("bucket").asc_nulls_last())


def recent_candles(candle_table: DataFrame, symbol: str, as_of, span) -> DataFrame:
    """One symbol's candles with bucket >= as_of - span."""
    return (candle_table
            .filter((F.col("symbol") == symbol)
                    & timefns.trailing("bucket", as_of, span, inclusive=True))
            .orderBy(F.col("bucket").asc_nulls_last()))


def price_series(ticks: DataFrame) -> DataFrame:
    """AVG(price) per instant and symbol."""
    return timeseries.series_avg(ticks, "time", ["symbol"], "price", "price").orderBy(
        F.col("time").asc_nulls_last())


def price_pivot(ticks: DataFrame, symbols: Sequence[str] | None = None) -> DataFrame:
    """R8 as the dashboard shows it: one price column per symbol - of the
    ``symbols`` asked for, else of all there are (Spark refuses more columns
    than ``spark.sql.pivotMaxValues``)."""
    if symbols is None:
        limit = int(ticks.sparkSession.conf.get("spark.sql.pivotMaxValues"))
        found = ticks.select("symbol").distinct().orderBy("symbol").limit(limit + 1).collect()
        if len(found) > limit:
            raise ValueError(f"more than {limit} symbols: name those to show")
        symbols = [r[0] for r in found if r[0] is not None]
    return timeseries.pivot_series(ticks, "time", "symbol", "price", symbols, "price")


# -- IoT statistics (R9, R15-R18) -------------------------------------------

def sensor_temp(readings: DataFrame, width, after=None) -> DataFrame:
    """reading_count/avg/min/max/stddev per bucket and sensor.

    ``after`` (a bucket bound, exclusive) restricts the raw rows read to
    those whose bucket can be later than it - the scan-level form of the
    reports' ``bucket_time > NOW() - interval``.
    """
    if after is not None:
        first = timefns.earliest_time_for_bucket(timefns.as_of_dt(after), width, inclusive=False)
        readings = readings.filter(F.col("time") >= timefns.ntz_literal(first))
    return timeseries.sensor_stats(readings, width)


def recent_aggregates(agg_10min: DataFrame, as_of, span="1 day") -> DataFrame:
    """ORDER BY bucket_time DESC, sensor_id."""
    return (agg_10min.filter(timefns.trailing("bucket_time", as_of, span))
            .orderBy(F.col("bucket_time").desc_nulls_first(), F.col("sensor_id").asc_nulls_last()))


def sensor_history(agg_1h: DataFrame, sensor_id: int, as_of, span="30 days") -> DataFrame:
    """One sensor's hourly aggregates (no stddev column)."""
    return (agg_1h.filter(timefns.trailing("bucket_time", as_of, span)
                          & (F.col("sensor_id") == sensor_id))
            .select("bucket_time", "sensor_id", "reading_count", "avg_temperature",
                    "min_temperature", "max_temperature")
            .orderBy(F.col("bucket_time").desc_nulls_first()))


# The reference's stability thresholds and labels.
HIGH_VARIABILITY = 2
MEDIUM_VARIABILITY = 1


def stability_class(agg_10min: DataFrame, as_of, span="1 day") -> DataFrame:
    """Label each bucket by its standard deviation."""
    sd = F.col("stddev_temperature")
    label = (F.when(sd > HIGH_VARIABILITY, F.lit("High variability"))
             .when(sd > MEDIUM_VARIABILITY, F.lit("Medium variability"))
             .otherwise(F.lit("Stable")))
    return (agg_10min.filter(timefns.trailing("bucket_time", as_of, span))
            .select("bucket_time", "sensor_id", "avg_temperature", "stddev_temperature",
                    label.alias("stability"))
            .orderBy(sd.desc_nulls_first()))


def hourly_rollup(readings: DataFrame, as_of, span="7 days") -> DataFrame:
    """Hourly avg/min/max straight from raw readings."""
    rows = readings.filter(timefns.trailing("time", as_of, span))
    return (rows.groupBy(timefns.time_bucket("time", "1 hour").alias("hour"), F.col("sensor_id"))
            .agg(F.avg("temperature").alias("avg_temperature"),
                 F.min("temperature").alias("min_temperature"),
                 F.max("temperature").alias("max_temperature"))
            .orderBy(F.col("hour").desc_nulls_first()))


# -- IoT joins, JSON, top-k (R10-R14, R19, R20) -------------------------------

def readings_last_hour(readings: DataFrame, sensors: DataFrame, as_of, span="1 hour") -> DataFrame:
    """Latest readings with the sensor's serial, newest first.

    The time filter shrinks the fact side before the join; Spark (AQE) then
    broadcasts whichever side its measured size proves small.
    """
    recent = readings.filter(timefns.trailing("time", as_of, span))
    j = recent.join(sensors, recent["sensor_id"] == sensors["id"], "inner")
    return (j.select(sensors["sensor_sn"], recent["temperature"], recent["time"])
            .orderBy(F.col("time").desc_nulls_first()))


def sensor_avg(readings: DataFrame, sensors: DataFrame, as_of, span="24 hours") -> DataFrame:
    """avg/min/max per sensor over a trailing window.

    ``id`` is the dimension's key, so grouping by (id, serial) after the join
    equals grouping readings by sensor_id before it: the aggregate runs
    first (map-side combine, skew-proof) and only one row per sensor meets
    the dimension.
    """
    recent = readings.filter(timefns.trailing("time", as_of, span))
    per_sensor = recent.groupBy("sensor_id").agg(
        F.avg("temperature").alias("avg_temp"), F.min("temperature").alias("min_temp"),
        F.max("temperature").alias("max_temp"))
    j = per_sensor.join(sensors, per_sensor["sensor_id"] == sensors["id"], "inner")
    return (j.select(sensors["sensor_sn"], "avg_temp", "min_temp", "max_temp")
            .orderBy(F.col("avg_temp").desc_nulls_first()))


def device_sensors(sensors: DataFrame, device_id: str) -> DataFrame:
    """R11 (and S11 when no device is given): sensors of a device."""
    rows = sensors if device_id is None else sensors.filter(F.col("device_id") == device_id)
    return rows.select("id", "sensor_sn", "type", "location").orderBy("sensor_sn")


STATUS_COLUMNS = ["device_id", "event_category", "message_counter", "git_version",
                  "num_temp_sensors", "num_flow_sensors", "is_camera_enabled", "status_data", "time"]


def status_latest(status: DataFrame, device_id: str, k: int = 10) -> DataFrame:
    """The k newest status rows of a device (top-k, not a full sort)."""
    return (status.filter(F.col("device_id") == device_id)
            .orderBy(F.col("time").desc_nulls_first()).limit(k)
            .select(*STATUS_COLUMNS))


def status_json_filter(status: DataFrame, device_id: str, field: str, threshold: str,
                       extract: Sequence[str], numeric: bool = False) -> DataFrame:
    """JSON fields of a device's status rows where a field exceeds a
    threshold.  ``->>`` yields text, so the reference compares as text
    ('9' > '50'); ``numeric=True`` compares numbers instead."""
    value = F.get_json_object("status_data", f"$.{field}")
    cond = (value.cast("double") > F.lit(float(threshold))) if numeric else (value > F.lit(threshold))
    cols = [F.get_json_object("status_data", f"$.{f}").alias(f) for f in extract]
    return (status.filter((F.col("device_id") == device_id) & cond)
            .select("device_id", "time", *cols)
            .orderBy(F.col("time").desc_nulls_first()))


def temp_series(readings: DataFrame, sensors: DataFrame) -> DataFrame:
    """AVG(temperature) per (time, device, serial).

    (device_id, sensor_sn) are functions of sensor_id, so the average is
    taken per (time, sensor_id) before the dimension join.
    """
    per = readings.groupBy("time", "sensor_id").agg(F.avg("temperature").alias("avg_temperature"))
    j = per.join(sensors, per["sensor_id"] == sensors["id"], "inner")
    return (j.select(per["time"], "avg_temperature", sensors["device_id"], sensors["sensor_sn"])
            .orderBy(F.col("time").asc_nulls_last()))


def fk_orphans(readings: DataFrame, sensors: DataFrame) -> DataFrame:
    """Readings whose sensor_id has no row in sensors."""
    return readings.join(sensors, readings["sensor_id"] == sensors["id"], "left_anti")


def table_counts(sensors: DataFrame, readings: DataFrame) -> DataFrame:
    """Row counts of the dimension and the readings."""
    n_readings = readings.agg(F.count(F.lit(1))).scalar()  # uncorrelated scalar subquery
    return sensors.agg(F.count(F.lit(1)).alias("sensors")).select(
        "sensors", n_readings.alias("readings"))


def hourly_sketches(readings: DataFrame) -> DataFrame:
    """percentile_agg per (hour, sensor): a mergeable KLL sketch column."""
    from tempora.functions import aggs

    return readings.filter(F.col("temperature").isNotNull()).groupBy(
        timefns.time_bucket("time", "1 hour").alias("bucket_time"), F.col("sensor_id")).agg(
        aggs.kll_sketch("temperature").alias("sketch"))


def daily_median_from_hourly_sketches(readings: DataFrame) -> DataFrame:
    """approx_percentile(0.5, rollup(sketch)) per (day, sensor)."""
    from tempora.functions import aggs

    hourly = hourly_sketches(readings)
    daily = hourly.groupBy(timefns.time_bucket("bucket_time", "1 day").alias("day"),
                           F.col("sensor_id")).agg(aggs.kll_merge("sketch").alias("sketch"))
    return daily.select("day", "sensor_id", aggs.kll_median("sketch").alias("median_temperature"),
                        F.kll_sketch_get_n_double("sketch").alias("readings"))


def median_rank_check(readings: DataFrame, error: float = 0.017) -> DataFrame:
    """Per day: number of readings, and whether the median read from the
    merged hourly sketches has a rank within ``error`` of the middle."""
    from tempora.functions import aggs

    day = timefns.time_bucket("bucket_time", "1 day").alias("day")
    medians = hourly_sketches(readings).groupBy(day).agg(aggs.kll_merge("sketch").alias("sketch")).select(
        "day", aggs.kll_median("sketch").alias("median"))
    rows = readings.filter(F.col("temperature").isNotNull()).select(
        timefns.time_bucket("time", "1 day").alias("day"), "temperature")
    ranks = rows.join(medians, "day").groupBy("day").agg(
        F.count(F.lit(1)).alias("readings"),
        F.sum((F.col("temperature") < F.col("median")).cast("long")).alias("below"),
        F.sum((F.col("temperature") <= F.col("median")).cast("long")).alias("upto"))
    slack = F.col("readings") * error + 1
    middle = F.col("readings") / 2
    return ranks.select("day", "readings", ((F.col("below") <= middle + slack)
                                            & (F.col("upto") >= middle - slack)).alias("within"))
