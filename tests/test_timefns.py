from datetime import datetime

from pyspark.sql import functions as F

from tempora.functions import aggs, timefns


def _ts(spark, rows, schema="ts string, v double"):
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def test_time_bucket_utc_widths(spark):
    df = _ts(spark, [("2024-01-01 00:17:30", 1.0), ("2024-01-01 23:59:59.999999", 2.0)])
    out = df.select(timefns.time_bucket("ts", "10 minutes").alias("a"),
                    timefns.time_bucket("ts", "30 minutes").alias("b"),
                    timefns.time_bucket("ts", "1 hour").alias("c"),
                    timefns.time_bucket("ts", "7 days").alias("w")).collect()
    assert out[0]["a"] == datetime(2024, 1, 1, 0, 10)
    assert out[0]["b"] == datetime(2024, 1, 1, 0, 0)
    assert out[1]["c"] == datetime(2024, 1, 1, 23, 0)
    # week buckets start on Mondays (origin 2000-01-03); 2024-01-01 is one
    assert out[0]["w"] == datetime(2024, 1, 1)


def test_berlin_day_and_hour_buckets_across_dst(spark):
    rows = [("2023-03-25 23:30:00", 1.0),   # 00:30 CET on 26 Mar (spring forward day)
            ("2023-03-26 01:30:00", 2.0),   # 03:30 CEST
            ("2023-10-28 22:30:00", 3.0),   # 00:30 CEST on 29 Oct (fall back day)
            ("2023-10-29 00:30:00", 4.0),   # 02:30 CEST (first 02:xx)
            ("2023-10-29 01:30:00", 5.0)]   # 02:30 CET (second 02:xx)
    df = _ts(spark, rows)
    out = df.select("v", timefns.local_bucket("ts", "1 day", "Europe/Berlin").alias("d"),
                    timefns.local_bucket("ts", "01:00:00", "Europe/Berlin").alias("h")
                    ).orderBy("v").collect()
    # local midnight of 26 Mar is 23:00 UTC the day before (CET, +1)
    assert out[0]["d"] == datetime(2023, 3, 25, 23, 0)
    assert out[1]["d"] == datetime(2023, 3, 25, 23, 0)
    # local midnight of 29 Oct is 22:00 UTC (still CEST, +2)
    assert out[2]["d"] == datetime(2023, 10, 28, 22, 0)
    assert out[4]["d"] == datetime(2023, 10, 28, 22, 0)
    # the repeated local hour 02:00 maps both instants to the earlier one
    assert out[3]["h"] == datetime(2023, 10, 29, 0, 0)
    assert out[4]["h"] == datetime(2023, 10, 29, 0, 0)


def test_weekday_and_hour_labels(spark):
    df = _ts(spark, [("2024-01-07 10:00:00", 1.0)])  # a Sunday
    r = df.select(timefns.weekday_abbrev("ts").alias("d"), timefns.hour_of_day("ts").alias("h"),
                  timefns.hour_interval("ts").alias("i")).first()
    assert r["d"] == "Sun" and r["h"] == 10 and r["i"].total_seconds() == 36000


def test_first_last_counter_delta_and_ties(spark):
    df = spark.createDataFrame(
        [("2024-01-01 00:00:00", None, 1), ("2024-01-01 00:05:00", 10.0, 2),
         ("2024-01-01 00:09:00", 10.125, 3), ("2024-01-01 00:09:00", 10.135, 4)],
        "ts string, v double, id int").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    r = df.agg(aggs.first_at("v", "ts").alias("f"),
               aggs.last_at("v", "ts", "id").alias("l"),
               aggs.counter_delta("v", "ts", "id").alias("d")).first()
    assert r["f"] is None            # NULL value at the earliest instant is returned
    assert r["l"] == 10.135           # tie on time broken by id
    assert r["d"] is None             # last - NULL


def test_counter_delta_rounds_half_even(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", 0.0), ("2024-01-01 01:00:00", 0.125)],
                               "ts string, v double").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz"))
    r = df.agg(aggs.counter_delta("v", "ts").alias("d")).first()
    assert r["d"] == 0.12             # 12.5 → 12 (half to even)


def test_stddev_single_row_is_null_and_stability_label(spark):
    from tempora.plans import reports

    df = spark.createDataFrame([("2024-01-01 00:00:00", 1, 20.0)],
                               "time string, sensor_id int, temperature double").withColumn(
        "time", F.col("time").cast("timestamp_ntz"))
    stats = reports.sensor_temp(df, "10 minutes")
    r = stats.first()
    assert r["reading_count"] == 1 and r["stddev_temperature"] is None
    lab = reports.stability_class(stats, datetime(2024, 1, 1, 0, 5)).first()
    assert lab["stability"] == "Stable"


def test_parse_width():
    assert timefns.parse_width("01:00:00").total_seconds() == 3600
    assert timefns.parse_width("10 minutes").total_seconds() == 600
    assert timefns.parse_width("2 days").total_seconds() == 172800
    assert timefns.bucket_floor(datetime(2024, 1, 1, 0, 17), "10 minutes") == datetime(2024, 1, 1, 0, 10)
    assert timefns.bucket_ceil(datetime(2024, 1, 1, 0, 10), "10 minutes") == datetime(2024, 1, 1, 0, 10)


def test_merged_hourly_sketches_close_to_exact_median(spark):
    from tempora.plans import reports
    from tempora.sources import tables

    readings = tables.stat_readings(spark, "/root/testdata/sf0.01")
    approx = reports.daily_median_from_hourly_sketches(readings)
    exact = readings.groupBy(timefns.time_bucket("time", "1 day").alias("day"), "sensor_id").agg(
        F.percentile("temperature", 0.5).alias("exact"), F.count("*").alias("n"))
    j = approx.join(exact, ["day", "sensor_id"]).collect()
    assert len(j) == exact.count()
    assert all(r["readings"] == r["n"] for r in j)
    # the sketch answers with a stored value (a discrete median) close to the interpolated one
    assert all(abs(r["median_temperature"] - r["exact"]) < 3 for r in j)


def test_label_zone_option(spark):
    from tempora.operators import calendar

    # a Berlin-day bucket starting 2024-01-06 23:00 UTC is Sunday 7 Jan locally
    df = spark.createDataFrame([("2024-01-06 23:00:00", 5.0)], "time string, value double").withColumn(
        "time", F.col("time").cast("timestamp_ntz"))
    utc = {r["day"]: r["value"] for r in calendar.weekday_median(df).collect()}
    local = {r["day"]: r["value"] for r in calendar.weekday_median(df, label_tz="Europe/Berlin").collect()}
    assert utc["Sat"] == 5.0 and utc["Sun"] is None          # as the reference labels it
    assert local["Sun"] == 5.0 and local["Sat"] is None
