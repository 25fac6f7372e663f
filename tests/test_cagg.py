from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tempora.plans import cagg


def _readings(spark, rows):
    return spark.createDataFrame(rows, "time timestamp_ntz, sensor_id int, temperature double")


def _base(n_hours=12):
    t0 = datetime(2024, 1, 10)
    return [(t0 + timedelta(minutes=7 * i), i % 2, 20.0 + (i % 5)) for i in range(n_hours * 60 // 7)]


def _as_set(df):
    return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())


def test_incremental_equals_full_when_nothing_is_late(spark, workdir):
    raw = _readings(spark, _base())
    a = cagg.define("sensor_temp_10min", f"{workdir}/a")
    a.create(raw.filter(F.col("time") < datetime(2024, 1, 10, 9)))
    a.refresh(raw, datetime(2024, 1, 10, 12))          # window (9:00, 11:50]
    full = cagg.define("sensor_temp_10min", f"{workdir}/b")
    full.create(raw.filter(F.col("time") < datetime(2024, 1, 10, 11, 50)))
    assert _as_set(a.read(spark)) == _as_set(full.read(spark))


def test_late_row_outside_window_is_ignored_inside_counts(spark, workdir):
    raw = _readings(spark, _base())
    a = cagg.define("sensor_temp_10min", f"{workdir}/late")
    a.create(raw)
    before = {(r["bucket_time"], r["sensor_id"]): r["reading_count"] for r in a.read(spark).collect()}
    late = _readings(spark, [(datetime(2024, 1, 10, 1, 1), 0, 99.0),     # older than 3 h
                             (datetime(2024, 1, 10, 10, 1), 0, 99.0)])  # inside the window
    a.refresh(raw.unionByName(late), datetime(2024, 1, 10, 12))
    after = {(r["bucket_time"], r["sensor_id"]): r["reading_count"] for r in a.read(spark).collect()}
    old, new = (datetime(2024, 1, 10, 1, 0), 0), (datetime(2024, 1, 10, 10, 0), 0)
    assert after.get(old, 0) == before.get(old, 0)
    assert after.get(new, 0) == before.get(new, 0) + 1


def test_newest_bucket_is_held_back(spark, workdir):
    raw = _readings(spark, _base())
    a = cagg.define("sensor_temp_10min", f"{workdir}/hold")
    a.create(raw.filter(F.col("time") < datetime(2024, 1, 10, 11)))
    lo, hi = a.refresh(raw, datetime(2024, 1, 10, 11, 55))
    assert (lo, hi) == (datetime(2024, 1, 10, 9, 0), datetime(2024, 1, 10, 11, 40))
    buckets = {r["bucket_time"] for r in a.read(spark).collect()}
    assert datetime(2024, 1, 10, 11, 30) in buckets and datetime(2024, 1, 10, 11, 40) not in buckets


def test_vanished_buckets_disappear(spark, workdir):
    raw = _readings(spark, [(datetime(2024, 1, 11, 10, 1), 0, 1.0), (datetime(2024, 1, 10, 1), 0, 1.0)])
    a = cagg.define("sensor_temp_1h", f"{workdir}/gone")
    a.create(raw)
    a.refresh(raw.filter(F.col("time") < datetime(2024, 1, 11)), datetime(2024, 1, 11, 12))
    assert [r["bucket_time"] for r in a.read(spark).collect()] == [datetime(2024, 1, 10, 1)]


def test_policy_windows_of_all_seven_aggregates():
    t = datetime(2024, 1, 10, 12, 34, 56)
    got = {n: cagg.define(n, "/nowhere").window(t) for n in cagg.POLICIES}
    assert got["sensor_temp_10min"] == (datetime(2024, 1, 10, 9, 40), datetime(2024, 1, 10, 12, 20))
    assert got["sensor_temp_30min"] == (datetime(2024, 1, 10, 1, 0), datetime(2024, 1, 10, 12, 0))
    assert got["sensor_temp_1h"] == (datetime(2024, 1, 8, 13, 0), datetime(2024, 1, 10, 11, 0))
    assert got["one_hour_candle"] == (datetime(2024, 1, 10, 10, 0), datetime(2024, 1, 10, 11, 0))
    assert got["ten_min_candle"] == (datetime(2024, 1, 10, 12, 10), datetime(2024, 1, 10, 12, 20))
    # Berlin days: the last local midnight before t - 1 h is 23:00 UTC
    assert got["kwh_day_by_day"] == (None, datetime(2024, 1, 9, 23, 0))
    assert got["kwh_hour_by_hour"] == (None, datetime(2024, 1, 10, 11, 0))


def test_refresh_on_a_chunked_raw_table_prunes_chunks(spark, workdir):
    from tempora.operators import layout

    raw = _readings(spark, _base(48))
    layout.write_chunked(raw, f"{workdir}/raw", "time", "sensor_id", chunk_interval="1 day")
    table = spark.read.parquet(f"{workdir}/raw")
    a = cagg.define("sensor_temp_10min", f"{workdir}/chunked")
    a.raw_chunk_interval = "1 day"
    lo, hi = a.window(datetime(2024, 1, 11, 12))
    pruned = a.compute(table, lo, hi)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(chunk" in plan
    assert _as_set(pruned) == _as_set(a.compute(raw, lo, hi))


def test_invalidation_refresh_equals_window_refresh(spark, workdir):
    raw = _readings(spark, _base(48))
    late = _readings(spark, [(datetime(2024, 1, 10, 1, 1), 0, 99.0),
                             (datetime(2024, 1, 11, 20, 3), 1, -5.0)])
    for name in ["sensor_temp_1h", "kwh_day_by_day"]:
        a = cagg.define(name, f"{workdir}/{name}_a")
        b = cagg.define(name, f"{workdir}/{name}_b")
        src = raw
        if name.startswith("kwh"):   # counter rows of type 5, Berlin days
            src = raw.select(F.col("time").alias("created"), F.lit(5).alias("type_id"),
                             F.col("temperature").alias("value"))
            late_rows = late.select(F.col("time").alias("created"), F.lit(5).alias("type_id"),
                                    F.col("temperature").alias("value"))
        else:
            late_rows = late
        a.create(src)
        b.create(src)
        now = datetime(2024, 1, 12, 0, 30)
        a.refresh(src.unionByName(late_rows), now)
        b.refresh_changed(src.unionByName(late_rows), late_rows, now)
        assert _as_set(a.read(spark)) == _as_set(b.read(spark)), name


def test_equal_times_are_ordered_by_volume_and_price(spark):
    from tempora.plans import reports

    t = datetime(2024, 1, 1)
    rows = [(t, "A", float(p), v) for p in range(40) for v in (None, 3, 7)]
    df = spark.createDataFrame(rows, "time timestamp_ntz, symbol string, price double, day_volume long")
    got = {tuple(reports.candles(df.repartition(n), "1 hour").first()[2:]) for n in (1, 3, 8)}
    assert got == {(0.0, 39.0, 0.0, 39.0, 7)}


def test_streaming_needs_a_bound_for_unbounded_policies(spark):
    agg = cagg.define("kwh_day_by_day", "/nowhere")
    with pytest.raises(ValueError, match="unbounded"):
        agg.policy.watermark


def test_a_merge_repeated_changes_nothing(spark, workdir):
    agg = cagg.define("sensor_temp_10min", f"{workdir}/merged")
    rows = agg.compute(_readings(spark, _base(5))).drop("bucket_date")
    agg.merge(rows.limit(0))
    agg.merge(rows)
    want = _as_set(agg.read(spark))
    agg.merge(rows)
    assert _as_set(agg.read(spark)) == want and len(want) == agg.read(spark).count()
    agg.refresh(_readings(spark, _base(5)), datetime(2024, 1, 10, 4))  # the same table
    assert _as_set(agg.read(spark)) == want


def _kwh_rows(spark, rows):
    return spark.createDataFrame(rows, "created timestamp_ntz, type_id int, value double")


@pytest.mark.parametrize("name", ["kwh_hour_by_hour", "kwh_day_by_day"])
def test_buckets_that_close_after_their_batch_are_covered_later(spark, workdir, name):
    """Rows of 10:05 and 10:30 arrive before a run at 11:00, when their bucket is open; the next run
    at 13:30 is told of newer rows only, and must cover that bucket nevertheless."""
    a = cagg.define(name, f"{workdir}/{name}")
    a.create(_kwh_rows(spark, []))
    first = [(datetime(2024, 1, 10, 10, 5), 5, 10.0), (datetime(2024, 1, 10, 10, 30), 5, 16.0)]
    second = [(datetime(2024, 1, 10, 12, 5), 5, 20.0), (datetime(2024, 1, 10, 12, 20), 5, 21.5)]
    third = [(datetime(2024, 1, 12, 3, 5), 5, 30.0), (datetime(2024, 1, 10, 10, 45), 5, 17.0)]
    rows: list = []
    for n, (new, now) in enumerate([(first, datetime(2024, 1, 10, 11)), (second, datetime(2024, 1, 10, 13, 30)),
                                    (third, datetime(2024, 1, 14, 12))]):
        rows += new
        a.run_policy(_kwh_rows(spark, rows), _kwh_rows(spark, new), now, batch=n)
        full = cagg.define(name, f"{workdir}/{name}_{n}")
        full.create(_kwh_rows(spark, rows))
        hi = a.window(now)[1]
        assert _as_set(a.read(spark)) == _as_set(full.read(spark).filter(F.col("time") < F.lit(hi))), n
    assert a.invalidated(spark).count() == 0


def test_a_run_that_dies_is_repeated_by_the_next(spark, workdir, monkeypatch):
    a = cagg.define("kwh_hour_by_hour", f"{workdir}/dies")
    a.create(_kwh_rows(spark, []))
    rows = [(datetime(2024, 1, 10, 10, 5), 5, 10.0), (datetime(2024, 1, 10, 10, 30), 5, 16.0)]
    real = cagg.ContinuousAggregate._overwrite_dates
    monkeypatch.setattr(cagg.ContinuousAggregate, "_overwrite_dates",
                        lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        a.run_policy(_kwh_rows(spark, rows), _kwh_rows(spark, rows), datetime(2024, 1, 10, 14), batch=0)
    monkeypatch.setattr(cagg.ContinuousAggregate, "_overwrite_dates", real)
    a.run_policy(_kwh_rows(spark, rows), None, datetime(2024, 1, 10, 14))
    assert [r["value"] for r in a.read(spark).collect()] == [6.0]
    a.run_policy(_kwh_rows(spark, rows), None, datetime(2024, 1, 10, 15))  # nothing noted, nothing done
    assert a.read(spark).count() == 1


def test_merging_rows_with_null_keys_twice_changes_nothing(spark, workdir):
    a = cagg.define("sensor_temp_1h", f"{workdir}/nullkeys")
    rows = _readings(spark, [(datetime(2024, 1, 10, 1), None, 1.0), (datetime(2024, 1, 10, 1), 2, 1.0),
                             (None, None, 5.0), (None, 3, 6.0)])
    fresh = a.compute(rows).drop("bucket_date")
    a.merge(fresh)
    a.merge(fresh)
    a.merge(fresh.filter("sensor_id IS NULL"))
    assert _as_set(a.read(spark).select("sensor_id", "reading_count").orderBy("sensor_id").fillna(-1)) == [
        (-1, 1), (-1, 1), (2, 1), (3, 1)]


def test_a_merge_scans_the_dates_of_its_rows_only(spark, workdir):
    a = cagg.define("sensor_temp_1h", f"{workdir}/pruned")
    days = [(datetime(2024, 1, d, h), 1, 1.0) for d in range(1, 31) for h in (1, 5)]
    a.create(_readings(spark, days))
    table = spark.read.parquet(a.path).filter(cagg._on([datetime(2024, 1, 3).date(), datetime(2024, 1, 9).date()]))
    assert len({f.split("bucket_date=")[1][:10] for f in table.inputFiles()}) == 30  # listed, but
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket_date" in plan and "2024-01-03" in plan.replace("19725", "2024-01-03")
    seen = []
    real = cagg.ContinuousAggregate._overwrite_dates

    def spy(self, spark_, rows, dates):
        seen.append((dates, rows._jdf.queryExecution().executedPlan().toString()))
        real(self, spark_, rows, dates)

    cagg.ContinuousAggregate._overwrite_dates = spy
    try:
        a.merge(a.compute(_readings(spark, [(datetime(2024, 1, 3, 1), 1, 2.0), (datetime(2024, 1, 9, 7), 1, 2.0)]))
                .drop("bucket_date"))
        changed = _readings(spark, [(datetime(2024, 1, 20, 1), 1, 9.0)])
        raw = _readings(spark, days).unionByName(changed)
        raw.write.parquet(f"{workdir}/rawtable")
        a.refresh_changed(spark.read.parquet(f"{workdir}/rawtable"), changed, datetime(2024, 1, 21))
    finally:
        cagg.ContinuousAggregate._overwrite_dates = real
    assert [d.day for d in seen[0][0]] == [3, 9] and [d.day for d in seen[1][0]] == [20]
    for _, plan in seen:
        assert "PartitionFilters: [(bucket_date" in plan or "PartitionFilters: [((bucket_date" in plan \
            or "PartitionFilters: [bucket_date" in plan or "IN (" in plan, plan
    assert "GreaterThanOrEqual(time" in seen[1][1] or "time" in seen[1][1].split("PushedFilters")[-1]


def test_stretches_of_dates():
    d = [datetime(2024, 1, x).date() for x in (1, 2, 3, 7, 9, 10, 20)]
    assert [(a.day, b.day) for a, b in cagg._stretches(d)] == [(1, 3), (7, 7), (9, 10), (20, 20)]
    assert [(a.day, b.day) for a, b in cagg._stretches(d, most=2)] == [(1, 10), (20, 20)]
