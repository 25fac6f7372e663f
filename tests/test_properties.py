"""Property checks against plain-Python models (hypothesis)."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tempora.functions import timefns
from tempora.plans import cagg

ORIGIN = datetime(2000, 1, 3)
WIDTHS = ["1 minute", "10 minutes", "30 minutes", "1 hour", "1 day", "7 days"]


def py_bucket(t: datetime, width: str) -> datetime:
    w = timefns.parse_width(width)
    return t - ((t - ORIGIN) % w)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.datetimes(min_value=datetime(1990, 1, 1), max_value=datetime(2040, 1, 1)),
                min_size=1, max_size=40))
def test_time_bucket_matches_python_model(spark, times):
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    cols = [timefns.time_bucket("ts", w).alias(f"b{i}") for i, w in enumerate(WIDTHS)]
    for t, row in zip(times, df.select("ts", *cols).collect()):
        assert row["ts"] == t
        for i, w in enumerate(WIDTHS):
            assert row[f"b{i}"] == py_bucket(t, w), (t, w)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 24 * 60 - 1), st.integers(0, 2),
                          st.floats(-50, 50, allow_nan=False), st.booleans()),
                min_size=5, max_size=60),
       st.integers(6 * 60, 24 * 60))
def test_refresh_equals_model(spark, tmp_path_factory, rows, now_minute):
    """create() on the on-time rows, then refresh() with every row at
    ``now``: buckets inside the policy window equal a full recompute, all
    other buckets keep the first materialisation."""
    t0 = datetime(2024, 3, 1)
    data = [(t0 + timedelta(minutes=m), s, v, late) for m, s, v, late in rows]
    df = spark.createDataFrame(data, "time timestamp_ntz, sensor_id int, temperature double, "
                                     "late boolean")
    now = t0 + timedelta(minutes=now_minute)
    path = str(tmp_path_factory.mktemp("cagg"))
    a = cagg.define("sensor_temp_10min", path)
    visible = df.filter(~F.col("late") & (F.col("time") <= F.lit(now - timedelta(hours=1))))
    a.create(visible.drop("late"))
    lo, hi = a.refresh(df.drop("late"), now)

    def model(rows_):
        out = {}
        for t, s, v, _ in rows_:
            out.setdefault((py_bucket(t, "10 minutes"), s), []).append(v)
        return {k: len(vs) for k, vs in out.items()}

    first = model([r for r in data if not r[3] and r[0] <= now - timedelta(hours=1)])
    full = model(data)
    expect = {k: n for k, n in full.items() if lo <= k[0] < hi}
    expect.update({k: n for k, n in first.items() if not (lo <= k[0] < hi)})
    got = {(r["bucket_time"], r["sensor_id"]): r["reading_count"] for r in a.read(spark).collect()}
    assert got == expect
