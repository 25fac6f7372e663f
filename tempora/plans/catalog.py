"""Registered queries: one per operator/report, each with its SQL oracle.

Every query reads the given tables (or data Spark derives from them) in
full.  ``as_of`` - the reference's NOW() - is the latest event time, read
with one scalar aggregate so that the time predicates are literals.  Where
floating-point sums are involved (avg, stddev) both sides round to six
decimals: the two engines add in different orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.functions import timefns
from tempora.plans import reports
from tempora.session import ensure_utc
from tempora.sources import tables

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return run
    return deco


def r6(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) for c in cols})


def as_of(spark: SparkSession, sf_dir: str):
    """Latest event time of the given tables: one scalar aggregate, part of each query that needs it."""
    return tables.latest_time(tables.events(spark, sf_dir), "ts")


# Parameters of the registered reports (stand-ins for the reference's
# 'BTC/USD', 'AAPL', 'device-001', sensor 1, cpu_usage > '50').
SYMBOL_10MIN = "view"
SYMBOL_1H = "purchase"
DEVICE = "7"
SENSOR = 1
SYMBOLS = ["click", "error", "purchase", "signup", "view"]

# ---------------------------------------------------------------- SQL parts
AS_OF = "(SELECT max(ts) FROM events)"
TICKS = ("SELECT ts AS time, event_type AS symbol, value AS price, "
         "CAST(event_id AS DECIMAL(38,10)) AS day_volume FROM events")
STAT = ("SELECT ts AS time, CAST(user_id % 5 AS INTEGER) AS sensor_id, "
        "value / 25.0 AS temperature FROM events")


def _candle_sql(width: str, ticks: str = TICKS) -> str:
    return f"""
SELECT time_bucket(INTERVAL '{width}', time) AS bucket, symbol,
       first(price ORDER BY time, day_volume NULLS FIRST, price) AS open, max(price) AS high,
       min(price) AS low, last(price ORDER BY time, day_volume NULLS FIRST, price) AS close,
       last(day_volume ORDER BY time, day_volume NULLS FIRST, price) AS day_volume
FROM ({ticks}) t GROUP BY 1, 2"""


def _stats_sql(width: str) -> str:
    return f"""
SELECT time_bucket(INTERVAL '{width}', time) AS bucket_time, sensor_id,
       count(*) AS reading_count, round(avg(temperature), 6) AS avg_temperature,
       min(temperature) AS min_temperature, max(temperature) AS max_temperature,
       round(stddev_samp(temperature), 6) AS stddev_temperature
FROM ({STAT}) r WHERE temperature IS NOT NULL GROUP BY 1, 2"""


def _berlin_bucket_sql(unit: str) -> str:
    local = "((time AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Berlin')"
    return (f"CAST((date_trunc('{unit}', {local}) AT TIME ZONE 'Europe/Berlin') "
            f"AT TIME ZONE 'UTC' AS TIMESTAMP)")


def _kwh_sql(unit: str) -> str:
    return f"""
SELECT {_berlin_bucket_sql(unit)} AS time,
       round_even((last(value ORDER BY time, value) - first(value ORDER BY time, value)) * 100.0, 0)
         / 100.0 AS value
FROM (SELECT ts AS time, value FROM events WHERE event_type = 'view') m GROUP BY 1"""


_F7 = ("((time AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Berlin') > "
       "date_trunc('month', time) - INTERVAL 1 YEAR")


# ------------------------------------------------------------ step 1: candles

@register("candle_10min", _candle_sql("10 minutes"))
def candle_10min(spark, sf_dir):
    """ten_min_candle: OHLCV per 10-minute bucket and symbol."""
    return reports.candles(tables.stocks(spark, sf_dir), "10 minutes")


@register("candle_1h", _candle_sql("1 hour"))
def candle_1h(spark, sf_dir):
    """one_hour_candle: OHLCV per hour and symbol."""
    return reports.candles(tables.stocks(spark, sf_dir), "1 hour")


@register("candle_10min_symbol", f"SELECT * FROM ({_candle_sql('10 minutes')}) c "
                                 f"WHERE symbol = '{SYMBOL_10MIN}' ORDER BY bucket")
def candle_10min_symbol(spark, sf_dir):
    """One symbol's 10-minute candles in time order."""
    return reports.candles_for(candle_10min(spark, sf_dir), SYMBOL_10MIN)


@register("candle_1h_symbol", f"SELECT * FROM ({_candle_sql('1 hour')}) c "
                              f"WHERE symbol = '{SYMBOL_1H}' ORDER BY bucket")
def candle_1h_symbol(spark, sf_dir):
    """One symbol's hourly candles in time order."""
    return reports.candles_for(candle_1h(spark, sf_dir), SYMBOL_1H)


@register("candle_recent", f"SELECT * FROM ({_candle_sql('10 minutes')}) c "
                           f"WHERE symbol = '{SYMBOL_10MIN}' "
                           f"AND bucket >= {AS_OF} - INTERVAL 2 HOUR ORDER BY bucket")
def candle_recent(spark, sf_dir):
    """The last two hours of one symbol's 10-minute candles."""
    t = as_of(spark, sf_dir)
    raw = reports.candles(tables.stocks(spark, sf_dir), "10 minutes", since=_since(t, "2 hours"))
    return reports.recent_candles(raw, SYMBOL_10MIN, t, "2 hours")


@register("candle_recent_1h", f"SELECT * FROM ({_candle_sql('1 hour')}) c "
                              f"WHERE symbol = '{SYMBOL_1H}' "
                              f"AND bucket >= {AS_OF} - INTERVAL 5 HOUR ORDER BY bucket")
def candle_recent_1h(spark, sf_dir):
    """The last five hours of one symbol's hourly candles."""
    t = as_of(spark, sf_dir)
    raw = reports.candles(tables.stocks(spark, sf_dir), "1 hour", since=_since(t, "5 hours"))
    return reports.recent_candles(raw, SYMBOL_1H, t, "5 hours")


# ------------------------------------------------- step 2: sensor statistics

def _stats(spark, sf_dir, width, after=None):
    return reports.sensor_temp(tables.stat_readings(spark, sf_dir), width, after)


def _since(t, span):
    return t - timefns.parse_width(span)


@register("sensor_temp_10min", _stats_sql("10 minutes"))
def sensor_temp_10min(spark, sf_dir):
    return r6(_stats(spark, sf_dir, "10 minutes"), "avg_temperature", "stddev_temperature")


@register("sensor_temp_30min", _stats_sql("30 minutes"))
def sensor_temp_30min(spark, sf_dir):
    return r6(_stats(spark, sf_dir, "30 minutes"), "avg_temperature", "stddev_temperature")


@register("sensor_temp_1h", _stats_sql("1 hour"))
def sensor_temp_1h(spark, sf_dir):
    return r6(_stats(spark, sf_dir, "1 hour"), "avg_temperature", "stddev_temperature")


@register("agg_recent_10min", f"SELECT * FROM ({_stats_sql('10 minutes')}) s "
                              f"WHERE bucket_time > {AS_OF} - INTERVAL 1 DAY "
                              "ORDER BY bucket_time DESC, sensor_id")
def agg_recent_10min(spark, sf_dir):
    """The last day of 10-minute aggregates."""
    t = as_of(spark, sf_dir)
    df = reports.recent_aggregates(_stats(spark, sf_dir, "10 minutes", _since(t, "1 day")), t)
    return r6(df, "avg_temperature", "stddev_temperature")


@register("agg_1h_one_sensor", f"""
SELECT bucket_time, sensor_id, reading_count, avg_temperature, min_temperature, max_temperature
FROM ({_stats_sql('1 hour')}) s
WHERE bucket_time > {AS_OF} - INTERVAL 30 DAY AND sensor_id = {SENSOR}
ORDER BY bucket_time DESC""")
def agg_1h_one_sensor(spark, sf_dir):
    """30 days of one sensor's hourly aggregates."""
    t = as_of(spark, sf_dir)
    df = reports.sensor_history(_stats(spark, sf_dir, "1 hour", _since(t, "30 days")), SENSOR, t)
    return r6(df, "avg_temperature")


@register("stability_class", f"""
SELECT bucket_time, sensor_id, avg_temperature, stddev_temperature,
       CASE WHEN stddev_temperature > 2 THEN 'High variability'
            WHEN stddev_temperature > 1 THEN 'Medium variability'
            ELSE 'Stable' END AS stability
FROM ({_stats_sql('10 minutes')}) s
WHERE bucket_time > {AS_OF} - INTERVAL 1 DAY ORDER BY stddev_temperature DESC""")
def stability_class(spark, sf_dir):
    """Variability label per 10-minute bucket of the last day."""
    t = as_of(spark, sf_dir)
    df = reports.stability_class(_stats(spark, sf_dir, "10 minutes", _since(t, "1 day")), t)
    return r6(df, "avg_temperature", "stddev_temperature")


@register("hourly_rollup_7d", f"""
SELECT time_bucket(INTERVAL '1 hour', time) AS hour, sensor_id,
       round(avg(temperature), 6) AS avg_temperature, min(temperature) AS min_temperature,
       max(temperature) AS max_temperature
FROM ({STAT}) r WHERE time > {AS_OF} - INTERVAL 7 DAY GROUP BY 1, 2 ORDER BY hour DESC""")
def hourly_rollup_7d(spark, sf_dir):
    """Hourly rollup of the last seven days from raw readings."""
    df = reports.hourly_rollup(tables.stat_readings(spark, sf_dir), as_of(spark, sf_dir))
    return r6(df, "avg_temperature")


# ------------------------------------------------------------ step 3: energy

def _kwh_day(spark, sf_dir):
    return reports.kwh_by_day(tables.metrics_of_type(spark, sf_dir, 5), type_id=5)


def _kwh_hour(spark, sf_dir):
    return reports.kwh_by_hour(tables.metrics_of_type(spark, sf_dir, 5), type_id=5)


@register("kwh_day", _kwh_sql("day"))
def kwh_day(spark, sf_dir):
    """kWh per Berlin day."""
    return _kwh_day(spark, sf_dir)


@register("kwh_hour", _kwh_sql("hour"))
def kwh_hour(spark, sf_dir):
    """R2: kWh per Berlin hour."""
    return _kwh_hour(spark, sf_dir)


@register("kwh_weekday_median", f"""
WITH per_day AS ({_kwh_sql('day')}),
daily AS (SELECT strftime(time, '%a') AS day, value FROM per_day WHERE {_F7}),
pct AS (SELECT day, round(quantile_cont(value, 0.5), 6) AS value FROM daily GROUP BY 1)
SELECT d.day, d.ordinal, pd.value
FROM unnest(['Sun', 'Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat']) WITH ORDINALITY AS d(day, ordinal)
LEFT JOIN pct pd ON lower(pd.day) = lower(d.day)""")
def kwh_weekday_median(spark, sf_dir):
    """Median daily kWh per weekday, all seven shown."""
    return r6(reports.kwh_weekday_median(_kwh_day(spark, sf_dir)), "value")


@register("kwh_hour_profile", f"""
WITH per_hour AS ({_kwh_sql('hour')}),
hourly AS (SELECT CAST(hour(time) AS INTEGER) AS hour, value FROM per_hour WHERE {_F7})
SELECT hour, round(quantile_cont(value, 0.5), 6) AS median, max(value) AS maximum
FROM hourly GROUP BY 1 ORDER BY 1""")
def kwh_hour_profile(spark, sf_dir):
    """Median and max kWh per hour of day."""
    return r6(reports.kwh_hour_profile(_kwh_hour(spark, sf_dir)), "median")


# ---------------------------------------- step 4: joins, JSON, top-k, pivot

_READINGS = ("SELECT ts AS time, CAST(user_id AS INTEGER) AS sensor_id, value AS temperature "
             "FROM events")
_SENSORS = ("SELECT CAST(c_custkey AS INTEGER) AS id, c_name AS sensor_sn, "
            "CAST(c_nationkey AS VARCHAR) AS device_id, 'temperature' AS type, "
            "c_mktsegment AS location FROM customer")
_STATUS = ("SELECT ts AS time, CAST(user_id AS VARCHAR) AS device_id, event_type AS event_category, "
           "CAST(event_id AS INTEGER) AS message_counter, CAST(NULL AS VARCHAR) AS git_version, "
           "CAST(NULL AS VARCHAR) AS git_current_version, CAST(NULL AS VARCHAR) AS git_stable_version, "
           "CAST(NULL AS INTEGER) AS num_temp_sensors, CAST(NULL AS INTEGER) AS num_flow_sensors, "
           "CAST(NULL AS BOOLEAN) AS is_camera_enabled, props AS status_data FROM events")


@register("readings_last_hour", f"""
SELECT s.sensor_sn, r.temperature, r.time
FROM ({_READINGS}) r JOIN ({_SENSORS}) s ON r.sensor_id = s.id
WHERE r.time > {AS_OF} - INTERVAL 1 HOUR ORDER BY r.time DESC""")
def readings_last_hour(spark, sf_dir):
    """Readings of the last hour with the sensor serial."""
    return reports.readings_last_hour(tables.sensor_data(spark, sf_dir),
                                      tables.sensors(spark, sf_dir), as_of(spark, sf_dir))


@register("sensor_avg_24h", f"""
SELECT s.sensor_sn, round(avg(r.temperature), 6) AS avg_temp, min(r.temperature) AS min_temp,
       max(r.temperature) AS max_temp
FROM ({_READINGS}) r JOIN ({_SENSORS}) s ON r.sensor_id = s.id
WHERE r.time > {AS_OF} - INTERVAL 24 HOUR GROUP BY s.id, s.sensor_sn ORDER BY avg_temp DESC""")
def sensor_avg_24h(spark, sf_dir):
    """avg/min/max temperature per sensor over 24 hours."""
    df = reports.sensor_avg(tables.sensor_data(spark, sf_dir), tables.sensors(spark, sf_dir),
                            as_of(spark, sf_dir))
    return r6(df, "avg_temp")


@register("device_sensors", f"""
SELECT id, sensor_sn, type, location FROM ({_SENSORS}) s
WHERE device_id = '{DEVICE}' ORDER BY sensor_sn""")
def device_sensors(spark, sf_dir):
    """Sensors of one device."""
    return reports.device_sensors(tables.sensors(spark, sf_dir), DEVICE)


@register("sensor_list", f"SELECT id, sensor_sn, type, location FROM ({_SENSORS}) s ORDER BY id")
def sensor_list(spark, sf_dir):
    """All sensors ordered by id."""
    return tables.sensors(spark, sf_dir).select("id", "sensor_sn", "type", "location").orderBy("id")


@register("temp_series", f"""
SELECT r.time, round(avg(r.temperature), 6) AS avg_temperature, s.device_id, s.sensor_sn
FROM ({_READINGS}) r JOIN ({_SENSORS}) s ON r.sensor_id = s.id
GROUP BY r.time, s.device_id, s.sensor_sn ORDER BY r.time""")
def temp_series(spark, sf_dir):
    """Temperature series per device and serial."""
    df = reports.temp_series(tables.sensor_data(spark, sf_dir), tables.sensors(spark, sf_dir))
    return r6(df, "avg_temperature")


@register("status_latest_10", f"""
SELECT device_id, event_category, message_counter, git_version, num_temp_sensors,
       num_flow_sensors, is_camera_enabled, status_data, time
FROM ({_STATUS}) d WHERE device_id = '{DEVICE}' ORDER BY time DESC LIMIT 10""")
def status_latest_10(spark, sf_dir):
    """The ten latest status rows of a device."""
    return reports.status_latest(tables.device_status(spark, sf_dir), DEVICE, 10)


@register("status_json_filter", f"""
SELECT device_id, time, status_data->>'k' AS k FROM ({_STATUS}) d
WHERE device_id = '{DEVICE}' AND status_data->>'k' > '50' ORDER BY time DESC""")
def status_json_filter(spark, sf_dir):
    """Status rows of a device whose JSON field exceeds '50' as text."""
    return reports.status_json_filter(tables.device_status(spark, sf_dir), DEVICE, "k", "50", ["k"])


@register("status_json_numeric", f"""
SELECT device_id, time, status_data->>'k' AS k FROM ({_STATUS}) d
WHERE device_id = '{DEVICE}' AND CAST(status_data->>'k' AS DOUBLE) > 50 ORDER BY time DESC""")
def status_json_numeric(spark, sf_dir):
    """R13, numeric variant of the comparison."""
    return reports.status_json_filter(tables.device_status(spark, sf_dir), DEVICE, "k", "50", ["k"],
                                      numeric=True)


@register("price_series", f"""
SELECT time, symbol, round(avg(price), 6) AS price FROM ({TICKS}) t GROUP BY time, symbol
ORDER BY time""")
def price_series(spark, sf_dir):
    """Average price per instant and symbol."""
    return r6(reports.price_series(tables.stocks(spark, sf_dir)), "price")


@register("price_pivot", "SELECT time, " + ", ".join(
    f"round(avg(price) FILTER (WHERE symbol = '{s}'), 6) AS \"price {s}\"" for s in SYMBOLS)
    + f" FROM ({TICKS}) t GROUP BY time")
def price_pivot(spark, sf_dir):
    """One price column per symbol."""
    df = reports.price_pivot(tables.stocks(spark, sf_dir))
    return r6(df, *[c for c in df.columns if c != "time"])


@register("fk_orphans", f"""
SELECT r.* FROM ({_READINGS}) r
WHERE NOT EXISTS (SELECT 1 FROM ({_SENSORS}) s WHERE s.id = r.sensor_id)""")
def fk_orphans(spark, sf_dir):
    """Readings without a sensor."""
    return reports.fk_orphans(tables.sensor_data(spark, sf_dir), tables.sensors(spark, sf_dir))


@register("table_counts", "SELECT (SELECT count(*) FROM customer) AS sensors, "
                          "(SELECT count(*) FROM events) AS readings")
def table_counts(spark, sf_dir):
    """Row counts of sensors and readings."""
    return reports.table_counts(tables.sensors(spark, sf_dir), tables.sensor_data(spark, sf_dir))


# ------------------------------------- step 5: continuous aggregates, layout

from datetime import timedelta  # noqa: E402

from tempora.operators import layout  # noqa: E402
from tempora.plans import cagg  # noqa: E402
from tempora.session import checkpointed, scratch_path  # noqa: E402

_FIRST_PASS_LAG = timedelta(hours=2)
_LATE_SQL = "CAST(props->>'k' AS INTEGER) < 10"
_STAT_COLS = ("bucket_time, sensor_id, reading_count, avg_temperature, min_temperature, "
              "max_temperature, stddev_temperature")


def _scenario(spark, sf_dir, mapper, name):
    """Materialise an aggregate from the rows visible two hours before the
    last event (late rows held back), then refresh it under its policy at
    the last event time with every row present."""
    ev = tables.events(spark, sf_dir)
    t = as_of(spark, sf_dir)
    first = ev.filter((F.col("ts") <= timefns.ntz_literal(t - _FIRST_PASS_LAG))
                      & ~tables.late_arrival(ev))
    agg = cagg.define(name, scratch_path(spark, "cagg", name))
    agg.create(mapper(first))
    seen = (F.col("ts") <= timefns.ntz_literal(t - _FIRST_PASS_LAG)) & ~tables.late_arrival(ev)
    agg.run_policy(mapper(ev), mapper(ev.filter(~seen)), t)
    return agg.read(spark)


def _scenario_sql(p1: str, p2: str, col: str, lo: str | None, hi: str) -> str:
    inside = f"{col} < ({hi})" + (f" AND {col} >= ({lo})" if lo else "")
    return f"""
WITH p1 AS ({p1}), p2 AS ({p2})
SELECT * FROM p2 WHERE {inside}
UNION ALL SELECT * FROM p1 WHERE NOT ({inside})"""


def _ceil_sql(width: str, t: str) -> str:
    b = f"time_bucket(INTERVAL '{width}', {t})"
    return f"CASE WHEN {b} = {t} THEN {t} ELSE {b} + INTERVAL '{width}' END"


_VISIBLE = f"ts <= {AS_OF} - INTERVAL 2 HOUR AND NOT ({_LATE_SQL})"


@register("cagg_full", _stats_sql("10 minutes"))
def cagg_full(spark, sf_dir):
    """K8: sensor_temp_10min materialised WITH DATA, read back."""
    agg = cagg.define("sensor_temp_10min", scratch_path(spark, "cagg", "full"))
    agg.create(tables.stat_readings(spark, sf_dir))
    return r6(agg.read(spark).select(*_STAT_COLS.split(", ")), "avg_temperature",
              "stddev_temperature")


@register("cagg_incremental", _scenario_sql(
    _stats_sql("10 minutes").replace("FROM events", f"FROM events WHERE {_VISIBLE}"),
    _stats_sql("10 minutes"), "bucket_time",
    _ceil_sql("10 minutes", f"{AS_OF} - INTERVAL 3 HOUR"),
    f"time_bucket(INTERVAL '10 minutes', {AS_OF} - INTERVAL 10 MINUTE)"))
def cagg_incremental(spark, sf_dir):
    """sensor_temp_10min refreshed under (3 h, 10 min): late rows
    count only inside the window."""
    df = _scenario(spark, sf_dir, tables.stat_readings_of, "sensor_temp_10min")
    return r6(df.select(*_STAT_COLS.split(", ")), "avg_temperature", "stddev_temperature")


@register("cagg_incremental_candle", _scenario_sql(
    _candle_sql("1 hour").replace("FROM events", f"FROM events WHERE {_VISIBLE}"),
    _candle_sql("1 hour"), "bucket",
    _ceil_sql("1 hour", f"{AS_OF} - INTERVAL 3 HOUR"),
    f"time_bucket(INTERVAL '1 hour', {AS_OF} - INTERVAL 1 HOUR)"))
def cagg_incremental_candle(spark, sf_dir):
    """one_hour_candle refreshed under (3 h, 1 h)."""
    df = _scenario(spark, sf_dir, tables.stocks_of, "one_hour_candle")
    return df.select("bucket", "symbol", "open", "high", "low", "close", "day_volume")


def _kwh_hi_sql():
    t = f"(({AS_OF} - INTERVAL 1 HOUR) AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Berlin'"
    return (f"CAST((date_trunc('day', {t}) AT TIME ZONE 'Europe/Berlin') AT TIME ZONE 'UTC' "
            "AS TIMESTAMP)")


@register("cagg_incremental_kwh", _scenario_sql(
    _kwh_sql("day").replace("WHERE event_type = 'view'", f"WHERE event_type = 'view' AND {_VISIBLE}"),
    _kwh_sql("day"), "time", None, _kwh_hi_sql()))
def cagg_incremental_kwh(spark, sf_dir):
    """kwh_day_by_day refreshed under (unbounded, 1 h) on Berlin days."""
    df = _scenario(spark, sf_dir, lambda ev: tables.metrics_of_type_of(ev, 5), "kwh_day_by_day")
    return df.select("time", "value")


@register("chunk_write_readback", f"""
SELECT time, sensor_id, temperature FROM ({_READINGS}) r
WHERE time >= {AS_OF} - INTERVAL 7 DAY""")
def chunk_write_readback(spark, sf_dir):
    """K5/K6: write readings as a 7-day-chunked table segmented by sensor,
    read back a week with chunk pruning."""
    path = scratch_path(spark, "chunked", "sensor_data")
    layout.write_chunked(tables.sensor_data(spark, sf_dir), path, "time", "sensor_id")
    t = as_of(spark, sf_dir)
    return layout.read_chunked(spark, path, "time", lo=t - timedelta(days=7))


@register("compact_check", f"SELECT time, sensor_id, temperature FROM ({_READINGS}) r")
def compact_check(spark, sf_dir):
    """K7: two appends (on-time, then late rows), then compaction of chunks
    older than two days; the table keeps every row."""
    ev = tables.events(spark, sf_dir)
    path = scratch_path(spark, "chunked", "compact")
    late = tables.late_arrival(ev)
    layout.write_chunked(tables.sensor_data_of(ev.filter(~late | late.isNull())), path, "time",
                            "sensor_id")
    layout.write_chunked(tables.sensor_data_of(ev.filter(late)), path, "time", "sensor_id")
    layout.compact_table(spark, "sensor_data", path, as_of(spark, sf_dir))
    return spark.read.parquet(path).drop("chunk")


# ------------------------------------------------------- step 6: IoT ingest

from tempora import schemas  # noqa: E402
from tempora.operators import dims  # noqa: E402
from tempora.sources import messages  # noqa: E402
from tempora.streaming import iot  # noqa: E402
from tempora.streaming import ticks as tick_ingest  # noqa: E402


_PARSED: dict = {}


def _envelopes(spark, sf_dir):
    return messages.iot_envelopes(tables.events(spark, sf_dir))


def _parsed(spark, sf_dir):
    """The routed messages of the given tables.  The plan (not its rows) is
    built once per session and folder - DataFrames are immutable and lazy;
    every query still executes it in full."""
    key = (tables.session_key(spark), sf_dir)
    if key not in _PARSED:
        _PARSED[key] = iot.parse(_envelopes(spark, sf_dir))
    return _PARSED[key]


def _empty_sensors(spark):
    return spark.createDataFrame([], schemas.SENSORS)


_DEV_SQL = "CASE WHEN user_id % 37 = 0 THEN 'unknown' ELSE printf('device-%03d', user_id) END"
_TEMPS_ROWS = f"""
SELECT date_trunc('second', min(ts) OVER (PARTITION BY event_id // 4, user_id)) AS time,
       min(event_id) OVER (PARTITION BY event_id // 4, user_id) AS seq,
       {_DEV_SQL} AS device_id,
       printf('28-%08x-%d', event_id // 32, event_id % 4) AS sensor_sn, value
FROM events WHERE event_type IN ('click', 'purchase', 'view')"""
_FLAT = f"SELECT time, seq, device_id, sensor_sn, value AS temperature FROM ({_TEMPS_ROWS}) t WHERE value <= 450"
_DIM = f"""
SELECT CAST(row_number() OVER (ORDER BY time, seq, sensor_sn) AS INTEGER) AS id, sensor_sn,
       device_id, 'temperature' AS type, 'unknown' AS location
FROM (SELECT *, row_number() OVER (PARTITION BY sensor_sn ORDER BY time, seq, device_id) AS rn
      FROM ({_FLAT}) f) x WHERE rn = 1"""


@register("iot_flatten", f"SELECT time, device_id, sensor_sn, temperature FROM ({_FLAT}) f")
def iot_flatten(spark, sf_dir):
    """Temps messages → one reading per sensor entry."""
    return iot.readings(_parsed(spark, sf_dir)).select("time", "device_id", "sensor_sn",
                                                       "temperature")


@register("sensor_register", _DIM)
def sensor_register(spark, sf_dir):
    """Sensors registered from every reading; first device wins, ids
    dense in order of first sighting."""
    return dims.register_sensors(_empty_sensors(spark), iot.readings(_parsed(spark, sf_dir)))


@register("iot_readings", f"""
SELECT f.time, d.id AS sensor_id, f.temperature
FROM ({_FLAT}) f JOIN ({_DIM}) d ON f.sensor_sn = d.sensor_sn""")
def iot_readings(spark, sf_dir):
    """Readings with the registered sensor ids (sensor_data rows)."""
    # Used by both the registration and the id lookup: parse once.
    r = checkpointed(iot.readings(_parsed(spark, sf_dir)))
    dim = dims.register_sensors(_empty_sensors(spark), r)
    return dims.resolve(r, dim).select("time", "sensor_id", "temperature")


_STATUS_JSON = ("printf('{\"eventCategory\":\"%s\",\"messageCounter\":%d,\"gitVersion\":\"v1.%d\","
                "\"version\":\"1.%d\",\"stableVersion\":\"1.0\",\"numTempSensors\":%d,"
                "\"numFlowSensors\":%d,\"isCameraEnabled\":%s,\"cpu_usage\":%d}', event_type, k, k, "
                "k, k % 4, k % 2, CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END, k)")


@register("iot_status", f"""
SELECT date_trunc('second', ts) AS time, {_DEV_SQL} AS device_id, event_type AS event_category,
       CAST(k AS INTEGER) AS message_counter, printf('v1.%d', k) AS git_version,
       printf('1.%d', k) AS git_current_version, '1.0' AS git_stable_version,
       CAST(k % 4 AS INTEGER) AS num_temp_sensors, CAST(k % 2 AS INTEGER) AS num_flow_sensors,
       k % 2 = 0 AS is_camera_enabled, {_STATUS_JSON} AS status_data
FROM (SELECT *, CAST(props->>'k' AS INTEGER) AS k FROM events WHERE event_type = 'signup') s
WHERE k < 95""")
def iot_status(spark, sf_dir):
    """Validated status messages → device_status rows."""
    return iot.device_status(_parsed(spark, sf_dir))


@register("iot_quarantine", f"""
SELECT reason, count(*) AS n FROM (
  SELECT CASE WHEN event_type = 'error' AND CAST(props->>'k' AS INTEGER) % 2 = 0 THEN 'invalid_json'
              WHEN event_type = 'error' THEN 'unknown_format'
              WHEN event_type = 'signup' AND CAST(props->>'k' AS INTEGER) >= 95
                   THEN 'bad_type:messageCounter'
              WHEN event_type IN ('click', 'purchase', 'view') AND value > 450 THEN 'bad_temperature'
         END AS reason
  FROM events) q
WHERE reason IS NOT NULL GROUP BY reason""")
def iot_quarantine(spark, sf_dir):
    """Rejected messages and entries counted by reason."""
    return iot.quarantine(_parsed(spark, sf_dir)).groupBy("reason").agg(
        F.count(F.lit(1)).alias("n"))


_MESSAGES = """
SELECT user_id, min(event_id) AS seq, min(ts) AS ts FROM events
WHERE event_type IN ('click', 'purchase', 'view') GROUP BY event_id // 4, user_id
UNION ALL
SELECT user_id, event_id AS seq, ts FROM events WHERE event_type IN ('signup', 'error')"""


@register("stream_progress", f"""
SELECT partition, seq * 10 AS offset, seq AS sequence_number,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp
FROM (SELECT CAST(user_id % 4 AS VARCHAR) AS partition, max(seq) AS seq, arg_max(ts, seq) AS ts
      FROM ({_MESSAGES}) m GROUP BY 1) p""")
def stream_progress(spark, sf_dir):
    """Last offset, sequence number and time per partition."""
    return iot.progress(_envelopes(spark, sf_dir))


@register("partition_props", f"""
SELECT CAST(user_id % 4 AS VARCHAR) AS partition, min(seq) AS beginning_sequence_number,
       max(seq) AS last_enqueued_sequence_number, count(*) AS messages
FROM ({_MESSAGES}) m GROUP BY 1""")
def partition_props(spark, sf_dir):
    """Per-partition sequence range and message count."""
    return iot.partition_properties(_envelopes(spark, sf_dir))


# ------------------------------------------------ step 7: ticks, CSV load

@register("tick_filter", """
SELECT date_trunc('second', ts) AS time, event_type AS symbol, value AS price,
       CASE WHEN event_type = 'signup' THEN NULL
            ELSE CAST(event_id AS DECIMAL(38,10)) END AS day_volume
FROM events""")
def tick_filter(spark, sf_dir):
    """Price frames kept, control frames dropped, mapped onto
    (time, symbol, price, day_volume)."""
    frames = messages.tick_frames(tables.events(spark, sf_dir))
    return tick_ingest.price_rows(tick_ingest.parse_frames(frames))


@register("csv_load", """
SELECT ts AS created, CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2
       WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 WHEN 'view' THEN 5 END AS INTEGER) AS type_id,
       value
FROM events""")
def csv_load(spark, sf_dir):
    """Metrics exported as gzip CSV with a header, loaded once into a
    typed table (a second load is skipped by the guard)."""
    from tempora.sources import csv as csv_source
    from tempora.sources.versioned import Store

    base = scratch_path(spark, "csv")
    csv_source.write_csv(tables.metrics(spark, sf_dir), f"{base}/metrics_csv")
    store = Store(spark, f"{base}/tables")
    csv_source.load_once(store, f"{base}/metrics_csv", "metrics", schemas.METRICS)
    csv_source.load_once(store, f"{base}/metrics_csv", "metrics", schemas.METRICS)
    return store.read("metrics").withColumn("created", timefns.instant_to_ntz("created"))


# ------------------------------------------------ constraint checks (K9)

from tempora.operators import quality  # noqa: E402


def _table_constraints(spark, sf_dir):
    sensors = tables.sensors(spark, sf_dir)
    lim = schemas.VARCHAR_LIMITS
    return [
        (sensors, quality.Constraints("sensors", not_null=["id", "sensor_sn"],
                                      max_length=lim["sensors"], unique=["sensor_sn"])),
        (tables.sensor_data(spark, sf_dir), quality.Constraints(
            "sensor_data", not_null=["time", "sensor_id"],
            foreign_keys=[("sensor_id", sensors, "id")])),
        (tables.device_status(spark, sf_dir), quality.Constraints(
            "device_status", not_null=["time", "device_id"],
            max_length={k: v for k, v in lim["device_status"].items()})),
        (tables.metrics(spark, sf_dir), quality.Constraints(
            "metrics", not_null=["created", "type_id", "value"], default_now=["created"])),
    ]


def _count_sql(table: str, check: str, cond: str, source: str) -> str:
    return (f"SELECT '{table}' AS \"table\", '{check}' AS \"check\", "
            f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS violations FROM ({source}) s")


_MET = ("SELECT ts AS created, CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 "
        "WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 WHEN 'view' THEN 5 END AS type_id, value "
        "FROM events")
_CONSTRAINT_SQL = " UNION ALL ".join([
    _count_sql("sensors", "not_null:id", "id IS NULL", _SENSORS),
    _count_sql("sensors", "not_null:sensor_sn", "sensor_sn IS NULL", _SENSORS),
    *[_count_sql("sensors", f"too_long:{c}", f"length({c}) > {n}", _SENSORS)
      for c, n in schemas.VARCHAR_LIMITS["sensors"].items()],
    f"SELECT 'sensors', 'unique:sensor_sn', CAST(coalesce(sum(n - 1) FILTER (WHERE n > 1), 0) "
    f"AS BIGINT) FROM (SELECT sensor_sn, count(*) AS n FROM ({_SENSORS}) s "
    f"WHERE sensor_sn IS NOT NULL GROUP BY 1) u",
    _count_sql("sensor_data", "not_null:time", "time IS NULL", _READINGS),
    _count_sql("sensor_data", "not_null:sensor_id", "sensor_id IS NULL", _READINGS),
    f"SELECT 'sensor_data', 'fk:sensor_id', CAST(count(*) AS BIGINT) FROM ({_READINGS}) r "
    f"WHERE sensor_id IS NOT NULL AND NOT EXISTS "
    f"(SELECT 1 FROM ({_SENSORS}) s WHERE s.id = r.sensor_id)",
    _count_sql("device_status", "not_null:time", "time IS NULL", _STATUS),
    _count_sql("device_status", "not_null:device_id", "device_id IS NULL", _STATUS),
    *[_count_sql("device_status", f"too_long:{c}", f"length({c}) > {n}", _STATUS)
      for c, n in schemas.VARCHAR_LIMITS["device_status"].items()],
    _count_sql("metrics", "not_null:created", "created IS NULL", _MET),
    _count_sql("metrics", "not_null:type_id", "type_id IS NULL", _MET),
    _count_sql("metrics", "not_null:value", "value IS NULL", _MET),
])


@register("constraint_report", _CONSTRAINT_SQL)
def constraint_report(spark, sf_dir):
    """K9: NOT NULL / varchar(n) / UNIQUE / FK violation counts per table."""
    out = None
    for df, c in _table_constraints(spark, sf_dir):
        v = quality.violations(df, c)
        out = v if out is None else out.unionByName(v)
    return out


@register("readings_fk_split", f"""
SELECT r.time, r.sensor_id, r.temperature FROM ({STAT}) r
WHERE EXISTS (SELECT 1 FROM ({_SENSORS}) s WHERE s.id = r.sensor_id)""")
def readings_fk_split(spark, sf_dir):
    """K9/J4 on ingest: readings split into accepted and quarantined by the
    sensor foreign key; the accepted part is returned."""
    c = quality.Constraints("sensor_data", not_null=["time", "sensor_id"],
                            foreign_keys=[("sensor_id", tables.sensors(spark, sf_dir), "id")])
    accepted, _ = quality.split(tables.stat_readings(spark, sf_dir), c)
    return accepted


# ------------------------------------------------ step 8: medians, sketches (A10)

@register("kwh_weekday_median_sketch", f"""
WITH per_day AS ({_kwh_sql('day')}),
daily AS (SELECT strftime(time, '%a') AS day, value FROM per_day WHERE {_F7}),
pct AS (SELECT day, quantile_disc(value, 0.5) AS value FROM daily GROUP BY 1)
SELECT d.day, d.ordinal, pd.value
FROM unnest(['Sun', 'Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat']) WITH ORDINALITY AS d(day, ordinal)
LEFT JOIN pct pd ON lower(pd.day) = lower(d.day)""")
def kwh_weekday_median_sketch(spark, sf_dir):
    """A10 via a KLL sketch per weekday (exact below k=200 items per group,
    so the discrete median is the oracle)."""
    return reports.kwh_weekday_median(_kwh_day(spark, sf_dir), method="sketch")


@register("kwh_hour_profile_approx", f"""
WITH per_hour AS ({_kwh_sql('hour')}),
hourly AS (SELECT CAST(hour(time) AS INTEGER) AS hour, value FROM per_hour WHERE {_F7})
SELECT hour, quantile_disc(value, 0.5) AS median, max(value) AS maximum
FROM hourly GROUP BY 1 ORDER BY 1""")
def kwh_hour_profile_approx(spark, sf_dir):
    """A10 via percentile_approx (exact at this group size)."""
    return reports.kwh_hour_profile(_kwh_hour(spark, sf_dir), method="approx")


@register("percentile_sketch", f"""
SELECT time_bucket(INTERVAL '1 day', bucket) AS day, count(*) AS readings, true AS within
FROM (SELECT time AS bucket, temperature FROM ({STAT}) r WHERE temperature IS NOT NULL) x GROUP BY 1""")
def percentile_sketch(spark, sf_dir):
    """A10 two-step: a KLL sketch per (hour, sensor) - what a continuous
    aggregate would store - merged per day, median read from the merged
    sketch.  Approximate on large groups, so the result says of each day
    whether the median's rank lies within the sketch's stated error (1.7 %
    of the readings, for the default size) of the middle."""
    return reports.median_rank_check(tables.stat_readings(spark, sf_dir))


# ------------------------------------------------ streaming runners

from tempora.streaming import ingest  # noqa: E402


@register("cagg_stream_10min", f"""
SELECT * FROM ({_stats_sql('10 minutes')}) s
WHERE bucket_time + INTERVAL 10 MINUTE <= {AS_OF} - INTERVAL 3 HOUR""")
def cagg_stream_10min(spark, sf_dir):
    """sensor_temp_10min as a Structured Streaming window aggregate
    (watermark = the policy's 3 h start offset, append mode): the windows
    closed by the watermark are emitted, exactly as the batch aggregate."""
    base = scratch_path(spark, "stream", "cagg")
    rows = tables.stat_readings(spark, sf_dir)
    rows.write.parquet(f"{base}/landing")
    agg = cagg.define("sensor_temp_10min", f"{base}/out")
    src = spark.readStream.schema(rows.schema).parquet(f"{base}/landing")
    q = agg.stream(src, f"{base}/checkpoint", trigger={"availableNow": True})
    q.awaitTermination()
    return r6(agg.read(spark).select(*_STAT_COLS.split(", ")), "avg_temperature", "stddev_temperature")


def _ingested(spark, sf_dir) -> ingest.IngestTables:
    """The tables that the ingestion job makes of a landed stream."""
    base = scratch_path(spark, "stream", "iot")
    env = messages.iot_envelopes(tables.events(spark, sf_dir))
    env.write.parquet(f"{base}/landing")
    src = spark.readStream.schema(env.schema).parquet(f"{base}/landing")
    out = ingest.IngestTables(f"{base}/tables")
    q = ingest.start(spark, src, out, f"{base}/checkpoint", trigger={"availableNow": True})
    q.awaitTermination()
    return out


@register("iot_ingest_stream", f"""
SELECT f.time, d.id AS sensor_id, f.temperature
FROM ({_FLAT}) f JOIN ({_DIM}) d ON f.sensor_sn = d.sensor_sn""")
def iot_ingest_stream(spark, sf_dir):
    """The ingestion job on a landed envelope stream
    (foreachBatch: sensor registration, readings, status, quarantine,
    progress); returns the sensor_data table it wrote."""
    out = _ingested(spark, sf_dir)
    return out.read(spark, "sensor_data").select("time", "sensor_id", "temperature")


# ------------------------------------------- the remaining refresh policies

@register("cagg_incremental_30min", _scenario_sql(
    _stats_sql("30 minutes").replace("FROM events", f"FROM events WHERE {_VISIBLE}"),
    _stats_sql("30 minutes"), "bucket_time",
    _ceil_sql("30 minutes", f"{AS_OF} - INTERVAL 12 HOUR"),
    f"time_bucket(INTERVAL '30 minutes', {AS_OF} - INTERVAL 30 MINUTE)"))
def cagg_incremental_30min(spark, sf_dir):
    """sensor_temp_30min refreshed under (12 h, 30 min)."""
    df = _scenario(spark, sf_dir, tables.stat_readings_of, "sensor_temp_30min")
    return r6(df.select(*_STAT_COLS.split(", ")), "avg_temperature", "stddev_temperature")


@register("cagg_incremental_1h", _scenario_sql(
    _stats_sql("1 hour").replace("FROM events", f"FROM events WHERE {_VISIBLE}"),
    _stats_sql("1 hour"), "bucket_time",
    _ceil_sql("1 hour", f"{AS_OF} - INTERVAL 2 DAY"),
    f"time_bucket(INTERVAL '1 hour', {AS_OF} - INTERVAL 1 HOUR)"))
def cagg_incremental_1h(spark, sf_dir):
    """sensor_temp_1h refreshed under (2 days, 1 h)."""
    df = _scenario(spark, sf_dir, tables.stat_readings_of, "sensor_temp_1h")
    return r6(df.select(*_STAT_COLS.split(", ")), "avg_temperature", "stddev_temperature")


@register("cagg_incremental_candle_10min", _scenario_sql(
    _candle_sql("10 minutes").replace("FROM events", f"FROM events WHERE {_VISIBLE}"),
    _candle_sql("10 minutes"), "bucket",
    _ceil_sql("10 minutes", f"{AS_OF} - INTERVAL 30 MINUTE"),
    f"time_bucket(INTERVAL '10 minutes', {AS_OF} - INTERVAL 10 MINUTE)"))
def cagg_incremental_candle_10min(spark, sf_dir):
    """ten_min_candle refreshed under (30 min, 10 min)."""
    df = _scenario(spark, sf_dir, tables.stocks_of, "ten_min_candle")
    return df.select("bucket", "symbol", "open", "high", "low", "close", "day_volume")


def _kwh_hour_hi_sql():
    t = f"(({AS_OF} - INTERVAL 1 HOUR) AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Berlin'"
    return (f"CAST((date_trunc('hour', {t}) AT TIME ZONE 'Europe/Berlin') AT TIME ZONE 'UTC' "
            "AS TIMESTAMP)")


@register("cagg_incremental_kwh_hour", _scenario_sql(
    _kwh_sql("hour").replace("WHERE event_type = 'view'", f"WHERE event_type = 'view' AND {_VISIBLE}"),
    _kwh_sql("hour"), "time", None, _kwh_hour_hi_sql()))
def cagg_incremental_kwh_hour(spark, sf_dir):
    """kwh_hour_by_hour refreshed under (unbounded, 1 h) on Berlin hours."""
    df = _scenario(spark, sf_dir, lambda ev: tables.metrics_of_type_of(ev, 5), "kwh_hour_by_hour")
    return df.select("time", "value")


@register("tick_stream", """
SELECT date_trunc('second', ts) AS time, event_type AS symbol, value AS price,
       CASE WHEN event_type = 'signup' THEN NULL
            ELSE CAST(event_id AS DECIMAL(38,10)) END AS day_volume
FROM events""")
def tick_stream(spark, sf_dir):
    """S3/K1/F8: tick frames landed as text files, ingested by the streaming
    job into a chunked Parquet table (file sink, exactly once)."""
    base = scratch_path(spark, "stream", "ticks")
    frames = messages.tick_frames(tables.events(spark, sf_dir))
    frames.select(F.col("frame").alias("value")).write.text(f"{base}/landing")
    src = messages.read_ticks(spark, f"{base}/landing")
    q = tick_ingest.start(src, f"{base}/stocks", f"{base}/checkpoint",
                          trigger={"availableNow": True})
    q.awaitTermination()
    return spark.read.parquet(f"{base}/stocks").drop("chunk")


@register("cagg_invalidation_kwh", ORACLE["cagg_incremental_kwh"])
def cagg_invalidation_kwh(spark, sf_dir):
    """W2 for an unbounded policy, driven by invalidation: after the first
    pass, only the buckets that received rows since (late rows and the last
    two hours) are recomputed - the same result as refreshing all history."""
    ev = tables.events(spark, sf_dir)
    t = as_of(spark, sf_dir)
    visible = (F.col("ts") <= timefns.ntz_literal(t - _FIRST_PASS_LAG)) & ~tables.late_arrival(ev)
    agg = cagg.define("kwh_day_by_day", scratch_path(spark, "cagg", "invalidation"))
    mapper = lambda e: tables.metrics_of_type_of(e, 5)
    agg.create(mapper(ev.filter(visible)))
    agg.refresh_changed(mapper(ev), mapper(ev.filter(~visible)), t)
    return agg.read(spark).select("time", "value")


@register("agg_recent_10min_materialized", ORACLE["agg_recent_10min"])
def agg_recent_10min_materialized(spark, sf_dir):
    """R15 as the reference runs it: against the materialised 10-minute
    aggregate, reading only the bucket_date partitions of the last day."""
    t = as_of(spark, sf_dir)
    agg = cagg.define("sensor_temp_10min", scratch_path(spark, "cagg", "materialized"))
    agg.create(tables.stat_readings(spark, sf_dir))
    df = reports.recent_aggregates(agg.read(spark, after=_since(t, "1 day")), t)
    return r6(df.select(*_STAT_COLS.split(", ")), "avg_temperature", "stddev_temperature")


@register("agg_1h_one_sensor_materialized", ORACLE["agg_1h_one_sensor"])
def agg_1h_one_sensor_materialized(spark, sf_dir):
    """R16 against the materialised hourly aggregate (30-day partition range)."""
    t = as_of(spark, sf_dir)
    agg = cagg.define("sensor_temp_1h", scratch_path(spark, "cagg", "materialized_1h"))
    agg.create(tables.stat_readings(spark, sf_dir))
    df = reports.sensor_history(agg.read(spark, after=_since(t, "30 days")), SENSOR, t)
    return r6(df, "avg_temperature")


@register("stability_class_materialized", ORACLE["stability_class"])
def stability_class_materialized(spark, sf_dir):
    """R17 against the materialised 10-minute aggregate (last day's partitions)."""
    t = as_of(spark, sf_dir)
    agg = cagg.define("sensor_temp_10min", scratch_path(spark, "cagg", "materialized_stab"))
    agg.create(tables.stat_readings(spark, sf_dir))
    df = reports.stability_class(agg.read(spark, after=_since(t, "1 day")), t)
    return r6(df, "avg_temperature", "stddev_temperature")


# ------------------------------------- stream, refresh and report in one path

_SECOND_TICKS = """
SELECT date_trunc('second', ts) AS time, event_type AS symbol, value AS price,
       CASE WHEN event_type = 'signup' THEN NULL ELSE CAST(event_id AS DECIMAL(38,10)) END AS day_volume
FROM events"""


@register("candle_from_ticks", _candle_sql("10 minutes", _SECOND_TICKS))
def candle_from_ticks(spark, sf_dir):
    """A2-A5 over whole-second ticks: of equal times the smaller volume, then
    the smaller price, is the earlier one."""
    frames = messages.tick_frames(tables.events(spark, sf_dir))
    return reports.candles(tick_ingest.price_rows(tick_ingest.parse_frames(frames)), "10 minutes")


def _streamed_candles(spark, sf_dir, chunk_interval):
    base = scratch_path(spark, "stream", "candles")
    t = as_of(spark, sf_dir)
    frames = messages.tick_frames(tables.events(spark, sf_dir))
    frames.select(F.col("frame").alias("value")).write.text(f"{base}/landing")
    q = tick_ingest.start(messages.read_ticks(spark, f"{base}/landing"), f"{base}/stocks",
                          f"{base}/checkpoint", {"availableNow": True}, chunk_interval)
    q.awaitTermination()
    raw = spark.read.parquet(f"{base}/stocks")
    agg = cagg.define("one_hour_candle", f"{base}/candles")
    agg.raw_chunk_interval = f"{layout.known_interval(spark, f'{base}/stocks')} seconds"
    agg.create(raw.filter(F.col("time") <= timefns.ntz_literal(t - _FIRST_PASS_LAG)))
    agg.refresh(raw, t)
    return reports.candles_for(agg.read(spark), SYMBOL_1H)


_STREAMED_SQL = _scenario_sql(
    _candle_sql("1 hour", _SECOND_TICKS + f" WHERE date_trunc('second', ts) <= {AS_OF} - INTERVAL 2 HOUR"),
    _candle_sql("1 hour", _SECOND_TICKS), "bucket", _ceil_sql("1 hour", f"{AS_OF} - INTERVAL 3 HOUR"),
    f"time_bucket(INTERVAL '1 hour', {AS_OF} - INTERVAL 1 HOUR)")


@register("tick_stream_to_candle", f"SELECT * FROM ({_STREAMED_SQL}) c WHERE symbol = '{SYMBOL_1H}' "
                                   "ORDER BY bucket")
def tick_stream_to_candle(spark, sf_dir):
    """Ticks streamed into a weekly chunked table, one_hour_candle
    refreshed from it under its policy, one symbol's candles reported."""
    return _streamed_candles(spark, sf_dir, layout.DEFAULT_CHUNK)


@register("tick_stream_to_candle_daily", ORACLE["tick_stream_to_candle"])
def tick_stream_to_candle_daily(spark, sf_dir):
    """The same from a daily chunked table."""
    return _streamed_candles(spark, sf_dir, "1 day")


@register("cagg_stream_then_refresh", _scenario_sql(
    _stats_sql("10 minutes").replace("FROM events", f"FROM events WHERE NOT ({_LATE_SQL})")
    .replace("GROUP BY 1, 2", f"AND time_bucket(INTERVAL '10 minutes', time) + INTERVAL 10 MINUTE <= "
             f"(SELECT max(ts) FROM events WHERE NOT ({_LATE_SQL})) - INTERVAL 3 HOUR GROUP BY 1, 2"),
    _stats_sql("10 minutes"), "bucket_time", _ceil_sql("10 minutes", f"{AS_OF} - INTERVAL 3 HOUR"),
    f"time_bucket(INTERVAL '10 minutes', {AS_OF} - INTERVAL 10 MINUTE)"))
def cagg_stream_then_refresh(spark, sf_dir):
    """sensor_temp_10min kept by the streaming runner from rows on
    time, then the same table refreshed under its policy with late rows."""
    base = scratch_path(spark, "stream", "cagg_refresh")
    ev = tables.events(spark, sf_dir)
    rows = tables.stat_readings_of(ev.filter(~tables.late_arrival(ev)))
    rows.write.parquet(f"{base}/landing")
    agg = cagg.define("sensor_temp_10min", f"{base}/out")
    src = spark.readStream.schema(rows.schema).parquet(f"{base}/landing")
    agg.stream(src, f"{base}/checkpoint", trigger={"availableNow": True}).awaitTermination()
    agg.refresh(tables.stat_readings(spark, sf_dir), as_of(spark, sf_dir))
    return r6(agg.read(spark).select(*_STAT_COLS.split(", ")), "avg_temperature", "stddev_temperature")


# ------------------------------------- counters, progress records, start position

@register("ingest_counters", f"""
SELECT (SELECT count(*) FROM ({_MESSAGES}) m) AS messages,
       (SELECT count(*) FROM events WHERE event_type IN ('click', 'purchase', 'view')) AS sensor_entries,
       (SELECT count(*) FROM events WHERE event_type = 'signup' AND CAST(props->>'k' AS INTEGER) < 95)
         AS status_messages,
       (SELECT count(*) FROM events WHERE event_type = 'error'
          OR event_type = 'signup' AND CAST(props->>'k' AS INTEGER) >= 95) AS rejected""")
def ingest_counters(spark, sf_dir):
    """The ingestion job's counters, added up over its batches."""
    c = _ingested(spark, sf_dir).read(spark, "ingest_counters")
    return c.agg(*[F.sum(x).alias(x) for x in ("messages", "sensor_entries", "status_messages", "rejected")])


@register("progress_records", f"SELECT * FROM ({ORACLE['stream_progress']}) p WHERE partition <> '3'")
def progress_records(spark, sf_dir):
    """Stored progress records listed after one partition's were deleted."""
    out = _ingested(spark, sf_dir)
    ingest.delete_progress(spark, out, "3")
    return ingest.latest_progress(spark, out)


@register("start_position", f"""
SELECT seq AS sequence_number, CAST(user_id % 4 AS VARCHAR) AS partition FROM ({_MESSAGES}) m
WHERE ts >= {AS_OF} - INTERVAL 7 DAY""")
def start_position(spark, sf_dir):
    """A stream told to leave the past out reads messages from its start on."""
    base = scratch_path(spark, "stream", "position")
    env = messages.iot_envelopes(tables.events(spark, sf_dir))
    env.write.parquet(f"{base}/landing")
    since = as_of(spark, sf_dir) - timedelta(days=7)
    src = messages.read_envelopes(spark, f"{base}/landing", fmt="parquet", ignore_past="True",
                                  started_at=since)
    q = (src.select(F.col("seq").alias("sequence_number"), "partition").writeStream.format("parquet")
         .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start(f"{base}/out"))
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")


@register("fk_orphans_found", f"SELECT * FROM ({_READINGS}) r WHERE sensor_id % 7 = 3")
def fk_orphans_found(spark, sf_dir):
    """J4 against a dimension that lacks every seventh sensor."""
    lacking = tables.sensors(spark, sf_dir).filter("id % 7 <> 3")
    return reports.fk_orphans(tables.sensor_data(spark, sf_dir), lacking)


@register("default_now", f"""
SELECT coalesce(created, {AS_OF}) AS created, type_id, value
FROM (SELECT CASE WHEN type_id = 2 THEN NULL ELSE created END AS created, type_id, value FROM ({_MET}) m) x""")
def default_now(spark, sf_dir):
    """K9: a missing time gets the time of the load (here that of the last event)."""
    rows = tables.metrics(spark, sf_dir).withColumn(
        "created", F.when(F.col("type_id") != 2, F.col("created")))
    c = quality.Constraints("metrics", default_now=["created"])
    return quality.apply_defaults(rows, c, timefns.ntz_literal(as_of(spark, sf_dir)))
