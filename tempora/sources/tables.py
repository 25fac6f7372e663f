"""Table access and the mapping of the driver's test tables onto the
reference's tables.

The reference's own data (an energy CSV, live ticks, device messages) is not
available, so the generated ``events`` and ``customer`` tables stand in:

* ``metrics``       created=ts, type_id from event_type, value
* ``stocks``        time=ts, symbol=event_type, price=value,
                    day_volume=event_id as NUMERIC
* ``sensor_data``   time=ts, sensor_id=user_id, temperature=value
* ``stat_readings`` time=ts, sensor_id=user_id % 5, temperature=value / 25
                    (denser groups so that the statistics are not all NULL)
* ``sensors``       customer: id=c_custkey, sensor_sn=c_name,
                    device_id=c_nationkey, type='temperature',
                    location=c_mktsegment
* ``device_status`` time=ts, device_id=user_id, event_category=event_type,
                    message_counter=event_id, status_data=props

Every mapping is a projection, so Catalyst prunes the scan to the columns a
query uses and pushes filters on ``ts`` into the Parquet reader.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

# Fixed values of the stand-in mapping: event_type → type_id.
TYPE_IDS = {"click": 1, "error": 2, "purchase": 3, "signup": 4, "view": 5}


_RELATIONS: dict = {}


def session_key(spark: SparkSession) -> tuple:
    """Identity of a live session (a restarted context gets a new app id)."""
    try:
        return (spark.sparkContext.applicationId, spark._jsparkSession.hashCode())
    except Exception:  # noqa: BLE001 - a session without a local context
        return ("session", id(spark))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table's relation, resolved once per session: file listing and
    Parquet footer schema are read on first use, later queries reuse them
    (the DataFrame is lazy - no rows are cached)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (session_key(spark), path)
    df = _RELATIONS.get(key)
    if df is None:
        df = _RELATIONS[key] = spark.read.parquet(path)
    return df


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def type_id_of(event_type) -> F.Column:
    c = F.col(event_type) if isinstance(event_type, str) else event_type
    expr = None
    for name, tid in TYPE_IDS.items():
        expr = (F.when(c == name, F.lit(tid)) if expr is None
                else expr.when(c == name, F.lit(tid)))
    return expr.cast("int")


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir)
    return ev.select(F.col("ts").alias("created"), type_id_of("event_type").alias("type_id"),
                     F.col("value"))


def metrics_of_type(spark: SparkSession, sf_dir: str, type_id: int) -> DataFrame:
    """metrics WHERE type_id = n, with the predicate stated on the stored
    column so it is pushed into the Parquet scan."""
    return metrics_of_type_of(events(spark, sf_dir), type_id)


def metrics_of_type_of(ev: DataFrame, type_id: int) -> DataFrame:
    name = next(k for k, v in TYPE_IDS.items() if v == type_id)
    ev = ev.filter(F.col("event_type") == name)
    return ev.select(F.col("ts").alias("created"), F.lit(type_id).cast("int").alias("type_id"),
                     F.col("value"))


def stocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stocks_of(events(spark, sf_dir))


def stocks_of(ev: DataFrame) -> DataFrame:
    return ev.select(F.col("ts").alias("time"), F.col("event_type").alias("symbol"),
                     F.col("value").alias("price"),
                     F.col("event_id").cast("decimal(38,10)").alias("day_volume"))


def sensor_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensor_data_of(events(spark, sf_dir))


def sensor_data_of(ev: DataFrame) -> DataFrame:
    return ev.select(F.col("ts").alias("time"), F.col("user_id").cast("int").alias("sensor_id"),
                     F.col("value").alias("temperature"))


def stat_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stat_readings_of(events(spark, sf_dir))


def stat_readings_of(ev: DataFrame) -> DataFrame:
    return ev.select(F.col("ts").alias("time"),
                     (F.col("user_id") % 5).cast("int").alias("sensor_id"),
                     (F.col("value") / F.lit(25.0)).alias("temperature"))


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("int").alias("id"),
                    F.col("c_name").alias("sensor_sn"),
                    F.col("c_nationkey").cast("string").alias("device_id"),
                    F.lit("temperature").alias("type"),
                    F.col("c_mktsegment").alias("location"))


def device_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir)
    null_int = F.lit(None).cast("int")
    null_str = F.lit(None).cast("string")
    return ev.select(
        F.col("ts").alias("time"),
        F.col("user_id").cast("string").alias("device_id"),
        F.col("event_type").alias("event_category"),
        F.col("event_id").cast("int").alias("message_counter"),
        null_str.alias("git_version"), null_str.alias("git_current_version"),
        null_str.alias("git_stable_version"), null_int.alias("num_temp_sensors"),
        null_int.alias("num_flow_sensors"), F.lit(None).cast("boolean").alias("is_camera_enabled"),
        F.col("props").alias("status_data"),
    )


def latest_time(df: DataFrame, col: str) -> datetime:
    """max(col) as a Python value: one aggregate job returning one scalar.

    Reports take an explicit ``as_of`` so that their time filters are
    literals (pushed into the scan, pruning files and row groups); this is
    the repeatable stand-in for NOW() used by tests and the registry.
    """
    return df.agg(F.max(col).alias("m")).first()["m"]


def late_arrival(ev: DataFrame):
    """Rows treated as arriving late in refresh scenarios: props.k < 10."""
    return F.get_json_object(ev["props"], "$.k").cast("int") < 10
