"""Declared schemas of the reference's tables (nothing is ever inferred)."""

from pyspark.sql import types as T

# energy readings: created timestamptz, type_id integer, value double
METRICS = T.StructType([
    T.StructField("created", T.TimestampType(), False),
    T.StructField("type_id", T.IntegerType(), False),
    T.StructField("value", T.DoubleType(), False),
])

# market ticks; day_volume is an unbounded NUMERIC in the reference
STOCKS_REAL_TIME = T.StructType([
    T.StructField("time", T.TimestampType(), True),
    T.StructField("symbol", T.StringType(), True),
    T.StructField("price", T.DoubleType(), True),
    T.StructField("day_volume", T.DecimalType(38, 10), True),
])

CRYPTO_ASSETS = T.StructType([
    T.StructField("symbol", T.StringType(), True),
    T.StructField("name", T.StringType(), True),
])

SENSORS = T.StructType([
    T.StructField("id", T.IntegerType(), False),
    T.StructField("sensor_sn", T.StringType(), False),
    T.StructField("device_id", T.StringType(), True),
    T.StructField("type", T.StringType(), True),
    T.StructField("location", T.StringType(), True),
])

SENSOR_DATA = T.StructType([
    T.StructField("time", T.TimestampType(), False),
    T.StructField("sensor_id", T.IntegerType(), False),
    T.StructField("temperature", T.DoubleType(), True),
    T.StructField("cpu", T.DoubleType(), True),
])

DEVICE_STATUS = T.StructType([
    T.StructField("time", T.TimestampType(), False),
    T.StructField("device_id", T.StringType(), False),
    T.StructField("event_category", T.StringType(), True),
    T.StructField("message_counter", T.IntegerType(), True),
    T.StructField("git_version", T.StringType(), True),
    T.StructField("git_current_version", T.StringType(), True),
    T.StructField("git_stable_version", T.StringType(), True),
    T.StructField("num_temp_sensors", T.IntegerType(), True),
    T.StructField("num_flow_sensors", T.IntegerType(), True),
    T.StructField("is_camera_enabled", T.BooleanType(), True),
    T.StructField("status_data", T.StringType(), True),
])

# Column-length limits declared by the DDL (fixed values of the reference).
VARCHAR_LIMITS = {
    "sensors": {"sensor_sn": 50, "device_id": 64, "type": 50, "location": 50},
    "device_status": {"device_id": 64, "event_category": 50, "git_version": 64,
                      "git_current_version": 64, "git_stable_version": 64},
}

# Message envelope of a partitioned device stream.
ENVELOPE = T.StructType([
    T.StructField("body", T.StringType(), True),
    T.StructField("device_id_raw", T.BinaryType(), True),
    T.StructField("partition", T.StringType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("seq", T.LongType(), True),
    T.StructField("enqueued", T.TimestampType(), True),
])

# A websocket tick frame; `day_volume` is optional.
TICK_EVENT = T.StructType([
    T.StructField("event", T.StringType(), True),
    T.StructField("timestamp", T.LongType(), True),
    T.StructField("symbol", T.StringType(), True),
    T.StructField("price", T.DoubleType(), True),
    T.StructField("day_volume", T.DecimalType(38, 10), True),
])

STREAM_PROGRESS = T.StructType([
    T.StructField("partition", T.StringType(), False),
    T.StructField("offset", T.LongType(), True),
    T.StructField("sequence_number", T.LongType(), True),
    T.StructField("timestamp", T.StringType(), True),
])
