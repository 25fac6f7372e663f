from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tempora.operators import dims, layout
from tempora.schemas import SENSORS


def _sightings(spark, rows):
    df = spark.createDataFrame(rows, "sensor_sn string, device_id string, time string, seq long")
    return df.withColumn("time", F.col("time").cast("timestamp_ntz"))


def test_known_sensor_keeps_id_and_device_new_sensor_gets_next_id(spark):
    dim = spark.createDataFrame(
        [(1, "28-44815f1e64ff", "device-001", "temperature", "unknown"),
         (9, "28-0000000000", "device-001", "temperature", "unknown")], SENSORS)
    seen = _sightings(spark, [("28-44815f1e64ff", "device-777", "2024-01-01 00:00:00", 1),
                              ("28-new-sensor", "device-002", "2024-01-01 00:00:01", 2),
                              ("28-new-sensor", "device-003", "2024-01-01 00:00:02", 3)])
    out = {r["sensor_sn"]: (r["id"], r["device_id"]) for r in dims.register_sensors(dim, seen).collect()}
    assert out == {"28-44815f1e64ff": (1, "device-001"),     # cached: first device wins
                   "28-0000000000": (9, "device-001"),
                   "28-new-sensor": (10, "device-002")}       # next id, first sighting's device


def test_dense_ids_over_many_partitions(spark):
    df = spark.range(0, 5000).select(F.format_string("sn-%05d", "id").alias("k"),
                                     (F.lit(5000) - F.col("id")).alias("t"))
    out = dims.with_dense_ids(df, ["t", "k"], 100, partitions=7)
    rows = out.select("id", "t").collect()
    ids = sorted(r["id"] for r in rows)
    assert ids == list(range(101, 5101))
    # ordered by t: smallest t gets the smallest id
    assert {r["t"]: r["id"] for r in rows}[1] == 101


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_many_new_serials_get_distinct_dense_ids(spark, workdir, reuse):
    n = 300_000
    empty = spark.createDataFrame([], SENSORS)
    seen = spark.range(n).select(
        F.format_string("sn-%07d", "id").alias("sensor_sn"),
        F.format_string("device-%03d", F.col("id") % 500).alias("device_id"),
        F.timestamp_seconds(1_700_000_000 + F.col("id") % 9999).cast("timestamp_ntz").alias("time"),
        F.col("id").alias("seq"))
    before = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        dims.register_sensors(empty, seen).write.parquet(f"{workdir}/sensors")
    finally:
        spark.conf.set("spark.sql.exchange.reuse", before)
    got = spark.read.parquet(f"{workdir}/sensors").agg(
        F.count("*"), F.countDistinct("id"), F.min("id"), F.max("id"), F.countDistinct("device_id")).first()
    assert tuple(got) == (n, n, 1, n, 500)


def test_first_registration_into_empty_dimension(spark):
    empty = spark.createDataFrame([], SENSORS)
    seen = _sightings(spark, [("b", "d1", "2024-01-01 00:00:05", 7), ("a", "d2", "2024-01-01 00:00:05", 7),
                              ("c", "d3", "2024-01-01 00:00:01", 9)])
    out = sorted((r["id"], r["sensor_sn"]) for r in dims.register_sensors(empty, seen).collect())
    assert out == [(1, "c"), (2, "a"), (3, "b")]


def test_orphans(spark):
    fact = spark.createDataFrame([(1,), (2,), (3,)], "sensor_id int")
    dim = spark.createDataFrame([(1,), (3,)], "id int")
    assert [r[0] for r in dims.orphans(fact, dim, "sensor_id", "id").collect()] == [2]


def test_chunked_table_pruning_and_compaction(spark, workdir):
    rows = [(datetime(2024, 1, d, h), d % 3, float(d * 100 + h)) for d in range(1, 29) for h in (0, 12)]
    df = spark.createDataFrame(rows, "time timestamp_ntz, sensor_id int, temperature double")
    path = f"{workdir}/ht"
    layout.write_chunked(df, path, "time", "sensor_id")
    layout.write_chunked(df.limit(3), path, "time", "sensor_id")  # a second append
    part = layout.read_chunked(spark, path, "time", lo=datetime(2024, 1, 22))
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(chunk" in plan
    assert part.count() == 14
    chunks = layout.compact(spark, path, "time", "sensor_id", datetime(2024, 1, 29), "2 days")
    assert len(chunks) >= 3
    assert spark.read.parquet(path).count() == len(rows) + 3
    # nothing to do the second time; a late append makes its chunk dirty again
    assert layout.compact(spark, path, "time", "sensor_id", datetime(2024, 1, 29), "2 days") == []
    layout.write_chunked(df.filter("time < timestamp'2024-01-02'"), path, "time", "sensor_id")
    again = layout.compact(spark, path, "time", "sensor_id", datetime(2024, 1, 29), "2 days")
    assert again == chunks[:1]
    assert spark.read.parquet(path).count() == len(rows) + 5


def test_daily_chunks_are_pruned_by_their_own_interval(spark, workdir):
    rows = [(datetime(2024, 1, d, 5), d, 1.0) for d in range(1, 29)]
    df = spark.createDataFrame(rows, "time timestamp_ntz, sensor_id int, temperature double")
    layout.write_chunked(df, f"{workdir}/daily", "time", "sensor_id", chunk_interval="1 day")
    assert layout.known_interval(spark, f"{workdir}/daily") == 86400
    got = layout.read_chunked(spark, f"{workdir}/daily", "time", datetime(2024, 1, 9), datetime(2024, 1, 14))
    assert got.count() == 5
    with pytest.raises(ValueError):
        layout.write_chunked(df, f"{workdir}/daily", "time", "sensor_id", chunk_interval="7 days")
    # a table that doesn't tell its interval is read by time alone
    df.withColumn("chunk", F.to_date("time")).write.partitionBy("chunk").parquet(f"{workdir}/plain")
    got = layout.read_chunked(spark, f"{workdir}/plain", "time", datetime(2024, 1, 9), datetime(2024, 1, 14))
    assert got.count() == 5


def test_tables_with_batches_below_chunks_are_not_compacted_in_place(spark, workdir):
    df = spark.createDataFrame([(datetime(2024, 1, 1), 1, 1.0)],
                               "time timestamp_ntz, sensor_id int, temperature double")
    (df.withColumn("chunk", F.to_date("time")).withColumn("batch_id", F.lit(0))
     .write.partitionBy("chunk", "batch_id").parquet(f"{workdir}/sensor_data"))
    with pytest.raises(ValueError, match="below its chunks"):
        layout.compact_table(spark, "sensor_data", f"{workdir}/sensor_data", datetime(2024, 6, 1))
    assert spark.read.parquet(f"{workdir}/sensor_data").count() == 1


def test_compaction_keeps_the_tables_own_interval(spark, workdir):
    """A daily table compacted without naming its interval: same rows, one folder a day."""
    rows = [(datetime(2024, 1, d, h), d % 3, 1.0) for d in range(1, 11) for h in (1, 2)]
    df = spark.createDataFrame(rows, "time timestamp_ntz, sensor_id int, temperature double")
    path = f"{workdir}/sensor_data"
    layout.write_chunked(df, path, "time", "sensor_id", chunk_interval="1 day")
    done = layout.compact_table(spark, "sensor_data", path, datetime(2024, 2, 1))
    assert len(done) == 10 and spark.read.parquet(path).count() == 20
    assert layout.read_chunked(spark, path, "time", datetime(2024, 1, 3), datetime(2024, 1, 5)).count() == 4
    with pytest.raises(ValueError, match="chunked by"):
        layout.compact_table(spark, "sensor_data", path, datetime(2024, 2, 1), "7 days")


def test_tables_of_a_streaming_sink_are_not_compacted_in_place(spark, workdir):
    from tempora.sources import messages
    from tempora.streaming import ticks

    spark.createDataFrame([('{"event": "price", "timestamp": 1600000000, "symbol": "x", "price": 1.0}',)],
                          "value string").write.text(f"{workdir}/in")
    ticks.start(messages.read_ticks(spark, f"{workdir}/in"), f"{workdir}/ticks", f"{workdir}/ck",
                {"availableNow": True}).awaitTermination(120)
    with pytest.raises(ValueError, match="streaming sink"):
        layout.compact_table(spark, "stocks_real_time", f"{workdir}/ticks", datetime(2024, 2, 1))
    assert spark.read.parquet(f"{workdir}/ticks").count() == 1


def test_devices_of_known_sensors(spark):
    dim = spark.createDataFrame([(1, "a", "d1", "temperature", "unknown"), (2, "b", None, "temperature", "hall"),
                                 (3, "c", "d3", "x", "y")], SENSORS)
    seen = _sightings(spark, [("a", "d9", "2024-01-01 00:00:02", 2), ("a", "d1", "2024-01-01 00:00:05", 3),
                              ("b", "d2", "2024-01-01 00:00:00", 1), ("c", "d3", "2024-01-01 00:00:00", 1),
                              ("n", "d4", "2024-01-01 00:00:00", 1)])
    got = sorted(tuple(r) for r in dims.upsert_changes(dim, seen, "update").collect())
    assert got == [(1, "a", "d9", "temperature", "unknown"), (2, "b", "d2", "temperature", "hall"),
                   (4, "n", "d4", "temperature", "unknown")]
    assert [r["sensor_sn"] for r in dims.upsert_changes(dim, seen).collect()] == ["n"]
    with pytest.raises(ValueError):
        dims.upsert_changes(dim, seen, "replace")
