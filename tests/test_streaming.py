"""Structured Streaming runners driven by file sources with availableNow."""

import re
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tempora.plans import cagg
from tempora.schemas import ENVELOPE
from tempora.sources import messages, tables, versioned
from tempora.streaming import ingest, iot
from tempora.streaming import ticks as tick_ingest


def test_iot_ingest_stream_exactly_once(spark, workdir):
    ev = tables.events(spark, SF_SMALL)
    env = messages.iot_envelopes(ev)
    landing = f"{workdir}/landing"
    # two landed files → two micro-batches (maxFilesPerTrigger=1)
    env.filter(F.col("seq") % 2 == 0).coalesce(1).write.parquet(f"{landing}/a")
    env.filter(F.col("seq") % 2 == 1).coalesce(1).write.parquet(f"{landing}/b")
    src = spark.readStream.schema(env.schema).option("maxFilesPerTrigger", 1).option(
        "recursiveFileLookup", "true").parquet(landing)
    tbl = ingest.IngestTables(f"{workdir}/tables")
    ck = f"{workdir}/ck"
    q = ingest.start(spark, src, tbl, ck, trigger={"availableNow": True})
    q.awaitTermination(300)
    assert q.exception() is None

    parsed = iot.parse(env)
    expect_readings = iot.readings(parsed).count()
    assert tbl.read(spark, "sensor_data").count() == expect_readings
    assert tbl.read(spark, "device_status").count() == iot.device_status(parsed).count()
    assert tbl.read(spark, "quarantine").count() == iot.quarantine(parsed).count()
    dim = tbl.sensors(spark)
    assert dim.count() == dim.select("sensor_sn").distinct().count() == dim.select("id").distinct().count()
    assert dim.agg(F.max("id")).first()[0] == dim.count()
    # every reading resolved to a registered sensor
    assert tbl.read(spark, "sensor_data").join(dim, F.col("sensor_id") == F.col("id"),
                                               "left_anti").count() == 0
    prog = {r["partition"]: r["sequence_number"] for r in ingest.latest_progress(spark, tbl).collect()}
    assert prog == {r["partition"]: r["m"] for r in env.groupBy("partition").agg(
        F.max("seq").alias("m")).collect()}

    counters = tbl.read(spark, "ingest_counters")
    assert counters.count() == 2                     # one row per micro-batch
    assert counters.agg(F.sum("messages")).first()[0] == env.count()

    # a restart over the same checkpoint re-delivers nothing
    q2 = ingest.start(spark, src, tbl, ck, trigger={"availableNow": True})
    q2.awaitTermination(300)
    assert tbl.read(spark, "sensor_data").count() == expect_readings

    ingest.delete_progress(spark, tbl, "0")
    assert ingest.get_progress(spark, tbl, "0").count() == 0
    assert ingest.get_progress(spark, tbl, "1").count() == 1


def test_tick_stream_keeps_price_frames(spark, workdir):
    ev = tables.events(spark, SF_SMALL)
    frames = messages.tick_frames(ev)
    frames.select(F.col("frame").alias("value")).write.text(f"{workdir}/frames")
    src = messages.read_ticks(spark, f"{workdir}/frames")
    q = tick_ingest.start(src, f"{workdir}/stocks", f"{workdir}/ck", trigger={"availableNow": True})
    q.awaitTermination(300)
    out = spark.read.parquet(f"{workdir}/stocks")
    assert out.count() == ev.count()
    assert out.filter(F.col("symbol") == "signup").filter(F.col("day_volume").isNotNull()).count() == 0


def test_streaming_cagg_matches_batch_for_closed_windows(spark, workdir):
    rows = tables.stat_readings(spark, SF_SMALL)
    rows.write.parquet(f"{workdir}/raw")
    agg = cagg.define("sensor_temp_1h", f"{workdir}/stream_out")
    src = spark.readStream.schema(rows.schema).parquet(f"{workdir}/raw")
    q = agg.stream(src, f"{workdir}/ck", trigger={"availableNow": True})
    q.awaitTermination(300)
    got = spark.read.parquet(agg.path).drop("bucket_date")
    last = rows.agg(F.max("time")).first()[0]
    closed_before = last - timedelta(days=2)   # watermark = start_offset (2 days)
    batch = agg.compute(rows).drop("bucket_date").filter(
        F.col("bucket_time") + F.expr("INTERVAL 1 HOUR") <= F.lit(closed_before))
    assert got.count() > 0
    key = ["bucket_time", "sensor_id", "reading_count", "min_temperature", "max_temperature"]
    assert sorted(got.select(*key).collect()) == sorted(batch.select(*key).collect())


def test_batch_of_five_and_empty_batch(spark, workdir):
    import json
    from datetime import datetime

    from tempora.schemas import ENVELOPE

    rows = [(json.dumps({"unix_time": 1700000000 + i, "temps": {f"sensor-{i}": 20.0 + i}}),
             f"device-{i}".encode(), "0", 100 + i, 1 + i, datetime(2023, 11, 14)) for i in range(5)]
    tbl = ingest.IngestTables(f"{workdir}/t")
    ingest.process_batch(tbl, spark.createDataFrame([], ENVELOPE), 0)
    assert tbl.store(spark).state().version == -1           # nothing written for an empty batch
    ingest.process_batch(tbl, spark.createDataFrame(rows, ENVELOPE), 1)
    got = sorted((r["sensor_id"], r["temperature"]) for r in tbl.read(spark, "sensor_data").collect())
    assert got == [(i + 1, 20.0 + i) for i in range(5)]
    assert [(r["partition"], r["sequence_number"]) for r in
            ingest.latest_progress(spark, tbl).collect()] == [("0", 5)]
    assert tbl.read(spark, "ingest_counters").first()["messages"] == 5
    # replaying the same batch id replaces its output
    ingest.process_batch(tbl, spark.createDataFrame(rows, ENVELOPE), 1)
    assert tbl.read(spark, "sensor_data").count() == 5


def test_streaming_berlin_days_any_session_zone(spark, workdir):
    """kwh_day_by_day as a stream: local-day windows, closed by the
    watermark, equal the batch buckets - also with a non-UTC session."""
    from datetime import datetime

    rows = [(datetime(2024, 1, d, h, 30), 5, float(d * 100 + h)) for d in range(1, 8)
            for h in (0, 5, 22, 23)]
    df = spark.createDataFrame(rows, "created timestamp_ntz, type_id int, value double")
    df.write.parquet(f"{workdir}/raw")
    old_tz = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        agg = cagg.define("kwh_day_by_day", f"{workdir}/out")
        src = spark.readStream.schema(df.schema).parquet(f"{workdir}/raw")
        q = agg.stream(src, f"{workdir}/ck", trigger={"availableNow": True}, lateness="1 hour")
        q.awaitTermination(300)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old_tz)
    got = {r["time"]: r["value"] for r in spark.read.parquet(agg.path).collect()}
    batch = {r["time"]: r["value"] for r in agg.compute(df).collect()}
    assert got and all(batch[k] == v for k, v in got.items())
    assert min(got) == datetime(2023, 12, 31, 23, 0)   # Berlin midnight of 1 Jan in UTC


def test_streaming_late_rows_follow_the_watermark(spark, workdir):
    """W3 on the stream: a late row within the delay (start_offset 3 h) is
    counted; a row older than the watermark is dropped once the watermark
    used for late rows (the previous batch's) has passed it - Spark's
    guarantee is one-directional, the batch ``refresh`` is the exact form."""
    from datetime import datetime, timedelta

    t0 = datetime(2024, 2, 1)
    schema = "time timestamp_ntz, sensor_id int, temperature double"

    def land(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{workdir}/land/{name}")

    land("a", [(t0 + timedelta(minutes=15 * i), 0, 20.0) for i in range(25)])   # up to t0+6h
    land("b", [(t0 + timedelta(hours=6, minutes=10), 0, 20.0)])                 # on time
    land("c", [(t0 + timedelta(hours=1, minutes=1), 0, 99.0),                   # < watermark t0+3h
               (t0 + timedelta(hours=4, minutes=1), 0, 99.0)])                  # open window
    land("d", [(t0 + timedelta(hours=10), 0, 20.0)])                            # advance watermark
    agg = cagg.define("sensor_temp_10min", f"{workdir}/out")
    src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
           .option("recursiveFileLookup", "true").parquet(f"{workdir}/land"))
    q = agg.stream(src, f"{workdir}/ck", trigger={"availableNow": True})
    q.awaitTermination(300)
    got = {r["bucket_time"]: r["reading_count"] for r in spark.read.parquet(agg.path).collect()}
    assert got[t0 + timedelta(hours=1)] == 1          # the too-late row was dropped
    assert got[t0 + timedelta(hours=4)] == 2          # the late row inside the delay counted


def _batch(spark, serials, seq, device=b"gate"):
    from datetime import datetime

    from tempora.schemas import ENVELOPE

    body = '{"temps": {' + ", ".join(f'"{s}": 1.0' for s in serials) + "}}"
    return spark.createDataFrame(
        [(body, device, "0", seq, seq, datetime(2024, 1, 3, 23, 59, 59))], ENVELOPE)


def test_failed_batch_is_retried_without_duplicates(spark, workdir, monkeypatch):
    """K2 'failed write → batch kept for retry': an attempt that dies after any number of its
    writes leaves nothing that a reader sees in any table; the restarted query runs the batch again."""
    ev = tables.events(spark, SF_SMALL)
    env = messages.iot_envelopes(ev)
    env.coalesce(1).write.parquet(f"{workdir}/landing")
    tbl = ingest.IngestTables(f"{workdir}/tables")
    ck = f"{workdir}/ck"
    src = spark.readStream.schema(env.schema).parquet(f"{workdir}/landing")
    real = versioned.Commit._folder
    for survive in range(6):  # sensors, sensor_data, device_status, quarantine, progress, counters
        done = []

        def dying(self, table):
            if len(done) == survive:
                raise RuntimeError("executor lost")
            done.append(table)
            return real(self, table)

        monkeypatch.setattr(versioned.Commit, "_folder", dying)
        q = ingest.start(spark, src, tbl, ck, trigger={"availableNow": True}, progress_minutes=1e-9)
        try:
            q.awaitTermination(300)
        except Exception:  # noqa: BLE001 - the simulated failure
            pass
        assert q.exception() is not None and len(done) == survive
        monkeypatch.setattr(versioned.Commit, "_folder", real)
        assert tbl.store(spark).state().parts("sensor_data") == []
    q2 = ingest.start(spark, src, tbl, ck, trigger={"availableNow": True})
    q2.awaitTermination(300)
    assert tbl.read(spark, "sensor_data").count() == iot.readings(iot.parse(env)).count()
    assert tbl.read(spark, "device_status").count() == iot.device_status(iot.parse(env)).count()
    assert tbl.store(spark).vacuum(older_than_seconds=0) > 0  # what the attempts left behind
    assert tbl.read(spark, "sensor_data").count() == iot.readings(iot.parse(env)).count()


def test_batches_that_run_again_change_nothing(spark, workdir):
    tbl = ingest.IngestTables(f"{workdir}/tables")
    ingest.process_batch(tbl, _batch(spark, ["a", "b"], 1), 0)
    for _ in range(2):
        ingest.process_batch(tbl, _batch(spark, ["b", "c"], 2), 1)
        assert sorted((r["id"], r["sensor_sn"]) for r in tbl.sensors(spark).collect()) == [
            (1, "a"), (2, "b"), (3, "c")]
        assert sorted(r["sensor_id"] for r in tbl.read(spark, "sensor_data").collect()) == [1, 2, 2, 3]
    # a reader of the first version sees the first batch in every table
    assert tbl.read(spark, "sensor_data", version=0).count() == 2
    assert tbl.read(spark, "sensors", version=0).count() == 2
    assert tbl.read(spark, "ingest_counters", version=0).count() == 1


def test_device_of_a_known_sensor(spark, workdir):
    for how, device in (("keep", "one"), ("update", "two")):
        tbl = ingest.IngestTables(f"{workdir}/{how}")
        ingest.process_batch(tbl, _batch(spark, ["a", "b"], 1, b"one"), 0, how)
        ingest.process_batch(tbl, _batch(spark, ["b", "c"], 2, b"two"), 1, how)
        got = sorted((r["id"], r["sensor_sn"], r["device_id"]) for r in tbl.sensors(spark).collect())
        assert got == [(1, "a", "one"), (2, "b", device), (3, "c", "two")]
        assert sorted(r["sensor_id"] for r in tbl.read(spark, "sensor_data").collect()) == [1, 2, 2, 3]


def test_segments_of_the_dimension_stay_few_and_small_ones_are_not_rewritten_for_ever(spark, workdir):
    tbl = ingest.IngestTables(f"{workdir}/t")
    store = tbl.store(spark)
    ingest.process_batch(tbl, _batch(spark, [f"s{i:03d}" for i in range(400)], 1), 0)
    big = store.state().parts("sensors")
    for n in range(1, 8):
        ingest.process_batch(tbl, _batch(spark, [f"n{n}", "s001"], n + 1), n)
    parts = store.state().parts("sensors")
    assert big[0] in parts and len(parts) <= 4  # 400 rows were written once
    dim = tbl.sensors(spark)
    assert dim.count() == 407 and dim.agg(F.max("id")).first()[0] == 407
    ingest.process_batch(tbl, _batch(spark, ["s002"], 99), 99)  # nothing new: no segment
    assert store.state().parts("sensors") == parts


def test_positions_are_written_when_due_and_at_the_end(spark, workdir):
    now = [0.0]
    tbl = ingest.IngestTables(f"{workdir}/t")
    keeper = ingest.ProgressKeeper(spark, tbl, ingest.progress_interval_seconds("0.5"), clock=lambda: now[0])
    ingest.process_batch(tbl, _batch(spark, ["a"], 1), 0, progress=keeper)
    ingest.process_batch(tbl, _batch(spark, ["b"], 5), 1, progress=keeper)
    assert tbl.store(spark).state().parts("stream_progress") == []  # 30 s aren't over
    now[0] = 31.0
    ingest.process_batch(tbl, _batch(spark, ["c"], 7), 2, progress=keeper)
    assert [r["sequence_number"] for r in ingest.latest_progress(spark, tbl).collect()] == [7]
    ingest.process_batch(tbl, _batch(spark, ["d"], 9), 3, progress=keeper)
    assert [r["sequence_number"] for r in ingest.latest_progress(spark, tbl).collect()] == [7]
    assert keeper.flush() == 1 and keeper.flush() == 0
    assert [r["sequence_number"] for r in ingest.latest_progress(spark, tbl).collect()] == [9]


def test_stop_drains_and_writes_positions(spark, workdir):
    landing = f"{workdir}/landing"
    _batch(spark, ["a"], 1).write.parquet(f"{landing}/0")
    src = (spark.readStream.schema(_batch(spark, ["a"], 1).schema).option("recursiveFileLookup", "true")
           .parquet(landing))
    tbl = ingest.IngestTables(f"{workdir}/t")
    job = ingest.start(spark, src, tbl, f"{workdir}/ck", {"processingTime": "1 second"}, progress_minutes=30)
    job.processAllAvailable()
    for n in range(1, 4):
        _batch(spark, [f"x{n}"], n + 1).write.parquet(f"{landing}/{n}")
    assert tbl.store(spark).state().parts("stream_progress") == []
    job.stop()
    assert not job.isActive
    assert tbl.read(spark, "sensor_data").count() == 4  # what had arrived was taken
    assert [r["sequence_number"] for r in ingest.latest_progress(spark, tbl).collect()] == [4]


def test_many_progress_folders_are_folded(spark, workdir):
    tbl = ingest.IngestTables(f"{workdir}/t")
    for n in range(ingest.PROGRESS_FOLDERS + 3):
        keeper = ingest.ProgressKeeper(spark, tbl, 0)
        keeper.note([{"partition": str(n % 3), "offset": n, "sequence_number": n, "timestamp": "t"}])
        keeper.flush()
    assert len(tbl.store(spark).state().parts("stream_progress")) <= 4
    got = sorted((r["partition"], r["sequence_number"]) for r in ingest.latest_progress(spark, tbl).collect())
    assert got == [("0", 18), ("1", 16), ("2", 17)]


def test_compaction_beside_a_running_ingest(spark, workdir):
    from datetime import datetime

    from tempora.schemas import ENVELOPE

    def day(d, seq):
        return spark.createDataFrame([('{"temps": {"a": 1.0, "b": 2.0}, "unix_time": %d}' % (
            1704067200 + 86400 * d + seq), b"gate", "0", seq, seq, datetime(2024, 1, 1))], ENVELOPE)

    tbl = ingest.IngestTables(f"{workdir}/t")
    for n in range(6):
        ingest.process_batch(tbl, day(n % 2 * 10, n), n)
    store = tbl.store(spark)
    reader = tbl.read(spark, "sensor_data")  # bound to the version at hand
    before = sorted(reader.collect())
    assert len(store.state().parts("sensor_data")) == 6
    chunks = tbl.compact(spark, datetime(2024, 1, 20))
    assert [len(c) for c in chunks.values()] == [2, 0] or chunks == {"sensor_data": chunks["sensor_data"]}
    assert len(store.state().parts("sensor_data")) == 2
    assert sorted(reader.collect()) == sorted(tbl.read(spark, "sensor_data").collect()) == before
    assert tbl.compact(spark, datetime(2024, 1, 20)).get("sensor_data") == []  # nothing to do
    ingest.process_batch(tbl, day(0, 77), 6)  # the stream goes on; its chunk is compacted again
    assert len(tbl.compact(spark, datetime(2024, 1, 20))["sensor_data"]) == 1
    assert tbl.read(spark, "sensor_data").count() == len(before) + 2
    assert store.vacuum(keep_versions=1, older_than_seconds=0) >= 6
    assert tbl.read(spark, "sensor_data").count() == len(before) + 2


def test_compaction_of_a_tick_table_under_its_stream(spark, workdir):
    from tempora.sources.versioned import Store

    frames = messages.tick_frames(tables.events(spark, SF_SMALL))
    land = f"{workdir}/frames"
    parts = frames.select(F.col("frame").alias("value")).randomSplit([0.3, 0.3, 0.4], seed=3)
    store = Store(spark, f"{workdir}/ticks")
    total = tables.events(spark, SF_SMALL).count()
    last = tables.latest_time(tables.events(spark, SF_SMALL), "ts")
    seen = 0
    for i, p in enumerate(parts):
        p.write.mode("append").text(land)
        src = messages.read_ticks(spark, land)
        tick_ingest.start_versioned(src, store, f"{workdir}/ck", {"availableNow": True}).awaitTermination(300)
        before = store.read("stocks_real_time").count()
        assert before > seen
        assert store.compact_table("stocks_real_time", last)
        assert store.read("stocks_real_time").count() == before
        assert store.compact_table("stocks_real_time", last) == []
        seen = before
    assert seen == total
    by_chunk = {}
    for p in store.state().parts("stocks_real_time"):
        by_chunk.setdefault(p.chunk, []).append(p.compacted)
    assert sum(v == [True] for v in by_chunk.values()) >= len(by_chunk) - 1


def test_partitions_start_where_they_are_told(spark, workdir):
    from datetime import datetime

    from tempora.schemas import ENVELOPE

    def land(name, rows):
        spark.createDataFrame([("{}", None, p, n, n, datetime(2024, 1, 1)) for p, n in rows],
                              ENVELOPE).write.parquet(f"{workdir}/in/{name}")

    def seen(positions, ck):
        src = messages.read_from(spark, f"{workdir}/in", positions, ck, max_files_per_trigger=1)
        q = (src.select("partition", "seq").writeStream.format("parquet").option("checkpointLocation", f"{ck}/q")
             .trigger(availableNow=True).start(f"{ck}/out"))
        q.awaitTermination(120)
        return sorted((tuple(r) for r in spark.read.parquet(f"{ck}/out").collect()), key=str)

    land("a", [(p, n) for p in ("0", "1", "2", None) for n in (1, 2, 3)])
    mixed = {"0": 1, "1": "latest"}
    first = {(p, n) for p, n in seen(mixed, f"{workdir}/x")}
    assert first == {("0", 2), ("0", 3)} | {(p, n) for p in ("2", None) for n in (1, 2, 3)}
    assert seen("latest", f"{workdir}/y") == [(None, 1), (None, 2), (None, 3)]  # no partition, no position
    land("b", [("0", 4), ("1", 4), ("9", 1)])
    # a restart keeps what 'latest' was at the first start
    assert {r for r in seen(mixed, f"{workdir}/x")} - first == {("0", 4), ("1", 4), ("9", 1)}
    assert set(seen("latest", f"{workdir}/y")) == {(None, 1), (None, 2), (None, 3), ("0", 4), ("1", 4), ("9", 1)}
    assert len(seen("earliest", f"{workdir}/z")) == 15
    # positions that the ingestion stored are a mapping too
    assert messages.resolve_positions(spark, f"{workdir}/none", {"5": 7, "*": "latest"}, f"{workdir}/n") == {"5": 7}


def test_a_trigger_takes_about_so_many_messages(spark, workdir):
    for n in range(8):
        _batch(spark, [f"s{n}"], n + 1).unionByName(_batch(spark, ["t"], n + 100)).coalesce(1).write.parquet(f"{workdir}/in/{n}")
    assert messages.files_for_rows(spark, f"{workdir}/in", 5) == 2
    assert messages.files_for_rows(spark, f"{workdir}/in", 1) == 1
    assert messages.files_for_rows(spark, f"{workdir}/none", 2) == 1
    src = messages.read_from(spark, f"{workdir}/in", "earliest", f"{workdir}/ck", max_rows_per_trigger=4)
    sizes = []
    src.writeStream.foreachBatch(lambda df, _: sizes.append(df.count())).option(
        "checkpointLocation", f"{workdir}/ck/q").trigger(availableNow=True).start().awaitTermination(120)
    assert sum(sizes) == 16 and len(sizes) >= 4 and max(sizes) <= 4


def test_batch_is_dealt_evenly_and_parsed_by_compiled_methods(spark, capsys):
    """A batch that arrives in one partition, one kind of message after the other, is parsed by all cores, in
    methods that the JVM compiles; nothing but what the tables need is kept."""
    bodies = ['{"unix_time": 1700000000, "temps": {"a%d": 1.5, "b%d": 2}}' % (i, i) for i in range(600)]
    bodies += ['{"unix_time": 1700000000, "status": {"messageCounter": %d}}' % i for i in range(200)] + ["{"] * 100
    env = spark.createDataFrame([(b, bytearray(b"d"), str(n % 3), n * 10, n, datetime(2024, 1, 1))
                                 for n, b in enumerate(bodies)], ENVELOPE).coalesce(1)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parsed, messages, kinds = ingest.counted_parse(env)
        parsed.unpersist()
        capsys.readouterr()
        parsed.select("*").explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000
    assert messages.get == {"messages": 900}
    assert kinds.get == {"sensor_entries": 1200, "status_messages": 200, "rejected": 100}
    parsed, _, _ = ingest.counted_parse(env)
    try:
        assert not {"_v", "route", "device_id_raw"} & set(parsed.columns)
        shares = [r["n"] for r in parsed.select("seq").distinct().join(
            parsed.select("seq", F.spark_partition_id().alias("p")).distinct(), "seq").groupBy("p").agg(
            F.count(F.lit(1)).alias("n")).collect()]
        assert len(shares) >= 2 * spark.sparkContext.defaultParallelism and max(shares) < 2 * 900 / len(shares)
        assert sorted(iot.progress(parsed).collect()) == sorted(iot.progress(env).collect())
    finally:
        parsed.unpersist()
