"""Registered queries on tables that jobs keep: versioned stores, compaction beside streams, policies that
run again and again, mergeable states, dimension upserts, keys kept unique, start positions."""

from __future__ import annotations

from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import functions as F

from tempora.functions import aggs, timefns
from tempora.operators import quality
from tempora.plans import cagg, states
from tempora.plans.catalog import (_DIM, _F7, _FLAT, _MESSAGES, AS_OF, ORACLE, STAT, _berlin_bucket_sql,
                                   _candle_sql, _kwh_hi_sql, _kwh_hour_hi_sql, _kwh_sql, _stats_sql, _STAT_COLS,
                                   as_of, r6, register)
from tempora.session import delete_path, scratch_path
from tempora.sources import messages, tables
from tempora.sources.versioned import Store
from tempora.streaming import ingest, iot
from tempora.streaming import ticks as tick_ingest


@contextmanager
def _land(spark, *name):
    """A fresh landing folder, deleted when the streams that read it are done."""
    path = scratch_path(spark, "live", *name)
    try:
        yield path
    finally:
        delete_path(spark, path)


# ------------------------------------------------ compaction beside streams (K7, K1, K2)

def _halves(spark, sf_dir):
    """Device messages in two deliveries: those of the first half of the sequence numbers, then the rest."""
    env = messages.iot_envelopes(tables.events(spark, sf_dir))
    middle = tables.events(spark, sf_dir).agg(F.max("event_id")).first()[0] // 2
    return env.filter(F.col("seq") < middle), env.filter(F.col("seq") >= middle)


_PART = "CASE WHEN seq < (SELECT max(event_id) // 2 FROM events) THEN 0 ELSE 1 END"
_DIM_PARTS = f"""
SELECT CAST(row_number() OVER (ORDER BY part, time, seq, sensor_sn) AS INTEGER) AS id, sensor_sn, device_id
FROM (SELECT *, row_number() OVER (PARTITION BY sensor_sn ORDER BY part, time, seq, device_id) AS rn
      FROM (SELECT *, {_PART} AS part FROM ({_FLAT}) f) p) x WHERE rn = 1"""


def _ingested_twice(spark, sf_dir, on_conflict="keep", between=None, **options) -> ingest.IngestTables:
    """Both deliveries through the ingestion job, which is restarted for the second."""
    out = ingest.IngestTables(scratch_path(spark, "live", "tables"))
    with _land(spark, "envelopes") as land:
        for i, env in enumerate(_halves(spark, sf_dir)):
            env.write.parquet(f"{land}/in/{i}")
            src = (spark.readStream.schema(env.schema).option("recursiveFileLookup", "true")
                   .parquet(f"{land}/in"))
            ingest.start(spark, src, out, f"{land}/checkpoint", {"availableNow": True}, on_conflict=on_conflict,
                         **options).awaitTermination()
            if between is not None:
                between(out)
    return out


@register("compact_ingest_tables", f"""
SELECT f.time, d.id AS sensor_id, f.temperature
FROM ({_FLAT}) f JOIN ({_DIM_PARTS}) d ON f.sensor_sn = d.sensor_sn""")
def compact_ingest_tables(spark, sf_dir):
    """K7/K2: the ingestion job's fact tables compacted under the reference's policies after each of two
    deliveries, the stream restarted in between; a second compaction finds nothing to do."""
    now = as_of(spark, sf_dir)

    def compact(out):
        out.compact(spark, now)
        again = out.compact(spark, now)
        if any(again.values()):
            raise RuntimeError(f"compacted twice: {again}")

    out = _ingested_twice(spark, sf_dir, between=compact)
    return out.read(spark, "sensor_data").select("time", "sensor_id", "temperature")


@register("compact_tick_table", ORACLE["tick_stream"])
def compact_tick_table(spark, sf_dir):
    """K7/K1: ticks streamed into a versioned table in two deliveries, compacted after each."""
    store = Store(spark, scratch_path(spark, "live", "stocks"))
    frames = messages.tick_frames(tables.events(spark, sf_dir)).select(F.col("frame").alias("value"))
    first = F.xxhash64("value") % 2 == 0
    with _land(spark, "frames") as land:
        for part in (frames.filter(first), frames.filter(~first)):
            part.write.mode("append").text(f"{land}/in")
            tick_ingest.start_versioned(messages.read_ticks(spark, f"{land}/in"), store, f"{land}/checkpoint",
                                        {"availableNow": True}).awaitTermination()
            store.compact_table("stocks_real_time", as_of(spark, sf_dir))
    return store.read("stocks_real_time")


@register("ingest_one_commit", f"""
SELECT (SELECT count(*) FROM ({_FLAT}) f) AS readings,
       (SELECT count(*) FROM ({_FLAT}) f WHERE {_PART} = 0) AS readings_at_first,
       (SELECT count(*) FROM ({_DIM}) d) AS sensors,
       (SELECT count(DISTINCT sensor_sn) FROM ({_FLAT}) f WHERE {_PART} = 0) AS sensors_at_first,
       (SELECT count(*) FROM ({_MESSAGES}) m WHERE {_PART} = 0) AS messages_at_first""")
def ingest_one_commit(spark, sf_dir):
    """A reader of the version that the first delivery made sees that delivery in every table."""
    seen = {}

    def note(out):
        seen.setdefault("version", out.store(spark).state().version)

    out = _ingested_twice(spark, sf_dir, between=note, progress_minutes=30)
    # the job's positions are written after its last batch
    v = seen["version"]
    count = F.count(F.lit(1))
    return (out.read(spark, "sensor_data").agg(count.alias("readings"))
            .crossJoin(out.read(spark, "sensor_data", v).agg(count.alias("readings_at_first")))
            .crossJoin(out.read(spark, "sensors").agg(count.alias("sensors")))
            .crossJoin(out.read(spark, "sensors", v).agg(count.alias("sensors_at_first")))
            .crossJoin(out.read(spark, "ingest_counters", v).agg(F.sum("messages").alias("messages_at_first"))))


@register("segment_history", f"""
SELECT time, temperature FROM (SELECT CAST(ts AS TIMESTAMP) AS time, CAST(user_id % 5 AS INTEGER) AS sensor_id,
                                      value / 25.0 AS temperature FROM events) r
WHERE sensor_id = 1 AND time >= {AS_OF} - INTERVAL 30 DAY""")
def segment_history(spark, sf_dir):
    """One sensor's last month from a table in segment order: chunks are chosen in the log, row groups by the
    segment's minima, maxima and Bloom filters."""
    store = Store(spark, scratch_path(spark, "live", "segments"))
    commit = store.begin()
    commit.add_chunked("stat_readings", tables.stat_readings(spark, sf_dir), "time", "sensor_id")
    commit.commit()
    since = as_of(spark, sf_dir) - timedelta(days=30)
    df = store.read("stat_readings", time_col="time", lo=since)
    return df.filter("sensor_id = 1").select("time", "temperature")


# ------------------------------------------------ dimension upsert, unique keys

@register("sensor_upsert", f"""
SELECT d.id, d.sensor_sn, coalesce(u.device_id, d.device_id) AS device_id
FROM ({_DIM_PARTS}) d LEFT JOIN (
  SELECT sensor_sn, arg_min(device_id, (time, seq, device_id)) AS device_id
  FROM (SELECT * FROM ({_FLAT}) f WHERE {_PART} = 1) l GROUP BY 1) u ON u.sensor_sn = d.sensor_sn""")
def sensor_upsert(spark, sf_dir):
    """Sensors of two deliveries, a known serial taking the device of the second one's first
    sighting (ON CONFLICT DO UPDATE); ids stay."""
    out = _ingested_twice(spark, sf_dir, on_conflict="update")
    return out.sensors(spark).select("id", "sensor_sn", "device_id")


_FIRST = f"""
SELECT *, {_PART} AS part, row_number() OVER (PARTITION BY sensor_sn
  ORDER BY {_PART}, time, seq, device_id) AS rn FROM ({_FLAT}) f"""


@register("unique_on_ingest", f"""
SELECT part, CASE WHEN rn = 1 THEN 'accepted' ELSE 'unique:sensor_sn' END AS outcome, count(*) AS n,
       min(CASE WHEN rn = 1 THEN sensor_sn END) AS lowest
FROM ({_FIRST}) x GROUP BY 1, 2""")
def unique_on_ingest(spark, sf_dir):
    """K9: UNIQUE (sensor_SN) kept while two batches are loaded: the first row of a serial is taken,
    later ones - of the same batch or another - go to the quarantine with their reason."""
    store = Store(spark, scratch_path(spark, "live", "unique"))
    rules = quality.Constraints("sensor_list", not_null=["sensor_sn"], unique=["sensor_sn"])
    load = quality.UniqueIngest(store, rules, order=["time", "seq", "device_id"])
    for n, env in enumerate(_halves(spark, sf_dir)):
        rows = iot.readings(iot.parse(env)).select("sensor_sn", "device_id", "time", "seq").withColumn(
            "part", F.lit(n))
        load.append(rows, n)
    taken = store.read("sensor_list").withColumn("outcome", F.lit("accepted"))
    out = store.read("sensor_list_rejected").withColumnRenamed("reason", "outcome")
    both = taken.unionByName(out.select(taken.columns))
    return both.groupBy("part", "outcome").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(F.col("outcome") == "accepted", F.col("sensor_sn"))).alias("lowest"))


# ------------------------------------------------ policies that run again and again

@register("cagg_policy_runs", f"""
SELECT 'kwh_day_by_day' AS aggregate, time, value FROM ({_kwh_sql('day')}) d WHERE time < ({_kwh_hi_sql()})
UNION ALL
SELECT 'kwh_hour_by_hour', time, value FROM ({_kwh_sql('hour')}) h WHERE time < ({_kwh_hour_hi_sql()})""")
def cagg_policy_runs(spark, sf_dir):
    """Both unbounded policies run three times, each time told only the rows that are new; buckets that
    weren't closed at one run are covered by a later one, late rows wherever they fall."""
    ev = tables.events(spark, sf_dir)
    t = as_of(spark, sf_dir)
    late = tables.late_arrival(ev)
    # a third of a bucket's rows come with each run: cuts inside the hour and the day
    cuts = [t - timedelta(days=9, minutes=35), t - timedelta(days=2, hours=5, minutes=20), t]
    out = None
    for name in ("kwh_day_by_day", "kwh_hour_by_hour"):
        agg = cagg.define(name, scratch_path(spark, "live", name))
        before = None
        for n, cut in enumerate(cuts):
            upto = F.col("ts") <= timefns.ntz_literal(cut)
            seen = upto if n == len(cuts) - 1 else upto & ~late  # late rows arrive before the last run
            raw = tables.metrics_of_type_of(ev.filter(seen), 5)
            if before is None:
                agg.create(tables.metrics_of_type_of(ev.filter(F.lit(False)), 5))
                new = raw
            else:
                new = tables.metrics_of_type_of(ev.filter(seen & ~before), 5)
            agg.run_policy(raw, new, cut, batch=n)
            before = seen
        part = agg.read(spark).select(F.lit(name).alias("aggregate"), "time", "value")
        out = part if out is None else out.unionByName(part)
    return out


# ------------------------------------------------ mergeable states

def _absorbed(spark, sf_dir, name, mapper) -> states.StateAggregate:
    """Three batches that interleave in time, so every later one is late everywhere."""
    agg = states.define(name, scratch_path(spark, "live", "states"), spark)
    ev = tables.events(spark, sf_dir)
    for n in range(3):
        agg.absorb(mapper(ev.filter(F.col("event_id") % 3 == n)), "load", n)
    agg.absorb(mapper(ev.filter(F.col("event_id") % 3 == 2)), "load", 2)  # again: changes nothing
    return agg


@register("states_temp_10min", _stats_sql("10 minutes"))
def states_temp_10min(spark, sf_dir):
    """Count, mean and deviation merged from the states of three batches."""
    df = _absorbed(spark, sf_dir, "sensor_temp_10min", tables.stat_readings_of).read()
    return r6(df.select(*_STAT_COLS.split(", ")), "avg_temperature", "stddev_temperature")


@register("states_candle_1h", _candle_sql("1 hour"))
def states_candle_1h(spark, sf_dir):
    """A2/A3/A5: candles merged from states that keep the first and last price with their order."""
    df = _absorbed(spark, sf_dir, "one_hour_candle", tables.stocks_of).read()
    return df.select("bucket", "symbol", "open", "high", "low", "close", "day_volume")


@register("states_kwh_day", f"SELECT * FROM ({_kwh_sql('day')}) d WHERE time < ({_kwh_hi_sql()})")
def states_kwh_day(spark, sf_dir):
    """Counter deltas of Berlin days merged from states, of the days that the policy has closed."""
    agg = _absorbed(spark, sf_dir, "kwh_day_by_day", lambda ev: tables.metrics_of_type_of(ev, 5))
    return agg.read(as_of=as_of(spark, sf_dir)).select("time", "value")


@register("states_stream_30min", _stats_sql("30 minutes"))
def states_stream_30min(spark, sf_dir):
    """A stream without a watermark absorbed file by file: no row is too late for a state."""
    rows = tables.stat_readings(spark, sf_dir)
    agg = states.define("sensor_temp_30min", scratch_path(spark, "live", "states"), spark)
    with _land(spark, "readings") as land:
        rows.repartition(3).write.parquet(f"{land}/in")
        src = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{land}/in")
        agg.stream(src, f"{land}/checkpoint", trigger={"availableNow": True}).awaitTermination()
    return r6(agg.read().select(*_STAT_COLS.split(", ")), "avg_temperature", "stddev_temperature")


def _rank_check(rows, medians, keys, value, error):
    """Whether each median's rank lies within ``error`` of the middle of its group."""
    ranks = rows.filter(F.col(value).isNotNull()).join(medians, keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("items"),
        F.sum((F.col(value) < F.col("median")).cast("long")).alias("below"),
        F.sum((F.col(value) <= F.col("median")).cast("long")).alias("upto"))
    slack, middle = F.col("items") * error + 1, F.col("items") / 2
    return ranks.select(*keys, "items", ((F.col("below") <= middle + slack)
                                         & (F.col("upto") >= middle - slack)).alias("within"))


@register("states_median_rank", f"""
SELECT time_bucket(INTERVAL '1 day', time) AS bucket_time, sensor_id, count(*) AS items, true AS within
FROM ({STAT}) r WHERE temperature IS NOT NULL GROUP BY 1, 2""")
def states_median_rank(spark, sf_dir):
    """A10: medians per day and sensor from quantile sketches merged over three batches; their rank is
    within the sketch's stated error (1.7 % of the readings)."""
    spec = cagg.sensor_temp("sensor_temp_1h", "1 day", scratch_path(spark, "live", "median"))
    agg = states.StateAggregate(spec, [states.median("median", "temperature")],
                                Store(spark, scratch_path(spark, "live", "states")))
    ev = tables.events(spark, sf_dir)
    for n in range(3):
        agg.absorb(tables.stat_readings_of(ev.filter(F.col("event_id") % 3 == n)), "load", n)
    rows = tables.stat_readings(spark, sf_dir).withColumn("bucket_time", timefns.time_bucket("time", "1 day"))
    return _rank_check(rows, agg.read(), ["bucket_time", "sensor_id"], "temperature", 0.017)


_HOURLY = f"""
SELECT strftime(time, '%a') AS day, value FROM (
  SELECT time_bucket(INTERVAL '1 hour', ts) AS time, value FROM events WHERE event_type = 'view') h WHERE {_F7}"""


def _weekday_values(spark, sf_dir):
    """Readings of the energy meter with the weekday of their hour, over the profile's year."""
    m = tables.metrics_of_type_of(tables.events(spark, sf_dir), 5)
    hour = timefns.time_bucket("created", "1 hour")
    local = timefns.at_time_zone(hour, "Europe/Berlin")
    keep = local > timefns.month_start(hour) - F.expr("INTERVAL 1 YEAR")
    return m.filter(keep).select(timefns.weekday_abbrev(hour).alias("day"), "value")


@register("kwh_weekday_median_rank", f"SELECT day, count(*) AS items, true AS within FROM ({_HOURLY}) h GROUP BY 1")
def kwh_weekday_median_rank(spark, sf_dir):
    """A10 on large groups: the sketch's median of every weekday's meter readings lies within its rank error."""
    rows = _weekday_values(spark, sf_dir)
    sketch = rows.groupBy("day").agg(aggs.kll_sketch("value").alias("s"))
    return _rank_check(rows, sketch.select("day", aggs.kll_median("s").alias("median")), ["day"], "value", 0.017)


@register("kwh_hour_profile_rank", ORACLE["kwh_weekday_median_rank"])
def kwh_hour_profile_rank(spark, sf_dir):
    """A10 on large groups: percentile_approx with accuracy 200 lies within its rank error (1/200)."""
    rows = _weekday_values(spark, sf_dir)
    median = rows.groupBy("day").agg(aggs.median_approx("value", 200).alias("median"))
    return _rank_check(rows, median, ["day"], "value", 1 / 200)


# ------------------------------------------------ start positions, rejects, records

@register("start_positions_by_partition", f"""
SELECT CAST(user_id % 4 AS VARCHAR) AS partition, seq AS sequence_number FROM ({_MESSAGES}) m
WHERE user_id % 4 = 1 OR user_id % 4 = 0 AND seq > (SELECT max(event_id) // 3 FROM events)
   OR user_id % 4 = 3 AND seq > 500 OR user_id % 4 = 2 AND {_PART} = 1""")
def start_positions_by_partition(spark, sf_dir):
    """A stream whose partitions start at a third of the numbers (0), at the earliest (1), at the latest
    landed message (2) and after number 500 (3); restarted for a second delivery, it keeps them."""
    last = tables.events(spark, sf_dir).agg(F.max("event_id")).first()[0]
    store = Store(spark, scratch_path(spark, "live", "positions"))

    def write(batch, n):
        commit = store.begin()
        commit.add("seen", batch.select("partition", F.col("seq").alias("sequence_number")))
        commit.commit("positions", n)

    with _land(spark, "envelopes") as land:
        for i, env in enumerate(_halves(spark, sf_dir)):
            env.write.parquet(f"{land}/in/{i}")
            src = messages.read_from(spark, f"{land}/in", {"0": last // 3, "2": "latest", "3": 500},
                                     f"{land}/checkpoint")
            (src.writeStream.foreachBatch(write).option("checkpointLocation", f"{land}/checkpoint/query")
             .trigger(availableNow=True).start().awaitTermination())
    return store.read("seen")


def _defects() -> list[tuple[str, str, str]]:
    """(reason, message body, device) of every way a message or an entry is rejected."""
    def status(field, value):
        return '{"unix_time": 1700000000, "status": {"%s": %s}}' % (field, value)

    out = [("empty_temps", '{"unix_time": 1700000000, "temps": {}}', "d"),
           ("empty_status", '{"unix_time": 1700000000, "status": {}}', "d"),
           ("bad_time", '{"unix_time": "noon", "temps": {"s": 1.5}}', "d"),
           ("invalid_json", "{", "d"), ("unknown_format", '{"unix_time": 1700000000}', "d"),
           ("bad_temperature", '{"temps": {"s": "warm"}}', "d"),
           ("too_long:sensor_sn", '{"temps": {"%s": 1.5}}' % ("s" * 51), "d"),
           ("too_long:device_id", status("messageCounter", 1), "d" * 65)]
    for f, limit in iot.STRING_LIMITS.items():
        out += [(f"bad_type:{f}", status(f, 7), "d"), (f"too_long:{f}", status(f, '"%s"' % ("x" * (limit + 1))), "d")]
    for f in iot.INTEGER_FIELDS:
        out += [(f"bad_type:{f}", status(f, '"7"'), "d"), (f"out_of_range:{f}", status(f, 2 ** 31), "d")]
    return out + [(f"bad_type:{f}", status(f, 1), "d") for f in iot.BOOLEAN_FIELDS]


_REASONS = ", ".join(f"({i}, '{r}')" for i, (r, _, _) in enumerate(_defects()))


@register("reject_reasons", f"""
SELECT reason, count(*) AS n, min(event_id) AS first_seq
FROM events JOIN (VALUES {_REASONS}) v(i, reason) ON event_id % {len(_defects())} = i GROUP BY 1""")
def reject_reasons(spark, sf_dir):
    """Every event sends a message with one of all defects; each is rejected for its own reason."""
    kinds = _defects()
    ev = tables.events(spark, sf_dir)
    pick = F.col("event_id") % len(kinds)
    body = device = None
    for i, (_, b, d) in enumerate(kinds):
        body = F.when(pick == i, b) if body is None else body.when(pick == i, b)
        device = F.when(pick == i, d) if device is None else device.when(pick == i, d)
    env = ev.select(body.alias("body"), F.encode(device, "UTF-8").alias("device_id_raw"), F.lit("0").alias("partition"),
                    (F.col("event_id") * 10).alias("offset"), F.col("event_id").alias("seq"),
                    timefns.ntz_to_instant("ts").alias("enqueued"))
    return iot.quarantine(iot.parse(env)).groupBy("reason").agg(
        F.count(F.lit(1)).alias("n"), F.min("seq").alias("first_seq"))


@register("message_time_fallback", """
SELECT CASE WHEN event_id % 3 = 0 THEN ts ELSE CAST(date_trunc('second', ts) AS TIMESTAMP) END AS time,
       'dev-' || user_id AS device_id, 'sn-' || event_id AS sensor_sn, value AS temperature
FROM events WHERE value IS NOT NULL""")
def message_time_fallback(spark, sf_dir):
    """A message without a time (or with 0) has that of its enqueuing; one that holds both
    temps and status counts as temps."""
    ev = tables.events(spark, sf_dir).filter("value IS NOT NULL")
    sent = timefns.epoch_seconds("ts").cast("string")
    when = F.when(F.col("event_id") % 6 == 0, F.lit("")).when(
        F.col("event_id") % 3 == 0, F.lit('"unix_time": 0, ')).otherwise(F.concat(F.lit('"unix_time": '), sent, F.lit(", ")))
    both = F.when(F.col("event_id") % 2 == 1, F.lit(', "status": {"messageCounter": 1}')).otherwise(F.lit(""))
    body = F.concat(F.lit("{"), when, F.lit('"temps": {"sn-'), F.col("event_id").cast("string"), F.lit('": '),
                    F.col("value").cast("string"), F.lit("}"), both, F.lit("}"))
    env = ev.select(body.alias("body"), F.encode(F.concat(F.lit("dev-"), F.col("user_id").cast("string")),
                                                 "UTF-8").alias("device_id_raw"),
                    F.lit("0").alias("partition"), F.col("event_id").alias("offset"), F.col("event_id").alias("seq"),
                    timefns.ntz_to_instant("ts").alias("enqueued"))
    return iot.readings(iot.parse(env)).select("time", "device_id", "sensor_sn", "temperature")


@register("named_progress_records", """
SELECT CAST(event_id AS VARCHAR) AS partition, event_id * 10 AS offset, event_id AS sequence_number,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp
FROM events WHERE event_id % 3 = 0""")
def named_progress_records(spark, sf_dir):
    """Progress kept as named documents; names without the prefix are left out, the rest lose it."""
    ev = tables.events(spark, sf_dir)
    name = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit(ingest.CHECKPOINT_PREFIX), F.col("event_id").cast("string"))
                  ).when(F.col("event_id") % 3 == 1, F.concat(F.lit("other-"), F.col("event_id").cast("string"))
                         ).otherwise(F.concat(F.lit("my-checkpoint-"), F.col("event_id").cast("string")))
    payload = F.to_json(F.struct((F.col("event_id") * 10).alias("offset"), F.col("event_id").alias("sequence_number"),
                                 F.date_format(timefns.as_ntz("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp")))
    return ingest.records_from_named(ev.select(name.alias("name"), payload.alias("payload")))


@register("hour_as_interval", """
SELECT date_trunc('day', ts) + hour(ts) * INTERVAL 1 HOUR AS hour, count(*) AS events
FROM events WHERE ts IS NOT NULL GROUP BY 1""")
def hour_as_interval(spark, sf_dir):
    """extract(HOUR) times an interval of an hour, added to the day."""
    at = (F.date_trunc("day", timefns.as_ntz("ts")) + timefns.hour_interval("ts")).cast("timestamp_ntz")
    return tables.events(spark, sf_dir).filter("ts IS NOT NULL").groupBy(at.alias("hour")).agg(
        F.count(F.lit(1)).alias("events"))


@register("sensors_snapshot", _DIM_PARTS)
def sensors_snapshot(spark, sf_dir):
    """The sensor dimension as a later job loads it, from the segments that two deliveries left."""
    return _ingested_twice(spark, sf_dir).read(spark, "sensors").select("id", "sensor_sn", "device_id")
