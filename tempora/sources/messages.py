"""Message sources: device-message envelopes and market tick frames.

The reference receives these from a device hub and a websocket.  Here they
come from files or Kafka through Structured Streaming, and - for tests and
the registered queries - are derived from the ``events`` table, so that
their volume grows with it:

* temps messages: ``click``/``purchase``/``view`` events, grouped by
  (event_id div 4, user_id), i.e. at most four sensor entries per message;
  sensor serial ``28-<event_id div 32 in hex>-<event_id % 4>`` (so one serial
  is reported by several devices and the first one wins, and the sensors
  grow with the table), values above 450
  sent as the text "n/a", and every tenth block sends unix_time as text;
* status messages: ``signup`` events; ``messageCounter`` is sent as text
  (a type error) when props.k >= 95;
* junk: ``error`` events; invalid JSON when props.k is even, else an
  object with neither ``temps`` nor ``status``.

Device: ``device-<user_id, 3 digits>``, no header when user_id % 37 = 0;
hub partition: user_id % 4; sequence number: first event_id; offset:
10 x sequence number; enqueue time: first event time.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.functions import timefns
from tempora.schemas import ENVELOPE, TICK_EVENT
from tempora.session import exists, read_text, write_text

TEMPS_TYPES = ["click", "purchase", "view"]


def _k(ev):
    return F.get_json_object(ev["props"], "$.k").cast("int")


def _device(user_id):
    return F.when(user_id % 37 == 0, F.lit(None).cast("binary")).otherwise(
        F.encode(F.format_string("device-%03d", user_id), "UTF-8"))


def iot_envelopes(ev: DataFrame) -> DataFrame:
    """Device-message envelopes derived from ``events`` (see module doc)."""
    temps = ev.filter(F.col("event_type").isin(*TEMPS_TYPES))
    sn = F.format_string("28-%08x-%d", F.floor(F.col("event_id") / 32), F.col("event_id") % 4)
    val = F.when(F.col("value") > 450, F.lit('"n/a"')).otherwise(F.col("value").cast("string"))
    entry = F.format_string('"%s": %s', sn, val)
    blocks = temps.groupBy((F.col("event_id") / 4).cast("bigint").alias("block"), "user_id").agg(
        F.min("ts").alias("ts"), F.min("event_id").alias("seq"),
        F.array_sort(F.collect_list(entry)).alias("entries"))  # <= 4 entries per group
    epoch = timefns.epoch_seconds("ts")
    ut = F.when(F.col("block") % 10 == 0, F.format_string('"%d"', epoch)).otherwise(
        epoch.cast("string"))
    temps_body = F.concat(F.lit('{"unix_time": '), ut, F.lit(', "temps": {'),
                          F.array_join("entries", ", "), F.lit("}}"))
    temps_msgs = blocks.select(temps_body.alias("body"), "user_id", "seq", "ts")

    st = ev.filter(F.col("event_type") == "signup")
    k = _k(st)
    counter = F.when(k >= 95, F.format_string('"%d"', k)).otherwise(k.cast("string"))
    status_body = F.format_string(
        '{"unix_time": %d, "status": {"eventCategory": "%s", "messageCounter": %s, '
        '"gitVersion": "v1.%d", "version": "1.%d", "stableVersion": "1.0", '
        '"numTempSensors": %d, "numFlowSensors": %d, "isCameraEnabled": %s, "cpu_usage": %d}}',
        timefns.epoch_seconds("ts"), F.col("event_type"), counter, k, k, k % 4, k % 2,
        F.when(k % 2 == 0, F.lit("true")).otherwise(F.lit("false")), k)
    status_msgs = st.select(status_body.alias("body"), "user_id",
                            F.col("event_id").alias("seq"), "ts")

    junk = ev.filter(F.col("event_type") == "error")
    kj = _k(junk)
    junk_body = F.when(kj % 2 == 0, F.lit("<not JSON>")).otherwise(
        F.format_string('{"unix_time": %d, "humidity": 40}', timefns.epoch_seconds("ts")))
    junk_msgs = junk.select(junk_body.alias("body"), "user_id", F.col("event_id").alias("seq"),
                            "ts")

    msgs = temps_msgs.unionByName(status_msgs).unionByName(junk_msgs)
    return msgs.select(
        "body", _device(F.col("user_id")).alias("device_id_raw"),
        (F.col("user_id") % 4).cast("string").alias("partition"),
        (F.col("seq") * 10).alias("offset"), "seq",
        timefns.ntz_to_instant("ts").alias("enqueued"))


def tick_frames(ev: DataFrame) -> DataFrame:
    """Websocket frames derived from ``events``: price frames for every
    event, plus a heartbeat control frame for every ``error`` event; the
    day volume is left out of ``signup`` frames (optional field)."""
    vol = F.when(F.col("event_type") == "signup", F.lit(None)).otherwise(
        F.col("event_id").cast("string"))
    price = F.to_json(F.struct(
        F.lit("price").alias("event"), timefns.epoch_seconds("ts").alias("timestamp"),
        F.col("event_type").alias("symbol"), F.col("value").alias("price"),
        vol.cast("decimal(38,10)").alias("day_volume")))
    beat = F.to_json(F.struct(F.lit("heartbeat").alias("event"),
                              timefns.epoch_seconds("ts").alias("timestamp")))
    prices = ev.select(price.alias("frame"))
    beats = ev.filter(F.col("event_type") == "error").select(beat.alias("frame"))
    return prices.unionByName(beats)


# -- stream readers ------------------------------------------------------------

def start_options(ignore_past, has_checkpoint: bool) -> dict:
    """The start-position policy.

    'true' → only new data (latest); 'full' → from the beginning (earliest);
    anything else → resume from the checkpoint if there is one, else
    earliest.  Case-insensitive; an invalid value counts as 'false'.
    For the Kafka source this is ``startingOffsets``; a file source always
    replays unseen files, and resuming is the checkpoint location itself.
    """
    v = str(ignore_past).strip().lower() if ignore_past is not None else "false"
    if v == "true":
        return {"startingOffsets": "latest", "resume": False}
    if v == "full":
        return {"startingOffsets": "earliest", "resume": False}
    return {"startingOffsets": "earliest", "resume": has_checkpoint}


def read_envelopes(spark: SparkSession, path: str, fmt: str = "json",
                   max_files_per_trigger: int | None = None, ignore_past=None,
                   has_checkpoint: bool = False, started_at=None) -> DataFrame:
    """A landed envelope stream (files), declared schema.

    S5 on a file source: 'true' keeps only messages enqueued at or after
    ``started_at``; otherwise every unseen file is read, and resuming is the
    checkpoint location of the query.
    """
    r = spark.readStream.format(fmt).schema(ENVELOPE)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.load(path)
    opts = start_options(ignore_past, has_checkpoint)
    if opts["startingOffsets"] == "latest" and started_at is not None:
        df = df.filter(F.col("enqueued") >= F.lit(started_at))
    return df


def resolve_positions(spark: SparkSession, path: str, positions, checkpoint: str, fmt: str = "parquet") -> dict:
    """S5 by partition: where each partition of a landed stream starts, as sequence numbers to start after.

    ``positions``: 'earliest', 'latest', or a mapping of partition to either of them or to a sequence number,
    with '*' for the partitions it doesn't name (earliest, if it has none).  'latest' is the last number landed
    when the stream starts for the first time; the outcome is kept beside the stream's checkpoint, so a restart
    starts from the same numbers and not from what is latest then."""
    kept = read_text(spark, f"{checkpoint}/_start_positions")
    if kept is not None:
        return json.loads(kept)
    wanted = dict(positions) if isinstance(positions, Mapping) else {"*": positions}
    rest = wanted.pop("*", "earliest")
    out = {p: None if v == "earliest" else v for p, v in wanted.items()}
    if "latest" in [*out.values(), rest]:
        landed = (spark.read.schema(ENVELOPE).format(fmt).option("recursiveFileLookup", "true").load(path)
                  if exists(spark, path) else None)
        ends = {} if landed is None else {  # one row per partition of the hub
            r["partition"]: r["last"] for r in landed.groupBy("partition").agg(F.max("seq").alias("last")).collect()}
        out = {p: ends.get(p) if v == "latest" else v for p, v in out.items()}
        if rest == "latest":
            out = {**ends, **out}
    write_text(spark, f"{checkpoint}/_start_positions", json.dumps(out))
    return out


def from_positions(envelopes: DataFrame, positions: Mapping) -> DataFrame:
    """Messages after the sequence number of their partition; None and partitions not named: all."""
    started = {p: int(n) for p, n in positions.items() if n is not None}
    if not started:
        return envelopes
    partition = F.col("partition")
    later = ~partition.isin(*started) | partition.isNull()
    for p, n in started.items():  # one term per partition of the hub; the scan sees them
        later = later | ((partition == p) & (F.col("seq") > n))
    return envelopes.filter(later)


def files_for_rows(spark: SparkSession, path: str, rows: int, fmt: str = "parquet") -> int:
    """How many landed files hold about ``rows`` messages, by the mean of those that are there (Parquet tells it
    from the files' footers); one at least."""
    if not exists(spark, path):
        return 1
    landed = spark.read.schema(ENVELOPE).format(fmt).option("recursiveFileLookup", "true").load(path)
    files = len(landed.inputFiles())
    return max(1, rows * files // max(1, landed.count())) if files else 1


def read_from(spark: SparkSession, path: str, positions, checkpoint: str, fmt: str = "parquet",
              max_rows_per_trigger: int | None = None, max_files_per_trigger: int | None = None,
              max_bytes_per_trigger: int | None = 1 << 30) -> DataFrame:
    """A landed envelope stream that starts each partition at its own position and takes a
    bounded part of a backlog at a time: by messages (as whole files, see ``files_for_rows``) or files if their
    number is given, else by bytes."""
    resolved = resolve_positions(spark, path, positions, checkpoint, fmt)
    r = spark.readStream.format(fmt).schema(ENVELOPE).option("recursiveFileLookup", "true")
    if max_rows_per_trigger:
        max_files_per_trigger = files_for_rows(spark, path, max_rows_per_trigger, fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    elif max_bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return from_positions(r.load(path), resolved)


def read_envelopes_kafka(spark: SparkSession, servers: str, topic: str, ignore_past=None,
                         has_checkpoint: bool = False,
                         max_offsets_per_trigger: int | None = None) -> DataFrame:
    """S4/S5 on Kafka (needs the spark-sql-kafka connector on the classpath):
    value → body, key → device id bytes, partition/offset/timestamp mapped;
    the start policy becomes ``startingOffsets``."""
    opts = start_options(ignore_past, has_checkpoint)
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", opts["startingOffsets"]))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    k = r.load()
    return k.select(F.col("value").cast("string").alias("body"), F.col("key").alias("device_id_raw"),
                    F.col("partition").cast("string").alias("partition"),
                    F.col("offset").alias("offset"), F.col("offset").alias("seq"),
                    F.col("timestamp").alias("enqueued"))


def read_ticks(spark: SparkSession, path: str, symbols=None) -> DataFrame:
    """S3: the tick stream; subscribing to symbols is a filter."""
    df = spark.readStream.format("json").schema(TICK_EVENT).load(path)
    return df if not symbols else df.filter(F.col("symbol").isin(*symbols))
