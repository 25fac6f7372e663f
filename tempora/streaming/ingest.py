"""The IoT ingestion job on Structured Streaming.

``readStream`` (files, or Kafka where its connector is installed) →
``foreachBatch``: parse once (persisted), then

1. register unseen sensors (a segment of new and changed rows),
2. write readings, device_status and quarantine rows,
3. write the batch's counters and, when they are due, the positions of its partitions.

All tables are those of one versioned store, and a micro-batch is one commit of it, written last: readers see
a batch in all tables or in none, whatever write a crash interrupts, and a micro-batch that runs again after its commit
is recognised by its number; together with Spark's offset log this is exactly once.  Compaction
may run beside the stream.  Recovery position is the checkpoint location (S5).
"""

from __future__ import annotations

import threading
import time
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tempora import schemas
from tempora.operators import dims
from tempora.session import checkpointed
from tempora.sources.versioned import Commit, Conflict, Part, State, Store
from tempora.streaming import iot

#: The writer's name of the job's batches in the store.
WRITER = "ingest"
#: Progress records are folded to one a partition when more folders than this hold them.
PROGRESS_FOLDERS = 16

_COUNTERS = "batch_id long, messages long, sensor_entries long, status_messages long, rejected long"
_PROGRESS = schemas.STREAM_PROGRESS


@dataclass
class IngestTables:
    """sensors, sensor_data, device_status, quarantine, stream_progress, ingest_counters below ``root``."""

    root: str

    def store(self, spark: SparkSession) -> Store:
        return Store(spark, self.root)

    def read(self, spark: SparkSession, name: str, version: int | None = None, lo: datetime | None = None,
             hi: datetime | None = None) -> DataFrame:
        """A table as of a version, by default the newest; ``lo`` and ``hi`` bound the time of a fact table."""
        if name == "sensors":
            return self.sensors(spark, self.store(spark).state(version))
        return self.store(spark).read(name, version, "time", lo, hi)

    def sensors(self, spark: SparkSession, state: State | None = None) -> DataFrame:
        """The sensor dimension: its segments, of each serial the newest row."""
        store = self.store(spark)
        state = state or store.state()
        parts = state.parts("sensors")
        if not parts:
            return spark.createDataFrame([], schemas.SENSORS)
        return dims.latest(store.frame("sensors", parts, state))

    def compact(self, spark: SparkSession, as_of: datetime) -> dict[str, list[str]]:
        """K7 on the fact tables under the reference's policies; the stream may be running."""
        store = self.store(spark)
        return {t: store.compact_table(t, as_of) for t in ("sensor_data", "device_status")
                if t in store.state().intervals}


def folded(parts: list[Part], rows: int) -> list[Part]:
    """The newest segments that a segment of ``rows`` rows is to be merged with: while the one before has at most
    twice the rows so far.  So segments at least double from new to old: there are few, and a row
    is written again only as often as their number."""
    taken = []
    for p in reversed(parts):
        if p.rows is None or p.rows > 2 * rows:
            break
        taken.append(p)
        rows += p.rows
    return taken


def _add_sensors(store: Store, state: State, commit: Commit, changes: DataFrame) -> None:
    """A segment of the dimension's new and changed rows, merged with newer segments of like size."""
    n = changes.count()
    parts = state.parts("sensors")
    rev = state.version + 1
    fresh = changes.withColumn("rev", F.lit(rev).cast("long"))
    old = folded(parts, n)
    if old:
        both = store.frame("sensors", old, state).unionByName(fresh)
        newest = F.max_by(F.struct(*[c for c in both.columns if c != "sensor_sn"]), "rev").alias("r")
        fresh = both.groupBy("sensor_sn").agg(newest).select("r.id", "sensor_sn", "r.device_id", "r.type",
                                                             "r.location", "r.rev")
        commit.remove(old)
    # the number of rows bounds that of a merge from above: enough to choose by
    commit.add("sensors", fresh, n + sum(p.rows for p in old))


# Progress write interval in minutes and its fallback.
DEFAULT_PROGRESS_MINUTES = 30.0


def progress_interval_seconds(minutes) -> float:
    """W8 setting: minutes as text or number, fractions allowed; a missing,
    unparsable or non-positive value falls back to 30 minutes."""
    try:
        m = float(minutes)
    except (TypeError, ValueError):
        m = DEFAULT_PROGRESS_MINUTES
    if not m > 0:
        m = DEFAULT_PROGRESS_MINUTES
    return m * 60.0


class ProgressKeeper:
    """The newest position of each partition, written every ``interval`` seconds and when the job stops.

    Held are one record per partition; what is pending when a job crashes is found again, as the
    checkpoint makes its batches run again or the next records are later ones."""

    def __init__(self, spark: SparkSession, tables: IngestTables, interval: float, clock=time.monotonic):
        self.spark, self.tables, self.interval, self.clock = spark, tables, interval, clock
        self.pending: dict[str, tuple] = {}
        self.last = clock()
        self._lock = threading.RLock()

    def note(self, records: list) -> None:
        with self._lock:
            for r in records:
                have = self.pending.get(r["partition"])
                if have is None or (r["sequence_number"] or 0) >= (have[2] or 0):
                    self.pending[r["partition"]] = (r["partition"], r["offset"], r["sequence_number"], r["timestamp"])

    def due(self) -> bool:
        return self.clock() - self.last >= self.interval

    def take(self) -> list[tuple]:
        """The pending records, no longer pending."""
        with self._lock:
            rows, self.pending, self.last = list(self.pending.values()), {}, self.clock()
        return rows

    def flush(self) -> int:
        """Write what is pending now; the number of records."""
        with self._lock:
            rows = self.take()
            if rows:
                commit = self.tables.store(self.spark).begin()
                _add_progress(self.tables.store(self.spark), commit, rows)
                _commit(commit)
        return len(rows)


def _add_progress(store: Store, commit: Commit, rows: list[tuple]) -> None:
    """Records of the newest positions; folded with the stored ones now and then."""
    df = store.spark.createDataFrame(rows, _PROGRESS).coalesce(1)
    state = store.state()
    parts = state.parts("stream_progress")
    if len(parts) >= PROGRESS_FOLDERS:
        df = _newest(store.frame("stream_progress", parts, state).unionByName(df)).coalesce(1)
        commit.remove(parts)
    commit.add("stream_progress", df)


def _commit(commit: Commit, writer: str | None = None, batch: int | None = None) -> int | None:
    """Publish a batch.  If somebody else has folded a table meanwhile, its folders stay: records and
    segments of earlier revisions count less than later ones, so doing it twice changes no result."""
    while True:
        try:
            return commit.commit(writer, batch)
        except Conflict:
            live = commit.store.state().live
            commit.removed = [p for p in commit.removed if p.folder in live]


def _newest(progress: DataFrame) -> DataFrame:
    last = F.max_by(F.struct("offset", "sequence_number", "timestamp"), F.col("sequence_number"))
    return progress.groupBy("partition").agg(last.alias("l")).select("partition", "l.*")


def dealt(envelope: DataFrame) -> DataFrame:
    """A micro-batch dealt evenly over tasks.  Landed files hold few row groups, and those of one kind of message stand
    together; parsing is most of a batch's work, and what is kept of it is read by every table's write."""
    spark = envelope.sparkSession
    return envelope.repartition(max(2 * spark.sparkContext.defaultParallelism,
                                    int(spark.conf.get("spark.sql.shuffle.partitions"))))


def counted_parse(envelope: DataFrame) -> tuple[DataFrame, Observation, Observation]:
    """Parse a micro-batch with its counters attached.  Spark gathers
    them while the rows flow (observed metrics), in the same pass that fills
    the persisted parse - no extra scan.  Kept are the columns that the tables and the positions need."""
    messages = Observation("messages")
    # Counted between routing and status checks, where a row is a message: there Spark ends one generated method and
    # begins the next.  Both in one are beyond the size that the JVM compiles (8,000 bytes), and run interpreted.
    observed = iot.routed(dealt(envelope)).observe(messages, F.count(F.lit(1)).alias("messages"))
    parsed = iot.expanded(observed).drop("_v", "route", "device_id_raw").persist()
    kinds = Observation("kinds")
    kind = F.col("kind")
    parsed.observe(
        kinds,
        F.sum(F.when(kind == "temps", 1).otherwise(0)).alias("sensor_entries"),
        F.sum(F.when(kind == "status", 1).otherwise(0)).alias("status_messages"),
        F.sum(F.when(~kind.isin("temps", "status"), 1).otherwise(0)).alias("rejected"),
    ).write.format("noop").mode("overwrite").save()
    return parsed, messages, kinds


def process_batch(tables: IngestTables, envelope: DataFrame, batch_id: int, on_conflict: str = "keep",
                  progress: ProgressKeeper | None = None) -> None:
    """One micro-batch as one commit.  ``on_conflict``: what a known sensor's new device does (see
    ``dims.upsert_changes``).  Without ``progress`` the positions are written with every batch."""
    spark = envelope.sparkSession
    store = tables.store(spark)
    state = store.state()
    if state.writers.get(WRITER, -1) >= batch_id:  # a replay of a batch that was committed
        return
    if envelope.isEmpty():  # an empty batch writes nothing and records no progress
        return
    parsed, messages, kinds = counted_parse(envelope)
    commit = store.begin()
    try:
        counters = {**messages.get, **kinds.get}
        commit.add("ingest_counters", spark.createDataFrame(
            [(batch_id, counters["messages"], counters["sensor_entries"] or 0,
              counters["status_messages"] or 0, counters["rejected"] or 0)], _COUNTERS))
        new_readings = iot.readings(parsed)
        current = tables.sensors(spark, state)
        changes = checkpointed(dims.upsert_changes(current, new_readings, on_conflict))
        dim = current
        if not changes.isEmpty():
            _add_sensors(store, state, commit, changes)
            # ids never change: known serials resolve by the old rows, new ones by theirs
            dim = current.unionByName(changes.join(current.select("sensor_sn"), "sensor_sn", "left_anti")
                                      .select(*current.columns))
        resolved = dims.resolve(new_readings, dim)
        commit.add_chunked("sensor_data", resolved.select("time", "sensor_id", "temperature"), "time")
        commit.add_chunked("device_status", iot.device_status(parsed), "time")
        commit.add("quarantine", iot.quarantine(parsed))
        # every message has a row in the parse; one record per partition of the hub
        records = iot.progress(parsed).collect()
        if progress is None:
            _add_progress(store, commit, [tuple(r[c] for c in _PROGRESS.names) for r in records])
        else:
            progress.note(records)
            if progress.due():
                _add_progress(store, commit, progress.take())
        _commit(commit, WRITER, batch_id)
    finally:
        parsed.unpersist()


class _Flush(StreamingQueryListener):
    """Writes pending positions while the stream idles and when it ends."""

    def __init__(self, job: "IngestJob"):
        self.job = job

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        if str(event.id) == self.job.query.id and self.job.progress.due():
            self.job.progress.flush()

    def onQueryTerminated(self, event) -> None:
        if str(event.id) == self.job.query.id:
            self.job.progress.flush()


class IngestJob:
    """A running ingestion: the streaming query, its timed positions, and a stop that loses nothing."""

    def __init__(self, spark: SparkSession, query, progress: ProgressKeeper):
        self.spark, self.query, self.progress = spark, query, progress
        self._listener = _Flush(self)
        spark.streams.addListener(self._listener)

    def __getattr__(self, name: str):
        return getattr(self.query, name)

    def awaitTermination(self, timeout: float | None = None):
        done = self.query.awaitTermination(timeout) if timeout is not None else self.query.awaitTermination()
        if not self.query.isActive:
            self._end()
        return done

    def stop(self, drain: bool = True) -> None:
        """Let the stream take what has arrived (``drain``), end it and write the pending positions."""
        if drain and self.query.isActive:
            self.query.processAllAvailable()
        self.query.stop()
        self._end()

    def _end(self) -> None:
        self.progress.flush()
        if self._listener is not None:
            self.spark.streams.removeListener(self._listener)
            self._listener = None


def start(spark: SparkSession, envelopes: DataFrame, tables: IngestTables, checkpoint: str,
          trigger: dict | None = None, progress_minutes=None, on_conflict: str = "keep") -> IngestJob:
    """Run the ingestion stream; ``trigger`` e.g. {"availableNow": True}; positions are written every
    ``progress_minutes`` (see ``progress_interval_seconds``) and at the end."""
    keeper = ProgressKeeper(spark, tables, progress_interval_seconds(progress_minutes))
    w = (envelopes.writeStream
         .foreachBatch(lambda df, bid: process_batch(tables, df, bid, on_conflict, keeper))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(**(trigger or {"processingTime": "5 seconds"}))
    return IngestJob(spark, w.start(), keeper)


def latest_progress(spark: SparkSession, tables: IngestTables) -> DataFrame:
    """W8 list/get: the newest record per partition, but for those at or before a deletion."""
    store = tables.store(spark)
    state = store.state()
    p = store.frame("stream_progress", state.parts("stream_progress"), state)
    if state.parts("progress_deleted"):
        gone = store.frame("progress_deleted", state.parts("progress_deleted"), state).groupBy("partition").agg(
            F.max("sequence_number").alias("upto"))
        p = p.join(gone, "partition", "left").filter(
            F.col("upto").isNull() | (F.col("sequence_number") > F.col("upto"))).drop("upto")
    return _newest(p)


# -- progress records: list / get / delete (W8, X19) ---------------------------

# Fixed value: the name prefix of a partition's progress record.
CHECKPOINT_PREFIX = "checkpoint-"
_RECORD = "offset long, sequence_number long, timestamp string"


def records_from_named(named: DataFrame, name_col: str = "name",
                       payload_col: str = "payload") -> DataFrame:
    """Progress records kept as named JSON documents (``checkpoint-<id>``):
    names without the prefix are ignored, the rest parsed per partition."""
    rows = named.filter(F.col(name_col).startswith(CHECKPOINT_PREFIX))
    rec = F.from_json(F.col(payload_col), _RECORD)
    return rows.select(
        F.regexp_replace(F.col(name_col), "^" + CHECKPOINT_PREFIX, "").alias("partition"),
        rec.alias("r")).select("partition", "r.*")


def get_progress(spark: SparkSession, tables: IngestTables, partition: str) -> DataFrame:
    return latest_progress(spark, tables).filter(F.col("partition") == partition)


def delete_progress(spark: SparkSession, tables: IngestTables, partition: str) -> None:
    """Drop every record of one partition that is stored so far: a mark that readers go by; the
    records, to which the stream may be adding, stay as they are."""
    mark = (get_progress(spark, tables, partition).filter("sequence_number IS NOT NULL")
            .select("partition", "sequence_number"))
    commit = tables.store(spark).begin()
    commit.add("progress_deleted", mark)
    commit.commit()
