"""Dimension maintenance: get-or-create of sensors by serial number
and referential checks (J4).

The reference looks a serial up in a dict, and on a miss inserts it (type
'temperature', location 'unknown') and caches the id; a cached sensor keeps
the device it was first seen with.  As a set operation per micro-batch:

1. first sighting per serial: ``min_by(device, (time, seq))`` - a partial
   aggregate, so a serial seen a billion times is one buffer per task;
2. serials not yet in the dimension: ``left_anti`` join;
3. ids continue after ``max(id)``, dense, in order of first sighting.

Step 3 is distributed: new keys are range-partitioned on the order, each
partition numbers its rows, and a per-partition offset (one row per
partition - a fixed bound, so it is broadcast) is added.  Nothing passes
through one task or the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempora.session import checkpointed

# Fixed values the reference writes for a new sensor.
NEW_SENSOR_TYPE = "temperature"
NEW_SENSOR_LOCATION = "unknown"
#: Up to so many new keys are numbered by one task; more are dealt by ranges.
ONE_TASK = 20_000


def with_dense_ids(df: DataFrame, order: Sequence[str], start, id_col: str = "id",
                   partitions: int | None = None) -> DataFrame:
    """Number rows start+1, start+2, ... in ``order`` (which must be unique).

    ``start`` is a Column (e.g. a scalar subquery) or an int.
    """
    spark = df.sparkSession
    kept = checkpointed(df)  # read again below: the upstream plan runs once
    start_col = start if not isinstance(start, int) else F.lit(start)
    rows = kept.count()
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if partitions is None and rows <= ONE_TASK:  # a bounded number of keys: one task numbers them
        if not rows:
            return kept.withColumn(id_col, F.lit(0))
        nth = F.row_number().over(Window.orderBy(*order))
        return kept.withColumn(id_col, (start_col + nth).cast("int"))
    # Range bounds are sampled per exchange, and two plans over the same keys
    # may hold two exchanges with different bounds.  So the partition number
    # is materialised with the rows, and counts and row numbers both come
    # from that one table.
    ranged = checkpointed(kept.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id()))
    local = ranged.withColumn(
        "_rn", F.row_number().over(Window.partitionBy("_pid").orderBy(*order)))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    out = local.join(F.broadcast(offsets), "_pid")  # at most n rows
    return out.withColumn(id_col, (start_col + F.col("_off") + F.col("_rn")).cast("int")).drop(
        "_pid", "_rn", "_off")


def first_sightings(sightings: DataFrame, key: str = "sensor_sn", attr: str = "device_id",
                    time_col: str = "time", seq_col: str = "seq") -> DataFrame:
    order = F.struct(F.col(time_col), F.col(seq_col), F.col(attr))
    return sightings.groupBy(key).agg(
        F.min_by(F.col(attr), order).alias(attr),
        F.min(order).alias("_first"))


def new_sensors(dim: DataFrame, sightings: DataFrame) -> DataFrame:
    """Rows to add to the dimension: unseen serials with their new ids.

    ``dim``: (id, sensor_sn, device_id, type, location);
    ``sightings``: (sensor_sn, device_id, time, seq).
    """
    first = first_sightings(sightings)
    new = first.join(dim.select("sensor_sn"), "sensor_sn", "left_anti")
    start = F.coalesce(dim.agg(F.max("id")).scalar(), F.lit(0))
    ordered = new.select("sensor_sn", "device_id", F.col("_first.time").alias("_t"),
                         F.col("_first.seq").alias("_s"))
    numbered = with_dense_ids(ordered, ["_t", "_s", "sensor_sn"], start)
    return numbered.select("id", "sensor_sn", "device_id",
                           F.lit(NEW_SENSOR_TYPE).alias("type"),
                           F.lit(NEW_SENSOR_LOCATION).alias("location"))


def register_sensors(dim: DataFrame, sightings: DataFrame) -> DataFrame:
    """New dimension = existing rows unchanged ∪ unseen serials with new ids."""
    added = new_sensors(dim, sightings)
    return dim.select("id", "sensor_sn", "device_id", "type", "location").unionByName(added)


def changed_devices(dim: DataFrame, sightings: DataFrame) -> DataFrame:
    """Known sensors whose first sighting names another device, with that device: the reference's
    ON CONFLICT (sensor_SN) DO UPDATE SET device_ID.  A sighting without a device changes it to null."""
    first = first_sightings(sightings).select("sensor_sn", F.col("device_id").alias("_device"))
    return (dim.join(first, "sensor_sn").filter(~F.col("device_id").eqNullSafe(F.col("_device")))
            .select("id", "sensor_sn", F.col("_device").alias("device_id"), "type", "location"))


def upsert_changes(dim: DataFrame, sightings: DataFrame, on_conflict: str = "keep") -> DataFrame:
    """The rows that a batch of sightings adds to the dimension or replaces in it, and no others.

    ``on_conflict``: 'keep' leaves known sensors as they are (the reference's cached path), 'update' gives them
    the device of the batch's first sighting (its insert path)."""
    if on_conflict not in ("keep", "update"):
        raise ValueError(on_conflict)
    added = new_sensors(dim, sightings)
    return added if on_conflict == "keep" else added.unionByName(changed_devices(dim, sightings))


def latest(segments: DataFrame) -> DataFrame:
    """The dimension from its segments: of each serial the row of the highest revision."""
    row = F.struct("id", "device_id", "type", "location")
    return (segments.groupBy("sensor_sn").agg(F.max_by(row, "rev").alias("r"))
            .select("r.id", "sensor_sn", "r.device_id", "r.type", "r.location"))


def resolve(readings: DataFrame, dim: DataFrame) -> DataFrame:
    """Attach sensor ids to readings (serial → id).  The dimension is joined
    by key; Spark broadcasts it only when its measured size allows."""
    return readings.join(dim.select(F.col("sensor_sn"), F.col("id").alias("sensor_id")),
                         "sensor_sn", "inner")


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Fact rows whose key has no dimension row (foreign-key check)."""
    return fact.join(dim, fact[fact_key] == dim[dim_key], "left_anti")
