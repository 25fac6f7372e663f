"""Device message ingestion: route, validate, explode, register, append.

A message envelope (body JSON string, device id bytes, partition, offset,
sequence number, enqueue time) is turned into

* readings        (temps messages, one row per sensor entry)
* device_status   (status messages, ten typed columns + the raw object)
* quarantine      (everything rejected, with a reason)

entirely with JVM-side expressions: ``try_parse_json`` + ``schema_of_variant``
give the JSON types the reference checks with ``isinstance``, and a
``temps`` object becomes a map that is exploded.  The same functions run on a
batch DataFrame or inside ``foreachBatch`` of a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempora.functions import timefns

# Fixed values of the reference's validation: field → limit, and the status
# field → column map.
STRING_LIMITS = {"eventCategory": 50, "gitVersion": 64, "version": 64, "stableVersion": 64}
INTEGER_FIELDS = ["messageCounter", "numTempSensors", "numFlowSensors"]
BOOLEAN_FIELDS = ["isCameraEnabled"]
STATUS_COLUMNS = {
    "eventCategory": "event_category",
    "messageCounter": "message_counter",
    "gitVersion": "git_version",
    "version": "git_current_version",
    "stableVersion": "git_stable_version",
    "numTempSensors": "num_temp_sensors",
    "numFlowSensors": "num_flow_sensors",
    "isCameraEnabled": "is_camera_enabled",
}
DEVICE_ID_LIMIT = 64
SENSOR_SN_LIMIT = 50
UNKNOWN_DEVICE = "unknown"

_INT_TYPES = ["TINYINT", "SMALLINT", "INT", "BIGINT"]
_INT32 = (-(2 ** 31), 2 ** 31 - 1)
_EPOCH_RANGE = (-62135596800, 253402300799)  # years 1 .. 9999


def _sub(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def _type(v: Column, path: str) -> Column:
    """JSON type at ``path``: NULL when absent, 'VOID' for JSON null."""
    return F.schema_of_variant(_sub(v, path))


def device_id(raw: Column) -> Column:
    """Header bytes → UTF-8 text; absent or empty → 'unknown'."""
    return F.coalesce(F.nullif(F.decode(raw, "UTF-8"), F.lit("")), F.lit(UNKNOWN_DEVICE))


def epoch_of(v: Column) -> Column:
    """int(payload.get('unix_time', 0)): integer, truncated number, integer
    text or boolean; NULL when that conversion fails (null, 'abc', '1.5')."""
    return _epoch_from(_type(v, "$.unix_time"), v)


def _epoch_from(t: Column, v: Column) -> Column:
    text = F.trim(F.try_variant_get(v, "$.unix_time", "string"))
    return (F.when(t.isNull(), F.lit(0).cast("bigint"))
            .when(t.isin(*_INT_TYPES), F.try_variant_get(v, "$.unix_time", "bigint"))
            .when(t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT"),
                  F.try_variant_get(v, "$.unix_time", "double").cast("bigint"))
            .when(t == "STRING",
                  F.when(text.rlike(r"^[+-]?[0-9]+$"), text.cast("bigint")))
            .when(t == "BOOLEAN",
                  F.try_variant_get(v, "$.unix_time", "boolean").cast("bigint")))


def parse(envelope: DataFrame, now: Column | None = None) -> DataFrame:
    """Envelope → the routed rows of its messages (see ``routed`` and ``expanded``)."""
    return expanded(routed(envelope, now))


def routed(envelope: DataFrame, now: Column | None = None) -> DataFrame:
    """Envelope → one row per message with route, device, time and the
    parsed body (as a variant).

    Built as a chain of projections, each computing its values once from
    columns of the previous one: the JSON body is parsed once, not once per
    field test, and each projection stays small enough for whole-stage
    code generation.
    """
    # A message without a time gets the time it was enqueued, which a replay
    # of its batch finds again - not the time of the run.
    now = now if now is not None else timefns.instant_to_ntz(
        F.coalesce(F.col("enqueued").cast("timestamp"), F.current_timestamp()))
    s1 = envelope.select("*", F.try_parse_json("body").alias("_v"),
                         device_id(F.col("device_id_raw")).alias("device_id"))
    # Key presence from the parsed value (a key holding JSON null is present:
    # variant null, not SQL NULL); the body is parsed once.
    v = F.col("_v")
    # valid JSON whose first non-blank character is '{' is an object
    s1 = s1.select("*", F.col("body").rlike(r"^\s*\{").alias("_is_obj"),
                   _sub(v, "$.temps").isNotNull().alias("_has_temps"),
                   _sub(v, "$.status").isNotNull().alias("_has_status"))
    s2 = s1.select("*", _type(F.col("_v"), "$.unix_time").alias("_ut_t"))
    s3 = s2.select("*", _epoch_from(F.col("_ut_t"), F.col("_v")).alias("_epoch"))
    epoch = F.col("_epoch")
    time = (F.when(epoch == 0, now)
            .when(epoch.between(*_EPOCH_RANGE), timefns.from_epoch_seconds(epoch)))
    s4 = s3.select("*", time.alias("time"))
    route = (F.when(F.col("_v").isNull() | ~F.col("_is_obj"), F.lit("invalid_json"))
             .when(F.col("time").isNull(), F.lit("bad_time"))
             .when(F.col("_has_temps"), F.lit("temps"))
             .when(F.col("_has_status"), F.lit("status"))
             .otherwise(F.lit("unknown_format")))
    return s4.select("*", route.alias("route")).drop(
        "_ut_t", "_epoch", "_is_obj", "_has_temps", "_has_status")


def expanded(parsed: DataFrame) -> DataFrame:
    """Routed messages with their status checked, as the rows that the outputs are made of."""
    return _by_kind(_with_status_checks(parsed))


def _by_kind(parsed: DataFrame) -> DataFrame:
    """Expand each message into its routed rows with ``inline``: one row per
    sensor entry of a temps message, else one row whose ``kind`` is the
    route; a status row carries the status object as ``payload``.
    Downstream filters reference these generated columns, so they stay
    above the generator and the message is parsed once however many
    outputs use it."""
    v = F.col("_v")
    temps = F.try_variant_get(v, "$.temps", "map<string,string>")
    with_map = parsed.select("*", temps.alias("_temps"))
    no_text = F.lit(None).cast("string")
    no_payload = F.lit(None).cast("variant")

    def row(kind, sn=no_text, value=no_text, payload=no_payload):
        return F.struct(kind.alias("kind"), sn.alias("sensor_sn"), value.alias("raw_value"),
                        payload.alias("payload"))

    entries = F.transform(F.map_entries("_temps"),
                          lambda e: row(F.lit("temps"), e["key"], e["value"]))
    route = F.col("route")
    rows = (F.when((route == "temps") & (F.size("_temps") > 0), entries)
            .when(route == "temps", F.array(row(F.lit("empty_temps"))))
            .when(route == "status",
                  F.array(row(F.coalesce(F.col("_status_reason"), route),
                              payload=F.try_variant_get(v, "$.status", "variant"))))
            .otherwise(F.array(row(route))))
    keep = [c for c in with_map.columns if c not in ("_temps", "_status_reason")]
    return with_map.select(*keep, F.inline(rows))


# -- temps -------------------------------------------------------------------

def temps_entries(parsed: DataFrame) -> DataFrame:
    """Sensor entries of temps messages (one row per serial)."""
    return parsed.filter(F.col("kind") == "temps")


def _entry_reason() -> Column:
    return (F.when(F.length("device_id") > DEVICE_ID_LIMIT, F.lit("too_long:device_id"))
            .when(F.length("sensor_sn") > SENSOR_SN_LIMIT, F.lit("too_long:sensor_sn"))
            .when(_number(F.col("raw_value")).isNull(), F.lit("bad_temperature")))


def _number(text: Column) -> Column:
    """Text as a number: decimal digits with point and exponent, inf or nan -
    not Java's suffixes and hexadecimal forms that a bare cast takes."""
    plain = text.rlike(r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?|nan)\s*$")
    return F.when(plain, F.trim(text).try_cast("double"))


def readings(parsed: DataFrame) -> DataFrame:
    """Accepted sensor entries: time, device_id, sensor_sn, temperature."""
    e = temps_entries(parsed).withColumn("_reason", _entry_reason())
    return (e.filter(F.col("_reason").isNull())
            .select("time", "device_id", "sensor_sn",
                    _number(F.col("raw_value")).alias("temperature"),
                    "partition", "seq"))


# -- status ------------------------------------------------------------------

def _present(t: Column) -> Column:
    return t.isNotNull() & (t != "VOID")


def _with_status_checks(parsed: DataFrame) -> DataFrame:
    """Add ``_status_reason`` (NULL = accepted) for status messages.

    Computed per message below the routing generator, in staged
    projections: the JSON type of every checked field is one column, the
    reason a CASE over those columns - so each field is inspected once.
    """
    is_status = F.col("route") == "status"
    v = F.col("_v")
    fields = list(STRING_LIMITS) + INTEGER_FIELDS + BOOLEAN_FIELDS
    typed = parsed.select(
        "*", F.when(is_status, _type(v, "$.status")).alias("_st_t"),
        *[F.when(is_status, _type(v, f"$.status.{f}")).alias(f"_t_{f}") for f in fields])
    sized = typed.select(
        "*",
        *[F.when(is_status, F.length(F.try_variant_get(v, f"$.status.{f}", "string")))
          .alias(f"_len_{f}") for f in STRING_LIMITS],
        *[F.when(is_status, F.try_variant_get(v, f"$.status.{f}", "bigint")).alias(f"_int_{f}")
          for f in INTEGER_FIELDS])
    st = F.col("_st_t")
    empty = st.isNull() | ~st.startswith("OBJECT") | (st == "OBJECT<>")
    reason = F.when(empty, F.lit("empty_status")).when(
        F.length("device_id") > DEVICE_ID_LIMIT, F.lit("too_long:device_id"))
    for f, limit in STRING_LIMITS.items():
        ft = F.col(f"_t_{f}")
        reason = reason.when(_present(ft) & (ft != "STRING"), F.lit(f"bad_type:{f}")).when(
            _present(ft) & (F.col(f"_len_{f}") > limit), F.lit(f"too_long:{f}"))
    for f in INTEGER_FIELDS:
        ft = F.col(f"_t_{f}")
        reason = reason.when(_present(ft) & ~ft.isin(*_INT_TYPES), F.lit(f"bad_type:{f}")).when(
            _present(ft) & ~F.col(f"_int_{f}").between(*_INT32), F.lit(f"out_of_range:{f}"))
    for f in BOOLEAN_FIELDS:
        ft = F.col(f"_t_{f}")
        reason = reason.when(_present(ft) & (ft != "BOOLEAN"), F.lit(f"bad_type:{f}"))
    helper = [c for c in sized.columns if c.startswith(("_t_", "_len_", "_int_"))] + ["_st_t"]
    return sized.select("*", F.when(is_status, reason).alias("_status_reason")).drop(*helper)


def device_status(parsed: DataFrame) -> DataFrame:
    """Accepted status messages in the device_status column order."""
    s = parsed.filter(F.col("kind") == "status")
    v = F.col("payload")
    cols = [F.col("time"), F.col("device_id")]
    for f, c in STATUS_COLUMNS.items():
        if f in STRING_LIMITS:
            typ = "string"
        elif f in INTEGER_FIELDS:
            typ = "int"
        else:
            typ = "boolean"
        cols.append(F.try_variant_get(v, f"$.{f}", typ).alias(c))
    # The whole object, unknown keys included, as the original JSON text.
    cols.append(F.get_json_object("body", "$.status").alias("status_data"))
    return s.select(*cols)


# -- quarantine ----------------------------------------------------------------

def quarantine(parsed: DataFrame) -> DataFrame:
    """Every rejected message or sensor entry, with its reason - one pass
    over the routed rows: a temps entry carries its entry-level reason, a
    rejected message its route/validation reason as ``kind``."""
    kind = F.col("kind")
    reason = (F.when(kind == "temps", _entry_reason())
              .when(kind != "status", kind))
    return (parsed.select("partition", "offset", "seq", "device_id", reason.alias("reason"),
                          "sensor_sn", "body")
            .filter(F.col("reason").isNotNull()))


# -- progress (W8, S6) -----------------------------------------------------------

def progress(envelope: DataFrame) -> DataFrame:
    """Last (offset, sequence number, enqueue time) per partition."""
    last = F.max_by(F.struct("offset", "seq", "enqueued"), F.col("seq"))
    g = envelope.groupBy("partition").agg(last.alias("_l"))
    return g.select("partition", F.col("_l.offset").alias("offset"),
                    F.col("_l.seq").alias("sequence_number"),
                    F.date_format(_utc_wall_clock(F.col("_l.enqueued")),
                                  "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"))


def _utc_wall_clock(ts: Column) -> Column:
    """An instant (TIMESTAMP) as UTC wall-clock time, whatever the session
    time zone."""
    return timefns.instant_to_ntz(ts)


def partition_properties(envelope: DataFrame) -> DataFrame:
    """Per partition, first and last sequence number and message count."""
    return envelope.groupBy("partition").agg(
        F.min("seq").alias("beginning_sequence_number"),
        F.max("seq").alias("last_enqueued_sequence_number"),
        F.count(F.lit(1)).alias("messages"))
