"""Message in → rows / quarantine out: routing, validation and lenient times."""

import json
from datetime import datetime

import pytest

from tempora.schemas import ENVELOPE
from tempora.streaming import iot

NOW = datetime(2030, 1, 1)


def env(spark, bodies, device=b"gate-12"):
    rows = []
    for i, b in enumerate(bodies):
        body = b if isinstance(b, str) else json.dumps(b)
        dev = device if not callable(device) else device(i)
        rows.append((body, dev, "0", 100 + i, 1 + i, datetime(2023, 11, 14, 22, 13, 20)))
    return spark.createDataFrame(rows, ENVELOPE)


def parse(spark, bodies, **kw):
    from tempora.functions import timefns

    return iot.parse(env(spark, bodies, **kw), now=timefns.ntz_literal(NOW))


def reasons(spark, bodies, **kw):
    return sorted(r["reason"] for r in iot.quarantine(parse(spark, bodies, **kw)).collect())


def test_one_sensor(spark):
    p = parse(spark, [{"unix_time": 1700000000, "temps": {"probe-7f": 18.75}}])
    rows = iot.readings(p).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r["sensor_sn"], r["device_id"], r["temperature"]) == ("probe-7f", "gate-12", 18.75)
    assert r["time"] == datetime(2023, 11, 14, 22, 13, 20)


def test_two_sensors_explode(spark):
    p = parse(spark, [{"unix_time": 1700000000, "temps": {"inlet": -3.25, "outlet": 41.0}}])
    assert sorted((r["sensor_sn"], r["temperature"]) for r in iot.readings(p).collect()) == [
        ("inlet", -3.25), ("outlet", 41.0)]


def test_empty_temps_rejected(spark):
    bodies = [{"unix_time": 1700000000, "temps": {}}]
    assert iot.readings(parse(spark, bodies)).count() == 0
    assert reasons(spark, bodies) == ["empty_temps"]


def test_null_temps_still_routes_to_temps_and_rejects(spark):
    assert reasons(spark, [{"unix_time": 1700000000, "temps": None}]) == ["empty_temps"]


@pytest.mark.parametrize("body", ["no JSON at all", '{"temps": '])
def test_invalid_json_rejected_stream_continues(spark, body):
    good = {"unix_time": 1700000000, "temps": {"a": 1.0}}
    p = parse(spark, [body, good])
    assert iot.readings(p).count() == 1
    assert sorted(r["reason"] for r in iot.quarantine(p).collect()) == ["invalid_json"]


def test_missing_unix_time_uses_now(spark):
    p = parse(spark, [{"temps": {"probe-7f": 18.75}}])
    assert [r["time"] for r in iot.readings(p).collect()] == [NOW]


def test_missing_unix_time_is_the_enqueue_time_at_every_replay(spark):
    df = env(spark, [{"temps": {"probe-7f": 1.0}}, {"unix_time": 0, "temps": {"probe-8a": 2.0}}])
    first, second = ({(r["sensor_sn"], r["time"]) for r in iot.readings(iot.parse(df)).collect()} for _ in "ab")
    assert first == second == {("probe-7f", datetime(2023, 11, 14, 22, 13, 20)),
                               ("probe-8a", datetime(2023, 11, 14, 22, 13, 20))}


@pytest.mark.parametrize("text,ok", [("1.5d", False), ("0x1p3", False), ("1f", False), (" 2.5e1 ", True),
                                     (".5", True), ("-7.", True), ("", False)])
def test_numbers_as_text(spark, text, ok):
    p = parse(spark, [{"unix_time": 1700000000, "temps": {"a": text}}])
    assert iot.readings(p).count() == ok


def test_unix_time_forms(spark):
    bodies = [{"unix_time": "1700000000", "temps": {"a": 1.0}},   # numeric text ok
              {"unix_time": 1700000000.9, "temps": {"b": 1.0}},  # number truncates
              {"unix_time": "1.5", "temps": {"c": 1.0}},          # int('1.5') fails
              {"unix_time": None, "temps": {"d": 1.0}},           # int(None) fails
              {"unix_time": "abc", "temps": {"e": 1.0}}]
    p = parse(spark, bodies)
    got = {r["sensor_sn"]: r["time"] for r in iot.readings(p).collect()}
    assert got == {"a": datetime(2023, 11, 14, 22, 13, 20), "b": datetime(2023, 11, 14, 22, 13, 20)}
    assert reasons(spark, bodies) == ["bad_time"] * 3


def test_bad_temperature_entry_rejected_others_kept(spark):
    p = parse(spark, [{"unix_time": 1700000000, "temps": {"a": 20.0, "b": "n/a"}}])
    assert [r["sensor_sn"] for r in iot.readings(p).collect()] == ["a"]
    assert [r["reason"] for r in iot.quarantine(p).collect()] == ["bad_temperature"]


def test_long_serial_rejected(spark):
    p = parse(spark, [{"unix_time": 1700000000, "temps": {"x" * 51: 20.0}}])
    assert iot.readings(p).count() == 0
    assert [r["reason"] for r in iot.quarantine(p).collect()] == ["too_long:sensor_sn"]


def test_hundred_sensors_in_one_message(spark):
    temps = {f"coil-{i}": i / 4 for i in range(100)}
    p = parse(spark, [{"unix_time": 1700000000, "temps": temps}])
    assert iot.readings(p).count() == 100


FULL_STATUS = {"eventCategory": "boot", "gitVersion": "fw-77a", "version": "9.4",
               "stableVersion": "9.1", "messageCounter": 17, "numTempSensors": 6,
               "numFlowSensors": 3, "isCameraEnabled": True}


def test_status_full(spark):
    p = parse(spark, [{"unix_time": 1700000000, "status": FULL_STATUS}], device=b"gate-31")
    rows = iot.device_status(p).collect()
    assert len(rows) == 1
    r = rows[0].asDict()
    assert r["device_id"] == "gate-31"
    assert (r["event_category"], r["git_version"], r["git_current_version"],
            r["git_stable_version"], r["message_counter"], r["num_temp_sensors"],
            r["num_flow_sensors"], r["is_camera_enabled"]) == (
        "boot", "fw-77a", "9.4", "9.1", 17, 6, 3, True)
    assert json.loads(r["status_data"]) == FULL_STATUS


def test_status_missing_optionals_are_null(spark):
    p = parse(spark, [{"unix_time": 1700000000,
                       "status": {"eventCategory": "idle", "messageCounter": 8}}])
    r = iot.device_status(p).first()
    assert r["message_counter"] == 8 and r["git_version"] is None and r["is_camera_enabled"] is None


def test_status_extra_key_kept_in_payload(spark):
    st = dict(FULL_STATUS, rack={"row": 4})
    r = iot.device_status(parse(spark, [{"unix_time": 1700000000, "status": st}])).first()
    assert json.loads(r["status_data"])["rack"] == {"row": 4}


@pytest.mark.parametrize("body,reason", [
    ({"unix_time": 1700000000, "status": {}}, "empty_status"),
    ({"unix_time": 1700000000}, "unknown_format"),
    ({"unix_time": 1700000000, "humidity": 40}, "unknown_format"),
    ({"unix_time": 1700000000, "status": dict(FULL_STATUS, gitVersion="v" * 65)},
     "too_long:gitVersion"),
    ({"unix_time": 1700000000, "status": dict(FULL_STATUS, eventCategory="e" * 51)},
     "too_long:eventCategory"),
    ({"unix_time": 1700000000, "status": dict(FULL_STATUS, messageCounter="12")},
     "bad_type:messageCounter"),
    ({"unix_time": 1700000000, "status": dict(FULL_STATUS, isCameraEnabled="true")},
     "bad_type:isCameraEnabled"),
    ({"unix_time": 1700000000, "status": dict(FULL_STATUS, numTempSensors=2.0)},
     "bad_type:numTempSensors"),
    ({"unix_time": 1700000000, "status": dict(FULL_STATUS, messageCounter=3_000_000_000)},
     "out_of_range:messageCounter"),
])
def test_status_rejections(spark, body, reason):
    p = parse(spark, [body])
    assert iot.device_status(p).count() == 0
    assert [r["reason"] for r in iot.quarantine(p).collect()] == [reason]


def test_status_device_id_too_long(spark):
    p = parse(spark, [{"unix_time": 1700000000, "status": FULL_STATUS}], device=b"d" * 65)
    assert [r["reason"] for r in iot.quarantine(p).collect()] == ["too_long:device_id"]


def test_no_device_id_is_unknown(spark):
    p = parse(spark, [{"unix_time": 1700000000, "status": FULL_STATUS}], device=None)
    assert iot.device_status(p).first()["device_id"] == "unknown"


def test_temps_wins_over_status(spark):
    p = parse(spark, [{"unix_time": 1700000000, "temps": {"a": 1.0}, "status": FULL_STATUS}])
    assert iot.readings(p).count() == 1 and iot.device_status(p).count() == 0


def test_progress_per_partition(spark):
    rows = [("{}", b"d", "0", 100, 1, datetime(2024, 1, 1)),
            ("{}", b"d", "0", 300, 5, datetime(2024, 1, 2)),
            ("{}", b"d", "1", 200, 10, datetime(2024, 1, 3))]
    df = spark.createDataFrame(rows, ENVELOPE)
    got = {r["partition"]: (r["offset"], r["sequence_number"], r["timestamp"])
           for r in iot.progress(df).collect()}
    assert got == {"0": (300, 5, "2024-01-02T00:00:00.000000"),
                   "1": (200, 10, "2024-01-03T00:00:00.000000")}


@pytest.mark.parametrize("value,expected", [
    ("true", ("latest", False)), ("TRUE", ("latest", False)), ("full", ("earliest", False)),
    ("false", ("earliest", True)), ("invalid", ("earliest", True)), (None, ("earliest", True))])
def test_start_position_policy(value, expected):
    from tempora.sources.messages import start_options

    o = start_options(value, has_checkpoint=True)
    assert (o["startingOffsets"], o["resume"]) == expected
    assert start_options("false", has_checkpoint=False)["resume"] is False


def test_progress_interval_setting():
    from tempora.streaming.ingest import progress_interval_seconds

    assert progress_interval_seconds("0.5") == 30
    assert progress_interval_seconds(None) == 1800
    assert progress_interval_seconds("abc") == 1800
    assert progress_interval_seconds("-1") == 1800


def test_file_source_latest_skips_past(spark, workdir):
    from tempora.sources.messages import read_envelopes

    rows = [("{}", b"d", "0", 1, 1, datetime(2024, 1, 1)), ("{}", b"d", "0", 2, 2, datetime(2024, 1, 3))]
    spark.createDataFrame(rows, ENVELOPE).write.parquet(f"{workdir}/env")
    df = read_envelopes(spark, f"{workdir}/env", fmt="parquet", ignore_past="TRUE",
                        started_at=datetime(2024, 1, 2))
    q = df.writeStream.format("memory").queryName("latest_only").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [r["seq"] for r in spark.table("latest_only").collect()] == [2]


def test_progress_records_by_name(spark):
    from tempora.streaming.ingest import records_from_named

    named = spark.createDataFrame([
        ("checkpoint-0", '{"offset": 100, "sequence_number": 1, "timestamp": "2024-01-01T00:00:00"}'),
        ("checkpoint-1", '{"offset": 200, "sequence_number": 2, "timestamp": "2024-01-01T00:00:01"}'),
        ("other-data", '{"offset": 9}')], "name string, payload string")
    got = sorted((r["partition"], r["offset"], r["sequence_number"])
                 for r in records_from_named(named).collect())
    assert got == [("0", 100, 1), ("1", 200, 2)]


def test_trailing_year_window(spark):
    from pyspark.sql import functions as F

    from tempora.operators import calendar

    df = spark.createDataFrame([("2022-01-01 00:00:00", 1.0), ("2024-01-07 00:00:00", 2.0)],
                               "time string, value double").withColumn(
        "time", F.col("time").cast("timestamp_ntz"))
    as_written = {r["day"]: r["value"] for r in calendar.weekday_median(df).collect()}
    trailing = {r["day"]: r["value"] for r in calendar.weekday_median(
        df, as_of=datetime(2024, 1, 8)).collect()}
    assert as_written["Sat"] == 1.0 and as_written["Sun"] == 2.0   # predicate keeps every row
    assert trailing["Sat"] is None and trailing["Sun"] == 2.0


@pytest.mark.parametrize("body", ["[1, 2]", "123", '"text"', "null", '  {"temps": {"a": 1.0}} '])
def test_only_json_objects_are_routed(spark, body):
    p = parse(spark, [body])
    expect_reading = body.strip().startswith("{")
    assert iot.readings(p).count() == (1 if expect_reading else 0)
    if not expect_reading:
        assert [r["reason"] for r in iot.quarantine(p).collect()] == ["invalid_json"]


def test_epoch_of_forms(spark):
    from pyspark.sql import functions as F

    bodies = ['{"unix_time": 1700000000}', '{"unix_time": "  42 "}', '{"unix_time": 7.9}',
              '{"unix_time": true}', '{}', '{"unix_time": "1.5"}', '{"unix_time": null}']
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    got = [r[0] for r in df.select(iot.epoch_of(F.try_parse_json("body"))).collect()]
    assert got == [1700000000, 42, 7, 1, 0, None, None]
