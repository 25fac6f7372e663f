"""Mergeable states against aggregates computed from all rows at once."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tempora.plans import cagg, states
from tempora.sources import versioned
from tempora.sources.versioned import Store

T0 = datetime(2024, 3, 1)


def readings(spark, rows):
    return spark.createDataFrame(rows, "time timestamp_ntz, sensor_id int, temperature double")


def canon(df):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=repr)


def some(n, seed, offset=20.0):
    rng = random.Random(seed)
    return [(T0 + timedelta(minutes=rng.randrange(0, 4000)), rng.choice([0, 1, None]),
             rng.choice([None, offset + rng.random()])) for _ in range(n)]


@pytest.mark.parametrize("name", ["sensor_temp_10min", "sensor_temp_30min", "sensor_temp_1h"])
def test_batches_merge_to_the_whole(spark, workdir, name):
    batches = [some(150, s) for s in range(3)]
    agg = states.define(name, f"{workdir}/s", spark)
    for n, b in enumerate(batches):
        assert agg.absorb(readings(spark, b), "w", n) == n
    assert agg.absorb(readings(spark, batches[1]), "w", 1) is None
    whole = readings(spark, [r for b in batches for r in b])
    want = cagg.define(name, f"{workdir}/c").compute(whole).drop("bucket_date")
    assert canon(agg.read().select(want.columns)) == canon(want)


def test_deviation_of_large_values(spark, workdir):
    rng = random.Random(1)
    batches = [[(T0, 1, 1e9 + rng.random()) for _ in range(50)] for _ in range(4)]
    agg = states.define("sensor_temp_1h", f"{workdir}/s", spark)
    for n, b in enumerate(batches):
        agg.absorb(readings(spark, b), "w", n)
    v = [r[2] for b in batches for r in b]
    mean = sum(x - 1e9 for x in v) / len(v)
    exact = math.sqrt(sum((x - 1e9 - mean) ** 2 for x in v) / (len(v) - 1))
    assert agg.read().first()["stddev_temperature"] == pytest.approx(exact, rel=1e-5)


def test_first_and_last_with_ties_and_nulls(spark, workdir):
    schema = "time timestamp_ntz, symbol string, price double, day_volume decimal(38,10)"
    rows = [(T0, "a", 3.0, 5), (T0, "a", 2.0, 5), (T0, "a", None, 1), (T0, "a", 9.0, None), (None, "a", 7.0, 1),
            (T0 + timedelta(minutes=3), "a", 4.0, 2), (T0 + timedelta(minutes=3), "a", 4.5, 2), (T0, None, 1.0, 1),
            (T0, None, 2.0, 2)]
    for seed in range(4):
        mixed = rows[:]
        random.Random(seed).shuffle(mixed)
        mixed = [(t, s, p, None if v is None else __import__("decimal").Decimal(v)) for t, s, p, v in mixed]
        agg = states.define("ten_min_candle", f"{workdir}/{seed}", spark)
        for n in range(3):
            agg.absorb(spark.createDataFrame(mixed[n::3], schema), "w", n)
        want = cagg.define("ten_min_candle", f"{workdir}/c").compute(spark.createDataFrame(mixed, schema))
        want = want.drop("bucket_date")
        assert canon(agg.read().select(want.columns)) == canon(want), seed


def test_a_refresh_reads_the_new_rows_and_their_dates_only(spark, workdir):
    agg = states.define("sensor_temp_1h", f"{workdir}/s", spark)
    for d in range(6):
        agg.absorb(readings(spark, [(T0 + timedelta(days=d, hours=1), 1, 20.0)]), "w", d)
    store = agg.store
    before = {p.chunk: p for p in store.state().parts("sensor_temp_1h")}
    agg.absorb(readings(spark, [(T0 + timedelta(days=2, hours=1), 1, 30.0)]), "w", 6)  # four days late
    after = {p.chunk: p for p in store.state().parts("sensor_temp_1h")}
    assert [c for c in after if after[c] != before.get(c)] == ["2024-03-03"] and len(after) == 6
    row = agg.read(after=T0 + timedelta(days=2)).filter(F.col("reading_count") == 2).first()
    assert row["avg_temperature"] == 25.0
    # of the day that is still open at the time nothing is read
    closed = agg.read(as_of=T0 + timedelta(days=5, hours=2))
    assert closed.count() == 5


def test_two_writers_of_one_date(spark, workdir, monkeypatch):
    root = f"{workdir}/s"
    a, b = (states.define("sensor_temp_1h", root, spark) for _ in range(2))
    real, once = versioned.Commit.commit, []

    def late(self, *args, **how):
        if not once:  # the other writer commits between this one's look and its commit
            once.append(1)
            b.absorb(readings(spark, [(T0, 1, 10.0)]), "other", 0)
        return real(self, *args, **how)

    monkeypatch.setattr(versioned.Commit, "commit", late)
    a.absorb(readings(spark, [(T0, 1, 30.0)]), "w", 0)
    assert [tuple(r)[2:4] for r in a.read().collect()] == [(2, 20.0)]


def test_median_state(spark, workdir):
    spec = cagg.sensor_temp("sensor_temp_1h", "1 day", f"{workdir}/m")
    agg = states.StateAggregate(spec, [states.median("median", "temperature")], Store(spark, f"{workdir}/s"))
    rng = random.Random(3)
    values = [rng.random() for _ in range(6000)]
    for n in range(3):
        agg.absorb(readings(spark, [(T0, 1, v) for v in values[n::3]]), "w", n)
    median = agg.read().first()["median"]
    rank = sum(v < median for v in values) / len(values)
    assert abs(rank - 0.5) < 0.017


def test_empty_batches(spark, workdir):
    agg = states.define("sensor_temp_1h", f"{workdir}/s", spark)
    agg.absorb(readings(spark, []), "w", 0)
    assert agg.read().count() == 0
    agg.absorb(readings(spark, [(T0, 1, 10.0)]), "w", 1)
    assert agg.read().count() == 1
