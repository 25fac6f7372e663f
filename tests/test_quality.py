from datetime import datetime

from tempora.operators import quality


def test_split_and_violations(spark):
    dim = spark.createDataFrame([(1,), (2,)], "id int")
    rows = spark.createDataFrame(
        [(datetime(2024, 1, 1), 1, "ok"), (None, 2, "ok"), (datetime(2024, 1, 1), 3, "ok"),
         (datetime(2024, 1, 1), 1, "x" * 51), (datetime(2024, 1, 1), None, "ok")],
        "time timestamp, sensor_id int, sn string")
    c = quality.Constraints("t", not_null=["sensor_id"], max_length={"sn": 50},
                            foreign_keys=[("sensor_id", dim, "id")], default_now=["time"],
                            unique=["sn"])
    acc, rej = quality.split(rows, c)
    assert acc.count() == 2                       # NULL time takes the default, so it passes
    assert acc.filter("time IS NULL").count() == 0
    assert sorted(r["reason"] for r in rej.collect()) == ["fk:sensor_id", "not_null:sensor_id",
                                                        "too_long:sn"]
    v = {r["check"]: r["violations"] for r in quality.violations(rows, c).collect()}
    assert v == {"not_null:sensor_id": 1, "too_long:sn": 1, "unique:sn": 3, "fk:sensor_id": 1}


def _loader(spark, workdir, **more):
    from tempora.sources.versioned import Store

    store = Store(spark, f"{workdir}/s")
    return store, quality.UniqueIngest(store, quality.Constraints("t", not_null=["sn"], unique=["sn"], **more), ["seq"])


def _sn(spark, rows):
    return spark.createDataFrame(rows, "sn string, seq int, v int")


def test_a_key_is_taken_once_over_all_batches(spark, workdir):
    store, load = _loader(spark, workdir, max_length={"sn": 3})
    assert load.append(_sn(spark, [("a", 2, 1), ("a", 1, 2), ("b", 1, 3), (None, 1, 4), ("long", 1, 5), ("c", 3, 6),
                                   ("c", 3, 6)]), 0) == 0
    assert load.append(_sn(spark, [("a", 0, 7), ("d", 1, 8)]), 1) == 1
    assert load.append(_sn(spark, [("a", 0, 7), ("d", 1, 8)]), 1) is None  # the batch again
    assert sorted(tuple(r) for r in store.read("t").collect()) == [("a", 1, 2), ("b", 1, 3), ("c", 3, 6), ("d", 1, 8)]
    out = sorted((r["reason"], r["sn"] or "", r["v"]) for r in store.read("t_rejected").collect())
    assert out == [("not_null:sn", "", 4), ("too_long:sn", "long", 5), ("unique:sn", "a", 1), ("unique:sn", "a", 7),
                   ("unique:sn", "c", 6)]


def test_null_keys_are_no_duplicates(spark, workdir):
    from tempora.sources.versioned import Store

    store = Store(spark, f"{workdir}/s")
    load = quality.UniqueIngest(store, quality.Constraints("t", unique=["sn"]), ["seq"])
    for n in range(2):
        load.append(_sn(spark, [(None, 1, n), (None, 2, n), ("a", 1, n)]), n)
    assert store.read("t").filter("sn IS NULL").count() == 4 and store.read("t").count() == 5


def test_two_loaders_take_a_key_once(spark, workdir, monkeypatch):
    from tempora.sources import versioned

    store, load = _loader(spark, workdir)
    other = quality.UniqueIngest(versioned.Store(spark, f"{workdir}/s"), load.rules, ["seq"])
    real, once = versioned.Commit.commit, []

    def late(self, *args, **how):
        if not once:
            once.append(1)
            other.append(_sn(spark, [("a", 1, 100)]), 7)
        return real(self, *args, **how)

    monkeypatch.setattr(versioned.Commit, "commit", late)
    load.append(_sn(spark, [("a", 1, 1), ("b", 1, 2)]), 8)
    assert sorted(tuple(r) for r in store.read("t").collect()) == [("a", 1, 100), ("b", 1, 2)]


def test_folders_of_keys_stay_few(spark, workdir):
    store, load = _loader(spark, workdir)
    for n in range(9):
        load.append(_sn(spark, [(f"k{n}", 1, n), ("k0", 2, n)]), n)
    assert len(store.state().parts("t_keys")) <= 4
    assert store.read("t").count() == 9 and store.read("t_rejected").count() == 9
