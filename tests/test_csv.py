"""Load once: whole or not at all, and by one loader only."""

import threading
from datetime import datetime

import pytest

from tempora import schemas
from tempora.sources import csv as csv_source
from tempora.sources import versioned
from tempora.sources.versioned import Store


@pytest.fixture()
def landed(spark, workdir):
    rows = spark.createDataFrame([(datetime(2024, 1, 1, h), h % 3, float(h)) for h in range(20)], schemas.METRICS)
    csv_source.write_csv(rows, f"{workdir}/csv")
    return f"{workdir}/csv"


def test_two_loaders_at_once_give_one_copy(spark, workdir, landed):
    done = []
    threads = [threading.Thread(target=lambda: done.append(csv_source.load_once(
        Store(spark, f"{workdir}/t"), landed, "metrics", schemas.METRICS))) for _ in range(3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(done) == [False, False, True]
    assert Store(spark, f"{workdir}/t").read("metrics").count() == 20
    assert not csv_source.load_once(Store(spark, f"{workdir}/t"), landed, "metrics", schemas.METRICS)


def test_a_load_that_dies_is_done_again(spark, workdir, landed, monkeypatch):
    store = Store(spark, f"{workdir}/t")
    real = versioned.Commit.commit
    monkeypatch.setattr(versioned.Commit, "commit", lambda *_, **__: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        csv_source.load_once(store, landed, "metrics", schemas.METRICS)
    monkeypatch.setattr(versioned.Commit, "commit", real)
    assert store.state().parts("metrics") == []  # all of its rows were written, none is seen
    assert csv_source.load_once(store, landed, "metrics", schemas.METRICS)
    assert store.read("metrics").count() == 20


def test_an_empty_file_loads_nothing_and_leaves_the_table_loadable(spark, workdir, landed):
    store = Store(spark, f"{workdir}/t")
    csv_source.write_csv(spark.createDataFrame([], schemas.METRICS), f"{workdir}/none")
    csv_source.load_once(store, f"{workdir}/none", "metrics", schemas.METRICS)
    assert csv_source.load_once(store, landed, "metrics", schemas.METRICS)
    assert store.read("metrics").count() == 20
