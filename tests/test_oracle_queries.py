"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle import compare

from tempora.plans import catalog

# the training-data queries, where they are installed, have tests of their own
QUERIES = {k: v for k, v in E.queries().items() if k in catalog.QUERIES}
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in catalog.QUERIES}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) == set(catalog.QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    r = compare(df, ORACLE[name], SF_SMALL)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["exact"], r
    if name in ORDERED:
        assert r["ordered"], r


#: Reports whose last ORDER BY is total, so that the order itself is part of the result (O1-O3).
ORDERED = {"candle_10min_symbol", "candle_1h_symbol", "candle_recent", "candle_recent_1h",
           "tick_stream_to_candle", "kwh_hour_profile", "sensor_list", "agg_1h_one_sensor",
           "agg_recent_10min"}


def test_ordered_reports_are_registered():
    assert ORDERED <= set(QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["bucket", "symbol", "open", "high", "low", "close", "day_volume"]
    assert df.count() > 0
