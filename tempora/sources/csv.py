"""Bulk CSV load into a typed table (S1) with a load-once guard.

Gzip files are not splittable: each file is read by one task, so the rows
are redistributed (round-robin, no key - no skew) before any heavy work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tempora.session import delete_path
from tempora.sources.versioned import Conflict, Store


# Text form of timestamps in the CSV files (microsecond precision).
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def read_csv(spark: SparkSession, path: str, schema, header: bool = True,
             repartition: int | None = None, timestamp_format: str = TIMESTAMP_FORMAT) -> DataFrame:
    df = (spark.read.schema(schema).option("header", str(header).lower())
          .option("timestampFormat", timestamp_format)
          .option("mode", "FAILFAST").csv(path))
    return df.repartition(repartition) if repartition else df


def load_once(store: Store, csv_path: str, table: str, schema, header: bool = True) -> bool:
    """Load the CSV into ``table`` of the store unless it holds rows already.  True when this call loaded them.

    The rows are seen all at once, by a commit that only one loader can make: of two at the same
    time one comes out empty-handed, and what a crashed one has written nobody reads."""
    spark = store.spark
    state = store.state()
    if state.parts(table) and not store.frame(table, state.parts(table), state).limit(1).isEmpty():
        return False
    commit = store.begin()
    # even parts of the advisory size, however large the load
    part = commit.add(table, read_csv(spark, csv_path, schema, header).hint("rebalance"))
    commit.expect(table, {None}, state.parts(table))
    try:
        commit.commit()
    except Conflict:
        for p in part:
            delete_path(spark, f"{store.root}/{p.folder}")
        return False
    return True


def write_csv(df: DataFrame, path: str, header: bool = True,
              timestamp_format: str = TIMESTAMP_FORMAT) -> None:
    (df.write.option("header", str(header).lower()).option("compression", "gzip")
     .option("timestampFormat", timestamp_format).option("timestampNTZFormat", timestamp_format)
     .csv(path))
