"""Tick ingestion: websocket frames → stocks_real_time rows.

Only ``event == "price"`` frames are kept; fields map by position onto
(time, symbol, price, day_volume), ``day_volume`` being optional.  The
frame's epoch seconds are read as UTC (the reference's host-local
conversion is replaced by UTC, deliberately).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.functions import timefns
from tempora.operators import layout
from tempora.schemas import TICK_EVENT
from tempora.sources.versioned import Store


def parse_frames(frames: DataFrame, col: str = "frame") -> DataFrame:
    t = F.from_json(F.col(col), TICK_EVENT)
    return frames.select(t.alias("t")).select("t.*")


def price_rows(ticks: DataFrame) -> DataFrame:
    """Keep price frames; project onto the table's column order."""
    return (ticks.filter(F.col("event") == "price")
            .select(timefns.from_epoch_seconds("timestamp").alias("time"),
                    "symbol", "price", "day_volume"))


def start(ticks_stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
          chunk_interval=layout.DEFAULT_CHUNK):
    """Append price rows to a Parquet table, exactly once per micro-batch
    (the file sink's own log), chunked like every other table; the interval
    is kept with the table."""
    layout.remember_interval(ticks_stream.sparkSession, path, chunk_interval)
    rows = price_rows(ticks_stream).withColumn("chunk", layout.chunk_of("time", chunk_interval))
    w = (rows.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).partitionBy("chunk"))
    w = w.trigger(**(trigger or {"processingTime": "5 seconds"}))
    return w.start(path)


def start_versioned(ticks_stream: DataFrame, store: Store, checkpoint: str, trigger: dict | None = None,
                    chunk_interval=layout.DEFAULT_CHUNK, table: str = "stocks_real_time"):
    """Append price rows to a table of a versioned store, a commit per micro-batch; the table
    can be compacted (``store.compact_table``) while the stream runs."""
    def write(batch: DataFrame, number: int) -> None:
        if store.committed(table, number):
            return
        commit = store.begin()
        commit.add_chunked(table, price_rows(batch), "time", None, chunk_interval)
        commit.commit(table, number)

    w = ticks_stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": "5 seconds"})).start()
