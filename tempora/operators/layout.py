"""Time-chunked Parquet tables ("chunked tables"), their column layout, and
age-based compaction.

* K5: rows are written under ``chunk=<date>`` directories, one per fixed time
  interval, so a time predicate can skip whole directories.
* K6: within a chunk, rows are clustered by the segment column and ordered
  by time descending; Parquet (zstd, dictionary/RLE) then keeps per-row-group
  min/max statistics that make segment and time predicates selective.
* K7: chunks older than a cut-off are rewritten once into that layout.

Writers rebalance on the chunk and sort within their partitions: a chunk or
segment holding a third of all rows is split across tasks by its measured
size instead of landing in one.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.functions import timefns
from tempora.session import checkpointed, hadoop_fs, list_dirs, read_text, write_text

DEFAULT_CHUNK = "7 days"

# The reference's compression settings per table - segment-by
# column, order-by column (descending) and the age after which a chunk is
# compressed.
COMPRESSION = {
    "metrics": ("type_id", "created", "7 days"),
    "stocks_real_time": ("symbol", "time", "1 day"),
    "sensor_data": ("sensor_id", "time", "2 days"),
    "device_status": ("device_id", "time", "2 days"),
}


def chunk_of(ts, chunk_interval=DEFAULT_CHUNK):
    """Chunk key: the date on which the row's chunk starts."""
    return F.to_date(timefns.time_bucket(ts, chunk_interval))


def remember_interval(spark: SparkSession, path: str, chunk_interval) -> None:
    """Keep the chunk interval with the table (readers skip files with a leading underscore)."""
    seconds = int(timefns.parse_width(chunk_interval).total_seconds())
    known = known_interval(spark, path)
    if known is not None and known != seconds:
        raise ValueError(f"{path} is chunked by {known} s, not {seconds} s")
    if known is None:
        write_text(spark, f"{path}/_chunk_interval", str(seconds))


def known_interval(spark: SparkSession, path: str) -> int | None:
    """Chunk interval of a table in seconds, None where the table doesn't tell."""
    text = read_text(spark, f"{path}/_chunk_interval")
    return int(text) if text else None


def chunk_range_filter(lo: datetime | None, hi: datetime | None, chunk_interval=DEFAULT_CHUNK):
    """Partition predicate implied by lo <= ts < hi (Spark does not derive it
    through the bucket expression, so state it)."""
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col("chunk") >= F.lit(timefns.bucket_floor(lo, chunk_interval).date()))
    if hi is not None:
        cond = cond & (F.col("chunk") <= F.lit(timefns.bucket_floor(hi, chunk_interval).date()))
    return cond


def clustered(df: DataFrame, time_col: str, segment_by: str | None,
              chunk_interval=DEFAULT_CHUNK, partitions: int | None = None) -> DataFrame:
    out = df.withColumn("chunk", chunk_of(time_col, chunk_interval))
    # A rebalance on the chunk reads the input once (range partitioning reads
    # it again for its sample), and the engine splits a large chunk by size.
    dealt = (out.hint("rebalance", partitions, F.col("chunk")) if partitions
             else out.hint("rebalance", F.col("chunk")))
    order = ["chunk"] + ([F.col(segment_by)] if segment_by else []) + [F.col(time_col).desc()]
    return dealt.sortWithinPartitions(*order)


def segment_options(segment_by: str | None, row_group_bytes: int | None = None) -> dict[str, str]:
    """Writer options by which a predicate on the segment column skips row groups: rows sorted by segment give
    narrow minima and maxima, and a Bloom filter per row group tells of the rest (files of small batches, which
    hold values from everywhere) whether a segment is in it."""
    out = {}
    if segment_by:
        out[f"parquet.bloom.filter.enabled#{segment_by}"] = "true"
        out[f"parquet.bloom.filter.adaptive.enabled#{segment_by}"] = "true"  # sized by the values at hand
    if row_group_bytes:
        out["parquet.block.size"] = str(row_group_bytes)
    return out


def write_chunked(df: DataFrame, path: str, time_col: str, segment_by: str | None = None,
                     chunk_interval=DEFAULT_CHUNK, mode: str = "append",
                     max_records_per_file: int = 5_000_000, row_group_bytes: int | None = None) -> None:
    """Append (or overwrite) rows into a chunked table at ``path``."""
    remember_interval(df.sparkSession, path, chunk_interval) if mode == "append" else None
    (clustered(df, time_col, segment_by, chunk_interval)
     .write.mode(mode)
     .option("maxRecordsPerFile", max_records_per_file)
     .option("compression", "zstd")
     .options(**segment_options(segment_by, row_group_bytes))
     .partitionBy("chunk")
     .parquet(path))
    if mode != "append":
        remember_interval(df.sparkSession, path, chunk_interval)


def read_chunked(spark: SparkSession, path: str, time_col: str, lo: datetime | None = None,
                    hi: datetime | None = None, keep_chunk: bool = False) -> DataFrame:
    """Rows with lo <= time < hi, pruned to the chunks that can hold them -
    by the interval kept with the table; where none is, by time alone."""
    df = spark.read.parquet(path)
    seconds = known_interval(spark, path)
    if seconds is not None:
        df = df.filter(chunk_range_filter(lo, hi, f"{seconds} seconds"))
    if lo is not None:
        df = df.filter(F.col(time_col) >= timefns.ntz_literal(lo))
    if hi is not None:
        df = df.filter(F.col(time_col) < timefns.ntz_literal(hi))
    return df if keep_chunk else df.drop("chunk")


def _data_files(spark: SparkSession, folder: str) -> list[str]:
    fs, p = hadoop_fs(spark, folder)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)
                  if not st.getPath().getName().startswith(("_", ".")))


def compact(spark: SparkSession, path: str, time_col: str, segment_by: str | None,
            as_of: datetime, older_than, chunk_interval=None) -> list:
    """Rewrite every chunk that ended more than ``older_than`` before
    ``as_of`` with the segment/order layout (K7), unless it is unchanged
    since its last compaction: each compacted chunk keeps the list of its
    files beside them.  Returns the chunks rewritten.

    The rewritten rows are checkpointed to the shared folder before the
    chunks they were read from are overwritten.  The chunk interval is the one kept with the table;
    one that differs is an error, as its rows would get other chunks.  Refused are tables with directories
    below the chunks and those of a streaming file sink, whose readers go by the sink's own list of
    files: a store (``sources.versioned``) compacts under running streams.
    """
    known = known_interval(spark, path)
    if known is not None and chunk_interval is not None and \
            known != int(timefns.parse_width(chunk_interval).total_seconds()):
        raise ValueError(f"{path} is chunked by {known} s, not {chunk_interval}")
    chunk_interval = f"{known} seconds" if known is not None else chunk_interval or DEFAULT_CHUNK
    if "_spark_metadata" in list_dirs(spark, path):
        raise ValueError(f"{path} belongs to a streaming sink; it can't be compacted in place")
    cutoff = as_of - timefns.parse_width(older_than)
    width = timefns.parse_width(chunk_interval)
    last_old = (timefns.bucket_floor(cutoff, width) - width).date()
    # Chunk keys come from the directory listing - no rows are read.
    chunks = sorted(d for d in (date.fromisoformat(n.split("=", 1)[1])
                                for n in list_dirs(spark, path) if n.startswith("chunk="))
                    if d <= last_old)
    nested = [d for d in chunks if list_dirs(spark, f"{path}/chunk={d.isoformat()}")]
    if nested:
        raise ValueError(f"{path} has directories below its chunks; it can't be compacted in place")
    chunks = [d for d in chunks if read_text(spark, f"{path}/chunk={d.isoformat()}/_compacted")
              != "\n".join(_data_files(spark, f"{path}/chunk={d.isoformat()}"))]
    if not chunks:
        return []
    parts = [f"{path}/chunk={d.isoformat()}" for d in chunks]
    rows = spark.read.option("basePath", path).parquet(*parts).drop("chunk")
    staged = checkpointed(clustered(rows, time_col, segment_by, chunk_interval))
    (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", "zstd").options(**segment_options(segment_by))
     .partitionBy("chunk").parquet(path))
    for folder in parts:
        write_text(spark, f"{folder}/_compacted", "\n".join(_data_files(spark, folder)))
    return chunks


def compact_table(spark: SparkSession, table: str, path: str, as_of: datetime,
                  chunk_interval=None) -> list:
    """K7 with the reference's per-table policy (segment, order, age)."""
    segment_by, time_col, older_than = COMPRESSION[table]
    return compact(spark, path, time_col, segment_by, as_of, older_than, chunk_interval)
