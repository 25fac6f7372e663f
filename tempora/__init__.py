"""tempora: time-series analytics on Spark DataFrames and Structured Streaming.

Time-bucketed aggregates (first/last, counter deltas, OHLC candles, summary
statistics, medians), continuous aggregates refreshed under a policy,
time-chunked Parquet layout, and IoT / market-tick ingestion, all expressed
with the public PySpark API.
"""

__version__ = "0.1.0"
