"""A key holding half of all rows: aggregation stays partial and the join is
split by AQE instead of landing in one task."""

from pyspark.sql import functions as F

from tempora.operators import dims


def test_hot_sensor_join_is_split_and_exact(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 200_000
        readings = spark.range(n).select(
            F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(
                F.format_string("s-%d", F.col("id") % 1000)).alias("sensor_sn"),
            F.col("id").cast("double").alias("temperature"))
        dim = spark.range(1000).select(F.format_string("s-%d", "id").alias("sensor_sn"),
                                       (F.col("id") + 1).cast("int").alias("id")).unionByName(
            spark.createDataFrame([("hot", 5000)], "sensor_sn string, id int"))
        joined = dims.resolve(readings, dim)
        per = joined.groupBy("sensor_id").agg(F.count(F.lit(1)).alias("n"))
        rows = {r["sensor_id"]: r["n"] for r in per.collect()}
        assert rows[5000] == n // 2 and sum(rows.values()) == n
        cached = joined.cache()
        cached.count()   # the cached relation keeps the final adaptive plan
        plan = cached._jdf.queryExecution().executedPlan().toString()
        cached.unpersist()
        assert "isFinalPlan=true" in plan and "skew=true" in plan, plan[:3000]
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
