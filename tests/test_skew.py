"""A third of lineitem on one order key: the shuffle join is split by AQE."""
from pyspark.sql import functions as F

from conftest import SF_MID


def test_hot_order_key_join_is_split_by_aqe(spark, tmp_dir):
    li = spark.read.parquet(f"{SF_MID}/lineitem.parquet")
    hot = li.withColumn("l_orderkey", F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_orderkey")))
    hot.repartition(8).write.parquet(f"{tmp_dir}/li")
    orders = spark.read.parquet(f"{SF_MID}/orders.parquet")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16384",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        h = spark.read.parquet(f"{tmp_dir}/li")
        j = h.join(orders, h.l_orderkey == orders.o_orderkey).groupBy("o_orderstatus").agg(
            F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"))
        got = sorted(tuple(r) for r in j.collect())
        plan = j._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "skew=true" in plan, plan
    ref = hot.join(orders, hot.l_orderkey == orders.o_orderkey).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"))
    assert got == sorted(tuple(r) for r in ref.collect())
