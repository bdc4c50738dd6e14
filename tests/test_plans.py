"""Plan assertions: pruning, pushdown, join strategies, no cartesian products."""
import re

import __spark_entry__ as E
from tools.scan_stats import scan_bytes

from conftest import SF_SMALL

Q = E.queries()


def plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_projection_reaches_the_scan(spark):
    p = Q["scan_projection"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in p


def test_service_filter_pushed_to_lineitem_scan(spark):
    from tripmart.plans.trips import trips
    p = trips(spark, SF_SMALL, locations=False, services=("Green",))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*In\(l_linestatus, \[O\]\)|EqualTo\(l_linestatus,O\)", p), p


def test_time_range_pushed_to_orders_scan(spark):
    p = Q["filter_time_window"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in p and "LessThan(o_orderdate" in p


def test_zone_dimension_is_broadcast_and_no_cartesian(spark):
    for k in ("join_implicit", "join_role_playing", "fct_trips", "max_tip_by_dropoff"):
        p = plan(Q[k](spark, SF_SMALL))
        assert "BroadcastHashJoin" in p
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_not_in_is_an_anti_join_not_a_nested_loop(spark):
    p = plan(Q["orphan_keys"](spark, SF_SMALL))
    assert "LeftAnti" in p and "BroadcastNestedLoopJoin" not in p


def test_no_python_in_batch_plans(spark):
    for k in ("fct_trips", "monthly_zone_revenue", "daily_location_report", "session_by_key", "dq_report"):
        p = plan(Q[k](spark, SF_SMALL))
        assert not re.search(r"ArrowEvalPython|BatchEvalPython|PythonUDF", p), k


def test_partition_pruning_and_scan_bytes(spark):
    df = Q["partition_prune_distinct"](spark, SF_SMALL)
    p = plan(df)
    assert "PartitionFilters: [isnotnull(dropoff_date" in p
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    one, two, every = (scan_bytes(li.select("l_extendedprice")), scan_bytes(li.select("l_extendedprice", "l_tax")),
                       scan_bytes(li))
    assert 0 < one < two < every
    from pyspark.sql import functions as F
    assert scan_bytes(li.agg(F.count(F.lit(1)))) == 0


def test_dedupe_reuses_join_partitioning(spark):
    # (orderkey, linenumber) rows meet where the orderkey join left them: no exchange more
    p = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        s = Q["dedupe_first"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", p)
    assert len(re.findall(r"Exchange hashpartitioning", s)) <= 2


def test_pickup_filter_on_the_fact_reaches_the_orders_scan(spark):
    from tripmart.plans import marts
    from tripmart.plans.trips import trips, zones
    fct = marts.fct_trips(trips(spark, SF_SMALL), zones(spark, SF_SMALL)).where("pickup_datetime >= TIMESTAMP_NTZ '1998-01-01'")
    p = fct._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in p
    r = Q["rollup_of_report"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(o_orderdate" in r and "l_linestatus" in r.split("PushedFilters")[1]


def test_high_water_mark_is_a_pushed_range(spark):
    p = Q["incremental_high_water"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderdate" in p


def test_year_list_becomes_pushed_ranges(spark):
    p = Q["filter_years_in"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in p
    assert re.search(r"o_orderdate#\d+ >= 1996-01-01 00:00:00\)\) AND \(o_orderdate#\d+ < 1998-01-01", p)


def test_bucketed_tables_join_without_exchange(spark, tmp_dir):
    from tripmart.operators.table_store import write_bucketed
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    od = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    write_bucketed(li, "tm_li_b", ["l_orderkey"], 8, path=f"{tmp_dir}/li")
    write_bucketed(od, "tm_od_b", ["o_orderkey"], 8, path=f"{tmp_dir}/od")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a, b = spark.table("tm_li_b"), spark.table("tm_od_b")
        j = a.join(b, a.l_orderkey == b.o_orderkey)
        n = j.count()
        p = j._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    assert n == li.join(od, li.l_orderkey == od.o_orderkey).count()
    assert "SortMergeJoin" in p and "Exchange hashpartitioning" not in p, p


def test_unused_location_lookup_is_not_joined(spark):
    from tripmart.plans.trips import trips
    p = trips(spark, SF_SMALL, locations=("pickup",))._jdf.queryExecution().executedPlan().toString()
    assert "supplier.parquet" in p and "customer.parquet" not in p
    rev = Q["revenue_by_zone"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "customer.parquet" not in rev


def test_both_services_share_the_orders_exchange(spark):
    """Each service joins its own line items; the orders are shuffled once."""
    from tripmart.plans import marts
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        p = marts.clean_all(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    reused = re.findall(r"ReusedExchange \[([^\]]*)\]", p)
    assert any("o_orderkey" in r for r in reused), p
