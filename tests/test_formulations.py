"""Two formulations of one query must agree (the reference's manual cross-checks)."""
from pyspark.sql import functions as F

import __spark_entry__ as E
from tripmart.plans import marts
from tripmart.plans.trips import zones

from conftest import SF_SMALL


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_comma_join_equals_explicit_join(spark):
    q = E.queries()
    assert rows(q["join_implicit"](spark, SF_SMALL)) == rows(q["join_role_playing"](spark, SF_SMALL))


def test_revenue_report_dataframe_equals_spark_sql(spark):
    base = marts.revenue_base(spark, SF_SMALL)
    green = marts.clean(marts.raw_trips(spark, SF_SMALL, "Green"), "Green")
    yellow = marts.clean(marts.raw_trips(spark, SF_SMALL, "Yellow"), "Yellow")
    green.createOrReplaceTempView("rv_green")
    yellow.createOrReplaceTempView("rv_yellow")
    zones(spark, SF_SMALL).createOrReplaceTempView("rv_zones")
    sql = spark.sql("""
        SELECT z.zone, CAST(SUM(t.total_amount) AS DECIMAL(20,2)) AS revenue
        FROM (SELECT pickup_location_id AS location_id, total_amount FROM rv_green
              UNION ALL SELECT pickup_location_id, total_amount FROM rv_yellow) t
        JOIN rv_zones z ON t.location_id = z.location_id
        GROUP BY z.zone""")
    assert rows(marts.revenue_by_zone(base)) == rows(sql)


def test_batch_sessions_equal_sql_islands(spark):
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    e.createOrReplaceTempView("ev")
    sql = spark.sql("""
        SELECT user_id, COUNT(*) AS n FROM (
          SELECT user_id, SUM(brk) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sid FROM (
            SELECT user_id, ts, event_id,
                   CASE WHEN ts - LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 5 MINUTES
                        THEN 0 ELSE 1 END AS brk FROM ev))
        GROUP BY user_id, sid""")
    df = E.queries()["session_by_key"](spark, SF_SMALL).select("user_id", F.col("num_events").alias("n"))
    assert rows(df) == rows(sql)
