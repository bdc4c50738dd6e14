"""Registered queries of the incremental building blocks: merging distinct
counts, several reports in one pass, checks while writing, quarantine of bad
rows, run-time partition pruning, key merges behind a filter, partial states."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tripmart.functions import columns as C
from tripmart.operators import distinct as D
from tripmart.operators import materialize as M
from tripmart.operators import quality as Q
from tripmart.operators.observed import checked_write
from tripmart.operators.partials import Partials
from tripmart.operators.reports import read_report, write_grouped_reports
from tripmart.plans import marts
from tripmart.plans.queries import _STG_SQL, PAY, TRIPS, ZONES, W, _scratch, register, ts
from tripmart.plans.trips import trips
from tripmart.sources import files as FS
from tripmart.sources import quarantine as QU
from tripmart.sources.tables import table

# ------------------------------------------------ distinct counts that merge

RANGES = {"first day": (dt.date(2024, 1, 1), dt.date(2024, 1, 2)), "one week": (dt.date(2024, 1, 8), dt.date(2024, 1, 15)),
          "overlapping": (dt.date(2024, 1, 12), dt.date(2024, 1, 22)), "month": (dt.date(2024, 1, 1), dt.date(2024, 2, 1)),
          "before all": (dt.date(2023, 1, 1), dt.date(2023, 2, 1))}


@register("distinct_users_in_ranges", "\nUNION ALL\n".join(
    f"SELECT '{r}' AS range, COUNT(DISTINCT user_id) AS n_users FROM events WHERE ts >= DATE '{a}' AND ts < DATE '{b}'"
    for r, (a, b) in RANGES.items()))
def q_distinct_users_in_ranges(spark, d):
    """The day bitmaps are stored once; every range is a union of them."""
    e = table(spark, d, "events").select(F.to_date("ts").alias("day"), "user_id")
    path = _scratch(spark, "bitmaps")
    D.bitmaps(e, "user_id", ["day"]).write.partitionBy("day").parquet(path)
    return D.count_in_ranges(spark.read.parquet(path), "day", RANGES, "n_users")


@register("distinct_orders_by_month", W("""
SELECT CAST(date_trunc('month', dropoff_datetime) AS DATE) AS month, service_type, COUNT(DISTINCT orderkey) AS n_orders
FROM trips WHERE dropoff_datetime IS NOT NULL GROUP BY 1, 2""", TRIPS))
def q_distinct_orders_by_month(spark, d):
    """Month counts from day bitmaps, per service."""
    t = trips(spark, d, locations=False).where(F.col("dropoff_datetime").isNotNull())
    days = D.bitmaps(t.select(F.to_date("dropoff_datetime").alias("day"), "service_type", "orderkey"), "orderkey", ["day", "service_type"])
    path = _scratch(spark, "bitmaps")
    days.write.parquet(path)
    months = spark.read.parquet(path).withColumn("month", F.trunc("day", "month"))
    return D.count_distinct(months, ["month", "service_type"], "n_orders")


# --------------------------------------------------- reports in one pass

REPORTS = {"by_zone": ["zone"], "by_vendor_zone": ["vendor_id", "zone"]}


@register("reports_one_pass", W("""
SELECT CASE GROUPING(vendor_id) WHEN 1 THEN 'by_zone' ELSE 'by_vendor_zone' END AS report, vendor_id, zone,
       CAST(SUM(total_amount) AS DECIMAL(20,2)) AS revenue
FROM trips t JOIN zones z ON t.pickup_location_id = z.location_id
GROUP BY GROUPING SETS ((zone), (vendor_id, zone))""", TRIPS, ZONES))
def q_reports_one_pass(spark, d):
    """Both revenue reports from one scan, one join and one shuffle."""
    path = _scratch(spark, "reports")
    revenue = [F.sum("total_amount").cast("decimal(20,2)").alias("revenue")]
    write_grouped_reports(marts.revenue_base(spark, d), path, REPORTS, revenue)
    parts = [read_report(spark, path, name, REPORTS).withColumn("report", F.lit(name)) for name in REPORTS]
    return parts[0].unionByName(parts[1], allowMissingColumns=True).select("report", "vendor_id", "zone", "revenue")


# ---------------------------------------------------- checks while writing

MUST = [Q.not_null("orderkey"), Q.accepted_values("service_type", ["Green", "Yellow"]), Q.positive("trip_distance")]
SHOULD = [Q.not_null("payment_type"), Q.non_negative("trip_seconds"), Q.primary_key("orderkey", "linenumber"),
          Q.expression("tip below fare", "tip_amount * 20 < fare_amount")]


@register("checked_write", W("""
SELECT "check", "column", severity, violations, (SELECT COUNT(*) FROM trips) AS n_rows FROM (
  SELECT 'not_null' AS "check", 'orderkey' AS "column", 'error' AS severity, COUNT(*) FILTER (WHERE orderkey IS NULL) AS violations FROM trips
  UNION ALL SELECT 'accepted_values', 'service_type', 'error', COUNT(*) FILTER (WHERE service_type NOT IN ('Green', 'Yellow')) FROM trips
  UNION ALL SELECT 'positive', 'trip_distance', 'error', COUNT(*) FILTER (WHERE trip_distance <= 0) FROM trips
  UNION ALL SELECT 'not_null', 'payment_type', 'warning', COUNT(*) FILTER (WHERE payment_type IS NULL) FROM trips
  UNION ALL SELECT 'non_negative', 'trip_seconds', 'warning',
    COUNT(*) FILTER (WHERE date_diff('second', pickup_datetime, dropoff_datetime) < 0) FROM trips
  UNION ALL SELECT 'primary_key', 'orderkey,linenumber', 'warning', COUNT(*) - COUNT(DISTINCT (orderkey, linenumber)) FROM trips
  UNION ALL SELECT 'expression', 'tip below fare', 'warning', COUNT(*) FILTER (WHERE NOT coalesce(tip_amount * 20 < fare_amount, false)) FROM trips)""", TRIPS))
def q_checked_write(spark, d):
    """The trips written once, counted and guarded by the same job."""
    t = trips(spark, d, locations=False).withColumn("trip_seconds", C.seconds_between("pickup_datetime", "dropoff_datetime"))
    return checked_write(t, _scratch(spark, "checked"), MUST, SHOULD)


# ------------------------------------------------------------- quarantine

_BAD = """
bad AS (
  SELECT p_partkey, p_partkey % 11 = 0 AS fields, p_partkey % 7 = 0 AND p_partkey % 11 <> 0 AS no_size,
         p_partkey % 13 = 0 AND p_partkey % 11 <> 0 AS no_price, p_retailprice FROM part
)"""


@register("csv_quarantine", W("""
SELECT 'good' AS reason, COUNT(*) AS n, CAST(SUM(CAST(p_retailprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total
FROM bad WHERE NOT fields AND NOT no_size AND NOT no_price
UNION ALL SELECT 'number of fields', COUNT(*), NULL FROM bad WHERE fields
UNION ALL SELECT 'p_size is no int: big', COUNT(*), NULL FROM bad WHERE no_size
UNION ALL SELECT 'p_retailprice is no double: free', COUNT(*), NULL FROM bad WHERE no_price""", _BAD))
def q_csv_quarantine(spark, d):
    """The part table as CSV lines, some with a surplus field or a value of another type; good rows and rejects from one scan."""
    p = table(spark, d, "part")
    size = F.when(F.col("p_partkey") % 7 == 0, "big").otherwise(F.col("p_size").cast("string"))
    price = F.when(F.col("p_partkey") % 13 == 0, "free").otherwise(F.col("p_retailprice").cast("string"))
    line = F.to_csv(F.struct("p_partkey", "p_name", size.alias("p_size"), price.alias("p_retailprice")))
    lines, split = _scratch(spark, "csv"), _scratch(spark, "split")
    p.select(F.when(F.col("p_partkey") % 11 == 0, F.concat(line, F.lit(",more"))).otherwise(line).alias("value")).write.text(lines)
    schema = "p_partkey long, p_name string, p_size int, p_retailprice double"
    QU.write_split(QU.read_csv_marked(spark, lines, schema, header=False), split)
    ok = QU.good(spark, split).agg(F.lit("good").alias("reason"), F.count(F.lit(1)).alias("n"),
                                   F.sum(F.col("p_retailprice").cast("decimal(18,2)")).cast("decimal(38,2)").alias("total"))
    bad = (QU.rejects(spark, split).select(F.explode(QU.REASONS).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
           .withColumn("total", F.lit(None).cast("decimal(38,2)")))
    return ok.unionByName(bad)


# ----------------------------------------------- run-time partition pruning

@register("partitions_of_a_dimension", W("""
SELECT service_type, CAST(quarter(pickup_datetime) AS INTEGER) AS quarter, COUNT(*) AS n, CAST(SUM(total_amount) AS DECIMAL(38,2)) AS total
FROM trips WHERE quarter(pickup_datetime) IN (2, 3) AND year(pickup_datetime) = 1997 GROUP BY 1, 2""", TRIPS))
def q_partitions_of_a_dimension(spark, d):
    """Trips in folders of service, year and month; the months wanted come from a
    calendar that is filtered at run time."""
    root, cal = _scratch(spark, "months"), _scratch(spark, "calendar")
    t = trips(spark, d, locations=False).where(F.col("pickup_datetime").isNotNull())
    t = t.select("service_type", F.year("pickup_datetime").alias("yr"), F.month("pickup_datetime").alias("mon"), "total_amount")
    t.hint("rebalance", "service_type", "yr", "mon").write.partitionBy("service_type", "yr", "mon").parquet(root)
    o = table(spark, d, "orders").select(F.trunc("o_orderdate", "month").alias("m")).where("m IS NOT NULL").distinct()
    o.select(F.year("m").alias("yr"), F.month("m").alias("mon"), F.quarter("m").alias("quarter")).write.parquet(cal)
    wanted = spark.read.parquet(cal).where("quarter IN (2, 3) AND yr = 1997")
    got = FS.read_matching(spark, root, wanted, ["yr", "mon"])
    return got.groupBy("service_type", "quarter").agg(F.count(F.lit(1)).alias("n"), F.sum("total_amount").cast("decimal(38,2)").alias("total"))


# ------------------------------------------------ merges behind a key filter

@register("merge_small_batch", W("""
SELECT CAST(year(pickup_datetime) AS INTEGER) AS yr, COUNT(*) AS n FROM (
  SELECT pickup_datetime FROM trips WHERE orderkey % 50 <> 0
  UNION ALL
  SELECT s.pickup_datetime FROM trips s WHERE s.orderkey % 25 = 0
    AND NOT EXISTS (SELECT 1 FROM trips t WHERE t.orderkey % 50 <> 0 AND t.orderkey = s.orderkey AND t.linenumber = s.linenumber))
GROUP BY 1""", TRIPS))
def q_merge_small_batch(spark, d):
    """A batch of a twenty-fifth of the orders, half of them loaded already: the
    target is cut down to the batch's keys before it is shuffled."""
    t = trips(spark, d, locations=False).select("orderkey", "linenumber", "pickup_datetime")
    merged = M.merge_insert(t.where("orderkey % 50 <> 0"), t.where("orderkey % 25 = 0"), ["orderkey", "linenumber"], small_batch=True)
    return merged.groupBy(F.year("pickup_datetime").alias("yr")).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------- reports of partial states

def daily_partials(spark, path: str) -> Partials:
    """Mergeable states of the daily location report."""
    money = lambda c: (F.sum(c).cast("decimal(38,2)"), F.sum)
    return Partials(spark, path, {"yr": F.year("pickup_datetime"), "pickup_date": F.to_date("pickup_datetime"), "pickup_location_id": F.col("pickup_location_id")}, {
        "trips_count": (F.count(F.lit(1)), F.sum), "total_amount": money("total_amount"), "total_fare": money("fare_amount"),
        "total_tip": money(F.coalesce("tip_amount", F.lit(0))), "distance": money(F.coalesce("trip_distance", F.lit(0))),
        "passengers": (F.sum(F.coalesce("passenger_count", F.lit(0))).cast("long"), F.sum)}, ["yr"])


def finished_report(p: Partials):
    mean = lambda c: F.round(F.col(c).cast("double") / F.col("trips_count"), 4)
    return p.merged().select("pickup_date", "pickup_location_id", "trips_count", "total_amount", "total_fare", "total_tip",
                             mean("distance").alias("avg_trip_distance"), mean("passengers").alias("avg_passengers"))


@register("daily_report_from_partials", W("""
SELECT CAST(pickup_datetime AS DATE) AS pickup_date, pickup_location_id, COUNT(*) AS trips_count,
  CAST(SUM(total_amount) AS DECIMAL(38,2)) AS total_amount, CAST(SUM(fare_amount) AS DECIMAL(38,2)) AS total_fare,
  CAST(SUM(coalesce(tip_amount, 0)) AS DECIMAL(38,2)) AS total_tip,
  round(avg(coalesce(CAST(trip_distance AS DOUBLE), 0.0)), 4) AS avg_trip_distance,
  round(avg(coalesce(CAST(passenger_count AS DOUBLE), 0.0)), 4) AS avg_passengers
FROM stg GROUP BY 1, 2""", TRIPS, PAY, _STG_SQL))
def q_daily_report_from_partials(spark, d):
    """Three batches that share days, one of them loaded twice, compacted after
    the second: equal to the report over all rows at once."""
    stg = marts.stg_trips(spark, d)
    p = daily_partials(spark, _scratch(spark, "partials"))
    p.add(stg.where("vendor_id <= 2"), "first")
    p.add(stg.where("vendor_id BETWEEN 3 AND 4"), "second")
    p.compact()
    rest = stg.where("vendor_id > 4 OR vendor_id IS NULL")
    p.add(rest, "third")
    p.add(rest, "third")
    return finished_report(p)
