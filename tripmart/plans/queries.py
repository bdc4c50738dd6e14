"""Registered queries: one per operator of the inventory, each with a plain
SQL twin that a warehouse engine can run on the same tables (the oracle).

Every query reads whole driver tables (or data Spark derives from them).
Column names are identical on both sides; money stays DECIMAL, counts BIGINT.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions import columns as C
from tripmart.operators import materialize as M
from tripmart.operators import quality as Q
from tripmart.operators.dedupe import dedupe_any, dedupe_first
from tripmart.operators.joins import broadcast_if_small, not_in, role_playing
from tripmart.operators.project import fields_with_default, null_counts
from tripmart.operators.union import union_all
from tripmart.operators.windows import session_totals, tumbling
from tripmart.plans import marts
from tripmart.plans.trips import EXTRAS, PAYMENTS_SQL, TRIPS_SQL, ZONES_SQL, events, payment_lookup, trips, zones
from tripmart.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql.strip()
        return fn
    return deco


def W(body: str, *ctes: str) -> str:
    """Prefix ``body`` with the given CTE definitions."""
    return ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body


TRIPS, ZONES, PAY = TRIPS_SQL, ZONES_SQL, PAYMENTS_SQL


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def _count(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


# ============================ scans / projections ============================

@register("scan_projection", "SELECT l_orderkey, l_extendedprice FROM lineitem")
def q_scan_projection(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_extendedprice")



@register("conform_rename_cast", W("""
SELECT vendor_id, pickup_datetime, dropoff_datetime, store_and_fwd_flag, rate_code_id, pickup_location_id, dropoff_location_id, passenger_count,
       trip_distance, fare_amount, extra, mta_tax, tip_amount, tolls_amount,
       CASE WHEN service_type = 'Yellow' THEN CAST(0 AS DECIMAL(18,2)) ELSE ehail_fee END AS ehail_fee, improvement_surcharge,
       total_amount, payment_type, CASE WHEN service_type = 'Yellow' THEN 1 ELSE trip_type END AS trip_type,
       congestion_surcharge, cbd_congestion_fee, service_type, coalesce(airport_fee, CAST(0 AS DECIMAL(18,2))) AS airport_fee
FROM trips""", TRIPS))
def q_conform_rename_cast(spark, d):
    return marts.clean_all(spark, d)


_STAGED_SQL = """
SELECT vendor_id, rate_code_id, pickup_location_id, dropoff_location_id, pickup_datetime, dropoff_datetime, store_and_fwd_flag, passenger_count,
       CAST(trip_distance AS DECIMAL(38,9)) AS trip_distance, {trip_type} AS trip_type, {money},
       payment_type, CAST({ehail} AS DECIMAL(38,9)) AS ehail_fee, service_type
FROM trips WHERE service_type = '{service}'"""
_STAGED_MONEY = ", ".join(f"CAST({c} AS DECIMAL(38,9)) AS {c}" for c in (
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount"))


@register("stg_green", W(_STAGED_SQL.format(trip_type="trip_type", ehail="ehail_fee", service="Green", money=_STAGED_MONEY), TRIPS))
def q_stg_green(spark, d):
    return marts.stg_green(marts.raw_trips(spark, d, "Green"))


@register("stg_yellow", W(_STAGED_SQL.format(trip_type="1", ehail="0", service="Yellow", money=_STAGED_MONEY)
                          + " AND pickup_datetime BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1996-02-01 00:00:00'", TRIPS))
def q_stg_yellow(spark, d):
    """With the development range, which is inclusive."""
    return marts.stg_yellow(marts.raw_trips(spark, d, "Yellow"), (ts("1996-01-01"), ts("1996-02-01")))


@register("filter_not_null", W("""
SELECT CAST(vendor_id AS VARCHAR) AS dispatching_base_num, pickup_datetime, dropoff_datetime,
       pickup_location_id, dropoff_location_id, trip_type AS sr_flag,
       CAST(payment_type AS VARCHAR) AS affiliated_base_number
FROM trips WHERE payment_type IS NOT NULL""", TRIPS))
def q_filter_not_null(spark, d):
    return marts.stg_fhv(marts.raw_fhv(spark, d))


@register("filter_time_window", W("""
SELECT service_type, COUNT(*) AS trips FROM trips
WHERE pickup_datetime >= TIMESTAMP '1997-01-01 00:00:00' AND pickup_datetime < TIMESTAMP '1998-01-01 00:00:00'
GROUP BY service_type""", TRIPS))
def q_filter_time_window(spark, d):
    t = trips(spark, d, locations=False).where(M.in_window(F.col("pickup_datetime"), ts("1997-01-01"), ts("1998-01-01")))
    return t.groupBy("service_type").agg(F.count(F.lit(1)).alias("trips"))


@register("filter_between_distinct", W("""
SELECT DISTINCT vendor_id FROM trips
WHERE dropoff_datetime BETWEEN TIMESTAMP '1998-03-01 00:00:00' AND TIMESTAMP '1998-03-15 00:00:00'""", TRIPS))
def q_filter_between_distinct(spark, d):
    t = trips(spark, d, locations=False)
    return t.where(F.col("dropoff_datetime").between(ts("1998-03-01"), ts("1998-03-15"))).select("vendor_id").distinct()


@register("filter_day_of_month", W("SELECT COUNT(*) AS n FROM trips WHERE day(pickup_datetime) = 15", TRIPS))
def q_filter_day_of_month(spark, d):
    return _count(trips(spark, d, locations=False).where(F.dayofmonth("pickup_datetime") == 15))


@register("filter_years_in", W("""
SELECT service_type, COUNT(*) AS trips FROM trips WHERE year(pickup_datetime) IN (1996, 1997)
GROUP BY service_type""", TRIPS))
def q_filter_years_in(spark, d):
    t = trips(spark, d, locations=False).where(C.year_in("pickup_datetime", [1996, 1997]))
    return t.groupBy("service_type").agg(F.count(F.lit(1)).alias("trips"))


@register("null_counts", W("SELECT " + ", ".join(
    f"COUNT(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in (
        "orderkey", "linenumber", "vendor_id", "service_type", "payment_type", "trip_type", "passenger_count",
        "pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id", "trip_distance",
        "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "ehail_fee",
        "total_amount", "rate_code_id", "store_and_fwd_flag", "congestion_surcharge", "cbd_congestion_fee", "airport_fee")) + " FROM trips", TRIPS))
def q_null_counts(spark, d):
    return null_counts(trips(spark, d))


@register("keep_with_default", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       CASE WHEN json_exists(props, '$.brand') THEN json_extract_string(props, '$.brand') ELSE 'N/A' END AS brand
FROM events""")
def q_keep_with_default(spark, d):
    docs = events(spark, d).select("event_id", F.from_json("props", "map<string,string>").alias("m"))
    k, brand = fields_with_default("m", ["k", "brand"], "N/A")
    return docs.select("event_id", k.cast("long").alias("k"), brand.alias("brand"))


# ================================ counts =====================================

@register("count_all", "SELECT COUNT(*) AS n FROM lineitem")
def q_count_all(spark, d):
    return _count(table(spark, d, "lineitem"))


@register("count_zero", "SELECT COUNT(*) AS n FROM lineitem WHERE l_discount = 0")
def q_count_zero(spark, d):
    return _count(table(spark, d, "lineitem").where(F.col("l_discount") == 0))


@register("count_gt", "SELECT COUNT(*) AS n FROM events WHERE value > 5")
def q_count_gt(spark, d):
    return _count(events(spark, d).where(F.col("value") > 5))


@register("count_short", W("""
SELECT COUNT(*) AS n FROM trips
WHERE pickup_datetime >= TIMESTAMP '1997-01-01 00:00:00' AND dropoff_datetime < TIMESTAMP '1998-01-01 00:00:00'
  AND trip_distance <= 1""", TRIPS))
def q_count_short(spark, d):
    t = trips(spark, d, locations=False)
    return _count(t.where((F.col("pickup_datetime") >= ts("1997-01-01")) & (F.col("dropoff_datetime") < ts("1998-01-01"))
                          & (F.col("trip_distance") <= 1)))


@register("count_distinct", "SELECT COUNT(DISTINCT l_suppkey) AS n FROM lineitem")
def q_count_distinct(spark, d):
    return table(spark, d, "lineitem").agg(F.count_distinct("l_suppkey").alias("n"))


# ============================== JSON / time ==================================

@register("json_extract_avg", """
SELECT event_type, round(avg(CAST(json_extract(props, '$.k') AS DOUBLE)), 2) AS avg_k
FROM events GROUP BY event_type""")
def q_json_extract_avg(spark, d):
    e = events(spark, d).select("event_type", F.from_json("props", "k double").alias("p"))
    return e.groupBy("event_type").agg(F.round(F.avg("p.k"), 2).alias("avg_k"))


@register("avg_price_by_brand", """
SELECT p_brand AS brand, round(avg(p_retailprice), 2) AS avg_price FROM part GROUP BY p_brand""")
def q_avg_price_by_brand(spark, d):
    p = table(spark, d, "part")
    return p.groupBy(F.col("p_brand").alias("brand")).agg(F.round(F.avg("p_retailprice"), 2).alias("avg_price"))


@register("json_roundtrip", "SELECT event_id, ts, user_id, event_type, value FROM events")
def q_json_roundtrip(spark, d):
    e = events(spark, d)
    cols = ["event_id", "ts", "user_id", "event_type", "value"]
    msg = e.select(C.to_json_text(cols).alias("value_json"))
    schema = e.select(*cols).schema
    return msg.select(C.from_json_text("value_json", schema).alias("r")).select("r.*")


@register("epoch_millis_roundtrip", """
SELECT event_id, CAST(floor(epoch_us(ts) / 1000) AS BIGINT) AS ms,
       make_timestamp(CAST(floor(epoch_us(ts) / 1000) AS BIGINT) * 1000) AS ts_ms FROM events""")
def q_epoch_millis_roundtrip(spark, d):
    e = events(spark, d).select("event_id", C.to_epoch_millis("ts").alias("ms"))
    return e.select("event_id", "ms", C.from_epoch_millis("ms").alias("ts_ms"))


@register("parse_ts_string", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text,
       strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS parsed FROM events""")
def q_parse_ts_string(spark, d):
    e = events(spark, d).select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts_text"))
    return e.select("event_id", "ts_text", C.parse_timestamp("ts_text").alias("parsed"))


# ============================ keys and macros ================================

_ROW7 = ["vendor_id", "pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id",
         "fare_amount", "trip_distance"]
_ROW5 = _ROW7[:5]


def _sql_row_id(cols):
    return "md5(" + " || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols) + ")"


@register("row_id", W(f"""
SELECT orderkey, linenumber, {_sql_row_id(_ROW7)} AS row_id7, {_sql_row_id(_ROW5)} AS row_id5 FROM trips""", TRIPS))
def q_row_id(spark, d):
    t = trips(spark, d)
    return t.select("orderkey", "linenumber", C.row_id(*_ROW7).alias("row_id7"), C.row_id(*_ROW5).alias("row_id5"))


_SK = ["vendor_id", "pickup_datetime", "pickup_location_id", "service_type", "payment_type"]


@register("surrogate_key", W("SELECT orderkey, linenumber, md5(concat_ws('-', " + ", ".join(
    f"coalesce(CAST({c} AS VARCHAR), '{C.SURROGATE_NULL_TOKEN}')" for c in _SK) + ")) AS trip_id FROM trips", TRIPS))
def q_surrogate_key(spark, d):
    return trips(spark, d, locations=("pickup",)).select("orderkey", "linenumber", C.surrogate_key(*_SK).alias("trip_id"))


@register("cents_to_dollars", W("""
SELECT orderkey, linenumber, CAST(round(total_amount * 0.01, 2) AS DECIMAL(16,2)) AS total_dollars FROM trips""", TRIPS))
def q_cents_to_dollars(spark, d):
    return trips(spark, d, locations=False).select("orderkey", "linenumber",
                                                   C.cents_to_dollars("total_amount").alias("total_dollars"))


@register("trip_duration", W("""
SELECT orderkey, linenumber, date_diff('second', pickup_datetime, dropoff_datetime) AS trip_seconds,
       CAST(date_diff('second', pickup_datetime, dropoff_datetime) / 60.0 AS DECIMAL(18,4)) AS trip_minutes
FROM trips""", TRIPS))
def q_trip_duration(spark, d):
    t = trips(spark, d, locations=False)
    return t.select("orderkey", "linenumber",
                    C.seconds_between("pickup_datetime", "dropoff_datetime").alias("trip_seconds"),
                    C.minutes_between("pickup_datetime", "dropoff_datetime").alias("trip_minutes"))


@register("longest_trip", W("""
SELECT orderkey, linenumber, pickup_datetime, dropoff_datetime,
       CAST(date_diff('microsecond', pickup_datetime, dropoff_datetime) / 3600000000.0 AS DECIMAL(18,4)) AS trip_hours
FROM trips ORDER BY trip_hours DESC, orderkey, linenumber LIMIT 1""", TRIPS))
def q_longest_trip(spark, d):
    t = trips(spark, d, locations=False).select(
        "orderkey", "linenumber", "pickup_datetime", "dropoff_datetime",
        C.hours_between("pickup_datetime", "dropoff_datetime").alias("trip_hours"))
    return t.orderBy(F.desc("trip_hours"), "orderkey", "linenumber").limit(1)


@register("validity_flag", W("""
SELECT CASE WHEN pickup_datetime IS NULL OR dropoff_datetime IS NULL THEN false
            WHEN date_diff('second', pickup_datetime, dropoff_datetime) <= 0 THEN false
            WHEN coalesce(trip_distance, 0) <= 0 THEN false ELSE true END AS is_valid,
       COUNT(*) AS n
FROM trips GROUP BY 1""", TRIPS))
def q_validity_flag(spark, d):
    t = trips(spark, d, locations=False)
    return (t.groupBy(C.is_valid_trip("pickup_datetime", "dropoff_datetime", "trip_distance").alias("is_valid"))
             .agg(F.count(F.lit(1)).alias("n")))


@register("period_name", W("""
SELECT lower(service_type) || '_tripdata_' || strftime(pickup_datetime, '%Y-%m') AS period, COUNT(*) AS n
FROM trips GROUP BY 1""", TRIPS))
def q_period_name(spark, d):
    t = trips(spark, d, locations=False)
    return t.groupBy(C.period_name("service_type", "pickup_datetime").alias("period")).agg(F.count(F.lit(1)).alias("n"))


# ================================== joins ====================================

_LOC_SQL = """
SELECT t.orderkey, t.linenumber,
       concat_ws('', pz.borough, ' / ', pz.zone) AS pickup_loc,
       concat_ws('', dz.borough, ' / ', dz.zone) AS dropoff_loc
FROM trips t{join}"""


@register("join_implicit", W(_LOC_SQL.format(
    join=", zones pz, zones dz WHERE t.pickup_location_id = pz.location_id AND t.dropoff_location_id = dz.location_id"),
    TRIPS, ZONES))
def q_join_implicit(spark, d):
    # comma join + WHERE: the planner turns the predicates into equi-join keys
    t = trips(spark, d).alias("t")
    z = broadcast_if_small(zones(spark, d))
    pz, dz = z.alias("pz"), z.alias("dz")
    j = t.join(pz).join(dz).where((F.col("t.pickup_location_id") == F.col("pz.location_id"))
                                  & (F.col("t.dropoff_location_id") == F.col("dz.location_id")))
    return j.select("t.orderkey", "t.linenumber",
                    C.concat_skip_null("pz.borough", F.lit(" / "), "pz.zone").alias("pickup_loc"),
                    C.concat_skip_null("dz.borough", F.lit(" / "), "dz.zone").alias("dropoff_loc"))


@register("join_role_playing", W(_LOC_SQL.format(
    join=" JOIN zones pz ON t.pickup_location_id = pz.location_id JOIN zones dz ON t.dropoff_location_id = dz.location_id"),
    TRIPS, ZONES))
def q_join_role_playing(spark, d):
    f = role_playing(trips(spark, d), zones(spark, d), "location_id",
                     {"pickup": "pickup_location_id", "dropoff": "dropoff_location_id"}, ["zone", "borough"],
                     how="inner")
    return f.select("orderkey", "linenumber",
                    C.concat_skip_null("pickup_borough", F.lit(" / "), "pickup_zone").alias("pickup_loc"),
                    C.concat_skip_null("dropoff_borough", F.lit(" / "), "dropoff_zone").alias("dropoff_loc"))


@register("left_join_coalesce_key", W("""
SELECT p.payment_type_name, COUNT(*) AS n FROM trips t
LEFT JOIN payment_lookup p ON coalesce(t.payment_type, 5) = p.payment_type_id GROUP BY 1""", TRIPS, PAY))
def q_left_join_coalesce_key(spark, d):
    t = trips(spark, d, locations=False).withColumn("__pk", F.coalesce("payment_type", F.lit(5)))
    p = F.broadcast(payment_lookup(spark))
    j = t.join(p, t["__pk"] == p["payment_type_id"], "left")
    return j.groupBy("payment_type_name").agg(F.count(F.lit(1)).alias("n"))


@register("stg_trips_lookup", W("""
SELECT p.payment_type_name, COUNT(*) AS n FROM trips t
JOIN payment_lookup p ON t.payment_type = p.payment_type_id GROUP BY 1""", TRIPS, PAY))
def q_stg_trips_lookup(spark, d):
    t = trips(spark, d, locations=False)
    p = F.broadcast(payment_lookup(spark))
    return (t.join(p, t.payment_type == p.payment_type_id, "inner")
             .groupBy("payment_type_name").agg(F.count(F.lit(1)).alias("n")))


@register("orphan_keys", """
SELECT COUNT(*) AS n FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer)""")
def q_orphan_keys(spark, d):
    return _count(not_in(table(spark, d, "events").select("user_id"), "user_id", table(spark, d, "customer"), "c_custkey"))


def _pickup_zone_trips(spark, d):
    t = trips(spark, d, locations=("pickup",))
    z = broadcast_if_small(zones(spark, d).select("location_id", "zone"))
    return t.join(z, t.pickup_location_id == z.location_id, "inner")


@register("least_frequent_zone", W("""
SELECT z.zone, COUNT(*) AS n FROM trips t JOIN zones z ON t.pickup_location_id = z.location_id
GROUP BY z.zone ORDER BY n, z.zone LIMIT 1""", TRIPS, ZONES))
def q_least_frequent_zone(spark, d):
    return (_pickup_zone_trips(spark, d).groupBy("zone").agg(F.count(F.lit(1)).alias("n"))
            .orderBy("n", "zone").limit(1))


_REV_BASE = """
revbase AS (
  SELECT t.vendor_id, z.zone, t.total_amount FROM trips t JOIN zones z ON t.pickup_location_id = z.location_id
)"""


@register("revenue_by_zone", W("""
SELECT zone, CAST(SUM(total_amount) AS DECIMAL(20,2)) AS revenue FROM revbase GROUP BY zone
ORDER BY revenue DESC, zone""", TRIPS, ZONES, _REV_BASE))
def q_revenue_by_zone(spark, d):
    return marts.revenue_by_zone(marts.revenue_base(spark, d))


@register("revenue_by_vendor_zone", W("""
SELECT vendor_id, zone, CAST(SUM(total_amount) AS DECIMAL(20,2)) AS revenue FROM revbase GROUP BY vendor_id, zone
ORDER BY vendor_id, revenue DESC, zone""", TRIPS, ZONES, _REV_BASE))
def q_revenue_by_vendor_zone(spark, d):
    return marts.revenue_by_vendor_zone(marts.revenue_base(spark, d))


@register("topn_join_on_day", W("""
SELECT z.zone, CAST(SUM(t.total_amount) AS DECIMAL(20,2)) AS revenue
FROM trips t JOIN zones z ON t.pickup_location_id = z.location_id
WHERE CAST(t.pickup_datetime AS DATE) = DATE '1997-06-15'
GROUP BY z.zone ORDER BY revenue DESC, z.zone""", TRIPS, ZONES))
def q_topn_join_on_day(spark, d):
    # date equality written as a half-open range so it reaches the scan
    t = _pickup_zone_trips(spark, d).where(M.in_window(F.col("pickup_datetime"), ts("1997-06-15"), ts("1997-06-16")))
    return (t.groupBy("zone").agg(F.sum("total_amount").cast("decimal(20,2)").alias("revenue"))
             .orderBy(F.desc("revenue"), "zone"))


@register("max_tip_by_dropoff", W("""
SELECT dz.zone AS dropoff_zone, MAX(t.tip_amount) AS max_tip
FROM trips t JOIN zones pz ON t.pickup_location_id = pz.location_id
JOIN zones dz ON t.dropoff_location_id = dz.location_id
WHERE pz.zone = 'NATION_1' GROUP BY dz.zone ORDER BY max_tip DESC, dropoff_zone""", TRIPS, ZONES))
def q_max_tip_by_dropoff(spark, d):
    f = role_playing(trips(spark, d), zones(spark, d), "location_id",
                     {"pickup": "pickup_location_id", "dropoff": "dropoff_location_id"}, ["zone"], how="inner")
    return (f.where(F.col("pickup_zone") == "NATION_1").groupBy("dropoff_zone")
             .agg(F.max("tip_amount").alias("max_tip")).orderBy(F.desc("max_tip"), "dropoff_zone"))


# =============================== aggregates ==================================

@register("daily_stats", W("""
SELECT CAST(dropoff_datetime AS DATE) AS day, COUNT(*) AS n, MAX(total_amount) AS max_total,
       MAX(trip_distance) AS max_distance FROM trips GROUP BY 1 ORDER BY 1""", TRIPS))
def q_daily_stats(spark, d):
    t = trips(spark, d, locations=False)
    return (t.groupBy(F.to_date("dropoff_datetime").alias("day"))
             .agg(F.count(F.lit(1)).alias("n"), F.max("total_amount").alias("max_total"),
                  F.max("trip_distance").alias("max_distance")).orderBy("day"))


@register("daily_max", W("""
SELECT CAST(pickup_datetime AS DATE) AS day, MAX(trip_distance) AS max_distance FROM trips
WHERE trip_distance < 50 GROUP BY 1 ORDER BY 1""", TRIPS))
def q_daily_max(spark, d):
    t = trips(spark, d, locations=False).where(F.col("trip_distance") < 50)
    return t.groupBy(F.to_date("pickup_datetime").alias("day")).agg(F.max("trip_distance").alias("max_distance")).orderBy("day")


_INT_TRIPS_SQL = """
trips_c AS (SELECT * REPLACE ({cents}) FROM trips),
int_trips AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, md5(concat_ws('-', {key})) AS trip_id,
      CASE payment_type {pay} ELSE 'Unknown' END AS payment_description,
      CAST(date_diff('second', pickup_datetime, dropoff_datetime) / 60.0 AS DECIMAL(18,4)) AS trip_duration_minutes,
      row_number() OVER (PARTITION BY {keys} ORDER BY dropoff_datetime NULLS FIRST, {rest}) AS rn
    FROM trips_c) WHERE rn = 1
)""".format(key=", ".join(f"coalesce(CAST({c} AS VARCHAR), '{C.SURROGATE_NULL_TOKEN}')" for c in marts.TRIP_KEYS),
            keys=", ".join(marts.TRIP_KEYS),
            cents=", ".join(f"CAST({c} * 0.01 AS DECIMAL(16,2)) AS {c}" for c in marts.CENTS_COLUMNS),
            pay=" ".join(f"WHEN {k} THEN '{v}'" for k, v in sorted(C.PAYMENT_LABELS.items())),
            rest=", ".join(f"{c} NULLS FIRST" for c in (
                "orderkey", "linenumber", "payment_type", "trip_type", "passenger_count",
                "dropoff_location_id", "trip_distance", "fare_amount", "extra", "mta_tax",
                "tip_amount", "tolls_amount", "improvement_surcharge", "ehail_fee", "total_amount")))

_FCT_SQL = """
fct AS (
  SELECT t.trip_id, t.vendor_id, t.service_type, t.rate_code_id, t.pickup_location_id, pz.borough AS pickup_borough, pz.zone AS pickup_zone,
    t.dropoff_location_id, dz.borough AS dropoff_borough, dz.zone AS dropoff_zone, t.pickup_datetime, t.dropoff_datetime,
    t.store_and_fwd_flag, t.passenger_count, t.trip_distance, t.trip_type, t.trip_duration_minutes, t.fare_amount, t.extra, t.mta_tax,
    t.tip_amount, t.tolls_amount, t.ehail_fee, t.improvement_surcharge, t.total_amount, t.payment_type,
    t.payment_description
  FROM int_trips t LEFT JOIN zones pz ON t.pickup_location_id = pz.location_id
  LEFT JOIN zones dz ON t.dropoff_location_id = dz.location_id
)"""

_MONTHLY_SQL = """
monthly AS (
  SELECT coalesce(pickup_zone, 'Unknown Zone') AS pickup_zone,
    CAST(date_trunc('month', pickup_datetime) AS DATE) AS revenue_month, service_type,
    {sums},
    COUNT(trip_id) AS total_monthly_trips,
    round(avg(CAST(passenger_count AS DOUBLE)), 4) AS avg_monthly_passenger_count,
    round(avg(CAST(trip_distance AS DOUBLE)), 4) AS avg_monthly_trip_distance
  FROM fct GROUP BY 1, 2, 3
)""".format(sums=", ".join(f"CAST(SUM({c}) AS DECIMAL(38,2)) AS {a}" for c, a in marts.MONTHLY_SUMS))


@register("fct_trips", W("SELECT * FROM fct", TRIPS, ZONES, _INT_TRIPS_SQL, _FCT_SQL))
def q_fct_trips(spark, d):
    return marts.fct_trips(trips(spark, d), zones(spark, d))


@register("monthly_zone_revenue", W("SELECT * FROM monthly", TRIPS, ZONES, _INT_TRIPS_SQL, _FCT_SQL, _MONTHLY_SQL))
def q_monthly_zone_revenue(spark, d):
    return marts.monthly_zone_revenue(marts.fct_trips(trips(spark, d), zones(spark, d)))


@register("rollup_of_report", W("""
SELECT pickup_zone, CAST(SUM(coalesce(revenue_monthly_total_amount, 0)) AS DECIMAL(38,2)) AS revenue FROM monthly
WHERE service_type = 'Green' AND year(revenue_month) = 1997
GROUP BY pickup_zone ORDER BY revenue DESC, pickup_zone LIMIT 1""", TRIPS, ZONES, _INT_TRIPS_SQL, _FCT_SQL, _MONTHLY_SQL))
def q_rollup_of_report(spark, d):
    # pickup time and service are part of the trip key: the filter goes below the
    # de-duplication, to the scans, without changing the report
    t = trips(spark, d, services=("Green",)).where(M.in_window(F.col("pickup_datetime"), ts("1997-01-01"), ts("1998-01-01")))
    m = marts.monthly_zone_revenue(marts.fct_trips(t, zones(spark, d)))
    return (m.groupBy("pickup_zone")
             .agg(F.sum(F.coalesce("revenue_monthly_total_amount", F.lit(0))).cast("decimal(38,2)").alias("revenue"))
             .orderBy(F.desc("revenue"), "pickup_zone").limit(1))


_STG_SQL = """
stg AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT t.*, p.payment_type_name,
      row_number() OVER (PARTITION BY vendor_id, pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id
                         ORDER BY {rest}) AS rn
    FROM trips t JOIN payment_lookup p ON t.payment_type = p.payment_type_id) WHERE rn = 1
)""".format(rest=", ".join(f"{c} NULLS FIRST" for c in (
    "orderkey", "linenumber", "service_type", "payment_type", "trip_type", "passenger_count", "trip_distance",
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "ehail_fee",
    "total_amount", "payment_type_name")))


@register("daily_location_report", W("""
SELECT CAST(pickup_datetime AS DATE) AS pickup_date, pickup_location_id, COUNT(*) AS trips_count,
  CAST(SUM(total_amount) AS DECIMAL(38,2)) AS total_amount, CAST(SUM(fare_amount) AS DECIMAL(38,2)) AS total_fare,
  CAST(SUM(coalesce(tip_amount, 0)) AS DECIMAL(38,2)) AS total_tip,
  round(avg(coalesce(CAST(trip_distance AS DOUBLE), 0.0)), 4) AS avg_trip_distance,
  round(avg(coalesce(CAST(passenger_count AS DOUBLE), 0.0)), 4) AS avg_passengers
FROM stg GROUP BY 1, 2""", TRIPS, PAY, _STG_SQL))
def q_daily_location_report(spark, d):
    return marts.daily_location_report(marts.stg_trips(spark, d))


@register("daily_service_payment", W("""
SELECT CAST(pickup_datetime AS DATE) AS pickup_date, service_type, payment_type, COUNT(*) AS trips_count,
  CAST(SUM(total_amount) AS DECIMAL(38,2)) AS total_amount
FROM trips GROUP BY 1, 2, 3""", TRIPS))
def q_daily_service_payment(spark, d):
    t = trips(spark, d, locations=False)
    return (t.groupBy(F.col("pickup_datetime").cast("date").alias("pickup_date"), "service_type", "payment_type")
             .agg(F.count(F.lit(1)).alias("trips_count"), F.sum("total_amount").cast("decimal(38,2)").alias("total_amount")))


@register("dim_vendors", W("""
SELECT DISTINCT vendor_id, CASE vendor_id {v} END AS vendor_name FROM trips""".format(
    v=" ".join(f"WHEN {k} THEN '{n}'" for k, n in sorted(C.VENDOR_LABELS.items()))), TRIPS))
def q_dim_vendors(spark, d):
    return trips(spark, d, locations=False).select("vendor_id", C.vendor_name("vendor_id").alias("vendor_name")).distinct()


@register("dim_payments", W("""
SELECT DISTINCT payment_type, CASE payment_type {p} ELSE 'Unknown' END AS payment_description FROM trips""".format(
    p=" ".join(f"WHEN {k} THEN '{n}'" for k, n in sorted(C.PAYMENT_LABELS.items()))), TRIPS))
def q_dim_payments(spark, d):
    t = trips(spark, d, locations=False)
    return t.select("payment_type", C.payment_description("payment_type").alias("payment_description")).distinct()


@register("date_bounds", W("""
SELECT CAST(MIN(pickup_datetime) AS DATE) AS min_date, CAST(MAX(pickup_datetime) AS DATE) AS max_date FROM trips""", TRIPS))
def q_date_bounds(spark, d):
    t = trips(spark, d, locations=False)
    return t.agg(F.min("pickup_datetime").cast("date").alias("min_date"), F.max("pickup_datetime").cast("date").alias("max_date"))


@register("payment_share", W("""
SELECT CAST(round(100.0 * SUM(CASE WHEN payment_type = 1 THEN 1 ELSE 0 END) / COUNT(*), 2) AS DECIMAL(10,2)) AS card_share_pct
FROM trips""", TRIPS))
def q_payment_share(spark, d):
    t = trips(spark, d, locations=False)
    n1 = F.sum(F.when(F.col("payment_type") == 1, 1).otherwise(0)).cast("decimal(38,0)")
    return t.agg(F.round(n1 * 100 / F.count(F.lit(1)), 2).cast("decimal(10,2)").alias("card_share_pct"))


@register("total_tips", W("SELECT CAST(SUM(tip_amount) AS DECIMAL(38,2)) AS total_tips FROM trips", TRIPS))
def q_total_tips(spark, d):
    return trips(spark, d, locations=False).agg(F.sum("tip_amount").cast("decimal(38,2)").alias("total_tips"))


# ================================ windows ====================================

_T_COLS = ["orderkey", "linenumber", "vendor_id", "service_type", "payment_type", "trip_type", "passenger_count",
           "pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id", "trip_distance",
           "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "ehail_fee",
           "total_amount"]


def _order_sql(cols):
    return ", ".join(f"{c} NULLS FIRST" for c in cols)


@register("dedupe_first", W("""
SELECT * EXCLUDE (rn, {x}) FROM (
  SELECT *, row_number() OVER (PARTITION BY orderkey, linenumber ORDER BY dropoff_datetime NULLS FIRST, {o}) AS rn
  FROM trips) WHERE rn = 1""".format(o=_order_sql([c for c in _T_COLS if c not in ("orderkey", "linenumber", "dropoff_datetime")]), x=", ".join(EXTRAS)),
    TRIPS))
def q_dedupe_first(spark, d):
    return dedupe_first(trips(spark, d, extras=False), ["orderkey", "linenumber"], ["dropoff_datetime"])


_DA_KEYS = ["vendor_id", "pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id"]


@register("dedupe_any", W("""
SELECT * EXCLUDE (rn, {x}) FROM (
  SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY {o}) AS rn FROM trips) WHERE rn = 1""".format(
    k=", ".join(_DA_KEYS), o=_order_sql([c for c in _T_COLS if c not in _DA_KEYS]), x=", ".join(EXTRAS)), TRIPS))
def q_dedupe_any(spark, d):
    return dedupe_any(trips(spark, d, extras=False), _DA_KEYS)


# ================================ set ops ====================================

@register("union_services", W("""
SELECT service_type, COUNT(*) AS n, CAST(SUM(total_amount) AS DECIMAL(38,2)) AS total FROM trips GROUP BY 1""", TRIPS))
def q_union_services(spark, d):
    g = trips(spark, d, locations=False, services=("Green",)).select("service_type", "total_amount", "vendor_id")
    y = trips(spark, d, locations=False, services=("Yellow",)).select("vendor_id", "total_amount", "service_type")
    u = union_all([g, y])  # by name: column order differs between the sides
    return u.groupBy("service_type").agg(F.count(F.lit(1)).alias("n"), F.sum("total_amount").cast("decimal(38,2)").alias("total"))


@register("union_ragged", W("""
SELECT service_type, COUNT(*) AS n, COUNT(CASE WHEN service_type = 'Green' THEN 1 END) AS n_with_ehail_column,
       CAST(SUM(total_amount) AS DECIMAL(38,2)) AS total FROM trips GROUP BY 1""", TRIPS))
def q_union_ragged(spark, d):
    g = trips(spark, d, locations=False, services=("Green",)).select(
        "service_type", "total_amount", F.lit(0).cast("decimal(18,2)").alias("ehail_fee"))
    y = trips(spark, d, locations=False, services=("Yellow",)).select("service_type", "total_amount")
    u = union_all([g, y], allow_missing=True)
    return u.groupBy("service_type").agg(F.count(F.lit(1)).alias("n"),
                                         F.count("ehail_fee").alias("n_with_ehail_column"),
                                         F.sum("total_amount").cast("decimal(38,2)").alias("total"))


# ============================ materializations ===============================

def _agg_cs(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum("total_amount").cast("decimal(38,2)").alias("total"))


_T96 = "pickup_datetime < TIMESTAMP '1997-01-01 00:00:00'"


@register("mat_append", W("""
SELECT COUNT(*) AS n, CAST(SUM(total_amount) AS DECIMAL(38,2)) AS total FROM trips""", TRIPS))
def q_mat_append(spark, d):
    # everything before 1996, then everything else (rows without a time too) appended
    t = trips(spark, d, locations=False)
    old = F.col("pickup_datetime") < ts("1996-01-01")
    return _agg_cs(M.append(t.where(old), t.where((F.col("pickup_datetime") >= ts("1996-01-01")) | F.col("pickup_datetime").isNull())))


@register("merge_insert_only", W(f"""
SELECT COUNT(*) AS n, CAST(SUM(total_amount) AS DECIMAL(38,2)) AS total FROM (
  SELECT orderkey, linenumber, total_amount FROM trips WHERE {_T96}
  UNION ALL
  SELECT s.orderkey, s.linenumber, s.total_amount FROM trips s
  WHERE s.pickup_datetime >= TIMESTAMP '1996-01-01 00:00:00'
    AND NOT EXISTS (SELECT 1 FROM trips t WHERE t.{_T96} AND t.orderkey = s.orderkey AND t.linenumber = s.linenumber))""",
    TRIPS))
def q_merge_insert_only(spark, d):
    t = trips(spark, d, locations=False).select("orderkey", "linenumber", "pickup_datetime", "total_amount")
    target = t.where(F.col("pickup_datetime") < ts("1997-01-01"))
    source = t.where(F.col("pickup_datetime") >= ts("1996-01-01"))
    return _agg_cs(M.merge_insert(target, source, ["orderkey", "linenumber"]))


_DEDUP_T = """
dt AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT orderkey, linenumber, pickup_datetime, total_amount,
      row_number() OVER (PARTITION BY orderkey, linenumber ORDER BY pickup_datetime NULLS FIRST, total_amount NULLS FIRST) AS rn
    FROM trips) WHERE rn = 1
)"""


@register("merge_upsert", W(f"""
SELECT CAST(year(pickup_datetime) AS INTEGER) AS yr, COUNT(*) AS n, CAST(SUM(total_amount) AS DECIMAL(38,2)) AS total,
       COUNT(tag) AS n_tagged FROM (
  SELECT t.orderkey, t.linenumber, t.pickup_datetime, t.total_amount, CAST(NULL AS VARCHAR) AS tag FROM dt t
  WHERE t.{_T96} AND NOT EXISTS (SELECT 1 FROM dt s WHERE s.pickup_datetime >= TIMESTAMP '1996-01-01 00:00:00'
                                 AND s.orderkey = t.orderkey AND s.linenumber = t.linenumber)
  UNION ALL
  SELECT orderkey, linenumber, pickup_datetime, CAST(total_amount * 2 AS DECIMAL(18,2)), 'v2' FROM dt
  WHERE pickup_datetime >= TIMESTAMP '1996-01-01 00:00:00')
GROUP BY 1""", TRIPS, _DEDUP_T))
def q_merge_upsert(spark, d):
    t = trips(spark, d, locations=False).select("orderkey", "linenumber", "pickup_datetime", "total_amount")
    t = dedupe_first(t, ["orderkey", "linenumber"], ["pickup_datetime"])
    target = t.where(F.col("pickup_datetime") < ts("1997-01-01"))
    source = (t.where(F.col("pickup_datetime") >= ts("1996-01-01"))
               .withColumn("total_amount", (F.col("total_amount") * 2).cast("decimal(18,2)"))
               .withColumn("tag", F.lit("v2")))
    m = M.merge_upsert(target, source, ["orderkey", "linenumber"], add_columns=True)
    return (m.groupBy(F.year("pickup_datetime").alias("yr"))
             .agg(F.count(F.lit(1)).alias("n"), F.sum("total_amount").cast("decimal(38,2)").alias("total"),
                  F.count("tag").alias("n_tagged")))


@register("incremental_high_water", W(f"""
SELECT COUNT(*) AS n, CAST(SUM(total_amount) AS DECIMAL(38,2)) AS total FROM trips
WHERE pickup_datetime > (SELECT MAX(pickup_datetime) FROM trips WHERE {_T96})""", TRIPS))
def q_incremental_high_water(spark, d):
    t = trips(spark, d, locations=False)
    target = t.where(F.col("pickup_datetime") < ts("1997-01-01"))
    return _agg_cs(M.high_water_filter(t, target, "pickup_datetime"))


@register("replace_interval", W("""
SELECT CAST(year(pickup_datetime) AS INTEGER) AS yr, COUNT(*) AS n, CAST(SUM(total_amount) AS DECIMAL(38,2)) AS total FROM (
  SELECT pickup_datetime, total_amount FROM trips
  WHERE NOT (pickup_datetime >= TIMESTAMP '1997-01-01 00:00:00' AND pickup_datetime < TIMESTAMP '1998-01-01 00:00:00')
  UNION ALL
  SELECT pickup_datetime, CAST(total_amount * 2 AS DECIMAL(18,2)) FROM trips
  WHERE pickup_datetime >= TIMESTAMP '1997-01-01 00:00:00' AND pickup_datetime < TIMESTAMP '1998-01-01 00:00:00')
GROUP BY 1""", TRIPS))
def q_replace_interval(spark, d):
    t = trips(spark, d, locations=False).select("pickup_datetime", "total_amount")
    src = t.withColumn("total_amount", (F.col("total_amount") * 2).cast("decimal(18,2)"))
    r = M.replace_interval(t, src, "pickup_datetime", ts("1997-01-01"), ts("1998-01-01"))
    return (r.groupBy(F.year("pickup_datetime").alias("yr"))
             .agg(F.count(F.lit(1)).alias("n"), F.sum("total_amount").cast("decimal(38,2)").alias("total")))


@register("delete_insert", W("""
SELECT pickup_location_id, COUNT(*) AS n, CAST(SUM(total_amount) AS DECIMAL(38,2)) AS total FROM (
  SELECT pickup_location_id, total_amount FROM trips
  WHERE pickup_location_id NOT IN (SELECT DISTINCT pickup_location_id FROM trips
      WHERE pickup_datetime >= TIMESTAMP '1997-01-01 00:00:00' AND pickup_datetime < TIMESTAMP '1998-01-01 00:00:00'
        AND pickup_location_id IS NOT NULL)
  UNION ALL
  SELECT pickup_location_id, CAST(total_amount * 2 AS DECIMAL(18,2)) FROM trips
  WHERE pickup_datetime >= TIMESTAMP '1997-01-01 00:00:00' AND pickup_datetime < TIMESTAMP '1998-01-01 00:00:00')
GROUP BY 1""", TRIPS))
def q_delete_insert(spark, d):
    t = trips(spark, d, locations=("pickup",)).select("pickup_location_id", "pickup_datetime", "total_amount")
    src = (t.where(M.in_window(F.col("pickup_datetime"), ts("1997-01-01"), ts("1998-01-01")))
            .withColumn("total_amount", (F.col("total_amount") * 2).cast("decimal(18,2)")))
    r = M.delete_insert(t, src, ["pickup_location_id"])
    return (r.groupBy("pickup_location_id")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("total_amount").cast("decimal(38,2)").alias("total")))


@register("backfill_months", W("""
SELECT CAST(date_trunc('month', pickup_datetime) AS DATE) AS month, COUNT(*) AS n FROM trips
WHERE pickup_datetime >= TIMESTAMP '1997-11-01 00:00:00' AND pickup_datetime < TIMESTAMP '1998-03-01 00:00:00'
GROUP BY 1""", TRIPS))
def q_backfill_months(spark, d):
    from tripmart.sources.files import month_range
    months = month_range(dt.date(1997, 11, 1), dt.date(1998, 2, 1))  # end month inclusive, crosses New Year
    t = trips(spark, d, locations=False)
    lo, hi = months[0], months[-1]
    hi_excl = dt.datetime(hi.year + (hi.month == 12), hi.month % 12 + 1, 1)
    t = t.where(M.in_window(F.col("pickup_datetime"), dt.datetime(lo.year, lo.month, 1), hi_excl))
    return t.groupBy(C.month_start("pickup_datetime").alias("month")).agg(F.count(F.lit(1)).alias("n"))


@register("partition_prune_distinct", W("""
SELECT DISTINCT vendor_id FROM trips
WHERE dropoff_datetime >= TIMESTAMP '1998-03-01 00:00:00' AND dropoff_datetime < TIMESTAMP '1998-03-16 00:00:00'""", TRIPS))
def q_partition_prune_distinct(spark, d):
    """Write a copy partitioned by dropoff date and clustered by vendor, then
    read a time range: the reader derives the dates, so only their folders are opened."""
    from tripmart.operators.table_store import write_partitioned
    from tripmart.sources.files import read_time_range
    path = _scratch(spark, "partitioned")
    write_partitioned(trips(spark, d, locations=False), path, "dropoff_date", "dropoff_datetime", ["vendor_id"])
    p = read_time_range(spark, path, "dropoff_datetime", ts("1998-03-01"), ts("1998-03-16"), "dropoff_date")
    return p.select("vendor_id").distinct()


# =========================== event-time windows ==============================

_E_MONEY = "CAST(value AS DECIMAL(18,2))"


@register("tumble_1h_by_key", f"""
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       user_id, COUNT(*) AS num_events, CAST(SUM({_E_MONEY}) AS DECIMAL(38,2)) AS total_value
FROM events GROUP BY 1, 2, 3""")
def q_tumble_1h_by_key(spark, d):
    e = events(spark, d).withColumn("amount", F.col("value").cast("decimal(18,2)"))
    return tumbling(e, "ts", "1 hour", ["user_id"],
                    [F.count(F.lit(1)).alias("num_events"), F.sum("amount").cast("decimal(38,2)").alias("total_value")])


@register("tumble_1h_total", f"""
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       CAST(SUM({_E_MONEY}) AS DECIMAL(38,2)) AS total_value
FROM events GROUP BY 1, 2""")
def q_tumble_1h_total(spark, d):
    e = events(spark, d).withColumn("amount", F.col("value").cast("decimal(18,2)"))
    return tumbling(e, "ts", "1 hour", [], [F.sum("amount").cast("decimal(38,2)").alias("total_value")])


_T5 = """
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end,
       user_id, COUNT(*) AS num_events
FROM events GROUP BY 1, 2, 3"""


def _tumble_5m(spark, d):
    return tumbling(events(spark, d), "ts", "5 minutes", ["user_id"], [F.count(F.lit(1)).alias("num_events")])


@register("tumble_5m_by_key", _T5)
def q_tumble_5m_by_key(spark, d):
    return _tumble_5m(spark, d)


@register("top_windows", f"SELECT * FROM ({_T5}) ORDER BY num_events DESC, window_start, user_id LIMIT 3")
def q_top_windows(spark, d):
    return _tumble_5m(spark, d).orderBy(F.desc("num_events"), "window_start", "user_id").limit(3)


@register("best_hour", f"""
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, CAST(SUM({_E_MONEY}) AS DECIMAL(38,2)) AS total_value
FROM events GROUP BY 1 ORDER BY total_value DESC, window_start LIMIT 1""")
def q_best_hour(spark, d):
    e = events(spark, d).withColumn("amount", F.col("value").cast("decimal(18,2)"))
    t = tumbling(e, "ts", "1 hour", [], [F.sum("amount").cast("decimal(38,2)").alias("total_value")])
    return t.select("window_start", "total_value").orderBy(F.desc("total_value"), "window_start").limit(1)


_ISLANDS = """
isl AS (
  SELECT *, SUM(brk) OVER (PARTITION BY {p} ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM (
    SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY {p} ORDER BY ts, event_id) IS NULL
                     OR ts - lag(ts) OVER (PARTITION BY {p} ORDER BY ts, event_id) > INTERVAL 5 MINUTE
                   THEN 1 ELSE 0 END AS brk
    FROM events)
)"""


@register("session_by_key", W(f"""
SELECT user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL 5 MINUTE AS session_end, COUNT(*) AS num_events,
       CAST(SUM({_E_MONEY}) AS DECIMAL(38,2)) AS total_value
FROM isl GROUP BY user_id, sid""", _ISLANDS.format(p="user_id")))
def q_session_by_key(spark, d):
    # counts and sums: sessions from per-minute summaries, no per-row sort
    e = events(spark, d).withColumn("amount", F.col("value").cast("decimal(18,2)"))
    s = session_totals(e, "ts", 300, ["user_id"], ["amount"], sum_names=["total_value"])
    return s.withColumn("total_value", F.col("total_value").cast("decimal(38,2)"))


@register("longest_session", W("""
SELECT MAX(n) AS max_events FROM (SELECT user_id, sid, COUNT(*) AS n FROM isl GROUP BY 1, 2)""",
                               _ISLANDS.format(p="user_id")))
def q_longest_session(spark, d):
    s = session_totals(events(spark, d), "ts", 300, ["user_id"])
    return s.agg(F.max("num_events").alias("max_events"))


@register("session_global_by_key", W(f"""
SELECT MIN(MIN(ts)) OVER (PARTITION BY sid) AS session_start, user_id, COUNT(*) AS num_events,
       CAST(SUM({_E_MONEY}) AS DECIMAL(38,2)) AS total_value
FROM isl GROUP BY sid, user_id""", _ISLANDS.replace("PARTITION BY {p} ", "").format()))
def q_session_global_by_key(spark, d):
    # sessions over all events (no key), totals per user inside each session
    e = events(spark, d).withColumn("amount", F.col("value").cast("decimal(18,2)"))
    s = session_totals(e, "ts", 300, [], ["amount"], by=["user_id"], sum_names=["total_value"])
    return s.select("session_start", "user_id", "num_events", F.col("total_value").cast("decimal(38,2)").alias("total_value"))


# ============================== data quality =================================

def _dq(spark, d, checks):
    # no check reads a location column: skip the lookups
    return Q.run_checks(trips(spark, d, locations=False), checks)


def _dq_sql(kind, col, pred):
    return W(f"SELECT '{kind}' AS \"check\", '{col}' AS \"column\", COUNT(*) FILTER (WHERE {pred}) AS violations FROM trips",
             TRIPS)


@register("dq_not_null", _dq_sql("not_null", "payment_type", "payment_type IS NULL"))
def q_dq_not_null(spark, d):
    return _dq(spark, d, [Q.not_null("payment_type")])


@register("dq_unique", W("""
SELECT 'unique' AS "check", 'orderkey' AS "column", COUNT(*) FILTER (WHERE n > 1) AS violations FROM (
  SELECT orderkey, COUNT(*) AS n FROM trips WHERE orderkey IS NOT NULL GROUP BY orderkey)""", TRIPS))
def q_dq_unique(spark, d):
    return _dq(spark, d, [Q.unique("orderkey")])


@register("dq_accepted_values", _dq_sql("accepted_values", "payment_type",
                                        "payment_type IS NOT NULL AND payment_type NOT IN (1, 2, 3, 4, 5, 6)"))
def q_dq_accepted_values(spark, d):
    return _dq(spark, d, [Q.accepted_values("payment_type", [1, 2, 3, 4, 5, 6])])


@register("dq_non_negative", W("""
SELECT 'non_negative' AS "check", 'trip_seconds' AS "column",
       COUNT(*) FILTER (WHERE date_diff('second', pickup_datetime, dropoff_datetime) < 0) AS violations FROM trips""",
                               TRIPS))
def q_dq_non_negative(spark, d):
    t = trips(spark, d, locations=False).withColumn(
        "trip_seconds", C.seconds_between("pickup_datetime", "dropoff_datetime"))
    return Q.run_checks(t, [Q.non_negative("trip_seconds")])


@register("dq_positive", _dq_sql("positive", "trip_distance", "trip_distance <= 0"))
def q_dq_positive(spark, d):
    return _dq(spark, d, [Q.positive("trip_distance")])


@register("dq_primary_key", W("""
SELECT 'primary_key' AS "check", 'orderkey,linenumber' AS "column",
       CAST(COUNT(*) FILTER (WHERE NOT nul AND n > 1) + coalesce(SUM(CASE WHEN nul THEN n END), 0) AS BIGINT) AS violations FROM (
  SELECT orderkey, linenumber, COUNT(*) AS n, (orderkey IS NULL OR linenumber IS NULL) AS nul FROM trips GROUP BY 1, 2)""",
                              TRIPS))
def q_dq_primary_key(spark, d):
    return _dq(spark, d, [Q.primary_key("orderkey", "linenumber")])


@register("dq_report", W("""
SELECT 'not_null' AS "check", 'pickup_datetime' AS "column", COUNT(*) FILTER (WHERE pickup_datetime IS NULL) AS violations FROM trips
UNION ALL SELECT 'accepted_values', 'service_type', COUNT(*) FILTER (WHERE service_type IS NOT NULL AND service_type NOT IN ('Green', 'Yellow')) FROM trips
UNION ALL SELECT 'accepted_values', 'payment_type', COUNT(*) FILTER (WHERE payment_type IS NOT NULL AND payment_type NOT IN (1, 2, 3, 4, 5, 6)) FROM trips
UNION ALL SELECT 'non_negative', 'total_amount', COUNT(*) FILTER (WHERE total_amount < 0) FROM trips
UNION ALL SELECT 'positive', 'trip_distance', COUNT(*) FILTER (WHERE trip_distance <= 0) FROM trips
UNION ALL SELECT 'unique', 'orderkey', COUNT(*) FILTER (WHERE n > 1) FROM (SELECT orderkey, COUNT(*) AS n FROM trips WHERE orderkey IS NOT NULL GROUP BY 1)
""", TRIPS))
def q_dq_report(spark, d):
    return _dq(spark, d, [Q.not_null("pickup_datetime"), Q.accepted_values("service_type", ["Green", "Yellow"]),
                          Q.accepted_values("payment_type", [1, 2, 3, 4, 5, 6]), Q.non_negative("total_amount"),
                          Q.positive("trip_distance"), Q.unique("orderkey")])


@register("dq_relationships", """
SELECT 'relationships' AS "check", 'user_id' AS "column", COUNT(*) AS violations FROM events
WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL)""")
def q_dq_relationships(spark, d):
    return Q.relationships(table(spark, d, "events"), "user_id", table(spark, d, "customer"), "c_custkey")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# ================================ streaming ==================================
# The stream reads the events table file as a file source (availableNow),
# runs to completion and the result table is returned; the SQL twin is the
# batch answer, so these check stream == batch.

def _event_stream(spark, d, max_files=None):
    from tripmart.streaming.jobs import read_events
    schema = events(spark, d).schema
    return read_events(spark, schema, path=f"{d.rstrip('/')}/event[s].parquet", fmt="parquet",
                       max_files=max_files)


@register("stream_pass_through", "SELECT event_id, ts, user_id, value FROM events")
def q_stream_pass_through(spark, d):
    import uuid
    from tripmart.session import scratch_path
    from tripmart.streaming.jobs import start
    out = scratch_path(spark, f"stream_out/{uuid.uuid4().hex}")
    q = start(_event_stream(spark, d).select("event_id", "ts", "user_id", "value"), fmt="parquet", path=out,
              available_now=True)
    q.awaitTermination()
    return spark.read.parquet(out)


@register("stream_tumble_1h_by_key", f"""
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       user_id, COUNT(*) AS num_events, CAST(SUM({_E_MONEY}) AS DECIMAL(38,2)) AS total_value
FROM events GROUP BY 1, 2, 3""")
def q_stream_tumble_1h_by_key(spark, d):
    import uuid
    from tripmart.operators.table_store import TableStore
    from tripmart.session import scratch_path
    from tripmart.streaming.jobs import start, tumbling_counts, upsert_sink, with_event_time
    s = with_event_time(_event_stream(spark, d), "ts", "5 seconds").withColumn(
        "amount", F.col("value").cast("decimal(18,2)"))
    agg = tumbling_counts(s, "ts", "1 hour", ["user_id"],
                          [F.count(F.lit(1)).alias("num_events"), F.sum("amount").cast("decimal(38,2)").alias("total_value")])
    from tripmart.streaming.ride_jobs import with_window_date
    # partitioned by window day: each micro-batch rewrites only the days it touches
    store = TableStore(spark, scratch_path(spark, f"stream_tables/{uuid.uuid4().hex}"), ["window_date"])
    q = start(with_window_date(agg), sink=upsert_sink(store, ["window_start", "user_id"], "hourly"), mode="update",
              available_now=True)
    q.awaitTermination()
    r = store.read()
    return r.select(C.instant_to_naive("window_start").alias("window_start"),
                    C.instant_to_naive("window_end").alias("window_end"), "user_id", "num_events", "total_value")


# ======================= file formats (derived data) =========================
# Whole driver tables are written out in a source format into the shared
# scratch folder, read back through the library's readers and aggregated;
# the SQL twins compute the same aggregate on the original table.

def _scratch(spark, name: str) -> str:
    import uuid
    from tripmart.session import scratch_path
    return scratch_path(spark, f"{name}/{uuid.uuid4().hex}")


@register("csv_typed_roundtrip", """
SELECT l_returnflag, COUNT(*) AS n, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS revenue,
       SUM(l_quantity) AS qty, MIN(l_shipdate) AS first_ship, MAX(l_shipdate) AS last_ship
FROM lineitem GROUP BY l_returnflag""")
def q_csv_typed_roundtrip(spark, d):
    """S01/K19: gzip CSV with header written from lineitem, read back with the
    declared schema and timestamp format (no inference pass)."""
    from tripmart.sources.files import read_csv
    li = table(spark, d, "lineitem")
    path = _scratch(spark, "csv")
    fmt = "yyyy-MM-dd HH:mm:ss"
    li.write.option("header", True).option("compression", "gzip").option("timestampNTZFormat", fmt).csv(path)
    back = read_csv(spark, path, li.schema, ts_format=fmt)
    return back.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(38,2)").alias("revenue"),
        F.sum("l_quantity").alias("qty"), F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))


@register("json_nested_explode", """
SELECT kind, COUNT(*) AS n, CAST(SUM(amount) AS DECIMAL(38,2)) AS total FROM (
  SELECT 'price' AS kind, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount FROM lineitem
  UNION ALL
  SELECT 'tax', CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2)) AS DECIMAL(18,2)) FROM lineitem)
GROUP BY kind""")
def q_json_nested_explode(spark, d):
    """S09: JSON documents with an array of objects (one document per line
    item: its price and tax items), read back and exploded."""
    from tripmart.sources.files import read_json_array
    li = table(spark, d, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    tax = (price * F.col("l_tax").cast("decimal(18,2)")).cast("decimal(18,2)")
    docs = li.select("l_orderkey", "l_linenumber",
                     F.array(F.struct(F.lit("price").alias("kind"), price.alias("amount")),
                             F.struct(F.lit("tax").alias("kind"), tax.alias("amount"))).alias("items"))
    path = _scratch(spark, "json")
    docs.write.json(path)
    schema = "l_orderkey long, l_linenumber int, items array<struct<kind: string, amount: decimal(18,2)>>"
    items = read_json_array(spark, path, "items", schema=schema, multi_line=False, parents=["l_orderkey"])
    return items.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").cast("decimal(38,2)").alias("total"))


@register("paged_scan_events", """
SELECT event_type, COUNT(*) AS n, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total
FROM events GROUP BY event_type""")
def q_paged_scan_events(spark, d):
    """S10a: the events table saved as numbered JSON pages of 1000 records
    (page N = event ids (N-1)*1000 ..), read through the paged source that
    stops at the first empty page."""
    from tripmart.sources.paged import paged_scan
    e = events(spark, d)
    path = _scratch(spark, "pages")
    pages = e.withColumn("page", (F.floor(F.col("event_id") / 1000) + 1).cast("long"))
    (pages.groupBy("page").agg(F.to_json(F.collect_list(F.struct("event_id", "event_type", "value"))).alias("value"))
          .write.partitionBy("page").text(path))
    got = paged_scan(spark, path + "/page={page}/part-*", "event_id long, event_type string, value double",
                     kind="page", pages_per_partition=4)
    return got.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"),
                                         F.sum(F.col("value").cast("decimal(18,2)")).cast("decimal(38,2)").alias("total"))


@register("ingest_months", W("""
SELECT lower(service_type) AS taxi_type, CAST(date_trunc('month', pickup_datetime) AS DATE) AS month, COUNT(*) AS n,
       CAST(SUM(total_amount) AS DECIMAL(38,2)) AS total
FROM trips WHERE pickup_datetime >= TIMESTAMP '1997-11-01 00:00:00' AND pickup_datetime < TIMESTAMP '1998-03-01 00:00:00'
GROUP BY 1, 2""", TRIPS))
def q_ingest_months(spark, d):
    """S14: per (type, month) files; the months Nov 1997 .. Feb 1998 of both
    types (across New Year) are ingested in one read per type with
    ``taxi_type`` and ``extracted_at`` added."""
    from tripmart.sources.files import ingest, period_paths
    root = _scratch(spark, "monthly")
    t = trips(spark, d, locations=False).select("pickup_datetime", "total_amount", "service_type")
    (t.withColumn("kind", F.lower("service_type")).withColumn("month", F.date_format("pickup_datetime", "yyyy-MM"))
      .drop("service_type").hint("rebalance", "kind", "month").write.partitionBy("kind", "month").parquet(root))
    kinds = ["green", "yellow"]
    paths = period_paths(root, kinds, dt.date(1997, 11, 1), dt.date(1998, 2, 1),
                         pattern="{root}/kind={kind}/month={year:04d}-{month:02d}")
    df = ingest(spark, {k: [p for p in paths if f"/kind={k}/" in p] for k in kinds})
    return df.groupBy("taxi_type", C.month_start("pickup_datetime").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("total_amount").cast("decimal(38,2)").alias("total"))


# ====================== streaming sessions (append mode) =====================
# A session is emitted once the watermark (max event time, in ms, minus 5 s)
# passes its end (last event + gap); the twins select exactly those sessions.

_WM = "(SELECT date_trunc('millisecond', MAX(ts)) - INTERVAL 5 SECOND FROM events)"


def _run_to_table(spark, df, sink_kind: str, mode: str = "append"):
    import uuid
    from tripmart.operators.table_store import TableStore
    from tripmart.streaming.jobs import append_sink, start
    store = TableStore(spark, _scratch(spark, "stream_tables"))
    start(df, sink=append_sink(store, sink_kind), mode=mode, available_now=True,
          name=f"{sink_kind}_{uuid.uuid4().hex[:8]}").awaitTermination()
    return store


@register("stream_session_by_key", W(f"""
SELECT user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL 5 MINUTE AS session_end, COUNT(*) AS num_events,
       CAST(SUM({_E_MONEY}) AS DECIMAL(38,2)) AS total_value
FROM isl GROUP BY user_id, sid HAVING MAX(ts) + INTERVAL 5 MINUTE <= {_WM}""", _ISLANDS.format(p="user_id")))
def q_stream_session_by_key(spark, d):
    from tripmart.streaming.jobs import session_counts, with_event_time
    s = with_event_time(_event_stream(spark, d), "ts", "5 seconds").withColumn(
        "amount", F.col("value").cast("decimal(18,2)"))
    agg = session_counts(s, "ts", "5 minutes", ["user_id"],
                         [F.count(F.lit(1)).alias("num_events"), F.sum("amount").cast("decimal(38,2)").alias("total_value")])
    r = _run_to_table(spark, agg, "sessions").read()
    return r.select("user_id", C.instant_to_naive("session_start").alias("session_start"),
                    C.instant_to_naive("session_end").alias("session_end"), "num_events", "total_value")


@register("stream_session_global_by_key", W(f"""
SELECT s.session_start, s.session_end, CAST(i.user_id AS BIGINT) AS location, COUNT(*) AS num_events,
       CAST(SUM(CAST(i.value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_amount
FROM isl i JOIN (SELECT sid, MIN(ts) AS session_start, MAX(ts) + INTERVAL 5 MINUTE AS session_end
                 FROM isl GROUP BY sid) s ON i.sid = s.sid
GROUP BY 1, 2, 3""", _ISLANDS.replace("PARTITION BY {p} ", "").format()))
def q_stream_session_global_by_key(spark, d):
    from tripmart.operators.table_store import TableStore
    from tripmart.streaming.global_sessions import PARTITIONS, global_sessions, start_summaries
    from tripmart.streaming.jobs import with_event_time
    s = with_event_time(_event_stream(spark, d), "ts", "5 seconds")
    store = TableStore(spark, _scratch(spark, "stream_tables"), PARTITIONS)
    start_summaries(s, store, "ts", "user_id", "value", available_now=True).awaitTermination()
    r = global_sessions(store.read(), 300)
    return r.select(C.instant_to_naive("session_start").alias("session_start"),
                    C.instant_to_naive("session_end").alias("session_end"), "location", "num_events", "total_amount")


# registered by their own modules
from tripmart.plans import incremental_queries, storage_queries, stream_queries  # noqa: E402,F401
