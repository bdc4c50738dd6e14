"""The trip fact and its dimensions, built from the driver tables.

Role mapping (a taxi trip stands on a line item of an order):

=====================  =====================================================
trip key               ``(l_orderkey, l_linenumber)`` (has real duplicates)
vendor_id              ``l_linenumber``
service_type           ``l_linestatus``: 'O' -> Green, 'F' -> Yellow
payment_type           first digit of ``o_orderpriority``, 5 -> NULL
trip_type              ``l_returnflag``: N -> 1, R -> 2, else NULL
passenger_count        ``round(l_tax * 100)``
pickup / dropoff time  ``o_orderdate`` / ``l_shipdate``
pickup / dropoff loc.  supplier nation / customer nation
distance, money        quantity; price, price*discount, price*(1+tax) ...
rate code, flag, fees  line number % 6 + 1; return flag; steps of the quantity
=====================  =====================================================

Money is DECIMAL(18,2) from the first projection on, so every later sum is
exact.  ``TRIPS_SQL`` is the same view in plain SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.columns import PAYMENT_LABELS
from tripmart.operators.joins import broadcast_if_small
from tripmart.sources.tables import table

MONEY = "decimal(18,2)"


def _money(c) -> F.Column:
    return c.cast(MONEY)


EXTRAS = ("rate_code_id", "store_and_fwd_flag", "congestion_surcharge", "cbd_congestion_fee", "airport_fee")
SERVICE_CODES = {"Green": "O", "Yellow": "F"}


def trips(spark: SparkSession, sf_dir: str, locations: bool | tuple[str, ...] = True,
          services: tuple[str, ...] | None = None, extras: bool = True) -> DataFrame:
    """Trip rows.  ``locations`` selects the location lookups to resolve:
    ``True`` (both), ``False`` (none) or a subset of ``("pickup", "dropoff")``
    - the planner cannot drop an unused lookup join by itself since it does
    not know the lookup keys are unique.  ``services`` keeps only those
    services, filtered on the raw status column so the predicate reaches the
    Parquet scan.  ``extras=False`` leaves out the columns (:data:`EXTRAS`) that
    only the clean layer, the staging models and the fact read."""
    roles = {"pickup", "dropoff"} if locations is True else set(locations or ())
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    if services is not None:
        li = li.where(F.col("l_linestatus").isin([SERVICE_CODES[s] for s in services]))
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    # resolve each side's lookup before the big orderkey join: the lookups
    # are broadcast only while their estimated size is small
    if "pickup" in roles:
        sup = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("pickup_location_id"))
        li = li.join(broadcast_if_small(sup), li.l_suppkey == sup.s_suppkey, "left")
    if "dropoff" in roles:
        cus = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("dropoff_location_id"))
        od = od.join(broadcast_if_small(cus), od.o_custkey == cus.c_custkey, "left")
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    price = _money(F.col("l_extendedprice"))
    cols = [
        F.col("l_orderkey").alias("orderkey"),
        F.col("l_linenumber").alias("linenumber"),
        F.col("l_linenumber").alias("vendor_id"),
        F.when(F.col("l_linestatus") == "O", "Green").when(F.col("l_linestatus") == "F", "Yellow").alias("service_type"),
        F.nullif(F.substring("o_orderpriority", 1, 1).cast("int"), F.lit(5)).alias("payment_type"),
        F.when(F.col("l_returnflag") == "N", 1).when(F.col("l_returnflag") == "R", 2).cast("int").alias("trip_type"),
        F.round(F.col("l_tax") * 100).cast("int").alias("passenger_count"),
        F.col("o_orderdate").alias("pickup_datetime"),
        F.col("l_shipdate").alias("dropoff_datetime"),
    ]
    cols += [F.col(f"{r}_location_id") for r in ("pickup", "dropoff") if r in roles]
    cols += [
        _money(F.col("l_quantity")).alias("trip_distance"),
        price.alias("fare_amount"),
        _money(_money(F.col("l_discount")) * 10).alias("extra"),
        F.lit(0.50).cast(MONEY).alias("mta_tax"),
        _money(price * _money(F.col("l_discount"))).alias("tip_amount"),
        F.when(F.col("l_quantity") > 45, F.lit(6.94)).otherwise(F.lit(0)).cast(MONEY).alias("tolls_amount"),
        F.lit(1.00).cast(MONEY).alias("improvement_surcharge"),
        F.when(F.col("l_linestatus") == "F", F.lit(0)).cast(MONEY).alias("ehail_fee"),
        _money(price * (F.lit(1) + _money(F.col("l_tax")))).alias("total_amount"),
    ]
    # these depend on the columns above only, so they break no tie between rows
    cols += [
        (F.col("l_linenumber") % 6 + 1).cast("int").alias("rate_code_id"),
        F.when(F.col("l_returnflag").isin("N", "R"), "N").otherwise("Y").alias("store_and_fwd_flag"),
        F.when(F.col("l_quantity") > 30, F.lit(2.75)).otherwise(F.lit(0)).cast(MONEY).alias("congestion_surcharge"),
        F.when(F.col("l_quantity") > 40, F.lit(0.75)).otherwise(F.lit(0)).cast(MONEY).alias("cbd_congestion_fee"),
        F.when(F.col("l_linestatus") == "F", F.when(F.col("l_quantity") > 20, F.lit(1.75)).otherwise(F.lit(0))).cast(MONEY).alias("airport_fee"),
    ] if extras else []
    return j.select(*cols)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone dimension: location_id, zone, borough (nation -> region)."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (n.join(broadcast_if_small(r), n.n_regionkey == r.r_regionkey, "left")
             .select(F.col("n_nationkey").alias("location_id"), F.col("n_name").alias("zone"),
                     F.col("r_name").alias("borough")))


def payment_lookup(spark: SparkSession) -> DataFrame:
    """Seed lookup ``payment_type_id -> payment_type_name`` (7 fixed rows)."""
    return spark.createDataFrame(sorted(PAYMENT_LABELS.items()),
                                 "payment_type_id int, payment_type_name string")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


# Same view in SQL (for the DuckDB oracle; also runs on Spark SQL).
TRIPS_SQL = """
trips AS (
  SELECT l.l_orderkey AS orderkey, l.l_linenumber AS linenumber, l.l_linenumber AS vendor_id,
    CASE l.l_linestatus WHEN 'O' THEN 'Green' WHEN 'F' THEN 'Yellow' END AS service_type,
    NULLIF(CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER), 5) AS payment_type,
    CAST(CASE l.l_returnflag WHEN 'N' THEN 1 WHEN 'R' THEN 2 END AS INTEGER) AS trip_type,
    CAST(round(l.l_tax * 100) AS INTEGER) AS passenger_count,
    o.o_orderdate AS pickup_datetime, l.l_shipdate AS dropoff_datetime,
    s.s_nationkey AS pickup_location_id, c.c_nationkey AS dropoff_location_id,
    CAST(l.l_quantity AS DECIMAL(18,2)) AS trip_distance,
    CAST(l.l_extendedprice AS DECIMAL(18,2)) AS fare_amount,
    CAST(CAST(l.l_discount AS DECIMAL(18,2)) * 10 AS DECIMAL(18,2)) AS extra,
    CAST(0.50 AS DECIMAL(18,2)) AS mta_tax,
    CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_discount AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS tip_amount,
    CAST(CASE WHEN l.l_quantity > 45 THEN 6.94 ELSE 0 END AS DECIMAL(18,2)) AS tolls_amount,
    CAST(1.00 AS DECIMAL(18,2)) AS improvement_surcharge,
    CAST(CASE WHEN l.l_linestatus = 'F' THEN 0 END AS DECIMAL(18,2)) AS ehail_fee,
    CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 + CAST(l.l_tax AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total_amount,
    CAST(l.l_linenumber % 6 + 1 AS INTEGER) AS rate_code_id,
    CASE WHEN l.l_returnflag IN ('N', 'R') THEN 'N' ELSE 'Y' END AS store_and_fwd_flag,
    CAST(CASE WHEN l.l_quantity > 30 THEN 2.75 ELSE 0 END AS DECIMAL(18,2)) AS congestion_surcharge,
    CAST(CASE WHEN l.l_quantity > 40 THEN 0.75 ELSE 0 END AS DECIMAL(18,2)) AS cbd_congestion_fee,
    CAST(CASE WHEN l.l_linestatus = 'F' THEN CASE WHEN l.l_quantity > 20 THEN 1.75 ELSE 0 END END AS DECIMAL(18,2)) AS airport_fee
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
)"""

ZONES_SQL = """
zones AS (
  SELECT n.n_nationkey AS location_id, n.n_name AS zone, r.r_name AS borough
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

PAYMENTS_SQL = "payment_lookup AS (SELECT * FROM (VALUES " + ", ".join(
    f"({k}, '{v}')" for k, v in sorted(PAYMENT_LABELS.items())) + ") AS p(payment_type_id, payment_type_name))"
