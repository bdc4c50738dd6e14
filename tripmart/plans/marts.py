"""Star-schema marts and reports: the reference's end-to-end jobs as plans.

* E01 clean:    raw per-service frame -> rename -> constants -> conform
* E02 revenue:  clean green U clean yellow -> broadcast zones -> reports
* E03 marts:    trips -> surrogate key, labels, duration -> dedupe -> zones x2
                -> fct_trips -> monthly zone revenue
* E06 staging:  trips -> payment lookup (inner) -> dedupe_any -> daily report
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions import columns as C
from tripmart.operators.dedupe import dedupe_any, dedupe_first
from tripmart.operators.joins import broadcast_if_small, role_playing
from tripmart.operators.project import conform, rename, with_constants
from tripmart.operators.union import union_all
from tripmart.plans.trips import payment_lookup, trips, zones
from tripmart.sources.files import dev_limit

MONEY = T.DecimalType(18, 2)

# The columns of the clean layer, in their order.  Money and
# distance are decimals so that later sums are exact.
CLEAN_SCHEMA = T.StructType([T.StructField(name, kind) for name, kind in (
    ("vendor_id", T.IntegerType()),
    ("pickup_datetime", T.TimestampNTZType()),
    ("dropoff_datetime", T.TimestampNTZType()),
    ("store_and_fwd_flag", T.StringType()),
    ("rate_code_id", T.IntegerType()),
    ("pickup_location_id", T.IntegerType()),
    ("dropoff_location_id", T.IntegerType()),
    ("passenger_count", T.IntegerType()),
    ("trip_distance", MONEY),
    ("fare_amount", MONEY),
    ("extra", MONEY),
    ("mta_tax", MONEY),
    ("tip_amount", MONEY),
    ("tolls_amount", MONEY),
    ("ehail_fee", MONEY),
    ("improvement_surcharge", MONEY),
    ("total_amount", MONEY),
    ("payment_type", T.IntegerType()),
    ("trip_type", T.IntegerType()),
    ("congestion_surcharge", MONEY),
    ("cbd_congestion_fee", MONEY),
    ("service_type", T.StringType()),
    ("airport_fee", MONEY),
)])

# Raw -> clean column names per service (the two services prefix times differently).
_IDS = {"VendorID": "vendor_id", "RatecodeID": "rate_code_id", "PULocationID": "pickup_location_id", "DOLocationID": "dropoff_location_id"}
RENAME = {
    "Green": {**_IDS, "lpep_pickup_datetime": "pickup_datetime", "lpep_dropoff_datetime": "dropoff_datetime"},
    "Yellow": {**_IDS, "tpep_pickup_datetime": "pickup_datetime", "tpep_dropoff_datetime": "dropoff_datetime", "Airport_fee": "airport_fee"},
}
# Per-service constants: green cabs pick up at no airport; yellow has no trip
# type (street hail = 1) and no e-hail fee.
CONSTANTS = {
    "Green": {"service_type": ("Green", "string"), "airport_fee": (0, MONEY)},
    "Yellow": {"service_type": ("Yellow", "string"), "trip_type": (1, "int"), "ehail_fee": (0, MONEY)},
}
# Raw columns whose names both services share, with their raw types.
_RAW = {"store_and_fwd_flag": "string", "passenger_count": "long", "payment_type": "long"} | dict.fromkeys(
    ("trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount",
     "congestion_surcharge", "cbd_congestion_fee"), "double")


def raw_trips(spark: SparkSession, sf_dir: str, service: str, dropoff: bool = True) -> DataFrame:
    """A raw monthly-file-shaped frame for one service (taxi column names,
    long ids, double amounts) derived from the trip view.  ``dropoff=False``
    leaves out the dropoff location (and its lookup join) for consumers that
    never read it."""
    t = trips(spark, sf_dir, locations=("pickup", "dropoff") if dropoff else ("pickup",), services=(service,))
    own = {"Green": {"trip_type": "long", "ehail_fee": "double"}, "Yellow": {"airport_fee": "double"}}[service]
    raw_name = {v: k for k, v in RENAME[service].items()}
    renamed = [F.col(c).cast("timestamp_ntz" if c.endswith("datetime") else own.get(c, "long")).alias(raw)
               for c, raw in raw_name.items() if dropoff or c != "dropoff_location_id"]
    return t.select(*renamed, *[F.col(c).cast(kind).alias(c) for c, kind in (_RAW | own).items() if c not in raw_name])


def clean(raw: DataFrame, service: str) -> DataFrame:
    """E01: rename -> constants -> conform to the clean schema."""
    df = rename(raw, RENAME[service])
    df = with_constants(df, {k: v for k, v in CONSTANTS[service].items() if k not in df.columns})
    return conform(df, CLEAN_SCHEMA)


# The staging models' columns, in their order; NUMERIC has nine decimals.
NUMERIC = "decimal(38,9)"
STAGED = {"vendor_id": "int", "rate_code_id": "int", "pickup_location_id": "int", "dropoff_location_id": "int",
          "pickup_datetime": "timestamp_ntz", "dropoff_datetime": "timestamp_ntz", "store_and_fwd_flag": "string", "passenger_count": "int",
          "trip_distance": NUMERIC, "trip_type": "int", "fare_amount": NUMERIC, "extra": NUMERIC, "mta_tax": NUMERIC, "tip_amount": NUMERIC,
          "tolls_amount": NUMERIC, "improvement_surcharge": NUMERIC, "total_amount": NUMERIC, "payment_type": "int", "ehail_fee": NUMERIC,
          "service_type": "string"}
STAGED_FHV = {"dispatching_base_num": "string", "pickup_datetime": "timestamp_ntz", "dropOff_datetime": "timestamp_ntz", "PUlocationID": "int",
              "DOlocationID": "int", "SR_Flag": "int", "Affiliated_base_number": "string"}
FHV_NAMES = {"dropOff_datetime": "dropoff_datetime", "PUlocationID": "pickup_location_id", "DOlocationID": "dropoff_location_id",
             "SR_Flag": "sr_flag", "Affiliated_base_number": "affiliated_base_number"}


def _staged(raw: DataFrame, service: str, dev: tuple | None) -> DataFrame:
    known = raw.where(F.col("VendorID").isNotNull())
    df = rename(known, RENAME[service])
    df = with_constants(df, {k: v for k, v in CONSTANTS[service].items() if k in STAGED and k not in df.columns})
    return dev_limit(df.select(*[F.col(c).cast(t).alias(c) for c, t in STAGED.items()]), "pickup_datetime", dev)


def stg_green(raw: DataFrame, dev: tuple | None = None) -> DataFrame:
    """Staged green trips: renamed, typed, without rows that lack a vendor.
    ``dev`` is an inclusive range of pickup times for development runs."""
    return _staged(raw, "Green", dev)


def stg_yellow(raw: DataFrame, dev: tuple | None = None) -> DataFrame:
    """Staged yellow trips; all are street hails (type 1) without an e-hail fee."""
    return _staged(raw, "Yellow", dev)


def stg_fhv(raw: DataFrame) -> DataFrame:
    """Staged for-hire trips, without rows that lack a dispatching base."""
    known = raw.where(F.col("dispatching_base_num").isNotNull())
    return known.select(*[F.col(c).cast(t).alias(FHV_NAMES.get(c, c)) for c, t in STAGED_FHV.items()])


def raw_fhv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A for-hire file's columns from the trip view; trips without a payment type have no base."""
    t = trips(spark, sf_dir)
    base = F.when(F.col("payment_type").isNotNull(), F.col("vendor_id").cast("string"))
    return t.select(base.alias("dispatching_base_num"), "pickup_datetime", F.col("dropoff_datetime").alias("dropOff_datetime"),
                    F.col("pickup_location_id").cast("double").alias("PUlocationID"), F.col("dropoff_location_id").cast("double").alias("DOlocationID"),
                    F.col("trip_type").cast("string").alias("SR_Flag"), F.col("payment_type").cast("string").alias("Affiliated_base_number"))


def clean_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_all([clean(raw_trips(spark, sf_dir, s), s) for s in ("Green", "Yellow")])


def revenue_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E02 input: both services' (vendor, location, total) joined to zone names."""
    parts = [clean(raw_trips(spark, sf_dir, s, dropoff=False), s)
             .select("vendor_id", F.col("pickup_location_id").alias("location_id"), "total_amount")
             for s in ("Green", "Yellow")]
    z = broadcast_if_small(zones(spark, sf_dir).select("location_id", "zone"))
    return union_all(parts).join(z, "location_id")


def revenue_by_zone(base: DataFrame) -> DataFrame:
    return (base.groupBy("zone").agg(F.sum("total_amount").cast("decimal(20,2)").alias("revenue"))
                .orderBy(F.desc("revenue"), "zone"))


def revenue_by_vendor_zone(base: DataFrame) -> DataFrame:
    return (base.groupBy("vendor_id", "zone").agg(F.sum("total_amount").cast("decimal(20,2)").alias("revenue"))
                .orderBy("vendor_id", F.desc("revenue"), "zone"))


# ---- E03 --------------------------------------------------------------------

# Fixed values.
CENTS_COLUMNS = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
                 "total_amount"]


# A trip is one vendor's pickup at a time and place, per service (fixed value).
TRIP_KEYS = ("vendor_id", "pickup_datetime", "pickup_location_id", "service_type")


def int_trips(t: DataFrame, dedupe_keys=TRIP_KEYS, money_in_cents: bool = True) -> DataFrame:
    """Enriched, de-duplicated trips of both services: surrogate key over
    ``dedupe_keys``, payment label, duration; first row per key by dropoff time.

    ``money_in_cents`` keeps the conversion of the money columns by ``/100`` to
    ``decimal(16,2)`` (the amounts are taken as cents); ``ehail_fee`` passes
    through unchanged.  A filter on a key column commutes with the
    de-duplication, so callers may put it on ``t`` (or on the result: the
    planner pushes it down).
    """
    if money_in_cents:
        t = t.withColumns({c: C.cents_to_dollars(c) for c in CENTS_COLUMNS})
    t = dedupe_first(t, list(dedupe_keys), ["dropoff_datetime"])
    return t.withColumns({
        "trip_id": C.surrogate_key(*dedupe_keys),
        "payment_description": C.payment_description("payment_type"),
        "trip_minutes": C.minutes_between("pickup_datetime", "dropoff_datetime"),
    })


# The fact's columns, in their order.
FCT_COLUMNS = ["trip_id", "vendor_id", "service_type", "rate_code_id", "pickup_location_id", "pickup_borough", "pickup_zone",
               "dropoff_location_id", "dropoff_borough", "dropoff_zone", "pickup_datetime", "dropoff_datetime",
               "store_and_fwd_flag", "passenger_count", "trip_distance", "trip_type", "trip_duration_minutes", "fare_amount", "extra",
               "mta_tax", "tip_amount", "tolls_amount", "ehail_fee", "improvement_surcharge", "total_amount",
               "payment_type", "payment_description"]


def fct_trips(trips: DataFrame, zone: DataFrame, dedupe_keys=TRIP_KEYS) -> DataFrame:
    """Fact: deduped trips left-joined to the zone dimension twice."""
    t = int_trips(trips, dedupe_keys).withColumnRenamed("trip_minutes", "trip_duration_minutes")
    f = role_playing(t, zone, "location_id",
                     {"pickup": "pickup_location_id", "dropoff": "dropoff_location_id"}, ["zone", "borough"])
    return f.select(*FCT_COLUMNS)


# Money columns and the report's names for their sums.
MONTHLY_SUMS = [("fare_amount", "revenue_monthly_fare"), ("extra", "revenue_monthly_extra"),
                ("mta_tax", "revenue_monthly_mta_tax"), ("tip_amount", "revenue_monthly_tip_amount"),
                ("tolls_amount", "revenue_monthly_tolls_amount"), ("ehail_fee", "revenue_monthly_ehail_fee"),
                ("improvement_surcharge", "revenue_monthly_improvement_surcharge"),
                ("total_amount", "revenue_monthly_total_amount")]


def monthly_zone_revenue(fct: DataFrame) -> DataFrame:
    """A07: zone x month x service: 8 sums, trip count, 2 averages."""
    g = fct.groupBy(F.coalesce("pickup_zone", F.lit("Unknown Zone")).alias("pickup_zone"),
                    C.month_start("pickup_datetime").alias("revenue_month"), "service_type")
    return g.agg(*[F.sum(c).cast("decimal(38,2)").alias(a) for c, a in MONTHLY_SUMS],
                 F.count("trip_id").alias("total_monthly_trips"),
                 F.round(F.avg(F.col("passenger_count").cast("double")), 4).alias("avg_monthly_passenger_count"),
                 F.round(F.avg(F.col("trip_distance").cast("double")), 4).alias("avg_monthly_trip_distance"))


# ---- E06 --------------------------------------------------------------------

# What makes two staged trips the same.
STG_KEYS = ["vendor_id", "pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id"]


def stg_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging: inner lookup join to payment names (drops unknown/NULL
    payment types), then one row per (vendor, times, locations)."""
    t = trips(spark, sf_dir, extras=False)
    lk = F.broadcast(payment_lookup(spark))  # fixed 7-row seed
    t = t.join(lk, t.payment_type == lk.payment_type_id, "inner").drop("payment_type_id")
    return dedupe_any(t, STG_KEYS)


def daily_location_report(stg: DataFrame) -> DataFrame:
    """A08: per pickup day and location."""
    return (stg.groupBy(F.col("pickup_datetime").cast("date").alias("pickup_date"), "pickup_location_id")
               .agg(F.count(F.lit(1)).alias("trips_count"),
                    F.sum("total_amount").cast("decimal(38,2)").alias("total_amount"),
                    F.sum("fare_amount").cast("decimal(38,2)").alias("total_fare"),
                    F.sum(F.coalesce("tip_amount", F.lit(0))).cast("decimal(38,2)").alias("total_tip"),
                    F.round(F.avg(F.coalesce(F.col("trip_distance").cast("double"), F.lit(0.0))), 4)
                     .alias("avg_trip_distance"),
                    F.round(F.avg(F.coalesce(F.col("passenger_count").cast("double"), F.lit(0.0))), 4)
                     .alias("avg_passengers")))

