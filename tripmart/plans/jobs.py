"""End-to-end batch jobs: the reference's flows as compositions of operators.

Each job is a plain function over DataFrames and :class:`TableStore` tables;
scheduling is left to whatever runs it (one call per period, or one call for
a whole backfill range).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions import columns as C
from tripmart.operators import materialize as M
from tripmart.operators import quality as Q
from tripmart.operators.dedupe import dedupe_any
from tripmart.operators.joins import broadcast_if_small
from tripmart.operators.project import fields_with_default
from tripmart.operators.table_store import TableStore
from tripmart.plans import marts
from tripmart.sources import files as FS

# ---------------------------------------------------------------- E05 / E02b

# The fields of a row's id.
ROW_ID_FIELDS_7 = ["VendorID", "lpep_pickup_datetime", "lpep_dropoff_datetime", "PULocationID", "DOLocationID",
                   "fare_amount", "trip_distance"]


def monthly_elt(spark: SparkSession, csv_paths: str | Sequence[str], file_columns: Sequence[str],
                table_schema: T.StructType, target: TableStore, id_fields: Sequence[str] = ROW_ID_FIELDS_7,
                ts_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """COPY the month's CSV into the table's column list, add
    ``unique_row_id`` (MD5 of the id fields, no separator) and ``filename``,
    then insert-only MERGE on ``unique_row_id`` into ``target``.
    Returns the staged batch (lazy)."""
    staged = FS.copy_in(spark, csv_paths, file_columns, table_schema, ts_format)
    staged = staged.withColumns({"unique_row_id": C.row_id(*id_fields),
                                 "filename": F.col("_metadata.file_name")})
    target.merge_insert(staged, ["unique_row_id"])
    return staged


# -------------------------------------------------------------------- E03

def fct_trips_incremental(trips: DataFrame, zone: DataFrame, target: TableStore,
                          lookback: dt.timedelta | None = None) -> None:
    """Incremental fact: only trips newer than the fact's latest pickup (plus
    an optional ``lookback`` for late rows) are read, built and merged on
    ``trip_id``; new columns are appended to the table schema.  Pickup time is
    part of the trip key, so filtering the source first drops no duplicate's
    better row."""
    if target.exists():
        trips = M.high_water_filter(trips, target.read(), "pickup_datetime", lookback)
    target.merge_upsert(marts.fct_trips(trips, zone), ["trip_id"], add_columns=True)


# What the fact and the report are checked for.
FCT_CHECKS = [Q.unique("trip_id"), Q.not_null("trip_id"), Q.accepted_values("service_type", ["Green", "Yellow"])]


# -------------------------------------------------------------------- E06

REPORT_CHECKS = [Q.not_null("pickup_date"), Q.primary_key("pickup_date", "pickup_location_id"),
                 Q.non_negative("trips_count"), Q.non_negative("total_fare"), Q.non_negative("total_tip"),
                 Q.non_negative("avg_trip_distance")]


def staged_daily_report(trips: DataFrame, payments: DataFrame, staging: TableStore, report: TableStore,
                        start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Append -> interval staging -> daily report, with checks.

    Staging keeps, for ``[start, end)``, the trips that have a known payment
    type, one per (vendor, times, locations); the report is rebuilt, for every
    day the window touches, from all of that day's staged rows, so a window may
    begin or end inside a day.  Both replacements are ``time_interval``
    rewrites of only the touched partitions.  The report's checks run in one
    pass over the replaced days and stop the job on a violation.  Returns the
    check report.
    """
    if end <= start:
        raise ValueError("an empty window")
    first, after = start.date(), (end - dt.timedelta(microseconds=1)).date() + dt.timedelta(days=1)
    window = trips.where(M.in_window(F.col("pickup_datetime"), start, end))
    stg = window.join(broadcast_if_small(payments), window.payment_type == payments.payment_type_id, "inner") \
                .drop("payment_type_id")
    stg = dedupe_any(stg, marts.STG_KEYS).withColumn("pickup_date", F.to_date("pickup_datetime"))
    staging.replace_interval(stg, "pickup_datetime", start, end)
    days = M.in_window(F.col("pickup_date"), first, after)
    staged = staging.read().where(days)
    report.replace_interval(marts.daily_location_report(staged), "pickup_date", first, after)
    checks = Q.run_checks(report.read().where(days), REPORT_CHECKS)
    return Q.assert_passing(checks)


# -------------------------------------------------------------------- E08

def avg_price_by_brand(spark: SparkSession, json_path: str, field: str = "products") -> DataFrame:
    """Products JSON -> one row per product -> ``brand`` defaulted to 'N/A'
    where the key is absent (an explicit null stays null) -> rounded average
    price per brand.  Products are parsed as maps so that key presence is
    visible; each document file is one row (JSON documents do not split)."""
    docs = spark.read.text(json_path, wholetext=True)
    items = docs.select(F.explode(F.from_json("value", f"struct<{field}: array<map<string,string>>>")[field])
                        .alias("m"))
    brand, price = fields_with_default("m", ["brand", "price"], "N/A")
    kept = items.select(brand, price)
    return (kept.groupBy("brand").agg(F.round(F.avg(F.col("price").cast("double")), 2).alias("avg_price"))
                .orderBy(F.desc("avg_price"), "brand"))


# -------------------------------------------------------------------- E01

def clean_month(spark: SparkSession, sf_dir: str, service: str, out_path: str, files: int = 4) -> None:
    """Clean one service's trips into ``files`` Parquet files."""
    from tripmart.operators.table_store import write_table
    write_table(marts.clean(marts.raw_trips(spark, sf_dir, service), service), out_path, files)
