import datetime as dt
import decimal

from pyspark.sql import functions as F

from tripmart.operators.numbering import with_row_number
from tripmart.plans import marts

from conftest import SF_SMALL

MONEY = ", ".join(f"{c} double" for c in ("trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
                                          "total_amount", "congestion_surcharge", "cbd_congestion_fee"))


def raw(spark, p, more, rows):
    schema = (f"VendorID long, {p}_pickup_datetime timestamp_ntz, {p}_dropoff_datetime timestamp_ntz, store_and_fwd_flag string, RatecodeID long, "
              f"PULocationID long, DOLocationID long, passenger_count long, payment_type long, {MONEY}, {more}")
    base = (dt.datetime(2019, 1, 1), dt.datetime(2019, 1, 1, 1), "N", 1, 10, 20, 2, 1, 1.5, 10.0, .5, .5, 2.25, 0.0, .3, 13.55, 2.75, .75)
    return spark.createDataFrame([(v, at or base[0], *base[1:], *own) for v, at, *own in rows], schema)


def test_green_and_yellow_staging(spark):
    g = marts.stg_green(raw(spark, "lpep", "trip_type long, ehail_fee double", [(1, None, 2, 1.25), (None, None, 1, 0.0), (2, None, None, None)]))
    assert dict(g.dtypes) == marts.STAGED and g.columns == list(marts.STAGED)
    got = {r.vendor_id: r for r in g.collect()}
    assert sorted(got) == [1, 2]                                     # no row without a vendor
    assert (got[1].trip_type, got[1].ehail_fee, got[1].service_type) == (2, decimal.Decimal("1.25"), "Green")
    assert got[2].trip_type is None and got[2].ehail_fee is None and got[2].tip_amount == decimal.Decimal("2.25")
    y = raw(spark, "tpep", "Airport_fee double", [(1, dt.datetime(2019, 2, 1), 1.0), (1, dt.datetime(2019, 2, 1, 0, 0, 1), 1.0), (3, None, None)])
    s = marts.stg_yellow(y)
    assert s.dtypes == g.dtypes and {(r.trip_type, r.ehail_fee, r.service_type) for r in s.collect()} == {(1, 0, "Yellow")}
    dev = marts.stg_yellow(y, (dt.datetime(2019, 1, 1), dt.datetime(2019, 2, 1)))
    assert dev.count() == 2                                          # both ends of the range are in
    assert g.unionByName(s).count() == 5


def test_fhv_staging(spark):
    rows = [("B1", dt.datetime(2019, 1, 1), None, 1.0, None, "1", "B2"), (None, None, None, 2.0, 3.0, None, None)]
    df = spark.createDataFrame(rows, "dispatching_base_num string, pickup_datetime timestamp_ntz, dropOff_datetime timestamp_ntz, PUlocationID double, "
                                     "DOlocationID double, SR_Flag string, Affiliated_base_number string")
    out = marts.stg_fhv(df)
    assert out.columns == ["dispatching_base_num", "pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id", "sr_flag",
                           "affiliated_base_number"]
    assert [tuple(r) for r in out.collect()] == [("B1", dt.datetime(2019, 1, 1), None, 1, None, 1, "B2")]


def test_clean_layer_has_all_columns(spark):
    out = marts.clean_all(spark, SF_SMALL)
    assert len(out.columns) == 23 and out.columns == marts.CLEAN_SCHEMA.names
    y = marts.clean(raw(spark, "tpep", "Airport_fee double", [(1, None, 1.75)]), "Yellow").first()
    assert (y.airport_fee, y.trip_type, y.ehail_fee, y.rate_code_id, y.cbd_congestion_fee) == (decimal.Decimal("1.75"), 1, 0, 1, decimal.Decimal("0.75"))
    g = marts.clean(raw(spark, "lpep", "trip_type long, ehail_fee double", [(1, None, 2, None)]), "Green").first()
    assert (g.airport_fee, g.trip_type, g.ehail_fee, g.store_and_fwd_flag) == (0, 2, None, "N")


def test_fact_has_rate_code_and_flag(spark):
    from tripmart.plans.trips import trips, zones
    f = marts.fct_trips(trips(spark, SF_SMALL), zones(spark, SF_SMALL))
    assert {"rate_code_id", "store_and_fwd_flag"} < set(f.columns) and f.where("rate_code_id IS NULL OR store_and_fwd_flag IS NULL").count() == 0


def test_row_numbers_are_consecutive(spark, tmp_dir):
    spark.range(0, 1000, 1, 7).where("id % 3 = 0 AND (id < 200 OR id > 700)").select("id", F.lit("x").alias("row_number_")).write.parquet(f"{tmp_dir}/t")
    df = spark.read.parquet(f"{tmp_dir}/t").repartition(1).sortWithinPartitions("id")
    df.write.parquet(f"{tmp_dir}/u")
    for path in ("t", "u"):
        out = with_row_number(spark.read.parquet(f"{tmp_dir}/{path}"), "at").collect()
        assert sorted(r["at"] for r in out) == list(range(len(out))) and len({r.id for r in out}) == len(out)
    assert with_row_number(spark.read.parquet(f"{tmp_dir}/u").limit(0), "at").count() == 0
