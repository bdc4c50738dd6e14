import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators.joins import lookup
from tripmart.operators.project import enforce, snake_case_columns
from tripmart.sources import files as FS

from conftest import SF_SMALL


def test_snake_case_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "VendorID int, PULocationID int, tpep_pickup_datetime int")
    assert snake_case_columns(df).columns == ["vendor_id", "pu_location_id", "tpep_pickup_datetime"]


def test_enforce_adds_defaults_and_fails_on_bad_values(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("cbd_fee", T.DoubleType())])
    ok = enforce(spark.createDataFrame([("1",)], "a string"), schema, {"cbd_fee": 0.0}).collect()
    assert tuple(ok[0]) == (1, 0.0)
    with pytest.raises(Exception):
        enforce(spark.createDataFrame([("x",)], "a string"), schema).collect()


def test_dev_limit_is_inclusive(spark):
    df = spark.createDataFrame([(dt.datetime(2019, 1, 1),), (dt.datetime(2019, 2, 1),), (dt.datetime(2019, 2, 2),)],
                               "t timestamp_ntz")
    got = FS.dev_limit(df, "t", (dt.datetime(2019, 1, 1), dt.datetime(2019, 2, 1)))
    assert got.count() == 2 and FS.dev_limit(df, "t", None).count() == 3


def test_read_glob_merges_month_schemas_and_file_sizes(spark, tmp_dir):
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    e.select("event_id", "value").coalesce(1).write.parquet(f"{tmp_dir}/yellow_tripdata_2024-01.parquet")
    e.select("event_id", "value", "user_id").coalesce(1).write.parquet(f"{tmp_dir}/yellow_tripdata_2024-02.parquet")
    g = FS.read_glob(spark, f"{tmp_dir}/yellow_tripdata_2024-*.parquet")
    assert set(g.columns) == {"event_id", "value", "user_id"} and g.count() == 2 * e.count()
    avg = FS.avg_file_size(g).first()
    assert avg["files"] == 2 and avg["avg_file_size"] > 0


def test_seed_lookup_with_checks(spark, tmp_dir):
    from tripmart.operators import quality as Q
    p = f"{tmp_dir}/payment_lookup.csv"
    with open(p, "w") as f:
        f.write("payment_type_id,payment_type_name\n0,Flex Fare trip\n1,Credit Card\n2,Cash\n")
    seed = FS.seed(spark, p, T.StructType([T.StructField("payment_type_id", T.IntegerType()),
                                          T.StructField("payment_type_name", T.StringType())]))
    rep = Q.run_checks(seed, [Q.unique("payment_type_id"), Q.not_null("payment_type_id"),
                              Q.not_null("payment_type_name")])
    assert rep.where("violations > 0").count() == 0
    facts = spark.createDataFrame([(1,), (2,), (9,)], "payment_type_id int")
    got = sorted((r[0], r[1]) for r in lookup(facts, seed, "payment_type_id").collect())
    assert got == [(1, "Credit Card"), (2, "Cash"), (9, None)]
