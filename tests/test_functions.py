import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tripmart.functions import columns as C


def test_row_id_without_separator_collides(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "x")], "a string, b string")
    ids = [r[0] for r in df.select(C.row_id("a", "b")).collect()]
    assert ids[0] == ids[1]
    sep = [r[0] for r in df.select(C.row_id("a", "b", sep="|")).collect()]
    assert sep[0] != sep[1]
    # NULL renders as empty text
    assert ids[2] == df.sparkSession.range(1).select(F.md5(F.lit("x"))).first()[0]


def test_surrogate_key_null_token(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    got = df.select(C.surrogate_key("a", "b")).first()[0]
    exp = spark.range(1).select(F.md5(F.lit("1-" + C.SURROGATE_NULL_TOKEN))).first()[0]
    assert got == exp


def test_timestamp_text_with_and_without_fraction(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 0),), (dt.datetime(2024, 1, 1, 0, 0, 0, 500000),)],
                               "t timestamp_ntz")
    assert [r[0] for r in df.select(C.as_text("t")).collect()] == ["2024-01-01 00:00:00", "2024-01-01 00:00:00.5"]


def test_seconds_between_counts_boundaries(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 0, 900000), dt.datetime(2024, 1, 1, 0, 0, 2, 100000))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert df.select(C.seconds_between("a", "b")).first()[0] == 2


def test_labels(spark):
    df = spark.createDataFrame([(i,) for i in [0, 1, 2, 3, 4, 5, 6, 7, None]], "p int")
    got = [r[0] for r in df.select(C.payment_description("p")).collect()]
    assert got == ["Flex Fare trip", "Credit Card", "Cash", "No charge", "Dispute", "Unknown", "Voided trip",
                   "Unknown", "Unknown"]
    v = [r[0] for r in df.select(C.vendor_name("p")).collect()]
    assert v[1] == "Creative Mobile Technologies, LLC" and v[2] == "VeriFone Inc." and v[4] == "Unknown Vendor"
    assert v[3] is None and v[8] is None


def test_cents_to_dollars_rounds_half_up(spark):
    df = spark.createDataFrame([(Decimal("12.50"),), (Decimal("-0.50"),), (Decimal("1234.56"),)], "x decimal(18,2)")
    assert [r[0] for r in df.select(C.cents_to_dollars("x")).collect()] == [Decimal("0.13"), Decimal("-0.01"), Decimal("12.35")]


def test_concat_skip_null(spark):
    df = spark.createDataFrame([("a", None, "c")], "a string, b string, c string")
    assert df.select(C.concat_skip_null("a", "b", "c")).first()[0] == "ac"


def test_epoch_millis_floor_and_back(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 7, 179575),)], "t timestamp_ntz")
    ms = df.select(C.to_epoch_millis("t")).first()[0]
    assert ms == 1704067207179
    back = spark.createDataFrame([(ms,)], "m long").select(C.from_epoch_millis("m").cast("timestamp_ntz")).first()[0]
    assert back == dt.datetime(2024, 1, 1, 0, 0, 7, 179000)


def test_snake_case():
    assert C.snake_case("PULocationID") == "pu_location_id"
    assert C.snake_case("VendorID") == "vendor_id"
    assert C.snake_case("tpep_pickup_datetime") == "tpep_pickup_datetime"


def test_validity_flag(spark):
    a, b = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    df = spark.createDataFrame([(a, b, Decimal("1")), (b, a, Decimal("1")), (a, b, Decimal("0")), (None, b, Decimal("1")),
                                (a, b, None)], "p timestamp_ntz, d timestamp_ntz, x decimal(18,2)")
    assert [r[0] for r in df.select(C.is_valid_trip("p", "d", "x")).collect()] == [True, False, False, False, False]


def test_json_roundtrip_keeps_micros(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 0, 0, 7, 179575))], "id long, t timestamp_ntz")
    j = df.select(C.to_json_text(["id", "t"]).alias("j"))
    back = j.select(C.from_json_text("j", df.schema).alias("r")).select("r.*").first()
    assert back["t"] == dt.datetime(2024, 1, 1, 0, 0, 7, 179575)


def test_period_name(spark):
    df = spark.createDataFrame([("Green", dt.datetime(2019, 3, 5))], "s string, t timestamp_ntz")
    assert df.select(C.period_name("s", "t")).first()[0] == "green_tripdata_2019-03"
