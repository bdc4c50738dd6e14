import datetime as dt
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators.table_store import TableStore
from tripmart.plans import jobs, marts
from tripmart.plans.trips import payment_lookup, trips, zones
from tripmart.streaming import jobs as S
from tripmart.streaming import ride_jobs as R
from tripmart.streaming.global_sessions import PARTITIONS, global_sessions

from conftest import SF_SMALL

GREEN_COLS = ["VendorID", "lpep_pickup_datetime", "lpep_dropoff_datetime", "PULocationID", "DOLocationID",
              "passenger_count", "trip_distance", "fare_amount", "tip_amount", "total_amount", "payment_type"]
TABLE = T.StructType([T.StructField(c, T.StringType() if c in ("VendorID", "PULocationID", "DOLocationID",
                                                                "payment_type") else
                                    T.TimestampNTZType() if "datetime" in c else T.DoubleType())
                      for c in GREEN_COLS] + [T.StructField("ehail_fee", T.DoubleType()),
                                              T.StructField("trip_type", T.StringType())])


def test_monthly_elt_is_idempotent(spark, tmp_dir):
    raw = marts.raw_trips(spark, SF_SMALL, "Green").select(*GREEN_COLS)
    raw.coalesce(1).write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss") \
        .csv(f"{tmp_dir}/csv")
    target = TableStore(spark, f"{tmp_dir}/green")
    jobs.monthly_elt(spark, f"{tmp_dir}/csv", GREEN_COLS, TABLE, target)
    n1 = target.read().count()
    distinct_ids = target.read().select("unique_row_id").distinct().count()
    jobs.monthly_elt(spark, f"{tmp_dir}/csv", GREEN_COLS, TABLE, target)   # re-run: nothing new
    assert target.read().count() == n1 == raw.count()
    assert distinct_ids <= n1
    assert target.read().where("filename LIKE 'part-%'").count() == n1
    assert target.read().where("ehail_fee IS NOT NULL").count() == 0       # column not in the file


def test_incremental_fact_and_checks(spark, tmp_dir):
    from tripmart.operators import quality as Q
    target = TableStore(spark, f"{tmp_dir}/fct")
    t, z = trips(spark, SF_SMALL), zones(spark, SF_SMALL)
    first = t.where("pickup_datetime < TIMESTAMP_NTZ '1996-01-01'")
    jobs.fct_trips_incremental(first, z, target)
    n = target.read().count()
    assert 0 < n == marts.fct_trips(first, z).count()
    jobs.fct_trips_incremental(t, z, target)                    # the rest
    n = target.read().count()
    assert n == marts.fct_trips(t, z).count()
    jobs.fct_trips_incremental(t, z, target)                    # nothing newer: unchanged
    assert target.read().count() == n
    Q.assert_passing(Q.run_checks(target.read(), jobs.FCT_CHECKS))


def test_staged_daily_report_windows(spark, tmp_dir):
    t = trips(spark, SF_SMALL)
    staging = TableStore(spark, f"{tmp_dir}/stg", ["pickup_date"])
    report = TableStore(spark, f"{tmp_dir}/rep", ["pickup_date"])
    pay = payment_lookup(spark)
    for y in (1997, 1998):
        rep = jobs.staged_daily_report(t, pay, staging, report, dt.datetime(y, 1, 1), dt.datetime(y + 1, 1, 1))
        assert rep.where("violations > 0").count() == 0
    # re-running a window replaces it (no duplicates)
    jobs.staged_daily_report(t, pay, staging, report, dt.datetime(1997, 1, 1), dt.datetime(1998, 1, 1))
    full = marts.daily_location_report(marts.stg_trips(spark, SF_SMALL)).where(
        (F.year("pickup_date") >= 1997) & (F.year("pickup_date") <= 1998))
    cols = ["pickup_date", "pickup_location_id", "trips_count", "total_amount"]
    got = sorted(tuple(r) for r in report.read().select(*cols).collect())
    assert got == sorted(tuple(r) for r in full.select(*cols).collect())


def test_avg_price_from_products_json(spark, tmp_dir):
    p = f"{tmp_dir}/p.json"
    with open(p, "w") as f:
        json.dump({"products": [{"brand": "A", "price": 1.0}, {"brand": "A", "price": 2.0}, {"price": 5.0},
                                {"brand": None, "price": 7.0}]}, f)
    got = [tuple(r) for r in jobs.avg_price_by_brand(spark, p).collect()]
    # absent brand -> 'N/A'; explicit null brand stays null
    assert got == [(None, 7.0), ("N/A", 5.0), ("A", 1.5)]


def _rides(spark, tmp_dir):
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(
        F.col("ts").alias("pickup_datetime"), F.col("user_id").cast("int").alias("pickup_location_id"),
        F.col("value").alias("total_amount"), (F.col("value") / 10).alias("tip_amount"))
    e.coalesce(1).write.parquet(f"{tmp_dir}/rides/a")
    stream = S.read_events(spark, e.schema, path=f"{tmp_dir}/rides/*", fmt="parquet")
    return e, S.with_event_time(stream.withColumnRenamed("pickup_datetime", "event_timestamp"), "event_timestamp",
                                "5 seconds")


def test_ride_jobs(spark, tmp_dir):
    e, ev = _rides(spark, tmp_dir)
    hourly = TableStore(spark, f"{tmp_dir}/hourly", ["window_date"])
    R.hourly_by_location(ev, hourly, available_now=True, checkpoint=f"{tmp_dir}/ck1").awaitTermination()
    batch = e.groupBy(F.window("pickup_datetime", "1 hour").start.alias("w"), "pickup_location_id").count()
    got = sorted((r.window_start.replace(tzinfo=None), r.pickup_location_id, r.num_trips) for r in hourly.read().collect())
    assert got == sorted(tuple(r) for r in batch.collect())
    tips = TableStore(spark, f"{tmp_dir}/tips")
    R.hourly_tips(ev, tips, available_now=True, checkpoint=f"{tmp_dir}/ck2").awaitTermination()
    assert tips.read().count() == e.select(F.window("pickup_datetime", "1 hour")).distinct().count()
    pt = TableStore(spark, f"{tmp_dir}/pt")
    R.pass_through(ev, pt, ["event_timestamp", "pickup_location_id"], available_now=True,
                   checkpoint=f"{tmp_dir}/ck3").awaitTermination()
    assert pt.read().count() == e.count()
    ss = TableStore(spark, f"{tmp_dir}/ss", PARTITIONS)
    R.session_streaks(ev, ss, available_now=True, checkpoint=f"{tmp_dir}/ck4").awaitTermination()
    # all sessions, the one still open included: every event is in one
    assert global_sessions(ss.read()).agg(F.sum("num_events")).first()[0] == e.count()


def test_stream_append_into_rdbms(spark, tmp_dir):
    url = "jdbc:derby:memory:tripmart_stream;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "user_id", "value")
    e.coalesce(2).write.parquet(f"{tmp_dir}/in/a")
    stream = S.read_events(spark, e.schema, path=f"{tmp_dir}/in/*", fmt="parquet", max_files=1)
    S.start(stream, sink=S.jdbc_append_sink(url, "EVENTS_SINK", props), available_now=True,
            checkpoint=f"{tmp_dir}/ck").awaitTermination()
    back = spark.read.jdbc(url, "EVENTS_SINK", properties=props)
    assert back.count() == e.count()


def test_consumer_to_table(spark, tmp_dir):
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    e.repartition(3).write.parquet(f"{tmp_dir}/in/a")
    target = TableStore(spark, f"{tmp_dir}/t")
    q = R.consume_to_table(spark, e.schema, target, path=f"{tmp_dir}/in/*", fmt="parquet", max_files=1,
                           available_now=True, checkpoint=f"{tmp_dir}/ck")
    q.awaitTermination()
    assert target.read().count() == e.count()
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 3   # one file per micro-batch


def test_half_day_window_rebuilds_the_whole_day(spark, tmp_dir):
    t = trips(spark, SF_SMALL)
    pay = payment_lookup(spark)
    day = t.join(pay, t.payment_type == pay.payment_type_id).groupBy(F.to_date("pickup_datetime").alias("d")).count() \
        .orderBy(F.desc("count"), "d").first()["d"]
    at = dt.datetime(day.year, day.month, day.day)
    t = t.where(F.to_date("pickup_datetime") == day).withColumn(
        "pickup_datetime", F.expr("pickup_datetime + make_dt_interval(0, linenumber * 3)"))
    staging, report = TableStore(spark, f"{tmp_dir}/stg", ["pickup_date"]), TableStore(spark, f"{tmp_dir}/rep", ["pickup_date"])
    jobs.staged_daily_report(t, pay, staging, report, at, at + dt.timedelta(days=1))
    whole = sorted(tuple(r) for r in report.read().collect())
    jobs.staged_daily_report(t, pay, staging, report, at + dt.timedelta(hours=12), at + dt.timedelta(days=1))
    jobs.staged_daily_report(t, pay, staging, report, at + dt.timedelta(hours=3), at + dt.timedelta(hours=6))
    assert sorted(tuple(r) for r in report.read().collect()) == whole
    assert sum(r.trips_count for r in report.read().collect()) == staging.read().count()


def test_restart_with_defaults_goes_on_after_the_last_commit(spark, tmp_dir):
    target = TableStore(spark, f"{tmp_dir}/pt")
    for i in (1, 2):
        spark.createDataFrame([(i,)], "id int").coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
        stream = S.read_events(spark, T.StructType([T.StructField("id", T.IntegerType())]), path=f"{tmp_dir}/in", fmt="parquet")
        R.pass_through(stream, target, ["id"], available_now=True).awaitTermination()
        assert sorted(r.id for r in target.read().collect()) == list(range(1, i + 1))
    # a second query with a checkpoint of its own is not taken for a replay of the first
    stream = S.read_events(spark, T.StructType([T.StructField("id", T.IntegerType())]), path=f"{tmp_dir}/in", fmt="parquet")
    R.pass_through(stream, target, ["id"], available_now=True, checkpoint=f"{tmp_dir}/other").awaitTermination()
    assert sorted(r.id for r in target.read().collect()) == [1, 1, 2, 2]
