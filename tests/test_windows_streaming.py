import datetime as dt
import os

import pandas as pd
from pyspark.sql import functions as F

from tripmart.operators.table_store import TableStore
from tripmart.operators.windows import islands, session_window_agg, sessions, tumbling
from tripmart.streaming import jobs as S

from conftest import SF_MID, SF_SMALL

B = dt.datetime(2024, 1, 1, 10, 0, 0)
MIN5 = dt.timedelta(minutes=5)


def _norm(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_gap_exactly_five_minutes_merges_and_one_micro_more_splits(spark):
    rows = [(1, B), (1, B + MIN5), (1, B + 2 * MIN5 + dt.timedelta(microseconds=1))]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz")
    s = sessions(df, "ts", 300, ["k"], [F.count(F.lit(1)).alias("n")])
    assert _norm(s, ["k", "session_start", "n"]) == [(1, B, 2), (1, rows[2][1], 1)]
    w = session_window_agg(df.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "5 minutes", ["k"],
                           [F.count(F.lit(1)).alias("n")])
    assert sorted(r.n for r in w.collect()) == [1, 2]


def brute_sessions(pdf, keys, gap_s):
    pdf = pdf.sort_values(keys + ["ts"]) if keys else pdf.sort_values("ts")
    out, prev, sid = [], {}, {}
    for r in pdf.itertuples(index=False):
        k = tuple(getattr(r, c) for c in keys)
        if k not in prev or (r.ts - prev[k]).total_seconds() > gap_s:
            sid[k] = sid.get(k, 0) + 1
        prev[k] = r.ts
        out.append((*k, sid[k], r.event_id))
    return sorted(out)


def test_islands_across_small_buckets_equal_brute_force(spark):
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    for bucket in (60, 3600, 86400):
        got = sorted(tuple(r) for r in islands(e, "ts", 300, ["user_id"], bucket_seconds=bucket)
                     .select("user_id", "session_id", "event_id").collect())
        assert got == brute_sessions(e.toPandas(), ["user_id"], 300)
    g = sorted(tuple(r) for r in islands(e, "ts", 600, [], bucket_seconds=120).select("session_id", "event_id").collect())
    assert g == brute_sessions(e.toPandas(), [], 600)


def test_sessions_equal_session_window_on_events(spark):
    e = spark.read.parquet(f"{SF_MID}/events.parquet")
    aggs = [F.count(F.lit(1)).alias("n"), F.sum("value").alias("v")]
    a = sessions(e, "ts", 300, ["user_id"], aggs)
    b = session_window_agg(e, "ts", "5 minutes", ["user_id"], aggs)
    cols = ["user_id", "session_start", "session_end", "n"]
    assert _norm(a, cols) == _norm(b, cols)


def test_global_session_two_locations_alternating(spark):
    rows = [(i, B + i * dt.timedelta(minutes=4), 1 + i % 2) for i in range(6)]
    df = spark.createDataFrame(rows, "event_id int, ts timestamp_ntz, loc int")
    t = islands(df, "ts", 300, [], session_col="sid")
    per = t.groupBy("sid", "loc").count()
    assert sorted((r.sid, r.loc, r["count"]) for r in per.collect()) == [(1, 1, 3), (1, 2, 3)]


def _split_events(spark, src, out_dir, parts=4):
    e = spark.read.parquet(src).withColumn("d", F.dayofmonth("ts"))
    pdf = e.toPandas()
    cuts = pd.qcut(pdf["d"].rank(method="first"), parts, labels=False)
    for i in range(parts):
        spark.createDataFrame(pdf[cuts == i].drop(columns=["d"]), e.drop("d").schema) \
            .coalesce(1).write.parquet(f"{out_dir}/part{i}")
    return e.drop("d").schema


def test_stream_tumbling_update_mode_equals_batch(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    schema = _split_events(spark, f"{SF_SMALL}/events.parquet", src)
    stream = S.read_events(spark, schema, path=f"{src}/part*", fmt="parquet", max_files=1)
    ev = S.with_event_time(stream, "ts", "5 seconds")
    agg = S.tumbling_counts(ev, "ts", "1 hour", ["user_id"], [F.count(F.lit(1)).alias("n")])
    store = TableStore(spark, f"{tmp_dir}/out")
    q = S.start(agg, sink=S.upsert_sink(store, ["window_start", "user_id"], "h"), mode="update",
                available_now=True, checkpoint=f"{tmp_dir}/ck")
    q.awaitTermination()
    batch = tumbling(spark.read.parquet(f"{SF_SMALL}/events.parquet"), "ts", "1 hour", ["user_id"],
                     [F.count(F.lit(1)).alias("n")])
    got = store.read().select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "user_id", "n")
    assert _norm(got, ["window_start", "user_id", "n"]) == _norm(batch, ["window_start", "user_id", "n"])


def test_stream_sessions_complete_mode_equals_batch(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    schema = _split_events(spark, f"{SF_SMALL}/events.parquet", src)
    stream = S.with_event_time(S.read_events(spark, schema, path=f"{src}/part*", fmt="parquet"), "ts", "5 seconds")
    agg = S.session_counts(stream, "ts", "5 minutes", ["user_id"], [F.count(F.lit(1)).alias("n")])
    store = TableStore(spark, f"{tmp_dir}/out")

    def overwrite(b, bid):
        store.overwrite(b)
    q = S.start(agg, sink=overwrite, mode="complete", available_now=True, checkpoint=f"{tmp_dir}/ck")
    q.awaitTermination()
    batch = sessions(spark.read.parquet(f"{SF_SMALL}/events.parquet"), "ts", 300, ["user_id"],
                     [F.count(F.lit(1)).alias("n")])
    got = store.read().select("user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"), "n")
    assert _norm(got, ["user_id", "session_start", "n"]) == _norm(batch, ["user_id", "session_start", "n"])


def test_late_row_behind_watermark_is_dropped(spark, tmp_dir):
    """Spark filters late rows against the watermark of the previous batch:
    batch 0 moves the watermark to 12:59:55, batch 1 evicts the 10:00
    window, a 10:01 row in batch 2 is dropped (not counted)."""
    import time
    schema = "event_id long, ts timestamp_ntz, user_id long"
    files = [[(1, B, 1), (2, B + dt.timedelta(hours=3), 1)], [(3, B + dt.timedelta(hours=3, minutes=30), 1)],
             [(4, B + dt.timedelta(minutes=1), 1)]]
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_dir}/in/f{i}")
        time.sleep(1.1)  # file order = modification time
    sch = spark.read.parquet(f"{tmp_dir}/in/f0").schema
    stream = S.with_event_time(S.read_events(spark, sch, path=f"{tmp_dir}/in/f*", fmt="parquet", max_files=1),
                               "ts", "5 seconds")
    agg = S.tumbling_counts(stream, "ts", "1 hour", [], [F.count(F.lit(1)).alias("n")])
    store = TableStore(spark, f"{tmp_dir}/out")
    q = S.start(agg, sink=S.upsert_sink(store, ["window_start"], "late"), mode="update", available_now=True,
                checkpoint=f"{tmp_dir}/ck")
    q.awaitTermination()
    got = {r.window_start.replace(tzinfo=None): r.n for r in store.read().collect()}
    assert got[B] == 1
    dropped = [p["stateOperators"][0].get("numRowsDroppedByWatermark", 0) for p in q.recentProgress
               if p.get("stateOperators")]
    assert max(dropped) >= 1  # reported in the progress of the dropping batch


def test_sinks_take_a_replayed_batch_once(spark, tmp_dir):
    store = TableStore(spark, f"{tmp_dir}/t")
    h = S.upsert_sink(store, ["k"], "q")
    a = spark.createDataFrame([(1, 1)], "k int, v int")
    h(a, 0)
    h(a, 0)  # replay of batch 0
    assert [tuple(r) for r in store.read().collect()] == [(1, 1)]
    h(spark.createDataFrame([(1, 9), (2, 2)], "k int, v int"), 1)
    assert sorted(tuple(r) for r in store.read().collect()) == [(1, 9), (2, 2)]
    ap = TableStore(spark, f"{tmp_dir}/a")
    g = S.append_sink(ap, "q")
    g(a, 3)
    g(a, 3)
    assert ap.read().count() == 1
    g(a, 4)
    assert ap.read().count() == 2


def test_running_count_and_pass_through(spark, tmp_dir):
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    stream = S.read_events(spark, e.schema, path=f"{SF_SMALL}/event[s].parquet", fmt="parquet")
    cnt = S.running_count(stream, F.col("value") > 5)
    res = {}

    def keep(b, bid):
        res["n"] = b.first()["n"]
    S.start(cnt, sink=keep, mode="complete", available_now=True, checkpoint=f"{tmp_dir}/ck").awaitTermination()
    assert res["n"] == e.where("value > 5").count()


def test_event_time_from_epoch_and_text(spark):
    df = spark.createDataFrame([(1704067207179, "2024-01-01 00:00:07")], "ms long, s string")
    a = S.with_event_time(df, "t", epoch_millis="ms").first()["t"]
    b = S.with_event_time(df, "t2", text="s").first()["t2"]
    assert a.replace(tzinfo=None) == dt.datetime(2024, 1, 1, 0, 0, 7, 179000)
    assert b.replace(tzinfo=None) == dt.datetime(2024, 1, 1, 0, 0, 7)


def test_publish_json_then_read_back(spark, tmp_dir):
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "ts", "user_id", "value")
    S.publish_json(e, e.columns, path=f"{tmp_dir}/topic")
    assert len([f for f in os.listdir(f"{tmp_dir}/topic") if f.endswith(".txt")]) >= 1
    back = S.read_events(spark, e.schema, path=f"{tmp_dir}/topic", fmt="json")
    out = f"{tmp_dir}/back"
    S.start(back, fmt="parquet", path=out, available_now=True, checkpoint=f"{tmp_dir}/ck").awaitTermination()
    assert _norm(spark.read.parquet(out), e.columns) == _norm(e, e.columns)


def test_stream_global_sessions_per_location_equal_batch(spark, tmp_dir):
    from tripmart.streaming.global_sessions import PARTITIONS, global_sessions, start_summaries
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    src = f"{tmp_dir}/in"
    schema = _split_events(spark, f"{SF_SMALL}/events.parquet", src)
    # rows without a location count in their session, rows without a time in none
    last = e.agg(F.max("ts")).first()[0]
    odd = [(10 ** 9, last, None, "x", 1.25, "{}"), (10 ** 9 + 1, None, 3, "x", 9.0, "{}")]
    spark.createDataFrame(odd, schema).coalesce(1).write.parquet(f"{src}/part9")
    stream = S.with_event_time(S.read_events(spark, schema, path=f"{src}/part*", fmt="parquet", max_files=1),
                               "ts", "5 seconds")
    store = TableStore(spark, f"{tmp_dir}/out", PARTITIONS)
    start_summaries(stream, store, "ts", "user_id", "value", available_now=True, checkpoint=f"{tmp_dir}/ck").awaitTermination()
    got = {(r.session_start.replace(tzinfo=None), r.location): (r.num_events, round(float(r.total_amount), 2))
           for r in global_sessions(store.read(), 300).collect()}
    all_rows = e.unionByName(spark.createDataFrame(odd, schema))
    t = islands(all_rows.where("ts IS NOT NULL"), "ts", 300, [], session_col="sid")
    start = t.groupBy("sid").agg(F.min("ts").alias("s"))
    per = t.groupBy("sid", "user_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).alias("v")) \
        .join(start, "sid")
    assert got == {(r.s, r.user_id): (r.n, round(float(r.v), 2)) for r in per.collect()}


def test_sessions_without_keys_sort_no_bucket_rows_in_one_task(spark):
    from tripmart.operators import windows as Wn
    e = spark.read.parquet(f"{SF_MID}/events.parquet").select("ts", "user_id", "event_id")
    df = Wn.session_totals(e, "ts", 300, [], by=["user_id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    single = [x for x in plan.split("Exchange ") if x.startswith("SinglePartition")]
    assert all("__chunk" in x.split("+-", 2)[1] for x in single), plan    # one row per chunk of buckets only
    null_keys = e.withColumn("user_id", F.when(F.col("user_id") % 3 == 0, None).otherwise(F.col("user_id")))
    s = Wn.session_totals(null_keys, "ts", 300, ["user_id"])
    assert s.agg(F.sum("num_events")).first()[0] == e.count()


def test_stream_restarts_from_checkpoint(spark, tmp_dir):
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    e.where("event_id < 500").coalesce(1).write.parquet(f"{tmp_dir}/in/a")
    out, ck = f"{tmp_dir}/out", f"{tmp_dir}/ck"
    S.start(S.read_events(spark, e.schema, path=f"{tmp_dir}/in/*", fmt="parquet"), fmt="parquet", path=out,
            available_now=True, checkpoint=ck).awaitTermination()
    e.where("event_id >= 500").coalesce(1).write.parquet(f"{tmp_dir}/in/b")
    S.start(S.read_events(spark, e.schema, path=f"{tmp_dir}/in/*", fmt="parquet"), fmt="parquet", path=out,
            available_now=True, checkpoint=ck).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == e.count() and got.select("event_id").distinct().count() == e.count()


def test_hot_key_third_of_rows_sessions_and_dedupe(spark):
    """One user holds a third of all events: bucketed sessions and the
    combining dedupe still equal the straightforward per-key forms."""
    from pyspark.sql import Window
    from tripmart.operators.dedupe import dedupe_first
    e = spark.read.parquet(f"{SF_MID}/events.parquet")
    hot = e.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    aggs = [F.count(F.lit(1)).alias("n")]
    a = sessions(hot, "ts", 300, ["user_id"], aggs)
    b = session_window_agg(hot, "ts", "5 minutes", ["user_id"], aggs)
    cols = ["user_id", "session_start", "session_end", "n"]
    assert _norm(a, cols) == _norm(b, cols)
    assert hot.where("user_id = 0").count() * 3 >= e.count() - 3
    d = dedupe_first(hot, ["user_id"], ["ts"])
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    ref = hot.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert _norm(d, hot.columns) == _norm(ref, hot.columns)


def test_session_totals_equal_row_level_sessions(spark):
    from tripmart.operators.windows import session_totals
    e = spark.read.parquet(f"{SF_MID}/events.parquet").withColumn("amount", F.col("value").cast("decimal(18,2)"))
    hot = e.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    for df in (e, hot):
        a = session_totals(df, "ts", 300, ["user_id"], ["amount"], sum_names=["total"])
        b = sessions(df, "ts", 300, ["user_id"], [F.count(F.lit(1)).alias("num_events"), F.sum("amount").alias("total")])
        cols = ["user_id", "session_start", "session_end", "num_events", "total"]
        assert _norm(a, cols) == _norm(b, cols)
    # global sessions reported per user
    g = session_totals(e, "ts", 300, [], ["amount"], by=["user_id"], sum_names=["total"])
    t = islands(e, "ts", 300, [], session_col="sid")
    bounds = t.groupBy("sid").agg(F.min("ts").alias("s"), F.max("ts").alias("l"))
    ref = t.groupBy("sid", "user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("v")).join(bounds, "sid")
    got = sorted((r.session_start, r.user_id, r.num_events, r.total) for r in g.collect())
    assert got == sorted((r.s, r.user_id, r.n, r.v) for r in ref.collect())


def test_session_totals_ignore_rows_without_event_time(spark):
    from tripmart.operators.windows import session_totals
    rows = [(1, B, 1.0), (1, B + dt.timedelta(minutes=2), 2.0), (1, None, 5.0)]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, v double")
    got = [tuple(r) for r in session_totals(df, "ts", 300, ["k"], ["v"]).collect()]
    assert got == [(1, B, B + dt.timedelta(minutes=7), 2, 3.0)]
    w = session_window_agg(df.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "5 minutes", ["k"],
                           [F.count(F.lit(1)).alias("n")])
    assert [r.n for r in w.collect()] == [2]


def test_islands_leave_rows_without_event_time_untagged(spark):
    rows = [(1, 1, B), (2, 1, B + dt.timedelta(minutes=10)), (3, 1, None)]
    df = spark.createDataFrame(rows, "id int, k int, ts timestamp_ntz")
    got = sorted((r.id, r.sid) for r in islands(df, "ts", 300, ["k"], session_col="sid").collect())
    assert got == [(1, 1), (2, 2), (3, None)]


def test_tumbling_ignores_rows_without_event_time(spark):
    df = spark.createDataFrame([(1, B), (1, B + dt.timedelta(minutes=30)), (1, None)], "k int, ts timestamp_ntz")
    got = [(r.window_start, r.n) for r in tumbling(df, "ts", "1 hour", ["k"], [F.count(F.lit(1)).alias("n")]).collect()]
    assert got == [(B, 2)]
