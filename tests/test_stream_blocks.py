"""Stream building blocks: copies, late rows, chained aggregates."""
import datetime as dt

from pyspark.sql import functions as F

from tripmart.operators.table_store import TableStore
from tripmart.streaming import chained
from tripmart.streaming import jobs as S
from tripmart.streaming import late as L
from tripmart.streaming import ride_jobs as R

B = dt.datetime(2024, 1, 1)
SCHEMA = "event_id long, ts timestamp_ntz, user_id long, value double"


def block(spark, tmp_dir, i, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    df.write.parquet(f"{tmp_dir}/in/block={i}")
    return S.read_events(spark, df.schema, path=f"{tmp_dir}/in/block=*", fmt="parquet")


def minutes(i, m, user=1, value=1.0):
    return i, B + dt.timedelta(minutes=m), user, value


def test_copies_are_dropped_with_bounded_state(spark, tmp_dir):
    store = TableStore(spark, f"{tmp_dir}/t")
    kept = []
    for i in range(6):
        own = [minutes(100 * i + k, 60 * i + k % 60) for k in range(60)]
        again = [minutes(100 * (i - 1) + k, 60 * (i - 1) + k % 60) for k in range(30, 60)] if i else []
        stream = block(spark, tmp_dir, i, own + own[:20] + again)
        q = S.start(S.deduplicated(S.with_event_time(stream, "ts", "40 minutes"), ["event_id"]), sink=S.append_sink(store, "once"), available_now=True)
        q.awaitTermination()
        kept.append(max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]))
    ids = [r.event_id for r in store.read().collect()]
    assert sorted(ids) == [100 * i + k for i in range(6) for k in range(60)]
    assert max(kept) <= 240 and kept[-1] <= kept[2]              # two delays of keys, however long the stream runs


def test_consumer_reads_an_at_least_once_topic(spark, tmp_dir):
    rows = [minutes(k, k) for k in range(50)]
    df = spark.createDataFrame(rows * 2, SCHEMA)
    df.write.parquet(f"{tmp_dir}/in")
    target = TableStore(spark, f"{tmp_dir}/t")
    R.consume_to_table(spark, df.schema, target, path=f"{tmp_dir}/in", fmt="parquet", once_by=["event_id"], available_now=True).awaitTermination()
    assert sorted(r.event_id for r in target.read().collect()) == list(range(50))


def test_late_rows_are_counted_and_kept(spark, tmp_dir):
    rows, account = TableStore(spark, f"{tmp_dir}/rows", ["late"]), TableStore(spark, f"{tmp_dir}/acc")
    blocks = [
        [minutes(1, 0), minutes(2, 90), (3, None, 1, 1.0)],
        [minutes(4, 80), minutes(5, 79), minutes(6, 200)],       # the mark is 90 - 10 minutes
        [minutes(7, 190), minutes(8, 189), minutes(9, 30)],
        [(10, None, 1, 1.0)],
        [minutes(11, 189), minutes(12, 190)]]
    for i, b in enumerate(blocks):
        sink = L.split_sink(rows, account, "ts", "10 minutes")
        S.start(S.with_event_time(block(spark, tmp_dir, i, b), "ts", "10 minutes"), sink=sink, available_now=True).awaitTermination()
    assert sorted(r.event_id for r in L.late(rows).collect()) == [5, 8, 9, 11]
    assert sorted(r.event_id for r in L.in_time(rows).collect()) == [1, 2, 3, 4, 6, 7, 10, 12]
    got = [(r.batch_id, r.in_time, r.late) for r in account.read().orderBy("batch_id").collect()]
    assert got == [(0, 3, 0), (1, 2, 1), (2, 1, 2), (3, 1, 0), (4, 1, 1)]


def test_a_replayed_split_changes_nothing(spark, tmp_dir):
    rows, account = TableStore(spark, f"{tmp_dir}/rows", ["late"]), TableStore(spark, f"{tmp_dir}/acc")
    sink = L.split_sink(rows, account, "ts", "10 minutes")
    batches = [spark.createDataFrame([minutes(i, 100 * i), minutes(10 + i, 5)], SCHEMA) for i in range(3)]
    for i in (0, 1, 1, 2, 2):
        sink(batches[i].withColumn("ts", F.col("ts").cast("timestamp")), i)
    assert rows.read().count() == 6 and account.read().count() == 3
    assert [(r.in_time, r.late) for r in account.read().orderBy("batch_id").collect()] == [(2, 0), (2, 0), (1, 1)]


def test_chained_aggregates_hold_only_what_is_open(spark, tmp_dir):
    out = TableStore(spark, f"{tmp_dir}/best")
    for i in range(5):                                            # a day a block
        stream = block(spark, tmp_dir, i, [minutes(1000 * i + k, 1440 * i + 10 * k, value=float(k % 50)) for k in range(144)])
        s = S.with_event_time(stream, "ts", "5 seconds")
        q = S.start(chained.best_window_per_day(s, "ts", "1 hour", F.sum("value")), sink=S.append_sink(out, "best"), available_now=True)
        q.awaitTermination()
        last = q.recentProgress[-1]["stateOperators"]
        assert len(last) == 2 and sum(o["numRowsTotal"] for o in last) <= 4
    hours = {}
    for i in range(4):                                            # the fifth day is open
        for k in range(144):
            key = i, (10 * k) // 60
            hours[key] = hours.get(key, 0) + k % 50
    want = {i: max((v, -h) for (d, h), v in hours.items() if d == i) for i in range(4)}
    got = {(r.day.replace(tzinfo=None) - B).days: (r.total, -((r.window_start.replace(tzinfo=None) - B).seconds // 3600)) for r in out.read().collect()}
    assert got == want


def test_chained_sessions(spark, tmp_dir):
    day = 1440
    rows = [minutes(1, 0), minutes(2, 3), minutes(3, 100), minutes(4, 104), minutes(5, 106), minutes(6, 5, user=2),
            minutes(7, day - 2), minutes(8, day + 1), minutes(9, day + 500, user=2), minutes(10, 3 * day)]
    s = S.with_event_time(block(spark, tmp_dir, 0, rows), "ts", "5 seconds")
    out = TableStore(spark, f"{tmp_dir}/t")
    S.start(chained.longest_session_per_day(s, "ts", "5 minutes", "user_id"), sink=S.append_sink(out, "s"), available_now=True).awaitTermination()
    got = sorted(((r.day.replace(tzinfo=None) - B).days, r.user_id, r.num_events, (r.session_start.replace(tzinfo=None) - B).total_seconds() // 60) for r in out.read().collect())
    # the session over midnight belongs to the day it ends in
    assert got == [(0, 1, 3, 100), (0, 2, 1, 5), (1, 1, 2, day - 2), (1, 2, 1, day + 500)]
