"""Registered queries of the stream building blocks.

The events arrive in blocks; each block is written below the stream's folder
and taken by one run of the query, which goes on from its checkpoint, so the
order of arrival is the same at every size.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions import columns as C
from tripmart.operators.table_store import TableStore
from tripmart.plans.queries import _E_MONEY, _ISLANDS, _WM, W, _event_stream, _run_to_table, _scratch, register
from tripmart.plans.trips import events
from tripmart.streaming import chained
from tripmart.streaming.jobs import append_sink, deduplicated, read_events, start, with_event_time
from tripmart.streaming.late import split_sink

COLUMNS = ["event_id", "ts", "user_id", "value"]


def _arrive(spark, blocks: Iterable[DataFrame], run: Callable[[DataFrame], None]) -> None:
    """Write block after block and let the stream take each."""
    path = _scratch(spark, "arrivals")
    for i, block in enumerate(blocks):
        block.write.parquet(f"{path}/block={i}")
        run(read_events(spark, block.schema, path=f"{path}/block=*", fmt="parquet"))


@register("stream_once", "SELECT event_id, ts, user_id, value FROM events")
def q_stream_once(spark, d):
    """An at-least-once topic: every fifth event is sent twice, and each block
    begins with the last tenth of all events once more."""
    e = events(spark, d).select(*COLUMNS)
    n = e.count()
    blocks = []
    for i in range(4):
        lo, hi = n * i // 4, n * (i + 1) // 4
        own = e.where((F.col("event_id") >= max(0, lo - n // 10)) & (F.col("event_id") < hi))
        blocks.append(own.union(own.where("event_id % 5 = 0")))
    store = TableStore(spark, _scratch(spark, "stream_tables"))
    name = f"once_{uuid.uuid4().hex[:8]}"

    def run(stream: DataFrame) -> None:
        once = deduplicated(with_event_time(stream, "ts", "6 days"), ["event_id"])
        start(once, sink=append_sink(store, name), available_now=True, name=name).awaitTermination()

    _arrive(spark, blocks, run)
    return store.read().withColumn("ts", C.instant_to_naive("ts"))


@register("stream_restarted_consumer", "SELECT event_id, ts, user_id, value FROM events")
def q_stream_restarted_consumer(spark, d):
    """A consumer that is stopped and started again without naming a checkpoint
    goes on after its last commit, a file a micro-batch."""
    from tripmart.streaming.ride_jobs import consume_to_table
    e = events(spark, d).select(*COLUMNS)
    half = e.count() // 2
    store = TableStore(spark, _scratch(spark, "stream_tables"))
    path = _scratch(spark, "arrivals")
    for i, block in enumerate((e.where(F.col("event_id") < half), e.where(F.col("event_id") >= half))):
        block.write.parquet(f"{path}/block={i}")
        consume_to_table(spark, e.schema, store, path=f"{path}/block=*", fmt="parquet", max_files=1, available_now=True).awaitTermination()
    return store.read()


@register("stream_time_from_text", """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, COUNT(*) AS num_events FROM events GROUP BY 1""")
def q_stream_time_from_text(spark, d):
    """Event time written as text in JSON lines."""
    from tripmart.streaming.jobs import tumbling_counts, upsert_sink
    path = _scratch(spark, "topic")
    e = events(spark, d).select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"))
    e.write.json(path)
    stream = with_event_time(read_events(spark, e.schema, path=path), "ts", "5 seconds", text="at")
    store = TableStore(spark, _scratch(spark, "stream_tables"))
    agg = tumbling_counts(stream, "ts", "1 hour", [], [F.count(F.lit(1)).alias("num_events")])
    start(agg, sink=upsert_sink(store, ["window_start"], "hours"), mode="update", available_now=True).awaitTermination()
    return store.read().select(C.instant_to_naive("window_start").alias("window_start"), "num_events")


@register("stream_tumble_5m_by_key", f"""
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, event_type, COUNT(*) AS num_events, CAST(SUM({_E_MONEY}) AS DECIMAL(38,2)) AS total_value
FROM events GROUP BY 1, 2""")
def q_stream_tumble_5m_by_key(spark, d):
    """Two runs over the same table, the second after more events: windows that
    grow are replaced by key, in the days they lie in."""
    from tripmart.streaming.jobs import tumbling_counts, upsert_sink
    from tripmart.streaming.ride_jobs import money_sum, with_window_date
    e = events(spark, d).select("event_id", "ts", "event_type", "value")
    half = e.count() // 2
    store = TableStore(spark, _scratch(spark, "stream_tables"), ["window_date"])

    def run(stream: DataFrame) -> None:
        agg = tumbling_counts(with_event_time(stream, "ts", "5 seconds"), "ts", "5 minutes", ["event_type"],
                              [F.count(F.lit(1)).alias("num_events"), money_sum("value", "total_value")])
        start(with_window_date(agg), sink=upsert_sink(store, ["window_start", "event_type"], "five_minutes"), mode="update",
              available_now=True).awaitTermination()

    _arrive(spark, [e.where(F.col("event_id") < half), e.where(F.col("event_id") >= half)], run)
    return store.read().select(C.instant_to_naive("window_start").alias("window_start"), "event_type", "num_events", "total_value")


@register("stream_count_above", "SELECT COUNT(*) AS n FROM events WHERE value > 10")
def q_stream_count_above(spark, d):
    """A running total over a filtered stream; each run's total replaces the last."""
    from tripmart.streaming.jobs import running_count
    store = TableStore(spark, _scratch(spark, "stream_tables"))
    e = events(spark, d).select(*COLUMNS)

    def replace(batch: DataFrame, batch_id: int) -> None:
        store.overwrite(batch)
    replace.checkpoint = f"{store.path}/_checkpoints/count"

    def run(stream: DataFrame) -> None:
        start(running_count(stream, F.col("value") > 10), sink=replace, mode="complete", available_now=True).awaitTermination()

    _arrive(spark, [e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1")], run)
    return store.read()


_ARRIVALS = """
a AS (
  SELECT event_id, ts, least(3, CAST(floor((event_id + CASE WHEN event_id % 13 = 0 THEN n / 4.0 ELSE 0 END) * 4 / n) AS BIGINT)) AS batch_id
  FROM events, (SELECT COUNT(*) AS n FROM events)
), m AS (
  SELECT batch_id, MAX(MAX(ts)) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM a GROUP BY batch_id
), l AS (
  SELECT a.*, coalesce(ts < date_trunc('millisecond', newest - INTERVAL 1 HOUR), false) AS late FROM a JOIN m USING (batch_id)
)"""


@register("stream_late_rows", W("""
SELECT batch_id, COUNT(*) FILTER (WHERE NOT late) AS in_time, COUNT(*) FILTER (WHERE late) AS late,
       CAST(SUM(CASE WHEN late THEN event_id ELSE 0 END) AS BIGINT) AS late_ids
FROM l GROUP BY batch_id""", _ARRIVALS))
def q_stream_late_rows(spark, d):
    """Every thirteenth event arrives a quarter of all events later: counted and
    kept by batch, with the ids found in the side table."""
    e = events(spark, d).select("event_id", "ts")
    n = e.count()
    arrives = F.col("event_id") + F.when(F.col("event_id") % 13 == 0, F.lit(n) / 4).otherwise(0)
    block = F.least(F.lit(3), F.floor(arrives * 4 / n)).cast("long")
    rows, account = TableStore(spark, _scratch(spark, "split"), ["late"]), TableStore(spark, _scratch(spark, "account"))
    name = f"late_{uuid.uuid4().hex[:8]}"

    def run(stream: DataFrame) -> None:
        start(with_event_time(stream, "ts", "1 hour"), sink=split_sink(rows, account, "ts", "1 hour", name), available_now=True,
              name=name).awaitTermination()

    _arrive(spark, [e.withColumn("sent", block).where(F.col("sent") == i) for i in range(4)], run)
    kept = rows.read().groupBy(F.col("sent").alias("batch_id")).agg(F.sum(F.when(F.col("late"), F.col("event_id")).otherwise(0)).alias("late_ids"))
    return account.read().select("batch_id", "in_time", "late").join(kept, "batch_id")


@register("stream_best_hour_by_day", f"""
WITH h AS (
  SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, CAST(SUM({_E_MONEY}) AS DECIMAL(38,2)) AS total_value FROM events
  GROUP BY 1 HAVING time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= {_WM}
)
SELECT date_trunc('day', window_start)::TIMESTAMP AS day, window_start, total_value FROM h
WHERE date_trunc('day', window_start) + INTERVAL 1 DAY <= {_WM}
QUALIFY row_number() OVER (PARTITION BY date_trunc('day', window_start) ORDER BY total_value DESC, window_start) = 1""")
def q_stream_best_hour_by_day(spark, d):
    s = with_event_time(_event_stream(spark, d), "ts", "5 seconds").withColumn("amount", F.col("value").cast("decimal(18,2)"))
    best = chained.best_window_per_day(s, "ts", "1 hour", F.sum("amount").cast("decimal(38,2)"))
    r = _run_to_table(spark, best, "best_hours").read()
    return r.select(C.instant_to_naive("day").alias("day"), C.instant_to_naive("window_start").alias("window_start"), F.col("total").alias("total_value"))


@register("stream_longest_session_by_day", W(f"""
SELECT date_trunc('day', session_end - INTERVAL 1 MICROSECOND)::TIMESTAMP AS day, user_id, num_events, session_start, session_end FROM (
  SELECT user_id, COUNT(*) AS num_events, MIN(ts) AS session_start, MAX(ts) + INTERVAL 5 MINUTE AS session_end
  FROM isl GROUP BY user_id, sid)
WHERE date_trunc('day', session_end - INTERVAL 1 MICROSECOND) + INTERVAL 1 DAY <= {_WM}
QUALIFY row_number() OVER (PARTITION BY day, user_id ORDER BY num_events DESC, session_start) = 1""", _ISLANDS.format(p="user_id")))
def q_stream_longest_session_by_day(spark, d):
    s = with_event_time(_event_stream(spark, d), "ts", "5 seconds")
    best = chained.longest_session_per_day(s, "ts", "5 minutes", "user_id")
    r = _run_to_table(spark, best, "longest_sessions").read()
    return r.select(C.instant_to_naive("day").alias("day"), "user_id", "num_events", C.instant_to_naive("session_start").alias("session_start"),
                    C.instant_to_naive("session_end").alias("session_end"))
