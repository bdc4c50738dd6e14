"""The four streaming jobs over ride events, wired from the operators in
:mod:`tripmart.streaming.jobs`:

* ``hourly_by_location``  1-hour tumbling window per pickup location: trips, revenue
* ``hourly_tips``         1-hour tumbling window over all locations: total tip
* ``session_streaks``     per-minute summaries from which 5-minute-gap sessions over
                          all events are read, per location
* ``pass_through``        projected events appended as they come

Each returns a started ``StreamingQuery``.  ``events`` is a stream with an
event-time column already watermarked (``with_event_time``).  Windows and
summaries run in update mode into a keyed upsert table; every sink is idempotent per micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripmart.functions.columns import instant_to_naive
from tripmart.operators.table_store import TableStore
from tripmart.streaming.global_sessions import start_summaries
from tripmart.streaming.jobs import append_sink, start, tumbling_counts, upsert_sink


def with_window_date(agg: DataFrame) -> DataFrame:
    """Add ``window_date`` (UTC day of the window start): partition window
    tables by it so each micro-batch's upsert rewrites only the days it
    touches instead of the whole, ever-growing table."""
    return agg.withColumn("window_date", F.to_date(instant_to_naive("window_start")))


def money_sum(column: str, name: str):
    """Exact sum of an amount: DECIMAL before it is added, never float."""
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("decimal(38,2)").alias(name)


def hourly_by_location(events: DataFrame, target: TableStore, ts: str = "event_timestamp",
                       location: str = "pickup_location_id", amount: str = "total_amount", **start_kw) -> StreamingQuery:
    agg = tumbling_counts(events, ts, "1 hour", [location],
                          [F.count(F.lit(1)).alias("num_trips"), money_sum(amount, "total_revenue")])
    return start(with_window_date(agg), sink=upsert_sink(target, ["window_start", location], "hourly_by_location"),
                 mode="update", **start_kw)


def hourly_tips(events: DataFrame, target: TableStore, ts: str = "event_timestamp", tip: str = "tip_amount",
                **start_kw) -> StreamingQuery:
    agg = tumbling_counts(events, ts, "1 hour", [], [money_sum(tip, "total_tip")])
    return start(with_window_date(agg), sink=upsert_sink(target, ["window_start"], "hourly_tips"), mode="update",
                 **start_kw)


def session_streaks(events: DataFrame, target: TableStore, ts: str = "event_timestamp",
                    location: str = "pickup_location_id", amount: str = "total_amount", **start_kw) -> StreamingQuery:
    """Keeps per-minute summaries in ``target`` (partitioned by ``day``);
    :func:`tripmart.streaming.global_sessions.global_sessions` reads the sessions from them."""
    return start_summaries(events, target, ts, location, amount, "session_streaks", **start_kw)


def pass_through(events: DataFrame, target: TableStore, columns: list[str], **start_kw) -> StreamingQuery:
    return start(events.select(*columns), sink=append_sink(target, "pass_through"), mode="append", **start_kw)


def consume_to_table(spark, schema, target: TableStore, *, kafka_servers: str | None = None,
                     topic: str | None = None, path: str | None = None, fmt: str = "json",
                     max_offsets: int | None = None, max_files: int | None = None, every: str = "5 seconds",
                     name: str = "consumer", once_by: list[str] | None = None, ts: str = "ts", delay: str = "1 day",
                     **start_kw) -> StreamingQuery:
    """Consumer that writes events to a table in micro-batches every ``every``,
    of at most ``max_offsets`` Kafka rows or ``max_files`` files if given;
    offsets are committed to the checkpoint only after the batch's table commit, and
    a replayed batch replaces what it wrote before (exactly once).  A topic that
    holds an event more than once (an at-least-once producer, a topic read from
    the start again) is thinned by ``once_by``: copies that come within ``delay``
    of event time ``ts`` are dropped."""
    from tripmart.streaming.jobs import deduplicated, read_events, with_event_time
    events = read_events(spark, schema, kafka_servers=kafka_servers, topic=topic, path=path, fmt=fmt,
                         max_offsets=max_offsets, max_files=max_files)
    if once_by:
        events = deduplicated(with_event_time(events, ts, delay), once_by)
    return start(events, sink=append_sink(target, name), mode="append", processing_time=every, name=name,
                 **start_kw)
