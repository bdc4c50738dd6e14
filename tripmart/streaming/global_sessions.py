"""Session windows over ALL events (no partition key), reported per location.

Spark's ``session_window`` needs a grouping key and would give per-location
sessions.  Here the stream keeps one summary per (minute, location): first and
last event, count, exact DECIMAL sum.  It is an ordinary keyed aggregation, so
state and work spread over all tasks, and it upserts into a table partitioned
by day in update mode, so that the table always holds every event that came in
time.  Sessions are assembled from that table by the batch operators
(:func:`global_sessions`): two events of one minute are never a gap apart, so
summaries lose nothing, open sessions are there as soon as their first event,
and a bounded run has all of them at its end.

Events without a time belong to no session; events without a location form a
group of their own (NULL).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripmart.operators.table_store import TableStore
from tripmart.operators.windows import totals_of_buckets
from tripmart.streaming.jobs import start, upsert_sink

MINUTE = 60_000_000
#: A NULL key would never match in an upsert, so the table holds the location as text with this for NULL.
NO_LOCATION = ""
PARTITIONS = ["day"]


def minute_summaries(events: DataFrame, ts: str, location: str, amount: str) -> DataFrame:
    """``(day, bucket, location, __min, __max, __n, __s0)`` per minute and location of a watermarked stream."""
    x = events.where(F.col(ts).isNotNull()).select(
        ts, F.coalesce(F.col(location).cast("string"), F.lit(NO_LOCATION)).alias("location"),
        F.col(amount).cast("decimal(18,2)").alias("amount"))
    us = F.unix_micros(F.col(ts))
    g = x.groupBy(F.window(F.col(ts), "1 minute").alias("w"), "location").agg(
        F.min(us).alias("__min"), F.max(us).alias("__max"), F.count(F.lit(1)).alias("__n"),
        F.sum("amount").cast("decimal(38,2)").alias("__s0"))
    bucket = F.floor(F.unix_micros("w.start") / F.lit(MINUTE)).alias("bucket")
    return g.select(F.date_from_unix_date(F.floor(F.unix_micros("w.start") / F.lit(86_400_000_000)).cast("int")).alias("day"),
                    bucket, "location", "__min", "__max", "__n", "__s0")


def start_summaries(events: DataFrame, target: TableStore, ts: str, location: str, amount: str,
                    name: str = "minute_summaries", **start_kw) -> StreamingQuery:
    """Keep ``target`` (partitioned by :data:`PARTITIONS`) up to date with the stream's summaries."""
    return start(minute_summaries(events, ts, location, amount), mode="update",
                 sink=upsert_sink(target, ["bucket", "location"], name), **start_kw)


def global_sessions(summaries: DataFrame, gap_seconds: int = 300) -> DataFrame:
    """``(session_start, session_end, location, num_events, total_amount)`` of all sessions, the open one included."""
    if gap_seconds < 60:
        raise ValueError("summaries are per minute: the gap must be a minute at least")
    out = totals_of_buckets(summaries.drop("day"), "bucket", gap_seconds * 1_000_000, [], ["location"], "num_events",
                            ["total_amount"], naive=False)
    return out.withColumns({"location": F.nullif(F.col("location"), F.lit(NO_LOCATION)).cast("long"),
                            "total_amount": F.col("total_amount").cast("decimal(38,2)")})
