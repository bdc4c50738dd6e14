"""Two event-time aggregations, one after the other, in one stream.

The first closes windows or sessions; ``window_time`` gives each closed one an
event time, on which the second aggregates by day.  Both run in append mode, so
a day comes out once, when the watermark has passed its end, and the state of
either operator holds only what is open.  Spark hands the watermark from the
first operator on to the second.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Days are counted in UTC, whatever the session's time zone.
DAY = "1 day"


def _by_day(closed: DataFrame, window: str, keys: list[str], best: Column, name: str) -> DataFrame:
    day = closed.groupBy(F.window(F.window_time(F.col(window)), DAY).alias("day"), *keys)
    return day.agg(best.alias(name)).select(F.col("day.start").alias("day"), *keys, name)


def best_window_per_day(stream: DataFrame, ts: str, size: str, total: Column) -> DataFrame:
    """``(day, window_start, total)``: each closed day's window with the largest
    ``total``, the earliest of equal ones."""
    windows = stream.groupBy(F.window(F.col(ts), size).alias("w")).agg(total.alias("total"))
    best = F.max(F.struct("total", (-F.unix_micros("w.start")).alias("before")))
    out = _by_day(windows, "w", [], best, "best")
    return out.select("day", F.timestamp_micros(-F.col("best.before")).alias("window_start"), F.col("best.total").alias("total"))


def longest_session_per_day(stream: DataFrame, ts: str, gap: str, key: str) -> DataFrame:
    """``(day, key, num_events, session_start, session_end)``: of the sessions
    that end in a closed day the one with most events, the earliest of equal ones."""
    sessions = stream.groupBy(F.session_window(F.col(ts), gap).alias("w"), key).agg(F.count(F.lit(1)).alias("num_events"))
    best = F.max(F.struct("num_events", (-F.unix_micros("w.start")).alias("before"), F.col("w.end").alias("end")))
    out = _by_day(sessions, "w", [key], best, "best")
    return out.select("day", key, F.col("best.num_events").alias("num_events"),
                      F.timestamp_micros(-F.col("best.before")).alias("session_start"), F.col("best.end").alias("session_end"))
