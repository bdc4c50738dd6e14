"""Event-time windows over bounded DataFrames: tumbling windows and sessions.

Tumbling windows are a plain ``groupBy(window(ts, size), keys)`` hash
aggregate (partial + final, skew-tolerant).

Sessions ("gaps and islands": a new session starts when the time since the
previous event of the same key is more than ``gap``) are computed without
sorting a whole key in one task.  Events are cut into fixed time buckets; a
window sort only ever runs inside one (key, bucket).  One summary row per
(key, bucket) carries the bucket's first/last timestamps and break count; a
window over these summaries (one row per bucket, independent of event volume)
decides whether a bucket continues the previous one and gives every bucket its
session-number offset.  The final aggregate per (key, session) combines
map-side, so a long or hot session never gathers on one task either.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions.columns import naive_epoch_micros


def _micros(df: DataFrame, ts: str) -> Column:
    """Epoch micros without the session zone (naive = UTC wall clock)."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return naive_epoch_micros(ts)
    return F.unix_micros(F.col(ts))


def tumbling(df: DataFrame, ts: str, size: str, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Tumbling-window aggregate; output ``window_start``, ``window_end``, keys,
    aggs.  Rows without an event time belong to no window (as in a stream)."""
    g = df.where(F.col(ts).isNotNull()).groupBy(F.window(F.col(ts), size).alias("w"), *keys).agg(*aggs)
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *keys, *[c for c in g.columns if c not in ("w", *keys)])


#: Buckets numbered together: one window task sees at most this many rows of a key.
CHUNK = 1440


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on ``keys``, NULL keys matching each other; ``b`` brings only its other columns."""
    names = {k: f"__r_{k}" for k in keys}
    right = b.withColumnsRenamed(names)
    cond = [a[k].eqNullSafe(right[names[k]]) for k in keys]
    return a.join(right, cond, how).drop(*names.values())


def _number(s: DataFrame, keys: Sequence[str], b: str, lo: str, hi: str, gap: int, inner: str | None = None) -> DataFrame:
    """``(*keys, b, __base)``: the session number in which each bucket begins.

    ``s`` has one row per (key, bucket) with its first and last time and,
    where rows of a bucket may lie a gap apart, the breaks inside it.  Buckets
    are numbered inside chunks of :data:`CHUNK`; one summary row per chunk
    then carries numbers and the last time across chunks, so that no task
    sorts all buckets of a key, not even without keys.
    """
    c = "__chunk"
    keys = list(keys)
    inside = F.col(inner) if inner else F.lit(0)
    w = Window.partitionBy(*keys, c).orderBy(b)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    prev = F.lag(hi).over(w)
    s = s.withColumn(c, F.floor(F.col(b) / F.lit(CHUNK)))
    # the first bucket of a chunk is decided by the chunk before
    s = s.withColumn("__brk", F.when(F.col(lo) - prev > gap, F.lit(1)).otherwise(F.lit(0)))
    s = s.withColumn("__run", F.coalesce(F.sum(F.col("__brk") + inside).over(before), F.lit(0)) + F.col("__brk"))
    chunks = s.groupBy(*keys, c).agg(F.min(lo).alias("__lo"), F.max(hi).alias("__hi"), F.sum(F.col("__brk") + inside).alias("__n"))
    wc = Window.partitionBy(*keys).orderBy(c)
    last = F.lag("__hi").over(wc)
    chunks = chunks.withColumn("__new", F.when(last.isNull() | (F.col("__lo") - last > gap), F.lit(1)).otherwise(F.lit(0)))
    start = F.coalesce(F.sum(F.col("__new") + F.col("__n")).over(wc.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chunks = chunks.select(*keys, c, (start + F.col("__new")).alias("__start"))
    return _same(s, chunks, [*keys, c], "inner").select(*keys, b, (F.col("__start") + F.col("__run")).alias("__base"))


def islands(df: DataFrame, ts: str, gap_seconds: int, keys: Sequence[str] = (),
            bucket_seconds: int = 60, session_col: str = "session_id") -> DataFrame:
    """Tag every row with a session number per ``keys``.

    A row starts a new session when the previous row of the same key is more
    than ``gap_seconds`` earlier (exactly ``gap`` apart stays together).
    Session numbers are dense per key in time order, starting at 1.

    ``bucket_seconds`` bounds both levels of work: a window sort sees one
    key's events of one bucket; the per-key summary scan sees at most one row
    per bucket of the key's time span (a year of minutes is 525,600 rows),
    however many events the key has.  Any bucket width gives the same result.
    """
    keys = list(keys)
    gap = gap_seconds * 1_000_000
    us = "__us"
    b = "__bucket"
    x = df.withColumn(us, _micros(df, ts)).withColumn(b, F.floor(F.col(us) / F.lit(bucket_seconds * 1_000_000)))

    # 1. inside a (key, bucket): break when the gap to the previous row is
    #    > gap, and the running count of such breaks (same window spec, so
    #    both window functions share one sort)
    w_in = Window.partitionBy(*keys, b).orderBy(us)
    prev = F.lag(us).over(w_in)
    x = x.withColumn("__inner_break", F.when(prev.isNotNull() & (F.col(us) - prev > gap), F.lit(1)).otherwise(F.lit(0)))
    x = x.withColumn("__run", F.sum("__inner_break").over(w_in.rowsBetween(Window.unboundedPreceding, 0)))

    # 2. one summary row per (key, bucket); rows without an event time take
    #    no part (their session stays NULL)
    s = x.where(F.col(b).isNotNull()).groupBy(*keys, b).agg(F.min(us).alias("__bmin"), F.max(us).alias("__bmax"),
                               F.sum("__inner_break").alias("__nbreaks"))
    s = _number(s, keys, b, "__bmin", "__bmax", gap, "__nbreaks")

    # 3. session number = bucket base + running inner breaks (no second sort)
    x = _same(x, s, [*keys, b], "left")
    x = x.withColumn(session_col, (F.col("__base") + F.col("__run")).cast("long"))
    return x.drop(us, b, "__inner_break", "__run", "__base")


def sessions(df: DataFrame, ts: str, gap_seconds: int, keys: Sequence[str], aggs: Sequence[Column],
             bucket_seconds: int = 60) -> DataFrame:
    """Session aggregate per key: ``session_start``, ``session_end`` (last event +
    gap, as ``session_window`` reports it), keys and ``aggs``."""
    tagged = islands(df, ts, gap_seconds, keys, bucket_seconds, "__sid")
    g = tagged.groupBy(*keys, "__sid").agg(F.min(ts).alias("session_start"),
                                           F.max(ts).alias("__last"), *aggs)
    return g.select(*keys, "session_start",
                    (F.col("__last") + F.make_dt_interval(secs=F.lit(gap_seconds))).alias("session_end"),
                    *[c for c in g.columns if c not in (*keys, "__sid", "session_start", "__last")])


def session_window_agg(df: DataFrame, ts: str, gap: str, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Same result through Spark's ``session_window`` (the form streams use).
    Batch execution sorts each key's rows in one task, so prefer
    :func:`sessions` for skewed keys."""
    g = df.groupBy(*keys, F.session_window(F.col(ts), gap).alias("sw")).agg(*aggs)
    return g.select(*keys, F.col("sw.start").alias("session_start"), F.col("sw.end").alias("session_end"),
                    *[c for c in g.columns if c not in (*keys, "sw")])


def _from_micros(us: Column, naive: bool) -> Column:
    if naive:
        return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
            secs=(us.cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)"))
    return F.timestamp_micros(us)


def session_totals(df: DataFrame, ts: str, gap_seconds: int, keys: Sequence[str], sums: Sequence[str] = (),
                   by: Sequence[str] = (), bucket_seconds: int = 60, count_name: str = "num_events",
                   sum_names: Sequence[str] | None = None) -> DataFrame:
    """Session counts and sums without sorting rows.

    With ``bucket_seconds <= gap_seconds`` two events of one bucket are never
    more than a gap apart, so sessions are decided by per-bucket (first,
    last) summaries alone: rows are pre-aggregated per (key, bucket[, by])
    by a map-side-combining hash aggregate, sessions are numbered over the
    bucket summaries (one row per bucket), and totals are re-aggregated per
    session.  ``by`` splits each session's totals further (global sessions
    reported per location: ``keys=()``, ``by=("location",)``).

    Output: keys, ``session_start``, ``session_end`` (last event + gap), by,
    ``count_name`` and one sum per column in ``sums`` (named ``sum_names``).
    """
    if bucket_seconds > gap_seconds:
        raise ValueError("bucket_seconds must not exceed gap_seconds")
    keys, by, sums = list(keys), list(by), list(sums)
    sum_names = list(sum_names or [f"sum_{c}" for c in sums])
    naive = isinstance(df.schema[ts].dataType, T.TimestampNTZType)
    gap = gap_seconds * 1_000_000
    us, b = "__us", "__bucket"
    # rows without an event time belong to no session (as with session_window)
    x = df.where(F.col(ts).isNotNull()).select(*keys, *by, *sums, _micros(df, ts).alias(us))
    x = x.withColumn(b, F.floor(F.col(us) / F.lit(bucket_seconds * 1_000_000)))
    fine = x.groupBy(*keys, b, *by).agg(F.min(us).alias("__min"), F.max(us).alias("__max"),
                                        F.count(F.lit(1)).alias("__n"),
                                        *[F.sum(c).alias(f"__s{i}") for i, c in enumerate(sums)])
    return totals_of_buckets(fine, b, gap, keys, by, count_name, sum_names, naive)


def totals_of_buckets(fine: DataFrame, b: str, gap: int, keys: Sequence[str], by: Sequence[str], count_name: str,
                      sum_names: Sequence[str], naive: bool) -> DataFrame:
    """Session totals from summaries ``(*keys, bucket, *by, __min, __max, __n,
    __s0 ..)``, one row per (key, bucket, by); times and ``gap`` in micros."""
    keys, by = list(keys), list(by)
    buckets = fine.groupBy(*keys, b).agg(F.min("__min").alias("__bmin"), F.max("__max").alias("__bmax")) \
        if by else fine.select(*keys, b, F.col("__min").alias("__bmin"), F.col("__max").alias("__bmax"))
    sid = _number(buckets, keys, b, "__bmin", "__bmax", gap).withColumnRenamed("__base", "__sid")
    tagged = _same(fine, sid, [*keys, b], "inner")
    per = tagged.groupBy(*keys, "__sid", *by).agg(
        F.min("__min").alias("__start"), F.max("__max").alias("__last"), F.sum("__n").alias(count_name),
        *[F.sum(f"__s{i}").alias(n) for i, n in enumerate(sum_names)])
    if by:
        # a session's start and end span all its ``by`` groups
        bounds = tagged.groupBy(*keys, "__sid").agg(F.min("__min").alias("__gmin"), F.max("__max").alias("__gmax"))
        per = (_same(per, bounds, [*keys, "__sid"], "inner")
                  .withColumn("__start", F.col("__gmin")).withColumn("__last", F.col("__gmax")))
    return per.select(*keys, _from_micros(F.col("__start"), naive).alias("session_start"),
                      _from_micros(F.col("__last") + F.lit(gap), naive).alias("session_end"),
                      *by, count_name, *sum_names)
