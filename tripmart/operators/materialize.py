"""Incremental materializations on plain Parquet.

Each strategy has a *pure core* ``f(target_df, source_df) -> new_target_df``
(usable as an ordinary query) and is applied to storage by
:class:`tripmart.operators.table_store.TableStore`, which rewrites only the
partitions the change touches.

Plain Parquet has no MERGE/DELETE, so every core is expressed with joins:
anti-joins on the key (shuffle or broadcast as the planner decides, never a
nested loop) plus UNION ALL by name.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def append(target: DataFrame, source: DataFrame) -> DataFrame:
    """``append``: every source row is added."""
    return target.unionByName(source, allowMissingColumns=True)


def merge_insert(target: DataFrame, source: DataFrame, key: Sequence[str], dedupe: bool = False, small_batch: bool = False) -> DataFrame:
    """Insert-only MERGE: source rows whose key is not in the target.

    As in ``MERGE ... WHEN NOT MATCHED THEN INSERT``, duplicates *inside* the
    batch are all inserted and a NULL key never matches; ``dedupe=True``
    keeps one row per key of the batch instead.  ``small_batch`` as in
    :func:`new_rows`.
    """
    key = list(key)
    src = source.dropDuplicates(key) if dedupe else source
    return target.unionByName(new_rows(target, src, key, small_batch), allowMissingColumns=True)


def key_set(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Distinct key values of ``df``.  The distinct runs map-side first, so a
    key repeated in a third of the rows is shuffled once per task instead of
    once per row; whether the set is small enough to broadcast is left to the
    planner, which knows its real size at run time."""
    return df.select(*key).distinct()


def keys_in(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """Distinct keys of ``target`` that ``source`` has.

    A semi join, whose left side the planner may thin before it is shuffled: by
    a broadcast of the batch's keys while they are few, beyond that by a Bloom
    filter of them that is built first and pushed to the target's scan
    (``spark.sql.optimizer.runtime.bloomFilter.*``), so that of the target only
    rows that may match are shuffled."""
    key = list(key)
    return target.select(*key).join(key_set(source, key), key, "left_semi").distinct()


def new_rows(target: DataFrame, source: DataFrame, key: Sequence[str], small_batch: bool = False) -> DataFrame:
    """Source rows whose key does not occur in the target (NULL-safe: a NULL
    key part never matches, like an equality join).  For a ``small_batch``,
    which is worth a second reading, the target is first cut down to the keys
    the batch has (:func:`keys_in`)."""
    t = (keys_in(target, source, key) if small_batch else key_set(target, key)).select(*[F.col(k).alias(f"__t_{k}") for k in key])
    cond = [source[k] == t[f"__t_{k}"] for k in key]
    return source.join(t, cond, "left_anti")


def merge_upsert(target: DataFrame, source: DataFrame, key: Sequence[str], add_columns: bool = True) -> DataFrame:
    """Upsert on a unique key: source rows replace target rows with the same
    key; new keys are inserted.  ``add_columns`` appends columns that only the
    source has (older rows get NULL); otherwise the target schema is kept.
    The source must be unique on ``key`` (see :func:`assert_unique`)."""
    key = list(key)
    kept = target.join(key_set(source, key), key, "left_anti")
    out = kept.unionByName(source, allowMissingColumns=True)
    if not add_columns:
        out = out.select(*target.columns)
    return out


def assert_unique(source: DataFrame, key: Sequence[str]) -> None:
    """Fail like a MERGE would when a key occurs twice in the source.  A key
    with a NULL part never matches in a MERGE, so such rows are exempt.
    Runs one aggregate job; only a flag comes back to the driver."""
    nn = source
    for k in key:
        nn = nn.where(F.col(k).isNotNull())
    dup = nn.groupBy(*key).count().where("count > 1").limit(1).count()
    if dup:
        raise ValueError(f"source has duplicate keys on {list(key)}")


def high_water_filter(df: DataFrame, target: DataFrame, ts: str,
                      lookback: _dt.timedelta | None = None) -> DataFrame:
    """Incremental filter: rows newer than the target's maximum ``ts``
    (a scalar subquery).  An empty target passes every row with a time, and
    rows without one too.  ``lookback`` widens the window so that late rows are
    re-read (pair with an upsert).

    The mark is fetched first (one aggregate row), so that the filter is a
    plain range, which reaches the scan."""
    hw = target.agg(F.max(ts)).first()[0]
    if hw is None:
        return df
    return df.where(F.col(ts) > F.lit(hw - lookback if lookback is not None else hw))


def in_window(ts: Column, start, end) -> Column:
    """Half-open ``start <= ts < end``.  A plain conjunction so that it is
    pushed into the Parquet scan; a NULL ``ts`` evaluates to NULL, which a
    filter drops, i.e. NULL is outside the window."""
    return (ts >= F.lit(start)) & (ts < F.lit(end))


def outside_window(ts: Column, start, end) -> Column:
    """Exact complement of :func:`in_window` (NULL ``ts`` is outside)."""
    return ts.isNull() | (ts < F.lit(start)) | (ts >= F.lit(end))


def replace_interval(target: DataFrame, source: DataFrame, ts: Column | str, start, end) -> DataFrame:
    """``time_interval``: delete target rows in ``[start, end)`` then insert
    the source rows in the same interval."""
    tcol = F.col(ts) if isinstance(ts, str) else ts
    return (target.where(outside_window(tcol, start, end))
                  .unionByName(source.where(in_window(tcol, start, end)), allowMissingColumns=True))


def delete_insert(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """``delete+insert``: drop every target row whose key value occurs in the
    source, then insert all source rows."""
    key = list(key)
    return target.join(key_set(source, key), key, "left_anti").unionByName(source, allowMissingColumns=True)


def truncate_insert(target: DataFrame, source: DataFrame) -> DataFrame:
    """Full refresh that keeps the target's schema."""
    return source.select(*[F.col(c).cast(target.schema[c].dataType) for c in target.columns])


def backfill_window(months: Sequence[_dt.date]) -> tuple[_dt.datetime, _dt.datetime]:
    """Half-open time window covering whole months (first .. last, inclusive)."""
    lo, hi = min(months), max(months)
    end = _dt.datetime(hi.year + (hi.month == 12), hi.month % 12 + 1, 1)
    return _dt.datetime(lo.year, lo.month, 1), end
