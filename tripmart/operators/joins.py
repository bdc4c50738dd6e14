"""Join helpers: size-checked broadcast, role-playing dimensions, NOT IN."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Broadcast only below this estimated size (bytes).  Above it the join is
# left to the planner (sort-merge / shuffle-hash, AQE may still switch to a
# broadcast at runtime when the real size turns out small).
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df``'s optimized plan (no job is run)."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    except Exception:  # pragma: no cover - connect sessions have no _jdf
        return 1 << 62
    return int(size if isinstance(size, int) else size.toString())


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only when the plan's size estimate is within bound."""
    return F.broadcast(df) if estimated_bytes(df) <= max_bytes else df


def lookup(fact: DataFrame, dim: DataFrame, on: Column | str | Sequence[str], how: str = "left",
           max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Fact-to-dimension join; the dimension is broadcast when its size is proven small."""
    return fact.join(broadcast_if_small(dim, max_bytes), on, how)


def role_playing(fact: DataFrame, dim: DataFrame, dim_key: str,
                 roles: Mapping[str, str], columns: Sequence[str], how: str = "left",
                 max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Join one dimension several times under different roles.

    ``roles`` maps an output prefix to the fact column holding the key, e.g.
    ``{"pickup": "pickup_location_id", "dropoff": "dropoff_location_id"}``;
    dimension ``columns`` come out as ``<prefix>_<column>``.
    """
    small = broadcast_if_small(dim.select(dim_key, *columns), max_bytes)
    out = fact
    for prefix, fact_key in roles.items():
        d = small.select(F.col(dim_key).alias(f"__{prefix}_key"),
                         *[F.col(c).alias(f"{prefix}_{c}") for c in columns])
        out = out.join(d, out[fact_key] == d[f"__{prefix}_key"], how).drop(f"__{prefix}_key")
    return out


def not_in(df: DataFrame, key: str, sub: DataFrame, sub_key: str) -> DataFrame:
    """SQL ``key NOT IN (SELECT sub_key FROM sub)`` with its NULL semantics:
    an empty subquery keeps every row; otherwise a NULL key, or any NULL in
    the subquery, makes the predicate unknown (row dropped).

    Plan: a distributed left-anti join on the key (never a nested loop) plus
    one scalar subquery (row count, NULL count) over the subquery side.
    """
    s = sub.select(F.col(sub_key).alias("__k")).distinct()
    stats = s.select(F.struct(F.count(F.lit(1)).alias("n"), F.count_if(F.col("__k").isNull()).alias("nulls"))).scalar()
    n_sub, n_null = stats.getField("n"), stats.getField("nulls")
    anti = df.join(s.where(F.col("__k").isNotNull()), df[key] == F.col("__k"), "left_anti")
    keep = (n_sub == 0) | (F.col(key).isNotNull() & (n_null == 0))
    return anti.where(keep)
