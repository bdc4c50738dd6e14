"""De-duplication: keep one row per key.

``row_number() = 1`` over a window.  The planner puts a partial group limit
below the exchange, so every task forwards one row per key at most: a key that
holds a third of the table does not land whole in one sort task.  The order is
completed by every remaining column, so two rows tie only when they are
identical, and then either is the same output.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = (),
                 descending: Sequence[str] = ()) -> DataFrame:
    """One row per ``keys``: the first by ``order`` (ascending, NULLs first;
    those in ``descending`` descending, NULLs last), ties broken by all
    remaining columns.  Columns that cannot be ordered (maps) break no tie."""
    keys = list(keys)
    plain = [c for c, t in df.dtypes if c not in keys and c not in order and not t.startswith(("map", "variant"))]
    by = [F.col(c).desc_nulls_last() if c in descending else F.col(c).asc_nulls_first() for c in order if c not in keys]
    by += [F.col(c).asc_nulls_first() for c in plain]
    w = Window.partitionBy(*keys).orderBy(*(by or [F.lit(0)]))
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def dedupe_any(df: DataFrame, keys: Sequence[str], deterministic: bool = True) -> DataFrame:
    """One row per ``keys`` when any row will do.  ``deterministic`` picks the
    smallest remaining row (repeatable); otherwise ``dropDuplicates``."""
    if not deterministic:
        return df.dropDuplicates(list(keys))
    return dedupe_first(df, keys)
