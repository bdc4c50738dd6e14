"""Checks made while a table is written: no second scan.

Row checks are counted by metrics that the write itself observes.  Those that
must hold are a guard in the plan besides: the first row that breaks one fails
the job, and as Spark commits the files of a job at its end, nothing of it is
ever visible.  Key checks number the rows of a key, which takes a shuffle by
the key but no scan either.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tripmart.operators.quality import Check, violates

REPORT = "check string, column string, severity string, violations long, n_rows long"
KEYED = ("unique", "primary_key")


def _broken(ch: Check) -> Column:
    if ch.kind not in KEYED:
        return violates(ch)
    nulls = [F.col(c).isNull() for c in ch.columns]
    some = nulls[0]
    for n in nulls[1:]:
        some = some | n
    again = F.row_number().over(Window.partitionBy(*ch.columns).orderBy(F.lit(0))) > 1
    return (again | some) if ch.kind == "primary_key" else (again & ~some)


def checked_write(df: DataFrame, path: str, must: Sequence[Check] = (), should: Sequence[Check] = (), mode: str = "overwrite",
                  partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to ``path`` and return ``(check, column, severity, violations, n_rows)``.

    A row that breaks a check of ``must`` stops the write before anything is
    visible; ``should`` only counts.  ``unique`` and ``primary_key`` count the
    rows beyond the first of their key (and those with a null part of it).
    """
    checks = [(c, "error") for c in must] + [(c, "warning") for c in should]
    names = [f"__broken{i}" for i in range(len(checks))]
    # keys first: what the row checks add is not carried through the sort by the key
    marked = df
    for keyed in (True, False):
        marked = marked.withColumns({n: _broken(c) for n, (c, _) in zip(names, checks, strict=True) if (c.kind in KEYED) == keyed})
    seen = Observation()
    metrics = [F.count_if(n).alias(n) for n in names]
    guard = F.lit(True)
    for n, (c, severity) in zip(names, checks, strict=True):
        if severity == "error":
            guard = F.when(F.col(n), F.raise_error(F.lit(f"check failed: {c.kind}({c.label})"))).otherwise(guard)
    out = marked.where(guard).observe(seen, F.count(F.lit(1)).alias("__rows"), *metrics).drop(*names)
    w = out.write.mode(mode)
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    got = seen.get
    rows = [(c.kind, c.label, severity, got[n], got["__rows"]) for n, (c, severity) in zip(names, checks, strict=True)]
    return df.sparkSession.createDataFrame(rows, REPORT)
