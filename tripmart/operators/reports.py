"""Several grouped reports of one input from one pass.

``GROUPING SETS`` copies each input row once per report below the partial
aggregate, so what is shuffled is one row per group and task of each report;
the input is scanned and joined once and nothing is persisted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grouped_reports(base: DataFrame, reports: Mapping[str, Sequence[str]], aggs: Sequence[Column]) -> DataFrame:
    """``(report, keys..., aggregates...)``: each report grouped by its own keys.

    A key that a report lacks is NULL in its rows; the report's name tells
    that from a NULL key.  No two reports may have the same keys.
    """
    keys = list(dict.fromkeys(k for ks in reports.values() for k in ks))
    # grouping_id: one bit per key in this order, set where a report lacks the key
    ids = {sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in ks): name for name, ks in reports.items()}
    if len(ids) < len(reports):
        raise ValueError("two reports have the same keys")
    g = base.groupingSets([[F.col(k) for k in ks] for ks in reports.values()], *[F.col(k) for k in keys])
    out = g.agg(F.grouping_id().alias("__id"), *aggs)
    name = F.lit(None).cast("string")
    for number, report in ids.items():
        name = F.when(F.col("__id") == number, report).otherwise(name)
    return out.select(name.alias("report"), *keys, *[c for c in out.columns if c not in (*keys, "__id")])


def write_grouped_reports(base: DataFrame, path: str, reports: Mapping[str, Sequence[str]], aggs: Sequence[Column],
                          mode: str = "overwrite") -> None:
    """All reports in one job, a folder ``report=<name>`` for each."""
    grouped_reports(base, reports, aggs).hint("rebalance", "report").write.mode(mode).partitionBy("report").parquet(path)


def read_report(spark, path: str, name: str, reports: Mapping[str, Sequence[str]]) -> DataFrame:
    """One report with its own columns; only its folder is opened."""
    lacking = {k for ks in reports.values() for k in ks} - set(reports[name])
    return spark.read.parquet(path).where(F.col("report") == name).drop("report", *lacking)
