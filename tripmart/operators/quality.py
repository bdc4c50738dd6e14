"""Declarative data-quality checks.

Single-column row checks (not_null, accepted_values, non_negative, positive)
of one table are fused into ONE aggregate pass.  Uniqueness checks need a
shuffle per key set (``groupBy(key).count()`` with map-side combine), never a
``count(DISTINCT ...)`` over many columns in one aggregate.
The report is a DataFrame ``(check, column, violations)``; only the report -
one row per check - is ever brought to the driver, by :func:`assert_passing`.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    kind: str  # not_null | unique | accepted_values | non_negative | positive | primary_key | expression | not_empty
    columns: tuple[str, ...]
    values: tuple[Any, ...] = field(default_factory=tuple)
    expr: str | None = None         # for kind="expression": SQL predicate a row must satisfy

    @property
    def label(self) -> str:
        return ",".join(self.columns)


def not_null(c: str) -> Check: return Check("not_null", (c,))
def unique(c: str) -> Check: return Check("unique", (c,))
def accepted_values(c: str, values: Sequence[Any]) -> Check: return Check("accepted_values", (c,), tuple(values))
def non_negative(c: str) -> Check: return Check("non_negative", (c,))
def positive(c: str) -> Check: return Check("positive", (c,))
def primary_key(*cols: str) -> Check: return Check("primary_key", tuple(cols))
def expression(name: str, predicate: str) -> Check: return Check("expression", (name,), expr=predicate)
def not_empty() -> Check: return Check("not_empty", ("*",))  # at least one row (> 0, not > 1)


def violates(ch: Check) -> Column:
    """Whether a row breaks a check that looks at single rows."""
    if ch.kind == "expression":
        return ~F.coalesce(F.expr(ch.expr), F.lit(False))
    c = F.col(ch.columns[0])
    broken = {"not_null": c.isNull(), "accepted_values": ~c.isin(list(ch.values)), "non_negative": c < 0, "positive": c <= 0}
    if ch.kind not in broken:
        raise ValueError(ch.kind)
    return F.coalesce(broken[ch.kind], F.lit(False))


def _row_violation(ch: Check) -> Column:
    if ch.kind == "not_empty":
        return F.when(F.count(F.lit(1)) == 0, F.lit(1)).otherwise(F.lit(0))
    return F.count_if(violates(ch))


def _report_row(ch: Check, violations: Column) -> Column:
    return F.struct(F.lit(ch.kind).alias("check"), F.lit(ch.label).alias("column"),
                    violations.cast("long").alias("violations"))


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Evaluate ``checks`` on ``df``; returns ``(check, column, violations)``.

    ``unique`` counts duplicated non-NULL values (groups with more than one
    row); ``primary_key`` counts duplicated key tuples plus rows with a NULL
    key part.
    """
    row_checks = [c for c in checks if c.kind not in ("unique", "primary_key")]
    key_checks = [c for c in checks if c.kind in ("unique", "primary_key")]
    parts: list[DataFrame] = []
    if row_checks:
        fused = df.agg(F.array(*[_report_row(c, _row_violation(c)) for c in row_checks]).alias("r"))
        parts.append(fused.select(F.inline("r")))
    for ch in key_checks:
        cols = list(ch.columns)
        has_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
        groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).withColumn("nul", has_null)
        v = F.count_if(~F.col("nul") & (F.col("n") > 1))
        if ch.kind == "primary_key":
            v = v + F.coalesce(F.sum(F.when(F.col("nul"), F.col("n"))), F.lit(0))
        parts.append(groups.agg(F.array(_report_row(ch, v)).alias("r")).select(F.inline("r")))
    return reduce(lambda a, b: a.unionByName(b), parts)


class CheckFailed(AssertionError):
    pass


def assert_passing(report: DataFrame) -> DataFrame:
    """Stop the run when any check has violations (the report is one row per
    check, so collecting it is bounded)."""
    bad = [r for r in report.where("violations > 0").collect()]
    if bad:
        raise CheckFailed("; ".join(f"{r['check']}({r['column']})={r['violations']}" for r in bad))
    return report


def scalar_equals(df: DataFrame, expected: Any) -> bool:
    """Custom check: a one-cell query result equals ``expected``."""
    rows = df.limit(2).collect()
    if len(rows) != 1 or len(rows[0]) != 1:
        raise ValueError("custom check query must return exactly one cell")
    return rows[0][0] == expected


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Referential check as a report row: non-NULL ``child.column`` values
    with no matching ``parent.parent_column`` (an anti join against the
    parent's distinct keys, broadcast when small)."""
    from tripmart.operators.materialize import key_set
    keys = key_set(parent.select(F.col(parent_column).alias("__p")), ["__p"])
    orphans = child.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("__p"), "left_anti")
    row = _report_row(Check("relationships", (column,)), F.count(F.lit(1)))
    return orphans.agg(F.array(row).alias("r")).select(F.inline("r"))
