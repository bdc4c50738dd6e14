"""Projection-level operators: rename, conform to a schema, constants, defaults."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions.columns import snake_case


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns present in ``df``; names not present are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def snake_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_case(c) for c in df.columns])


def with_constants(df: DataFrame, constants: Mapping[str, tuple[Any, T.DataType | str]]) -> DataFrame:
    """Add typed constant columns (``service_type``, zero fees, ``trip_type=1``)."""
    return df.withColumns({n: F.lit(v).cast(t) for n, (v, t) in constants.items()})


def conform(df: DataFrame, schema: T.StructType,
            defaults: Mapping[str, Any] | None = None, safe: bool = False) -> DataFrame:
    """Project ``df`` onto ``schema``: cast every field, add missing ones as a
    typed default (NULL unless given), drop the rest.  ``safe=True`` uses
    ``try_cast`` so a dirty value becomes NULL instead of failing the job."""
    defaults = defaults or {}
    lower = {c.lower(): c for c in df.columns}
    out = []
    for f in schema.fields:
        src = lower.get(f.name.lower())
        if src is None:
            out.append(F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name))
        else:
            c = F.col(f"`{src}`")
            c = c.try_cast(f.dataType) if safe else c.cast(f.dataType)
            out.append(c.alias(f.name))
    return df.select(*out)


def enforce(df: DataFrame, schema: T.StructType, defaults: Mapping[str, Any] | None = None) -> DataFrame:
    """Enforced schema: like :func:`conform` but an uncastable non-NULL value
    fails the job (ANSI cast) instead of turning into NULL."""
    return conform(df, schema, defaults, safe=False)


def keep_with_default(df: DataFrame, cols: Iterable[str], default: str = "N/A",
                      fill_null: bool = False) -> DataFrame:
    """Keep ``cols``; a column that does not exist gets ``default``.  A present
    column keeps its NULLs unless ``fill_null`` is set."""
    out = []
    for c in cols:
        if c in df.columns:
            col = F.col(c)
            out.append((F.coalesce(col.cast("string"), F.lit(default)) if fill_null else col).alias(c))
        else:
            out.append(F.lit(default).alias(c))
    return df.select(*out)


def fields_with_default(doc: str, fields: Iterable[str], default: str = "N/A") -> list[Column]:
    """Pick ``fields`` out of a parsed document (a map column): a field that is
    absent gets ``default``; a field present with a null value keeps null."""
    m = F.col(doc)
    return [F.when(F.map_contains_key(m, f), m[f]).otherwise(F.lit(default)).alias(f) for f in fields]


def null_counts(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """One row: NULL count of every column, in a single aggregate pass."""
    cols = list(cols or df.columns)
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
