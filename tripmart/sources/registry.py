"""Named sources: a name -> (format, path, schema, options) registry and a
pass-through staging view per source."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Source:
    fmt: str
    path: str
    schema: T.StructType | None = None
    options: dict = field(default_factory=dict)


class SourceRegistry:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._s: dict[str, Source] = {}

    def add(self, name: str, source: Source) -> None:
        self._s[name] = source

    def read(self, name: str) -> DataFrame:
        s = self._s[name]
        r = self.spark.read.format(s.fmt).options(**s.options)
        if s.schema is not None:
            r = r.schema(s.schema)
        return r.load(s.path)

    def stage(self, name: str, view: str | None = None) -> DataFrame:
        """Read the source and expose it as ``stg_<name>`` (a temp view)."""
        df = self.read(name)
        df.createOrReplaceTempView(view or f"stg_{name}")
        return df

    def tables(self, pattern: str = "*") -> list[str]:
        """Catalog lookup by pattern (``LIKE``-style listing)."""
        return [t.name for t in self.spark.catalog.listTables(pattern=pattern)]
