"""The driver's parquet tables by name (``<sf_dir>/<name>.parquet``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


# (application id, path) -> schema.  Reading Parquet without a schema runs a
# footer-inference job on every read; the tables are immutable inputs, so the
# schema is inferred once per application and declared afterwards.
_SCHEMAS: dict[tuple[str, str], object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise KeyError(name)
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    schema = _SCHEMAS.get(key)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[key] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)
