"""RDBMS read/write through Spark's JDBC source (any driver on the classpath)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """Table read; with a numeric ``partition_column`` the read is split in
    ``num_partitions`` range queries that run in parallel."""
    if partition_column:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                               numPartitions=num_partitions, properties=properties or {})
    return spark.read.jdbc(url, table, properties=properties or {})


def load_replace_then_append(first: DataFrame, rest: DataFrame | None, url: str, table: str,
                             properties: dict | None = None, batchsize: int = 100_000,
                             num_partitions: int | None = None) -> None:
    """Create/replace the table with the first chunk, then append the rest
    (``batchsize`` rows per insert batch, ``num_partitions`` parallel writers)."""
    def _w(df: DataFrame, mode: str):
        w = df.write.option("batchsize", batchsize)
        if num_partitions:
            w = w.option("numPartitions", num_partitions)
        w.jdbc(url, table, mode=mode, properties=properties or {})
    _w(first, "overwrite")
    if rest is not None:
        _w(rest, "append")
