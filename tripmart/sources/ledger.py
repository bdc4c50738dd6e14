"""Load ledger: which source files are new or changed since the last load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.table_store import TableStore


def listing(spark: SparkSession, pattern: str) -> DataFrame:
    """``file_path, file_size`` of the files matching ``pattern`` (only the
    file metadata is read, never the content).  Files are known by their whole
    path: two folders may hold files of one name."""
    return (spark.read.format("binaryFile").load(pattern)
            .select(F.col("path").alias("file_path"), F.col("length").alias("file_size")))


def changed_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files with no ledger entry or a different recorded size."""
    led = ledger.select(F.col("file_path").alias("__f"), F.col("file_size").alias("__s"))
    j = files.join(led, files.file_path == led.__f, "left")
    return j.where(F.col("__s").isNull() | (F.col("__s") != F.col("file_size"))).select("file_path", "file_size")


def record(store: TableStore, loaded: DataFrame) -> None:
    """Upsert the loaded files' sizes into the ledger table."""
    store.merge_upsert(loaded.select("file_path", "file_size"), ["file_path"])
