"""Helpers shared by the training-data operators.

Intermediate results that several jobs read are written as Parquet below the
shared folder of ``spark.checkpoint.dir`` (:func:`stored`), so a lost executor
costs a re-read, never a recomputation of the lineage.  ``drop_scratch``
removes everything a session wrote there once its results are saved.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.session import scratch_path
from tripmart.sources.tables import table

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Largest id, used so that rows without an id order after all others.
LAST_ID = 2**63 - 1


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def scratch_root(spark: SparkSession) -> str:
    return scratch_path(spark, f"llm-{spark.sparkContext.applicationId}")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new path below the session's scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written once as Parquet in the shared scratch folder and reread."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this session stored; call it after the results are written."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names not used by ``df`` (names are matched without case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def row_key(*cols: Column) -> Column:
    """128 bits that stand for a row's values, so that many rows can be told
    apart: two hashes of the values, the second from another seed."""
    return F.struct(F.xxhash64(*cols).alias("a"), F.xxhash64(F.lit(1), *cols).alias("b"))


#: Keys that may be broadcast: some 20 MB.
FEW = 250_000


def few(keys: DataFrame) -> DataFrame:
    """A stored table of keys, to be broadcast if it has ``FEW`` rows at most."""
    return F.broadcast(keys) if keys.limit(FEW + 1).count() <= FEW else keys


def without(docs: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose ``key`` is in ``gone``, a stored table of
    distinct keys.  While these are few they are broadcast and the texts stay
    where they are; beyond ``FEW`` both sides are shuffled."""
    return docs.join(few(gone), key, "left_anti")


def only(docs: DataFrame, key: str, some: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``key`` is in ``some``, as :func:`without` finds the others."""
    return docs.join(few(some), key, "left_semi")


def held_out(id_col: Column, folds: int, fold: int = 2) -> Column:
    """crc32 of the id's text leaves the remainder ``fold``; a null id counts
    as the text '' (crc32 0), so it is learnt from."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds == fold


def ascii_lower(text: Column) -> Column:
    """Only A-Z are lowered.  ``lower`` does just that on ASCII text and is
    much faster than ``translate``; other texts take the latter."""
    return (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
            .otherwise(F.translate(text, UPPER, UPPER.lower())))
