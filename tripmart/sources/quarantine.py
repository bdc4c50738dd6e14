"""CSV loads that keep going: good rows typed, bad rows kept with their reasons.

Every field is read as text in one scan.  A line with another number of fields
than the schema comes whole from the reader's corrupt-record column; each field
is then cast by ``try_cast``, and a value that is there but does not fit its
type is a reason.  The marked rows are written once, good ones and rejects to
folders of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINE, REASONS = "_line", "_reasons"
#: Reason of a line whose number of fields is wrong.
FIELDS = "number of fields"


def _typed(c: str, t: T.DataType, ts_format: str) -> F.Column:
    if isinstance(t, T.StringType):
        return F.col(c)
    if isinstance(t, T.TimestampType | T.TimestampNTZType):
        return F.try_to_timestamp(F.col(c), F.lit(ts_format)).cast(t)
    return F.trim(F.col(c)).try_cast(t)


def read_csv_marked(spark: SparkSession, path: str, schema: T.StructType | str, ts_format: str = "yyyy-MM-dd HH:mm:ss",
                    header: bool = True) -> DataFrame:
    """The schema's columns typed (NULL where a value does not fit), ``_line``
    (the line, if its number of fields is wrong) and ``_reasons``, empty for a
    good row.  An empty field is NULL and no reason."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField(LINE, T.StringType())])
    raw = (spark.read.schema(text).option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LINE)
           .option("columnPruning", False).csv(path))
    whole = F.col(LINE).isNull()
    reasons = [F.when(~whole, F.lit(FIELDS))]
    typed = []
    for f in schema.fields:
        value = _typed(f.name, f.dataType, ts_format)
        typed.append(F.when(whole, value).alias(f.name))
        if not isinstance(f.dataType, T.StringType):
            reasons.append(F.when(whole & F.col(f.name).isNotNull() & value.isNull(),
                                  F.concat(F.lit(f"{f.name} is no {f.dataType.simpleString()}: "), F.col(f.name))))
    return raw.select(*typed, LINE, F.array_compact(F.array(*reasons)).alias(REASONS))


def write_split(marked: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One job writes good rows and rejects, to ``rejected=false`` and ``rejected=true``."""
    marked.withColumn("rejected", (F.size(REASONS) > 0).cast("string")).write.mode(mode).partitionBy("rejected").parquet(path)


def good(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where("rejected = 'false'").drop(LINE, REASONS, "rejected")


def rejects(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where("rejected = 'true'").drop("rejected")
