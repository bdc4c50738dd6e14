"""File readers: typed/untyped CSV, external CSV tables, Parquet (pruned,
globbed, directory-partitioned), JSON documents with nested arrays, seeds,
multi-file ingestion over periods, and per-file statistics."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators.project import conform


def _csv_reader(spark: SparkSession, ts_format: str, null_value: str | None):
    """Typed CSV that stops on a value its column's type cannot hold."""
    r = (spark.read.option("timestampFormat", ts_format).option("timestampNTZFormat", ts_format).option("mode", "FAILFAST"))
    return r if null_value is None else r.option("nullValue", null_value)


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str,
             ts_format: str = "yyyy-MM-dd HH:mm:ss", header: bool = True, null_value: str | None = None,
             min_partitions: int | None = None, trim: bool = False) -> DataFrame:
    """Typed CSV (optionally gzip) scan; no inference pass.

    With a header the schema's columns are found by name, in whatever order
    the files have them; columns the schema lacks are skipped, a schema column
    that the header lacks is an error, and so are files whose headers differ.
    Without one they are taken by position.  A value that does not parse is an
    error (see :func:`external_csv` for the lenient form); ``trim`` takes blanks
    off around unquoted values first.  A gzip file is not
    splittable and arrives as one partition, so ``min_partitions``
    redistributes it after the read.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    r = _csv_reader(spark, ts_format, null_value)
    r = r.option("ignoreLeadingWhiteSpace", trim).option("ignoreTrailingWhiteSpace", trim)
    if header:
        names = spark.read.option("header", True).csv(path).columns
        if missing := [f.name for f in schema.fields if f.name not in names]:
            raise ValueError(f"columns not in the header: {missing}")
        types = {f.name: f.dataType for f in schema.fields}
        in_file = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names])
        # each file's own header is held against the schema it is read with
        df = r.schema(in_file).option("header", True).option("enforceSchema", False).csv(path)
        df = df.select(*[F.col(f"`{f.name}`") for f in schema.fields])
    else:
        df = r.schema(schema).csv(path)
    if min_partitions:
        df = df.repartition(min_partitions)
    return df


def read_csv_untyped(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Header CSV with every column as string (no inference)."""
    return spark.read.option("header", True).csv(path)


def external_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """External CSV table: declared types, header row skipped, a value that
    does not parse becomes NULL, surplus fields are dropped and missing
    trailing fields are NULL."""
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def copy_in(spark: SparkSession, path: str, file_columns: Sequence[str], table_schema: T.StructType,
            ts_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """COPY a CSV into an explicit column list of a wider table: the file's
    columns are read by position under the given names (its header line is
    skipped unread), the table's other columns are NULL, and a value that does
    not parse stops the load."""
    file_schema = T.StructType([T.StructField(c, table_schema[c].dataType) if c in table_schema.names
                                else T.StructField(c, T.StringType()) for c in file_columns])
    df = _csv_reader(spark, ts_format, None).schema(file_schema).option("header", True).csv(path)
    return conform(df, table_schema)


def read_parquet(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None,
                 merge_schema: bool = False) -> DataFrame:
    """Parquet scan; ``columns`` prunes in the scan (``ReadSchema``).  A glob
    such as ``.../yellow_tripdata_2024-*.parquet`` is accepted."""
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.option("mergeSchema", merge_schema).parquet(*paths)
    return df.select(*columns) if columns else df


def read_glob(spark: SparkSession, pattern: str, merge_schema: bool = True) -> DataFrame:
    """All files matching a glob (``yellow_tripdata_2024-*.parquet``) as one
    table; schemas that differ between months are merged by name."""
    return read_parquet(spark, pattern, merge_schema=merge_schema)


def dev_limit(df: DataFrame, ts: str, window: tuple | None) -> DataFrame:
    """Development limiter: keep an inclusive ``[start, end]`` range of
    ``ts`` when ``window`` is given (production passes ``None``)."""
    if window is None:
        return df
    return df.where(F.col(ts).between(F.lit(window[0]), F.lit(window[1])))


def read_partition(spark: SparkSession, root: str, **equals) -> DataFrame:
    """Directory-partitioned table ``root/<col>=<value>/...``: filters on the
    partition columns prune directories before any file is opened."""
    df = spark.read.parquet(root)
    for k, v in equals.items():
        df = df.where(F.col(k) == F.lit(v))
    return df


def read_time_range(spark: SparkSession, root: str, ts: str, start: dt.datetime, end: dt.datetime,
                    date_col: str) -> DataFrame:
    """Rows with ``start <= ts < end`` of a table partitioned by the date of
    ``ts`` in ``date_col``: the dates follow from the range, so a filter on the
    timestamp alone opens only the folders it can match."""
    last = (end - dt.timedelta(microseconds=1)).date()
    return spark.read.parquet(root).where(
        F.col(date_col).between(F.lit(start.date()), F.lit(last)) & (F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(end)))


def read_matching(spark: SparkSession, root: str, wanted: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of a partitioned table whose partition columns ``on`` occur in
    ``wanted`` (a filtered dimension).  The values are known only when the
    dimension has run: its broadcast is used a second time, to open only the
    folders it names (dynamic partition pruning).  The dimension's other
    columns come along; a combination must occur in it once."""
    from tripmart.operators.joins import broadcast_if_small
    return spark.read.parquet(root).join(broadcast_if_small(wanted), list(on))


def read_json_array(spark: SparkSession, path: str | Sequence[str], field: str,
                    schema: T.StructType | None = None, keep: Sequence[str] | None = None,
                    multi_line: bool = True, parents: Sequence[str] = ()) -> DataFrame:
    """JSON documents holding an array of objects under ``field``: one row
    per element (``explode``), optionally keeping only ``keep`` fields and
    the document-level ``parents`` fields.  ``multi_line=False`` reads JSON
    Lines (one document per line, splittable)."""
    r = spark.read.option("multiLine", multi_line)
    if schema is not None:
        r = r.schema(schema)
    df = r.json(path).select(*parents, F.explode(F.col(field)).alias("__e")).select(*parents, "__e.*")
    return df.select(*parents, *keep) if keep else df


def seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Small lookup CSV with declared schema (checks are applied by the caller
    with :mod:`tripmart.operators.quality`)."""
    return read_csv(spark, path, schema)


def load_replace(spark: SparkSession, path: str, overrides: Mapping[str, T.DataType | str]) -> DataFrame:
    """CSV object -> table, every column text except the listed overrides."""
    df = read_csv_untyped(spark, path)
    return df.withColumns({c: F.col(c).cast(t) for c, t in overrides.items()})


def month_range(start: dt.date, end: dt.date) -> list[dt.date]:
    """First days of every month from ``start``'s month to ``end``'s month,
    both inclusive (a range across New Year works)."""
    out, y, m = [], start.year, start.month
    while (y, m) <= (end.year, end.month):
        out.append(dt.date(y, m, 1))
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


def period_paths(root: str, kinds: Iterable[str], start: dt.date, end: dt.date,
                 pattern: str = "{root}/{kind}_tripdata_{year:04d}-{month:02d}.parquet") -> list[str]:
    """Monthly file paths for every kind and month in ``[start, end]``."""
    return [pattern.format(root=root.rstrip("/"), kind=k, year=d.year, month=d.month)
            for k in kinds for d in month_range(start, end)]


def ingest(spark: SparkSession, paths_by_kind: Mapping[str, Sequence[str]],
           reader=None) -> DataFrame:
    """Read each kind's files, add ``taxi_type`` and ``extracted_at``, and
    concatenate with differing columns allowed (NULL where absent)."""
    reader = reader or (lambda p: spark.read.parquet(*p))
    parts = []
    for kind, paths in paths_by_kind.items():
        if paths:
            parts.append(reader(list(paths)).withColumn("taxi_type", F.lit(kind)))
    if not parts:
        raise ValueError("nothing to ingest")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.withColumn("extracted_at", F.current_timestamp())


def with_source_file(df: DataFrame, name: str = "filename") -> DataFrame:
    """Add the source file name of every row (from the scan's metadata)."""
    return df.withColumn(name, F.col("_metadata.file_name"))


def file_stats(df: DataFrame) -> DataFrame:
    """Rows and byte size per input file: ``file_name, file_size, rows``."""
    return (df.select(F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_size").alias("file_size"))
              .groupBy("file_name", "file_size").agg(F.count(F.lit(1)).alias("rows")))


def avg_file_size(df: DataFrame) -> DataFrame:
    """Average size over the distinct files behind ``df``."""
    return file_stats(df).agg(F.avg("file_size").alias("avg_file_size"), F.count(F.lit(1)).alias("files"))
