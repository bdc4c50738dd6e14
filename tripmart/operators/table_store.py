"""Partitioned Parquet tables whose changes rewrite only the partitions they touch.

A table is a folder ``data`` of Parquet files partitioned as Spark writes them
and an empty Parquet table ``schema`` that holds its columns and their types
(readers declare it, so neither footers nor folder names are asked for types).
Plain Parquet has no MERGE or DELETE, so every strategy joins old and new rows
by the pure cores of :mod:`tripmart.operators.materialize` and writes the result
with Spark's dynamic partition overwrite: the job writes aside, and its commit
replaces exactly the partitions that got rows.  All other partitions keep their
files.  A job that fails leaves the table as it was; one that is lost while it
commits is run again, which every strategy but a plain append allows without
harm, and an append does so too under a batch name (see
:meth:`TableStore.append`).  A table has one writer at a time.

Beside the caller's partition columns each table has ``_batch``: the name of the
append that brought the rows, ``all`` for everything else.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators import materialize as M
from tripmart.session import scratch_path

BATCH = "_batch"
#: Partition of rows that no named append brought.
ALL = "all"
_FILE = "__file"


class TableStore:
    def __init__(self, spark: SparkSession, path: str, partition_by: Sequence[str] = ()):
        self.spark = spark
        self.path = path.rstrip("/")
        self.partition_by = list(partition_by)
        self.data = f"{self.path}/data"
        self.parts = [*self.partition_by, BATCH]

    # ------------------------------------------------------------- reading
    def schema(self) -> T.StructType | None:
        """The table's columns, ``_batch`` last; None before the first write."""
        try:
            return self.spark.read.parquet(f"{self.path}/schema").schema
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def exists(self) -> bool:
        return self.schema() is not None

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema()).parquet(self.data)

    def read(self) -> DataFrame:
        return self._rows().drop(BATCH)

    def read_or_empty(self, like: DataFrame) -> DataFrame:
        return self.read() if self.exists() else self.spark.createDataFrame([], like.schema)

    # ------------------------------------------------------------- writing
    def _declare(self, df: DataFrame, replace: bool = False) -> None:
        """Record the columns of ``df``, after those the table has already."""
        old = None if replace else self.schema()
        have = {f.name.lower() for f in old.fields} if old else set()
        fields = (old.fields if old else []) + [f for f in df.schema.fields if f.name.lower() not in have]
        fields = sorted(fields, key=lambda f: self.parts.index(f.name) + 1 if f.name in self.parts else 0)
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
        if old is None or schema.names != old.names:
            self.spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/schema")

    def _write(self, df: DataFrame, mode: str, observe: tuple | None = None) -> None:
        # rebalance: AQE splits a hot partition value across tasks and merges small ones
        df = df.hint("rebalance", *self.parts)
        if observe:  # above the shuffle: what the writing tasks see
            df = df.observe(observe[0], *observe[1])
        (df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
         .partitionBy(*self.parts).parquet(self.data))

    def _once(self, source: DataFrame) -> DataFrame:
        """The change's rows, computed once and kept in the session's scratch
        folder: what follows reads files, and the lineage ends here."""
        path = scratch_path(self.spark, f"changes/{uuid.uuid4().hex}")
        source.write.parquet(path)
        return self.spark.read.schema(source.schema).parquet(path)

    def _partitions(self, rows: DataFrame | None = None) -> list[Row]:
        """Partitions that some rows (all, if not given) lie in, with a file of each; one row per partition.

        The rows give only their partition, once each before they are shuffled;
        the files are named by a scan that reads no column."""
        placed = self._rows().withColumn(_FILE, F.col("_metadata.file_path"))
        if rows is not None:
            placed = self._in(placed, {self._key(r) for r in rows.select(*self.parts).distinct().collect()})
        # a minimum of text sorts its rows: it gets one a file, and the count keeps the planner from leaving that step out
        once = placed.groupBy(*self.parts, _FILE).agg(F.count(F.lit(1)).alias("n")).where("n > 0")
        return once.groupBy(*self.parts).agg(F.min(_FILE).alias(_FILE)).collect()

    def _key(self, row: Row) -> tuple:
        return tuple(row[c] for c in self.parts)

    def _in(self, rows: DataFrame, keys: set[tuple]) -> DataFrame:
        """The table's rows in the given partitions; other folders are not opened."""
        if not keys:
            return rows.limit(0)
        for i, c in enumerate(self.parts):  # literal lists prune folders, the join is exact
            values = {k[i] for k in keys}
            some = F.col(c).isin([v for v in values if v is not None])
            rows = rows.where(some | F.col(c).isNull() if None in values else some)
        named = self.spark.createDataFrame(list(keys), T.StructType([rows.schema[c] for c in self.parts]))
        return rows.join(F.broadcast(named), [rows[c].eqNullSafe(named[c]) for c in self.parts], "left_semi")

    def _replace(self, content: DataFrame, old: list[Row]) -> None:
        """Replace the ``old`` partitions by ``content``.  Spark replaces those
        that get rows; where an old file is still there, none came, and the
        folder goes."""
        self._declare(content)
        self._write(content, "overwrite")
        for row in old:
            file = self.spark._jvm.org.apache.hadoop.fs.Path(self.spark._jvm.java.net.URI(row[_FILE]))
            fs = file.getFileSystem(self.spark._jsc.hadoopConfiguration())
            if fs.exists(file):
                fs.delete(file.getParent(), True)

    def append(self, df: DataFrame, batch: str | None = None, observe: tuple | None = None) -> None:
        """``append``.  A named ``batch`` replaces what the same batch brought
        before, so it may be written again.  ``observe`` is an Observation and
        the aggregates that the write gives it."""
        df = df.withColumn(BATCH, F.lit(batch or ALL))
        self._declare(df)
        self._write(df, "append" if batch is None else "overwrite", observe)

    def overwrite(self, df: DataFrame) -> None:
        """Full refresh; the table gets the columns of ``df``."""
        df = df.withColumn(BATCH, F.lit(ALL))
        old = self._partitions() if self.exists() else []
        if old:
            df = self._once(df)
        self._declare(df, replace=True)
        self._replace(df, old)

    def _change(self, source: DataFrame, hit, core) -> None:
        """Rewrite the partitions that hold rows for which ``hit(table, source)``
        is not empty, and those that new rows go to, by ``core(table, source)``."""
        src = self._once(source.withColumn(BATCH, F.lit(ALL)))
        if not self.exists():
            self._declare(src)
            return self._write(src, "append")
        old = self._partitions(hit(self._rows(), src))
        into = {self._key(r) for r in src.select(*self.parts).distinct().collect()}
        self._replace(core(self._in(self._rows(), {self._key(r) for r in old} | into), src), old)

    # -------------------------------------------------------- strategies
    def merge_insert(self, source: DataFrame, key: Sequence[str], dedupe: bool = False) -> None:
        src = source.dropDuplicates(list(key)) if dedupe else source
        # the batch is read twice: computed once before
        self.append(M.new_rows(self.read(), self._once(src), key, small_batch=True) if self.exists() else src)

    def merge_upsert(self, source: DataFrame, key: Sequence[str], add_columns: bool = True, check_unique: bool = True) -> None:
        """Upsert; ``check_unique=False`` skips the duplicate-key job when the
        source is unique by construction (e.g. an aggregation's output)."""
        key = list(key)
        if check_unique:
            source = self._once(source)
            M.assert_unique(source, key)
        self._change(source, lambda t, s: t.join(M.key_set(s, key), key, "left_semi"),
                     lambda t, s: M.merge_upsert(t, s, key, add_columns))

    def replace_interval(self, source: DataFrame, ts: str, start, end) -> None:
        inside = M.in_window(F.col(ts), start, end)
        self._change(source.where(inside), lambda t, s: t.where(inside), lambda t, s: M.replace_interval(t, s, ts, start, end))

    def delete_insert(self, source: DataFrame, key: Sequence[str]) -> None:
        key = list(key)
        self._change(source, lambda t, s: t.join(M.key_set(s, key), key, "left_semi"), lambda t, s: M.delete_insert(t, s, key))

    def truncate_insert(self, source: DataFrame) -> None:
        self.overwrite(M.truncate_insert(self.read(), source) if self.exists() else source)

    def backfill(self, source: DataFrame, ts: str, months) -> None:
        """Re-load a list of months in ONE job: the whole range is replaced
        (``time_interval`` over first..last month), not one job per month."""
        start, end = M.backfill_window(months)
        self.replace_interval(source, ts, start, end)


def write_reports(base: DataFrame, reports: dict, mode: str = "overwrite") -> None:
    """Several reports from one joined input: the input is persisted (memory,
    spilling to disk) for the duration of the writes, so the scan and join run
    once; a lost executor only recomputes its lost blocks from lineage.
    ``reports`` maps an output path to a function ``DataFrame -> DataFrame``."""
    from pyspark import StorageLevel
    base = base.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for path, build in reports.items():
            build(base).write.mode(mode).parquet(path)
    finally:
        base.unpersist()


def create_table_as(df: DataFrame, name: str, path: str | None = None, partition_by: Sequence[str] = ()) -> None:
    """``table`` materialization: create or replace a catalog table as select."""
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def create_view(df: DataFrame, name: str) -> DataFrame:
    """``view`` materialization: a temp view, nothing is computed."""
    df.createOrReplaceTempView(name)
    return df


def write_table(df: DataFrame, path: str, files: int = 4, mode: str = "overwrite") -> None:
    """Parquet write with a fixed number of output files.

    The rows are written aside first, by as many tasks as they have partitions,
    and the pieces, dealt out evenly by size, put together: a task that writes a
    file reads its share as compressed columns, in the order the rows came, and
    not as shuffled rows.  Only where there are fewer pieces than files are the
    rows shuffled.
    """
    spark = df.sparkSession
    aside = scratch_path(spark, f"pieces/{uuid.uuid4().hex}")
    try:
        df.write.option("compression", "zstd").parquet(aside)
        pieces = spark.read.schema(df.schema).parquet(aside)
        found = pieces.select(F.col("_metadata.file_path").alias("at"), F.col("_metadata.file_size").alias("size")).groupBy("at", "size").count().collect()
        shares: list[tuple[int, list[str]]] = [(0, []) for _ in range(files)]
        for r in sorted(found, key=lambda r: (-r["size"], r["at"])):
            size, names = heapq.heappop(shares)
            heapq.heappush(shares, (size + r["size"], [*names, r["at"]]))
        if len(found) < files:
            out = pieces.repartition(files)
        else:
            # a union of single partitions alone would be one partition again, so it starts with a scan of no file
            none = pieces.where(F.col("_metadata.file_size") < 0)
            out = reduce(DataFrame.union, [spark.read.schema(df.schema).parquet(*names).coalesce(1) for _, names in shares], none)
        out.write.mode(mode).parquet(path)
    finally:
        at = spark._jvm.org.apache.hadoop.fs.Path(aside)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def write_partitioned(df: DataFrame, path: str, date_col: str, ts_col: str, cluster_by: Sequence[str] = (),
                      mode: str = "overwrite") -> None:
    """Partition by a date derived from ``ts_col`` and cluster (sort) each
    file by ``cluster_by`` so row-group min/max statistics skip data.

    ``rebalance`` (not ``repartition(date)``) lets AQE split a date holding a
    large share of the rows over several tasks and merge small dates, so no
    task writes a hot day alone and small days do not become many tiny files.
    """
    out = df.withColumn(date_col, F.to_date(ts_col)).hint("rebalance", date_col)
    out = out.sortWithinPartitions(date_col, *cluster_by)
    out.write.mode(mode).partitionBy(date_col).parquet(path)


def write_bucketed(df: DataFrame, table: str, key: Sequence[str], buckets: int, path: str | None = None,
                   sort: bool = True) -> None:
    """Store ``df`` as a catalog table bucketed (and sorted) by ``key``.

    Two tables bucketed by their join key into the same number of buckets
    join without an exchange on either side (a sort-merge join reading
    matching buckets), so a layout written once saves a full shuffle of both
    tables on every later join - the large-scale form of a co-located join.
    """
    w = df.write.mode("overwrite").format("parquet").bucketBy(buckets, *key)
    if sort:
        w = w.sortBy(*key)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
