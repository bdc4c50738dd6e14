"""Registered queries that run the materializations on stored tables.

Each writes its target below the session's scratch folder through
:class:`TableStore`, applies one strategy and returns the table's rows, which
the SQL twin computes from the driver tables.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators import materialize as M
from tripmart.operators.dedupe import dedupe_first
from tripmart.operators.numbering import with_row_number
from tripmart.operators.table_store import TableStore
from tripmart.plans.queries import _DEDUP_T, TRIPS, W, _scratch, register, ts
from tripmart.plans.trips import trips
from tripmart.sources import files as FS
from tripmart.sources.tables import table

KEY = ["orderkey", "linenumber"]
ROW = ["orderkey", "linenumber", "pickup_datetime", "total_amount"]
_ROW = ", ".join(ROW)
_T96, _T97, _T98 = (f"TIMESTAMP '{y}-01-01 00:00:00'" for y in (1996, 1997, 1998))


def _store(spark) -> TableStore:
    return TableStore(spark, _scratch(spark, "store"), ["yr"])


def _rows(spark, d) -> DataFrame:
    t = trips(spark, d, locations=False).select(*ROW)
    return t.withColumn("yr", F.year("pickup_datetime"))


def _once(spark, d) -> DataFrame:
    """One row per key, as the upsert needs it (the twin's ``dt``)."""
    return dedupe_first(trips(spark, d, locations=False).select(*ROW), KEY, ["pickup_datetime"]).withColumn("yr", F.year("pickup_datetime"))


def _doubled(df: DataFrame) -> DataFrame:
    return df.withColumn("total_amount", (F.col("total_amount") * 2).cast("decimal(18,2)"))


def _before(year: int):
    return F.col("pickup_datetime") < ts(f"{year}-01-01")


def _rest(year: int):
    return (F.col("pickup_datetime") >= ts(f"{year}-01-01")) | F.col("pickup_datetime").isNull()


@register("store_append", W(f"SELECT {_ROW} FROM trips", TRIPS))
def q_store_append(spark, d):
    st, t = _store(spark), _rows(spark, d)
    st.append(t.where(_before(1996)))
    st.append(t.where(_rest(1996)))
    return st.read().select(*ROW)


@register("store_merge_insert", W(f"""
SELECT {_ROW} FROM trips WHERE pickup_datetime < {_T97}
UNION ALL
SELECT {_ROW} FROM trips s WHERE (s.pickup_datetime >= {_T96} OR s.pickup_datetime IS NULL)
  AND NOT EXISTS (SELECT 1 FROM trips t WHERE t.pickup_datetime < {_T97} AND t.orderkey = s.orderkey AND t.linenumber = s.linenumber)""", TRIPS))
def q_store_merge_insert(spark, d):
    st, t = _store(spark), _rows(spark, d)
    st.append(t.where(_before(1997)))
    st.merge_insert(t.where(_rest(1996)), KEY)
    return st.read().select(*ROW)


@register("store_merge_upsert", W(f"""
SELECT {_ROW}, CAST(NULL AS VARCHAR) AS tag FROM dt WHERE pickup_datetime < {_T96}
UNION ALL
SELECT orderkey, linenumber, pickup_datetime, CAST(total_amount * 2 AS DECIMAL(18,2)), 'v2' FROM dt
WHERE pickup_datetime >= {_T96} OR pickup_datetime IS NULL""", TRIPS, _DEDUP_T))
def q_store_merge_upsert(spark, d):
    st, t = _store(spark), _once(spark, d)
    st.append(t.where(_before(1997)))
    st.merge_upsert(_doubled(t.where(_rest(1996))).withColumn("tag", F.lit("v2")), KEY)
    return st.read().select(*ROW, "tag")


_REPLACED = f"""
SELECT {_ROW} FROM trips WHERE pickup_datetime IS NULL OR NOT (pickup_datetime >= {{lo}} AND pickup_datetime < {{hi}})
UNION ALL
SELECT orderkey, linenumber, pickup_datetime, CAST(total_amount * 2 AS DECIMAL(18,2)) FROM trips
WHERE pickup_datetime >= {{lo}} AND pickup_datetime < {{hi}}"""


@register("store_replace_interval", W(_REPLACED.format(lo="TIMESTAMP '1996-07-01 00:00:00'", hi=_T98), TRIPS))
def q_store_replace_interval(spark, d):
    st, t = _store(spark), _rows(spark, d)
    st.append(t)
    st.replace_interval(_doubled(t), "pickup_datetime", ts("1996-07-01"), ts("1998-01-01"))
    return st.read().select(*ROW)


@register("store_backfill", W(_REPLACED.format(lo="TIMESTAMP '1997-11-01 00:00:00'", hi="TIMESTAMP '1998-03-01 00:00:00'"), TRIPS))
def q_store_backfill(spark, d):
    st, t = _store(spark), _rows(spark, d)
    st.append(t)
    st.backfill(_doubled(t), "pickup_datetime", FS.month_range(dt.date(1997, 11, 1), dt.date(1998, 2, 1)))
    return st.read().select(*ROW)


@register("store_delete_insert", W(f"""
SELECT {_ROW} FROM trips t WHERE NOT EXISTS (
  SELECT 1 FROM trips s WHERE s.pickup_datetime >= {_T97} AND s.pickup_datetime < {_T98} AND s.orderkey = t.orderkey)
UNION ALL
SELECT orderkey, linenumber, pickup_datetime, CAST(total_amount * 2 AS DECIMAL(18,2)) FROM trips
WHERE pickup_datetime >= {_T97} AND pickup_datetime < {_T98}""", TRIPS))
def q_store_delete_insert(spark, d):
    st, t = _store(spark), _rows(spark, d)
    st.append(t)
    st.delete_insert(_doubled(t.where(M.in_window(F.col("pickup_datetime"), ts("1997-01-01"), ts("1998-01-01")))), ["orderkey"])
    return st.read().select(*ROW)


@register("store_truncate_insert", W(f"SELECT {_ROW} FROM trips WHERE pickup_datetime >= {_T97}", TRIPS))
def q_store_truncate_insert(spark, d):
    st, t = _store(spark), _rows(spark, d)
    st.append(t.where(_before(1997)))
    st.truncate_insert(t.where(F.col("pickup_datetime") >= ts("1997-01-01")))
    return st.read().select(*ROW)


# ---- sources over files that Spark wrote from the tables

_PARTS = "SELECT p_partkey, p_name, p_brand FROM part"


@register("csv_typed_by_name", _PARTS)
def q_csv_typed_by_name(spark, d):
    """Header CSV whose columns stand in another order than the schema's."""
    path = _scratch(spark, "csv")
    p = table(spark, d, "part")
    p.select("p_brand", "p_name", "p_partkey").write.option("header", True).csv(path)
    schema = ", ".join(f"{c} {t}" for c, t in p.select("p_partkey", "p_name", "p_brand").dtypes)
    return FS.read_csv(spark, path, schema)


@register("copy_in_columns", "SELECT p_partkey, p_brand, CAST(NULL AS VARCHAR) AS note FROM part")
def q_copy_in_columns(spark, d):
    path = _scratch(spark, "csv")
    p = table(spark, d, "part").select("p_partkey", "p_brand")
    p.write.option("header", True).csv(path)
    return FS.copy_in(spark, path, ["p_partkey", "p_brand"], p.withColumn("note", F.lit(None).cast("string")).schema)


@register("external_csv_lenient", """
SELECT CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_partkey END AS p_partkey, p_brand FROM part""")
def q_external_csv_lenient(spark, d):
    """A value that does not parse becomes NULL; a surplus column is dropped."""
    path = _scratch(spark, "csv")
    p = table(spark, d, "part")
    bad = F.when(F.col("p_partkey") % 7 == 0, F.lit("n/a")).otherwise(F.col("p_partkey").cast("string"))
    p.select(bad.alias("p_partkey"), "p_brand", "p_name").write.option("header", True).csv(path)
    return FS.external_csv(spark, path, p.select("p_partkey", "p_brand").schema)


@register("paged_offset_events", """
SELECT event_type, COUNT(*) AS n, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total
FROM events WHERE event_id % 3 <> 1 GROUP BY event_type""")
def q_paged_offset_events(spark, d):
    """Pages saved by offset, 500 records each, from events whose ids have gaps;
    the rows are numbered over all partitions before they are cut into pages."""
    from tripmart.sources.paged import paged_scan
    kept, path = _scratch(spark, "events"), _scratch(spark, "pages")
    table(spark, d, "events").where("event_id % 3 <> 1").select("event_id", "event_type", "value").write.parquet(kept)
    e = with_row_number(spark.read.parquet(kept), "at")
    pages = e.withColumn("offset", (F.floor(F.col("at") / 500) * 500).cast("long"))
    body = F.to_json(F.struct(F.collect_list(F.struct("event_id", "event_type", "value")).alias("data")))
    pages.groupBy("offset").agg(body.alias("value")).write.partitionBy("offset").text(path)
    got = paged_scan(spark, path + "/offset={offset}/part-*", "event_id long, event_type string, value double", kind="offset", limit=500)
    return got.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"),
                                         F.sum(F.col("value").cast("decimal(18,2)")).cast("decimal(38,2)").alias("total"))


# ---- file sets

_MONTHS = ("1996-01", "1996-02", "1996-03")


def _monthly(spark, d) -> str:
    """One folder per month of 1996; from March on the files have a column more."""
    root = _scratch(spark, "monthly")
    t = trips(spark, d, locations=False).select("pickup_datetime", "total_amount", "payment_type")
    for m in _MONTHS:
        part = t.where(F.date_format("pickup_datetime", "yyyy-MM") == m)
        (part if m >= "1996-03" else part.drop("payment_type")).write.parquet(f"{root}/trips_{m}")
    return root


@register("glob_merged_schema", W("""
SELECT CAST(date_trunc('month', pickup_datetime) AS DATE) AS month, COUNT(*) AS n,
       COUNT(CASE WHEN pickup_datetime >= TIMESTAMP '1996-03-01 00:00:00' THEN payment_type END) AS n_paid
FROM trips WHERE pickup_datetime >= TIMESTAMP '1996-01-01 00:00:00' AND pickup_datetime < TIMESTAMP '1996-04-01 00:00:00' GROUP BY 1""", TRIPS))
def q_glob_merged_schema(spark, d):
    """All months by one glob; the older files lack a column."""
    t = FS.read_glob(spark, f"{_monthly(spark, d)}/trips_1996-*")
    return t.groupBy(F.trunc("pickup_datetime", "month").alias("month")).agg(F.count(F.lit(1)).alias("n"), F.count("payment_type").alias("n_paid"))


@register("partition_equals", W("""
SELECT service_type, CAST(month(pickup_datetime) AS INTEGER) AS mon, COUNT(*) AS n FROM trips
WHERE year(pickup_datetime) = 1996 AND service_type = 'Green' GROUP BY 1, 2""", TRIPS))
def q_partition_equals(spark, d):
    """A table of folders <service>/<year>/<month>, read by year and service."""
    root = _scratch(spark, "folders")
    t = trips(spark, d, locations=False).select("service_type", F.year("pickup_datetime").alias("yr"), F.month("pickup_datetime").alias("mon"), "total_amount")
    t.hint("rebalance", "service_type", "yr", "mon").write.partitionBy("service_type", "yr", "mon").parquet(root)
    return FS.read_partition(spark, root, service_type="Green", yr=1996).groupBy("service_type", "mon").agg(F.count(F.lit(1)).alias("n"))


@register("rows_per_file", W("""
SELECT strftime(pickup_datetime, 'trips_%Y-%m') AS folder, COUNT(*) AS n_rows FROM trips
WHERE pickup_datetime >= TIMESTAMP '1996-01-01 00:00:00' AND pickup_datetime < TIMESTAMP '1996-04-01 00:00:00' GROUP BY 1""", TRIPS))
def q_rows_per_file(spark, d):
    """Rows behind the files of each month, from the scan's metadata."""
    t = spark.read.parquet(f"{_monthly(spark, d)}/trips_1996-*")
    folder = F.regexp_extract("_metadata.file_path", "/(trips_[^/]*)/", 1)
    return t.select(folder.alias("folder"), F.struct(F.lit(1))).groupBy("folder").agg(F.count(F.lit(1)).alias("n_rows"))


@register("ledger_changed_files", """
SELECT 'months' AS listed, 3 AS n_files, 0 AS n_rows_again
UNION ALL SELECT 'loaded', 3, 0
UNION ALL SELECT 'after a change', 1, (SELECT COUNT(*) FROM orders WHERE month(o_orderdate) = 2)""")
def q_ledger_changed_files(spark, d):
    """Files enter the ledger when loaded; a file that is written again with
    another size is the only one listed, and only it is read again."""
    from tripmart.sources import ledger
    root = _scratch(spark, "listed")
    o = table(spark, d, "orders").select("o_orderkey", F.month("o_orderdate").alias("mon"))

    def write(mon: int, df: DataFrame) -> None:
        # one file a month: the ledger knows files
        df.where(F.col("mon") == mon).coalesce(1).write.mode("overwrite").parquet(f"{root}/m{mon}")

    for mon in (1, 2, 3):
        write(mon, o)
    store = TableStore(spark, _scratch(spark, "ledger"))
    by_month = F.regexp_extract("file_path", r"/(m\d+)/", 1)
    files = lambda: ledger.listing(spark, f"{root}/m*/*.parquet").select(by_month.alias("file_path"), "file_size")
    empty = spark.createDataFrame([], "file_path string, file_size long")
    first = ledger.changed_files(files(), empty).count()
    ledger.record(store, files())
    loaded = store.read().count()
    write(2, o.withColumn("more", F.lit("a column more")))
    changed = ledger.changed_files(files(), store.read()).collect()
    again = spark.read.parquet(*[f"{root}/{r.file_path}" for r in changed]).count()
    return spark.createDataFrame([("months", first, 0), ("loaded", loaded, 0), ("after a change", len(changed), again)],
                                 "listed string, n_files int, n_rows_again long")


@register("snake_case_enforced", """
SELECT CAST(p_partkey AS INTEGER) AS part_key, p_name AS part_name, CAST(p_retailprice AS DECIMAL(18,2)) AS retail_price, CAST(NULL AS DATE) AS sold_on
FROM part""")
def q_snake_case_enforced(spark, d):
    """Camel-case names to snake case, then an enforced schema: a value that does not fit would stop the job."""
    from tripmart.operators.project import enforce, snake_case_columns
    raw = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("partKey"), F.col("p_name").alias("PartName"),
                                         F.col("p_retailprice").alias("RetailPrice"), F.lit("x").alias("unused"))
    schema = T.StructType([T.StructField("part_key", T.IntegerType()), T.StructField("part_name", T.StringType()),
                           T.StructField("retail_price", T.DecimalType(18, 2)), T.StructField("sold_on", T.DateType())])
    return enforce(snake_case_columns(raw), schema)


@register("custom_check", W("""
SELECT 'one trip per id' AS name, COUNT(*) = COUNT(DISTINCT (orderkey, linenumber)) AS ok FROM trips
UNION ALL SELECT 'two services', COUNT(DISTINCT service_type) = 2 FROM trips""", TRIPS))
def q_custom_check(spark, d):
    """Checks given as queries of one cell."""
    from tripmart.operators.quality import scalar_equals
    t = trips(spark, d, locations=False)
    twice = t.groupBy("orderkey", "linenumber").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n"), F.lit(1)))
    services = t.agg(F.count_distinct("service_type"))
    return spark.createDataFrame([("one trip per id", scalar_equals(twice, 1)), ("two services", scalar_equals(services, 2))], "name string, ok boolean")


# ---- loads, tables and views

_PART_CSV = ["p_partkey", "p_name", "p_brand", "p_size", "p_retailprice"]


def _part_csv(spark, d) -> str:
    path = _scratch(spark, "csv")
    table(spark, d, "part").select(*_PART_CSV).write.option("header", True).csv(path)
    return path


@register("csv_untyped", """
SELECT p_brand, COUNT(*) AS n, CAST(SUM(p_size) AS BIGINT) AS sizes FROM part GROUP BY p_brand""")
def q_csv_untyped(spark, d):
    """Every column text, cast where it is used."""
    p = FS.read_csv_untyped(spark, _part_csv(spark, d))
    return p.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("p_size").cast("long")).alias("sizes"))


@register("load_replace_table", """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS DECIMAL(38,9)) AS p_retailprice
FROM part""")
def q_load_replace_table(spark, d):
    """A CSV object loaded into a catalog table, text but for one column; the
    second load replaces the first, and a view reads the table."""
    from tripmart.operators.table_store import create_table_as, create_view
    name = f"loaded_{uuid.uuid4().hex[:10]}"
    df = FS.load_replace(spark, _part_csv(spark, d), {"p_retailprice": "decimal(38,9)"})
    create_table_as(df.limit(3), name, path=_scratch(spark, "tables"))
    create_table_as(df, name, path=_scratch(spark, "tables"))
    create_view(spark.table(name), f"v_{name}")
    return spark.sql(f"SELECT * FROM v_{name}")


@register("source_registry", """
SELECT n_name, r_name, (SELECT COUNT(*) FROM nation) AS n_staged FROM nation JOIN region ON n_regionkey = r_regionkey""")
def q_source_registry(spark, d):
    """Named sources staged as views, found again by a pattern and joined in SQL."""
    from tripmart.sources.registry import Source, SourceRegistry
    reg, mark = SourceRegistry(spark), uuid.uuid4().hex[:10]
    for name in ("nation", "region"):
        reg.add(name, Source("parquet", f"{d.rstrip('/')}/{name}.parquet"))
        reg.stage(name, f"stg_{mark}_{name}")
    nation, region = sorted(reg.tables(f"stg_{mark}_*"))
    return spark.sql(f"SELECT n_name, r_name, (SELECT COUNT(*) FROM {nation}) AS n_staged FROM {nation} JOIN {region} ON n_regionkey = r_regionkey")


@register("seed_checked", "SELECT n_nationkey, n_name FROM nation")
def q_seed_checked(spark, d):
    """A lookup CSV with a declared schema, checked before it is used."""
    from tripmart.operators import quality as Q
    path = _scratch(spark, "seed")
    table(spark, d, "nation").select("n_nationkey", "n_name").write.option("header", True).csv(path)
    schema = T.StructType([T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_name", T.StringType())])
    df = FS.seed(spark, path, schema)
    Q.assert_passing(Q.run_checks(df, [Q.unique("n_nationkey"), Q.not_null("n_nationkey"), Q.not_null("n_name"), Q.not_empty()]))
    return df


@register("files_of_a_write", "SELECT 4 AS n_files, COUNT(*) AS n_rows FROM lineitem")
def q_files_of_a_write(spark, d):
    from tripmart.operators.table_store import write_table
    path = _scratch(spark, "four")
    write_table(table(spark, d, "lineitem").limit(10), path, files=2)
    write_table(table(spark, d, "lineitem"), path, files=4)        # replaces the first
    return FS.file_stats(spark.read.parquet(path)).agg(F.count(F.lit(1)).cast("int").alias("n_files"), F.sum("rows").alias("n_rows"))


@register("file_lineage", """
SELECT 'part' AS taxi_type, COUNT(*) AS n, COUNT(*) AS n_named, COUNT(*) AS n_stamped FROM part
UNION ALL SELECT 'supplier', COUNT(*), COUNT(*), COUNT(*) FROM supplier""")
def q_file_lineage(spark, d):
    """Each row's file name and load time, over two kinds of files."""
    paths = {}
    for kind, key in (("part", "p_partkey"), ("supplier", "s_suppkey")):
        paths[kind] = [_scratch(spark, kind)]
        table(spark, d, kind).select(F.col(key).alias("id")).write.parquet(paths[kind][0])
    df = FS.ingest(spark, paths, reader=lambda p: FS.with_source_file(spark.read.parquet(*p)))
    return df.groupBy("taxi_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("filename").startswith("part-")).alias("n_named"),
                                       F.count_if(F.col("extracted_at") <= F.current_timestamp()).alias("n_stamped"))


@register("first_rows", "SELECT event_id, ts, user_id FROM events ORDER BY ts, event_id LIMIT 10")
def q_first_rows(spark, d):
    return table(spark, d, "events").select("event_id", "ts", "user_id").orderBy("ts", "event_id").limit(10)
