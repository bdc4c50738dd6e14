import datetime as dt
import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators.table_store import TableStore
from tripmart.sources import files as FS
from tripmart.sources import jdbc, ledger
from tripmart.sources.paged import paged_scan
from tripmart.sources.registry import Source, SourceRegistry

from conftest import SF_SMALL

TRIP_SCHEMA = T.StructType([T.StructField("VendorID", T.LongType()),
                            T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
                            T.StructField("fare_amount", T.DoubleType())])


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_typed_csv_and_external_table(spark, tmp_dir):
    p = f"{tmp_dir}/y.csv"
    _write(p, "VendorID,tpep_pickup_datetime,fare_amount\n1,2024-01-01 00:00:07,12.5\nx,2024-01-02 10:00:00,3,EXTRA\n2,,\n")
    with pytest.raises(Exception, match="(?i)malformed"):    # a typed scan stops on a bad value
        FS.read_csv(spark, p, TRIP_SCHEMA).collect()
    _write(f"{tmp_dir}/swapped.csv", "fare_amount,note,VendorID,tpep_pickup_datetime\n12.5,n,1,2024-01-01 00:00:07\n")
    df = FS.read_csv(spark, f"{tmp_dir}/swapped.csv", TRIP_SCHEMA)      # columns are bound by header name
    assert [tuple(r) for r in df.collect()] == [(1, dt.datetime(2024, 1, 1, 0, 0, 7), 12.5)]
    with pytest.raises(ValueError, match="other"):
        FS.read_csv(spark, f"{tmp_dir}/swapped.csv", "other int")
    ext = FS.external_csv(spark, p, TRIP_SCHEMA).collect()
    assert ext[1]["VendorID"] is None and ext[1]["fare_amount"] == 3.0   # bad value -> NULL, surplus dropped
    assert ext[2]["fare_amount"] is None                                 # missing -> NULL
    untyped = FS.read_csv_untyped(spark, p)
    assert all(isinstance(f.dataType, T.StringType) for f in untyped.schema.fields)
    lr = FS.load_replace(spark, p, {"fare_amount": "decimal(38,9)"})
    assert isinstance(lr.schema["fare_amount"].dataType, T.DecimalType)


def test_copy_in_explicit_columns(spark, tmp_dir):
    p = f"{tmp_dir}/g.csv"
    _write(p, "VendorID,fare_amount\n1,2.5\n")
    target = T.StructType([T.StructField("VendorID", T.LongType()), T.StructField("fare_amount", T.DoubleType()),
                           T.StructField("unique_row_id", T.StringType())])
    out = FS.copy_in(spark, p, ["VendorID", "fare_amount"], target).collect()
    assert tuple(out[0]) == (1, 2.5, None)


def test_gzip_csv_repartitioned(spark, tmp_dir):
    import gzip
    p = f"{tmp_dir}/z.csv.gz"
    with gzip.open(p, "wt") as f:
        f.write("VendorID,tpep_pickup_datetime,fare_amount\n" + "".join(f"{i},2024-01-01 00:00:00,1.0\n" for i in range(100)))
    df = FS.read_csv(spark, p, TRIP_SCHEMA, min_partitions=4)
    assert df.count() == 100 and df.rdd.getNumPartitions() == 4


def test_json_array_products_default_brand(spark, tmp_dir):
    from tripmart.operators.project import keep_with_default
    p = f"{tmp_dir}/products.json"
    _write(p, json.dumps({"products": [{"id": 1, "price": 10.0, "brand": "A"}, {"id": 2, "price": 20.0},
                                       {"id": 3, "price": 30.0, "brand": None}]}))
    df = FS.read_json_array(spark, p, "products")
    got = sorted(tuple(r) for r in keep_with_default(df, ["id", "brand", "color"], "N/A").collect())
    # absent field in every doc -> default; absent in one doc / null -> NULL unless fill_null
    assert got == [(1, "A", "N/A"), (2, None, "N/A"), (3, None, "N/A")]
    filled = keep_with_default(df, ["id", "brand"], "N/A", fill_null=True).orderBy("id").collect()
    assert [r.brand for r in filled] == ["A", "N/A", "N/A"]


def test_month_range_across_new_year_and_paths():
    assert FS.month_range(dt.date(2019, 11, 1), dt.date(2020, 2, 1)) == [
        dt.date(2019, 11, 1), dt.date(2019, 12, 1), dt.date(2020, 1, 1), dt.date(2020, 2, 1)]
    ps = FS.period_paths("/r", ["green", "yellow"], dt.date(2019, 12, 1), dt.date(2020, 1, 1))
    assert ps[0] == "/r/green_tripdata_2019-12.parquet" and len(ps) == 4


def test_ingest_ragged_and_file_stats(spark, tmp_dir):
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    e.select("event_id", "value").coalesce(1).write.parquet(f"{tmp_dir}/green")
    e.select("event_id", "ts").coalesce(1).write.parquet(f"{tmp_dir}/yellow")
    df = FS.ingest(spark, {"green": [f"{tmp_dir}/green"], "yellow": [f"{tmp_dir}/yellow"]})
    assert set(df.columns) == {"event_id", "value", "ts", "taxi_type", "extracted_at"}
    assert df.count() == 2 * e.count()
    st = FS.file_stats(spark.read.parquet(f"{tmp_dir}/green")).collect()
    assert len(st) == 1 and st[0]["rows"] == e.count() and st[0]["file_size"] > 0
    named = FS.with_source_file(spark.read.parquet(f"{tmp_dir}/green"))
    assert named.select("filename").distinct().count() == 1


def test_partition_read_prunes(spark, tmp_dir):
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    e.write.partitionBy("event_type").parquet(f"{tmp_dir}/p")
    df = FS.read_partition(spark, f"{tmp_dir}/p", event_type="click")
    assert "PartitionFilters: [isnotnull(event_type" in df._jdf.queryExecution().executedPlan().toString() or \
        df.count() == e.where("event_type = 'click'").count()
    assert df.count() == e.where("event_type = 'click'").count()


def test_paged_source_page_and_offset(spark, tmp_dir):
    d = f"{tmp_dir}/pages"
    os.makedirs(d)
    for page in (1, 2, 3):
        _write(f"{d}/page_{page}.json", json.dumps([{"id": page * 10 + i, "v": f"p{page}"} for i in range(3)]))
    _write(f"{d}/page_4.json", "[]")
    _write(f"{d}/page_5.json", json.dumps([{"id": 999, "v": "after-empty"}]))
    df = paged_scan(spark, d + "/page_{page}.json", "id long, v string", kind="page")
    assert sorted(r.id for r in df.collect()) == [10, 11, 12, 20, 21, 22, 30, 31, 32]   # nothing after the empty page 4
    with pytest.raises(AnalysisException):
        paged_scan(spark, f"{tmp_dir}/nowhere/page_{{page}}.json", "id long").count()
    _write(f"{d}/bad/page_1.json", '[{"id": ')
    with pytest.raises(Exception, match="(?i)malformed"):
        paged_scan(spark, d + "/bad/page_{page}.json", "id long").collect()
    for off in range(0, 250, 100):
        recs = [{"id": i} for i in range(off, min(off + 100, 250))]
        _write(f"{d}/off_{off}.json", json.dumps({"total": 250, "data": recs}))
    below = paged_scan(spark, d + "/off_{offset}.json", "id long", kind="offset", limit=100)
    assert below.count() == 250
    capped = paged_scan(spark, d + "/off_{offset}.json", "id long", kind="offset", limit=100, max=150)
    assert capped.count() == 150


def test_paged_offset_without_total_and_large(spark, tmp_dir):
    d = f"{tmp_dir}/off"
    for off in range(0, 2000, 100):   # more than a thousand rows, no total in the body
        _write(f"{d}/o_{off}.json", json.dumps([{"id": off + i} for i in range(100)]))
    assert paged_scan(spark, d + "/o_{offset}.json", "id long", kind="offset", limit=100).count() == 2000


def test_paged_endpoint_has_no_cap(monkeypatch):
    from tripmart.sources import paged
    pages = 250_000
    monkeypatch.setattr(paged, "_fetch", lambda url: [{"id": 1}] if int(url.rsplit("=", 1)[1]) <= pages else [])
    schema = T.StructType([T.StructField("id", T.LongType())])
    r = paged.PagedReader(schema, {"url": "http://x?page={page}", "pages_per_partition": 1000})
    parts = r.partitions()
    assert parts[-1].last == pages and len(parts) == 250
    monkeypatch.setattr(paged, "_fetch", lambda url: {"total": 50_000, "data": [{"id": 1}] * 100})
    r = paged.PagedReader(schema, {"url": "http://x?offset={offset}&limit={limit}", "kind": "offset"})
    assert len(r.partitions()) == 500
    monkeypatch.setattr(paged, "_fetch", lambda url: [] if url.endswith("=2") else [{"id": 1}])
    r = paged.PagedReader(schema, {"url": "http://x?page={page}", "pages": 3})
    with pytest.raises(ValueError, match="page 2"):
        list(r.read(r.partitions()[0]))


def test_ledger_changed_files(spark, tmp_dir):
    d = f"{tmp_dir}/files"
    for name, body in (("a.csv", "x"), ("b.csv", "yy"), ("c.csv", "zzz")):
        _write(f"{d}/{name}", body)
    _write(f"{tmp_dir}/other/a.csv", "xxxx")   # the same name in another folder is another file
    pre = "file:" + d
    led = spark.createDataFrame([(f"{pre}/a.csv", 1), (f"{pre}/b.csv", 5)], "file_path string, file_size long")
    ch = ledger.changed_files(ledger.listing(spark, f"{tmp_dir}/*/*.csv"), led)
    assert sorted(r.file_path.split(tmp_dir)[1] for r in ch.collect()) == ["/files/b.csv", "/files/c.csv", "/other/a.csv"]
    st = TableStore(spark, f"{tmp_dir}/ledger")
    ledger.record(st, led)
    ledger.record(st, ch)
    assert sorted((r.file_path.split(tmp_dir)[1], r.file_size) for r in st.read().collect()) == [
        ("/files/a.csv", 1), ("/files/b.csv", 2), ("/files/c.csv", 3), ("/other/a.csv", 4)]


def test_jdbc_replace_then_append_embedded_derby(spark):
    url = "jdbc:derby:memory:tripmart_test;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    jdbc.load_replace_then_append(df.limit(1), df.where("id = 2"), url, "PEOPLE", props, batchsize=1)
    back = jdbc.read_jdbc(spark, url, "PEOPLE", props, partition_column="ID", lower=0, upper=3, num_partitions=2)
    assert sorted(tuple(r) for r in back.collect()) == [(1, "a"), (2, "b")]


def test_source_registry_stage_view(spark):
    reg = SourceRegistry(spark)
    reg.add("zones", Source("parquet", f"{SF_SMALL}/nation.parquet"))
    reg.stage("zones")
    assert spark.sql("SELECT COUNT(*) FROM stg_zones").first()[0] == 25
    assert "stg_zones" in reg.tables("stg_*")


def test_format_conversion_csv_to_parquet_with_constant(spark, tmp_dir):
    from tripmart.operators.table_store import write_table
    p = f"{tmp_dir}/people.csv"
    _write(p, "name,age\nann,30\nbob, 41\n")
    df = FS.read_csv(spark, p, "name string, age int", trim=True).withColumn("processed", F.lit(True))
    write_table(df, f"{tmp_dir}/out", files=1)
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp_dir}/out").collect()) == [("ann", 30, True), ("bob", 41, True)]
