import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tripmart.operators import distinct as D
from tripmart.operators import materialize as M
from tripmart.operators import quality as Q
from tripmart.operators.observed import checked_write
from tripmart.operators.partials import Partials
from tripmart.operators.reports import grouped_reports, read_report, write_grouped_reports
from tripmart.plans import marts
from tripmart.sources import files as FS
from tripmart.sources import quarantine as QU

from conftest import SF_SMALL


def shuffled_rows(jdf):
    """Rows written by each shuffle of a frame that has run."""
    out, todo = [], [jdf.queryExecution().executedPlan().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if name == "ShuffleExchangeExec":
            out.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return out


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------ distinct counts

def test_bitmaps_count_as_count_distinct(spark):
    rng = random.Random(1)
    edges = [0, -1, 1, 32767, 32768, 32769, -32768, -32769, 2**40, -2**40, 2**62]
    rows = [(dt.date(2024, 1, 1 + rng.randrange(6)), rng.choice("ab"), rng.choice([None, rng.randrange(-70000, 70000), *edges])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "day date, kind string, k long")
    maps = D.bitmaps(df, "k", ["day", "kind"])
    ranges = {f"{a}-{b}": (dt.date(2024, 1, a), dt.date(2024, 1, b)) for a in range(1, 7) for b in range(a, 8)}
    got = {r.range: r.n for r in D.count_in_ranges(maps, "day", ranges).collect()}
    assert got == {n: len({k for d, _, k in rows if a <= d < b and k is not None}) for n, (a, b) in ranges.items()}
    per = {r.kind: r.n for r in D.count_distinct(maps, ["kind"]).collect()}
    assert per == {c: len({k for _, x, k in rows if x == c and k is not None}) for c in "ab"}
    assert D.count_distinct(maps.limit(0)).first().n == 0
    assert "Expand" not in plan_of(D.count_in_ranges(maps, "day", ranges))


def test_ranges_read_the_stored_bitmaps_only(spark, tmp_dir):
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(F.to_date("ts").alias("day"), "user_id")
    D.bitmaps(e, "user_id", ["day"]).write.parquet(f"{tmp_dir}/m")
    plan = plan_of(D.count_in_ranges(spark.read.parquet(f"{tmp_dir}/m"), "day", {"x": (dt.date(2024, 1, 1), dt.date(2024, 1, 9))}))
    assert "events.parquet" not in plan and "partial_bitmap_or_agg" in plan


def test_maps_grow_with_the_keys_not_with_days_times_blocks(spark):
    rng = random.Random(2)
    far = [(dt.date(2024, 1, 1 + i % 20), rng.randrange(2**40)) for i in range(3000)]        # a block for nearly every key
    edge = [(dt.date(2024, 2, 1 + j), 32768 * 7 + 1 + i * 3) for j, n in enumerate((D.DENSE - 1, D.DENSE, D.DENSE + 1, 5000)) for i in range(n)]
    df = spark.createDataFrame((far + edge) * 2, "day date, k long")
    maps = D.bitmaps(df, "k", ["day"])
    size = F.coalesce(F.octet_length(D.BITS), F.lit(0)) + F.coalesce(4 * F.size(D.PLACES), F.lit(0))
    assert maps.agg(F.sum(size)).first()[0] <= 16 * len({*far, *edge})
    kinds = {r.day: r.dense for r in maps.where("day >= DATE '2024-02-01'").select("day", F.col(D.BITS).isNotNull().alias("dense")).collect()}
    assert kinds == {dt.date(2024, 2, 1 + j): j > 0 for j in range(4)}
    # lists and bitmaps unite
    spans = {f"{a}-{b}": (dt.date(2024, 2, a), dt.date(2024, 2, b)) for a, b in ((1, 2), (1, 4), (2, 5), (1, 5))} | {"all": (dt.date(2024, 1, 1), dt.date(2024, 3, 1))}
    got = {r.range: r.n for r in D.count_in_ranges(maps, "day", spans).collect()}
    assert got == {n: len({k for d, k in far + edge if a <= d < b}) for n, (a, b) in spans.items()}


# ------------------------------------------------ reports in one pass

def test_grouped_reports(spark, tmp_dir):
    rows = [(1, "a", 10), (1, "b", 5), (2, "a", 1), (None, "a", 7), (2, None, 3)]
    df = spark.createDataFrame(rows, "v int, z string, x int")
    reports = {"z": ["z"], "vz": ["v", "z"], "all": []}
    out = grouped_reports(df, reports, [F.sum("x").alias("s"), F.count(F.lit(1)).alias("n")])
    got = {(r.report, r.v, r.z): (r.s, r.n) for r in out.collect()}
    assert got == {("z", None, "a"): (18, 3), ("z", None, "b"): (5, 1), ("z", None, None): (3, 1),
                   ("vz", 1, "a"): (10, 1), ("vz", 1, "b"): (5, 1), ("vz", 2, "a"): (1, 1), ("vz", None, "a"): (7, 1), ("vz", 2, None): (3, 1),
                   ("all", None, None): (26, 5)}
    write_grouped_reports(df, f"{tmp_dir}/r", reports, [F.sum("x").alias("s")])
    assert read_report(spark, f"{tmp_dir}/r", "z", reports).columns == ["z", "s"]
    assert read_report(spark, f"{tmp_dir}/r", "vz", reports).count() == 5
    with pytest.raises(ValueError):
        grouped_reports(df, {"a": ["v", "z"], "b": ["z", "v"]}, [F.count(F.lit(1)).alias("n")])


def test_reports_take_one_shuffle_and_no_cache(spark):
    base = marts.revenue_base(spark, SF_SMALL)
    out = grouped_reports(base, {"by_zone": ["zone"], "by_vendor_zone": ["vendor_id", "zone"]}, [F.sum("total_amount").alias("revenue")])
    plan = plan_of(out)
    shuffles = [x for x in plan.split("Exchange hashpartitioning(")[1:] if "spark_grouping_id" in x.split(")")[0]]
    assert len(shuffles) == 1 and plan.count("Expand") == 1 and "InMemoryTableScan" not in plan
    single = {r.zone: r.revenue for r in marts.revenue_by_zone(base).collect()}
    assert {r.zone: r.revenue for r in out.where("report = 'by_zone'").collect()} == single


# ------------------------------------------------ checks while writing

def test_checked_write(spark, tmp_dir):
    rows = [(1, "a", 5), (2, "b", -1), (2, "c", None), (None, "zz", 0)]
    df = spark.createDataFrame(rows, "k int, c string, v int")
    every = [Q.not_null("v"), Q.accepted_values("c", ["a", "b", "c"]), Q.non_negative("v"), Q.positive("v"), Q.unique("k"), Q.primary_key("k"),
             Q.expression("small", "v < 3")]
    report = checked_write(df, f"{tmp_dir}/t", should=every)
    assert [(r.check, r.severity, r.violations, r.n_rows) for r in report.collect()] == [
        ("not_null", "warning", 1, 4), ("accepted_values", "warning", 1, 4), ("non_negative", "warning", 1, 4), ("positive", "warning", 2, 4),
        ("unique", "warning", 1, 4), ("primary_key", "warning", 2, 4), ("expression", "warning", 2, 4)]
    back = spark.read.parquet(f"{tmp_dir}/t")
    assert back.columns == df.columns and back.count() == 4
    for ch in every:                                           # as an error each one stops the write
        with pytest.raises(Exception, match="check failed"):
            checked_write(df, f"{tmp_dir}/no", must=[ch])
        assert not [n for _, _, names in os.walk(f"{tmp_dir}/no") for n in names if n.endswith(".parquet")]
    ok = checked_write(df.where("k = 1"), f"{tmp_dir}/ok", must=every[:6], partition_by=["c"])
    assert {r.violations for r in ok.collect()} == {0} and spark.read.parquet(f"{tmp_dir}/ok").count() == 1


def test_checked_write_is_one_job(spark, tmp_dir):
    spark.range(100).withColumn("v", F.col("id") % 7).write.parquet(f"{tmp_dir}/in")
    df = spark.read.parquet(f"{tmp_dir}/in")
    spark.sparkContext.setJobGroup("checked", "checked")
    try:
        checked_write(df, f"{tmp_dir}/out", must=[Q.not_null("id")], should=[Q.positive("v")])
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("checked")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 1


# ------------------------------------------------ quarantine

def test_quarantine(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/a.csv", "w") as f:
        f.write("id,name,at,v\n1,ann,2024-01-01 00:00:00,1.5\nx,bob,2024-01-01 00:00:00,y\n3,,,\n4,dan\n5,eve,soon,2\n6,f,2024-01-01 00:00:00,1,9\n 7 ,g,2024-02-30 00:00:00,3\n")
    marked = QU.read_csv_marked(spark, f"{tmp_dir}/in", "id int, name string, at timestamp_ntz, v double")
    QU.write_split(marked, f"{tmp_dir}/out")
    ok = sorted((r.id, r.name, r.at, r.v) for r in QU.good(spark, f"{tmp_dir}/out").collect())
    assert ok == [(1, "ann", dt.datetime(2024, 1, 1), 1.5), (3, None, None, None)]
    bad = {(r.name or r._line): sorted(r._reasons) for r in QU.rejects(spark, f"{tmp_dir}/out").collect()}
    assert bad == {"bob": ["id is no int: x", "v is no double: y"], "4,dan": [QU.FIELDS], "eve": ["at is no timestamp_ntz: soon"],
                   "6,f,2024-01-01 00:00:00,1,9": [QU.FIELDS], "g": ["at is no timestamp_ntz: 2024-02-30 00:00:00"]}
    assert len(ok) + len(bad) == 7
    one = QU.read_csv_marked(spark, f"{tmp_dir}/in", "id int, name string, at timestamp_ntz, v double").select("id", QU.REASONS)
    assert one.where(F.size(QU.REASONS) == 0).count() == 2     # fields are counted though few columns are asked for


# ------------------------------------------------ run-time filters

def test_dynamic_partition_pruning(spark, tmp_dir):
    t = spark.range(4000).select((F.col("id") % 5 + 2020).cast("int").alias("yr"), (F.col("id") % 12 + 1).cast("int").alias("mon"), "id")
    t.write.partitionBy("yr", "mon").parquet(f"{tmp_dir}/t")
    spark.range(60).select((F.col("id") % 5 + 2020).cast("int").alias("yr"), (F.floor(F.col("id") / 5) + 1).cast("int").alias("mon"),
                           F.lit("x").alias("tag")).write.parquet(f"{tmp_dir}/cal")
    wanted = spark.read.parquet(f"{tmp_dir}/cal").where("yr = 2021 AND mon IN (3, 4) AND tag = 'x'")
    got = FS.read_matching(spark, f"{tmp_dir}/t", wanted, ["yr", "mon"])
    plan = plan_of(got)
    assert "dynamicpruning" in plan
    assert sorted(r.id for r in got.collect()) == [i for i in range(4000) if i % 5 == 1 and i % 12 in (2, 3)]


def test_key_merge_behind_a_bloom_filter(spark, tmp_dir):
    spark.range(20000).select("id", (F.col("id") * 3).alias("v")).write.parquet(f"{tmp_dir}/target")
    spark.range(19000, 40000).select("id", F.lit(1).cast("long").alias("v")).write.parquet(f"{tmp_dir}/all")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.optimizer.runtime.bloomFilter.enabled": "true", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        target = spark.read.parquet(f"{tmp_dir}/target")
        batch = spark.read.parquet(f"{tmp_dir}/all").where("id % 100 = 0 AND id < 21000")
        keys = M.keys_in(target, batch, ["id"])
        assert "might_contain" in plan_of(keys) and "might_contain" in plan_of(M.merge_insert(target, batch, ["id"], small_batch=True))
        assert sorted(r.id for r in keys.collect()) == list(range(19000, 20000, 100))
        ids = [r.id for r in M.merge_insert(target, batch, ["id"], small_batch=True).collect()]
        assert sorted(ids) == [*range(20000), *range(20000, 21000, 100)]
        # of the target's 20000 rows hardly more than the ten that match are shuffled
        ran = M.keys_in(target, batch, ["id"])
        jdf = ran._jdf
        jdf.collect()
        assert max(shuffled_rows(jdf)) < 1500
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# ------------------------------------------------ partial states

def test_partials_merge_replace_and_compact(spark, tmp_dir):
    def states(path):
        return Partials(spark, path, {"g": F.col("g")}, {"n": (F.count(F.lit(1)), F.sum), "s": (F.sum("v").cast("decimal(38,2)"), F.sum),
                                                         "lo": (F.min("v"), F.min), "hi": (F.max("v"), F.max)})
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(-50, 50)) for _ in range(300)]
    df = lambda some: spark.createDataFrame(some, "g string, v int")
    p = states(f"{tmp_dir}/p")
    p.add(df(rows[:50]), "1")
    p.add(df(rows[:100]), "1")                                  # loaded again, whole this time
    p.add(df(rows[100:180]), "2")
    p.compact()
    p.add(df(rows[180:]), "3")
    states(f"{tmp_dir}/p").add(df(rows[180:]), "3")             # again, by another job
    want = {g: (len(v), sum(v), min(v), max(v)) for g in ("a", "b", None) for v in [[x for k, x in rows if k == g]]}
    assert {r.g: (r.n, int(r.s), r.lo, r.hi) for r in p.merged().collect()} == want
    assert p.store.read().count() == 6                          # three groups compacted, three of the last batch
