import datetime as dt
import decimal
import os

import pytest
from pyspark.sql import functions as F

from tripmart.operators import materialize as M
from tripmart.operators.table_store import TableStore

SCHEMA = "k int, part string, ts timestamp_ntz, v int"


def rows(store):
    return sorted(tuple(r) for r in store.read().select("k", "part", "ts", "v").collect())


def df(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


T1, T2, T3 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)


def test_merge_insert_only(spark, tmp_dir):
    st = TableStore(spark, f"{tmp_dir}/t", ["part"])
    st.append(df(spark, [(1, "a", T1, 1)]))
    # key already in target (skipped), new key, new key twice in batch (both inserted)
    st.merge_insert(df(spark, [(1, "a", T1, 9), (2, "a", T1, 2), (3, "b", T2, 3), (3, "b", T2, 3)]), ["k"])
    assert rows(st) == [(1, "a", T1, 1), (2, "a", T1, 2), (3, "b", T2, 3), (3, "b", T2, 3)]
    st2 = TableStore(spark, f"{tmp_dir}/t2", ["part"])
    st2.merge_insert(df(spark, [(3, "b", T2, 3), (3, "b", T2, 3)]), ["k"], dedupe=True)
    assert rows(st2) == [(3, "b", T2, 3)]


def test_merge_upsert_changes_adds_and_rejects_duplicates(spark, tmp_dir):
    st = TableStore(spark, f"{tmp_dir}/t", ["part"])
    st.append(df(spark, [(1, "a", T1, 1), (2, "b", T1, 2)]))
    src = df(spark, [(1, "b", T2, 10), (3, "c", T3, 3)]).withColumn("extra", F.lit("x"))
    st.merge_upsert(src, ["k"])
    r = sorted(tuple(x) for x in st.read().select("k", "part", "v", "extra").collect())
    # changed row moved partition a -> b; new row; new column NULL for old rows
    assert r == [(1, "b", 10, "x"), (2, "b", 2, None), (3, "c", 3, "x")]
    assert not os.path.exists(f"{tmp_dir}/t/data/part=a/_batch=all")
    with pytest.raises(ValueError):
        st.merge_upsert(df(spark, [(5, "a", T1, 1), (5, "a", T1, 2)]), ["k"])


def test_replace_interval_edges(spark, tmp_dir):
    st = TableStore(spark, f"{tmp_dir}/t", ["part"])
    st.append(df(spark, [(1, "a", T1, 1), (2, "b", T2, 2), (3, "c", T3, 3)]))
    # window [T1, T3): row on start is in, row on end is out; spans two partitions
    st.replace_interval(df(spark, [(9, "a", T1, 9), (8, "c", T3, 8)]), "ts", T1, T3)
    assert rows(st) == [(3, "c", T3, 3), (9, "a", T1, 9)]
    # empty source window: the window's rows are deleted, nothing inserted
    st.replace_interval(df(spark, []), "ts", T3, dt.datetime(2024, 1, 4))
    assert rows(st) == [(9, "a", T1, 9)]


def test_delete_insert_and_truncate(spark, tmp_dir):
    st = TableStore(spark, f"{tmp_dir}/t", ["part"])
    st.append(df(spark, [(1, "a", T1, 1), (1, "b", T2, 2), (2, "b", T2, 3)]))
    st.delete_insert(df(spark, [(1, "c", T3, 7)]), ["k"])
    assert rows(st) == [(1, "c", T3, 7), (2, "b", T2, 3)]
    st.truncate_insert(df(spark, [(4, "d", T1, 4)]))
    assert rows(st) == [(4, "d", T1, 4)]


def files(path):
    return {os.path.join(d, n) for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def test_unpartitioned_table(spark, tmp_dir):
    st = TableStore(spark, f"{tmp_dir}/t")
    assert not st.exists()
    st.append(df(spark, [(1, "a", T1, 1)]), batch="b-0")
    st.append(df(spark, [(1, "a", T1, 1)]), batch="b-0")          # the same batch again
    assert st.exists() and st.read().columns == ["k", "part", "ts", "v"] and rows(st) == [(1, "a", T1, 1)]
    st.merge_upsert(df(spark, [(1, "a", T1, 5)]), ["k"])
    assert rows(st) == [(1, "a", T1, 5)]
    st.append(df(spark, [(1, "a", T1, 7)]))
    st.append(df(spark, [(1, "a", T1, 7)]))
    assert len(rows(st)) == 3
    st.overwrite(st.read().where("v = 5").withColumn("more", F.lit(1)))   # from its own rows
    assert [tuple(r) for r in st.read().collect()] == [(1, "a", T1, 5, 1)]
    st.overwrite(df(spark, []))
    assert st.read().columns == ["k", "part", "ts", "v"] and rows(st) == []


def test_untouched_partitions_keep_their_files(spark, tmp_dir):
    base = [(i, p, t, i) for i, (p, t) in enumerate([("a", T1), ("b", T2), ("c", T3), (None, T3), ("2024-01", T1)])]
    changes = {
        "merge_upsert": lambda st: st.merge_upsert(df(spark, [(1, "b", T2, 10)]), ["k"]),
        "delete_insert": lambda st: st.delete_insert(df(spark, [(1, "b", T2, 10)]), ["k"]),
        "replace_interval": lambda st: st.replace_interval(df(spark, [(1, "b", T2, 10)]), "ts", T2, T3)}
    for name, change in changes.items():
        st = TableStore(spark, f"{tmp_dir}/{name}", ["part"])
        st.append(df(spark, base))
        before = files(st.data)
        change(st)
        after = files(st.data)
        assert {f for f in before - after} == {f for f in before if "part=b" in f} and len(after) == len(before), name
        again = TableStore(spark, f"{tmp_dir}/{name}", ["part"])    # types come from the table, not from folder names
        assert sorted(map(str, again.read().collect())) == sorted(map(str, [
            again.read().collect()[0].__class__(k=k, ts=t, v=10 if k == 1 else v, part=p) for k, p, t, v in base])), name
        assert dict(again.read().dtypes)["part"] == "string"


def test_a_failing_change_leaves_the_table(spark, tmp_dir):
    st = TableStore(spark, f"{tmp_dir}/t", ["part"])
    st.append(df(spark, [(1, "a", T1, 1), (2, "b", T2, 2)]))
    bad = df(spark, [(1, "a", T1, 3), (2, "b", T2, 4)]).withColumn("v", F.when(F.col("k") == 2, F.raise_error(F.lit("stop"))).otherwise(F.col("v")))
    before = files(st.data)
    for change in (lambda: st.merge_upsert(bad, ["k"]), lambda: st.append(bad), lambda: st.overwrite(bad),
                   lambda: st._replace(bad.withColumn("_batch", F.lit("all")), [])):
        with pytest.raises(Exception, match="stop"):
            change()
        assert files(st.data) == before and rows(st) == [(1, "a", T1, 1), (2, "b", T2, 2)]


def test_named_batches_live_beside_changes(spark, tmp_dir):
    st = TableStore(spark, f"{tmp_dir}/t", ["part"])
    for i in range(3):
        st.append(df(spark, [(i, "a", T1, i), (10 + i, "b", T2, i)]), batch=f"q-{i}")
    st.merge_upsert(df(spark, [(1, "a", T1, 99)]), ["k"])
    st.append(df(spark, [(2, "a", T1, 2), (12, "b", T2, 2)]), batch="q-2")
    assert sorted((r[0], r[3]) for r in rows(st)) == [(0, 0), (1, 99), (2, 2), (10, 0), (11, 1), (12, 2)]


def test_pure_cores(spark):
    t = df(spark, [(1, "a", T1, 1), (None, "a", T1, 5)])
    s = df(spark, [(1, "a", T2, 2), (None, "a", T2, 6)])
    # NULL keys never match: inserted by merge_insert
    assert M.merge_insert(t, s, ["k"]).count() == 3
    assert sorted(r.v for r in M.append(t, s).collect()) == [1, 2, 5, 6]
    hw = M.high_water_filter(s, t, "ts")
    assert hw.count() == 2
    assert M.high_water_filter(s, t.limit(0), "ts").count() == 2
    lb = M.high_water_filter(t, s, "ts", lookback=dt.timedelta(days=2))
    assert lb.count() == 2  # max(T2) - 2 days < T1
    assert M.high_water_filter(t, s, "ts", lookback=dt.timedelta(days=1)).count() == 0  # strict >


def test_backfill_crosses_new_year_in_one_replace(spark, tmp_dir):
    st = TableStore(spark, f"{tmp_dir}/t", ["part"])
    old = [(1, "2019-12", dt.datetime(2019, 12, 5), 1), (2, "2020-01", dt.datetime(2020, 1, 5), 2),
           (3, "2020-03", dt.datetime(2020, 3, 5), 3)]
    st.append(df(spark, old))
    new = [(10, "2019-12", dt.datetime(2019, 12, 6), 10), (20, "2020-02", dt.datetime(2020, 2, 6), 20)]
    st.backfill(df(spark, new), "ts", [dt.date(2019, 12, 1), dt.date(2020, 2, 1)])
    assert [r[0] for r in rows(st)] == [3, 10, 20]


def test_reports_table_and_view(spark, tmp_dir):
    from tripmart.operators.table_store import create_table_as, create_view, write_reports
    base = df(spark, [(1, "a", T1, 1), (2, "a", T2, 5)])
    write_reports(base, {f"{tmp_dir}/r1": lambda b: b.groupBy("part").count(),
                         f"{tmp_dir}/r2": lambda b: b.agg(F.sum("v").alias("s"))})
    assert spark.read.parquet(f"{tmp_dir}/r2").first()["s"] == 6
    create_table_as(base, "tm_test_table", path=f"{tmp_dir}/tbl")
    assert spark.table("tm_test_table").count() == 2
    create_view(base, "tm_test_view")
    assert spark.sql("SELECT SUM(v) FROM tm_test_view").first()[0] == 6


def test_fixed_number_of_files_from_whole_pieces(spark, tmp_dir):
    from tripmart.operators.table_store import write_table
    from tripmart.session import scratch_path
    rows_of = lambda path: [{r.id for r in spark.read.parquet(f).collect()} for f in files(path)]
    write_table(spark.range(0, 8000, 1, 8), f"{tmp_dir}/a", files=3)
    got = rows_of(f"{tmp_dir}/a")
    assert sorted(map(len, got)) == [2000, 3000, 3000] and set.union(*got) == set(range(8000))
    # no row was shuffled: what one task wrote aside lies in one file
    assert all(ids >= set(range(1000 * (min(ids) // 1000), 1000 * (min(ids) // 1000) + 1000)) for ids in got)
    assert all(len({i // 1000 for i in ids}) * 1000 == len(ids) for ids in got)
    write_table(spark.range(0, 100, 1, 1), f"{tmp_dir}/b", files=4)      # fewer pieces than files
    assert sorted(map(len, rows_of(f"{tmp_dir}/b"))) == [25] * 4
    write_table(spark.range(0, 40, 1, 2), f"{tmp_dir}/b", files=1)       # replaces them
    assert rows_of(f"{tmp_dir}/b") == [set(range(40))]
    write_table(spark.range(40, 50, 1, 1), f"{tmp_dir}/b", files=1, mode="append")
    assert sorted(map(len, rows_of(f"{tmp_dir}/b"))) == [10, 40]
    assert not files(scratch_path(spark, "pieces").removeprefix("file:"))


def test_rows_are_not_sorted_to_list_partitions(spark, tmp_dir, monkeypatch):
    big = spark.range(0, 200_000, 1, 2).select(F.col("id").cast("int").alias("k"), F.when(F.col("id") < 150_000, "a").otherwise("b").alias("part"),
                                               F.lit(T1).alias("ts"), F.lit(1).alias("v"))
    kind = type(big)
    ran, collect = [], kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: (collect(self), ran.append(self))[0])

    def below(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return [node.executedPlan()]
        if name.endswith("QueryStageExec"):
            return [node.plan()]
        return [node.children().apply(i) for i in range(node.children().size())]

    def rows_of(node):
        return node.metrics().apply("numOutputRows").value() if node.metrics().contains("numOutputRows") else sum(map(rows_of, below(node)))

    def sorted_rows(node):
        mine = sum(map(rows_of, below(node))) if node.getClass().getSimpleName() == "SortExec" else 0
        return mine + sum(map(sorted_rows, below(node)))

    changes = {"replace_interval": lambda st: st.replace_interval(df(spark, [(1, "b", T1, 9)]), "ts", T1, T2),
               "delete_insert": lambda st: st.delete_insert(df(spark, [(1, "b", T1, 9)]), ["k"]),
               "truncate_insert": lambda st: st.truncate_insert(df(spark, [(1, "b", T1, 9)]))}
    for name, change in changes.items():
        st = TableStore(spark, f"{tmp_dir}/{name}", ["part"])
        st.append(big)
        ran.clear()
        change(st)
        assert ran and sum(sorted_rows(d._jdf.queryExecution().executedPlan()) for d in ran) < 100, name
        assert st.read().where("v = 9").count() == 1 and st.read().count() == {"delete_insert": 200_000}.get(name, 1), name


def test_rerunning_a_change_is_idempotent(spark, tmp_dir):
    base = [(1, "a", T1, 1), (2, "b", T2, 2), (3, "c", T3, 3)]
    src = [(2, "b", T2, 20), (4, "c", T3, 4)]
    ops = {
        "merge_insert": lambda st, s: st.merge_insert(s, ["k"]),
        "merge_upsert": lambda st, s: st.merge_upsert(s, ["k"]),
        "replace_interval": lambda st, s: st.replace_interval(s, "ts", T2, T3 + dt.timedelta(days=1)),
        "delete_insert": lambda st, s: st.delete_insert(s, ["k"]),
    }
    for name, op in ops.items():
        st = TableStore(spark, f"{tmp_dir}/{name}", ["part"])
        st.append(df(spark, base))
        op(st, df(spark, src))
        once = rows(st)
        op(st, df(spark, src))
        assert rows(st) == once, name


def test_upsert_null_keys_never_match_and_are_not_duplicates(spark, tmp_dir):
    st = TableStore(spark, f"{tmp_dir}/t", ["part"])
    st.append(df(spark, [(None, "a", T1, 1), (1, "a", T1, 1)]))
    st.merge_upsert(df(spark, [(None, "a", T1, 2), (None, "a", T1, 3), (1, "a", T1, 9)]), ["k"])
    got = sorted(tuple(r) for r in st.read().select("k", "v").collect() if r["k"] is not None)
    assert got == [(1, 9)]
    assert st.read().where("k IS NULL").count() == 3


@pytest.mark.parametrize("kind,values", [
    ("boolean", [True, False, None]), ("double", [1e10, 0.1, None]),
    ("timestamp_ntz", [dt.datetime(2024, 1, 1, 0, 0, 0, 500000), dt.datetime(2024, 1, 2), None]),
    ("decimal(10,2)", [decimal.Decimal("1.50"), decimal.Decimal("2.00"), None]),
    ("date", [dt.date(2024, 1, 1), dt.date(2024, 1, 2), None]), ("string", ["a/b=c", "x y", None])])
def test_upsert_into_typed_partitions(spark, tmp_dir, kind, values):
    st = TableStore(spark, f"{tmp_dir}/t", ["p"])
    a, b, c = values
    schema = f"k int, v int, p {kind}"
    st.append(spark.createDataFrame([(1, 1, a), (2, 1, b), (4, 1, c)], schema))
    st.merge_upsert(spark.createDataFrame([(1, 9, a), (3, 9, b), (4, 9, c)], schema), ["k"])
    got = sorted((r.k, r.v, r.p) for r in st.read().collect())
    assert got == [(1, 9, a), (2, 1, b), (3, 9, b), (4, 9, c)]
