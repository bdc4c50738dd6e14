import pytest
from pyspark.sql import functions as F

from tripmart.operators import quality as Q
from tripmart.operators.dedupe import dedupe_any, dedupe_first
from tripmart.operators.joins import broadcast_if_small, not_in, role_playing


def test_dedupe_first_full_duplicate_and_order(spark):
    df = spark.createDataFrame([(1, 1, 5, "x"), (1, 1, 5, "x"), (1, 1, 3, "y"), (2, None, 9, "z"), (2, None, 8, "w")],
                               "a int, b int, o int, v string")
    got = sorted(tuple(r) for r in dedupe_first(df, ["a", "b"], ["o"]).collect())
    # NULL key parts group together (GROUP BY semantics)
    assert got == [(1, 1, 3, "y"), (2, None, 8, "w")]


def test_dedupe_first_nulls_first_and_descending(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 2, "b"), (1, 7, "c")], "k int, o int, v string")
    assert dedupe_first(df, ["k"], ["o"]).first()["v"] == "a"
    assert dedupe_first(df, ["k"], ["o"], descending=["o"]).first()["v"] == "c"


def test_dedupe_any_is_deterministic(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k int, v string")
    assert sorted(tuple(r) for r in dedupe_any(df, ["k"]).collect()) == [(1, "a"), (2, "c")]
    assert dedupe_any(df, ["k"], deterministic=False).count() == 2


def test_not_in_null_semantics(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    sub = spark.createDataFrame([(1,)], "s int")
    assert sorted(r[0] for r in not_in(df, "k", sub, "s").collect()) == [2]
    sub_null = spark.createDataFrame([(1,), (None,)], "s int")
    assert not_in(df, "k", sub_null, "s").count() == 0
    empty = spark.createDataFrame([], "s int")
    assert not_in(df, "k", empty, "s").count() == 3


def test_string_key_join_with_text_value(spark):
    # a string key ("N/A") joined to an integer key: cast explicitly first
    zones = spark.createDataFrame([("1", "A"), ("N/A", "B")], "id string, zone string")
    trips = spark.createDataFrame([(1,), (2,)], "loc int")
    z = zones.select(F.col("id").try_cast("int").alias("loc"), "zone")
    assert [tuple(r) for r in trips.join(z, "loc").collect()] == [(1, "A")]


def test_role_playing_prefixes(spark):
    dim = spark.createDataFrame([(1, "A"), (2, "B")], "id int, zone string")
    f = spark.createDataFrame([(1, 2), (2, 3)], "pu int, do int")
    out = role_playing(f, dim, "id", {"p": "pu", "d": "do"}, ["zone"]).orderBy("pu").collect()
    assert [(r.p_zone, r.d_zone) for r in out] == [("A", "B"), ("B", None)]


def _hinted(df):
    return "broadcast" in str(df._jdf.queryExecution().logical()).lower()


def test_broadcast_only_when_small(spark):
    from conftest import SF_SMALL
    nation = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    assert _hinted(broadcast_if_small(nation))
    assert not _hinted(broadcast_if_small(nation, max_bytes=0))
    # a frame of unknown size (RDD-backed) is never hinted
    assert not _hinted(broadcast_if_small(spark.createDataFrame([(1,)], "a int")))


def test_quality_checks_one_violation_each(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "b", -1.0), (2, None, 0.0), (None, "zz", 2.0)],
                               "id int, code string, amt double")
    rep = Q.run_checks(df, [Q.not_null("code"), Q.unique("id"), Q.accepted_values("code", ["a", "b"]),
                            Q.non_negative("amt"), Q.positive("amt"), Q.primary_key("id"),
                            Q.expression("small", "amt < 2")])
    got = {(r["check"], r["column"]): r["violations"] for r in rep.collect()}
    assert got == {("not_null", "code"): 1, ("unique", "id"): 1, ("accepted_values", "code"): 1,
                   ("non_negative", "amt"): 1, ("positive", "amt"): 2, ("primary_key", "id"): 2,
                   ("expression", "small"): 1}
    with pytest.raises(Q.CheckFailed):
        Q.assert_passing(rep)
    assert Q.scalar_equals(df.agg(F.count("*")), 4)
    ok = {r["check"]: r["violations"] for r in Q.run_checks(df, [Q.not_empty()]).collect()}
    assert ok == {"not_empty": 0}
    empty = {r["check"]: r["violations"] for r in Q.run_checks(df.limit(0), [Q.not_empty()]).collect()}
    assert empty == {"not_empty": 1}


def test_dedupe_limits_each_key_before_the_exchange_and_matches_window(spark):
    import datetime as dt
    from pyspark.sql import Window
    rows = [(1, 5, dt.datetime(2024, 1, 1), "a"), (1, 7, dt.datetime(2024, 1, 1), "b"), (1, None, None, "c"),
            (2, 3, dt.datetime(2024, 1, 3), "d"), (2, 3, dt.datetime(2024, 1, 2), "e")]
    df = spark.createDataFrame(rows, "k int, o int, t timestamp_ntz, v string")
    for order, desc in ((["o"], ["o"]), (["t"], ["t"]), (["o", "t"], ["t"])):
        got = dedupe_first(df, ["k"], order, descending=desc)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Partial" in plan[plan.rindex("Exchange"):] and "WindowGroupLimit" in plan[plan.rindex("Exchange"):]
        ob = [F.col(c).desc_nulls_last() if c in desc else F.col(c).asc_nulls_first() for c in order] + \
             [F.col(c).asc_nulls_first() for c in df.columns if c not in order and c != "k"]
        ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*ob))).where("rn = 1").drop("rn")
        assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in ref.collect())


def test_relationships_check_counts_orphans(spark):
    child = spark.createDataFrame([(1,), (2,), (9,), (None,)], "pid int")
    parent = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    rep = [tuple(r) for r in Q.relationships(child, "pid", parent, "id").collect()]
    assert rep == [("relationships", "pid", 1)]
    assert Q.relationships(child.where("pid < 3"), "pid", parent, "id").first()["violations"] == 0
