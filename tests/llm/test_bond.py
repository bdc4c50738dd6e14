import numpy as np
from pyspark.sql import functions as F
from tools.oracle import compare, duckdb_connection

from tripmart.llm import bond as B

from conftest import SF_MID

SCHEMA = "vec_id long, label int, embedding array<long>"


def brute(rows, anchors, positives=5, negatives=5, low=80):
    """rows: (id, label, vec); an anchor is given by its place."""
    rows = [(i, r[0] if r[0] is not None else 2**63 - 1, r[1], np.array(r[2], object)) for i, r in enumerate(rows)
            if r[1] is not None and r[2] is not None and None not in r[2]]
    out = []
    for a in (r for r in rows if r[0] in anchors):
        score = [(-int((a[3] * r[3]).sum()), r[1], r[0], r[2]) for r in rows if len(r[3]) == len(a[3]) and r[0] != a[0]]
        for ps, pid, _, _ in sorted(s for s in score if s[3] == a[2])[:positives]:
            fit = sorted(s for s in score if s[3] != a[2] and low * -ps <= 100 * -s[0] <= 100 * -ps)[:negatives]
            out += [(a[1], pid, k + 1, s[1], -ps, -s[0]) for k, s in enumerate(fit)]
    return sorted(tuple(None if x == 2**63 - 1 else x for x in r) for r in out)


def made(n, dims, labels, seed, spread=40):
    rng = np.random.default_rng(seed)
    centre = rng.integers(-spread, spread, (8, dims))
    vecs = centre[rng.integers(0, 8, n)] + rng.integers(-12, 13, (n, dims))
    return [(i, int(rng.integers(labels)), [int(x) for x in vecs[i]]) for i in range(n)]


def test_equals_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(B, "LEAST_GROUP", 40)
    monkeypatch.setattr(B, "GROUP", 60)
    for seed, dims, labels in ((1, 16, 3), (2, 5, 2), (3, 21, 12)):
        rows = made(400, dims, labels, seed, 40 if seed != 2 else 3)   # few dimensions: many ties
        df = spark.createDataFrame(rows, SCHEMA)
        got = sorted(tuple(r) for r in B.hard_negatives(df, F.col("vec_id") % 20 == 0).collect())
        want = brute(rows, set(range(0, 400, 20)))
        assert got == want and len(want) > 100


def test_candidates_leave_before_the_last_column():
    rows = made(4000, 64, 5, 4)
    own = B.Columns(np.arange(4000), np.arange(4000), np.array([str(r[1]) for r in rows], object), np.array([r[2] for r in rows]))
    seen = []
    scan = own.scan

    def spy(anchor, bitmap, useful):
        return scan(anchor, bitmap, lambda low, high: (seen.append(len(low)), useful(low, high))[1])

    own.scan = spy
    for a in range(0, 400, 20):
        at, score = own.best(a, str(rows[a][1]), np.array(rows[a][2]), 5)
        own.inside(str(rows[a][1]), np.array(rows[a][2]), score, 5, 80)
    looks = np.array(seen).reshape(-1, 8)
    assert (looks[:, 1:] <= looks[:, :-1]).all() and looks[::2, -1].mean() < 0.2 * looks[::2, 0].mean()


def test_nulls_ties_copies_and_lengths(spark):
    rows = [(0, 1, [3, 4]), (100, 1, [3, 4]), (100, 1, [3, 4]), (1, 1, [3, 3]), (None, 1, [2, 3]), (2, None, [3, 4]), (3, 2, None),
            (4, 2, [3, None]), (5, 2, [3, 4]), (5, 2, [3, 4]), (6, 2, [4, 3]), (None, 2, [3, 3]), (7, 2, [0, 0]), (200, 3, [-3, -4]),
            (8, 3, [3, 4]), (300, 4, [0, 0]), (9, 4, [5, 5]), (400, 5, [1, 2, 3]), (10, 5, [1, 2, 3]), (11, 6, [1, 2, 3]), (12, 6, [3, 2, 1]),
            (500, 7, []), (13, 7, []), (14, 8, []), (600, 9, [1, 1])]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("ROW", F.lit(1)).withColumn("windows", F.lit("x"))
    places = {i for i, r in enumerate(rows) if r[0] is not None and r[0] % 100 == 0}
    key = lambda r: tuple((x is None, x or 0) for x in r)
    got = sorted((tuple(r) for r in B.hard_negatives(df, F.col("vec_id") % 100 == 0).collect()), key=key)
    assert got == sorted(brute(rows, places), key=key) and len(got) > 30
    assert not any(r[0] == 600 for r in got)                        # no other row of its label
    assert B.hard_negatives(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert B.hard_negatives(df, F.lit(None).cast("boolean")).count() == 0


def test_hot_label_and_long_vectors(spark, monkeypatch):
    monkeypatch.setattr(B, "LEAST_GROUP", 100)
    rows = [(i, 0 if i % 3 else i % 5, [(i * k) % 17 - 8 for k in range(700)]) for i in range(300)]
    got = sorted(tuple(r) for r in B.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, positives=3, negatives=2, low=10).collect())
    assert got == brute(rows, set(range(0, 300, 50)), 3, 2, 10) and got


def test_query_equals_sql(spark):
    r = compare(spark, SF_MID, "op13", B.query, B.SQL, duckdb_connection(SF_MID))
    assert r["ok"], r
    assert B.query(spark, SF_MID).count() > 0
