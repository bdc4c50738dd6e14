import numpy as np

from tripmart.llm import hnsw as H

from conftest import SF_MID


def brute(rows, threshold=0.93):
    """(id, links, component) by all pairs in double precision."""
    ids = [r[0] for r in rows]
    ok = []
    for _, v, label in rows:
        a = None if v is None or label is None or not len(v) or any(x is None for x in v) else np.array(v, np.float64)
        ok.append(a if a is not None and np.isfinite(a).all() and a.any() else None)
    n = len(rows)
    adj = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(i):
            a, b = ok[i], ok[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b):
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                adj[i, j] = adj[j, i] = a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold
    label = np.arange(n)
    H.unite(label, *np.nonzero(adj))
    out = []
    for i in range(n):
        mine = [ids[j] for j in range(n) if label[j] == label[i] and ids[j] is not None]
        out.append((ids[i], int(adj[i].sum()), min(mine) if mine else None))
    return out


def clustered(n, seed=0, dim=24):
    """Clusters from pairs to hundreds, far apart and chained, with loners."""
    rng = np.random.default_rng(seed)
    out = []
    while len(out) < n:
        c = rng.normal(size=dim)
        for _ in range(int(rng.choice([1, 1, 2, 4, 30, 300]))):
            out.append(c + rng.normal(size=dim) * rng.choice([0.02, 0.15, 0.28]))
    return np.array(out[:n])


def test_graph_finds_nearly_all_links():
    v = clustered(1500)
    v = v / np.linalg.norm(v, axis=1, keepdims=True)
    f = v.astype(np.float32)
    g = H.build(f, np.arange(len(f)))
    assert all((layer < len(f)).all() for layer in g.layers)
    found = H.neighbours(g, f, 0.93)
    truth = H.exact(f, f, 0.93 - H.SLACK)
    assert not (found & ~truth).any()
    assert (found & truth).sum() >= 0.99 * truth.sum()
    # the beam alone, without widening: a working index, not a scan
    ids, _ = g.search(f, H.BEAM)
    best = np.argsort(-(f @ f.T), axis=1)[:, :5]
    assert np.mean([len(set(a) & set(b)) / 5 for a, b in zip(ids.tolist(), best.tolist())]) > 0.9


def test_small_shards_equal_brute_force(spark):
    v = clustered(260, 3)
    rows = [(i, v[i].tolist(), i % 2) for i in range(len(v))]
    rows += [(1000, v[0].tolist(), 0), (1001, (v[0] * 2).tolist(), 0), (1002, v[0].tolist(), None), (1003, None, 0), (1004, [0.0] * 24, 0),
             (1005, [float("nan")] * 24, 0), (1006, [None] + [1.0] * 23, 0), (1007, [float("inf")] + [1.0] * 23, 0), (1008, [1.0, 2.0], 0),
             (1009, [], 0), (0, v[0].tolist(), 0), (None, v[2].tolist(), 0), (1010, (v[0] * 1e200).tolist(), 0), (1011, [-0.0, 1.0], 0), (1012, [0.0, 1.0], 0)]
    df = spark.createDataFrame([(*r, 5) for r in rows], "vec_id long, embedding array<double>, label int, n_links int")
    want = sorted(brute(rows), key=str)
    for shard in (4096, 40):
        got = sorted((tuple(r) for r in H.near_duplicates(df, shard=shard).collect()), key=str)
        assert got == want
    assert H.near_duplicates(df.limit(0)).count() == 0
    assert {r.n_links for r in H.near_duplicates(df.where("vec_id >= 1002 and vec_id <= 1007")).collect()} == {0}


def planted(n, links, seed=0, dim=32):
    """Unit vectors in loose topics, and partners of ``links`` of them at a cosine of 0.93 to 0.99."""
    rng = np.random.default_rng(seed)
    topics = rng.normal(size=(40, dim))
    v = topics[rng.integers(0, 40, n - links)] * 0.6 + rng.normal(size=(n - links, dim))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    a = v[:links]
    side = rng.normal(size=a.shape)
    side -= (side * a).sum(1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cos = rng.uniform(0.931, 0.99, (links, 1))
    return np.concatenate([v, cos * a + np.sqrt(1 - cos**2) * side])[rng.permutation(n)]


def test_recall_through_the_graphs_of_four_shards(monkeypatch):
    v = planted(8192, 1400).astype(np.float32)
    shards = [v[i::4] for i in range(4)]
    graphs = [H.build(s, np.arange(len(s))) for s in shards]
    asked = scanned = links = found = 0
    exact = H.exact

    def spy(q, vecs, floor):
        nonlocal scanned
        scanned += len(q)
        return exact(q, vecs, floor)

    monkeypatch.setattr(H, "exact", spy)
    beams = set()
    for i in range(4):
        for j in range(4):
            got = H.neighbours(graphs[j], shards[i], 0.93, i == j)
            truth = exact(shards[i], shards[j], 0.93)
            if i == j:
                np.fill_diagonal(got, False)
                np.fill_diagonal(truth, False)
            asked, links, found = asked + len(got), links + truth.sum(), found + (got & truth).sum()
            beams.add(H.audited_beam(graphs[j], shards[i], i == j))
    assert links > 2 * 1000 and scanned == 0                        # every query went through a graph
    assert found >= 0.95 * links


def test_an_audit_can_fail():
    """A graph that lost its links does not pass, though no query has a link."""
    rng = np.random.default_rng(1)
    v = rng.normal(size=(3000, 16)).astype(np.float32)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    good = H.build(v, np.arange(3000))
    beam = H.audited_beam(good, v, True)
    assert 4 * beam < 3000
    poor = H.Graph(v, [np.where(np.arange(x.shape[1]) < 2, x, -1) for x in good.layers], good.level)
    assert H.audited_beam(poor, v, True) > beam


def test_query_recall(spark, tmp_dir):
    """The given vectors have no link; with copies turned a little they have, in shards of a label."""
    import math

    from pyspark.sql import functions as F
    e = spark.read.parquet(f"{SF_MID}/embeddings.parquet")
    turned = F.transform("embedding", lambda x, i: (x + F.when(i % 7 == 0, 0.12 * (F.col("vec_id") % 10) / 10).otherwise(0.0)).cast("float"))
    both = e.union(e.where("vec_id % 3 = 0").select((F.col("vec_id") + 100_000).alias("vec_id"), turned.alias("embedding"), "label"))
    both.write.parquet(f"{tmp_dir}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding), r.label) for r in both.collect()]
    want = {i: (n, c) for i, n, c in brute(rows)}
    got = {r.vec_id: (r.n_links, r.component_id) for r in H.query(spark, tmp_dir).collect()}
    assert sorted(got) == sorted(want) and sum(n for n, _ in want.values()) > 100
    assert math.isclose(sum(n for n, _ in got.values()), sum(n for n, _ in want.values()), rel_tol=0.01)
    assert sum(got[i] == want[i] for i in want) >= 0.99 * len(want)
