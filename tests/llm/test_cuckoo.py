import hashlib
import random

from tools.oracle import compare, duckdb_connection

from tripmart.llm import cuckoo as C

from conftest import SF_MID


def key(i):
    return hashlib.sha256(str(i).encode()).digest()


def test_filter_against_a_dictionary():
    rng, shard, live = random.Random(3), C.Shard(2), {}
    grown = set()
    for step in range(6000):
        k = key(rng.randrange(900))
        if rng.random() < 0.6:
            shard.add(k, 1, 5, step, step)
            live[k] = live.get(k, 0) + 1
        elif k in live:
            shard.remove(k, 1, -5)
            live[k] -= 1
            if not live[k]:
                del live[k]
        else:
            shard.remove(k, 1, -5)
        grown.add(shard.mask + 1)
    assert len(grown) > 3 and shard.live == len(live)               # overflowed and doubled
    for i in range(900):
        slot = shard.find(key(i))
        assert (shard.content[shard.held[slot]][1] if slot >= 0 else None) == live.get(key(i))
    copy, dealt = C.Shard(), C.Shard()
    copy.load(([b, s, *x] for b, s, *x in shard.stored()), False)
    dealt.load(([b, s, *x] for b, s, *x in shard.stored()), True)
    assert copy.stored() == shard.stored()
    assert sorted(x[2:] for x in dealt.stored()) == sorted(x[2:] for x in shard.stored())


def test_hits_are_verified():
    """Digests of one tag and one bucket pair are told apart, beyond what eight slots hold."""
    shard = C.Shard(4)
    keys = [bytes([7, 7]) + (i * 4).to_bytes(8, "little") + bytes(22) for i in range(40)]
    for i, k in enumerate(keys):
        shard.add(k, i + 1, i, i, i)
    assert shard.mask > 3
    assert [shard.content[shard.held[shard.find(k)]][1] for k in keys] == list(range(1, 41))
    assert shard.find(bytes([7, 7]) + (161).to_bytes(8, "little") + bytes(22)) == -1


def rows(spark, data):
    return spark.createDataFrame([(key(k), s, i, r) for k, s, i, r in data], "key binary, size long, id long, row long")


def state(index):
    return {bytes(r.key): (r.group_size, r.keep_id) for r in index.classes().collect()}


def test_index_inserts_and_deletes(spark, monkeypatch, tmp_dir):
    monkeypatch.setattr(C, "SHARD", 50)
    first = rows(spark, [(i % 150, 10 + i % 7, i, i) for i in range(300)])
    index = C.CuckooIndex.empty(spark).insert(first)
    index.entries.write.parquet(tmp_dir + "/index")
    index = C.CuckooIndex.read(spark, tmp_dir + "/index")
    assert index.shards > 1
    more = rows(spark, [(i % 400, 12, 1000 + i, 1000 + i) for i in range(800)])
    both = index.insert(more)
    assert both.shards > index.shards                               # dealt anew
    data = [(i % 150, 10 + i % 7, i, i) for i in range(300)] + [(i % 400, 12, 1000 + i, 1000 + i) for i in range(800)]

    def brute(some):
        out = {}
        for k, s, i, _ in some:
            out.setdefault(key(k), []).append((-s, i))
        return {k: (len(v), min(v)[1]) for k, v in out.items()}

    assert state(both) == brute(data)
    rng = random.Random(1)
    gone = [x for x in data if rng.random() < 0.5]
    left = [x for x in data if x not in gone]
    less = both.delete(rows(spark, gone), rows(spark, left))
    assert state(less) == brute(left) and state(both) == brute(data)
    asked = {bytes(r.key): r.rows for r in less.rows_of(rows(spark, [(i, 0, 0, 0) for i in range(500)] * 2)).collect()}
    assert asked == {key(i): brute(left).get(key(i), (0,))[0] for i in range(500)}
    assert state(less.insert(rows(spark, gone))) == brute(data)
    assert state(less.delete(rows(spark, left), rows(spark, []))) == {}


def test_groups_nulls_ties_and_repeated_rows(spark):
    data = [(1, "a b", "x"), (2, "a  b", "x"), (3, "ab\n", "x"), (4, None, "x"), (5, "", None), (6, " \t\x0b\x0c\r\n", "x"),
            (7, "a b", "x"), (8, "A b", "x"), (9, "z", "x"), (9, "z", "x"), (None, "q", "x"), (None, "q ", "x"),
            (None, "ab   ", "x"), (10, "long " * 50_000, "x"), (11, "long" * 50_000, "x"), (12, "é", "x"), (13, "é", "x")]
    df = spark.createDataFrame(data, "doc_id long, text string, KEY string").withColumn("row", C.F.lit(1)).withColumn("n", C.F.lit(1))
    out = C.deduplicate(df)
    got = [(r.id, r.keep_id, r.group_size, r.kept) for r in out.collect()]
    assert len(got) == len(data)
    assert sorted(g for g in got if g[0] is not None and g[0] != 9) == [
        (1, None, 4, False), (2, None, 4, False), (3, None, 4, False), (4, 6, 3, False), (5, 6, 3, False), (6, 6, 3, True),
        (7, 7, 1, True), (8, 8, 1, True), (10, 10, 2, True), (11, 10, 2, False), (12, 12, 1, True), (13, 13, 1, True)]
    assert sorted(g[3] for g in got if g[0] == 9) == [False, True]
    assert sorted((g[2], g[3]) for g in got if g[0] is None) == [(2, False), (2, True), (4, True)]
    assert C.deduplicate(df.limit(0)).count() == 0


def test_hot_digests_and_the_rest_agree(spark, monkeypatch):
    data = [(i, "the hot one" if i % 3 else f"text {i // 4}") for i in range(900)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    want = sorted(C.deduplicate(df).collect())
    monkeypatch.setattr(C, "HOT", 10)
    assert sorted(C.deduplicate(df).collect()) == want
    assert len(want) == 900 and sum(r.kept for r in want) == len({t for _, t in data})


def test_query_equals_sql(spark):
    r = compare(spark, SF_MID, "op12", C.query, C.SQL, duckdb_connection(SF_MID))
    assert r["ok"], r
