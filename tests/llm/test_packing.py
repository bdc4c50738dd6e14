from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmart.llm import packing as P

from conftest import SF_SMALL


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_pack_is_valid_and_no_dearer_than_one_capacity(sizes):
    sizes = sorted(sizes, reverse=True)
    caps = (8, 16, 64)
    bins, final = P.pack(sizes, caps)
    used = defaultdict(int)
    for b, n in zip(bins, sizes):
        used[b] += n
    assert sorted(used) == list(range(len(final)))
    for b, c in enumerate(final):
        assert used[b] <= c and c in caps
        assert c == min(x for x in caps if x >= used[b])           # downsized to its contents
    _, single = P.pack(sizes, (64,))
    assert sum(map(P.cost, final)) <= sum(map(P.cost, single)) + 1e-9


def check_layout(rows, lengths, caps):
    """Every slot of every row lies in exactly one place of one bin."""
    bins, total = defaultdict(list), defaultdict(int)
    for r in rows:
        bins[r.bin_id].append(r)
        total[r.id] += r.n_tokens
    for of in bins.values():
        of.sort(key=lambda r: r.bin_offset)
        at = 0
        for r in of:
            assert r.bin_offset == at
            at += r.n_tokens
        assert len({r.bin_capacity for r in of}) == 1 and at <= of[0].bin_capacity
        assert of[0].bin_capacity == min(c for c in caps if c >= at)
    assert dict(total) == lengths


def test_packing_of_a_table_with_edges(spark):
    lengths = {1: 5, 2: 100, 3: 1000, 4: 1, 5: 1, 6: 64, 7: 65}
    rows = [(i, "t", n if i != 4 else None, "x") for i, n in lengths.items()] + [(None, None, -3, "y")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, n int, bin_id string")
    got = P.pack_documents(df, F.col("n"), capacities=(16, 64)).collect()
    check_layout(got, lengths | {None: 3}, (16, 64))
    assert max(r.piece for r in got if r.id == 3) == 15
    assert P.pack_documents(df.limit(0), F.col("n")).count() == 0
    # shards and windows of a few rows, and one row that fills a shard by repetition
    many = spark.createDataFrame([(i % 50 if i % 3 else 7, "same", 1 + i % 40) for i in range(3000)], "doc_id long, text string, n int")
    want = {r.doc_id: r.s for r in many.groupBy("doc_id").agg(F.sum("n").alias("s")).collect()}
    check_layout(P.pack_documents(many, F.col("n"), capacities=(16, 64), shard=100).collect(), want, (16, 64))


def test_query_packs_every_word(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = {r.doc_id: len((r.text or "").encode().split()) + 1 for r in docs.collect()}
    got = [r for r in P.query(spark, SF_SMALL).withColumnRenamed("doc_id", "id").collect()]
    check_layout(got, want, P.CAPACITIES)
    filled = sum(want.values()) / sum({r.bin_id: r.bin_capacity for r in got}.values())
    assert filled > 0.9


def optimum(sizes, caps, price):
    """Least cost over all ways to part the items into bins."""
    n = len(sizes)
    total = [sum(s for i, s in enumerate(sizes) if m >> i & 1) for m in range(1 << n)]
    bin_cost = [min((price(c) for c in caps if c >= t), default=float("inf")) for t in total]
    best = [0.0] + [float("inf")] * ((1 << n) - 1)
    for m in range(1, 1 << n):
        low, part = m & -m, m
        while part:
            if part & low:  # the bin that holds the first item
                best[m] = min(best[m], bin_cost[part] + best[m ^ part])
            part = (part - 1) & m
    return best[-1]


def test_cost_against_the_optimum():
    import random
    rng, ratio = random.Random(6), []
    for caps, price in (((8, 16, 64), P.cost), ((10, 15, 40), lambda c: c + 3.0), ((4, 8, 16, 32), lambda c: c ** 1.3)):
        for _ in range(60):
            sizes = sorted((rng.randint(1, max(caps)) if rng.random() < .3 else rng.randint(1, min(caps)) for _ in range(rng.randint(1, 9))), reverse=True)
            _, final = P.pack(sizes, caps, price)
            least = optimum(sizes, caps, price)
            ratio.append(sum(map(price, final)) / least)
            assert ratio[-1] > 1 - 1e-9
    assert max(ratio) < 1.35 and sum(ratio) / len(ratio) < 1.04 and sum(r < 1 + 1e-9 for r in ratio) > 0.6 * len(ratio)


def best_fit(sizes, caps, price, choose):
    """Another best fit, over all open bins in turn."""
    open_, out, left = [], [], sum(sizes)
    for s in sizes:
        fits = [b for b in open_ if b[0] - b[1] >= s]
        if fits:
            b = min(fits, key=lambda b: (b[0] - b[1], b[2]))
        else:
            b = [choose(s, max(left, 1), caps, price), 0, len(open_)]
            open_.append(b)
        b[1] += s
        left -= s
        out.append(b[2])
    return out, [min((price(c), c) for c in caps if c >= b[1])[1] for b in open_]


def test_equals_a_plain_best_fit():
    import random
    rng, caps = random.Random(9), (8, 16, 64)
    for _ in range(200):
        sizes = sorted((rng.randint(1, 64) for _ in range(rng.randint(0, 50))), reverse=True)
        plans = [best_fit(sizes, caps, P.cost, policy) for policy in P.POLICIES]
        least = min(sum(map(P.cost, final)) for _, final in plans)
        assert abs(sum(map(P.cost, P.pack(sizes, caps)[1])) - least) < 1e-9
