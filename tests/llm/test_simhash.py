import random

import numpy as np
import pytest
import xxhash

from tripmart.llm import simhash as S

from conftest import SF_SMALL


def brute_fingerprint(text, n=3):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ")
             .replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, ids, radius=3):
    label = list(range(len(fps)))
    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                label[find(i)] = find(j)
    least = {}
    for i, x in enumerate(ids):
        r = find(i)
        least[r] = min(least.get(r, x), x)
    return [least[find(i)] for i in range(len(fps))]


def clouds(n, seed=1):
    """Fingerprints in Hamming clouds of very different sizes, ties included."""
    r = random.Random(seed)
    out = []
    while len(out) < n:
        c = r.getrandbits(64)
        for _ in range(r.choice([1, 1, 2, 5, 60])):
            f = c
            for _ in range(r.randrange(5)):
                f ^= 1 << r.randrange(64)
            out.append(f)
    return out[:n]


@pytest.mark.parametrize("text", [None, "", " \n\t", "One", "two words", "A b C d", "é É ß A\x0bB\x0cC", "x " * 5000, "  a b c d"])
def test_fingerprint_equals_definition(text):
    assert S.fingerprint(text) == brute_fingerprint(text)


def test_spanning_links_connect_what_is_within_the_radius():
    fps = clouds(700)
    group = np.sort(np.random.default_rng(0).integers(0, 4, len(fps)))
    for radius in (0, 1, 3, 4, 7):
        a, b = S.spanning_links(group, np.array(fps, np.uint64), radius)
        got = np.arange(len(fps))
        S.unite(got, a, b)
        for g in range(4):
            at = np.flatnonzero(group == g)
            want = brute_components([fps[i] for i in at], at.tolist(), radius)
            assert got[at].tolist() == want


@pytest.mark.parametrize("blocks,tile", [(4, 4096), (5, 16), (6, 7)])
def test_links_do_not_depend_on_blocks_or_tiles(spark, blocks, tile):
    fps = sorted(set(clouds(500, 3)))
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    at = {f: i for i, f in enumerate(signed)}
    label = np.arange(len(fps))
    rows = S.links(df, 3, blocks, tile).collect()
    S.unite(label, np.array([at[r.a] for r in rows], int), np.array([at[r.b] for r in rows], int))
    assert label.tolist() == brute_components(fps, list(range(len(fps))))
    assert len(rows) < 100 * len(fps)


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    fps = [brute_fingerprint(r.text) for r in rows]
    want = {r.doc_id: (f"{f:016x}", c) for r, f, c in zip(rows, fps, brute_components(fps, [r.doc_id for r in rows]))}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in S.query(spark, SF_SMALL).collect()}
    assert got == want


SCHEMA = "doc_id long, text string, fp long, row_key string, component int"
EDGE = [(3, "a b c d e f", 1, "x", 1), (1, "A B C  d e f", 1, "x", 1), (None, "a b c d e f", 1, None, None), (3, "a b c d e f", 1, "x", 1),
        (7, None, 2, "y", 2), (5, "", None, None, None), (6, "quite another text with words of its own", 3, "z", 3),
        (9, "lang " * 20000, 4, "w", 4)]


def test_edges_and_clashing_columns(spark):
    df = spark.createDataFrame(EDGE, SCHEMA)
    got = sorted((r.id is None, r.id or 0, r.component) for r in S.groups(df).collect())
    assert got == [(False, 1, 1), (False, 3, 1), (False, 3, 1), (False, 5, 5), (False, 6, 6), (False, 7, 5), (False, 9, 9), (True, 0, 1)]
    kept = S.deduplicate(df)
    assert kept.columns == df.columns
    assert sorted(tuple(r) for r in kept.select("doc_id", "row_key").collect()) == [(1, "x"), (5, None), (6, "z"), (9, "w")]
    assert S.groups(df.limit(0)).count() == 0 and S.deduplicate(df.limit(0)).count() == 0
    only_null = spark.createDataFrame([(None, "t")], "doc_id long, text string")
    assert [tuple(r)[2] for r in S.groups(only_null).collect()] == [None]
    assert S.deduplicate(only_null).count() == 1
