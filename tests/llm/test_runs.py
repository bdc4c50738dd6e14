import hashlib
import random
import zlib

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from tripmart.llm import runs as R
from tripmart.llm.common import documents

from conftest import SF_SMALL


def brute_runs(w, least=12):
    n, out = len(w), []
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if w[i] != w[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            length = j + p - i
            smaller = any(all(w[k] == w[k + q] for k in range(i, j + p - q)) for q in range(1, p))
            if length >= max(least, 2 * p) and not smaller:
                out.append((i, length, p))
            i = j
    return sorted(out)


def brute_lyndon(w, reverse):
    s = [-x for x in w] if reverse else list(w)
    out = []
    for i in range(len(s)):
        best = 1
        for e in range(i + 1, len(s) + 1):
            u = s[i:e]
            if all(u < u[k:] for k in range(1, len(u))):
                best = e - i
        out.append(best)
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=26), st.booleans())
def test_lyndon_array(w, reverse):
    assert R.lyndon_lengths(w, reverse) == brute_lyndon(w, reverse)


def test_runs_equal_brute_force():
    rng = random.Random(5)
    for case in range(400):
        n, letters = rng.randrange(0, 90), rng.choice([1, 2, 2, 3, 8])
        w = [rng.randrange(letters) for _ in range(n)]
        if n > 8 and case % 2:
            a, p = rng.randrange(n), rng.randrange(1, 9)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            w += [9] + w[:rng.randrange(n)]
        for least in (2, 5, 12):
            assert R.find_runs(np.array(w, np.int64), least) == brute_runs(w, least), (w, least)


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def test_long_repetitive_texts():
    assert R.find_runs(np.zeros(200_000, np.int64)) == [(0, 200_000, 1)]
    assert R.find_runs(np.arange(200_000) % 1000) == [(0, 200_000, 1000)]
    assert R.find_runs(np.array(fibonacci(600))) == brute_runs(fibonacci(600))
    n = 60_000
    assert R.find_runs(np.arange(n) // 12) == [(12 * i, 12, 1) for i in range(n // 12)]
    once = np.arange(50_000)
    assert R.find_runs(np.r_[once, once]) == [(0, 100_000, 50_000)]
    assert R.find_runs(np.r_[once, [-1], once]) == []


def expected(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def digests(words, found):
    gone = set()
    for s, k, q in found:
        gone.update(range(s + q, s + k))
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    text = "".join(f"{s},{k},{q}\n" for s, k, q in found)
    return (len(found), *best, best[1] * 1000 // best[2] if found else None, hashlib.sha256(text.encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


def stretches(ids, least=12):
    """All runs by comparing the text with itself at every distance."""
    out = []
    for p in range(1, len(ids) // 2 + 1):
        edge = np.flatnonzero(np.diff(np.r_[False, ids[p:] == ids[:-p], False]))
        out += [(int(a), int(b - a) + p, p) for a, b in zip(edge[::2], edge[1::2]) if b - a + p >= max(least, 2 * p)]
    # a stretch of a multiple of a run's period is no run of its own
    return sorted(r for r in out if not any(s <= r[0] and r[0] + r[1] <= s + k and q < r[2] and r[2] % q == 0 for s, k, q in out))


def test_query_equals_comparison_at_every_distance(spark):
    docs = documents(spark, SF_SMALL)
    got = {r.doc_id: tuple(r)[1:] for r in R.query(spark, SF_SMALL).collect()}
    assert len(got) == docs.count()
    some = 0
    for r in docs.collect():
        words = expected(r.doc_id, r.text)
        found = stretches(R.word_ids(words)) if words else []
        some += bool(found)
        assert got[r.doc_id] == digests(words, found), r.doc_id
    assert some >= 15


def test_nulls_empty_and_clashing_columns(spark, tmp_dir):
    turn = "x y z " * 6
    rows = [(1, None, "a"), (2, "", "b"), (3, " \t\n\x0b\x0c\r ", "c"), (None, turn, "d"), (None, turn, "d"), (5, turn + "   é", None), (6, "w " * 11, "e"), (7, "w " * 12, "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, RUNS string").withColumn("id", R.F.lit(1)).withColumn("collapsed", R.F.lit(2))
    out = sorted((r.id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in R.runs(df).collect())
    assert out == [(0, 18, [(0, 18, 3)], "x y z")] * 2 + [
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (5, 20, [(0, 18, 3)], "x y z    é"),
        (6, 11, [], " ".join(["w"] * 11)), (7, 12, [(0, 12, 1)], "w")]
    assert R.runs(df.limit(0)).count() == 0
    df.write.parquet(f"{tmp_dir}/documents.parquet")
    got = [tuple(r) for r in R.query(spark, tmp_dir).collect()]
    want = [(r[0], *digests(w, stretches(R.word_ids(w)) if w else [])) for r in rows for w in [expected(r[0], r[1])]]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_batches_are_handed_over_in_parts(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(R, "FLUSH", 2)
    span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    schema = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("runs", span), ("collapsed", pa.string())])
    batch = pa.RecordBatch.from_pandas(pd.DataFrame({"id": [1, 2, 3], "text": ["a b", "c " * 40, "d e f g h i j"]}))
    parts = [p.to_pylist() for p in R._scan(iter([batch]), 12, schema)]
    assert [[r["id"] for r in p] for p in parts] == [[1], [2, 3]] and parts[1][0]["runs"] == [{"start": 0, "length": 40, "period": 1}]
