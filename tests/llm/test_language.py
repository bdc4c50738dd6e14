import itertools
import zlib

import numpy as np
from pyspark.sql import functions as F

from tripmart.llm import language as L

from conftest import SF_MID


def brute_path(scores, switch):
    best = None
    for path in itertools.product(range(scores.shape[1]), repeat=len(scores)):
        v = sum(scores[i, x] for i, x in enumerate(path)) - switch * sum(a != b for a, b in zip(path, path[1:]))
        if best is None or v > best[0] + 1e-9:
            best = v, path
    return best[0]


def value(scores, path, switch):
    return sum(scores[i, x] for i, x in enumerate(path)) - switch * sum(a != b for a, b in zip(path, path[1:]))


def test_best_path_is_optimal_and_the_shortcut_is_safe():
    rng = np.random.default_rng(5)
    for spread in (1.0, 5.0, 20.0):
        length = rng.integers(1, 7, 40)
        begin = np.cumsum(length) - length
        scores = (rng.normal(0, spread, (length.sum(), 3)) + rng.normal(0, spread, 3)).astype(np.float32)
        label = L.best_path(scores, begin, length, 6.0)
        top, sure = L.one_label(scores, begin, length, 6.0)
        for d in range(40):
            s = scores[begin[d]:begin[d] + length[d]].astype(float)
            own = label[begin[d]:begin[d] + length[d]]
            assert abs(value(s, own, 6.0) - brute_path(s, 6.0)) < 1e-3
            if sure[d]:
                assert abs(value(s, [top[d]] * length[d], 6.0) - brute_path(s, 6.0)) < 1e-3


TRAIN = [(f"the house and the garden of the {w}", "en") for w in ("king", "queen", "child", "mother", "worker")] * 8 + \
        [(f"der Hund und die Katze mit dem {w}", "de") for w in ("König", "Kind", "Vater", "Mann", "Weg")] * 8 + \
        [(f"собака и кошка в доме {w}", "ru") for w in ("короля", "отца")] * 8


def model(spark):
    return L.learn(spark.createDataFrame(TRAIN + [(None, "en"), ("x", None), ("", "en")], "text string, lang string"))


def test_spans_of_mixed_text_and_edges(spark):
    m = model(spark)
    assert m.langs == ["de", "en", "ru"]
    en, de = "the garden of the mother and the child of the king", "die Katze mit dem Vater und der Hund mit dem Mann"
    rows = [(1, f"{en}. {de}", 1), (2, None, 1), (3, "", 1), (4, "1234 -- !!", 1), (5, "дом короля", 1), (None, de, 1), (1, en, 1), (1, en, 1),
            (6, "中文字", 1), (7, f"{en} " * 3000, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    lang, share = L.main_language()
    got = L.spans(df, m).select("id", "spans", lang.alias("lang"), share.alias("share")).collect()
    assert len(got) == len(rows)
    by = {r.id: r for r in got}
    mixed = [r for r in got if r.id == 1 and len(r.spans) > 1][0]
    assert [s.lang for s in mixed.spans] == ["en", "de"]
    assert [f"{en}. {de}"[s.start:s.end] for s in mixed.spans] == [en, de]
    assert by[2].lang == by[3].lang == by[4].lang == "und" and by[4].share == 0.0 and by[4].spans == []
    assert by[5].lang == "ru" and by[None].lang == "de" and by[7].lang == "en" and by[7].share == 1.0
    assert by[6].lang in m.langs     # a script no language uses: no evidence, still letters
    assert L.spans(df.limit(0), m).count() == 0
    none = L.learn(df.select("text", F.lit(None).cast("string").alias("lang")))
    assert {r.lang for r in L.spans(df, none).select(L.main_language()[0].alias("lang")).collect()} == {"und"}


def test_held_out_accuracy_and_fold(spark):
    got = L.query(spark, SF_MID)
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 100 and sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_filter_keeps_columns_and_identified_rows(spark):
    df = spark.createDataFrame([(i, t, g, "k") for i, (t, g) in enumerate(TRAIN)] + [(900, "...", "en", "k"), (901, None, "en", "k"),
                               (None, "the house", "en", "k")], "doc_id long, text string, lang string, row_key string")
    kept = L.keep_identified(df)
    assert kept.columns == df.columns and kept.count() == len(TRAIN) + 1


def test_more_languages_than_a_part_and_than_a_byte(spark, monkeypatch):
    rows = []
    for i in range(150):
        letters = [chr(0x61 + (i + k) % 26) + chr(0x61 + (i // 26 * 5 + 3 * k) % 26) for k in range(6)]
        rows += [(1000 * j + i, " ".join("".join(letters[(k + j + m) % 6] for m in range(3)) for k in range(8)), f"l{i:03}") for j in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    m = L.learn(df)
    assert len(m.langs) == 150 and len(m.parts) == 3
    lang, _ = L.main_language()
    got = {r.id: r.lang for r in L.spans(df, m).select("id", lang.alias("lang")).collect()}
    assert sum(got[i] == g for i, _, g in rows) >= 0.9 * len(rows)
    assert L.keep_identified(df.withColumn("more", F.lit(1))).count() == len(rows)
    # parts of another size give the same labels
    monkeypatch.setattr(L, "PART", 7)
    again = L.learn(df)
    assert len(again.parts) == 22
    for i in range(0, 150, 13):
        assert np.array_equal(again.logp(i), m.parts and L.Model.logp(_whole(m), i))


def _whole(m):
    one = L.Model(m.langs)
    one.candidates = m.candidates
    flat = [x for p in m.parts for x in p]
    one.parts = [flat[i:i + L.PART] for i in range(0, len(flat), L.PART)]
    return one
