import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as P
from tripmart.llm.common import documents, drop_scratch, scratch_root, stored
from tripmart.llm.decontaminate import contamination
from tripmart.llm.packing import CAPACITIES
from tripmart.sources.tables import table

from conftest import SF_SMALL
from test_packing import check_layout
from test_simhash import brute_components, brute_fingerprint


@pytest.fixture(scope="module")
def stages(spark):
    out, docs = [], documents(spark, SF_SMALL)
    for name, stage in P.STAGES:
        docs = stored(stage(spark, docs, SF_SMALL), name)
        out.append(docs)
    return out


def test_stages_keep_the_columns_and_shrink(spark, stages):
    docs = documents(spark, SF_SMALL)
    counts = [docs.count()]
    for out in stages[:-1]:
        assert out.columns == docs.columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
        counts.append(out.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.5 * counts[0]


def test_near_copies_by_brute_force(stages):
    before = stages[1].select("doc_id", "text").collect()
    comp = brute_components([brute_fingerprint(r.text) for r in before], [r.doc_id for r in before])
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted({c for c in comp})


def test_leaks_by_the_operator(spark, stages):
    marked = contamination(stages[2], table(spark, SF_SMALL, "benchmark")).collect()
    assert sorted(r.doc_id for r in stages[3].collect()) == sorted(r.id for r in marked if r.n_hit == 0)
    assert any(r.n_hit for r in marked)


def test_packing_of_what_is_left(spark, stages):
    want = {r.doc_id: len(r.text.encode().split()) + 1 for r in stages[3].collect()}
    check_layout(stages[4].withColumnRenamed("doc_id", "id").collect(), want, CAPACITIES)


def test_run_equals_the_stages(spark, stages):
    got = P.run(spark, SF_SMALL)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stages[-1].collect()))


def test_null_and_empty_tables(spark):
    docs = documents(spark, SF_SMALL)
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "the the and", None, None, 3)], docs.schema)
    # language: only the text with letters stays; near copies: null and empty text are one group
    for (name, stage), left in zip(P.STAGES, (1, 3, 2, 3, 3), strict=True):
        assert stage(spark, odd, SF_SMALL).count() == left, name
        assert stage(spark, docs.limit(0), SF_SMALL).count() == 0, name


def test_rows_alike_and_clashing_columns(spark, stages):
    docs = documents(spark, SF_SMALL).where("doc_id < 60")
    more = {"row_key": F.lit(1), "ID": F.lit("x"), "key": F.array(F.lit(1)), "fp": F.lit(2), "row_rank": F.lit(3), "gone": F.lit(4), "n": F.lit(5),
            "least": F.lit(6), "stays": F.lit(False), "spans": F.create_map(F.lit("a"), F.lit(1)), "line": F.lit("y"), "words": F.lit(None).cast("string")}
    for name, stage in P.STAGES[:-1]:
        plain = sorted(r.doc_id for r in stage(spark, docs, SF_SMALL).collect())
        out = stage(spark, docs.withColumns(more), SF_SMALL)
        assert out.columns == [*docs.columns, *more] and sorted(r.doc_id for r in out.collect()) == plain, name
        assert all(r.row_key == 1 and r.ID == "x" and r.key == [1] and r.spans == {"a": 1} for r in out.collect()), name
        twice = sorted(r.doc_id for r in stage(spark, docs.union(docs), SF_SMALL).collect())
        assert twice == (plain if name == "simhash_near_dedup" else sorted(plain * 2)), name


def test_scratch_is_dropped(spark):
    path = scratch_root(spark)
    keep = stored(spark.range(3).select(F.col("id")), "x")
    assert keep.count() == 3
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert fs.exists(p)
    drop_scratch(spark)
    assert not fs.exists(p)


def test_entry_without_the_subpackage(monkeypatch):
    assert "pipeline" in E.queries() and len([k for k in E.queries() if k.startswith("op")]) == 13
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    assert "pipeline" not in E.queries() and not [k for k in E.queries() if k.startswith("op")] and E.oracle_sql()


def test_keys_beyond_the_broadcast_bound(spark, monkeypatch):
    """Many keys to drop go by a shuffle, with the same rows left."""
    from tripmart.llm import common
    docs = documents(spark, SF_SMALL)
    docs = docs.union(docs.where("doc_id < 20"))
    stages = [s for n, s in P.STAGES if n in ("line_dedup", "simhash_near_dedup", "decontamination")]
    few = [sorted(map(tuple, s(spark, docs, SF_SMALL).collect())) for s in stages]
    monkeypatch.setattr(common, "FEW", 0)
    assert [sorted(map(tuple, s(spark, docs, SF_SMALL).collect())) for s in stages] == few and len(few[1]) <= docs.count() - 20
