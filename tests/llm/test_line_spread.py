import corpus_pipeline
from tools.oracle import compare, duckdb_connection

from tripmart.llm import line_spread as L

from conftest import SF_SMALL

LONG = "a line that many sites share"


def docs(spark):
    rows = [(i, f"own line of document {i}\n{LONG}\nshort", f"s{i}", "x") for i in range(1, 13)]
    rows += [(20, f"  {LONG}  \n\nanother own line of twenty", "s1", "x"), (21, LONG, "s2", "x"), (21, LONG, "s2", "x"),
             (None, f"{LONG}\nline without an id here", "s3", None), (30, None, "s4", "x"), (31, "", None, "x"),
             (32, "only three sites have this line", "s1", "x"), (33, "only three sites have this line", "s2", "x"),
             (34, "only three sites have this line", None, "x"), (35, f"x\n{LONG}", None, "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, gone string")


def test_boilerplate_goes_from_all_but_the_holder(spark):
    df = docs(spark)
    out = L.mark(df)
    assert out.columns == ["doc_id", "text", "source", "gone", "n_lines", "n_removed", "clean_text"]
    got = {(r.doc_id, r.source): r for r in out.collect()}
    assert out.count() == df.count()
    assert got[1, "s1"].n_removed == 0 and LONG in got[1, "s1"].clean_text
    assert got[2, "s2"].clean_text == "own line of document 2\nshort" and got[2, "s2"].n_lines == 3
    assert got[20, "s1"].clean_text == "\nanother own line of twenty"
    assert got[None, "s3"].clean_text == "line without an id here"
    assert got[30, "s4"].clean_text is None and got[30, "s4"].n_lines == 0
    assert got[31, None].clean_text == "" and got[32, "s1"].n_removed == 0
    assert got[35, None].clean_text == "x"
    kept = L.clean(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 21 not in ids and 30 in ids and 31 in ids and len(ids) == df.count() - 2
    assert L.mark(df.limit(0)).count() == 0


def test_counts_near_the_threshold_are_exact(spark):
    rows = [(100 * n + i, f"this line stands on {n} sites", f"site{i}") for n in range(5, 17) for i in range(n)]
    rows += [(5000 + i, "this line stands on 9 sites", "site0") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    lines = L.line_rows(df, "doc_id", "text", "source", 16)
    assert L.boilerplate(lines).count() == 7                      # 10 to 16 sites
    assert L.boilerplate(lines, min_sites=200).count() == 0
    hll = L.boilerplate(lines, min_sites=10, band=1.0001)          # the sketch alone decides all but ties
    assert hll.count() == 7


def test_query_equals_sql(spark):
    r = compare(spark, SF_SMALL, "op3", L.query, L.SQL, duckdb_connection(SF_SMALL))
    assert r["ok"], r


def test_pipeline_keeps_a_long_passage_once(spark):
    rows = []
    for n in (1, 2, 3, 9):
        passage = " ".join(f"word{i}of{n}" for i in range(50))
        few = " ".join(f"word{i}of{n}" for i in range(49))
        rows += [(100 * n + i, f"own line {n} {i}\n{passage}\n{few}", f"site{i}") for i in range(n)]
    rows += [(950 + i, f"own line {i}\n" + " ".join(["null"] * 50), None) for i in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    before = {r.doc_id: r.text.split("\n") for r in df.collect()}
    got = {r.doc_id: r.text.split("\n") for r in corpus_pipeline.drop_boilerplate(spark, df, "").collect()}
    assert len(got) == len(rows)
    for i, lines in before.items():
        holder = i >= 900 and i > 949 or i % 100 == 0
        assert got[i] == (lines if holder else [lines[0], lines[2]])
    assert L.mark(df).where("n_removed > 0").count() == 0           # op3 alone: 10 sites
