"""Cross-site boilerplate lines: distinct-site spread by HyperLogLog.

DataFrame functions only.  A line is the text between line feeds with outer
spaces trimmed; its site is the document's source.

1. One codegen aggregation per line hash keeps lines whose smallest and
   largest site differ; a line of one site can never spread.
2. For those, HyperLogLog sketches of the sites are built per line hash; they
   merge map-side, so a line that a third of all rows share sends one sketch
   per task.  While these lines are few they are broadcast, and a common line's
   rows never meet in a task.
3. Lines whose estimate is far from the threshold are decided by it; the band
   around it gets an exact distinct count.
4. If asked for, lines of many words count as boilerplate from two sites on:
   that they were kept in step 1 says so already, and exactly.
5. Boilerplate lines leave every document except the holder with the smallest
   id, so no content is lost altogether; a document with nothing left goes
   (:func:`clean`), all others keep the rest of their lines in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import LAST_ID, documents, few, fresh, row_key, stored

#: Distinct sites from which a line is boilerplate.
MIN_SITES = 10
#: Characters a trimmed line needs; shorter ones recur by chance.
MIN_CHARS = 16
#: Words of a line that two sites do not share by chance.
LONG_WORDS = 50
#: log2 of the sketch's registers: standard error 3.3 %.
LG_K = 10
#: Estimates within this factor of the threshold are counted exactly; ten
#: standard errors, so that estimates outside it are safe.
BAND = 1.5
#: A line is known by two independent 64-bit hashes.
LINE = ["line", "line2"]


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def line_rows(docs: DataFrame, id_col: str, text_col: str, site_col: str, min_chars: int, long_words: int | None = None) -> DataFrame:
    """``(row_key, id, pos, line, line2, site)`` for each line long enough;
    with ``long_words`` also ``long``, whether it has so many words."""
    keyed = docs.select(
        row_key(F.col(id_col), F.col(text_col)).alias("row_key"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"),
        F.xxhash64(F.col(site_col)).alias("site"), F.col(site_col).isNotNull().alias("sited"),
        F.posexplode(_lines(F.col(text_col))).alias("pos", "text"))
    trimmed = F.trim("text")
    # as many words take twice as many characters, less one: shorter lines are not searched
    long = [] if long_words is None else [
        F.when(F.char_length(trimmed) >= 2 * long_words - 1, F.regexp_count(trimmed, F.lit(r"\S+")) >= long_words).otherwise(F.lit(False)).alias("long")]
    return (keyed.where(F.char_length(trimmed) >= min_chars)
            .select("row_key", "id", "pos", F.xxhash64(trimmed).alias("line"), F.xxhash64(F.lit(1), trimmed).alias("line2"),
                    F.when(F.col("sited"), F.col("site")).alias("site"), *long))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K, band: float = BAND) -> DataFrame:
    """``(line, line2, holder)`` of the lines on at least ``min_sites`` sites.

    Lines marked ``long`` (if :func:`line_rows` was asked to) need two sites.
    ``holder`` is the smallest document id with the line.  A null site is no
    site.
    """
    marked = "long" in lines.columns
    long = F.max("long") if marked else F.lit(False)
    spread = (lines.groupBy(*LINE).agg(F.min("site").alias("low"), F.max("site").alias("high"), F.min("id").alias("holder"), long.alias("long"))
              .where("low != high").select(*LINE, "holder", "long"))
    spread = stored(spread, "lines-spread")
    sited = lines.join(few(spread.where("NOT long").select(*LINE)), LINE, "left_semi").select(*LINE, "site")
    est = (sited.groupBy(*LINE).agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_k)).alias("sites")))
    est = stored(est, "lines-sites")
    near = est.where(F.col("sites").between(min_sites / band, min_sites * band))
    exact = (sited.join(few(near.select(*LINE)), LINE, "left_semi").distinct().where("site IS NOT NULL")
             .groupBy(*LINE).agg(F.count(F.lit(1)).alias("exact")))
    found = (est.where(F.col("sites") > min_sites * band).select(*LINE)
             .union(exact.where(F.col("exact") >= min_sites).select(*LINE)))
    short = spread.where("NOT long").join(found, LINE).select(*LINE, "holder")
    return short.union(spread.where("long").select(*LINE, "holder")) if marked else short


def mark(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
         min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS, long_words: int | None = None) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_removed`` and ``clean_text`` appended.

    A null text has no lines and stays null; a text without boilerplate stays
    as it is.  Rows without an id come after all ids when the holder is
    chosen.  Rows equal in id and text are one document: they get the same
    result.  Lines repeated inside the holder stay.  An empty table gives an
    empty result.  The three columns get a leading underscore where ``docs``
    has such names already (see :func:`clean`, which hides them).
    """
    n_lines, n_removed, text, key, gone = fresh(docs, "n_lines", "n_removed", "clean_text", "row_key", "gone")
    lines = stored(line_rows(docs, id_col, text_col, site_col, min_chars, long_words), "lines", "zstd")
    common = stored(boilerplate(lines, min_sites), "lines-common")
    drop = (lines.join(few(common), LINE).where("id != holder")
            .groupBy("row_key").agg(F.collect_set("pos").alias(gone)).withColumnRenamed("row_key", key))
    out = docs.withColumn(key, row_key(F.col(id_col), F.col(text_col))).join(stored(drop, "lines-gone"), key, "left")
    parts = _lines(F.col(text_col))
    kept = F.filter(parts, lambda _, i: ~F.array_contains(F.col(gone), i))
    return out.select(
        *[out[c] for c in docs.columns], F.coalesce(F.size(parts), F.lit(0)).cast("long").alias(n_lines),
        F.when(F.col(gone).isNull(), F.lit(0)).otherwise(F.size(gone)).cast("long").alias(n_removed),
        F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n")).alias(text))


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
          min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS, long_words: int | None = None) -> DataFrame:
    """``docs`` with boilerplate lines removed from the text, same columns.

    A document that loses lines and has only blank ones left goes.
    """
    marked = mark(docs, id_col, text_col, site_col, min_sites, min_chars, long_words)
    _, n_removed, text = marked.columns[-3:]
    left = (F.col(n_removed) == 0) | (F.trim(F.translate(F.col(text), "\n\t\r", "   ")) != "")
    return marked.where(left).select(*[F.col(text).alias(c) if c == text_col else marked[c] for c in docs.columns])


def query(spark, sf_dir):
    """op3: every document of the table with its lines counted and cleaned."""
    return mark(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_removed", F.col("clean_text").alias("text"))


SQL = f"""
WITH l AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents
), b AS (
  SELECT trim(line) AS t, min(doc_id) AS holder FROM l
  WHERE length(trim(line)) >= {MIN_CHARS} GROUP BY 1 HAVING count(DISTINCT source) >= {MIN_SITES}
), m AS (
  SELECT l.doc_id, l.line, l.pos, coalesce(b.holder <> l.doc_id, false) AS gone
  FROM l LEFT JOIN b ON trim(l.line) = b.t
), r AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text
  FROM m GROUP BY doc_id
)
SELECT d.doc_id, coalesce(r.n_lines, 0)::BIGINT AS n_lines, coalesce(r.n_removed, 0)::BIGINT AS n_removed,
       CASE WHEN r.doc_id IS NULL THEN d.text ELSE r.text END AS text
FROM documents d LEFT JOIN r ON d.doc_id = r.doc_id
"""
