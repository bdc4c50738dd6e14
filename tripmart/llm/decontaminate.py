r"""Benchmark decontamination by a prefix-filtered, position-bound set join.

DataFrame functions only.  A window is ``WINDOW`` consecutive words of a
benchmark item (an item of fewer words is one window).  Containment of a whole
window needs every one of its tokens, so the necessary prefix under any token
order is its first token; ordered by rarity in the documents that is the
rarest word.

1. Documents become word arrays once (stored, hash-free: exact words).
2. Frequencies of the benchmark's words are counted over all documents.
3. Document words meet the windows whose rarest word they are.  The offset of
   that word in the window fixes where the window would start: starts before
   the first word or ends behind the last (position and length bounds) fail,
   the rest compare the window's words with the document's there, inside the
   join, so only true occurrences are ever rows.
4. Per document the occurrences' union is measured and their items listed.

The windows are broadcast in parts of at most ``PART`` rows, whose number is
counted first: a larger benchmark takes more passes over the stored words,
never a larger broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import ascii_lower, documents, fresh, row_key, stored, without
from tripmart.sources.tables import table

WINDOW = 10
#: Windows broadcast at once, of WINDOW words each: some 40 MB.
PART = 100_000
#: What lies between words once A-Z are lowered: ASCII but digits and a-z.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text_col: str):
    """Array of a text's words; empty for a null text."""
    parts = F.split(ascii_lower(F.col(text_col)), BETWEEN)
    return F.coalesce(F.array_remove(parts, ""), F.array().cast("array<string>"))


def windows(items: DataFrame, id_col: str, text_col: str, size: int) -> tuple[DataFrame, DataFrame]:
    """Distinct windows ``(window, words)`` and ``(window, item)`` of the items.

    ``window`` is the words joined by a space: words hold none.
    """
    w = items.select(F.col(id_col).cast("string").alias("item"), words(text_col).alias("w")).where(F.size("w") > 0)
    w = w.select("item", "w", F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))).alias("at"))
    w = w.select("item", F.slice("w", F.col("at"), F.lit(size)).alias("words"))
    w = stored(w.select("item", "words", F.array_join("words", " ").alias("window")).distinct(), "windows")
    return w.select("window", "words").distinct(), w.select("window", "item")


def rarest(distinct: DataFrame, doc_words: DataFrame) -> DataFrame:
    """``(window, words, size, token, offset)``: the window's rarest word."""
    spots = distinct.select("window", "words", F.posexplode("words").alias("offset", "token"))
    vocabulary = stored(spots.select("token").distinct(), "vocabulary")
    all_words = doc_words.select(F.explode("words").alias("token"))
    if vocabulary.count() <= PART:
        all_words = all_words.join(F.broadcast(vocabulary), "token", "left_semi")
    counts = all_words.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    counted = vocabulary.join(counts, "token", "left").select("token", F.coalesce("n", F.lit(0)).alias("n"))
    order = Window.partitionBy("window").orderBy("n", "token", "offset")
    first = (spots.join(counted, "token").where("n > 0 OR offset = 0")
             .withColumn("r", F.row_number().over(order)).where("r = 1"))
    return first.where("n > 0").select("window", "words", F.size("words").alias("size"), "token", "offset")


def occurrences(doc_words: DataFrame, prefixes: DataFrame, part: int = PART) -> DataFrame:
    """``(row_key, start, size, window)`` of every window in every document; ``start`` is 0-based."""
    spots = doc_words.select("row_key", "n_words", F.col("words").alias("doc"), F.posexplode("words").alias("pos", "word"))
    n = prefixes.count()
    found = None
    passes = max(1, -(-n // part))
    for i in range(passes):
        some = prefixes.where(F.pmod(F.xxhash64("window"), F.lit(passes)) == i) if passes > 1 else prefixes
        start = F.col("pos") - F.col("offset")
        inside = (start >= 0) & (start + F.col("size") <= F.col("n_words"))
        same = F.slice("doc", F.greatest(start, F.lit(0)) + 1, F.col("size")) == F.col("words")
        hit = (spots.join(F.broadcast(some), (F.col("word") == F.col("token")) & inside & same)
               .select("row_key", start.alias("start"), "size", "window"))
        found = hit if found is None else found.union(hit)
    return found


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", size: int = WINDOW) -> DataFrame:
    """One row per document row: ``(row_key, id, n_words, n_hit, items)``.

    ``row_key`` is 128 bits of hashes of id and text; rows equal in both get equal results.
    ``items`` lists the item ids, sorted as strings; null without a hit.  A
    null text has no words; an item without words (or null) matches nothing;
    repeated items all count, a null item id is listed nowhere.  Empty tables
    give no rows (documents) or no hits (benchmark).
    """
    doc_words = stored(docs.select(row_key(F.col(id_col), F.col(text_col)).alias("row_key"),
                                   F.col(id_col).alias("id"), words(text_col).alias("words"))
                       .withColumn("n_words", F.size("words")), "words")
    distinct, of_items = windows(items, item_col, item_text, size)
    prefixes = stored(rarest(distinct, doc_words), "prefixes")
    hits = stored(occurrences(doc_words, prefixes), "occurrences")
    # union of the intervals: each adds what lies beyond all ends before it
    at = Window.partitionBy("row_key").orderBy("start")
    spans = (hits.groupBy("row_key", "start").agg(F.max(F.col("start") + F.col("size")).alias("end"))
             .withColumn("reach", F.max("end").over(at.rowsBetween(Window.unboundedPreceding, -1))))
    covered = spans.groupBy("row_key").agg(F.sum(F.greatest(
        F.lit(0), F.col("end") - F.greatest("start", F.coalesce("reach", F.lit(0))))).alias("n_hit"))
    named = (hits.select("row_key", "window").distinct().join(of_items, "window").groupBy("row_key")
             .agg(F.sort_array(F.collect_set("item")).alias("items")))
    marks = covered.join(named, "row_key", "left")
    return (doc_words.select("row_key", "id", F.col("n_words").cast("long").alias("n_words")).join(marks, "row_key", "left")
            .select("row_key", "id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), "items"))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", size: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that hold a window of the benchmark; same columns."""
    key, = fresh(docs, "row_key")
    bad = (contamination(docs, items, id_col, text_col, item_col, item_text, size).where("n_hit > 0")
           .select(F.col("row_key").alias(key)).distinct())
    keyed = docs.withColumn(key, row_key(F.col(id_col), F.col(text_col)))
    return without(keyed, key, stored(bad, "contaminated")).drop(key)


def query(spark, sf_dir):
    """op8: every document against the whole benchmark."""
    ids = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    return contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark")).select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
v AS (
  SELECT DISTINCT item_id, list_slice(w, s, s + {WINDOW - 1}) AS x
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) AS s FROM i WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT len(x) AS n FROM v),
o AS (
  SELECT doc_id, s, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS x
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)
), h AS (
  SELECT o.doc_id, o.s, o.n, v.item_id FROM o JOIN (SELECT item_id, len(x) AS n, array_to_string(x, ' ') AS x FROM v) v
  ON o.n = v.n AND o.x = v.x
), c AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM h) GROUP BY doc_id
), t AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit,
       coalesce(t.n_items, 0)::BIGINT AS n_items, sha256(coalesce(t.items, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""
