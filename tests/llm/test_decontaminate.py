import hashlib
import re

from tools.oracle import compare, duckdb_connection

from tripmart.llm import decontaminate as D

from conftest import SF_SMALL


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, size=10):
    out = []
    wins = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            wins.setdefault(tuple(w[i:i + size]), set()).add(item)
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for win, of in wins.items():
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i:i + len(win)]) == win:
                    hit |= set(range(i, i + len(win)))
                    found |= {str(x) for x in of if x is not None}
        out.append((doc, len(w), len(hit), sorted(found) or None))
    return sorted(out, key=str)


ITEMS = [(1, "the quick brown fox jumps over the lazy dog and runs away home"), (2, "short item"), (3, "..."), (4, None), (5, ""),
         (6, "a a a a a a a a a a a a"), (10, "Éa été l'hiver À la mer"), (None, "no id here at all"), (2, "short item"), (11, "word")]
DOCS = [(1, "He said THE QUICK, brown fox jumps over the lazy dog and runs -- away home today"), (2, "a short item and a SHORT\x00ITEM"),
        (3, None), (4, ""), (5, "a " * 25), (6, "éa été l hiver À la mer"), (7, "Éa été l hiver À la mer"), (8, "no id here at all"),
        (9, "the quick brown fox jumps over the lazy dog"), (None, "short item"), (2, "a short item and a SHORT\x00ITEM"),
        (12, "filler text " * 4000 + "short item"), (13, "clean text of no concern")]


def test_equals_brute_force_with_edges(spark):
    docs = spark.createDataFrame([(i, t, "k") for i, t in DOCS], "doc_id long, text string, row_key string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted(((r.id, r.n_words, r.n_hit, r["items"]) for r in D.contamination(docs, items).collect()), key=str)
    # a hit of an item without an id counts, but lists nothing
    want = brute(DOCS, ITEMS)
    assert [(a, b, c, d or None) for a, b, c, d in got] == want
    kept = D.decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _, n, _ in want if n == 0)
    assert D.decontaminate(docs, items.limit(0)).count() == len(DOCS)
    assert D.contamination(docs.limit(0), items).count() == 0


def test_parts_of_the_windows_do_not_change_the_result(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = docs.select("doc_id", D.words("text").alias("words")).selectExpr("doc_id AS row_key", "words", "size(words) AS n_words")
    prefixes = D.rarest(D.windows(items, "item_id", "text", 10)[0], rows)
    one, many = (sorted(map(tuple, D.occurrences(rows, prefixes, part).collect()), key=str) for part in (1000, 3))
    assert one == many and one


def test_query_equals_sql(spark):
    r = compare(spark, SF_SMALL, "op8", D.query, D.SQL, duckdb_connection(SF_SMALL))
    assert r["ok"], r
    none = D.query(spark, SF_SMALL).where("n_items = 0").first()
    assert none.items_sha256 == hashlib.sha256(b"").hexdigest() and not none.contaminated
