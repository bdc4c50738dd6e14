"""Runs of repeated words, found through Lyndon roots from Baier's grouping.

A run is a stretch of words that repeats with smallest period ``q`` at least
twice and that no neighbouring word extends.  Every run holds a root of length
``q`` that is the longest Lyndon word at its place, under the order of the
words or under the reversed order.  So per text:

1. Phase one of Baier's suffix sorter groups the suffixes by their longest
   Lyndon prefix (:func:`lyndon_lengths`): groups are taken from the highest
   down, the members of one leave the list of open places, and what stands
   before them takes their words over and moves to a higher group.  The length
   of a place's group is its entry in the Lyndon array; no phase two is needed.
2. Each Lyndon word is extended to both sides by longest common extensions to
   a stretch of its period; stretches of two periods are runs.

Texts are independent, so the work is one Arrow pass without a shuffle.  The
grouping runs over the parts of a text that may hold a run (:func:`segments`):
a run of ``min_len`` words repeats a stretch of half as many words at a
distance that the repeated stretch bounds, so all other words are in no run.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import documents

#: Fewest words of a run.
MIN_LEN = 12
#: Words compared at first when an extension is measured; doubles from there.
STEP = 64
#: Bytes of collapsed text after which a result batch is handed over.
FLUSH = 1 << 22
RUN = "array<struct<start:long,length:long,period:long>>"


def lyndon_lengths(words: list[int], reverse: bool = False) -> list[int]:
    """Length of the longest Lyndon word that starts at each place.

    ``reverse`` turns the order of the words around; the end of the text is
    lowest in both.  Linear but for the sort of the first groups.
    """
    n = len(words)
    after, before = list(range(1, n + 1)), list(range(-1, n))  # the open places as a linked list
    places: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        places.setdefault(w, []).append(i)
    rank = {w: g for g, w in enumerate(sorted(places, reverse=reverse))}
    group = [rank[w] for w in words]
    members = [places[w] for w in rank]
    size = [len(m) for m in members]
    lower, higher = list(range(-1, len(members) - 1)), [*range(1, len(members)), -1]
    g = len(members) - 1
    while g >= 0:
        moved: dict[tuple[int, int], list[int]] = {}
        for i in members[g]:
            j = before[i]
            if group[i] != g or (j >= 0 and group[j] == g):
                continue  # has moved on, or follows a member that stands for it
            e, times = after[i], 1
            while e < n and group[e] == g:
                e, times = after[e], times + 1
            before[e] = j
            if j >= 0:
                after[j] = e
                if size[group[j]] > 1:
                    moved.setdefault((group[j], times), []).append(j)
        last, at = -1, -1
        for old, times in sorted(moved):
            who = moved[old, times]
            at = at if old == last else old
            last, new, up = old, len(members), higher[at]
            members.append(who)
            size.append(len(who))
            size[old] -= len(who)
            lower.append(at)
            higher.append(up)
            higher[at] = new
            if up >= 0:
                lower[up] = new
            for j in who:
                group[j] = new
            at = new
        g = lower[g]
    return [e - i for i, e in enumerate(after)]


def segments(ids: np.ndarray, min_len: int = MIN_LEN) -> list[tuple[int, int]]:
    """Stretches ``(from, to)`` outside of which no run of ``min_len`` words lies.

    A run of period q matches itself q words on over max(q, min_len - q) words
    or more, so half of ``min_len`` words recur at each of those places, within
    q words.  Places where they do not, or where the next copy is farther than
    the block of such places is long, are in no run.
    """
    gram = max(1, -(-min_len // 2))
    n = len(ids) - gram + 1
    if n < 2:
        return []
    h = np.zeros(n, np.uint64)
    for k in range(gram):  # wraps; a collision only keeps more words
        h = h * np.uint64(0x9E3779B97F4A7C15) + ids[k:k + n].astype(np.uint64)
        h ^= h >> np.uint64(29)
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    if not same.any():
        return []
    gap = np.zeros(n, np.int64)
    gap[order[:-1][same]] = (order[1:] - order[:-1])[same]
    keep = gap > 0
    for _ in range(3):
        edge = np.flatnonzero(np.diff(np.r_[False, keep, False]))
        size = np.zeros(n, np.int64)
        first, past = edge[::2], edge[1::2]
        size[keep] = np.repeat(past - first, past - first)
        keep &= gap <= size + gram - 1
    edge = np.flatnonzero(np.diff(np.r_[False, keep, False]))
    out: list[tuple[int, int]] = []
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        to = min(len(ids), b - 1 + (b - a) + 2 * gram - 1)
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(to, out[-1][1]))
        else:
            out.append((a, to))
    return out


def _ahead(ids: np.ndarray, i: int, j: int) -> int:
    """Equal words from ``i`` and ``j`` (``i < j``) on."""
    k, step, n = 0, STEP, len(ids)
    while j + k < n:
        part = min(step, n - j - k)
        differ = ids[i + k:i + k + part] != ids[j + k:j + k + part]
        first = int(differ.argmax())
        if differ[first]:
            return k + first
        k, step = k + part, 2 * step
    return k


def find_runs(ids: np.ndarray, min_len: int = MIN_LEN) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of at least ``min_len`` words, sorted.

    ``ids`` are numbers of words, equal where the words are.
    """
    found: set[tuple[int, int, int]] = set()
    back = ids[::-1]
    n = len(ids)
    for a, b in segments(ids, min_len):
        part = ids[a:b].tolist()
        roots = np.unique(np.concatenate([np.array(lyndon_lengths(part, turned)) * (b - a) + np.arange(b - a) for turned in (False, True)]))
        period, i = roots // (b - a), a + roots % (b - a)
        j = i + period
        grows = (ids[np.minimum(j, n - 1)] == ids[i]) & (j < n) | (i > 0) & (ids[i - 1] == ids[j - 1])
        stretch = (0, 0, 0)
        for p, s in zip(period[grows].tolist(), i[grows].tolist(), strict=True):
            if stretch[0] == p and s >= stretch[1] and s + p <= stretch[2]:
                continue  # another turn of the root extended last
            start = s - _ahead(back, n - s - p, n - s)
            stretch = (p, start, s + p + _ahead(ids, s, s + p))
            if stretch[2] - start >= max(min_len, 2 * p):
                found.add((start, stretch[2] - start, p))
    return sorted(found)


def word_ids(words: list[bytes]) -> np.ndarray:
    """Words as numbers in order of first appearance."""
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(number.__getitem__, words), np.int64, len(words))


def collapse(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words left, one blank between, when each run keeps its first period."""
    if found:
        change = np.zeros(len(words) + 1, np.int64)
        for start, length, period in found:
            change[start + period] += 1
            change[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
    return b" ".join(words)


def _scan(batches: Iterator[pa.RecordBatch], min_len: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        begin, counts, spans, left, held = 0, [], [], [], 0
        for row in range(len(texts)):
            words = (texts[row].as_py() or b"").split()
            found = find_runs(word_ids(words), min_len) if len(words) >= max(2, min_len) else []
            counts.append(len(words))
            spans.append([{"start": s, "length": k, "period": q} for s, k, q in found])
            left.append(collapse(words, found))
            held += len(left[-1])
            if held > FLUSH or row == len(texts) - 1:
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(begin, row + 1 - begin).cast(schema.field(0).type), pa.array(counts, pa.int64()),
                    pa.array(spans, schema.field(2).type), pa.array(left, pa.binary()).cast(pa.string())], schema=schema)
                begin, counts, spans, left, held = row + 1, [], [], [], 0


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_len: int = MIN_LEN) -> DataFrame:
    """One row per input row: ``(id, n_words, runs, collapsed)``.

    Words are what ASCII white space (tab to carriage return, blank) parts.
    ``runs`` holds every run of at least ``min_len`` words as (start, length,
    period), numbered from word 0 and sorted by start, then period;
    ``collapsed`` the text in which of each run only the first period stays,
    words joined by one blank.  A null text counts as empty: no words, no runs,
    an empty ``collapsed``.  Equal rows give equal rows, a null id stays null
    and an empty table gives an empty result; other columns are not looked at.
    A text is one row's work: its memory follows the longest text, whatever
    its repetition.
    """
    span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    schema = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("runs", span), ("collapsed", pa.string())])
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(partial(_scan, min_len=min_len, schema=schema), f"id long, n_words long, runs {RUN}, collapsed string")


def planted(text: Column, doc_id: Column) -> Column:
    """The contract's text: in one document of ten (by crc32 of its id; a null
    id counts as '') the words from a place on repeat with a period."""
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    return F.when((h % 10 == 0) & F.regexp_like(text, F.lit(r"[^\x20\x09-\x0D]")), repeated(words, F.floor(h / 10))).otherwise(text)


def repeated(words: Column, g: Column) -> Column:
    """``words`` joined, from place a = g % n on repeated with period 1 + floor((n - a) / (3 + g % 8))."""
    shaped = F.struct(words.alias("w"), F.size(words).cast("long").alias("n"), g.cast("long").alias("g"))

    def turn(x: Column) -> Column:
        a = x["g"] % x["n"]
        p = F.lit(1) + F.floor((x["n"] - a) / (F.lit(3) + x["g"] % 8))
        y = F.struct(x["w"].alias("w"), a.alias("a"), p.cast("long").alias("p"))
        return F.transform(F.array(y), lambda y: F.array_join(F.transform(
            y["w"], lambda w, i: F.when(i < y["a"], w).otherwise(F.get(y["w"], (y["a"] + (i - y["a"]) % y["p"]).cast("int")))), " "))[0]

    return F.transform(F.array(shaped), turn)[0]


def query(spark, sf_dir):
    """op11: runs of every document's words, and digests of what they leave."""
    docs = documents(spark, sf_dir)
    found = runs(docs.select("doc_id", planted(F.col("text"), F.col("doc_id")).alias("text")))
    # greatest length, then smallest start, then smallest period
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("q"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return (found.withColumn("best", best)
            .select(F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"),
                    (-F.col("best.s")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.q")).alias("period"),
                    F.floor(F.col("best.length") * 1000 / -F.col("best.q")).cast("long").alias("exponent_milli"),
                    F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))
