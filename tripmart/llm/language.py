"""Language spans: script ranges, n-gram word scores, Viterbi with a switch cost.

Learning counts, over all training documents, the letter trigrams of each
language (hashed to ``BUCKETS``) and how many letters of each script the
language uses.  There may be any number of languages: the model keeps of each
only the trigrams that it has, counts come to the driver for ``PART`` languages
at a time and are broadcast in parts of as many, 26 MB each at most, and the
fewer words are scored at a time the more languages there are.

Prediction per document: words are runs of letters; the script of a word's
first letter leaves the languages that use that script as candidates; a
word's score in a language is the sum of its trigrams' log probabilities; the
best path over all words, paying ``SWITCH`` for every change of language,
labels the words, and runs of one label are the spans.  All steps are numpy
over chunks of whole documents; documents of a chunk advance word by word
together.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import documents, held_out, stored

BUCKETS = 1 << 16
#: Languages whose counts are collected, held and broadcast together.
PART = 64
#: Natural-log cost of a change of language between two words.
SWITCH = 20.0
#: Part of a language's letters from which it counts as using a script.
SCRIPT_SHARE = 0.01
#: Characters handled at a time (a longer document is a chunk of its own).
CHUNK = 1 << 19
#: Words of mixed documents that advance together.
PATH_WORDS = 1 << 19
#: Rows of an Arrow batch labelled, and handed on, at a time.
ROWS = 1024
UNKNOWN = "und"
FAR = np.float32(-1e6)

# First and last code point of the letters of common scripts
# (Unicode blocks); what lies in none of them is script 0.
SCRIPTS = (
    (0x0041, 0x024F), (0x0250, 0x02AF), (0x0370, 0x03FF), (0x0400, 0x052F), (0x0530, 0x058F), (0x0590, 0x05FF),
    (0x0600, 0x077F), (0x0900, 0x097F), (0x0980, 0x09FF), (0x0A00, 0x0A7F), (0x0A80, 0x0AFF), (0x0B80, 0x0BFF),
    (0x0C00, 0x0C7F), (0x0C80, 0x0CFF), (0x0D00, 0x0D7F), (0x0E00, 0x0E7F), (0x10A0, 0x10FF), (0x1100, 0x11FF),
    (0x1E00, 0x1EFF), (0x3040, 0x309F), (0x30A0, 0x30FF), (0x4E00, 0x9FFF), (0xAC00, 0xD7AF),
)

SPANS = "array<struct<start:int,end:int,letters:int,lang:string>>"
_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("letters", pa.int32()), ("lang", pa.string())])


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: its lower-case letter (0 for other characters), its script."""
    lower = np.zeros(sys.maxunicode + 1, np.uint32)
    for cp in range(sys.maxunicode + 1):
        if (c := chr(cp)).isalpha():
            lower[cp] = ord(low) if len(low := c.lower()) == 1 else cp
    script = np.zeros(sys.maxunicode + 1, np.uint8)
    for i, (a, b) in enumerate(SCRIPTS, 1):
        script[a:b + 1] = i
    script[0x0250:0x02B0] = script[0x1E00:0x1F00] = 1  # extensions of Latin
    return lower, script


def features(texts: list[str]) -> tuple[np.ndarray, ...]:
    """Letters of the texts: (position, bucket, script, is the word's first, document, offset of its text)."""
    lower, script = _tables()
    cps = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    low = np.concatenate([[0], lower[cps], [0]]).astype(np.uint32)
    at = np.flatnonzero(low[1:-1])
    a, b, c = low[at], low[at + 1], low[at + 2]
    h = a * np.uint32(0x9E3779B1) + b * np.uint32(0x85EBCA77) + c * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    length = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    begin = np.r_[0, np.cumsum(length)[:-1]]
    doc = np.searchsorted(begin, at, "right") - 1
    return at, h >> np.uint32(16), script[cps[at]], a == 0, doc, begin


def chunks(texts: list[str], most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` characters."""
    at = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield at, i
            at, size = i, 0
        size += len(t) + 1
    if at < len(texts):
        yield at, len(texts)


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), ROWS):
            yield batch.slice(at, ROWS)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts (lang, kind, key, n): trigrams (kind 0) and scripts (kind 1)."""
    grams: dict[str, np.ndarray] = {}
    scripts: dict[str, np.ndarray] = {}

    def counted() -> Iterator[pa.RecordBatch]:
        for kind, counts in ((0, grams), (1, scripts)):
            for lang, n in counts.items():
                key = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(key), pa.string()), pa.array(np.full(len(key), kind), pa.int32()), pa.array(key, pa.int32()),
                     pa.array(n[key], pa.int64())], ["lang", "kind", "key", "n"])
            counts.clear()

    for batch in _small(batches):
        texts, of = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist(), object)
        for a, b in chunks(texts):
            _, bucket, script, _, doc, _ = features(texts[a:b])
            for lang in dict.fromkeys(of[a:b]):
                if lang not in grams:
                    if len(grams) == PART:
                        yield from counted()
                    grams[lang], scripts[lang] = np.zeros(BUCKETS, np.int64), np.zeros(len(SCRIPTS) + 1, np.int64)
                mine = (of[a:b] == lang)[doc]
                grams[lang] += np.bincount(bucket[mine], minlength=BUCKETS)
                scripts[lang] += np.bincount(script[mine], minlength=len(SCRIPTS) + 1)
    yield from counted()


class Model:
    """``langs``; of each language the trigrams it has and their log
    probabilities (:meth:`logp`); ``candidates`` (scripts x languages)."""

    def __init__(self, langs: list[str]):
        self.langs = langs
        self.candidates = np.zeros((len(SCRIPTS) + 1, len(langs)), bool)
        self.parts: list[list[tuple]] = []
        self.shared: list = []  # the parts as broadcasts
        self._dense: dict[int, np.ndarray] = {}

    def add(self, counts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        """The next languages: (trigrams, their counts, letters by script) of each."""
        part = []
        for key, n, letters in counts:
            total = n.sum()
            self.candidates[:, PART * len(self.parts) + len(part)] = (letters >= SCRIPT_SHARE * max(total, 1)) & (letters > 0)
            scale = total + 0.5 * BUCKETS
            part.append((key.astype(np.int32), np.log((n + 0.5) / scale).astype(np.float32), np.float32(np.log(0.5 / scale))))
        self.parts.append(part)

    def logp(self, i: int) -> np.ndarray:
        """Log probability of every trigram in language ``i``."""
        row = self._dense.get(i)
        if row is None:
            part = self.shared[i // PART].value if self.shared else self.parts[i // PART]
            key, logs, rest = part[i % PART]
            row = np.full(BUCKETS, rest)
            row[key] = logs
            if len(self._dense) < PART:
                self._dense[i] = row
        return row

    def sent(self, context) -> "Model":
        """The model for tasks, its parts broadcast each for itself."""
        out = Model(self.langs)
        out.candidates, out.shared = self.candidates, [context.broadcast(p) for p in self.parts]
        return out


def learn(rows: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Model of all rows with a text and a language, whatever their languages' number."""
    rows = rows.select(F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("l")).where("t IS NOT NULL AND l IS NOT NULL")
    langs = sorted(r[0] for r in rows.select("l").distinct().collect())
    counts = stored(rows.mapInArrow(_count, "lang string, kind int, key int, n long").groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")),
                    "language-counts")
    model = Model(langs)
    for at in range(0, len(langs), PART):
        some = langs[at:at + PART]
        got = counts.where(F.col("lang").between(some[0], some[-1])).toPandas()
        by = {k: (g["key"].to_numpy(int), g["n"].to_numpy(float)) for k, g in got.groupby(["lang", "kind"])}
        none = np.zeros(0, int), np.zeros(0)
        part = []
        for lang in some:
            letters = np.zeros(len(SCRIPTS) + 1)
            key, n = by.get((lang, 1), none)
            letters[key] = n
            part.append((*by.get((lang, 0), none), letters))
        model.add(part)
    return model


def best_path(scores: np.ndarray, begin: np.ndarray, length: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Labels of the best path through each sequence of rows of ``scores``.

    Sequence d is ``scores[begin[d] : begin[d] + length[d]]``; a change of
    label costs ``switch``.  Ties stay, then take the smallest label.
    """
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    n, labels = len(scores), scores.shape[1]
    small = np.int8 if labels < 128 else np.int32
    back = np.empty((n, labels), small)
    out = np.empty(n, np.int64)
    steps = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(1, steps + 1), "right")  # sequences with more than t rows
    own = np.arange(labels, dtype=small)
    last = np.zeros(len(begin), np.int64)
    value = np.zeros((len(begin), labels), np.float64)
    for t in range(steps):
        a = active[t]
        row, v = begin[:a] + t, value[:a]
        if t:
            top = v.argmax(1)
            change = v[np.arange(a), top] - switch
            moved = v < change[:, None]
            back[row] = np.where(moved, top[:, None].astype(small), own)
            v = np.where(moved, change[:, None], v)
        v = v + scores[row]
        value[:a] = v
        over = active[t + 1] if t + 1 < steps else 0
        if over < a:
            last[over:a] = v[over:].argmax(1)
    for t in range(steps - 1, -1, -1):
        a = active[t]
        row = begin[:a] + t
        out[row] = last[:a]
        if t:
            last[:a] = back[row, last[:a]]
    return out


def one_label(scores: np.ndarray, begin: np.ndarray, length: np.ndarray, switch: float = SWITCH) -> tuple[np.ndarray, np.ndarray]:
    """(label of greatest sum, whether it alone is certainly the best path) of each non-empty sequence.

    A path through other labels gains the segments' differences to that label
    and pays at least one switch per segment.  So the constant path is best if
    no segment gains ``switch`` in any label, and the other labels' best scores
    together do not gain one either (paths that avoid the label altogether).
    """
    top = np.add.reduceat(scores, begin, axis=0, dtype=np.float64).argmax(1)
    doc = np.repeat(np.arange(len(begin)), length)
    # differences are cut below, which can only overrate a segment
    diff = np.maximum(scores - scores[np.arange(len(scores)), top[doc]][:, None], -2 * switch).astype(np.float64)
    diff[np.arange(len(scores)), top[doc]] = -2 * switch
    sure = np.add.reduceat(diff.max(1), begin) < switch
    # sequences lie so far below each other that a running minimum starts anew in each
    apart = doc * (2.0 * np.abs(diff).sum(0).max() + 1)
    for i in range(scores.shape[1]):
        after = np.cumsum(diff[:, i]) - apart
        low = np.minimum.accumulate(after - diff[:, i])
        sure &= np.maximum.reduceat(after - low, begin) < switch
    return top, sure


def word_scores(model: Model, texts: list[str]) -> tuple[np.ndarray, ...]:
    """(words x languages scores, document, start and end in its text, letters) of each word."""
    at, bucket, script, first, doc, begin = features(texts)
    start = np.flatnonzero(first)
    letters = np.diff(np.r_[start, len(at)])
    scores = np.empty((len(start), len(model.langs)), np.float32)
    if len(start):
        for i in range(len(model.langs)):
            scores[:, i] = np.add.reduceat(model.logp(i)[bucket], start)
        allowed = model.candidates[script[start]]
        none = ~allowed.any(1)
        scores[~allowed] = FAR
        scores[none] = 0
    doc_of = doc[start]
    return scores, doc_of, at[start] - begin[doc_of], at[np.r_[start[1:] - 1, len(at) - 1]] + 1 - begin[doc_of] if len(start) else start, letters


def _runs(doc, start, end, letters, label) -> tuple[np.ndarray, ...]:
    """Runs of words of one document and label as spans."""
    new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (label[1:] != label[:-1])])
    return doc[new], start[new], end[np.r_[new[1:], len(doc)] - 1], np.add.reduceat(letters, new), label[new]


def _mixed(parts: list[tuple], switch: float) -> tuple[np.ndarray, ...]:
    """Spans of the documents that need the full path; all of them advance together."""
    scores, doc, *words = (np.concatenate(x) for x in zip(*parts, strict=True))
    begin = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    length = np.diff(np.r_[begin, len(doc)])
    return _runs(doc, *words, best_path(scores, begin, length, switch))


def spans_of(model: Model, texts: list[str], switch: float = SWITCH) -> tuple[np.ndarray, ...]:
    """(document, start, end, letters, label) of each span of the texts, in their order."""
    found, rest, waiting = [tuple(np.zeros(0, np.int64) for _ in range(5))], [], 0
    fewer = max(1, -(-len(model.langs) // PART))
    for a, b in chunks(texts, CHUNK // fewer) if model.langs else ():
        scores, doc, *words = word_scores(model, texts[a:b])
        if not len(doc):
            continue
        begin = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        length = np.diff(np.r_[begin, len(doc)])
        top, sure = one_label(scores, begin, length, switch)
        done = np.repeat(sure, length)
        if sure.any():
            found.append(_runs(doc[done] + a, *(x[done] for x in words), np.repeat(top[sure], length[sure])))
        if not sure.all():
            rest.append((scores[~done], doc[~done] + a, *(x[~done] for x in words)))
            waiting += len(rest[-1][0])
        if waiting > PATH_WORDS // fewer:
            found.append(_mixed(rest, switch))
            rest, waiting = [], 0
    if rest:
        found.append(_mixed(rest, switch))
    out = [np.concatenate(x) for x in zip(*found, strict=True)]
    order = np.argsort(out[0], kind="stable")
    return tuple(x[order] for x in out)


def _label(batches: Iterator[pa.RecordBatch], model: Model, switch: float) -> Iterator[pa.RecordBatch]:
    names = pa.array(model.langs, pa.string())
    for batch in _small(batches):
        texts = [x or "" for x in batch.column(1).to_pylist()]
        doc, start, end, letters, label = spans_of(model, texts, switch)
        offsets = np.searchsorted(doc, np.arange(len(texts) + 1))
        span = pa.StructArray.from_arrays(
            [pa.array(x, pa.int32()) for x in (start, end, letters)] + [names.take(pa.array(label, pa.int32()))],
            fields=list(_SPAN))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), span)], ["id", "spans"])


def spans(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", switch: float = SWITCH) -> DataFrame:
    """``(id, spans)`` per row: each span's character range, letters and language.

    Spans are in text order and cover all words.  A null, empty or letterless
    text has none; a word in a script that no learned language uses takes its
    neighbours' language.  A model without languages labels nothing.
    """
    shared = model.sent(docs.sparkSession.sparkContext)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(partial(_label, model=shared, switch=switch), f"id {kind}, spans {SPANS}")


def main_language(spans_col: str = "spans") -> tuple:
    """(language with most letters, its part of all letters) from the spans; ties go to the first name."""
    def total(some):
        return F.aggregate(some, F.lit(0), lambda x, y: x + y["letters"])

    def better(x, y):
        return F.when((y["n"] > x["n"]) | (y["n"] == x["n"]) & (y["lang"] < x["lang"]), y).otherwise(x)

    langs = F.array_distinct(F.transform(spans_col, lambda x: x["lang"]))
    per = F.transform(langs, lambda lang: F.struct(total(F.filter(spans_col, lambda x: x["lang"] == lang)).alias("n"), lang.alias("lang")))
    best = F.aggregate(per, F.struct(F.lit(0).alias("n"), F.lit(UNKNOWN).alias("lang")), better)
    return best["lang"], F.coalesce(best["n"] / F.nullif(total(F.col(spans_col)), F.lit(0)), F.lit(0.0)).cast("double")


def training(docs: DataFrame, id_col: str = "doc_id", folds: int = 4) -> DataFrame:
    """The rows learnt from: crc32 of the id's text mod ``folds`` is not 2."""
    return docs.where(~held_out(F.col(id_col), folds))


def _identified(batches: Iterator[pa.RecordBatch], column: int, model: Model, switch: float) -> Iterator[pa.RecordBatch]:
    for batch in _small(batches):
        texts = [x or "" for x in batch.column(column).to_pylist()]
        found = np.zeros(len(texts), bool)
        found[spans_of(model, texts, switch)[0]] = True
        yield batch.filter(pa.array(found))


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    switch: float = SWITCH) -> DataFrame:
    """``docs`` without the rows in which no language is found (null or letterless text); same columns.

    Rows are labelled and dropped in one pass, without a shuffle."""
    model = learn(training(docs, id_col), text_col, lang_col).sent(docs.sparkSession.sparkContext)
    return docs.mapInArrow(partial(_identified, column=docs.columns.index(text_col), model=model, switch=switch), docs.schema)


def query(spark, sf_dir):
    """op4: language of every document, learnt from the training fold."""
    docs = documents(spark, sf_dir)
    model = learn(training(docs))
    lang, share = main_language()
    return spans(docs, model).select(F.col("id").alias("doc_id"), held_out(F.col("id"), 4).alias("held_out"),
                                     lang.alias("lang_pred"), share.alias("score"), "spans")
