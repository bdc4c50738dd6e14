"""SimHash near-duplicates with bit-sliced distance comparison.

1. A fingerprint per document (one Arrow pass; whole texts).
2. Equal fingerprints collapse to classes by a plain aggregation, so copies
   cost nothing further.
3. The 64 bits are cut into ``blocks`` parts; two fingerprints within
   ``radius`` bits agree on at least ``blocks - radius`` parts, so every choice
   of that many parts is one table of buckets (exact, no candidate is lost).
4. Buckets are compared with the bit planes stored vertically: one 64-bit word
   holds one bit of 64 fingerprints, a carry-save counter updates 64 distances
   at once, and words whose 64 lanes all exceed the radius are abandoned.
   Buckets above ``TILE`` are dealt out as pairs of tiles, so no task holds a
   bucket whole.  Only spanning links leave a task, never all pairs.
5. Links are united by :mod:`tripmart.llm.components`.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import LAST_ID, fresh, only, row_key, stored, without
from tripmart.llm.components import components

BITS = 64
#: Fingerprints of one bucket that a task compares with each other.
TILE = 4096
#: (word, query) entries compared at a time; bounds a task's memory.
ENTRIES = 1 << 15
#: Shingle hashes turned into bits at a time.
HASHES = 1 << 15
ALL = np.uint64(2**64 - 1)

_xxh = partial(xxhash.xxh64_intdigest, seed=42)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The unsigned 64-bit SimHash of one text (0 when it has no word)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(grams), HASHES):
        part = grams[at:at + HASHES]
        h = np.fromiter(map(_xxh, part), np.uint64, len(part))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(grams), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(1)), np.uint64, len(batch))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], ["id", "fp"])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = 3) -> DataFrame:
    """``(id, fp)`` per row; ``fp`` is the fingerprint as a signed long."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(partial(_fingerprints, shingle=shingle), f"id {dict(rows.dtypes)['id']}, fp long")


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the classes of ``a[i]`` and ``b[i]``; labels stay roots."""
    while len(a):
        ra, rb = label[a], label[b]
        differ = ra != rb
        a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
        if not len(a):
            return
        np.minimum.at(label, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(nxt := label[label], label):
            label[:] = nxt


def planes_of(lanes: np.ndarray) -> np.ndarray:
    """(64, words) bit planes of fingerprints laid out 64 to a word."""
    cells = lanes.reshape(-1, BITS)
    planes = np.empty((BITS, len(cells)), np.uint64)
    for p in range(BITS):
        bit = ((cells >> np.uint64(p)) & np.uint64(1)).astype(np.uint8)
        planes[p] = np.packbits(bit, axis=1, bitorder="little").view("<u8")[:, 0]
    return planes


def within(planes: np.ndarray, query: np.ndarray, word: np.ndarray, over: np.ndarray, radius: int) -> tuple:
    """Entries with a lane within ``radius`` bits of their query.

    Entry i compares ``query[i]`` with the 64 lanes of ``word[i]``; lanes set in
    ``over`` are out from the start.  The counter starts at the value that
    overflows on difference ``radius + 1``; the overflow bit is sticky.
    Returns (entry numbers, bit mask of the lanes within the radius).
    """
    size = max(1, radius.bit_length())
    preset = 2**size - 1 - radius
    counters = [np.full(len(query), ALL if preset >> c & 1 else 0, np.uint64) for c in range(size)]
    entry = np.arange(len(query))
    for p in range(BITS):
        carry = planes[p][word] ^ (np.uint64(0) - ((query >> np.uint64(p)) & np.uint64(1)))
        for c in range(size):
            counters[c], carry = counters[c] ^ carry, counters[c] & carry
        over = over | carry
        if p % 8 == 7:
            alive = over != ALL
            if not alive.all():
                entry, query, word, over = entry[alive], query[alive], word[alive], over[alive]
                counters = [x[alive] for x in counters]
            if not len(entry):
                break
    return entry, ~over


def spanning_links(group: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what lies within ``radius`` bits inside each group.

    ``group`` is sorted.  Returns positions (member, root of its class).
    """
    n = len(fp)
    label = np.arange(n)
    if n < 2:
        return label[:0], label[:0]
    start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[start, n])
    of = np.repeat(np.arange(len(start)), size)
    words = -(-size // BITS)
    first = np.r_[0, np.cumsum(words)]
    local = label - start[of]
    slot = first[of] * BITS + local
    lanes = np.zeros(first[-1] * BITS, np.uint64)
    lanes[slot] = fp
    member = np.full(first[-1] * BITS, -1)
    member[slot] = label
    planes = planes_of(lanes)
    empty = np.packbits((member < 0).reshape(-1, BITS), axis=1, bitorder="little").view("<u8")[:, 0]
    # each fingerprint meets its own word and those after it: every pair once
    entries = words[of] - local // BITS
    entries[local == size[of] - 1] = 0
    ends = np.cumsum(entries)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + ENTRIES, "right")))
        mine = np.repeat(np.arange(at, to), entries[at:to])
        if len(mine):
            offset = np.arange(len(mine)) - np.repeat(np.cumsum(entries[at:to]) - entries[at:to], entries[at:to])
            word = slot[mine] // BITS + offset
            before = np.where(offset == 0, (np.uint64(2) << (slot[mine] % BITS).astype(np.uint64)) - np.uint64(1), np.uint64(0))
            entry, mask = within(planes, fp[mine], word, empty[word] | before, radius)
            if len(entry):
                row, lane = np.nonzero(np.unpackbits(mask.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
                unite(label, mine[entry[row]], member[word[entry[row]] * BITS + lane])
        at = to
    linked = np.flatnonzero(label != np.arange(n))
    return linked, label[linked]


def _compare(batches: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    """Rows arrive sorted by (bucket, i, j); groups are compared as soon as they are whole."""
    rest = None
    keys = ["bucket", "part", "i", "j"]

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        key = pdf[keys].to_numpy()
        group = np.cumsum(np.r_[False, (key[1:] != key[:-1]).any(axis=1)])
        fp = pdf["fp"].to_numpy()
        a, b = spanning_links(group, fp.view(np.uint64), radius)
        return pd.DataFrame({"a": fp[a], "b": fp[b]})

    for pdf in batches:
        pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        if not len(pdf):
            continue
        last = (pdf[keys] == pdf[keys].iloc[-1]).all(axis=1).to_numpy()
        cut = int(np.argmax(last))
        rest = pdf.iloc[cut:].reset_index(drop=True)
        if cut:
            yield links(pdf.iloc[:cut])
    if rest is not None and len(rest):
        yield links(rest)


def _blocks(classes: int, radius: int) -> int:
    """Parts of the fingerprint: as few as keep mean buckets below 256.

    Any value gives the same links; more parts make more, finer tables.
    """
    for blocks in range(radius + 1, radius + 4):
        if classes >> (BITS * (blocks - radius) // blocks) < 256:
            break
    return blocks


def _masks(blocks: int, radius: int) -> list[int]:
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [(1 << cuts[i + 1]) - (1 << cuts[i]) for i in range(blocks)]
    signed = lambda m: m - 2**64 if m >= 2**63 else m
    return [signed(sum(c)) for c in combinations(parts, blocks - radius)]


def links(classes: DataFrame, radius: int = 3, blocks: int | None = None, tile: int = TILE) -> DataFrame:
    """Spanning links ``(a, b)`` between the distinct fingerprints of column ``fp``."""
    masks = _masks(blocks or _blocks(classes.count(), radius), radius)
    rows = (classes.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])))
            .select("fp", F.col("pos").alias("part"), F.col("col").alias("bucket")))
    # a bucket of one has no pair; the larger ones are dealt out as tile pairs
    sizes = (rows.groupBy("part", "bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
             .select("part", "bucket", F.ceil(F.col("n") / tile).cast("int").alias("tiles")))
    rows = rows.join(sizes, ["part", "bucket"]).withColumn("t", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
    rows = (rows.select("fp", "part", "bucket", "t", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("o"))
            .select("fp", "part", "bucket", F.least("t", "o").alias("i"), F.greatest("t", "o").alias("j")))
    dealt = rows.repartition("part", "bucket", "i", "j").sortWithinPartitions("part", "bucket", "i", "j")
    return dealt.mapInPandas(partial(_compare, radius=radius), "a long, b long")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
           radius: int = 3) -> DataFrame:
    """One row per input row: ``(id, fp, component)``.

    ``component`` is the smallest id whose fingerprint is reachable over links
    of at most ``radius`` differing bits.  A null or blank text has the
    fingerprint 0 and links like any other; a text of fewer than ``shingle``
    words is one shingle.  Rows with a null id take part, but never name a
    component (it is null if all its rows lack an id).  Repeated ids and rows
    each give a row.  An empty table gives an empty result.
    """
    ids = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = stored(fingerprints(ids, "id", "text", shingle), "simhash")
    classes = stored(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-classes")
    united = rooted(classes, radius)
    named = united.groupBy("root").agg(F.min("least").alias("component"))
    return rows.join(united.join(named, "root").select("fp", "component"), "fp").select("id", "fp", "component")


def rooted(classes: DataFrame, radius: int) -> DataFrame:
    """``(fp, least, root)``: distinct fingerprints with the one that names their group."""
    roots = components(links(classes.select("fp"), radius))
    return (classes.join(roots, classes["fp"] == roots["node"], "left")
            .select("fp", "least", F.coalesce("root", "fp").alias("root")))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                radius: int = 3) -> DataFrame:
    """``docs`` with one row of each group, all columns kept.

    The row with the smallest id stays (rows without an id come last; ties go
    to the smallest hash, then to the smallest remaining columns).
    """
    key, rank = fresh(docs, "row_key", "row_rank")
    keyed = docs.withColumn(key, row_key(F.col(id_col), F.col(text_col)))
    named = keyed.select(F.struct(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"), F.col(key)["a"].alias("a"),
                                  F.col(key)["b"].alias("b")).alias("id"), F.col(text_col).alias("text"))
    rows = stored(fingerprints(named, "id", "text", shingle), "simhash")
    # copies are one class each before anything is joined: a hot group sends one row per task
    classes = stored(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-classes")
    stays = rooted(classes, radius).groupBy("root").agg(F.min("least").alias("id"))
    of_id = F.struct(F.col("id.a").alias("a"), F.col("id.b").alias("b")).alias(key)
    keys = rows.groupBy(of_id).agg(F.count(F.lit(1)).alias("n"))
    keys = stored(keys.join(stays.select(of_id, F.lit(True).alias("stays")), key, "left"), "simhash-keys")
    left = without(keyed, key, keys.where("stays IS NULL").select(key))
    again = keys.where("stays AND n > 1").select(key)  # rows equal in id and text: one of them stays
    ordered = [F.col(c) for c, t in docs.dtypes if not t.startswith(("map", "variant"))]
    once = Window.partitionBy(key).orderBy(*ordered)
    repeated = only(left, key, again).withColumn(rank, F.row_number().over(once)).where(F.col(rank) == 1).drop(rank)
    return without(left, key, again).unionByName(repeated).drop(key)


def query(spark, sf_dir):
    """op10: fingerprints and components of the whole documents table."""
    from tripmart.llm.common import documents
    return groups(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"))
