"""Exact duplicates over an index of live digests: cuckoo filters in shards.

A digest (SHA-256 of the normalised text) belongs to one shard.  A shard is a
cuckoo filter: buckets of four 16-bit tags, each key with two buckets of which
one follows from the other and the tag.  Every tag has its content beside it:
the whole digest, the number of live rows and the row that stays.

* A tag that is absent from both buckets proves a new digest; a tag that is
  there is a hit only if the digest stored with it is equal.
* A key that finds both buckets full pushes others to their second bucket;
  when that does not end, the shard doubles and is filled anew from the
  stored keys.
* Deleting a row lowers its digest's count and frees the slot at zero.

The index is a Parquet table, one row per occupied slot, written whole as a
new generation by each change: a lost executor or driver leaves the one before.
Rows are merged per Arrow batch before they are shuffled, so a digest that a
third of all rows share sends one row per batch.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import LAST_ID, documents, stored

#: Rows a shard is dealt on average.
SHARD = 4096
#: Slots of a bucket, buckets of an empty shard, pushes before a shard doubles.
SLOTS, BUCKETS, PUSHES = 4, 16, 200
#: Digests with more than one row in HOT are at most HOT.
HOT = 4096
#: White space that is no part of the compared text (fixed value of the contract).
BLANKS = " \t\n\x0b\f\r"

ROW = "key binary, n long, size long, id long, row long"
ENTRY = f"shards int, shard int, buckets int, slot int, {ROW}"


class Shard:
    """Cuckoo filter with the content of its slots.

    ``content[e]`` is ``[key, rows, size, id, row]``: the digest, its live rows
    and of these the one that stays (most characters, then smallest id, then
    smallest row number; no such row known: size -1).
    """

    def __init__(self, buckets: int = BUCKETS):
        self.content: list[list | None] = []
        self.free: list[int] = []
        self.live = 0
        self._empty(buckets)

    def _empty(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.tags = array("H", bytes(2 * SLOTS * buckets))
        self.held = array("l", [-1]) * (SLOTS * buckets)

    def places(self, key: bytes) -> tuple[int, int, int]:
        """(tag, first bucket, second bucket)."""
        tag = 1 + int.from_bytes(key[:2], "little") % 0xFFFF
        one = int.from_bytes(key[2:10], "little") & self.mask
        return tag, one, self.other(one, tag)

    def other(self, bucket: int, tag: int) -> int:
        return bucket ^ (tag * 0x5BD1E995 >> 4 & self.mask)

    def find(self, key: bytes) -> int:
        """Slot of ``key``, -1 if it is not live."""
        tag, *buckets = self.places(key)
        for b in buckets:
            for slot in range(SLOTS * b, SLOTS * b + SLOTS):
                if self.tags[slot] == tag and self.content[self.held[slot]][0] == key:
                    return slot
        return -1

    def _put(self, tag: int, bucket: int, entry: int) -> bool:
        for slot in range(SLOTS * bucket, SLOTS * bucket + SLOTS):
            if not self.tags[slot]:
                self.tags[slot], self.held[slot] = tag, entry
                return True
        return False

    def _place(self, entry: int) -> bool:
        """Finds ``entry`` a slot; False if the pushes do not end."""
        tag, one, two = self.places(self.content[entry][0])
        if self._put(tag, one, entry) or self._put(tag, two, entry):
            return True
        bucket = two
        for push in range(PUSHES):
            slot = SLOTS * bucket + push % SLOTS
            tag, self.tags[slot] = self.tags[slot], tag
            entry, self.held[slot] = self.held[slot], entry
            bucket = self.other(bucket, tag)
            if self._put(tag, bucket, entry):
                return True
        return False

    def resize(self, buckets: int) -> None:
        """Fills ``buckets`` buckets (more, if they overflow) from the stored keys."""
        while True:
            self._empty(buckets)
            if all(self._place(e) for e, c in enumerate(self.content) if c):
                return
            buckets *= 2

    def add(self, key: bytes, n: int, size: int, id_: int, row: int) -> None:
        slot = self.find(key)
        if slot >= 0:
            mine = self.content[self.held[slot]]
            mine[1] += n
            if (-size, id_, row) < (-mine[2], mine[3], mine[4]):
                mine[2:] = size, id_, row
            return
        entry = self.free.pop() if self.free else len(self.content)
        self.content[entry:entry + 1] = [[key, n, size, id_, row]]
        self.live += 1
        if not self._place(entry):
            self.resize(2 * (self.mask + 1))

    def remove(self, key: bytes, n: int, row: int) -> None:
        """Takes ``n`` rows out; with the row that stays, its place falls vacant."""
        slot = self.find(key)
        if slot < 0:
            return
        mine = self.content[self.held[slot]]
        mine[1] -= n
        if mine[1] <= 0:
            self.content[self.held[slot]] = None
            self.free.append(self.held[slot])
            self.live -= 1
            self.tags[slot], self.held[slot] = 0, -1
        elif mine[4] == row:
            mine[2:] = -1, LAST_ID, LAST_ID

    def load(self, rows: Iterator[tuple], moved: bool) -> None:
        """Entries as stored; ``moved`` ones came from other shards and find new slots."""
        for buckets, slot, *entry in rows:
            if moved:
                self.add(*entry)
                continue
            if buckets != self.mask + 1:
                self._empty(buckets)
            self.tags[slot], self.held[slot] = self.places(entry[0])[0], len(self.content)
            self.content.append(entry)
            self.live += 1

    def stored(self) -> list[tuple]:
        return [(self.mask + 1, slot, *self.content[e]) for slot, e in enumerate(self.held) if e >= 0]


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per digest of a batch: rows, and the one of them that stays."""
    for pdf in batches:
        pdf = pdf.sort_values(["size", "id", "row"], ascending=[False, True, True])
        n = pdf.groupby("key", sort=False)["n"].transform("sum")
        yield pdf.assign(n=n).drop_duplicates("key")[["key", "n", "size", "id", "row"]]


_COLUMNS = [x.split()[0] for x in ROW.split(", ")]


def _change(pdf: pd.DataFrame, shards: int) -> pd.DataFrame:
    """One shard with its changes: removals first, then additions."""
    own = Shard()
    held = pdf[pdf["kind"] == 0]
    entries = zip(held["buckets"], held["slot"], *(held[c] for c in _COLUMNS), strict=True)
    own.load(([int(b), int(s), bytes(k), *map(int, x)] for b, s, k, *x in entries), bool(len(held)) and int(held["shards"].iloc[0]) != shards)
    for kind in (-1, 1):
        for k, *x in pdf.loc[pdf["kind"] == kind, _COLUMNS].itertuples(index=False):
            own.add(bytes(k), *map(int, x)) if kind > 0 else own.remove(bytes(k), int(x[0]), int(x[3]))
    out = pd.DataFrame(own.stored(), columns=["buckets", "slot", *_COLUMNS])
    return out.assign(shards=shards, shard=int(pdf["shard"].iloc[0]))[["shards", "shard", "buckets", "slot", *_COLUMNS]]


def _look_up(pdf: pd.DataFrame) -> pd.DataFrame:
    own = Shard()
    held = pdf[pdf["kind"] == 0]
    entries = zip(held["buckets"], held["slot"], *(held[c] for c in _COLUMNS), strict=True)
    own.load(([int(b), int(s), bytes(k), *map(int, x)] for b, s, k, *x in entries), False)
    asked = pdf.loc[pdf["kind"] == 1, "key"].map(bytes).drop_duplicates()
    slots = [own.find(k) for k in asked]
    return pd.DataFrame({"key": list(asked), "rows": [own.content[own.held[s]][1] if s >= 0 else 0 for s in slots]})


class CuckooIndex:
    """Live digests with their rows' number and the row that stays.

    A value: :meth:`insert` and :meth:`delete` return the index after the
    change, and the one before can still be read.  Rows are ``(key, size, id,
    row)``: the digest, the text's characters, its id (null comes last) and a
    number no other live row has.
    """

    def __init__(self, entries: DataFrame, shards: int = 0):
        self.entries, self.shards = entries, shards

    @classmethod
    def empty(cls, spark: SparkSession) -> CuckooIndex:
        return cls(spark.createDataFrame([], ENTRY))

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> CuckooIndex:
        """An index saved by ``index.entries.write.parquet(path)``."""
        entries = spark.read.schema(ENTRY).parquet(path)
        return cls(entries, entries.agg(F.max("shards")).first()[0] or 0)

    def insert(self, rows: DataFrame) -> CuckooIndex:
        """The index with ``rows``, whose digests may be live already."""
        return self._changed([(rows, 1)])

    def delete(self, rows: DataFrame, live: DataFrame) -> CuckooIndex:
        """The index without ``rows``.

        ``live`` are the rows that are left; of them those are read again whose
        digest lost the row that stays.
        """
        less = self._changed([(rows, -1)])
        vacant = less.entries.where("size < 0").select("key")
        found = live.join(F.broadcast(vacant) if vacant.limit(HOT + 1).count() <= HOT else vacant, "key", "left_semi")
        return less._changed([(found.withColumn("n", F.lit(0)), 1)])

    def rows_of(self, keys: DataFrame) -> DataFrame:
        """``(key, rows)`` for each distinct digest of ``keys``; 0 where it is not live."""
        blank = {c: F.lit(None).cast(t) for c, t in (x.split() for x in ENTRY.split(", ")) if c != "key"}
        asked = keys.select("key").where("key IS NOT NULL").distinct().withColumns(blank)
        both = self._dealt(self.entries, max(1, self.shards), 0).unionByName(self._dealt(asked, max(1, self.shards), 1))
        return both.groupBy("shard").applyInPandas(_look_up, "key binary, rows long")

    def classes(self) -> DataFrame:
        """``(key, group_size, keep_row, keep_id)`` of every live digest."""
        return self.entries.select("key", F.col("n").alias("group_size"), F.col("row").alias("keep_row"),
                                   F.when(F.col("id") != LAST_ID, F.col("id")).alias("keep_id"))

    @staticmethod
    def _dealt(rows: DataFrame, shards: int, kind: int) -> DataFrame:
        return rows.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int")).withColumn("kind", F.lit(kind))

    def _changed(self, parts: list[tuple[DataFrame, int]]) -> CuckooIndex:
        merged, count = [], self.entries.count()
        for rows, kind in parts:
            plain = rows.withColumn("n", F.col("n") if "n" in rows.columns else F.lit(1)).select(
                "key", F.col("n").cast("long").alias("n"), F.col("size").cast("long").alias("size"),
                F.coalesce(F.col("id"), F.lit(LAST_ID)).alias("id"), F.col("row").cast("long").alias("row"))
            # what is taken out is not merged: any of a digest's rows may be the one that stays
            few = stored(plain.mapInPandas(_merge, ROW) if kind > 0 else plain, "cuckoo-rows")
            merged.append((few, kind))
            count += few.count()
        shards = max(self.shards, -(-count // SHARD), 1)
        empty = {c: F.lit(-1) for c in ("shards", "buckets", "slot")}
        changes = self._dealt(self.entries, shards, 0)
        for rows, kind in merged:
            changes = changes.unionByName(self._dealt(rows.withColumns(empty), shards, kind))
        after = changes.groupBy("shard").applyInPandas(partial(_change, shards=shards), ENTRY)
        return CuckooIndex(stored(after, "cuckoo-index"), shards)


def normalised(text: Column) -> Column:
    """The text that is compared: without ASCII white space; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(key, size, id, row)`` per row of ``docs``, stored once."""
    rows = docs.select(
        F.unhex(F.sha2(normalised(F.col(text_col)), 256)).alias("key"),
        F.coalesce(F.char_length(text_col), F.lit(0)).cast("long").alias("size"),
        F.col(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"))
    return stored(rows, "digests")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``(id, keep_id, group_size, kept, key)``.

    Rows whose texts agree but for ASCII white space are a group; the row with
    the most code points stays, then the one with the smallest id.  A null text
    counts as empty, and empty texts are equal.  Rows without an id come after
    all ids (``keep_id`` is null where only such rows are in the group); of
    rows equal in id and text exactly one stays.  An empty table gives an empty
    result; other columns are not looked at.

    The groups go back to the rows by a join; the few digests that may hold
    more than one row in ``HOT`` are broadcast, so no task gets a hot group.
    """
    rows = digest_rows(docs, id_col, text_col)
    classes = CuckooIndex.empty(docs.sparkSession).insert(rows).classes()
    often = F.col("group_size") * HOT > rows.count()
    hot = F.broadcast(classes.where(often))  # at most HOT rows
    found = (rows.join(hot, "key")
             .unionByName(rows.join(hot.select("key"), "key", "left_anti").join(classes.where(~often), "key")))
    return found.select("id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "key")


def query(spark, sf_dir):
    """op12: every document with the one of its group that stays."""
    return deduplicate(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("key")).alias("text_sha256"))


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(length(text), 0) AS size,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), k AS (
  SELECT text_sha256, count(*) AS group_size, first(doc_id ORDER BY size DESC, doc_id) AS keep_id
  FROM d GROUP BY text_sha256
)
SELECT d.doc_id, k.keep_id, k.group_size, d.doc_id = k.keep_id AS kept, d.text_sha256
FROM d JOIN k USING (text_sha256)
"""
