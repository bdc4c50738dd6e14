"""Distinct counts that merge: one map of keys per day (or other part) and block of keys.

``COUNT(DISTINCT)`` of a date range cannot be put together from the counts of
its days.  A map of the keys can: the range's is the union of its days'.
Keys are integers (take a dense number for anything else), and a block is the
32,768 neighbouring keys that one of Spark's bitmaps holds.  A bitmap takes 4 kB
however few keys it has, so a block with fewer than ``DENSE`` of them keeps their
places instead: what is stored and shuffled grows with the keys, not with the
days times the blocks.  NULL keys count nowhere, as in SQL.

Rows are dealt out before they are aggregated, to ``spark.sql.shuffle.partitions``
tasks that are not merged again: keys compress so well that a merged partition
would hold many millions of them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A block has either ``bits`` or ``places``; the other is NULL.
BUCKET, BITS, PLACES = "bucket", "bits", "places"
#: Keys from which on a block is a bitmap: it then takes 16 bytes a key at most.
DENSE = 256
#: Tasks that the rows of one key and part are dealt to, so that a frequent key does not meet in one.
SPREAD = 8


def _dealt(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def bitmaps(df: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """``(by..., bucket, bits, places)``: the distinct keys of each combination of ``by``."""
    keys = df.where(F.col(key).isNotNull()).select(*by, F.col(key).cast("long").alias("k"), (F.spark_partition_id() % SPREAD).alias("salt"))
    once = _dealt(keys, [*by, "k", "salt"]).distinct()
    placed = once.select(*by, F.bitmap_bucket_number("k").alias(BUCKET), F.bitmap_bit_position("k").alias("place"))
    maps = _dealt(placed, [*by, BUCKET]).groupBy(*by, BUCKET).agg(F.collect_set("place").alias(PLACES), F.bitmap_construct_agg("place").alias(BITS))
    dense = F.size(PLACES) >= DENSE
    return maps.select(*by, BUCKET, F.when(dense, F.col(BITS)).alias(BITS), F.when(~dense, F.col(PLACES)).alias(PLACES))


def union_bitmaps(maps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The maps united over everything but ``by``, all of them as bitmaps."""
    places = maps.where(F.col(PLACES).isNotNull()).select(*by, BUCKET, F.explode(PLACES).alias("place"))
    sparse = _dealt(places, [*by, BUCKET]).groupBy(*by, BUCKET).agg(F.bitmap_construct_agg("place").alias(BITS))
    dense = maps.where(F.col(BITS).isNotNull()).select(*by, BUCKET, BITS)
    return sparse.unionByName(dense).groupBy(*by, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def count_distinct(maps: DataFrame, by: Sequence[str] = (), name: str = "n") -> DataFrame:
    """Exact distinct count per ``by``; without ``by`` one row, 0 for no keys."""
    n = F.coalesce(F.sum(F.bitmap_count(F.col(BITS))), F.lit(0)).cast("long").alias(name)
    return union_bitmaps(maps, by).groupBy(*by).agg(n)


def count_in_ranges(maps: DataFrame, day: str, ranges: Mapping[str, tuple[dt.date, dt.date]], name: str = "n") -> DataFrame:
    """``(range, n)``: the exact distinct count of each half-open range of days.

    A day's maps are handed to the ranges that hold it.  A range without a key
    counts 0.
    """
    spans = F.array(*[F.struct(F.lit(r).alias("range"), F.lit(a).alias("a"), F.lit(b).alias("b")) for r, (a, b) in ranges.items()])
    held = F.filter(spans, lambda s: (F.col(day) >= s["a"]) & (F.col(day) < s["b"]))
    some = maps.select(F.explode(F.transform(held, lambda s: s["range"])).alias("range"), BUCKET, BITS, PLACES)
    counted = count_distinct(some, ["range"], name)
    names = maps.sparkSession.createDataFrame([(r,) for r in ranges], "range string")
    return names.join(counted, "range", "left").select("range", F.coalesce(name, F.lit(0)).alias(name))
