"""Variable-capacity best-fit packing of documents into training sequences.

A shard of some ``SHARD`` items, chosen by the hash of the row, is packed at a
time, so tasks are independent, their memory is bounded, and a shard wastes at
most one part-filled bin.  In a shard items go largest first into the open bin
with the least room that holds them; if none does, a bin is opened at the
permitted length of least cost.  Several ways to price an opening are tried
(:data:`POLICIES`), each plan's bins are downsized to the cheapest permitted
length that holds their contents, and the cheapest plan is taken: the lengths
are optimised jointly, not each alone.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator, Sequence
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import documents

CAPACITIES = (512, 1024, 2048, 4096, 8192)
SHARD = 8192
#: Length at which attention costs a sequence as much again as its tokens.
ATTENTION = 32768
PACKED = "id long, row_key long, piece int, n_tokens int, bin_id long, bin_capacity int, bin_offset int"


def cost(capacity: int) -> float:
    """Of a sequence of that many slots: linear work plus attention's square."""
    return capacity * (1 + capacity / ATTENTION)


def _unit_cost(size: int, left: int, capacities: Sequence[int], price: Callable) -> int:
    """Least cost per token that can still come in."""
    return min((c for c in capacities if c >= size), key=lambda c: (price(c) / min(c, left), c))


def _whole_cost(size: int, left: int, capacities: Sequence[int], price: Callable) -> int:
    """Least cost of the bin itself."""
    return min((c for c in capacities if c >= size), key=lambda c: (price(c), c))


def _roomy(size: int, left: int, capacities: Sequence[int], price: Callable) -> int:
    """The largest; what stays empty is given back by downsizing."""
    return max(capacities)


POLICIES = (_unit_cost, _whole_cost, _roomy)


def pack(sizes: Sequence[int], capacities: Sequence[int] = CAPACITIES, price: Callable = cost) -> tuple[list[int], list[int]]:
    """(bin of each item, capacity of each bin); ``sizes`` descend, none exceeds the largest capacity."""
    best = None
    for policy in POLICIES:
        room: list[tuple[int, int]] = []  # (free slots, bin), ascending
        used: list[int] = []
        bins, left = [], sum(sizes)
        for size in sizes:
            at = bisect_left(room, (size, -1))
            if at < len(room):
                free, b = room.pop(at)
            else:
                free, b = policy(size, max(left, 1), capacities, price), len(used)
                used.append(0)
            bins.append(b)
            used[b] += size
            left -= size
            if free > size:
                insort(room, (free - size, b))
        final = [_whole_cost(u, u, capacities, price) for u in used]
        total = sum(map(price, final))
        if best is None or total < best[0]:
            best = total, bins, final
    return best[1], best[2]


def _windows(batches: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """Rows of one shard, ``size`` at most, in their order."""
    rest = None
    for pdf in batches:
        pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        while len(pdf):
            shard = pdf["shard"].to_numpy()
            same = int((shard == shard[0]).argmin()) or len(shard)
            if same == len(shard) and same < size:
                break
            yield pdf.iloc[:min(same, size)]
            pdf = pdf.iloc[min(same, size):].reset_index(drop=True)
        rest = pdf
    if rest is not None and len(rest):
        yield rest


def _pack_shards(batches: Iterator[pd.DataFrame], capacities: Sequence[int], size: int, price: Callable) -> Iterator[pd.DataFrame]:
    shard, made = None, 0
    for pdf in _windows(batches, size):
        if (s := int(pdf["shard"].iloc[0])) != shard:
            shard, made = s, 0
        n = pdf["n_tokens"].to_numpy()
        bins, final = pack(n.tolist(), capacities, price)
        out = pdf[["id", "row_key", "piece", "n_tokens"]].copy()
        b = pd.Series(bins, index=out.index)
        out["bin_id"] = (shard << 24) + made + b
        out["bin_capacity"] = b.map(dict(enumerate(final)))
        out["bin_offset"] = out.groupby(b)["n_tokens"].cumsum() - out["n_tokens"]
        made += len(final)
        yield out


def pack_documents(docs: DataFrame, length: Column, id_col: str = "doc_id", text_col: str = "text",
                   capacities: Sequence[int] = CAPACITIES, shard: int = SHARD, price: Callable = cost) -> DataFrame:
    """One row per piece of a document: its bin, the bin's length and its offset there.

    ``length`` gives each row's slots.  A row longer than the largest capacity
    is cut into pieces of that capacity and a rest, so every slot is packed;
    a length that is null or not positive takes one slot.  Repeated rows and
    null ids are packed like any other, each on its own.  An empty table gives
    an empty result.  Bin ids are unique; equal inputs give equal bins however
    they are partitioned, up to an exchange of rows equal in id and text.
    """
    top = max(capacities)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("row_key"),
                       F.greatest(F.coalesce(length.cast("long"), F.lit(1)), F.lit(1)).alias("n"))
    pieces = (rows.select("id", "row_key", "n", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / top).cast("int"))).alias("piece"))
              .select("id", "row_key", "piece", F.least(F.lit(top), F.col("n") - F.col("piece").cast("long") * top).cast("int").alias("n_tokens")))
    shards = max(1, -(-docs.count() // shard))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("row_key", "piece"), F.lit(shards)))
    ordered = (dealt.repartition("shard").sortWithinPartitions("shard", F.desc("n_tokens"), "id", "row_key", "piece"))
    return ordered.mapInPandas(partial(_pack_shards, capacities=tuple(sorted(capacities)), size=shard, price=price), PACKED)


def word_length(text_col: str = "text") -> Column:
    """Slots of a text: its white-space separated words and one end mark."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)) + 1


def query(spark, sf_dir):
    """op1: every document packed into sequences of the permitted lengths."""
    return pack_documents(documents(spark, sf_dir), word_length()).select(
        F.col("id").alias("doc_id"), "piece", "n_tokens", "bin_id", "bin_capacity", "bin_offset")
