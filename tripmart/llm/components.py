"""Connected components by alternating large-star / small-star passes.

Each pass is joins and minimum aggregations over the edge table (partial
aggregates before the shuffle), written to the shared scratch folder; nothing
but an edge count and a checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import stored


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node with an edge to another node.

    ``root`` is the smallest node reachable.  Null ends, self loops and
    repeated edges are ignored; an empty edge table gives an empty result.
    """
    clean = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    cur = stored(clean.distinct(), "edges")
    sig = _signature(cur)
    while sig[0]:
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low2, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        nxt = stored(moved.union(low2.select("u", F.col("m").alias("v"))).distinct(), "edges")
        new = _signature(nxt)
        cur, done, sig = nxt, new == sig, new
        if done:
            break
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
