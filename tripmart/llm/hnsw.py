"""Embedding near-duplicates over hierarchical navigable small-world graphs.

1. Equal vectors of a label collapse to one representative with a weight.
2. A label's representatives are dealt by hash to shards of about ``SHARD``;
   a task builds the layered graph of one shard (stored).
3. For every pair of shards of a label one task lets each side's vectors query
   the other side's graph, so every vector queries every shard.  A beam that
   comes back full of links is widened; the true nearest vectors of a sample of
   the queries are audited and the first beam is widened until it brings them.  Beams that would grow to a good part of the shard
   are replaced by an exact scan, so widening always ends.
4. Links are verified by cosine in double precision.  A task returns link
   counts and spanning links, never all pairs.
5. Spanning links are united by :mod:`tripmart.llm.components`.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import stored
from tripmart.llm.components import components
from tripmart.llm.simhash import unite
from tripmart.sources.tables import table

SHARD = 4096
#: Neighbours of a node on the upper layers; twice as many on the ground.
M = 12
#: Beam while building, and the first beam of a query.
BUILD_BEAM, BEAM = 48, 32
#: An audit must find this part of the nearest nodes of so many queries.
RECALL, NEAREST, AUDITED = 0.97, 10, 64
#: Below this part of the threshold's distance float32 sums may err.
SLACK = 1e-4
#: Queries that step together, and nodes each expands per step.
BATCH, EXPAND = 256, 4
GRAPH = "label string, dim int, shard int, shards int, node long, weight long, vec array<double>, links array<array<int>>"


class Graph:
    """Layered neighbour tables over unit vectors (float32 rows)."""

    def __init__(self, vecs: np.ndarray, layers: list[np.ndarray], level: np.ndarray):
        self.vecs, self.layers, self.level = vecs, layers, level

    def beam(self, layer: int, q: np.ndarray, entry: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, similarities) of the best ``width`` nodes found per query, -1 where fewer."""
        n, b = len(self.vecs), len(q)
        links = self.layers[layer]
        rows = np.arange(b)
        seen = np.zeros((b, n + 1), bool)  # the last column takes the padding
        seen[:, n] = True
        ids = np.full((b, width), -1)
        sims = np.full((b, width), -2.0, np.float32)
        fresh = np.zeros((b, width), bool)
        new = entry
        while True:
            new = np.where(new < 0, n, new)
            new = np.where(seen[rows[:, None], new], n, new)
            new.sort(axis=1)  # a node may come from several neighbours at once
            new[:, 1:][new[:, 1:] == new[:, :-1]] = n
            seen[rows[:, None], new] = True
            got = np.einsum("bkd,bd->bk", self.vecs[np.minimum(new, n - 1)], q)
            got[new == n] = -2.0
            all_ids = np.concatenate([ids, np.where(new == n, -1, new)], axis=1)
            all_sims = np.concatenate([sims, got], axis=1)
            all_fresh = np.concatenate([fresh, new < n], axis=1)
            top = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
            ids, sims, fresh = (np.take_along_axis(x, top, 1) for x in (all_ids, all_sims, all_fresh))
            if not fresh.any():
                return ids, sims
            k = min(EXPAND, width)
            best = np.argpartition(np.where(fresh, -sims, 3.0), k - 1, axis=1)[:, :k]
            chosen = np.take_along_axis(ids, best, 1)
            chosen[~np.take_along_axis(fresh, best, 1)] = -1
            np.put_along_axis(fresh, best, False, 1)
            new = np.where(chosen[:, :, None] < 0, -1, links[chosen]).reshape(b, -1)

    def search(self, q: np.ndarray, width: int, down_to: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Beam at layer ``down_to`` after the descent from the top layer."""
        top = len(self.layers) - 1
        entry = np.broadcast_to(np.flatnonzero(self.level == top)[:8], (len(q), min(8, int((self.level == top).sum()))))
        for layer in range(top, down_to, -1):
            entry, _ = self.beam(layer, q, entry, 8)
        return self.beam(down_to, q, entry, width)


def _spread(vecs: np.ndarray, near: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Of each row's candidates, nearest first, those nearer to the row than to
    any taken before; free places go to the nearest left out."""
    order = np.argsort(-sims, axis=1, kind="stable")
    near, sims = np.take_along_axis(near, order, 1), np.take_along_axis(sims, order, 1)
    v = vecs[np.maximum(near, 0)]
    between = np.einsum("bcd,bed->bce", v, v)
    taken = np.zeros(near.shape, bool)
    for c in range(near.shape[1]):
        closest = np.where(taken, between[:, c, :], -2.0).max(1)
        taken[:, c] = (near[:, c] >= 0) & (sims[:, c] > closest) & (taken.sum(1) < most)
    # taken first, then by nearness
    rank = np.argsort(np.where(near < 0, 2, np.where(taken, 0, 1)), axis=1, kind="stable")[:, :most]
    out = np.full((len(near), most), -1)
    out[:, :rank.shape[1]] = np.take_along_axis(near, rank, 1)
    return out


def build(vecs: np.ndarray, order: np.ndarray, m: int = M, width: int = BUILD_BEAM) -> Graph:
    """Graph of unit vectors; ``order`` (any integers) decides the layers.

    Vectors enter in batches that double up to ``BATCH``; members of a batch
    see the graph before it and each other.
    """
    n = len(vecs)
    u = ((order.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)).astype(float) / 2**53
    level = np.minimum((-np.log(np.maximum(u, 1e-12)) / np.log(m)).astype(int), 4)
    sequence = np.argsort(-level, kind="stable")  # the top layers first: every layer has an entry
    level[sequence[0]] = top = level.max()
    layers = [np.full((n, 2 * m if i == 0 else m), -1) for i in range(top + 1)]
    graph = Graph(vecs, layers, level)
    done = 0
    while done < n:
        batch = sequence[done:done + min(BATCH, max(1, done))]
        q = vecs[batch]
        for layer in range(top, -1, -1):
            mine = np.flatnonzero(level[batch] >= layer)
            if not len(mine):
                continue
            near = np.full((len(mine), 0), -1)
            if done:
                near, _ = graph.search(q[mine], width, layer)
            among = np.argsort(-(q[mine] @ q[mine].T), axis=1, kind="stable")[:, :m + 1]
            near = np.concatenate([near, np.where(among == np.arange(len(mine))[:, None], -1, batch[mine][among])], axis=1)
            sims = np.einsum("bkd,bd->bk", vecs[np.maximum(near, 0)], q[mine])
            sims[near < 0] = -2.0
            links = layers[layer]
            most = links.shape[1]
            links[batch[mine]] = _spread(vecs, near, sims, most)
            # the way back: a neighbour takes the newcomer, and chooses anew when full
            a, b = np.repeat(batch[mine], most), links[batch[mine]].reshape(-1)
            a, b = a[b >= 0], b[b >= 0]
            by = np.argsort(b, kind="stable")
            a, b = a[by], b[by]
            who, first, count = np.unique(b, return_index=True, return_counts=True)
            wide = np.full((len(who), most + int(count.max(initial=0))), -1)
            wide[:, :most] = links[who]
            wide[np.repeat(np.arange(len(who)), count), most + np.arange(len(a)) - np.repeat(first, count)] = a
            wide.sort(axis=1)
            wide[:, 1:][wide[:, 1:] == wide[:, :-1]] = -1
            for at in range(0, len(who), BATCH):
                w = wide[at:at + BATCH]
                w = -np.sort(-w, axis=1)[:, :max(most, int((w >= 0).sum(1).max(initial=0)))]
                s = np.einsum("bkd,bd->bk", vecs[np.maximum(w, 0)], vecs[who[at:at + BATCH]])
                s[w < 0] = -2.0
                links[who[at:at + BATCH]] = _spread(vecs, w, s, most)
        done += len(batch)
    return graph


def exact(q: np.ndarray, vecs: np.ndarray, floor: float) -> np.ndarray:
    """Which vectors reach ``floor``, per query."""
    return np.concatenate([q[i:i + BATCH] @ vecs.T >= floor for i in range(0, len(q), BATCH)]) if len(q) else np.zeros((0, len(vecs)), bool)


def audited_beam(graph: Graph, q: np.ndarray, same: bool) -> int:
    """Least beam whose audit passes: of the true nearest nodes of a sample of
    the queries (never the query itself) it brings RECALL.

    Nearest nodes are there whether or not any is a link, so every pair of
    shards gives evidence."""
    n = len(graph.vecs)
    some = np.unique(np.linspace(0, len(q) - 1, min(AUDITED, len(q))).astype(int))
    sims = q[some] @ graph.vecs.T
    if same:
        sims[np.arange(len(some)), some] = -2.0
    k = min(NEAREST, n - same)
    if k < 1:
        return BEAM
    nearest = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    width = BEAM
    while 4 * width < n:
        ids, _ = graph.search(q[some], width)
        if sum(len(np.intersect1d(a, b)) for a, b in zip(nearest, ids, strict=True)) >= RECALL * nearest.size:
            break
        width *= 2
    return width


def neighbours(graph: Graph, q: np.ndarray, threshold: float, same: bool = False) -> np.ndarray:
    """(queries x nodes) candidates with similarity ``threshold`` or slightly
    less; ``same``: query i is node i."""
    n, floor = len(graph.vecs), threshold - SLACK
    out = np.zeros((len(q), n), bool)
    todo, width = np.arange(len(q)), audited_beam(graph, q, same)
    while len(todo):
        if 4 * width >= n:
            out[todo] = exact(q[todo], graph.vecs, floor)
            break
        full = []
        for at in range(0, len(todo), BATCH):
            some = todo[at:at + BATCH]
            ids, sims = graph.search(q[some], width)
            row, col = np.nonzero((sims >= floor) & (ids >= 0))
            out[some[row], ids[row, col]] = True
            full.append(some[sims.min(1) >= floor])
        todo, width = np.concatenate(full), 4 * width
    return out


def _unit(rows) -> np.ndarray:
    v = np.stack([np.asarray(x, np.float64) for x in rows])
    v = v / np.abs(v).max(1, keepdims=True)  # extreme magnitudes stay finite when squared
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("node", ignore_index=True)
    graph = build(_unit(pdf["vec"]).astype(np.float32), pdf["node"].to_numpy())
    pdf["links"] = [[[int(x) for x in layer[i] if x >= 0] for layer in graph.layers[:graph.level[i] + 1]] for i in range(len(pdf))]
    return pdf


def _restore(pdf: pd.DataFrame) -> tuple[Graph, np.ndarray]:
    unit = _unit(pdf["vec"])
    level = np.array([len(x) - 1 for x in pdf["links"]])
    layers = [np.full((len(pdf), 2 * M if i == 0 else M), -1) for i in range(level.max() + 1)]
    for i, per in enumerate(pdf["links"]):
        for layer, near in enumerate(per):
            layers[layer][i, :len(near)] = near
    return Graph(unit.astype(np.float32), layers, level), unit


def _verify(found: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    row, col = np.nonzero(found)
    for at in range(0, len(row), 1 << 16):
        r, c = row[at:at + (1 << 16)], col[at:at + (1 << 16)]
        found[r, c] = np.einsum("pd,pd->p", a[r], b[c]) >= threshold
    return found


def _links(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Counts ``(a, null, n)`` and spanning links ``(a, b, 0)`` of one pair of shards."""
    i, j = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
    sides = [pdf[pdf["shard"] == s].sort_values("node", ignore_index=True) for s in ((i,) if i == j else (i, j))]
    if any(not len(s) for s in sides):
        return pd.DataFrame({"a": [], "b": [], "n": []})
    graphs = [_restore(s) for s in sides]
    (ga, ua), (gb, ub) = graphs[0], graphs[-1]
    found = neighbours(gb, ga.vecs, threshold, i == j)
    if i == j:
        found |= found.T
        np.fill_diagonal(found, False)
    else:
        found |= neighbours(ga, gb.vecs, threshold).T
    found = _verify(found, ua, ub, threshold)
    nodes = np.concatenate([s["node"].to_numpy() for s in sides])
    wa, wb = sides[0]["weight"].to_numpy(), sides[-1]["weight"].to_numpy()
    n = found @ wb if i == j else np.r_[found @ wb, wa @ found]
    label = np.arange(len(nodes))
    shift = 0 if i == j else len(sides[0])
    for at in range(0, len(found), BATCH):
        row, col = np.nonzero(found[at:at + BATCH])
        unite(label, row + at, col + shift)
    linked, moved = np.flatnonzero(n), np.flatnonzero(label != np.arange(len(label)))
    return pd.DataFrame({
        "a": np.r_[nodes[linked], nodes[moved]], "b": pd.array([None] * len(linked) + nodes[label[moved]].tolist(), "Int64"),
        "n": np.r_[n[linked], np.zeros(len(moved), int)]})


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    threshold: float = 0.93, shard: int = SHARD) -> DataFrame:
    """One row per input row: ``(id, n_links, component)``.

    Vectors are compared when their labels are equal and not null and their
    lengths agree.  A vector that is null, empty, zero or holds null or
    non-finite components links with nothing: zero links, its own component.
    Equal vectors link with each other.  Repeated ids are rows of their own; a
    null id never names a component.  An empty table gives an empty result.
    """
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                       F.col(vec_col).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & finite & F.exists("vec", lambda x: x != 0), F.lit(False))
    v = v.withColumn("node", F.when(usable, F.xxhash64("label", F.transform("vec", lambda x: x + F.lit(0.0)))))
    reps = (v.where("node IS NOT NULL").withColumn("dim", F.size("vec")).groupBy("label", "dim", "node")
            .agg(F.count(F.lit(1)).alias("weight"), F.any_value("vec").alias("vec")))
    reps = stored(reps, "vectors")
    sizes = reps.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / F.lit(shard)).cast("int").alias("shards"))
    dealt = (reps.join(sizes, ["label", "dim"])
             .select("label", "dim", F.pmod("node", F.col("shards").cast("long")).cast("int").alias("shard"), "shards", "node", "weight", "vec"))
    graphs = stored(dealt.groupBy("label", "dim", "shard").applyInPandas(_build, GRAPH), "graphs")
    paired = (graphs.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
              .withColumn("i", F.least("shard", "other")).withColumn("j", F.greatest("shard", "other")))
    out = paired.groupBy("label", "dim", "i", "j").applyInPandas(partial(_links, threshold=threshold), "a long, b long, n long")
    out = stored(out, "vector-links")
    counts = out.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    roots = components(out.where("b IS NOT NULL"))
    named = (v.select("id", "node").join(reps.select("node", "weight"), "node", "left")
             .join(counts, "node", "left").join(roots, "node", "left")
             .select("id", F.coalesce("root", "node").alias("root"),
                     F.coalesce(F.coalesce("others", F.lit(0)) + F.col("weight") - 1, F.lit(0)).alias("n_links")))
    least = named.where("root IS NOT NULL").groupBy("root").agg(F.min("id").alias("component"))
    return named.join(least, "root", "left").select("id", "n_links", F.coalesce("component", "id").alias("component"))


def query(spark, sf_dir):
    """op7: links and components of the whole embeddings table."""
    return near_duplicates(table(spark, sf_dir, "embeddings")).select(
        F.col("id").alias("vec_id"), F.col("n_links").cast("long").alias("n_links"), F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"))
