"""Hard negatives by branch and bound on decomposed vectors (BOND).

Anchors are a stated set of the rows.  An anchor's positives are its best rows
of the same label; a hard negative of one is a row of another label whose score
lies in a window below the positive's.  Scores are integer inner products.

* The rows are dealt to groups, every row to one.  A task turns its group into
  columns, one per dimension, with each one's least and greatest value, and the
  anchors stream past it: all anchors meet all rows, and only the anchors are
  sent more than once.
* For an anchor the columns are read in the order of its own components, the
  largest magnitude first.  What the columns not yet read can add at least and
  at most bounds each candidate's score; candidates that can reach none of the
  windows, or not the best few, leave the bitmap.  Scores of those that are
  left after the last column are exact and the windows are resolved on them.
* A group returns at most ``positives`` rows per anchor, then ``negatives``
  rows per window; a ranking per anchor or window keeps the best of all groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import LAST_ID, stored
from tripmart.sources.tables import table

#: Rows of a group at most, and at least if there are cores to spare.
GROUP, LEAST_GROUP = 65536, 1024
#: Columns read between two looks at the bounds.
STEP = 8
#: Lowest score of a negative, as parts of a hundred of its positive's.
LOW = 80

WINDOWS = "array<struct<row:long,id:long,score:long>>"


class Columns:
    """Rows of one vector length, stored by dimension."""

    def __init__(self, row: np.ndarray, ids: np.ndarray, label: np.ndarray, vecs: np.ndarray):
        self.row, self.ids, self.label = row, ids, label
        self.dims = np.ascontiguousarray(vecs.T)
        self.least, self.most = vecs.min(0), vecs.max(0)

    def scan(self, anchor: np.ndarray, bitmap: np.ndarray, useful) -> tuple[np.ndarray, np.ndarray]:
        """(places, exact scores) of what is left of ``bitmap``.

        ``useful(low, high)`` says which candidates may still matter when their
        scores lie between ``low`` and ``high``.
        """
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = np.stack([anchor * self.least, anchor * self.most])[:, order]
        # what the columns after the first t add at least, and at most
        rest = np.c_[np.cumsum(np.sort(ends, axis=0)[:, ::-1], axis=1)[:, ::-1], [0, 0]]
        at = np.flatnonzero(bitmap)
        score = np.zeros(len(at), np.int64)
        for t in range(0, len(order), STEP):
            if not len(at):
                break
            read = order[t:t + STEP]
            columns = self.dims[read] if len(at) == len(bitmap) else self.dims[read[:, None], at]
            score += anchor[read] @ columns
            done = min(t + STEP, len(order))
            left = useful(score + rest[0, done], score + rest[1, done])
            if not left.all():
                bitmap[at[~left]] = False
                at, score = np.flatnonzero(bitmap), score[left]
        return at, score

    def ranked(self, at: np.ndarray, score: np.ndarray, most: int) -> np.ndarray:
        """Which of ``at`` come first: by score, id and row number."""
        return np.lexsort((self.row[at], self.ids[at], -score))[:most]

    def best(self, row: int, label: str, anchor: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """The first ``most`` other rows of the anchor's label."""
        def useful(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            return high >= np.partition(low, -most)[-most] if len(low) > most else np.ones(len(low), bool)

        at, score = self.scan(anchor, (self.label == label) & (self.row != row), useful)
        first = self.ranked(at, score, most)
        return at[first], score[first]

    def inside(self, label: str, anchor: np.ndarray, tops: np.ndarray, most: int, low: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each top score the first ``most`` rows of other labels from ``low`` per cent of it to it."""
        floors = -(-low * tops // 100)
        some = floors <= tops
        if not some.any():
            return [(tops[:0], tops[:0])] * len(tops)

        def useful(least: np.ndarray, greatest: np.ndarray) -> np.ndarray:
            out = np.zeros(len(least), bool)
            near = np.flatnonzero((greatest >= floors[some].min()) & (least <= tops[some].max()))
            least, greatest = least[near], greatest[near]
            for floor, top in zip(floors[some], tops[some], strict=True):
                sure = least[(least >= floor) & (greatest <= top)]
                bound = max(floor, np.partition(sure, -most)[-most]) if len(sure) >= most else floor
                out[near] |= (greatest >= bound) & (least <= top)
            return out

        at, score = self.scan(anchor, self.label != label, useful)
        result = []
        for floor, top in zip(floors, tops, strict=True):
            fit = np.flatnonzero((score >= floor) & (score <= top))
            first = fit[self.ranked(at[fit], score[fit], most)]
            result.append((at[first], score[first]))
        return result


def _gathered(parts: list[pa.RecordBatch]) -> dict[int, Columns]:
    """A group's rows as columns, by the length of the vectors."""
    t = pa.Table.from_batches(parts)
    row, ids = (t.column(c).to_numpy() for c in ("row", "id"))
    label = np.array(t.column("label").to_pylist(), object)
    vec = t.column("vec").combine_chunks()
    offsets, flat = vec.offsets.to_numpy(), vec.values.to_numpy()
    size = np.diff(offsets)
    return {int(d): Columns(row[at], ids[at], label[at], flat[offsets[at][:, None] + np.arange(d)])
            for d in np.unique(size) for at in [np.flatnonzero(size == d)]}


def _meet(batches: Iterator[pa.RecordBatch], positives: int, negatives: int, low: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Per group first its rows, then all anchors; anchors with windows look for negatives, others for positives."""
    group, rows, columns = None, [], None
    for batch in batches:
        if not len(batch):
            continue
        tag = batch.column("grp").to_numpy().astype(np.int64) * 2 + batch.column("kind").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(tag)) + 1).tolist(), len(tag)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            part = batch.slice(a, b - a)
            if tag[a] // 2 != group:
                group, rows, columns = tag[a] // 2, [], None
            if tag[a] % 2 == 0:
                rows.append(part)
                continue
            if columns is None:
                columns = _gathered(rows) if rows else {}
                rows = []
            out: list[tuple] = []
            for r in part.select(["row", "label", "vec", "windows"]).to_pylist():
                own = columns.get(len(r["vec"]))
                if own is None:
                    continue
                anchor = np.array(r["vec"], np.int64)
                if r["windows"] is None:
                    at, score = own.best(r["row"], r["label"], anchor, positives)
                    out += [(r["row"], None, int(own.row[i]), int(own.ids[i]), int(s)) for i, s in zip(at, score, strict=True)]
                    continue
                found = own.inside(r["label"], anchor, np.array([w["score"] for w in r["windows"]], np.int64), negatives, low)
                for w, (at, score) in zip(r["windows"], found, strict=True):
                    out += [(r["row"], w["row"], int(own.row[i]), int(own.ids[i]), int(s)) for i, s in zip(at, score, strict=True)]
            cells = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cells], schema=schema)


def _scan(rows: DataFrame, anchors: DataFrame, groups: int, **what) -> DataFrame:
    """``(anchor, window, row, id, score)``: what each group has to offer."""
    columns = ["grp", "kind", "row", "id", "label", "vec", "windows"]
    dealt = rows.withColumn("grp", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int")).withColumns(
        {"kind": F.lit(0), "windows": F.lit(None).cast(WINDOWS)}).select(*columns)
    sent = anchors.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn("kind", F.lit(1)).select(*columns)
    names = ["anchor", "win", "row", "id", "score"]
    schema = pa.schema([(c, pa.int64()) for c in names])
    return (dealt.unionByName(sent).repartition(groups, "grp").sortWithinPartitions("grp", "kind")
            .mapInArrow(partial(_meet, schema=schema, **what), ", ".join(f"{c} long" for c in names)))


def hard_negatives(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding",
                   positives: int = 5, negatives: int = 5, low: int = LOW) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``vec_col`` holds integers (whose inner products fit a long); ``anchor``
    says which rows are anchors.  Higher scores come first, ties by smaller id
    (null last), then by the order the rows were read in.  A row whose label or
    vector is null or whose vector holds a null takes no part; vectors of
    another length than the anchor's are not compared with it.  Rows that share
    an id are rows of their own: an anchor's copy can be its positive, the
    anchor itself can't.  Positives with an empty window give no row, as do
    anchors without positives and an empty table.  Other columns are not
    looked at.
    """
    spark = vectors.sparkSession
    rows = stored(vectors.select(
        F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"),
        F.col(label_col).cast("string").alias("label"), F.col(vec_col).cast("array<long>").alias("vec"),
        F.coalesce(anchor, F.lit(False)).alias("asks"))
        .where("label IS NOT NULL AND vec IS NOT NULL AND forall(vec, x -> x IS NOT NULL)"), "bond-rows")
    n = rows.count()
    groups = max(1, -(-n // GROUP), min(2 * spark.sparkContext.defaultParallelism, -(-n // LEAST_GROUP)))
    what = {"positives": positives, "negatives": negatives, "low": low}
    asking = rows.where("asks").drop("asks")
    rows = rows.drop("asks")

    near = _scan(rows, asking.withColumn("windows", F.lit(None).cast(WINDOWS)), groups, **what)
    order = [F.desc("score"), F.asc("id"), F.asc("row")]
    near = near.withColumn("place", F.row_number().over(Window.partitionBy("anchor").orderBy(*order))).where(F.col("place") <= positives)
    windows = stored(near.groupBy("anchor").agg(F.collect_list(F.struct("row", "id", "score")).alias("windows")), "bond-windows")
    armed = stored(asking.join(windows.withColumnRenamed("anchor", "row"), "row"), "bond-anchors")

    far = _scan(rows, armed, groups, **what)
    far = far.withColumn("rank", F.row_number().over(Window.partitionBy("anchor", "win").orderBy(*order))).where(F.col("rank") <= negatives)
    pairs = armed.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"), F.inline("windows").alias("win", "positive_id", "positive_score"))
    real = lambda c: F.when(F.col(c) != LAST_ID, F.col(c)).alias(c)
    return (far.withColumnsRenamed({"id": "negative_id", "score": "negative_score"}).join(pairs, ["anchor", "win"])
            .select(real("anchor_id"), real("positive_id"), "rank", real("negative_id"), "positive_score", "negative_score"))


def finite(vec: Column) -> Column:
    """A vector without null and non-finite components."""
    return F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


def query(spark, sf_dir):
    """op13: hard negatives of every anchor of the embeddings table."""
    rows = table(spark, sf_dir, "embeddings").withColumn("embedding", F.col("embedding").cast("array<double>"))
    shown = rows.where(F.col("label").isNotNull() & finite(F.col("embedding"))).select(
        "vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        F.transform("embedding", lambda x: F.floor(x * 256)).alias("embedding"))
    return hard_negatives(shown, F.col("vec_id") % 100 == 0)


SQL = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_sum([a.v[i] * b.v[i] for i in range(1, len(a.v) + 1)])::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id, p.positive_score, s.other_id AS negative_id, s.score AS negative_score,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)::INT AS rank
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND {LOW} * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY rank <= 5
"""
