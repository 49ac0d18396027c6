"""Hard-negative mining with anchor spanning-tree bounds.

Anchors are taken in rounds of at most ``ROUND`` and joined by a minimum
spanning tree.  The score of a candidate ``c`` at an anchor differs from its
score at the parent anchor by at most the length of the tree edge times the
norm of ``c``; a score that isn't known is an interval, which widens along the
tree until it overlaps the scores that are searched for and is computed anew.
Each round scans all candidates twice: for the positives, whose least wanted
score rises with what a task has found, and for the windows that the positives
open.  Nothing depends on how scores lie: where bounds exclude nothing, every
score is computed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from verbum.llm import common as C

ROUND = 2048              # anchors of a round: what the driver and each worker hold of them
SLICE = 2048              # candidates whose intervals a task holds at once
LIMIT = 1 << 62           # scores beyond are held here
FOUND = "anchor_id long, positive_id long, positive_score long"
MINED = FOUND + ", negative_id long, negative_score long"


def quantized(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """``(vec_id, label, ints)``: every component times ``scale``, rounded down.
    Rows with a null id, label or vector, or a null or non-finite component are
    left out; an empty vector stays."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return (embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & whole)
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                    F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("ints")))


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order, parents and edge lengths of a minimum spanning tree over the rows;
    it grows from the row next to the mean, so parents come before children."""
    n = len(x)
    parent, edge, best = np.full(n, -1), np.zeros(n), np.full(n, np.inf)
    left, order = np.ones(n, bool), []
    at = int(((x - x.mean(0)) ** 2).sum(1).argmin())
    while True:
        order.append(at)
        left[at] = False
        if not left.any():
            return np.array(order), parent, edge
        d = np.sqrt(((x - x[at]) ** 2).sum(1))
        nearer = left & (d < best)
        best[nearer], parent[nearer] = d[nearer], at
        at = int(np.where(left, best, np.inf).argmin())
        edge[at] = best[at]


@dataclass
class Anchors:
    """A round of anchors, their tree, and the windows that are searched."""
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray                # int64, padded with zeros
    order: np.ndarray
    parent: np.ndarray
    edge: np.ndarray
    windows: list | None = None        # for each anchor: (positive_id, least, most)


def padded(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of a list array as an int64 matrix of at least ``width`` columns;
    shorter vectors end in zeros."""
    n = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lists), max([width, *n])), np.int64)
    out[np.arange(out.shape[1]) < n[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def plan(table: pa.Table) -> Anchors:
    lists = table.column("ints").combine_chunks()
    x = padded(lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists, 1)
    order, parent, edge = spanning_tree(x.astype(np.float64))
    return Anchors(table.column("vec_id").to_numpy(), table.column("label").to_numpy(), x, order, parent, edge)


def best(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` highest scores, ties by smaller id."""
    return np.lexsort((ids, -scores))[:n]


class Scorer:
    """Scores of one slice of candidates, computed only where asked."""

    def __init__(self, anchors: Anchors, ids, labels, ints):
        self.a, self.ids, self.labels = anchors, ids, labels
        x = padded(ints, anchors.vectors.shape[1])
        y = np.zeros((len(anchors.ids), x.shape[1]), np.int64)
        y[:, :anchors.vectors.shape[1]] = anchors.vectors
        most = [float(np.abs(v.astype(np.float64)).max(initial=0)) for v in (x, y)]
        # sums of products under 2^53 are exact in doubles; else Python's integers
        self.plain = most[0] * most[1] * x.shape[1] < 2 ** 53
        kind = np.float64 if self.plain else object
        self.x, self.y = x.astype(kind), y.astype(kind)
        # a little more than the true norm, for what doubles round off; no bounds beside big integers
        self.norm = np.sqrt((self.x * self.x).sum(1)) * (1 + 1e-9) if self.plain else np.full(len(x), np.inf)
        self.low = np.empty((len(y), len(x)))
        self.high = np.empty((len(y), len(x)))
        self.computed = 0

    def exact(self, k: int, places) -> np.ndarray:
        s = self.x[places] @ self.y[k]
        self.computed += len(s)
        return s.astype(np.int64) if self.plain else np.array([max(-LIMIT, min(LIMIT, int(v))) for v in s], np.int64)

    def search(self, k: int, fit: np.ndarray, least: float, most: float) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the candidates that ``fit`` and whose interval
        at anchor ``k`` overlaps ``least .. most``."""
        p = self.a.parent[k]
        if p < 0:
            every = self.exact(k, slice(None))
            self.low[k] = self.high[k] = every
            places = np.flatnonzero(fit & (every >= least) & (every <= most))
            return places, every[places]
        if self.plain:
            reach = self.norm * (self.a.edge[k] * (1 + 1e-9))
            low, high = self.low[p] - reach, self.high[p] + reach
        else:
            low, high = np.full(len(self.x), -np.inf), np.full(len(self.x), np.inf)
        places = np.flatnonzero(fit & (high >= least) & (low <= most))
        scores = self.exact(k, places)
        low[places] = high[places] = scores
        self.low[k], self.high[k] = low, high
        here = (scores >= least) & (scores <= most)
        return places[here], scores[here]


def slices(batches, anchors: Anchors):
    for batch in batches:
        for lo in range(0, batch.num_rows, SLICE):
            part = batch.slice(lo, SLICE)
            yield Scorer(anchors, part.column(0).to_numpy(), part.column(1).to_numpy(), part.column(2))


def find_positives(shipped, n: int):
    def work(batches):
        a = shipped.value
        top = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(a.ids)
        for s in slices(batches, a):
            for k in a.order:
                ids, scores = top[k]
                least = scores[-1] if len(scores) == n else -np.inf
                fit = (s.labels == a.labels[k]) & (s.ids != a.ids[k])
                places, new = s.search(k, fit, least, np.inf)
                if len(places):
                    ids, scores = np.r_[ids, s.ids[places]], np.r_[scores, new]
                    keep = best(scores, ids, n)
                    top[k] = ids[keep], scores[keep]
        for k in range(len(a.ids)):
            ids, scores = top[k]
            if len(ids):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), a.ids[k])), pa.array(ids), pa.array(scores)],
                                                 ["anchor_id", "positive_id", "positive_score"])

    return work


def find_negatives(shipped, n: int):
    def work(batches):
        a = shipped.value
        top = [[(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(w) for w in a.windows]
        for s in slices(batches, a):
            for k in a.order:
                if not a.windows[k]:          # nothing is searched here, but children need the interval
                    s.search(k, np.zeros(len(s.ids), bool), np.inf, -np.inf)
                    continue
                least, most = min(w[1] for w in a.windows[k]), max(w[2] for w in a.windows[k])
                places, new = s.search(k, s.labels != a.labels[k], least, most)
                found = s.ids[places]
                for j, (_, lo, hi) in enumerate(a.windows[k]):
                    here = (new >= lo) & (new <= hi)
                    if here.any():
                        ids, scores = np.r_[top[k][j][0], found[here]], np.r_[top[k][j][1], new[here]]
                        keep = best(scores, ids, n)
                        top[k][j] = ids[keep], scores[keep]
        for k in range(len(a.ids)):
            for (positive, _, hi), (ids, scores) in zip(a.windows[k], top[k], strict=True):
                if len(ids):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(ids), v)) for v in (a.ids[k], positive, hi)] + [pa.array(ids), pa.array(scores)],
                        ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])

    return work


def mine(spark: SparkSession, rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5,
         low: int = 80, high: int = 100, round_size: int = ROUND) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score)`` for ``rows`` (``vec_id``, ``label``, ``ints``).

    A row's score at an anchor is the integer inner product; higher scores come
    first, ties by smaller ``vec_id``.  An anchor's positives are its first
    ``positives`` other rows of its label; for each, the first ``negatives`` rows
    of other labels with ``low * positive <= 100 * negative <= high * positive``
    are returned, ranked from 1.

    ``vec_id`` names one row: of rows that repeat it the one with the least
    (label, vector) takes part.  Vectors of unlike length are padded with
    zeros; scores beyond 2^62 either way are held there.  Rows with a null
    ``vec_id``, label or vector take no part; an anchor without another row of
    its label, or a positive without a fitting negative, has no rows; an empty
    table gives an empty one.  Further columns of ``rows`` are ignored.

    A round holds at most ``round_size`` anchors on the driver and in each
    worker, whatever the table's size; rounds follow each other until all
    anchors are done."""
    rows = (rows.select("vec_id", "label", "ints").dropna().groupBy("vec_id").agg(F.min(F.struct("label", "ints")).alias("row"))
            .select("vec_id", "row.label", "row.ints"))
    rows = C.written(spark, rows, "vectors")
    heads = C.written(spark, rows.where(is_anchor), "anchors")
    out = C.shared_path(spark, "negatives")
    done, last = 0, None
    while True:
        todo = heads if last is None else heads.where(F.col("vec_id") > last)
        table = todo.orderBy("vec_id").limit(round_size).toArrow()
        if not table.num_rows:
            break
        last = table.column("vec_id")[-1].as_py()
        anchors = plan(table)
        shipped = spark.sparkContext.broadcast(anchors)
        order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
        near = (rows.mapInArrow(find_positives(shipped, positives), FOUND)
                .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= positives).drop("rank"))
        at = {v: k for k, v in enumerate(anchors.ids.tolist())}
        anchors.windows = [[] for _ in at]
        for r in near.toLocalIterator():                 # at most `positives` rows for each anchor of the round
            s = r.positive_score
            anchors.windows[at[r.anchor_id]].append((r.positive_id, -(-low * s // 100), high * s // 100, s))
        scored = {(i, w[0]): w[3] for i, k in at.items() for w in anchors.windows[k]}
        anchors.windows = [[w[:3] for w in ws] for ws in anchors.windows]
        shipped.unpersist()
        shipped = spark.sparkContext.broadcast(anchors)
        order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
        known = spark.createDataFrame([(*k, v) for k, v in scored.items()], FOUND)
        (rows.mapInArrow(find_negatives(shipped, negatives), MINED).drop("positive_score")
         .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
         .join(F.broadcast(known), ["anchor_id", "positive_id"])
         .write.parquet(f"{out}/round={done}"))
        shipped.unpersist()
        done += 1
    C.discard(spark, rows, heads)
    shape = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    found = spark.read.schema(shape).parquet(*[f"{out}/round={k}" for k in range(done)]) if done else spark.createDataFrame([], shape)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id AS id, CAST(list_inner_product(a.q, c.q) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
p AS (
  SELECT * FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
   AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
