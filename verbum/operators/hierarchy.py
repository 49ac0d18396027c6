"""Clustering features and the hierarchies over them.

A clustering feature ``(n, ls, ss)`` — rows, their sum and the sum of their
squared lengths — stands for a ball of dense rows and adds up exactly.  Every
task folds its rows into at most ``max_leaves`` features, groups of tasks are
folded in a tree, and the hierarchy is built over the features that remain:
never over pairs of rows.  As in the published method, a list that outgrows
``max_leaves`` is rebuilt with a larger threshold, so memory is bounded and all
rows count; the threshold that was needed is part of every feature.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from verbum.functions.joins import scalar
from verbum.session import checkpoint_dir

MAX_LEAVES = 1024      # features that one list may hold
PART_ROWS = 20_000     # rows that one list is begun with, about
FAN_IN = 8             # lists that are folded into one
FEATURE = "part long, leaf long, n long, ls array<double>, ss double, threshold double"


def dense_rows(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(doc_id, v)`` of the rows whose vector has no null, infinite or NaN
    component; the others belong to no cluster."""
    v = F.col(vec_col).cast("array<double>")
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & whole).select(F.col(id_col).cast("long").alias("doc_id"), v.alias("v"))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list array of equal lengths."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def dense_lsa(points: DataFrame, k: int = 2) -> DataFrame:
    """V8 for dense rows: ``k`` right singular vectors of the row matrix from
    its Gramian (columns × columns, summed over the tasks), rows projected and
    scaled to length one.  A zero row stays zero.  Each vector's largest
    component is made positive."""
    def gram(batches):
        total = None
        for batch in batches:
            x = matrix(batch.column(0))
            if len(x):
                total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            at = np.arange(total.size)
            yield pa.RecordBatch.from_arrays([pa.array(at // len(total)), pa.array(at % len(total)), pa.array(total.ravel())], ["i", "j", "g"])

    cells = points.select("v").mapInArrow(gram, "i long, j long, g double").groupBy("i", "j").agg(F.sum("g").alias("g")).collect()
    if not cells:
        return points
    d = max(c["i"] for c in cells) + 1
    g = np.zeros((d, d))
    for c in cells:
        g[c["i"], c["j"]] = c["g"]
    _, vectors = np.linalg.eigh(g)
    axes = vectors[:, ::-1][:, :k]
    axes = axes * np.sign(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])])

    def project(batches):
        for batch in batches:
            x = matrix(batch.column(1))
            x = x @ axes if len(x) else np.zeros((0, k))
            length = np.linalg.norm(x, axis=1, keepdims=True)
            x = np.divide(x, length, out=np.zeros_like(x), where=length > 0)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), flat], ["doc_id", "v"])

    return points.select("doc_id", "v").mapInArrow(project, "doc_id long, v array<double>")


class Leaves:
    """Features that take in others while the radius of the union stays within
    the threshold."""

    def __init__(self, dim: int, threshold: float, most: int):
        self.threshold, self.most, self.size = threshold, most, 0
        self.leaf, self.n = np.zeros(most + 1, np.int64), np.zeros(most + 1, np.int64)
        self.ls, self.ss, self.mean = np.zeros((most + 1, dim)), np.zeros(most + 1), np.zeros((most + 1, dim))

    def radius2(self, n, ls, ss):
        return np.maximum(ss / n - ((ls / np.reshape(n, (-1, 1))) ** 2).sum(-1), 0)

    def put(self, leaf: int, n: int, ls: np.ndarray, ss: float) -> None:
        k = self.size
        if k:
            j = int(((self.mean[:k] - ls / n) ** 2).sum(1).argmin())
            n2, ls2, ss2 = self.n[j] + n, self.ls[j] + ls, self.ss[j] + ss
            if self.radius2(n2, ls2[None], ss2)[0] <= self.threshold ** 2 + 1e-12 * ss2 / n2:
                self.leaf[j], self.n[j], self.ls[j], self.ss[j], self.mean[j] = min(self.leaf[j], leaf), n2, ls2, ss2, ls2 / n2
                return
        self.leaf[k], self.n[k], self.ls[k], self.ss[k], self.mean[k] = leaf, n, ls, ss, ls / n
        self.size += 1

    def add(self, leaf: int, n: int, ls: np.ndarray, ss: float) -> None:
        self.put(leaf, n, ls, ss)
        while self.size > self.most:
            k = self.size
            d = ((self.mean[:k, None] - self.mean[None, :k]) ** 2).sum(-1) if k * k * self.mean.shape[1] < 1 << 22 else \
                np.maximum((self.mean[:k] ** 2).sum(1)[:, None] + (self.mean[:k] ** 2).sum(1) - 2 * self.mean[:k] @ self.mean[:k].T, 0)
            np.fill_diagonal(d, np.inf)
            j = d.argmin(1)
            union = self.radius2(self.n[:k] + self.n[j], self.ls[:k] + self.ls[j], self.ss[:k] + self.ss[j])
            self.threshold = max(1.01 * self.threshold, float(np.sqrt(np.median(union))))
            old = [a[:k].copy() for a in (self.leaf, self.n, self.ls, self.ss)]
            self.size = 0
            for row in zip(*old, strict=True):
                self.put(*row)

    def frame(self, part: int) -> pd.DataFrame:
        k = self.size
        return pd.DataFrame({"part": part, "leaf": self.leaf[:k], "n": self.n[:k], "ls": list(self.ls[:k]), "ss": self.ss[:k], "threshold": self.threshold})


def features(points: DataFrame, threshold: float = 0.2, max_leaves: int = MAX_LEAVES, part_rows: int = PART_ROWS) -> DataFrame:
    """L15, first half: at most ``max_leaves`` features ``(leaf, n, ls, ss,
    threshold)`` of ``points(doc_id, v)``; ``leaf`` is the smallest id inside.

    Equal rows of one id are counted first; rows are dealt to lists by a hash
    and folded in the order of the id, so the result follows neither the
    partitioning of the input nor one id that many rows share."""
    rows = scalar(points.agg(F.count("*").alias("n")), "n")
    parts = max(1, math.ceil((rows or 0) / part_rows))
    dealt = (points.groupBy("doc_id", "v").agg(F.count("*").alias("n"))
             .select(F.pmod(F.xxhash64("doc_id", "v"), F.lit(parts)).alias("part"), "doc_id", "v", "n")
             .repartition(parts, "part").sortWithinPartitions("part", "doc_id", "v"))

    def fold_rows(batches):
        leaves, now = None, None
        for batch in batches:
            x, part, ids, n = matrix(batch.column(2)), *(batch.column(k).to_numpy() for k in (0, 1, 3))
            for k in range(len(x)):
                if part[k] != now:
                    if leaves is not None:
                        yield pa.RecordBatch.from_pandas(leaves.frame(now))
                    leaves, now = Leaves(x.shape[1], threshold, max_leaves), part[k]
                leaves.add(ids[k], n[k], n[k] * x[k], float(n[k] * (x[k] @ x[k])))
        if leaves is not None:
            yield pa.RecordBatch.from_pandas(leaves.frame(now))

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["leaf", "n", "ss"])
        leaves = Leaves(len(pdf["ls"].iloc[0]), float(pdf["threshold"].max()), max_leaves)
        for row in zip(pdf["leaf"], pdf["n"], pdf["ls"], pdf["ss"], strict=True):
            leaves.add(row[0], row[1], np.asarray(row[2]), row[3])
        return leaves.frame(int(pdf["part"].iloc[0]))

    found = dealt.mapInArrow(fold_rows, FEATURE)
    while parts > 1:
        parts = math.ceil(parts / FAN_IN)
        found = found.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("part").applyInPandas(fold, FEATURE)
    checkpoint_dir(points.sparkSession)
    return found.drop("part").checkpoint()


def assign(points: DataFrame, leaves: DataFrame) -> DataFrame:
    """``(doc_id, leaf)``: every row with the feature whose mean is nearest,
    ties to the smaller leaf.  ``leaves`` has at most ``max_leaves`` rows."""
    found = leaves.orderBy("leaf").collect()
    ids = np.array([r["leaf"] for r in found], np.int64)
    means = np.array([np.array(r["ls"]) / r["n"] for r in found])

    def work(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                x = matrix(part.column(1))
                d = np.maximum((means ** 2).sum(1) - 2 * x @ means.T, -(x ** 2).sum(1)[:, None])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids[np.round(d, 12).argmin(1)])], ["doc_id", "leaf"])

    return points.select("doc_id", "v").mapInArrow(work, "doc_id long, leaf long")


def merges(distance: np.ndarray, sizes: np.ndarray, linkage: str) -> list[tuple[int, int, float, int]]:
    """All merges ``(a, b, height, size)`` of a reducible linkage by the
    nearest-neighbour chain, in the order of their heights; clusters are named
    by their smallest member.  ``ward`` weighs by the sizes; ``wpgma`` takes the
    plain average of both distances."""
    m = len(sizes)
    d, n = distance.copy(), sizes.astype(np.float64)
    np.fill_diagonal(d, np.inf)
    live, top, chain, found = np.ones(m, bool), np.zeros(m), [], []
    while len(found) < m - 1:
        if not chain:
            chain = [int(live.argmax())]
        while True:
            row = np.where(live, d[chain[-1]], np.inf)
            y = int(row.argmin())
            if len(chain) > 1 and row[chain[-2]] <= row[y]:
                break
            chain.append(y)
        b, a = chain.pop(), chain.pop()
        a, b = min(a, b), max(a, b)
        height = max(float(d[a, b]), top[a], top[b])
        if linkage == "ward":
            new = np.sqrt(np.maximum(((n[a] + n) * d[a] ** 2 + (n[b] + n) * d[b] ** 2 - n * d[a, b] ** 2) / (n[a] + n[b] + n), 0))
        else:
            new = (d[a] + d[b]) / 2
        new[~live | (np.arange(m) == a) | (np.arange(m) == b)] = np.inf
        live[b] = False
        d[a], d[:, a], n[a], top[a] = new, new, n[a] + n[b], height
        found.append((a, b, height))
    name, size, out = np.arange(m), sizes.astype(np.int64).copy(), []
    for a, b, height in sorted(found, key=lambda r: r[2]):
        while name[a] != a:
            a = name[a]
        while name[b] != b:
            b = name[b]
        a, b = min(a, b), max(a, b)
        name[b] = a
        size[a] += size[b]
        out.append((a, b, height, int(size[a])))
    return out


def between(n: np.ndarray, mean: np.ndarray, linkage: str) -> np.ndarray:
    """Distances of features: of their means, for Ward times
    sqrt(2 n m / (n + m)), which is the plain distance of single rows."""
    d = np.stack([np.sqrt(((mean - x) ** 2).sum(1)) for x in mean])
    return d * np.sqrt(2 * np.outer(n, n) / (n[:, None] + n)) if linkage == "ward" else d


def tree(pdf: pd.DataFrame, linkage: str) -> tuple[np.ndarray, list]:
    pdf = pdf.sort_values(["leaf", "n", "ss"])
    n, mean = pdf["n"].to_numpy(), np.array([np.asarray(x) / k for x, k in zip(pdf["ls"], pdf["n"], strict=True)])
    return pdf["leaf"].to_numpy(), merges(between(n, mean, linkage), n, linkage)


def dendrogram(leaves: DataFrame, linkage: str) -> DataFrame:
    """L1 (``wpgma``) and L11 (``ward``): ``(step, a, b, height, size)``, one row
    for each merge; clusters are named by their smallest leaf, ``size`` counts
    rows.  One task takes the features, at most ``max_leaves`` of them; merges
    inside a feature aren't listed."""
    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        leaf, found = tree(pdf, linkage)
        rows = [(k + 1, leaf[a], leaf[b], h, s) for k, (a, b, h, s) in enumerate(found)]
        return pd.DataFrame(rows, columns=["step", "a", "b", "height", "size"])

    return leaves.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(work, "step long, a long, b long, height double, size long")


def cut(leaves: DataFrame, linkage: str, k: int) -> DataFrame:
    """``(leaf, cluster)``: the ``k`` clusters (all leaves, if fewer) that the
    last merges join, numbered from 0 in the order of their smallest leaf."""
    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        leaf, found = tree(pdf, linkage)
        name = np.arange(len(leaf))
        for a, b, _, _ in found[:max(len(leaf) - k, 0)]:
            name[name == b] = a
        return pd.DataFrame({"leaf": leaf, "cluster": np.unique(name, return_inverse=True)[1].astype(np.int64)})

    return leaves.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(work, "leaf long, cluster long")


def birch(points: DataFrame, threshold: float = 0.2, k: int = 2, max_leaves: int = MAX_LEAVES) -> DataFrame:
    """``(doc_id, leaf, cluster)`` for every row of ``points(doc_id, v)``:
    its feature, and the one of ``k`` Ward clusters of features that holds it."""
    leaves = features(points, threshold, max_leaves)
    return assign(points, leaves).join(F.broadcast(cut(leaves, "ward", k)), "leaf").select("doc_id", "leaf", "cluster")


def ward(points: DataFrame, k: int = 2, max_leaves: int = MAX_LEAVES) -> DataFrame:
    """``(doc_id, cluster)`` by Ward's method.  Equal rows are one feature;
    up to ``max_leaves`` distinct rows this is Ward over all rows, beyond it is
    Ward over the features."""
    return birch(points, 0.0, k, max_leaves).drop("leaf")
