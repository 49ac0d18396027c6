"""Similarity, distance and neighbour operators (V1–V7).

Sparse vectors are long tables ``(doc_id, term, w)``.  Dot products of all
pairs come from blocks of whole documents that are multiplied one against
another (``blocks``): a term that many documents hold makes no rows, and a task
returns only the pairs that its caller wants.

Dense vectors (``embeddings``) have no sparsity to exploit; exact range
queries over them run block against block (``dense_range_pairs``): rows are
hashed into blocks of bounded size and each pair of blocks is one task, so
no task ever holds more than two blocks.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from verbum.functions.joins import BROADCAST_ROW_LIMIT, broadcast_checked, scalar
from verbum.operators import blocks as B
from verbum.session import let_go, written as _cut

WIDE = 64              # centroids whose entries stand side by side in a term's row
PLACE_ROWS = 8_000_000  # entries of a sparse table that one task takes
RANGE_ROWS = 16_384    # dense vectors of a block; each is sent to every block that it meets
RANGE_CELLS = 4_000_000  # distances of dense vectors that a task holds at once


def places(v: DataFrame, rows: int) -> int:
    """Partitions for ``rows`` entries that meet the same keys again and again:
    few, so that a task's sums are of many entries each."""
    return max(v.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / PLACE_ROWS))


def l2_normalise(v: DataFrame, keep=()) -> DataFrame:
    """Divide each row's weights by its L2 norm (zero rows vanish)."""
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc_id")))
    return v.select("doc_id", *keep, "term", (F.col("w") / norm).alias("w")).filter(F.col("w").isNotNull())


def norms2(v: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return v.groupBy(id_col).agg(F.sum(F.col("w") * F.col("w")).alias("norm2"))


def dot_pairs(a: DataFrame, b: DataFrame, lower_triangle: bool = False) -> DataFrame:
    """Σ_term a.w·b.w for every (a.doc_id, b.doc_id) sharing a term.

    Output ``(doc_a, doc_b, dot)``; with ``lower_triangle`` only doc_a < doc_b.
    Rows are multiplied block against block, see ``blocks``."""
    return _shared_pairs(a, b, lower_triangle, lambda x, y, rows, i, j, dot: dot).withColumnRenamed("value", "dot")


def _shared_pairs(a: DataFrame, b: DataFrame, lower_triangle: bool, value) -> DataFrame:
    once = lower_triangle and a is b

    def keep(x, y, rows, dot, shared):
        i, j = np.nonzero(shared)
        ida, idb = x.ids[rows][i], y.ids[j]
        if lower_triangle:
            back = ida > idb
            # inside a block each pair comes both ways round, of two blocks only once
            here = ida < idb if not once or x.blk == y.blk else ida != idb
            if once:
                ida, idb = np.where(back, idb, ida), np.where(back, ida, idb)
            i, j, ida, idb = i[here], j[here], ida[here], idb[here]
        return ida, idb, value(x, y, rows, i, j, dot[i, j])

    left = B.blocks(a)
    return B.products(left, None if once else B.blocks(b), keep, "doc_a long, doc_b long, value double", pattern=True)


@dataclass
class CosineGraph:
    """The pairs of ``cosine_pairs`` with a cosine above ``min_cos``, known by
    their rows: what only multiplies by the cosines needs no row for each pair."""
    rows: DataFrame
    min_cos: float | None = None

    def pairs(self) -> DataFrame:
        out = cosine_pairs(self.rows)
        return out if self.min_cos is None else out.filter(F.col("cos") > self.min_cos)


def cosine_pairs(v: DataFrame, normalised: bool = True, as_graph: bool = False) -> DataFrame | CosineGraph:
    """V3: cosine similarity of every pair (doc_a < doc_b) with a shared term.

    Pairs that share no term have similarity 0 and are not emitted.
    ``as_graph``: all these pairs as a ``CosineGraph``, which writes none."""
    if not normalised:
        v = l2_normalise(v)
    if as_graph:
        return CosineGraph(v)
    return dot_pairs(v, v, lower_triangle=True).withColumnRenamed("dot", "cos")


def euclid_pairs(v: DataFrame) -> DataFrame:
    """V4: Euclidean distance ‖a‖²+‖b‖²−2a·b for every pair with a shared term.

    A pair sharing nothing is at sqrt(‖a‖²+‖b‖²); it is not emitted."""
    def far(x, y, rows, i, j, dot):
        return np.sqrt(np.maximum(0.0, x.norm2[rows][i] + y.norm2[j] - 2 * dot))

    return _shared_pairs(v, v, True, far).withColumnRenamed("value", "dist")


def near_graph(v: DataFrame, eps: float) -> tuple[DataFrame, DataFrame]:
    """Pairs of distinct rows at distance ≤ eps, without the rows' product:
    ``(edges(a, b, dist) with a < b, members(doc_id, rep))``.  Equal rows (to 12
    digits) are one node, named by the smallest id, so a group of copies costs
    one row for each copy.

    The rows of the nodes meet block against block, only those that share one of
    their leading (rarest) terms are multiplied, and only pairs within eps leave a
    task.  Exact under the condition of ``eps_neighbours``."""
    v = v.filter("w != 0").select("doc_id", "term", F.round("w", 12).alias("w"))
    mark = [F.bit_xor(F.xxhash64(F.lit(k), F.xxhash64("term"), "w")).alias(f"k{k}") for k in (1, 2)]
    rows = _cut(v.groupBy("doc_id").agg(*mark, F.count("*").alias("size")))
    same = ["k1", "k2", "size"]
    members = rows.join(rows.groupBy(*same).agg(F.min("doc_id").alias("rep")), same).select("doc_id", "rep")
    # terms in few rows lead: which come first among them doesn't matter
    often = v.groupBy("term").agg(F.count("*").alias("_o"))
    least = max(16, (scalar(rows.agg(F.sum("size").alias("e")), "e") or 0) // BROADCAST_ROW_LIMIT)
    often = broadcast_checked(_cut(often.filter(F.col("_o") > least)))
    alone = broadcast_checked(_cut(members.filter("doc_id = rep").select("doc_id")))
    let_go(v.sparkSession)
    nodes = (v.join(alone, "doc_id", "left_semi").join(often, "term", "left")
             .select("doc_id", "term", "w", F.coalesce("_o", F.lit(0)).alias("o")))
    return B.near(B.leading_blocks(nodes, "o", eps * eps), eps, "a long, b long, dist double"), members


def eps_neighbours(v: DataFrame, eps: float) -> DataFrame:
    """V5: ordered pairs (doc_a, doc_b), a ≠ b, at distance ≤ eps (inclusive).

    Exact when every pair sharing no term is farther than eps, i.e. when
    eps² < ‖a‖²+‖b‖² for all pairs — for unit rows any eps < √2.  The check
    is made from the two smallest norms; larger eps would make every pair a
    neighbour and is refused rather than materialised.  The pairs come from
    ``near_graph``; only those of copies are written out from their groups."""
    n = norms2(v)
    two = n.orderBy("norm2").limit(2).agg(F.sum("norm2").alias("s"))
    smallest = scalar(two, "s") or 0.0
    if eps * eps >= smallest:
        raise ValueError("eps reaches pairs without a shared term; all-pairs output refused")
    edges, members = near_graph(v, eps)
    edges, members = _cut(edges), _cut(members)
    left = members.select(F.col("rep").alias("a"), F.col("doc_id").alias("doc_a"))
    right = members.select(F.col("rep").alias("b"), F.col("doc_id").alias("doc_b"))
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "dist"))
    same = left.join(right, F.col("a") == F.col("b")).filter("doc_a != doc_b").select("doc_a", "doc_b", F.lit(0.0).alias("dist"))
    return both.join(left, "a").join(right, "b").select("doc_a", "doc_b", "dist").unionByName(same)


def similarity_graph(v: DataFrame, min_cos: float) -> DataFrame:
    """Edges ``(a, b, sim)``, a < b, of unit rows with a cosine of at least
    ``min_cos`` > 0.  Of equal rows each has one edge, to the smallest id of its
    group, and that one has the group's other edges: any clustering by links
    is the same as with all pairs written out."""
    edges, members = near_graph(v, math.sqrt(2 - 2 * min_cos) + 1e-12)
    copies = members.filter("rep != doc_id").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"), F.lit(1.0).alias("sim"))
    return edges.select("a", "b", F.round(1 - F.col("dist") * F.col("dist") / 2, 10).alias("sim")).filter(F.col("sim") >= min_cos).unionByName(copies)


def knn(test: DataFrame, train: DataFrame, k: int = 1) -> DataFrame:
    """V6: the k nearest training rows of every test row, ascending distance,
    ties by neighbour id.  Output ``(doc_id, nb_id, rank, dist)``.

    The rows are multiplied block against block and a task returns only the k
    nearest of its training rows for each of its test rows, so what is moved
    grows with the test rows and the blocks, not with the pairs."""
    def keep(x, y, rows, dot, shared):
        d2 = np.maximum(0.0, x.norm2[rows][:, None] + y.norm2[None, :] - 2 * dot)
        # squared distance rounded before the root: round-off of order 1e-16 in
        # na + nb - 2·dot would otherwise become 1e-8 and split exact ties
        near = np.round(np.sqrt(np.round(d2, 12)), 10)
        few = min(k, len(y.ids))
        last = np.partition(near, few - 1, axis=1)[:, few - 1:few]
        i, j = np.nonzero(near <= last)
        order = np.lexsort((y.ids[j], near[i, j], i))
        i, j = i[order], j[order]
        best = np.arange(len(i)) - np.searchsorted(i, i) < few
        i, j = i[best], j[best]
        return x.ids[rows][i], y.ids[j], d2[i, j]

    d = B.products(B.blocks(test), B.blocks(train), keep, "doc_id long, nb_id long, d2 double")
    d = d.select("doc_id", "nb_id", F.sqrt(F.round("d2", 12)).alias("dist"))
    w = Window.partitionBy("doc_id").orderBy(F.round("dist", 10), "nb_id")
    return d.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def distances_to_centroids(x: DataFrame, cent: DataFrame, key: str = "cluster", parts: int | None = None) -> DataFrame:
    """V7 input: distance from every row of ``x(doc_id, term, w)`` to every
    centroid ``cent(key, term, w)``.

    The keys are a bounded list, so a term's centroid entries are the columns of
    one row: the rows meet them once, and a document's norm and its dot products
    with all centroids are sums of one grouping.  Beyond ``WIDE`` keys the dot
    products are rows of their own.  ``parts``: the partitions by term that ``x``
    is kept in, which the centroids are dealt to."""
    nc = cent.groupBy(key).agg(F.sum(F.col("w") * F.col("w")).alias("nc"))
    keys = nc.orderBy(key).limit(WIDE + 1).collect()                  # one number a centroid
    if len(keys) > WIDE:
        return _distances_long(x, cent, nc, key)
    dots = [f"_{j}" for j in range(len(keys))]
    by_term = (cent.repartition(parts, "term") if parts else cent).groupBy("term").agg(*[F.sum(F.when(F.col(key) == F.lit(r[key]), F.col("w"))).alias(c) for r, c in zip(keys, dots)])
    g = (x.join(by_term, "term", "left").groupBy("doc_id")
         .agg(F.sum(F.col("w") * F.col("w")).alias("norm2"), *[F.sum(F.col("w") * F.col(c)).alias(c) for c in dots]))
    far = [F.struct(F.lit(r[key]).cast(cent.schema[key].dataType).alias(key), F.sqrt(F.greatest(F.lit(0.0), F.col("norm2") + F.lit(r["nc"]) - 2 * F.when(
        F.col("doc_id").isNotNull(), F.coalesce(c, F.lit(0.0))).otherwise(F.lit(0.0)))).alias("dist")) for r, c in zip(keys, dots)]
    cells = F.array(*far) if far else F.array().cast(f"array<struct<{key}:{cent.schema[key].dataType.simpleString()},dist:double>>")
    return g.select("doc_id", F.explode(cells).alias("_c")).select("doc_id", f"_c.{key}", "_c.dist")


def _distances_long(x: DataFrame, cent: DataFrame, nc: DataFrame, key: str) -> DataFrame:
    from verbum.operators.classify import per_doc_class
    nx = norms2(x)
    dot = (x.select("doc_id", "term", F.col("w").alias("wx"))
           .join(cent.select(key, "term", F.col("w").alias("wc")), "term")
           .groupBy("doc_id", key).agg(F.sum(F.col("wx") * F.col("wc")).alias("dot")))
    grid = per_doc_class(nx, nc, [key, "nc"])
    g = grid.join(dot, ["doc_id", key], "left")
    return g.select("doc_id", key, F.sqrt(F.greatest(
        F.lit(0.0), F.col("norm2") + F.col("nc") - 2 * F.coalesce("dot", F.lit(0.0)))).alias("dist"))


def nearest(dist: DataFrame, key: str = "cluster") -> DataFrame:
    """V7: argmin over centroids per row (ties to the smaller key)."""
    w = Window.partitionBy("doc_id").orderBy(F.round("dist", 10), key)
    return dist.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


# --------------------------------------------------------------- dense vectors

def _blocks(n: int, block_rows: int) -> int:
    return max(1, math.ceil(n / block_rows))


def _euclid(a: Column, b: Column) -> Column:
    """Euclidean distance of two equal-length double arrays (JVM side)."""
    sq = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(sq, F.lit(0.0), lambda acc, x: acc + x))


def dense_range_pairs(df: DataFrame, id_col: str, vec_col: str, eps: float,
                      block_rows: int = RANGE_ROWS, seed: int = 17) -> DataFrame:
    """Exact ε-range self-join over dense vectors: ordered pairs (a, b),
    a ≠ b, with Euclidean distance ≤ eps.

    Vectors are placed in cells of width eps by their distance to a seeded
    pivot row; by the triangle inequality a pair within eps lies in the same
    or adjacent cells, so only those cell pairs meet.  A crowded cell is cut
    into hash sub-blocks of about ``block_rows`` rows, and each pair of
    (cell, sub-block) blocks is one ``applyInPandas`` task computing
    distances with numpy, a bounded number at once.  Vectors travel in the
    numbers they came in and become doubles in the task.  Only the pivot vector and one count
    per cell are read on the driver side of the plan."""
    kind = df.schema[vec_col].dataType
    kind = kind if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else T.ArrayType(T.DoubleType())
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(kind).alias("v"))
    pivot = rows.orderBy(F.xxhash64("id", F.lit(seed)), "id").first()
    if pivot is None:
        return rows.select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(0.0).alias("dist")).limit(0)
    width = eps * (1.0 + 1e-9)  # guards the cell boundary against round-off
    cell = F.floor(_euclid(F.col("v").cast("array<double>"), F.array(*[F.lit(float(x)) for x in pivot["v"]])) / width)
    rows = rows.select("id", "v", cell.alias("cell"))
    sizes = rows.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(float(block_rows))).cast("long").alias("nsub"))
    m = (scalar(sizes.agg(F.max("nsub").alias("m")), "m") or 1) + 1
    rows = rows.join(sizes, "cell").withColumn("sub", F.pmod(F.xxhash64("id"), F.col("nsub")))
    rows = rows.withColumn("blk", F.col("cell") * m + F.col("sub"))
    for d, name in ((-1, "n_lo"), (1, "n_hi")):
        rows = rows.join(sizes.select((F.col("cell") - d).alias("cell"), F.col("nsub").alias(name)), "cell", "left")
    def subs(c, n):
        return F.when(F.coalesce(n, F.lit(0)) > 0,
                      F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda t: c * m + t)) \
                .otherwise(F.array().cast("array<long>"))
    others = F.concat(subs(F.col("cell") - 1, F.col("n_lo")), subs(F.col("cell"), F.col("nsub")),
                      subs(F.col("cell") + 1, F.col("n_hi")))
    join = RangeJoin(rows.select("id", "v", "blk", others.alias("others")), eps)

    def pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b, same = _two_blocks(pdf)
        ida, idb = a["id"].to_numpy(), b["id"].to_numpy()
        found = [(ida[ia], idb[ib], d) for ia, ib, d in _near(a, b, eps)]
        if not found:
            return pd.DataFrame({"a": [], "b": [], "dist": []})
        ida, idb, dd = (np.concatenate(x) for x in zip(*found))
        if same:  # both orders already present
            return pd.DataFrame({"a": ida, "b": idb, "dist": dd})
        return pd.DataFrame({"a": np.concatenate([ida, idb]), "b": np.concatenate([idb, ida]),
                             "dist": np.concatenate([dd, dd])})

    out = join.met(join.placed).applyInPandas(pairs, "a long, b long, dist double")
    out._range_join = join
    return out


def _two_blocks(pdf: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame, bool]:
    """The rows of both blocks of a task, and whether they are one."""
    lo, hi = int(pdf["lo"].iloc[0]), int(pdf["hi"].iloc[0])
    a = pdf[pdf["blk"] == lo]
    return a, a if hi == lo else pdf[pdf["blk"] == hi], hi == lo


def _near(a: pd.DataFrame, b: pd.DataFrame, eps: float):
    """``(ia, ib, dist)`` of the rows of ``a`` and ``b`` within ``eps`` that
    differ in id, a part of ``a`` at a time."""
    if not len(a) or not len(b):
        return
    xa = np.vstack(a["v"].to_numpy()).astype(np.float64)
    xb = np.vstack(b["v"].to_numpy()).astype(np.float64)
    na, nb = np.einsum("ij,ij->i", xa, xa), np.einsum("ij,ij->i", xb, xb)
    ida, idb, step = a["id"].to_numpy(), b["id"].to_numpy(), max(1, RANGE_CELLS // len(b))
    for at in range(0, len(a), step):
        d2 = na[at:at + step, None] + nb[None, :] - 2.0 * xa[at:at + step] @ xb.T
        np.maximum(d2, 0.0, out=d2)
        np.sqrt(d2, out=d2)
        ia, ib = np.nonzero(d2 <= eps)
        keep = ida[at + ia] != idb[ib]
        ia, ib = ia[keep], ib[keep]
        yield at + ia, ib, d2[ia, ib]


@dataclass
class RangeJoin:
    """What a range self-join says of its rows, without a row for each pair:
    tasks keep the pairs to themselves.  ``placed(id, v, blk, others)``."""
    placed: DataFrame
    eps: float

    def met(self, placed: DataFrame):
        """Rows by pair of blocks."""
        keep = [c for c in placed.columns if c != "others"]
        rows = placed.select(*keep, F.explode("others").alias("other"))
        return rows.select(*keep, F.least("blk", "other").alias("lo"), F.greatest("blk", "other").alias("hi")).groupBy("lo", "hi")

    def degrees(self) -> DataFrame:
        """``(doc_id, n)``: the pairs of every row that has any."""
        eps = self.eps

        def work(pdf: pd.DataFrame) -> pd.DataFrame:
            a, b, same = _two_blocks(pdf)
            na, nb = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
            for ia, ib, _ in _near(a, b, eps):
                na += np.bincount(ia, minlength=len(a))
                nb += np.bincount(ib, minlength=len(b))
            sides = [(a, na)] if same else [(a, na), (b, nb)]
            out = pd.concat([pd.DataFrame({"doc_id": x["id"].to_numpy(), "n": n}) for x, n in sides])
            return out[out["n"] > 0]

        return self.met(self.placed).applyInPandas(work, "doc_id long, n long").groupBy("doc_id").agg(F.sum("n").alias("n"))

    def forest(self, among: DataFrame) -> DataFrame:
        """``(a, b)``: edges that link the rows of ``among(doc_id)`` as all their
        pairs do; a pair of blocks gives fewer than it has rows."""
        eps = self.eps

        def work(pdf: pd.DataFrame) -> pd.DataFrame:
            a, b, same = _two_blocks(pdf)
            ida, idb, off = a["id"].to_numpy(), b["id"].to_numpy(), 0 if same else len(a)
            label, edges = np.arange(off + len(b)), []
            for ia, ib, _ in _near(a, b, eps):
                x, y = label[ia], label[off + ib]
                apart = np.flatnonzero(x != y)
                lo, hi = np.minimum(x, y)[apart], np.maximum(x, y)[apart]
                _, first = np.unique(lo * len(label) + hi, return_index=True)
                parent = {}

                def root(k):
                    while k in parent:
                        k = parent[k]
                    return k
                for i, p, q in zip(apart[first].tolist(), lo[first].tolist(), hi[first].tolist()):
                    p, q = root(p), root(q)
                    if p != q:
                        parent[max(p, q)] = min(p, q)
                        edges.append((ida[ia[i]], idb[ib[i]]))
                if parent:
                    to = np.arange(len(label))
                    for k in sorted(parent):          # a parent is smaller, so it is done
                        to[k] = to[parent[k]]
                    label = to[label]
            return pd.DataFrame(edges, columns=["a", "b"], dtype="int64")

        rows = self.placed.join(among.select(F.col("doc_id").alias("id")).distinct(), "id", "left_semi")
        return self.met(rows).applyInPandas(work, "a long, b long")

    def reached(self, comp: DataFrame) -> DataFrame:
        """``(doc_id, comp)``, distinct: for the rows outside ``comp(doc_id,
        comp)`` the components of their pairs' other rows."""
        eps = self.eps

        def work(pdf: pd.DataFrame) -> pd.DataFrame:
            a, b, same = _two_blocks(pdf)
            ia_in, ib_in, ca, cb = a["inside"].to_numpy(), b["inside"].to_numpy(), a["comp"].to_numpy(), b["comp"].to_numpy()
            ida, idb, found = a["id"].to_numpy(), b["id"].to_numpy(), [np.zeros((0, 2), np.int64)]
            for ia, ib, _ in _near(a, b, eps):
                k = ~ia_in[ia] & ib_in[ib]
                found.append(np.unique(np.stack([ida[ia[k]], cb[ib[k]]], 1), axis=0))
                if not same:
                    k = ia_in[ia] & ~ib_in[ib]
                    found.append(np.unique(np.stack([idb[ib[k]], ca[ia[k]]], 1), axis=0))
            return pd.DataFrame(np.unique(np.concatenate(found), axis=0), columns=["doc_id", "comp"])

        known = comp.select(F.col("doc_id").alias("id"), F.col("comp").cast("long").alias("comp")).dropDuplicates(["id"])
        rows = self.placed.where("id IS NOT NULL").join(known, "id", "left")
        rows = rows.withColumn("inside", F.col("comp").isNotNull()).withColumn("comp", F.coalesce("comp", F.lit(0)))
        return self.met(rows).applyInPandas(work, "doc_id long, comp long").distinct()


def dense_knn(test: DataFrame, train: DataFrame, id_col: str, vec_col: str, k: int = 1,
              block_rows: int = 2048) -> DataFrame:
    """Exact k nearest training vectors of each test vector: per block pair
    the local top-k, then the global top-k over the ≤ B·k local winners."""
    nt = scalar(train.agg(F.count("*").alias("n")), "n") or 0
    nb = _blocks(nt, block_rows)
    tr = train.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"),
                      F.pmod(F.xxhash64(id_col), F.lit(nb)).alias("blk"), F.lit(1).alias("side"))
    nq = scalar(test.agg(F.count("*").alias("n")), "n") or 0
    qb = _blocks(nq, block_rows)
    te = test.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"),
                     F.pmod(F.xxhash64(id_col), F.lit(qb)).alias("qblk"), F.lit(0).alias("side"))
    tr = tr.select("*", F.explode(F.sequence(F.lit(0), F.lit(qb - 1))).alias("qblk"))
    te = te.select("*", F.explode(F.sequence(F.lit(0), F.lit(nb - 1))).alias("blk"))
    rows = tr.unionByName(te)

    def local(pdf: pd.DataFrame) -> pd.DataFrame:
        q = pdf[pdf["side"] == 0]
        t = pdf[pdf["side"] == 1]
        if len(q) == 0 or len(t) == 0:
            return pd.DataFrame({"doc_id": pd.Series([], dtype="int64"), "nb_id": pd.Series([], dtype="int64"),
                                 "dist": pd.Series([], dtype="float64")})
        xq = np.vstack(q["v"].to_numpy())
        xt = np.vstack(t["v"].to_numpy())
        d2 = np.einsum("ij,ij->i", xq, xq)[:, None] + np.einsum("ij,ij->i", xt, xt)[None, :] - 2.0 * xq @ xt.T
        np.maximum(d2, 0.0, out=d2)
        kk = min(k, xt.shape[0])
        tid = t["id"].to_numpy()
        dr = np.round(np.sqrt(d2), 10)
        idx = np.vstack([np.lexsort((tid, dr[i]))[:kk] for i in range(xq.shape[0])])
        rows_i = np.repeat(np.arange(xq.shape[0]), kk)
        cols_i = idx.ravel()
        return pd.DataFrame({"doc_id": q["id"].to_numpy()[rows_i], "nb_id": t["id"].to_numpy()[cols_i],
                             "dist": np.sqrt(d2[rows_i, cols_i])})

    schema = "doc_id long, nb_id long, dist double"
    loc = rows.groupBy("qblk", "blk").applyInPandas(local, schema)
    w = Window.partitionBy("doc_id").orderBy(F.round("dist", 10), "nb_id")
    return loc.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def dense_long(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Dense array column → long ``(doc_id, term, w)`` with term = dimension."""
    return df.select(F.col(id_col).alias("doc_id"),
                     F.posexplode(F.col(vec_col).cast("array<double>")).alias("term", "w"))


def class_centroids(long_vecs: DataFrame, labels: DataFrame, key: str = "label") -> DataFrame:
    """Mean vector per class: ``(key, term, w)`` (absent coordinates are 0)."""
    n = labels.groupBy(key).agg(F.count("*").alias("_n"))
    s = long_vecs.join(labels, "doc_id").groupBy(key, "term").agg(F.sum("w").alias("_s"))
    return s.join(n, key).select(key, "term", (F.col("_s") / F.col("_n")).alias("w"))
