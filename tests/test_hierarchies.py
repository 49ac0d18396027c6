"""Clustering features, hierarchies, forests, the threshold join and mean
shift against brute force; expected heights from FIXTURES.md §4."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from verbum.operators import graph as G, hierarchy as H, modes as M, preprocess as P, similarity as S, weighting as W
from verbum.sources import tables

TOY = ["китайский пекин китайский", "китайский китайский шанхай", "китайский макао", "токио япония китайский",
       "китайский китайский китайский токио япония", "токио пекин"]


def points_of(spark, x, parts=3):
    return spark.createDataFrame([(i, [float(a) for a in row]) for i, row in enumerate(x)], "doc_id long, v array<double>").repartition(parts)


def toy_rows(spark):
    """A8 rows of the toy corpus as a dense matrix."""
    docs = spark.createDataFrame([(i + 1, t) for i, t in enumerate(TOY)], "doc_id long, text string")
    a8 = W.l2_weights(docs.select("doc_id", F.explode(F.split("text", " ")).alias("term")).groupBy("doc_id", "term").agg(F.count("*").alias("n"))).toPandas()
    wide = a8.pivot(index="doc_id", columns="term", values="w").fillna(0.0)
    return spark.createDataFrame([(int(i), [float(x) for x in r]) for i, r in zip(wide.index, wide.to_numpy())], "doc_id long, v array<double>")


def agglomerate(x, linkage):
    """Every step looks at all pairs of clusters."""
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    size, live, out = [1] * len(x), list(range(len(x))), []
    while len(live) > 1:
        h, a, b = min((d[i, j], i, j) for n, i in enumerate(live) for j in live[n + 1:])
        for k in live:
            if k not in (a, b):
                if linkage == "ward":
                    n = size[a] + size[b] + size[k]
                    new = math.sqrt(((size[a] + size[k]) * d[a, k] ** 2 + (size[b] + size[k]) * d[b, k] ** 2 - size[k] * h * h) / n)
                else:
                    new = (d[a, k] + d[b, k]) / 2
                d[a, k] = d[k, a] = new
        size[a] += size[b]
        live.remove(b)
        out.append((a, b, h, size[a]))
    return out


# --- clustering features -----------------------------------------------------

def test_fixture_heights(spark):
    leaves = H.features(toy_rows(spark), 0.0)
    got = [(r["a"], r["b"], round(r["height"], 4), r["size"]) for r in H.dendrogram(leaves, "wpgma").orderBy("step").collect()]
    assert got == [(4, 5, 0.2584, 2), (1, 6, 0.6282, 2), (1, 4, 1.2802, 4), (1, 2, 1.3840, 5), (1, 3, 1.3994, 6)]
    got = [(r["a"], r["b"], round(r["height"], 4), r["size"]) for r in H.dendrogram(leaves, "ward").orderBy("step").collect()]
    assert got == [(4, 5, 0.2584, 2), (1, 6, 0.6282, 2), (2, 3, 1.3999, 2), (1, 2, 1.6517, 4), (1, 4, 1.7365, 6)]


@pytest.mark.parametrize("linkage", ["ward", "wpgma"])
def test_dendrogram_by_force(spark, linkage):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 3))
    want = agglomerate(x, linkage)
    got = H.dendrogram(H.features(points_of(spark, x), 0.0, part_rows=17), linkage).orderBy("step").collect()
    assert [(r["a"], r["b"], r["size"]) for r in got] == [(a, b, s) for a, b, _, s in want]
    assert np.allclose([r["height"] for r in got], [h for _, _, h, _ in want])
    part = {r["doc_id"]: r["cluster"] for r in H.ward(points_of(spark, x), k=4).collect()}
    if linkage == "ward":
        name = np.arange(60)
        for a, b, _, _ in want[:56]:
            name[name == b] = a
        assert [part[i] for i in range(60)] == np.unique(name, return_inverse=True)[1].tolist()


@pytest.mark.parametrize("most", [5, 40, 1000])
def test_features_add_up(spark, most):
    rng = np.random.default_rng(most)
    x = np.concatenate([rng.normal(c, 0.05, (70, 2)) for c in ((0, 0), (3, 1), (-2, 4))] + [np.full((90, 2), 7.0)])
    points = points_of(spark, x)
    rows = H.features(points, 0.2, max_leaves=most, part_rows=50).collect()
    assert len(rows) <= most
    assert sum(r["n"] for r in rows) == len(x)
    assert np.allclose(sum(np.array(r["ls"]) for r in rows), x.sum(0)) and np.isclose(sum(r["ss"] for r in rows), (x ** 2).sum())
    for r in rows:
        assert r["ss"] / r["n"] - (np.array(r["ls"]) ** 2).sum() / r["n"] ** 2 <= r["threshold"] ** 2 + 1e-9
    if most > 5:
        assert {r["threshold"] for r in rows} == {0.2}
    again = H.features(points.repartition(7, "v"), 0.2, max_leaves=most, part_rows=50).collect()
    assert sorted((r["leaf"], r["n"]) for r in rows) == sorted((r["leaf"], r["n"]) for r in again)


def test_birch_labels_every_row(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(c, 0.02, (50, 2)) for c in ((0, 0), (3, 1), (-2, 4))])
    got = H.birch(points_of(spark, x), threshold=0.2, k=3).toPandas().sort_values("doc_id")
    assert got.doc_id.tolist() == list(range(150)) and got.cluster.tolist() == [0] * 50 + [1] * 50 + [2] * 50
    assert got.leaf.isin(got.doc_id).all()
    one = spark.createDataFrame([(3, [1.0]), (3, [1.0]), (9, [1.0])], "doc_id long, v array<double>")
    assert {(r["doc_id"], r["cluster"]) for r in H.birch(one).collect()} == {(3, 0), (9, 0)}


def test_dense_lsa_and_odd_rows(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(40, 6))
    x[5] = 0
    got = np.array([r["v"] for r in H.dense_lsa(points_of(spark, x), 2).orderBy("doc_id").collect()])
    want = x @ np.linalg.svd(x, full_matrices=False)[2][:2].T
    want = np.divide(want, np.linalg.norm(want, axis=1, keepdims=True), out=np.zeros_like(want), where=np.linalg.norm(want, axis=1, keepdims=True) > 0)
    assert np.allclose(np.abs(got), np.abs(want))
    odd = spark.createDataFrame([(1, [1.0, None]), (2, None), (None, [1.0, 2.0]), (3, [float("nan"), 1.0]), (4, [1.0, 2.0]), (5, [float("inf"), 0.0])],
                                "doc_id long, e array<double>")
    assert [r["doc_id"] for r in H.dense_rows(odd, "doc_id", "e").collect()] == [4]


def test_registered_hierarchies_cover_all_rows(spark):
    n = tables.embeddings(spark, SF_SMALL).count()
    for name in ("birch_embeddings", "ward_embeddings", "mean_shift_embeddings"):
        assert E.queries()[name](spark, SF_SMALL).select("doc_id").distinct().count() == n
    x = np.array([r["v"] for r in H.dense_rows(tables.embeddings(spark, SF_SMALL), "vec_id", "embedding").orderBy("doc_id").collect()])
    got = E.queries()["wpgma_dendrogram"](spark, SF_SMALL).orderBy("step").collect()
    want = H.merges(np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)), np.ones(len(x)), "wpgma")
    assert np.allclose([r["height"] for r in got], [m[2] for m in want], atol=1e-5) and len(got) == n - 1


# --- forests and the threshold join ------------------------------------------

def kruskal(edges):
    root = {}

    def find(a):
        while root.setdefault(a, a) != a:
            a = root[a]
        return a
    out = []
    for s, a, b in sorted((-s, min(a, b), max(a, b)) for a, b, s in edges if a != b):
        if find(a) != find(b):
            root[max(find(a), find(b))] = min(find(a), find(b))
            out.append((a, b, -s))
    return out, find


@pytest.mark.parametrize("kind", ["ties", "spread", "path", "star"])
def test_forest_by_force(spark, kind):
    rng = np.random.default_rng(6)
    pairs = {"ties": [(int(a), int(b), float(rng.integers(0, 3))) for a, b in rng.integers(0, 60, (90, 2))],
             "spread": [(int(a), int(b), float(rng.random())) for a, b in rng.integers(0, 80, (200, 2))],
             "path": [(i, i + 1, 1.0) for i in range(99)], "star": [(0, i, 0.5) for i in range(1, 50)]}[kind]
    vertices = spark.createDataFrame([(i,) for i in range(100)], "doc_id long")
    edges = spark.createDataFrame(pairs, "a long, b long, sim double")
    want, find = kruskal(pairs)
    got = [(r["a"], r["b"], r["sim"]) for r in G.max_similarity_merges(vertices, edges).orderBy("step").collect()]
    assert got == want
    comp = {r["doc_id"]: r["comp"] for r in G.components(vertices, edges).collect()}
    assert comp == {i: find(i) for i in range(100)}


def test_forest_without_edges(spark):
    vertices = spark.createDataFrame([(4,), (2,)], "doc_id long")
    none = spark.createDataFrame([], "a long, b long, sim double")
    assert G.max_similarity_merges(vertices, none).count() == 0
    assert {tuple(r) for r in G.components(vertices, none).collect()} == {(4, 4), (2, 2)}


@pytest.mark.parametrize("eps", [0.3, 0.9, 1.3])
def test_threshold_join_by_force(spark, eps):
    rng = np.random.default_rng(12)
    rows, weight = [], 1.0 / (1 + np.arange(40))
    for i in range(150):
        if i % 3 == 2:
            rows.append(dict(rows[rng.integers(0, i)]))              # copies
        else:
            # a term that all have, frequent ones and rare ones
            terms = set(rng.choice(40, rng.integers(2, 9), p=weight / weight.sum())) | {0}
            rows.append({int(t): float(rng.random() * (0.4 if t == 0 else 1) + 0.01) for t in terms})
    v = spark.createDataFrame([(i, f"t{t}", w) for i, r in enumerate(rows) for t, w in r.items()], "doc_id long, term string, w double")
    v = S.l2_normalise(v)
    x = np.zeros((150, 40))
    for i, r in enumerate(rows):
        for t, w in r.items():
            x[i, t] = w
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    d = np.sqrt(np.maximum(2 - 2 * x @ x.T, 0))
    want = {(i, j) for i in range(150) for j in range(150) if i != j and d[i, j] <= eps}
    got = S.eps_neighbours(v, eps).collect()
    assert {(r["doc_a"], r["doc_b"]) for r in got} == want and len(got) == len(want)
    assert max(abs(r["dist"] - d[r["doc_a"], r["doc_b"]]) for r in got) < 1e-6


def test_max_similarity_of_documents_by_force(spark):
    v = W.l2_weights(W.term_frequency(P.class_tokens(tables.documents(spark, SF_SMALL)))).toPandas()
    wide = v.pivot(index="doc_id", columns="term", values="w").fillna(0.0)
    ids, x = wide.index.to_numpy(), wide.to_numpy()
    cos = np.round(x @ x.T, 9)
    want, _ = kruskal([(int(ids[i]), int(ids[j]), float(cos[i, j])) for i in range(len(ids)) for j in range(i) if cos[i, j] >= 0.9])
    got = E.queries()["max_similarity_merges"](spark, SF_SMALL).orderBy("step").collect()
    assert len(got) == len(want) > 10
    assert np.allclose(sorted(r["sim"] for r in got), sorted(w[2] for w in want), atol=2e-6)
    assert {(r["a"], r["b"]) for r in got} == {w[:2] for w in want}


# --- mean shift --------------------------------------------------------------

def modes_by_force(x, width):
    ends = []
    for s in np.unique(np.rint(x / width), axis=0) * width:
        for _ in range(M.MAX_STEPS):
            near = x[((x - s) ** 2).sum(1) <= width * width]
            if not len(near):
                break
            before, s = s, near.mean(0)
            if np.linalg.norm(s - before) <= 1e-3 * width:
                ends.append((len(near), tuple(s)))
                break
    kept = []
    for n, s in sorted(set(ends), reverse=True):
        if all(np.linalg.norm(np.subtract(s, k)) > width for k in kept):
            kept.append(s)
    return np.array(kept)


def test_mean_shift_by_force(spark):
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(c, 0.3, (n, 2)) for c, n in (((0, 0), 80), ((4, 1), 50), ((-3, 5), 20))])
    points = points_of(spark, x)
    d = np.sort(np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)), axis=1)
    assert np.isclose(M.bandwidth(points, 0.2, threshold=0.0), d[:, 29].mean())
    assert abs(M.bandwidth(points, 0.2) - d[:, 29].mean()) < 0.02
    want = modes_by_force(x, 1.0)
    got, n = M.modes(points, 1.0)
    assert np.allclose(got, want) and list(n) == sorted(n, reverse=True)
    label = {r["doc_id"]: r["cluster"] for r in M.mean_shift(points, 1.0).collect()}
    assert [label[i] for i in range(len(x))] == ((x[:, None] - want[None]) ** 2).sum(-1).argmin(1).tolist()


def test_mean_shift_in_blocks_and_odd_tables(spark, monkeypatch):
    rng = np.random.default_rng(10)
    x = np.concatenate([rng.uniform(-4, 4, (120, 2)), np.full((60, 2), 2.5)])
    whole, n = M.modes(points_of(spark, x), 0.8)
    monkeypatch.setattr(M, "BLOCK", 7)
    parts, m = M.modes(points_of(spark, x), 0.8)
    assert np.allclose(whole, parts) and (n == m).all()
    assert np.allclose(whole, modes_by_force(x, 0.8))
    same = points_of(spark, np.ones((5, 2)))
    assert M.bandwidth(same) == 0.1 and {r["cluster"] for r in M.mean_shift(same).collect()} == {0}
    assert M.mean_shift(same.limit(0)).count() == 0
    monkeypatch.setattr(M, "MAX_SEEDS", 3)
    with pytest.raises(ValueError):
        M.modes(points_of(spark, x), 0.8)
