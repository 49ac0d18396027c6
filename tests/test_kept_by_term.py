"""Rounds of clustering move centroids and sums, not the rows."""

import math

from pyspark.sql import functions as F

from verbum.operators import cluster as L, similarity as S


def _rows(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, term string, w double")


def test_distances_of_one_grouping_and_of_many_keys(spark, monkeypatch):
    x = _rows(spark, [(1, "a", 1.0), (1, "b", 2.0), (2, "c", 3.0), (3, None, 1.0), (None, "a", 2.0)])
    cent = spark.createDataFrame([("p", "a", 1.0), ("p", "b", 1.0), ("q", "c", 2.0), (None, "a", 1.0)], "label string, term string, w double")
    want = {(1, "p"): 1.0, (1, "q"): 3.0, (2, "p"): math.sqrt(11), (2, "q"): 1.0, (3, "p"): math.sqrt(3), (3, "q"): math.sqrt(5),
            (None, "p"): math.sqrt(6), (None, "q"): math.sqrt(8), (1, None): math.sqrt(6), (2, None): math.sqrt(10), (3, None): math.sqrt(2), (None, None): math.sqrt(5)}
    for wide in (64, 1):
        monkeypatch.setattr(S, "WIDE", wide)
        got = {(r["doc_id"], r["label"]): r["dist"] for r in S.distances_to_centroids(x, cent, key="label").collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_one_join_for_all_centroids(spark):
    x = _rows(spark, [(i, f"t{i % 5}", 1.0) for i in range(40)])
    cent = x.where("doc_id < 4").select(F.col("doc_id").alias("cluster"), "term", "w")
    plan = S.distances_to_centroids(x, cent)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1


def test_small_and_large_sides_cluster_alike(spark, monkeypatch):
    v = _rows(spark, [(i, f"t{(i * 7 + j) % 9}", 1.0 + (i * j) % 3) for i in range(30) for j in range(3)])
    init = L.forgy_init(v, 3)
    seen = []
    for limit in (2_000_000, 0):
        monkeypatch.setattr(L, "BROADCAST_ROW_LIMIT", limit)
        a, _ = L.kmeans(v, init)
        u, _, _ = L.fuzzy_cmeans(v, init, max_iter=3)
        seen.append((sorted(map(tuple, a.collect())), sorted((r["doc_id"], r["cluster"], round(r["u"], 9)) for r in u.collect())))
    assert seen[0] == seen[1]
