"""Range join of dense vectors in large blocks, a bounded number of distances at once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from verbum.operators import cluster as L, similarity as S


def made(spark, n=300):
    x = np.random.default_rng(4).normal(size=(n, 4)).astype(np.float32)
    d = np.sqrt(((x[:, None].astype(float) - x[None].astype(float)) ** 2).sum(-1))
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, v array<float>"), d


def test_pairs_by_parts_of_a_block(spark, monkeypatch):
    df, d = made(spark)
    monkeypatch.setattr(S, "RANGE_CELLS", 1000)
    got = {(r.a, r.b): r.dist for r in S.dense_range_pairs(df, "vec_id", "v", 0.8).collect()}
    want = {(a, b) for a, b in zip(*np.nonzero(d <= 0.8)) if a != b}
    assert set(got) == want and all(abs(x - d[p]) < 1e-9 for p, x in got.items())


@pytest.mark.parametrize("border, block_rows", [("first", 40), ("all", 40), ("all", 1000)])
def test_density_clusters_write_no_pairs(spark, monkeypatch, border, block_rows):
    df, _ = made(spark)
    points, pairs = df.select(F.col("vec_id").alias("doc_id")), S.dense_range_pairs(df, "vec_id", "v", 0.8, block_rows=block_rows)
    want = L.dbscan(points, spark.createDataFrame(pairs.toPandas()), 6, True, border).collect()        # pairs of any kind
    sizes, cut = [], L._cut

    def spied(table):
        out = cut(table)
        sizes.append(out.count())
        return out
    monkeypatch.setattr(L, "_cut", spied)
    got = L.dbscan(points, pairs, 6, True, border).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len({r.cluster for r in got}) > 2
    assert max(sizes[:1]) <= 300 < pairs.count()
