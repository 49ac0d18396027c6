"""Affinity propagation against message loops written out node by node."""

import numpy as np
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from verbum.operators import exemplars as X


def by_force(s, damping, rounds, unchanged):
    m = len(s)
    r, a = np.zeros((m, m)), np.zeros((m, m))
    last, same = None, 0
    for done in range(1, rounds + 1):
        new = np.array([[s[i, k] - max(a[i, j] + s[i, j] for j in range(m) if j != k) for k in range(m)] for i in range(m)])
        r = damping * r + (1 - damping) * new
        new = np.zeros((m, m))
        for i in range(m):
            for k in range(m):
                up = sum(max(0.0, r[j, k]) for j in range(m) if j not in (i, k))
                new[i, k] = up if i == k else min(0.0, r[k, k] + up)
        a = damping * a + (1 - damping) * new
        now = [bool(r[k, k] + a[k, k] > 0) for k in range(m)]
        same = same + 1 if now == (last or [False] * m) else 0
        last = now
        if same >= unchanged and any(now):
            break
    return [k for k in range(m) if last[k]], done


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_messages_by_force(seed):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(c, 0.4, (7, 2)) for c in ((0, 0), (4, 1), (-3, 5))])
    s = X.similarities(np.ones(21, np.int64), x, np.zeros(21))
    heads, done = by_force(s, 0.75, 200, 15)
    to, rounds = X.exemplars(s)
    assert rounds == done < 200 and len(heads) == len(set(to)) and (to[list(set(to))] == list(set(to))).all()
    for i in range(21):
        assert to[i] == max(set(to.tolist()), key=lambda h: s[i, h]) or to[i] == i
    assert len({int(t) for t in to[:7]} & {int(t) for t in to[7:14]}) == 0


def test_weights_stand_for_equal_rows(spark):
    x = [[0.0, 0.0]] * 30 + [[5.0, 5.0]] * 25 + [[-5.0, 5.0]] * 20 + [[0.1, 0.0], [5.1, 5.0], [0.0, 0.1]]
    points = spark.createDataFrame(list(enumerate(x)), "doc_id long, v array<double>")
    got = X.affinity_propagation(points).toPandas().sort_values("doc_id")
    assert got.doc_id.tolist() == list(range(78))
    assert got.cluster.tolist() == [0] * 30 + [1] * 25 + [2] * 20 + [0, 1, 0]
    assert set(got.exemplar) == {0, 30, 55}
    assert X.median(np.array([3.0, 1.0, 2.0]), np.array([1, 2, 1])) == np.median([3, 1, 1, 2])
    one = spark.createDataFrame([(7, [1.0])], "doc_id long, v array<double>")
    assert [tuple(r) for r in X.affinity_propagation(one).collect()] == [(7, 0, 7)]
    assert X.affinity_propagation(one.limit(0)).count() == 0


def test_registered(spark):
    got = E.queries()["affinity_propagation_embeddings"](spark, SF_SMALL).toPandas()
    assert got.doc_id.is_unique and got.exemplar.isin(got.doc_id).all() and (got[got.doc_id.isin(got.exemplar)].eval("doc_id == exemplar")).all()
    assert 1 < got.cluster.nunique() < len(got) / 2
