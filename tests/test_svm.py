"""The distributed hinge solver and its probabilities against plain numpy."""

import numpy as np
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from verbum.operators import svm


def by_force(x, y, c, rounds=4000):
    """Dual coordinate ascent over all rows, far beyond the gap asked for."""
    x = np.hstack([x, np.ones((len(x), 1))])
    a, w = np.zeros(len(x)), np.zeros(x.shape[1])
    for _ in range(rounds):
        for i in range(len(x)):
            new = np.clip(a[i] + (1 - y[i] * (x[i] @ w)) / (x[i] @ x[i]), 0, c)
            w += (new - a[i]) * y[i] * x[i]
            a[i] = new
    return w


def made(spark, n, classes, seed):
    rng = np.random.default_rng(seed)
    label = rng.integers(0, classes, n)
    x = np.where(rng.random((n, 6)) < 0.7, rng.normal(size=(n, 6)), 0.0)
    x[np.arange(n), label] += 1.5
    split = np.where(np.arange(n) % 4 == 0, "test", "train")
    rows = spark.createDataFrame([(i, [int(j) * 1000 for j in np.flatnonzero(r)], [float(v) for v in r[r != 0]]) for i, r in enumerate(x)],
                                 "doc_id long, idx array<int>, val array<double>")
    docs = spark.createDataFrame([(i, f"class{k}", s) for i, (k, s) in enumerate(zip(label.tolist(), split.tolist()))], "doc_id long, label string, split string")
    return x, label, split, rows, docs


@pytest.mark.parametrize("block_rows, gap, near", [(1000, 1e-4, 0.05), (40, 1e-2, 0.3)])
def test_weights_of_two_classes(spark, block_rows, gap, near):
    x, label, split, rows, docs = made(spark, 80, 2, 5)
    got = svm.fit(rows, docs, c=1.0, gap=gap, block_rows=block_rows)
    t = split == "train"
    want = by_force(x[t], np.where(label[t] == 1, 1.0, -1.0), 1.0)
    assert got.labels == ["class0", "class1"] and got.used.tolist() == [0, 1000, 2000, 3000, 4000, 5000] and (got.gap <= gap).all()
    assert np.allclose(got.weights[0], want, atol=near)


def test_folds_and_probabilities_of_three_classes(spark):
    x, label, split, rows, docs = made(spark, 160, 3, 8)
    got = svm.probabilities(rows, docs, gap=1e-3).toPandas()
    wide = got.pivot(index="doc_id", columns="label", values="probability")
    assert wide.index.tolist() == np.flatnonzero(split == "test").tolist()
    assert np.allclose(wide.sum(axis=1), 1.0) and (wide.to_numpy() > 0).all()
    truth = label[wide.index]
    assert np.log(wide.to_numpy()[np.arange(len(wide)), truth]).mean() > np.log(1 / 3) + 0.2       # better than even odds
    named = got.drop_duplicates("doc_id").set_index("doc_id").predicted
    assert (named.loc[wide.index] == [f"class{k}" for k in truth]).mean() > 0.6
    t = split == "train"
    f = np.stack([np.hstack([x, np.ones((len(x), 1))]) @ by_force(x[t], np.where(label[t] == k, 1.0, -1.0), 1.0, 1000) for k in range(3)], 1)
    clear = np.sort(f, 1)[:, -1] - np.sort(f, 1)[:, -2] > 0.1
    assert all(named[i] == f"class{f[i].argmax()}" for i in wide.index if clear[i])


def test_unseen_margins_and_odd_tables(spark):
    _, label, split, rows, docs = made(spark, 60, 2, 3)
    m = svm.fit(rows, docs, folds=3, gap=1e-3)
    assert m.weights.shape[0] == 4 and m.fold.tolist() == [-1, 0, 1, 2]
    part = {r["doc_id"]: r["p"] for r in docs.select("doc_id", svm.part_of(3).alias("p")).collect()}
    without = docs.filter(~docs.doc_id.isin([d for d, p in part.items() if p == 1]))
    alone = svm.fit(rows, without, gap=1e-3)
    assert np.allclose(m.weights[2], alone.weights[0], atol=0.1)
    extra = docs.unionByName(spark.createDataFrame([(900, None, "test")], docs.schema))       # no features
    assert svm.predictions(rows, extra).count() == (split == "test").sum() + 1
    assert svm.probabilities(rows, docs.filter("label = 'class1' OR split = 'test'")).filter("probability < 1").count() == 0
    assert svm.probabilities(rows, docs.limit(0)).count() == 0
    assert svm.predictions(rows.limit(0), docs).select("predicted").distinct().count() == 1


def test_registered_probabilities(spark):
    got = E.queries()["svm_linear_probabilities"](spark, SF_SMALL).toPandas()
    assert len(got) and np.allclose(got.groupby("doc_id").probability.sum(), 1.0)
    named = E.queries()["svm_linear_predictions"](spark, SF_SMALL).toPandas().set_index("doc_id").predicted
    both = got.drop_duplicates("doc_id").set_index("doc_id").predicted
    assert (both == named.loc[both.index]).mean() > 0.95       # both within the gap of one optimum
