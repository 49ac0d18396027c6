"""LLSF and its least-squares solver against numpy's pseudo-inverse."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from verbum.operators import leastsquares as LS, preprocess as P, weighting as W
from verbum.sources import tables

CLASSES = [(1, "китайский пекин китайский", "china", "train"), (2, "китайский китайский шанхай", "china", "train"),
           (3, "китайский китайский макао", "china", "train"), (4, "токио япония китайский", "not_china", "train"),
           (5, "китайский китайский китайский токио япония", None, "test"), (6, "чужое слово", None, "test")]


@pytest.mark.parametrize("shape", [(8, 14), (14, 8)])
def test_least_norm_solution(spark, shape):
    rng = np.random.default_rng(sum(shape))
    a = np.where(rng.random(shape) < 0.4, rng.random(shape), 0.0)
    a[3] = a[1]                                  # equal rows with different targets
    a[:, 2] = a[:, 5] + 0.0                            # equal columns
    b = rng.integers(0, 2, (shape[0], 2)).astype(float)
    entries = spark.createDataFrame([(int(i), f"t{j}", float(a[i, j])) for i, j in zip(*np.nonzero(a))], "doc_id int, term string, w double")
    targets = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(b)], "doc_id int, u double, `v.w` double")
    x, steps = LS.least_squares(entries, targets, ["u", "v.w"], tolerance=1e-9)
    got = {r["term"]: (r["u"], r["v.w"]) for r in x.collect()}
    want = np.linalg.pinv(a) @ b
    assert steps <= min(shape)
    for j in range(shape[1]):
        assert np.allclose(got.get(f"t{j}", (0, 0)), want[j], atol=1e-4)


def test_fixture_scores(spark):
    docs = spark.createDataFrame(CLASSES, "doc_id int, text string, label string, split string")
    tf = docs.select("doc_id", "split", F.explode(F.split("text", " ")).alias("term")).groupBy("doc_id", "split", "term").agg(F.count("*").alias("n"))
    a9 = W.train_tfidf(tf).filter(~F.isnan("w")).select("doc_id", "term", "w")
    got = {(r["doc_id"], r["label"]): r["score"] for r in LS.llsf(a9, docs).collect()}
    assert got == {(5, "china"): 0.0, (5, "not_china"): 1.0, (6, "china"): 0.0, (6, "not_china"): 0.0}


def test_scores_of_documents_by_force(spark):
    lab = tables.labelled_corpus(spark, SF_SMALL)
    a9 = W.train_tfidf(W.term_frequency(P.class_tokens(lab, keep=("split",)), keep=("split",))).filter(~F.isnan("w")).select("doc_id", "term", "w").toPandas()
    docs = lab.select("doc_id", "label", "split").toPandas().set_index("doc_id")
    wide = a9.pivot(index="doc_id", columns="term", values="w").fillna(0.0)
    train = wide[docs.loc[wide.index, "split"] == "train"]
    classes = sorted(docs[docs.split == "train"].label.unique())
    b = np.stack([(docs.loc[train.index, "label"] == c).to_numpy(float) for c in classes], 1)
    f = np.linalg.pinv(train.to_numpy(), rcond=1e-9) @ b
    got = E.queries()["llsf_scores"](spark, SF_SMALL).toPandas()
    assert set(got.doc_id) == set(docs[docs.split == "test"].index)
    for r in got.itertuples():
        want = wide.loc[r.doc_id].to_numpy() @ f[:, classes.index(r.label)] if r.doc_id in wide.index else 0.0
        assert abs(r.score - want) <= 0.0052
