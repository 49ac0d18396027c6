"""Affinity propagation over clustering features.

Every pair of nodes exchanges two messages, so the nodes are the at most
``max_leaves`` features of the rows and not the rows: a feature of n rows
counts n times in the similarity to its exemplar, and its own spread is taken
off its preference.  Where features are single rows this is the plain method.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from verbum.operators.hierarchy import MAX_LEAVES, assign, features

DAMPING, ROUNDS, UNCHANGED = 0.75, 200, 15


def median(values: np.ndarray, weights: np.ndarray) -> float:
    """Median of values that count as often as their weights say."""
    order = np.argsort(values, kind="stable")
    upto = np.cumsum(weights[order])
    total = int(upto[-1])
    return float(sum(values[order[np.searchsorted(upto, k, "right")]] for k in ((total - 1) // 2, total // 2)) / 2)


def similarities(n: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Negative squared distances, once for each row of the feature; on the
    diagonal the median over all pairs of rows, less the feature's spread."""
    d2 = np.stack([((mean - x) ** 2).sum(1) for x in mean])
    s = -d2 * n[:, None]
    np.fill_diagonal(s, median(-d2.ravel(), np.outer(n, n).ravel()) - spread)
    # equal nodes would wait for each other for ever; a fixed, far smaller unevenness decides
    return s + 1e-12 * np.abs(s).max(initial=1.0) * np.random.default_rng(0).random(s.shape)


def exemplars(s: np.ndarray, damping: float = DAMPING, rounds: int = ROUNDS, unchanged: int = UNCHANGED) -> tuple[np.ndarray, int]:
    """The exemplar of each node and the number of rounds: responsibilities and
    availabilities are exchanged until the set of exemplars has stayed the
    same, and not empty, for ``unchanged`` rounds, or ``rounds`` are over.
    Without any exemplar all nodes get -1."""
    m = len(s)
    if m == 1:
        return np.zeros(1, np.int64), 0
    every = np.arange(m)
    respond, avail = np.zeros((m, m)), np.zeros((m, m))
    chosen, same, done = np.zeros(m, bool), 0, 0
    for done in range(1, rounds + 1):
        total = avail + s
        first = total.argmax(1)
        best = total[every, first]
        total[every, first] = -np.inf
        rival = np.repeat(best[:, None], m, 1)
        rival[every, first] = total.max(1)
        respond = damping * respond + (1 - damping) * (s - rival)
        support = np.maximum(respond, 0)
        support[every, every] = respond[every, every]
        support = support.sum(0)[None] - support
        own = support[every, every].copy()
        support = np.minimum(support, 0)
        support[every, every] = own
        avail = damping * avail + (1 - damping) * support
        now = (respond + avail)[every, every] > 0
        same = same + 1 if (now == chosen).all() else 0
        chosen = now
        if same >= unchanged and chosen.any():
            break
    heads = np.flatnonzero(chosen)
    if not len(heads):
        return np.full(m, -1, np.int64), done

    def nearest(heads):
        to = heads[s[:, heads].argmax(1)]
        to[heads] = heads
        return to
    to = nearest(heads)
    # inside a cluster the node that all are most alike to stands for it
    inside = [np.flatnonzero(to == h) for h in heads]
    return nearest(np.array([i[s[np.ix_(i, i)].sum(0).argmax()] for i in inside])), done


def affinity_propagation(points: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS, unchanged: int = UNCHANGED,
                         threshold: float = 0.0, max_leaves: int = MAX_LEAVES) -> DataFrame:
    """``(doc_id, cluster, exemplar)`` for every row of ``points(doc_id,
    v)``: clusters are numbered from 0 in the order of their exemplar, the
    smallest id of the exemplary feature; without one both are -1."""
    leaves = features(points, threshold, max_leaves)

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["leaf", "n", "ss"])
        leaf, n = pdf["leaf"].to_numpy(), pdf["n"].to_numpy()
        ls = np.array([np.asarray(x) for x in pdf["ls"]])
        spread = np.maximum(pdf["ss"].to_numpy() - (ls ** 2).sum(1) / n, 0)
        to, _ = exemplars(similarities(n, ls / n[:, None], np.where(n == 1, 0.0, spread)), damping, rounds, unchanged)
        heads = np.unique(to)
        cluster = np.where(to < 0, -1, np.searchsorted(heads, to))
        return pd.DataFrame({"leaf": leaf, "cluster": cluster, "exemplar": np.where(to < 0, -1, leaf[to])})

    found = leaves.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(work, "leaf long, cluster long, exemplar long")
    return assign(points, leaves).join(F.broadcast(found), "leaf").select("doc_id", "cluster", "exemplar")
