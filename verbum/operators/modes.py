"""Mean shift over dense rows of few dimensions.

Seeds are the occupied bins of a grid as wide as the bandwidth.  A seed's path
depends on the rows alone, so seeds move in blocks that are sent to the rows;
every task returns a count and a sum for each seed of the block, and the rows
themselves are never shuffled, whatever share of them one place holds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from verbum.operators.hierarchy import features, matrix

BLOCK = 2048           # seeds that are moved at a time
MAX_SEEDS = 65_536     # bins that may be occupied: more mean too many dimensions for a grid
MAX_STEPS = 300        # steps of one seed


def bandwidth(points: DataFrame, quantile: float = 0.4, threshold: float = 0.01) -> float:
    """Mean distance of the rows to their ``quantile`` nearest neighbour, the row
    itself counted, over clustering features in place of rows: exact as long as
    the features hold equal rows only, else off by their radius at most twice.
    A quantile below one row is raised to 1/n + 0.05; a width of 0 to 0.1."""
    found = features(points, threshold).collect()                   # bounded, see `features`
    n = np.array([r["n"] for r in found], np.int64)
    if not len(n):
        return 0.1
    mean = np.array([np.array(r["ls"]) / r["n"] for r in found])
    rows = int(n.sum())
    if rows * quantile < 1:
        quantile = 1 / rows + 0.05
    k = max(1, int(rows * quantile))
    total = 0.0
    for i in range(len(n)):
        d = np.sqrt(((mean - mean[i]) ** 2).sum(1))
        order = np.argsort(d, kind="stable")
        total += n[i] * d[order[np.searchsorted(np.cumsum(n[order]), k)]]
    return float(total / rows) or 0.1


def _near(points: DataFrame, seeds: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray]:
    """How many rows lie within ``width`` of each seed, and their mean."""
    dims = seeds.shape[1]
    names = [f"s{k}" for k in range(dims)]

    def work(batches):
        n, sums = np.zeros(len(seeds), np.int64), np.zeros((len(seeds), dims))
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                x = matrix(batch.column(0).slice(lo, 512))
                near = np.zeros((len(seeds), len(x)))
                for k in range(dims):
                    near += (seeds[:, k, None] - x[:, k]) ** 2
                near = near <= width * width
                n += near.sum(1)
                sums += near @ x
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at]), *[pa.array(sums[at, k]) for k in range(dims)]], ["seed", "n", *names])

    shape = "seed long, n long, " + ", ".join(f"{c} double" for c in names)
    found = points.select("v").mapInArrow(work, shape).groupBy("seed").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in names]).collect()
    n, mean = np.zeros(len(seeds), np.int64), seeds.copy()
    for r in found:
        n[r["seed"]] = r["n"]
        mean[r["seed"]] = [r[c] / r["n"] for c in names]
    return n, mean


def modes(points: DataFrame, width: float) -> tuple[np.ndarray, np.ndarray]:
    """Means and row counts of the modes, the fullest first (ties: by
    coordinates, the larger first); a mode within ``width`` of a fuller one is
    part of it."""
    bins = points.select(F.transform("v", lambda x: F.rint(x / F.lit(width))).alias("b")).distinct()
    seeds = np.array([r["b"] for r in bins.orderBy("b").limit(MAX_SEEDS + 1).collect()], np.float64) * width
    if len(seeds) > MAX_SEEDS:
        raise ValueError(f"more than {MAX_SEEDS} bins are occupied; reduce the dimensions first")
    ends, counts = [], []
    for lo in range(0, len(seeds), BLOCK):
        now = seeds[lo:lo + BLOCK] + 0.0
        for _ in range(MAX_STEPS):
            n, mean = _near(points, now, width)
            now, mean, n = now[n > 0], mean[n > 0], n[n > 0]         # a bin's corner may have no row in reach
            still = np.linalg.norm(mean - now, axis=1) <= 1e-3 * width
            ends.append(mean[still])
            counts.append(n[still])
            # seeds that met go on as one
            now = np.unique(mean[~still], axis=0)
            if not len(now):
                break
        else:
            n, mean = _near(points, now, width)
            ends.append(mean)
            counts.append(n)
    if not ends:
        return np.zeros((0, 0)), np.zeros(0, np.int64)
    x, n = np.concatenate(ends), np.concatenate(counts)
    order = np.lexsort((*-x.T[::-1], -n))
    x, n = x[order], n[order]
    kept: list[int] = []
    for k in range(len(x)):
        if not kept or np.linalg.norm(x[kept] - x[k], axis=1).min() > width:
            kept.append(k)
    return x[kept], n[kept]


def mean_shift(points: DataFrame, width: float | None = None, quantile: float = 0.4) -> DataFrame:
    """``(doc_id, cluster)``, every row of ``points(doc_id, v)`` with the
    nearest mode, numbered from the fullest (0); ties go to the fuller mode."""
    width = bandwidth(points, quantile) if width is None else width
    centres, _ = modes(points, width)

    def work(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                x = matrix(part.column(1))
                d = np.stack([((x - c) ** 2).sum(1) for c in centres], 1) if len(x) else np.zeros((0, 1))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.round(d, 12).argmin(1))], ["doc_id", "cluster"])

    return points.select("doc_id", "v").mapInArrow(work, "doc_id long, cluster long")
