"""Groups of near copies, some linked and some just not, against all pairs."""

import numpy as np
import pytest

from tests.llm.test_llm import components_by_force
from verbum.llm import neardup


def group(rng, start, core, copies, most):
    """Copies of ``core`` with up to ``most`` words of their own."""
    for d in range(copies):
        w = list(core)
        for k in rng.choice(len(w), int(rng.integers(0, most + 1)), replace=False):
            w[k] = f"own{start + d}x{k}" if rng.random() < 0.7 else f"common{k}"
        yield start + d, w


@pytest.mark.parametrize("width", [2, 5])
def test_groups_by_force(spark, width):
    rng = np.random.default_rng(3)
    core = [f"c{i}" for i in range(80)]
    other = [f"o{i}" for i in range(60)]
    rows = [(d, " ".join(w)) for d, w in group(rng, 1000, core, 150, 14 if width == 2 else 6)]
    rows += [(d, " ".join(w)) for d, w in group(rng, 2000, other, 60, 10 if width == 2 else 4)]
    # texts that hold the passage and words of their own, short parts of it, and copies of those
    rows += [(3000 + d, " ".join(core + [f"t{d}x{i}" for i in range(int(n))])) for d, n in enumerate(rng.integers(5, 200, 40))]
    rows += [(4000 + d, " ".join(core[:int(n)])) for d, n in enumerate(rng.integers(20, 80, 40))]
    rows += [(5000, " ".join(core + other)), (5001, " ".join(other + core)), (900, rows[7][1])]
    table = spark.createDataFrame([rows[i] for i in rng.permutation(len(rows))], "doc_id long, text string")
    got = neardup.near_duplicates(spark, table, width=width).toPandas()
    want = components_by_force(rows, width, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.itertuples()} == want
    assert 10 < len({c for _, c in want.values()}) < 300


def test_links_between_components(spark):
    """All members in one bucket and no link found before: every component must come out."""
    rng = np.random.default_rng(5)
    core = [f"c{i}" for i in range(60)]
    rows = [(d, " ".join(w)) for d, w in group(rng, 10, core, 90, 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sketch = neardup.sketches(docs, 2)
    nodes = sketch.selectExpr("doc_id AS node", "h1", "h2", "n_shingles AS n", "mins")
    mixed = nodes.selectExpr("1L AS key", "node", "n", "10L AS head")
    none = spark.createDataFrame([], "u long, v long")
    links = neardup.group_links(spark, docs, nodes, mixed, none, 2, 80)
    comp = {r.node: r.comp for r in neardup.components(spark, links).collect()}
    want = components_by_force(rows, 2, 80)
    assert {d: comp.get(d, d) for d, _ in rows} == {d: c for d, (_, c) in want.items()}
    assert 3 < len({c for _, c in want.values()}) < 90
