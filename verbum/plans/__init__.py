"""Registered queries: each pairs a Spark plan over the driver tables with
the equivalent DuckDB SQL (or none, for operators that SQL cannot express)."""

from verbum.plans.registry import QUERIES, ORACLES, query  # noqa: F401


def load_all():
    """Import every plan module so that its queries register themselves."""
    from verbum.plans import (preprocessing, weighting, criteria, itemsets,  # noqa: F401
                              similarity, classification, clustering, morphology,
                              summaries, lsa, ml, hierarchies)
    return QUERIES, ORACLES
