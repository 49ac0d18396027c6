"""Feature-selection criteria queries (F1–F5) on ``documents ⋈ labels``."""

from __future__ import annotations

from verbum.operators import criteria as C, preprocess as P, weighting as W
from verbum.plans import sqlparts as Q
from verbum.plans.registry import query
from verbum.sources import tables

_CONT = f"""{Q.labelled()}, {Q.class_tokens('lab', ', label')},
pairs AS (SELECT DISTINCT doc_id, label, token AS term FROM ctoks),
docs AS (SELECT DISTINCT doc_id, label FROM pairs),
cats AS (SELECT label, COUNT(*) AS n_cat FROM docs GROUP BY label),
uu AS (SELECT COUNT(*)::DOUBLE AS u FROM docs),
dfr AS (SELECT term, COUNT(*) AS df FROM pairs GROUP BY term),
aa AS (SELECT label, term, COUNT(*) AS a FROM pairs GROUP BY label, term),
cont AS (
  SELECT cats.label, dfr.term, COALESCE(aa.a, 0)::DOUBLE AS a, (dfr.df - COALESCE(aa.a, 0))::DOUBLE AS b,
         (cats.n_cat - COALESCE(aa.a, 0))::DOUBLE AS c,
         (uu.u - cats.n_cat - dfr.df + COALESCE(aa.a, 0))::DOUBLE AS d, uu.u
  FROM cats CROSS JOIN dfr CROSS JOIN uu
  LEFT JOIN aa ON aa.label = cats.label AND aa.term = dfr.term),
crit AS (
  SELECT label, term, a, b, c, d,
    CASE WHEN a = 0 THEN NULL ELSE log2(a * u / ((a + c) * (a + b))) END AS mi,
    (CASE WHEN a = 0 THEN 0 ELSE a / u * log2(u * a / ((a + b) * (a + c))) END
     + CASE WHEN c = 0 THEN 0 ELSE c / u * log2(u * c / ((c + d) * (a + c))) END
     + CASE WHEN b = 0 THEN 0 ELSE b / u * log2(u * b / ((a + b) * (b + d))) END
     + CASE WHEN d = 0 THEN 0 ELSE d / u * log2(u * d / ((c + d) * (b + d))) END) AS ig,
    CASE WHEN (a + c) * (b + d) * (a + b) * (c + d) = 0 THEN NULL
         ELSE u * (a * d - c * b) * (a * d - c * b) / ((a + c) * (b + d) * (a + b) * (c + d)) END AS chi
  FROM cont)"""


def _crit(spark, sf):
    lab = tables.labelled_corpus(spark, sf)
    tf = W.term_frequency(P.class_tokens(lab, keep=("label",)), keep=("label",))
    return C.criteria(C.contingency(tf))


@query("criteria_mi_ig_chi", sql=f"""
WITH {_CONT}
SELECT label, term, a::BIGINT AS a, b::BIGINT AS b, c::BIGINT AS c, d::BIGINT AS d,
       round(mi, 6) AS mi, round(ig, 6) + 0.0 AS ig, round(chi, 6) AS chi FROM crit""")
def q_criteria(spark, sf):
    """Contingency counts and MI / IG / CHI² per (class, term)."""
    return _crit(spark, sf).select("label", "term", "a", "b", "c", "d", "mi", "ig", "chi")


@query("criteria_top_chi", sql=f"""
WITH {_CONT},
rk AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY chi DESC NULLS LAST, term) AS rank FROM crit)
SELECT label, rank::BIGINT AS rank, term, round(chi, 6) AS chi, round(mi, 6) AS mi FROM rk WHERE rank <= 20""")
def q_criteria_top(spark, sf):
    """Top-20 terms per class by CHI² (the criteria's natural report)."""
    return C.top_terms_by(_crit(spark, sf), "chi", k=20).select("label", "rank", "term", "chi", "mi")


@query("document_frequency", sql=f"""
WITH {Q.labelled()}, {Q.class_tokens('lab')}
SELECT token AS term, COUNT(DISTINCT doc_id)::BIGINT AS df FROM ctoks GROUP BY token""")
def q_df(spark, sf):
    """the DF table of the labelled corpus."""
    lab = tables.labelled_corpus(spark, sf)
    return W.document_frequency(W.term_frequency(P.class_tokens(lab)))
