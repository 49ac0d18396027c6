"""Feature-selection criteria over category × term.

With u documents: A = in category with term, B = outside with term,
C = in category without, D = neither.  A comes from one aggregate over the
distinct (doc, term) pairs; B, C, D follow from df, category sizes and u,
so no per-document scan is repeated per category.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from verbum.functions.joins import scalar
from verbum.operators.weighting import document_frequency

# Categories are enumerated into each vocabulary row when there are at most
# this many; beyond it the skeleton is built by a distributed cartesian join.
MAX_INLINE_CATEGORIES = 10_000


def _plog2(x: Column) -> Column:
    """log2 for positive x, NULL otherwise (the reference's NaN)."""
    return F.when(x > 0, F.log2(x))


def _ig_cell(x, row, col, u) -> Column:
    return F.when(x == 0, F.lit(0.0)).otherwise(x / u * F.log2(u * x / (row * col)))


def category_term_skeleton(vocab: DataFrame, cats: DataFrame, label_col: str = "label") -> DataFrame:
    """Every (category, term) pair.  The category list is small and its size
    is checked; it is enumerated inside each vocabulary row."""
    n = scalar(cats.agg(F.count("*").alias("n")), "n")
    if n <= MAX_INLINE_CATEGORIES:
        rows = cats.collect()
        arr = F.array(*[F.struct(F.lit(r[label_col]).alias(label_col), F.lit(r["n_cat"]).alias("n_cat"))
                        for r in rows])
        return vocab.select("*", F.explode(arr).alias("_c")).select("*", "_c.*").drop("_c")
    return vocab.crossJoin(cats)


def contingency(tf: DataFrame, label_col: str = "label", docs: DataFrame | None = None) -> DataFrame:
    """``(label, term, a, b, c, d, u)`` for every category and term.

    ``tf`` is a (doc_id, label, term, ...) table unique per (doc, term);
    ``docs`` (doc_id, label) lists every document, including ones without
    tokens (default: the documents present in ``tf``)."""
    pairs = tf.select("doc_id", label_col, "term")
    docs = (docs if docs is not None else pairs).select("doc_id", label_col).distinct()
    cats = docs.groupBy(label_col).agg(F.count("*").alias("n_cat"))
    u = scalar(docs.agg(F.count("*").alias("u")), "u")
    dfreq = document_frequency(pairs)
    a = pairs.groupBy(label_col, "term").agg(F.count("*").alias("a"))
    sk = category_term_skeleton(dfreq, cats, label_col)
    t = sk.join(a, [label_col, "term"], "left").withColumn("a", F.coalesce("a", F.lit(0)))
    return t.select(label_col, "term", "a",
                    (F.col("df") - F.col("a")).alias("b"),
                    (F.col("n_cat") - F.col("a")).alias("c"),
                    (F.lit(u) - F.col("n_cat") - F.col("df") + F.col("a")).alias("d"),
                    F.lit(u).alias("u"))


def criteria(cont: DataFrame) -> DataFrame:
    """MI, IG and CHI² from the contingency table.

    MI = log2(A·u / ((A+C)(A+B))), NULL when not positive;
    IG = Σ_cells x/u·log2(u·x / (row·col)), a zero cell contributes 0;
    CHI = u(AD−CB)² / ((A+C)(B+D)(A+B)(C+D)), NULL for a zero denominator."""
    a, b, c, d, u = (F.col(x).cast("double") for x in ("a", "b", "c", "d", "u"))
    mi = F.when(F.col("a") == 0, F.lit(None).cast("double")).otherwise(_plog2(a * u / ((a + c) * (a + b))))
    ig = (_ig_cell(a, a + b, a + c, u) + _ig_cell(c, c + d, a + c, u)
          + _ig_cell(b, a + b, b + d, u) + _ig_cell(d, c + d, b + d, u))
    den = (a + c) * (b + d) * (a + b) * (c + d)
    chi = F.when(den == 0, F.lit(None).cast("double")).otherwise(u * (a * d - c * b) * (a * d - c * b) / den)
    return cont.select("*", mi.alias("mi"), ig.alias("ig"), chi.alias("chi"))


def top_terms_by(crit: DataFrame, measure: str, k: int = 10, label_col: str = "label") -> DataFrame:
    """Best k terms per category by one criterion (NULLs last, ties by term)."""
    from pyspark.sql import Window
    w = Window.partitionBy(label_col).orderBy(F.col(measure).desc_nulls_last(), "term")
    return crit.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
