"""Term statistics and weighting queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from verbum.operators import preprocess as P, weighting as W
from verbum.plans import sqlparts as Q
from verbum.plans.registry import query
from verbum.sources import tables

# classification-token tf over the whole corpus (shared by several oracles)
_CTF = f"""{Q.class_tokens()},
tf AS (SELECT doc_id, token AS term, COUNT(*)::BIGINT AS n FROM ctoks GROUP BY doc_id, token),
nd AS (SELECT COUNT(DISTINCT doc_id)::DOUBLE AS n_docs FROM tf),
dfr AS (SELECT term, COUNT(*)::BIGINT AS df FROM tf GROUP BY term)"""

_TFIDF = f"""{_CTF},
tfidf AS (
  SELECT tf.doc_id, tf.term, tf.n,
         tf.n::DOUBLE / SUM(tf.n) OVER (PARTITION BY tf.doc_id) * log10(nd.n_docs / dfr.df) AS tfidf
  FROM tf JOIN dfr ON tf.term = dfr.term CROSS JOIN nd)"""


def _ctf(spark, sf):
    return W.term_frequency(P.class_tokens(tables.documents(spark, sf)))


@query("tfidf_top_terms", sql=f"""
WITH {_TFIDF},
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY tfidf DESC, term) AS rank FROM tfidf)
SELECT doc_id, rank::BIGINT AS rank, term, n, round(tfidf, 6) AS tfidf FROM ranked WHERE rank <= 5""")
def q_tfidf_top_terms(spark, sf):
    """Flagship: P5 → A1 → A4 → A6 → five best terms per document."""
    top = W.top_terms(W.tfidf(_ctf(spark, sf)), k=5)
    return top.select("doc_id", "rank", "term", "n", "tfidf")


@query("word_frequency", sql=f"""
WITH {Q.tokens()},
tf AS (SELECT doc_id, token AS term, COUNT(*)::BIGINT AS n FROM tokens GROUP BY doc_id, token)
SELECT doc_id, term, n, (row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, term))::BIGINT AS rank FROM tf""")
def q_word_frequency(spark, sf):
    """A1 on pass-through tokens (P16), ranked inside each document."""
    return W.ranked_frequency(W.term_frequency(P.passthrough(tables.documents(spark, sf))))


@query("doc_length", sql=f"""
WITH {Q.tokens()}
SELECT doc_id, COUNT(*)::BIGINT AS n_tokens FROM tokens GROUP BY doc_id""")
def q_doc_length(spark, sf):
    """A2: token total per document."""
    return W.doc_length(W.term_frequency(P.tokens(tables.documents(spark, sf))))


@query("vocabulary", sql=f"""
WITH {Q.class_tokens()}
SELECT token AS term, COUNT(*)::BIGINT AS n FROM ctoks GROUP BY token""")
def q_vocabulary(spark, sf):
    """A3: corpus vocabulary and totals."""
    return W.vocabulary(_ctf(spark, sf))


@query("class_term_counts", sql=f"""
WITH {Q.labelled()}, {Q.class_tokens('lab', ', label')}
SELECT label, token AS term, COUNT(*)::BIGINT AS n FROM ctoks GROUP BY label, token""")
def q_class_term_counts(spark, sf):
    """A3: per-class word counts on the labelled corpus."""
    lab = tables.labelled_corpus(spark, sf)
    tf = W.term_frequency(P.class_tokens(lab, keep=("label",)), keep=("label",))
    return W.class_term_counts(tf)


@query("idf", sql=f"""
WITH {_CTF}
SELECT term, df, round(log10(nd.n_docs / df), 6) AS idf FROM dfr CROSS JOIN nd""")
def q_idf(spark, sf):
    """A4 + A5: document frequency and log10(N/df)."""
    tf = _ctf(spark, sf)
    return W.idf(W.document_frequency(tf), W.n_documents(tf))


@query("tfidf", sql=f"""
WITH {_TFIDF}
SELECT doc_id, term, n, round(tfidf, 6) AS tfidf FROM tfidf""")
def q_tfidf(spark, sf):
    """Full TF-IDF table."""
    return W.tfidf(_ctf(spark, sf)).select("doc_id", "term", "n", "tfidf")


@query("tfidf_pruned", sql=f"""
WITH {_TFIDF}
SELECT doc_id, term, round(tfidf, 6) AS tfidf FROM (
  SELECT *, MAX(tfidf) OVER (PARTITION BY doc_id) AS mx FROM tfidf) WHERE tfidf >= 0.5 * mx""")
def q_tfidf_pruned(spark, sf):
    """Keep terms with at least half the document's best weight."""
    return W.prune_by_max(W.tfidf(_ctf(spark, sf)), 0.5).select("doc_id", "term", "tfidf")


@query("l2_weights", sql=f"""
WITH {_CTF},
raw AS (SELECT tf.doc_id, tf.term, tf.n * log10(nd.n_docs / dfr.df) AS w
        FROM tf JOIN dfr ON tf.term = dfr.term CROSS JOIN nd),
nz AS (SELECT * FROM raw WHERE w <> 0)
SELECT doc_id, term, round(w / sqrt(SUM(w * w) OVER (PARTITION BY doc_id)), 6) AS w FROM nz""")
def q_l2_weights(spark, sf):
    """n·log10(N/df), L2-normalised rows."""
    return W.l2_weights(_ctf(spark, sf))


_TRAIN_TFIDF = f"""{Q.labelled()}, {Q.class_tokens('lab', ', split, label')},
tf AS (SELECT doc_id, split, label, token AS term, COUNT(*)::BIGINT AS n FROM ctoks GROUP BY ALL),
d AS (SELECT COUNT(DISTINCT doc_id)::DOUBLE AS d FROM tf WHERE split = 'train'),
dfr AS (SELECT term, COUNT(*) AS df FROM tf WHERE split = 'train' GROUP BY term),
raw AS (SELECT tf.doc_id, tf.split, tf.label, tf.term, tf.n * log10(d.d / dfr.df) AS w
        FROM tf JOIN dfr ON tf.term = dfr.term CROSS JOIN d),
a9 AS (SELECT doc_id, split, label, term,
              round_even(w / sqrt(SUM(w * w) OVER (PARTITION BY doc_id)), 2) AS w FROM raw)"""


@query("train_tfidf", sql=f"""
WITH {_TRAIN_TFIDF}
SELECT doc_id, split, term, w FROM a9 WHERE w IS NOT NULL AND NOT isnan(w)""")
def q_train_tfidf(spark, sf):
    """Train-fitted TF-IDF for train and test documents, rounded to 2."""
    lab = tables.labelled_corpus(spark, sf)
    tf = W.term_frequency(P.class_tokens(lab, keep=("split",)), keep=("split",))
    return W.train_tfidf(tf).filter(~F.isnan("w")).select("doc_id", "split", "term", "w")


@query("smoothed_tfidf_sums", sql=f"""
WITH {Q.lib_tokens()},
tf AS (SELECT doc_id, token AS term, COUNT(*) AS n FROM ltoks GROUP BY doc_id, token),
nd AS (SELECT COUNT(DISTINCT doc_id)::DOUBLE AS n_docs FROM tf),
dfr AS (SELECT term, COUNT(*) AS df FROM tf GROUP BY term),
raw AS (SELECT tf.doc_id, tf.term, tf.n * (ln((1 + nd.n_docs) / (1 + dfr.df)) + 1) AS w
        FROM tf JOIN dfr ON tf.term = dfr.term CROSS JOIN nd),
nw AS (SELECT term, w / sqrt(SUM(w * w) OVER (PARTITION BY doc_id)) AS w FROM raw)
SELECT term, round(SUM(w), 6) AS w_sum FROM nw GROUP BY term""")
def q_smoothed(spark, sf):
    """A10: smoothed TF-IDF (library analyser), summed per term."""
    tf = W.term_frequency(P.library_tokens(tables.documents(spark, sf)))
    return W.smoothed_tfidf_sums(tf)


@query("binary_weights", sql=f"""
WITH {Q.class_tokens()}
SELECT DISTINCT doc_id, token AS term, 1.0::DOUBLE AS w FROM ctoks""")
def q_binary(spark, sf):
    """Binary presence weights."""
    return W.binary_weights(_ctf(spark, sf))


@query("count_matrix", sql=f"""
WITH {Q.lib_tokens()}
SELECT doc_id, token AS term, COUNT(*)::BIGINT AS n FROM ltoks GROUP BY doc_id, token""")
def q_count_matrix(spark, sf):
    """Document-term counts with the vectoriser's analyser (long form)."""
    return W.term_frequency(P.library_tokens(tables.documents(spark, sf)))


@query("hashed_feature_norms")
def q_hashed(spark, sf):
    """Hashed, L2-normalised features; per document the number of
    buckets used and the squared norm (1)."""
    h = W.hashed_terms(_ctf(spark, sf))
    return h.groupBy("doc_id").agg(F.count("*").alias("nnz"), F.sum(F.col("w") * F.col("w")).alias("norm2"))


_GROUPS_SQL = f"""
WITH {Q.tokens()},
sup AS (SELECT token, COUNT(*) AS s FROM tokens GROUP BY token),
t AS (SELECT tokens.*, COALESCE(sup.s >= 200, false) AS fr FROM tokens LEFT JOIN sup ON tokens.token = sup.token),
i AS (SELECT *, SUM(CASE WHEN fr THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, sent_id ORDER BY pos) AS isl FROM t),
f AS (SELECT doc_id, sent_id, isl, pos, token,
             COUNT(*) OVER (PARTITION BY doc_id, sent_id, isl) AS len,
             row_number() OVER (PARTITION BY doc_id, sent_id, isl ORDER BY pos) - 1 AS k FROM i WHERE fr),
g AS (SELECT a.doc_id, a.sent_id, a.pos AS start,
             string_agg(b.token, ' ' ORDER BY b.pos) AS word_group
      FROM f a JOIN f b ON a.doc_id = b.doc_id AND a.sent_id = b.sent_id AND a.isl = b.isl AND b.pos >= a.pos
      WHERE a.len - a.k >= 2
      GROUP BY a.doc_id, a.sent_id, a.pos)"""


@query("frequent_word_groups", sql=_GROUPS_SQL + """
SELECT word_group, COUNT(*)::BIGINT AS support FROM g GROUP BY word_group""")
def q_word_groups(spark, sf):
    """A14 + A15: frequent contiguous word groups (support ≥ 200, size ≥ 2)
    and how often each occurs."""
    toks = P.tokens(tables.documents_by_id(spark, sf))
    support = P.tokens(tables.documents(spark, sf)).groupBy(F.col("token").alias("term")).agg(F.count("*").alias("n"))
    return W.group_support(W.frequent_word_groups(toks, min_support=200, min_size=2, support=support))


_BAGS = f"""{Q.labelled()}, {Q.class_tokens('lab', ', label')},
b0 AS (SELECT token AS term, COUNT(*) AS n FROM ctoks WHERE label = '0' GROUP BY token),
b1 AS (SELECT token AS term, COUNT(*) AS n FROM ctoks WHERE label = '1' GROUP BY token)"""


def _bags(spark, sf):
    lab = tables.labelled_corpus(spark, sf)
    ct = W.class_term_counts(W.term_frequency(P.class_tokens(lab, keep=("label",)), keep=("label",)))
    return ct.filter("label = '0'").select("term", "n"), ct.filter("label = '1'").select("term", "n")


@query("bag_union", sql=f"""
WITH {_BAGS}
SELECT term, SUM(n)::BIGINT AS n FROM (SELECT * FROM b0 UNION ALL SELECT * FROM b1) GROUP BY term""")
def q_bag_union(spark, sf):
    """The two class bags added together."""
    a, b = _bags(spark, sf)
    return W.bag_union(a, b)


@query("bag_intersection", sql=f"""
WITH {_BAGS}
SELECT b0.term, b0.n::BIGINT AS n_a, b1.n::BIGINT AS n_b FROM b0 JOIN b1 ON b0.term = b1.term""")
def q_bag_intersection(spark, sf):
    """The words both class bags contain."""
    a, b = _bags(spark, sf)
    return W.bag_intersection(a, b)
