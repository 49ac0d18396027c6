"""Similarity and neighbour queries (V1–V7) over document weights (A8 on
classification tokens) and over the dense ``embeddings`` table."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from verbum.functions.joins import broadcast_checked
from verbum.operators import preprocess as P, similarity as S, weighting as W
from verbum.plans import sqlparts as Q
from verbum.plans.registry import query
from verbum.session import written
from verbum.sources import tables

_A8 = f"""{Q.class_tokens()},
tf AS (SELECT doc_id, token AS term, COUNT(*) AS n FROM ctoks GROUP BY doc_id, token),
nd AS (SELECT COUNT(DISTINCT doc_id)::DOUBLE AS n_docs FROM tf),
dfr AS (SELECT term, COUNT(*) AS df FROM tf GROUP BY term),
raw AS (SELECT tf.doc_id, tf.term, tf.n * log10(nd.n_docs / dfr.df) AS w
        FROM tf JOIN dfr ON tf.term = dfr.term CROSS JOIN nd),
nz AS (SELECT * FROM raw WHERE w <> 0),
a8 AS (SELECT doc_id, term, w / sqrt(SUM(w * w) OVER (PARTITION BY doc_id)) AS w FROM nz),
nrm AS (SELECT doc_id, SUM(w * w) AS n2 FROM a8 GROUP BY doc_id),
dot AS (SELECT a.doc_id AS doc_a, b.doc_id AS doc_b, SUM(a.w * b.w) AS dot
        FROM a8 a JOIN a8 b ON a.term = b.term AND a.doc_id < b.doc_id GROUP BY ALL),
eu AS (SELECT dot.doc_a, dot.doc_b, sqrt(greatest(0, na.n2 + nb.n2 - 2 * dot.dot)) AS dist
       FROM dot JOIN nrm na ON na.doc_id = dot.doc_a JOIN nrm nb ON nb.doc_id = dot.doc_b)"""


def _a8(spark, sf):
    """A8 rows, written once: every user reads them several times.  The terms of
    more than one document are few enough to go to the rows, which then stay."""
    tf = W.term_frequency(P.class_tokens(tables.documents_by_id(spark, sf))).persist(StorageLevel.MEMORY_AND_DISK)
    v = written(W.l2_weights(tf, dfreq=broadcast_checked(written(W.document_frequency(tf).filter("df > 1"))), above_one=True))
    tf.unpersist()
    return v


@query("cosine_pairs", sql=f"""
WITH {_A8}
SELECT doc_a, doc_b, round(dot, 6) AS cos FROM dot""")
def q_cosine(spark, sf):
    """V3: cosine similarity of every document pair sharing a weighted term."""
    return S.cosine_pairs(_a8(spark, sf))


@query("euclid_pairs", sql=f"""
WITH {_A8}
SELECT doc_a, doc_b, round(dist, 6) AS dist FROM eu""")
def q_euclid(spark, sf):
    """V4: Euclidean distance of every pair sharing a term (others are √2 apart)."""
    return S.euclid_pairs(_a8(spark, sf))


@query("eps_neighbours", sql=f"""
WITH {_A8}
SELECT doc_a, doc_b, round(dist, 6) AS dist FROM eu WHERE dist <= 0.5
UNION ALL
SELECT doc_b AS doc_a, doc_a AS doc_b, round(dist, 6) AS dist FROM eu WHERE dist <= 0.5""")
def q_eps(spark, sf):
    """V5: ε-neighbourhood (ε = 0.5, inclusive, self excluded) of document vectors."""
    return S.eps_neighbours(_a8(spark, sf), 0.5)


_EMB = """e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings)"""


@query("embedding_range_pairs", sql=f"""
WITH {_EMB},
d AS (SELECT a.vec_id AS a, b.vec_id AS b, list_distance(a.v, b.v) AS dist FROM e a JOIN e b ON a.vec_id <> b.vec_id)
SELECT a, b, round(dist, 6) AS dist FROM d WHERE dist <= 1.2""")
def q_emb_range(spark, sf):
    """V5 (dense): ordered pairs of embeddings within distance 1.2 (pivot-cell blocks)."""
    return S.dense_range_pairs(tables.embeddings(spark, sf), "vec_id", "embedding", 1.2)


@query("embedding_knn", sql=f"""
WITH {_EMB},
d AS (SELECT a.vec_id AS doc_id, b.vec_id AS nb_id, list_distance(a.v, b.v) AS dist
      FROM e a JOIN e b ON a.vec_id % 5 = 0 AND b.vec_id % 5 <> 0),
rk AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(dist, 10), nb_id) AS rank FROM d)
SELECT doc_id, nb_id, rank::BIGINT AS rank, round(dist, 6) AS dist FROM rk WHERE rank <= 5""")
def q_emb_knn(spark, sf):
    """V6 (dense): five nearest reference vectors (vec_id % 5 ≠ 0) of every
    query vector (vec_id % 5 = 0)."""
    e = tables.embeddings(spark, sf)
    q = e.filter(F.col("vec_id") % 5 == 0)
    r = e.filter(F.col("vec_id") % 5 != 0)
    return S.dense_knn(q, r, "vec_id", "embedding", k=5).select("doc_id", "nb_id", "rank", "dist")


@query("nearest_centroid", sql=f"""
WITH {_EMB},
dims AS (SELECT vec_id, label, generate_subscripts(v, 1) AS dim, unnest(v) AS x FROM e),
cnt AS (SELECT label, COUNT(*) AS n FROM e GROUP BY label),
cent AS (SELECT d.label, dim, SUM(x) / MAX(cnt.n) AS c FROM dims d JOIN cnt ON d.label = cnt.label GROUP BY d.label, dim),
dist AS (SELECT d.vec_id, c.label, sqrt(SUM((d.x - c.c) * (d.x - c.c))) AS dist
         FROM dims d JOIN cent c ON d.dim = c.dim GROUP BY d.vec_id, c.label),
rk AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(dist, 10), label) AS r FROM dist)
SELECT vec_id AS doc_id, label, round(dist, 6) AS dist FROM rk WHERE r = 1""")
def q_nearest_centroid(spark, sf):
    """V7: every embedding's nearest class centroid (centroid = class mean)."""
    e = tables.embeddings(spark, sf)
    lv = S.dense_long(e, "vec_id", "embedding")
    cent = S.class_centroids(lv, e.select(F.col("vec_id").alias("doc_id"), "label"))
    return S.nearest(S.distances_to_centroids(lv, cent, key="label"), key="label").select("doc_id", "label", "dist")


@query("document_category_join", sql="""
SELECT d.doc_id, CAST(l.quality AS VARCHAR) AS category, d.lang FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def q_v1(spark, sf):
    """V1: documents joined to their categories."""
    d = tables.table(spark, sf, "documents").select("doc_id", "lang")
    l = tables.table(spark, sf, "labels").select("doc_id", F.col("quality").cast("string").alias("category"))
    return d.join(l, "doc_id")


@query("vocabulary_lookup", sql=f"""
WITH {_A8}
SELECT tf.doc_id, tf.term, tf.n, dfr.df FROM tf JOIN dfr ON tf.term = dfr.term""")
def q_v2(spark, sf):
    """V2: token ↔ vocabulary lookup (tf joined to df)."""
    tf = W.term_frequency(P.class_tokens(tables.documents(spark, sf)))
    return tf.join(W.document_frequency(tf), "term").select("doc_id", "term", "n", "df")
