"""Term statistics and weighting.

Everything is a long sparse table keyed by ``(doc_id, term)``.  The one
shuffle on ``doc_id`` that builds ``tf`` is reused by the per-document
windows (length, maximum, norm), and the per-term aggregates are combinable
(count / sum), so map-side partial aggregation flattens hot terms before the
exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from verbum.functions.joins import broadcast_checked, scalar
from verbum.session import written


def term_frequency(toks: DataFrame, token_col: str = "token", keep=()) -> DataFrame:
    """A1: ``tf(doc_id, term, n)``."""
    return toks.groupBy("doc_id", *keep, F.col(token_col).alias("term")).agg(F.count("*").alias("n"))


def ranked_frequency(tf: DataFrame) -> DataFrame:
    """A1 sorted view: rank of each term inside its document by (n desc, term)."""
    w = Window.partitionBy("doc_id").orderBy(F.desc("n"), "term")
    return tf.withColumn("rank", F.row_number().over(w))


def doc_length(tf: DataFrame) -> DataFrame:
    """A2: token total per document."""
    return tf.groupBy("doc_id").agg(F.sum("n").alias("n_tokens"))


def vocabulary(tf: DataFrame) -> DataFrame:
    """A3: corpus vocabulary with total counts."""
    return tf.groupBy("term").agg(F.sum("n").alias("n"))


def class_term_counts(tf: DataFrame, label_col: str = "label") -> DataFrame:
    """A3: per-class word counts; ``tf`` must carry the label column."""
    return tf.groupBy(label_col, "term").agg(F.sum("n").alias("n"))


def document_frequency(tf: DataFrame) -> DataFrame:
    """A4: number of documents containing each term (``tf`` is unique per
    (doc, term), so a plain count is exact)."""
    return tf.groupBy("term").agg(F.count("*").alias("df"))


def n_documents(tf: DataFrame) -> int:
    return scalar(tf.agg(F.countDistinct("doc_id").alias("n")), "n")


def idf(df: DataFrame, n_docs: int) -> DataFrame:
    """A5: ``log10(N / df)``."""
    return df.select("term", "df", F.log10(F.lit(float(n_docs)) / F.col("df")).alias("idf"))


def tfidf(tf: DataFrame, n_docs: int | None = None) -> DataFrame:
    """``(n / tokens in document) * log10(N / df)``.

    Output ``(doc_id, term, n, tf, idf, tfidf)``."""
    n_docs = n_docs if n_docs is not None else n_documents(tf)
    dfreq = idf(document_frequency(tf), n_docs)
    w = Window.partitionBy("doc_id")
    return (tf.join(dfreq, "term")
            .withColumn("tf", F.col("n") / F.sum("n").over(w))
            .withColumn("tfidf", F.col("tf") * F.col("idf")))


def top_terms(weights: DataFrame, k: int = 5, weight_col: str = "tfidf") -> DataFrame:
    """Top-k terms per document by weight (ties by term)."""
    w = Window.partitionBy("doc_id").orderBy(F.desc(weight_col), "term")
    return weights.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def prune_by_max(weights: DataFrame, min_mult: float, weight_col: str = "tfidf") -> DataFrame:
    """Drop terms whose weight is below ``min_mult`` × the document maximum."""
    w = Window.partitionBy("doc_id")
    return (weights.withColumn("_max", F.max(weight_col).over(w))
            .filter(F.col(weight_col) >= F.lit(min_mult) * F.col("_max")).drop("_max"))


def l2_weights(tf: DataFrame, n_docs: int | None = None, dfreq: DataFrame | None = None, above_one: bool = False) -> DataFrame:
    """``W = n * log10(N/df)`` divided by the row's L2 norm.

    Zero-weight terms (present in every document) are dropped, and so are
    documents whose norm is zero.  ``above_one``: ``dfreq`` leaves out the terms of
    a single document, which are most.  Output ``(doc_id, term, w)``."""
    n_docs = n_docs if n_docs is not None else n_documents(tf)
    dfreq = dfreq if dfreq is not None else document_frequency(tf)
    found = tf.filter("term IS NOT NULL").join(dfreq, "term", "left").withColumn("df", F.coalesce("df", F.lit(1))) if above_one else tf.join(dfreq, "term")
    raw = (found
           .select("doc_id", "term", (F.col("n") * F.log10(F.lit(float(n_docs)) / F.col("df"))).alias("w"))
           .filter(F.col("w") != 0))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc_id")))
    return raw.select("doc_id", "term", (F.col("w") / norm).alias("w"))


def train_tfidf(tf: DataFrame, split_col: str = "split", train_value: str = "train",
                digits: int = 2) -> DataFrame:
    """Vocabulary and df from the training split only; raw tf of train and
    test documents over that vocabulary; ``w = n·log10(D/df)`` with D the
    number of training documents; L2 row norm; rounded half-to-even.

    Output ``(doc_id, <split>, term, w)`` plus ``norm2`` (squared norm of the
    rounded row — rounded rows are not unit length)."""
    train = tf.filter(F.col(split_col) == train_value)
    d = n_documents(train)
    dfreq = document_frequency(train)
    raw = (tf.join(dfreq, "term")
           .withColumn("w", F.col("n") * F.log10(F.lit(float(d)) / F.col("df"))))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc_id")))
    out = raw.withColumn("w", F.bround(F.try_divide(F.col("w"), norm), digits)).filter(F.col("w").isNotNull())
    return out.drop("n", "df")


def smoothed_tfidf(tf: DataFrame, n_docs: int | None = None) -> DataFrame:
    """A10: ``n · (ln((1+N)/(1+df)) + 1)`` L2-normalised per document."""
    n_docs = n_docs if n_docs is not None else n_documents(tf)
    dfreq = document_frequency(tf)
    raw = tf.join(dfreq, "term").select(
        "doc_id", "term",
        (F.col("n") * (F.log((F.lit(1.0 + n_docs)) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0))).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc_id")))
    return raw.select("doc_id", "term", (F.col("w") / norm).alias("w"))


def smoothed_tfidf_sums(tf: DataFrame, n_docs: int | None = None) -> DataFrame:
    """A10 table: per term the sum of its smoothed weights over documents."""
    return smoothed_tfidf(tf, n_docs).groupBy("term").agg(F.sum("w").alias("w_sum"))


def binary_weights(tf: DataFrame) -> DataFrame:
    """1 for every (doc, term) present."""
    return tf.select("doc_id", "term", F.lit(1.0).alias("w"))


def hashed_features(toks: DataFrame, num_features: int = 1 << 20, token_col: str = "token") -> DataFrame:
    """Hashed term counts, L2-normalised (``HashingTF`` + ``Normalizer``).

    Spark's hashing is unsigned murmur3, so bucket ids differ from other
    libraries; the norm of each vector is 1."""
    from pyspark.ml.feature import HashingTF, Normalizer
    arrays = toks.groupBy("doc_id").agg(F.collect_list(token_col).alias("tokens"))
    h = HashingTF(inputCol="tokens", outputCol="raw", numFeatures=num_features).transform(arrays)
    return Normalizer(inputCol="raw", outputCol="features", p=2.0).transform(h).select("doc_id", "features")


def hashed_terms(tf: DataFrame, num_features: int = 1 << 20) -> DataFrame:
    """A13 in long form: ``(doc_id, bucket, w)`` with ``bucket =
    pmod(hash(term), num_features)`` (Spark SQL's murmur3; its tail handling
    differs from ``HashingTF``, so bucket ids are not interchangeable with the
    ML stage), counts summed per bucket and L2-normalised per document.
    Stays in the JVM and never materialises dense vectors."""
    b = (tf.groupBy("doc_id", F.pmod(F.hash("term"), F.lit(num_features)).alias("bucket"))
         .agg(F.sum("n").cast("double").alias("w")))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc_id")))
    return b.select("doc_id", "bucket", (F.col("w") / norm).alias("w"))


def frequent_word_groups(toks: DataFrame, min_support: int, min_size: int = 2,
                         support: DataFrame | None = None) -> DataFrame:
    """In each sentence, from every start extend right while the word's
    corpus support is at least ``min_support``; keep groups of at least
    ``min_size`` words.  Output ``(doc_id, sent_id, start, word_group)``.

    Frequent runs ("islands") are found with a running count of infrequent
    tokens inside each sentence; each island of length L yields its suffixes
    of length ≥ ``min_size``."""
    support = support if support is not None else vocabulary(term_frequency(toks))
    often = written(support.filter(F.col("n") >= min_support).select(F.col("term").alias("token"), F.col("n").alias("_sup")))
    sup = broadcast_checked(often)      # the frequent words go to the tokens
    t = toks.join(sup, "token", "left").withColumn(
        "_freq", F.coalesce(F.col("_sup") >= min_support, F.lit(False)))
    w = Window.partitionBy("doc_id", "sent_id").orderBy("pos")
    t = t.withColumn("_island", F.sum(F.when(F.col("_freq"), 0).otherwise(1)).over(w)).filter("_freq")
    isl = (t.groupBy("doc_id", "sent_id", "_island")
           .agg(F.array_sort(F.collect_list(F.struct("pos", "token"))).alias("_a")))
    isl = isl.select("doc_id", "sent_id", F.transform("_a", lambda s: s["token"]).alias("_w"),
                     F.col("_a")[0]["pos"].alias("_p0"))
    n = F.size("_w")
    starts = F.sequence(F.lit(0), n - F.lit(min_size))
    out = isl.filter(n >= min_size).select(
        "doc_id", "sent_id", "_p0", "_w", F.explode(starts).alias("_i"))
    return out.select("doc_id", "sent_id", (F.col("_p0") + F.col("_i")).alias("start"),
                      F.array_join(F.slice("_w", F.col("_i") + 1, n - F.col("_i")), " ").alias("word_group"))


def group_support(groups: DataFrame) -> DataFrame:
    """How many times each word group occurs."""
    return groups.groupBy("word_group").agg(F.count("*").alias("support"))


def bag_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """Merge two bags ``(term, n)`` by adding counts."""
    return a.select("term", "n").unionByName(b.select("term", "n")).groupBy("term").agg(F.sum("n").alias("n"))


def bag_intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    """The terms two bags share (with both counts)."""
    return a.select("term", F.col("n").alias("n_a")).join(b.select("term", F.col("n").alias("n_b")), "term")
