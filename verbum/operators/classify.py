"""Text classification (C1–C15) on a labelled corpus.

Inputs are long tables: ``tf(doc_id, label, split, term, n)`` and weight
tables ``(doc_id, term, w)``.  Per-class statistics are aggregates keyed by
(label, term); document×class score tables are built by joining each test
term to the class statistics of that term only (never a documents × classes ×
vocabulary product), then adding the per-class constants.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from verbum.functions.joins import scalar
from verbum.operators import similarity as S

MAX_INLINE_CLASSES = 10_000


def _classes_inline(classes: DataFrame, cols: list[str]):
    """The class table as a literal array of structs (size checked)."""
    n = scalar(classes.agg(F.count("*").alias("n")), "n")
    if n > MAX_INLINE_CLASSES:
        return None
    rows = classes.select(*cols).collect()
    return F.array(*[F.struct(*[F.lit(r[c]).alias(c) for c in cols]) for r in rows])


def per_doc_class(docs: DataFrame, classes: DataFrame, cols: list[str]) -> DataFrame:
    """Every (document, class) pair: the bounded class list is enumerated in
    each document row; a cartesian join is used only past the bound."""
    arr = _classes_inline(classes, cols)
    if arr is None:
        return docs.crossJoin(classes.select(*cols))
    return docs.select("*", F.explode(arr).alias("_c")).select("*", "_c.*").drop("_c")


def best_class(scores: DataFrame, score_col: str = "score", label_col: str = "label",
               ascending: bool = False) -> DataFrame:
    """argmax (or argmin) per document, ties to the smaller label."""
    order = F.col(score_col).asc() if ascending else F.col(score_col).desc()
    w = Window.partitionBy("doc_id").orderBy(order, label_col)
    return (scores.withColumn("_r", F.row_number().over(w)).filter("_r = 1")
            .select("doc_id", F.col(label_col).alias("predicted")))


# ---------------------------------------------------------------- naive Bayes

def naive_bayes(tf: DataFrame, digits: int = 3) -> DataFrame:
    """Multinomial naive Bayes in log10 with add-one smoothing.

    score(d, c) = log10(n_c/n) + Σ_w cnt·log10((W_wc+1)/(V+L_c)) over all
    words of d (out-of-vocabulary words included), rounded to ``digits``.
    Split as Σ_w cnt·log10(W_wc+1) over the words the class has, minus
    N_d·log10(V+L_c).  Output ``(doc_id, label, score)`` for test documents."""
    train = tf.filter("split = 'train'")
    test = tf.filter("split = 'test'")
    v = scalar(train.agg(F.countDistinct("term").alias("v")), "v")
    n_train = scalar(train.agg(F.countDistinct("doc_id").alias("n")), "n")
    classes = (train.groupBy("label").agg(F.countDistinct("doc_id").alias("n_c"), F.sum("n").alias("l_c"))
               .select("label", F.log10(F.col("n_c") / F.lit(float(n_train))).alias("prior"),
                       F.log10(F.lit(float(v)) + F.col("l_c")).alias("log_den")))
    cw = train.groupBy("label", "term").agg(F.sum("n").alias("w_c"))
    hit = (test.select("doc_id", "term", "n").join(cw, "term")
           .groupBy("doc_id", "label").agg(F.sum(F.col("n") * F.log10(F.col("w_c") + 1)).alias("hit")))
    docs = test.groupBy("doc_id").agg(F.sum("n").alias("n_d"))
    grid = per_doc_class(docs, classes, ["label", "prior", "log_den"])
    s = (grid.join(hit, ["doc_id", "label"], "left")
         .select("doc_id", "label",
                 F.bround(F.col("prior") + F.coalesce("hit", F.lit(0.0)) - F.col("n_d") * F.col("log_den"),
                          digits).alias("score")))
    return s


def naive_bayes_posterior(tf: DataFrame, digits: int = 3) -> DataFrame:
    """Posterior by ratios, 1 / Σ_j Π_{unique w∈d} (1+n_wj)S_c/((1+n_wc)S_j) · N_j/N_c.

    In log space this is a softmax over s_j(d) = Σ_{w∈d} ln(1+n_wj) −
    |d|·ln S_j + ln N_j, computed with log-sum-exp per document."""
    train = tf.filter("split = 'train'")
    test = tf.filter("split = 'test'").select("doc_id", "term").distinct()
    classes = train.groupBy("label").agg(F.countDistinct("doc_id").alias("n_j"), F.sum("n").alias("s_j"))
    classes = classes.select("label", F.log("n_j").alias("ln_n"), F.log("s_j").alias("ln_s"))
    cw = train.groupBy("label", "term").agg(F.sum("n").alias("w"))
    hit = test.join(cw, "term").groupBy("doc_id", "label").agg(F.sum(F.log1p("w")).alias("hit"))
    docs = test.groupBy("doc_id").agg(F.count("*").alias("u_d"))
    grid = per_doc_class(docs, classes, ["label", "ln_n", "ln_s"])
    s = grid.join(hit, ["doc_id", "label"], "left").select(
        "doc_id", "label",
        (F.coalesce("hit", F.lit(0.0)) - F.col("u_d") * F.col("ln_s") + F.col("ln_n")).alias("s"))
    w = Window.partitionBy("doc_id")
    m = F.max("s").over(w)
    s = s.withColumn("_e", F.exp(F.col("s") - m))
    return s.select("doc_id", "label", F.bround(F.col("_e") / F.sum("_e").over(w), digits).alias("probability"))


def class_overlap(tf: DataFrame) -> DataFrame:
    """Share of a test document's distinct words found in each class's
    training vocabulary."""
    train_terms = tf.filter("split = 'train'").select("label", "term").distinct()
    test = tf.filter("split = 'test'").select("doc_id", "term").distinct()
    docs = test.groupBy("doc_id").agg(F.count("*").alias("n_words"))
    classes = train_terms.select("label").distinct()
    hit = test.join(train_terms, "term").groupBy("doc_id", "label").agg(F.count("*").alias("n_shared"))
    grid = per_doc_class(docs, classes, ["label"])
    return grid.join(hit, ["doc_id", "label"], "left").select(
        "doc_id", "label", (F.coalesce("n_shared", F.lit(0)) / F.col("n_words")).alias("ratio"))


# -------------------------------------------------------------------- Rocchio

def centroids_rounded(weights: DataFrame, docs: DataFrame, digits: int = 3) -> DataFrame:
    """C4 centroids: per class the mean of its training vectors (absent = 0),
    rounded half-to-even.  Weights rounded to 2 decimals are summed as exact
    integers (hundredths), so the rounding is exact and order-independent.
    ``weights(doc_id, term, w)``, ``docs(doc_id, label)`` of training docs."""
    n_c = docs.groupBy("label").agg(F.count("*").alias("n_c"))
    s = (weights.join(docs, "doc_id").groupBy("label", "term")
         .agg(F.sum(F.round(F.col("w") * 100).cast("long")).alias("s100")))
    s = s.join(n_c, "label")
    num = F.col("s100") * F.lit(10 ** (digits - 2))
    q = F.floor(num / F.col("n_c"))
    rem2 = (num - q * F.col("n_c")) * 2
    up = F.when(rem2 > F.col("n_c"), 1).when(rem2 < F.col("n_c"), 0).otherwise(F.pmod(q, F.lit(2)))
    c = (q + up) / F.lit(float(10 ** digits))
    return s.select("label", "term", c.alias("w")).filter(F.col("w") != 0)


def rocchio(weights: DataFrame, docs: DataFrame) -> DataFrame:
    """C4: Euclidean distance from every test vector to every class centroid.

    ``weights(doc_id, term, w)`` for all documents; ``docs(doc_id, label,
    split)``.  Output ``(doc_id, label, dist)``."""
    train_docs = docs.filter("split = 'train'").select("doc_id", "label")
    cent = centroids_rounded(weights.join(train_docs.select("doc_id"), "doc_id"), train_docs)
    test_w = weights.join(docs.filter("split = 'test'").select("doc_id"), "doc_id")
    return S.distances_to_centroids(test_w, cent, key="label")


def rocchio_weighted(tf: DataFrame, docs: DataFrame) -> DataFrame:
    """Class-weighted Rocchio.  A training vector is tf·ln(class token
    count / class count of the term), L2-normalised; the centroid is the mean
    over the class; a test vector is plain tf over the training vocabulary,
    L2-normalised; output distances ``(doc_id, label, dist)``."""
    train = tf.filter("split = 'train'")
    ct = train.groupBy("label", "term").agg(F.sum("n").alias("ct"))
    tot = train.groupBy("label").agg(F.sum("n").alias("tot"))
    tv = (train.join(ct, ["label", "term"]).join(tot, "label")
          .select("doc_id", "label", "term", (F.col("n") * F.log(F.col("tot") / F.col("ct"))).alias("w")))
    tv = S.l2_normalise(tv.filter("w != 0"), keep=("label",))
    n_c = train.select("doc_id", "label").distinct().groupBy("label").agg(F.count("*").alias("n_c"))
    cent = (tv.groupBy("label", "term").agg(F.sum("w").alias("s")).join(n_c, "label")
            .select("label", "term", (F.col("s") / F.col("n_c")).alias("w")))
    vocab = train.select("term").distinct()
    test = tf.filter("split = 'test'").join(vocab, "term", "left_semi")
    xv = S.l2_normalise(test.select("doc_id", "term", F.col("n").cast("double").alias("w")))
    return S.distances_to_centroids(xv, cent, key="label")


# ------------------------------------------------------------------------ kNN

def knn(weights: DataFrame, docs: DataFrame, k: int = 1) -> DataFrame:
    """C6 + C7: k nearest training documents (Euclid) and the vote.

    Output ``(doc_id, predicted)``: most votes wins, ties go to the class of
    the nearest neighbour among the tied classes."""
    train = docs.filter("split = 'train'").select("doc_id", "label")
    test = docs.filter("split = 'test'").select("doc_id")
    nn = S.knn(weights.join(test, "doc_id"), weights.join(train.select("doc_id"), "doc_id"), k)
    nn = nn.join(train.withColumnRenamed("doc_id", "nb_id"), "nb_id")
    return vote(nn)


def vote(nn: DataFrame) -> DataFrame:
    """``nn(doc_id, nb_id, rank, label)`` → majority class, ties by the
    smallest rank (the nearest) holding that class."""
    v = nn.groupBy("doc_id", "label").agg(F.count("*").alias("votes"), F.min("rank").alias("first"))
    w = Window.partitionBy("doc_id").orderBy(F.desc("votes"), "first")
    return (v.withColumn("_r", F.row_number().over(w)).filter("_r = 1")
            .select("doc_id", F.col("label").alias("predicted")))


def accuracy(pred: DataFrame, docs: DataFrame) -> DataFrame:
    """C14: percentage of test documents predicted right."""
    j = pred.join(docs.select("doc_id", "label"), "doc_id")
    return j.agg((F.avg((F.col("predicted") == F.col("label")).cast("double")) * 100).alias("accuracy"),
                 F.count("*").alias("n_test"))


def one_hot(docs: DataFrame) -> DataFrame:
    """Class indicator per training document, long form
    ``(doc_id, label, y)`` with y = 1 (absent pairs are 0)."""
    return docs.select("doc_id", "label", F.lit(1.0).alias("y"))
