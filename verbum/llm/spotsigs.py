"""SpotSigs document fingerprints, with DataFrame functions only.

A spot is a common word (an anchor); its signature is the anchor with the chain
of the next content words.  A document's fingerprint is its sorted set of
signature hashes.  Two documents are compared by the Jaccard similarity of
their sets; the pair search partitions the documents by set length and prunes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from verbum.llm import common as C

# Common words that anchor a spot (English, French, German, Spanish).
ANCHORS = ("the", "a", "is", "was", "be", "to", "of", "that", "with", "for",
           "le", "la", "les", "des", "est", "que", "pour", "dans",
           "der", "die", "das", "ist", "und", "zu", "von", "ein",
           "el", "los", "una", "es", "por", "con", "se", "del")
CHAIN = 2            # content words of a chain
HEX = 8              # hexadecimal digits of a signature in the fingerprint


def signatures(text, anchors=ANCHORS, chain: int = CHAIN) -> Column:
    """Sorted distinct signature hashes (``array<int>``) of whole texts.

    With ``i`` the place of the ``j``-th anchor (from 0) among all words, just
    ``i - j`` content words stand before it, so its chain starts at that place
    of the content words.  A text without anchors takes every word for one, and
    a text without words (or null) has the empty set."""
    col = F.col(text) if isinstance(text, str) else text
    words = F.filter(F.split(F.lower(F.coalesce(col, F.lit(""))), C.WORD_BREAK), lambda w: w != "")

    def of(w: Column) -> Column:
        content = F.filter(w, lambda x: ~x.isin(*anchors))
        return F.transform(F.array(F.struct(w.alias("w"), content.alias("c"))), lambda s: F.transform(
            F.filter(F.transform(s["w"], lambda x, i: F.struct(x.alias("a"), i.alias("i"))),
                     lambda t: (F.size(s["c"]) == F.size(s["w"])) | t["a"].isin(*anchors)),
            lambda t, j: F.hash(t["a"], *[F.get(s["c"], t["i"] + k + F.when(F.size(s["c"]) == F.size(s["w"]), 1).otherwise(-j))
                                          for k in range(chain)])))[0]

    return F.transform(F.array(words), lambda w: F.sort_array(F.array_distinct(of(w))))[0]


def fingerprint_string(sigs: Column) -> Column:
    """The set as text: eight hexadecimal digits of each hash, in order."""
    return F.array_join(F.transform(sigs, lambda h: F.lpad(F.lower(F.hex(h.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), HEX, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two signature sets; two empty sets are alike.

    Pruned: where the shorter set cannot share anything the intersection isn't
    taken."""
    shared = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b)
    return (F.when(either == 0, F.lit(1.0))
            .when(F.least(F.size(a), F.size(b)) == 0, F.lit(0.0))
            .otherwise(shared / (either - shared)))


def with_next(spark: SparkSession, docs: DataFrame, columns=("text",), n_ranges: int | None = None) -> DataFrame:
    """Each document with the ``next_`` columns of the document after it in
    descending ``doc_id`` order (ties: by text; null ids last); the last one is
    followed by the first.

    The ids are cut into ranges at their quantiles, each range is one window
    partition, and the last row of a range takes the first row of the next
    non-empty range from a table with one row for each range."""
    n_ranges = n_ranges or 4 * C.partitions(spark)
    order = [F.col("doc_id").desc_nulls_last(), F.col(columns[0]).asc_nulls_first()]
    ranged = C.with_range(docs, "doc_id", n_ranges, descending=True)
    w = Window.partitionBy("_range").orderBy(*order)
    row = F.struct(*columns)
    here = ranged.withColumn("_next", F.lead(row).over(w))
    key = F.struct(F.coalesce(-F.col("doc_id"), F.lit(2**63 - 1)).alias("k"), F.col(columns[0]).alias("t"))
    firsts = ranged.groupBy("_range").agg(F.min_by(row, key).alias("_first"))
    whole = Window.orderBy("_range")      # one row for each range
    after = firsts.select(
        "_range", F.coalesce(F.lead("_first").over(whole), F.first("_first").over(whole)).alias("_first"))
    return (here.join(F.broadcast(after), "_range")
            .select(*docs.columns, *[F.coalesce(F.col("_next"), F.col("_first"))[c].alias(f"next_{c}") for c in columns]))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` with ``sigs``, ``fingerprint`` and ``length_class`` (set sizes
    in one class differ by less than a factor of 1.25)."""
    return (docs.withColumn("sigs", signatures("text"))
            .withColumn("fingerprint", fingerprint_string(F.col("sigs")))
            .withColumn("length_class", length_class(F.size("sigs"))))


def length_class(n: Column, threshold: float = 0.8) -> Column:
    return F.when(n > 0, F.floor(F.log(n.cast("double")) / -math.log(threshold))).otherwise(-1).cast("int")


def near_pairs(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Pairs ``(doc_id, other_id, similarity)`` of different fingerprints with a
    Jaccard similarity of at least ``threshold``, one row per pair of
    fingerprints, each shown by its smallest ``doc_id``.

    Sets of one similar pair lie in the same or in neighbouring length classes,
    so the index is partitioned by class; in it only the ``n - ceil(t n) + 1``
    rarest signatures of a set are keys, which every similar pair must share.
    Documents without signatures and null ids are in no pair."""
    sets = (fingerprints(docs.select("doc_id", "text")).where(F.size("sigs") > 0)
            .groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id"), F.first("sigs").alias("sigs"),
                                        F.first("length_class").alias("cls"))
            .where(F.col("doc_id").isNotNull()))
    df = sets.select(F.explode("sigs").alias("sig")).groupBy("sig").agg(F.count(F.lit(1)).alias("df"))
    need = F.size("sigs") - F.ceil(F.lit(threshold) * F.size("sigs") - 1e-9) + 1
    rare = (sets.select("doc_id", "cls", F.size("sigs").alias("n"), need.alias("need"), F.explode("sigs").alias("sig"))
            .join(df, "sig")
            .withColumn("r", F.row_number().over(Window.partitionBy("doc_id").orderBy("df", "sig")))
            .where(F.col("r") <= F.col("need")).select("doc_id", "cls", "n", "sig"))
    left = rare.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), "sig", F.explode(F.array(F.col("cls") - 1, "cls", F.col("cls") + 1)).alias("cls"))
    right = rare.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), "sig", "cls")
    cand = (left.join(right, ["sig", "cls"]).where(F.col("a") < F.col("b"))
            .where(F.least("na", "nb") >= F.lit(threshold) * F.greatest("na", "nb")).select("a", "b").distinct())
    own = sets.select("doc_id", "sigs")
    return (cand.join(own.select(F.col("doc_id").alias("a"), F.col("sigs").alias("sa")), "a")
            .join(own.select(F.col("doc_id").alias("b"), F.col("sigs").alias("sb")), "b")
            .withColumn("similarity", likeness(F.col("sa"), F.col("sb")))
            .where(F.col("similarity") >= threshold)
            .select(F.col("a").alias("doc_id"), F.col("b").alias("other_id"), "similarity"))


def edited_fingerprints(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Fingerprints of ``docs`` (``doc_id``, ``text``; null texts empty) and of
    each text whose last half is replaced by the beginning of the next document
    in descending id order, with both likenesses.  Equal texts have equal
    fingerprints; an empty text has the empty one."""
    own = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
           .withColumn("sigs", signatures("text")))
    n = F.char_length("text")
    edited = F.concat(F.expr("substring(text, 1, char_length(text) - int(floor(char_length(text) / 2)))"),
                      F.expr("substring(next_text, 1, int(floor(char_length(text) / 2)))"))
    pairs = (with_next(spark, own, ("text", "sigs"))
             .select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "sigs", "next_sigs"))
    return (pairs.withColumn("edited_sigs", signatures("edited"))
            .select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                    fingerprint_string(F.col("sigs")).alias("fingerprint"),
                    fingerprint_string(F.col("edited_sigs")).alias("edited_fingerprint"),
                    likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
                    likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
                    length_class(F.size("sigs")).alias("length_class")))
