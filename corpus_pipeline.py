"""From raw documents to packed training sequences, in five stages.

Every stage takes all rows that the one before kept.  Rows without id are never
dropped for what other rows say; empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from verbum.llm import common as C, decontaminate, linededup, neardup, packing, quality

MIN_QUALITY = 0.5      # documents with a lower probability of label 1 go


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` but those whose id is among the written ``ids``."""
    ids = ids.where("doc_id IS NOT NULL").distinct()
    return docs.join(C.maybe_broadcast(ids, ids.count()), "doc_id", "left_anti").select(*docs.columns)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality.fit(spark, docs, C.read(spark, sf_dir, "labels"))
    score = "_score"
    while score in docs.columns:
        score += "_"
    return quality.with_scores(spark, docs, model, score).where(F.col(score) >= MIN_QUALITY).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later copies of repeated line runs; one that has no
    line left goes.  ``n_chars`` follows the text."""
    out = linededup.dedup_lines(spark, docs).where(~((F.col("lines_cut") > 0) & (F.col("lines_left") == 0)))
    if "n_chars" in docs.columns:
        n = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("lines_cut") > 0, n).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates (five-word shingles,
    similarity 0.8); of rows that repeat an id one stays."""
    found = C.written(spark, neardup.near_duplicates(spark, docs), "components")
    left = without(docs, found.where("NOT kept").select("doc_id"))
    again = C.written(spark, found.where("kept AND doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated-ids")
    if again.isEmpty():
        return left
    twice = left.join(again, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"])
    return without(left, again).unionByName(twice)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    leaks = C.written(spark, decontaminate.find_leaks(spark, docs, C.read(spark, sf_dir, "benchmark"), short_items=True), "leaks")
    return without(docs, leaks.select("doc_id"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    return packing.pack(spark, docs)


STAGES = [("quality classifier", quality_filter), ("line dedup", line_dedup), ("MinHash near-dedup", near_dedup),
          ("benchmark decontamination", decontamination), ("best-fit packing", pack)]

# Classifier, tokenizer and bin packing aren't SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of each is written and reread."""
    out = C.read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, out, sf_dir)
        if k + 1 < len(STAGES):
            out = C.written(spark, out, name.replace(" ", "-"))
    return out
