"""Registered queries of the training-data operators: each applies its operator
with production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from verbum.llm import common as C, hardneg, importance

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {"op12_importance_resampling": importance.ORACLE, "op13_hard_negatives": hardneg.ORACLE}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page url: given rules, then mined association rules."""
    from verbum.llm import urlfilter
    return urlfilter.judge_urls(spark, C.read(spark, sf_dir, "pages").select("page_id", "url"), C.read(spark, sf_dir, "labels"))


@query
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item, with the item and the overlaps."""
    from verbum.llm import decontaminate
    return decontaminate.find_leaks(spark, C.read(spark, sf_dir, "documents"), C.read(spark, sf_dir, "benchmark"), short_items=True)


@query
def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shuffled shards, read back from the written shards."""
    from verbum.llm import shards
    out = shards.shuffle_into_shards(spark, C.read(spark, sf_dir, "documents"), n_shards=24)
    return out.select("doc_id", shards.record_size().alias("size"),
                      F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
                      F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op4_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids in a token file, read back: place, length, checksum."""
    from verbum.llm import rans
    path = rans.write_token_file(spark, C.read(spark, sf_dir, "documents"))
    return rans.read_token_file(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram base score and interpolated bigram score of every document."""
    from verbum.llm import lm
    return lm.score_documents(spark, C.read(spark, sf_dir, "documents"))


@query
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with a two-word shingle similarity of 0.8."""
    from verbum.llm import neardup
    return neardup.near_duplicates(spark, C.read(spark, sf_dir, "documents"), width=2, similarity=80)


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' pieces packed into sequences of 2048 tokens."""
    from verbum.llm import packing
    return packing.pack(spark, C.read(spark, sf_dir, "documents"))


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole text; labels of the held-out third unseen."""
    from verbum.llm import quality
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(spark, docs, C.read(spark, sf_dir, "labels"), may_learn=quality.fold() != 1)
    return quality.with_scores(spark, docs, model).select(
        "doc_id", (quality.fold() == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SpotSigs fingerprints of every text, of its edited text, and how alike
    they and the next document's are."""
    from verbum.llm import spotsigs
    docs = C.read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return spotsigs.edited_fingerprints(spark, docs)


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the later copies of repeated line runs."""
    from verbum.llm import linededup
    return linededup.dedup_lines(spark, C.read(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every whole text; labels of the held-out fifth unseen."""
    from verbum.llm import toxicity
    return toxicity.score_documents(spark, C.read(spark, sf_dir, "documents"), C.read(spark, sf_dir, "labels"))


@query
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance weights of all documents towards the benchmark, and the draw."""
    return importance.resample(spark, C.read(spark, sf_dir, "documents"), C.read(spark, sf_dir, "benchmark"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth embedding, by positive."""
    rows = hardneg.quantized(C.read(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hardneg.mine(spark, rows, F.col("vec_id") % 100 == 0)


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over all documents, to packed sequences."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
