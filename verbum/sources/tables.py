"""Parquet tables of a scale-factor folder and the corpus views built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _spread(spark: SparkSession, df: DataFrame, key: str) -> DataFrame:
    """Hash-partition a scan by ``key`` when it arrives in fewer splits than
    the cluster has cores (a single small file).  Large inputs keep their
    file splits: re-shuffling raw text would cost more than it saves.  The
    per-document aggregations downstream then need no further exchange
    because HashPartitioning(doc_id) satisfies grouping on (doc_id, ...)."""
    parallelism = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < parallelism:
        return df.repartition(parallelism, key)
    return df


def documents(spark: SparkSession, sf_dir: str, columns=("doc_id", "text")) -> DataFrame:
    """The corpus: one row per document."""
    df = table(spark, sf_dir, "documents").select(*columns)
    return _spread(spark, df, "doc_id")


def documents_by_id(spark: SparkSession, sf_dir: str, columns=("doc_id", "text")) -> DataFrame:
    """The corpus hash-partitioned by ``doc_id``: one exchange of the raw text.
    Grouping and windows on (doc_id, ...) over its exploded tokens, which are
    several times the text, then need none."""
    return table(spark, sf_dir, "documents").select(*columns).repartition("doc_id")


# Fixed split rule of the labelled corpus: every fifth document id is held
# out for testing, all others train.  Both parts are used in full.
TEST_MODULUS = 5


def labelled_corpus(spark: SparkSession, sf_dir: str, label: str = "quality") -> DataFrame:
    """``documents ⋈ labels`` with columns doc_id, text, label (string), split."""
    docs = documents(spark, sf_dir)      # spread before the join: asking a join for its partitions runs it
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col(label).cast("string").alias("label"))
    return (docs.join(labels, "doc_id")
            .withColumn("split", F.when(F.col("doc_id") % TEST_MODULUS == 0, F.lit("test"))
                        .otherwise(F.lit("train"))))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense vectors (vec_id, embedding array<float>, label)."""
    return table(spark, sf_dir, "embeddings")
