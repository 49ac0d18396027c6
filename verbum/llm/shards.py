"""Sharding by a two-pass external shuffle.

Pass 1 scatters the records into memory-sized buckets by a seeded hash of
``doc_id``; the buckets are Spark's shuffle files.  Pass 2 takes one bucket at
a time, applies a seeded Fisher-Yates shuffle and writes it.  The buckets laid
end to end are one random permutation of the corpus; cutting it at equal row
counts gives the shards, so shard counts are at most one apart (law ``rows``).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from verbum.llm import common as C

# Texts of one bucket together take about this much memory.
BUCKET_BYTES = 16 << 20


def record_size() -> F.Column:
    """UTF-8 bytes of the text (null: none) plus eight for the id."""
    return F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + F.lit(8)


def shuffle_into_shards(spark: SparkSession, docs: DataFrame, n_shards: int = 24, seed: int = 7,
                        bucket_bytes: int = BUCKET_BYTES, path: str | None = None) -> DataFrame:
    """Write ``docs`` (``doc_id``, ``text``) as ``n_shards`` shuffled shards and
    return them read back, with ``shard`` and the gapless ``slot`` in it.

    The same rows and seed give the same shards, however the rows are dealt
    over the input files.  Null ids are spread by their position in the scan;
    rows that repeat an id are all kept and stand in one bucket; null and empty
    texts are records without text.  An empty table gives no rows.  Columns
    other than the two are left out."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(record_size()).alias("b")).first()
    n, size = int(total["n"]), int(total["b"] or 0)
    n_buckets = max(2 * n_shards, math.ceil(size / bucket_bytes))
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64(
        F.lit(seed), F.coalesce(F.col("doc_id"), -1 - F.monotonically_increasing_id())), F.lit(n_buckets)).cast("int"))
    counts = dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    offsets = C.prefix_offsets(counts, "bucket", "n")

    def fisher_yates(key, table):
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])  # whatever order the rows came in
        order = np.random.Generator(np.random.PCG64([seed, key[0].as_py()])).permutation(table.num_rows)
        return table.take(pa.array(order)).append_column("rank", pa.array(np.arange(table.num_rows, dtype=np.int64)))

    mixed = dealt.groupBy("bucket").applyInArrow(fisher_yates, "doc_id long, text string, bucket int, rank long")
    small, large = divmod(n, n_shards)          # the first `large` shards have one row more
    edge = large * (small + 1)
    place = F.col("offset") + F.col("rank")
    shard = F.when(place < edge, F.floor(place / (small + 1))).otherwise(large + F.floor((place - edge) / max(small, 1)))
    start = F.when(F.col("shard") < large, F.col("shard") * (small + 1)).otherwise(edge + (F.col("shard") - large) * small)
    out = (mixed.join(C.maybe_broadcast(offsets, n_buckets), "bucket")
           .withColumn("shard", shard.cast("int"))
           .withColumn("slot", (place - start).cast("long"))
           .select("doc_id", "text", "slot", "shard"))
    path = path or C.shared_path(spark, "shards")
    out.write.partitionBy("shard").parquet(path)
    return spark.read.schema("doc_id long, text string, slot long, shard int").parquet(path)
