"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from verbum.session import checkpoint_dir

# Fixed value: separators of words, space and the controls \x09 to \x0D.
WORD_BREAK = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Largest table that the operators broadcast on their own decision, in rows of
# a few machine words each; the row count is taken before.
BROADCAST_ROWS = 1_000_000
# Functions that drop what a Python worker remembers from earlier tasks.
WORKER_CACHES = []


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the driver and all executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here, so
    a lost executor costs a reread and not a recomputation."""
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete written tables that no later plan reads."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for t in tables:
        path = jvm.org.apache.hadoop.fs.Path(t._written_to)
        path.getFileSystem(conf).delete(path, True)


def maybe_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint when the counted rows stay within ``BROADCAST_ROWS``."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words_of(texts: pa.Array, lower: bool = True):
    """Words of whole texts: ``(codes, offsets, dictionary)``.

    Row ``i`` has the words ``dictionary[codes[offsets[i]:offsets[i + 1]]]``;
    a null text has none.  Only A-Z are lower-cased."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    texts = texts.take(pa.array(np.arange(len(texts))))       # ascii_lower misreads the offsets of a slice
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    flat = lists.flatten()
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False).astype(bool)
    offsets = np.concatenate([[0], np.cumsum(full)])[ends].astype(np.int64)
    coded = flat.filter(pa.array(full)).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), offsets, coded.dictionary


def hash_words(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string, the same on every machine."""
    if not len(words):
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False).astype(object), categorize=False).astype(np.uint64)


def mix(a: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift and multiply)."""
    a = np.asarray(a, np.uint64).copy()
    with np.errstate(over="ignore"):
        a ^= a >> np.uint64(30)
        a *= np.uint64(0xBF58476D1CE4E5B9)
        a ^= a >> np.uint64(27)
        a *= np.uint64(0x94D049BB133111EB)
        a ^= a >> np.uint64(31)
    return a


def join_hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Order-dependent hash of pairs of hashes."""
    with np.errstate(over="ignore"):
        return mix(a * np.uint64(0x9E3779B97F4A7C15) + mix(b))


def text_batches(batch: pa.RecordBatch, column: str = "text", limit: int = 8 << 20):
    """Cut an Arrow batch where its texts pass ``limit`` bytes, so that memory
    follows one slice; a longer text is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(n)
    if start < len(sizes):
        yield batch.slice(start)


def give_back(caches: bool = True) -> None:
    """Return this process's free memory to the machine, and (``caches``) what
    other operators left in it: Spark uses its Python workers again, so that a
    stage would pay for the one before."""
    for clear in WORKER_CACHES if caches else ():
        clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
    if trim:
        trim(0)


def vocabulary_file(name: str) -> str:
    """Place of a public vocabulary file; never copied into the repository."""
    import public_tokenizers
    return public_tokenizers.path(name)


def prefix_offsets(counts: DataFrame, key: str, n: str, block: int = 4096) -> DataFrame:
    """``key -> offset``: the sum of ``n`` over all smaller integer keys.

    Two levels: windows inside blocks of keys, and one over the block totals,
    so that no task takes more than ``block`` keys or all block totals."""
    from pyspark.sql import Window
    at = counts.select(F.col(key), F.col(n).alias("_n"), F.floor(F.col(key) / block).alias("_block"))
    inner = Window.partitionBy("_block").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = (at.groupBy("_block").agg(F.sum("_n").alias("_n"))
              .select("_block", F.coalesce(F.sum("_n").over(outer), F.lit(0)).alias("_base")))
    return (at.withColumn("_in", F.coalesce(F.sum("_n").over(inner), F.lit(0)))
            .join(totals, "_block").select(key, (F.col("_base") + F.col("_in")).alias("offset")))


def with_range(docs: DataFrame, key: str, n: int, descending: bool = False) -> DataFrame:
    """``docs`` with ``_range``: the number of the quantile range that the
    integer ``key`` lies in, from 0, in the order of the key.  Null keys have a
    range of their own, the first (descending: the last)."""
    cuts = docs.agg(F.percentile_approx(key, [k / n for k in range(1, n)], 100 * n).alias("q")).first()["q"]
    cuts = F.array(*[F.lit(c) for c in sorted(set(cuts or []))]).cast("array<bigint>")
    here = (lambda c: c > F.col(key)) if descending else (lambda c: c < F.col(key))
    place = F.size(F.filter(cuts, here)) + (0 if descending else 1)
    null = F.size(cuts) + 1 if descending else F.lit(0)
    return docs.withColumn("_range", F.when(F.col(key).isNull(), null).otherwise(place).cast("int"))
