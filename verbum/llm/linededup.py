"""Line de-duplication by ranks of blocks of lines.

Distributed prefix doubling names every repeated block of 1, 2, 4, ... lines by
its rank among the blocks of that length, as deep as a block of ``MIN_WORDS``
words can be long.  Two overlapping ranks name any block of ``m`` lines; its
earliest place stays, the others are later copies.  No suffix array and no
longest common prefixes are computed.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from verbum.llm import common as C

MIN_WORDS = 10       # words that a repeated run of lines must have to be cut
SPLIT = re.compile(C.WORD_BREAK)


def line_array(text="text") -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def count_words(line: Column) -> Column:
    """Words of a line; none for a blank one."""
    return F.size(F.filter(F.split(line, C.WORD_BREAK), lambda w: w != ""))


def global_rank(spark: SparkSession, keys: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Distinct ``keys`` with their rank (a gapless long) in sorted order:
    range-partitioned sort, rows numbered in each range, ranges added up."""
    parted = C.written(spark, keys.repartitionByRange(C.partitions(spark), *columns)
                       .withColumn("_part", F.spark_partition_id()), name)
    sizes = parted.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    base = C.prefix_offsets(sizes, "_part", "_n")
    w = Window.partitionBy("_part").orderBy(*columns)
    return (parted.withColumn("_at", F.row_number().over(w)).join(F.broadcast(base), "_part")
            .select(*columns, (F.col("offset") + F.col("_at") - 1).cast("long").alias("rank")))


def blocks_of(before: np.ndarray, again: np.ndarray, min_words: int):
    """Blocks ``(i, m)`` of one document in which every line is repeated: the
    shortest with enough words from each line on, and up to each line.
    ``before`` are the words before each line, with the total at the end."""
    n = len(again)
    i = np.arange(n)
    end = np.searchsorted(before, before[:-1] + min_words)               # first place with enough words behind
    start = np.searchsorted(before, before[1:] - min_words, "right") - 1
    blocks = np.vstack([np.c_[i, end - i][end <= n], np.c_[start, i + 1 - start][start >= 0]])
    once = np.concatenate([[0], np.cumsum(~again)])                      # lines without another copy
    blocks = blocks[once[blocks[:, 0] + blocks[:, 1]] == once[blocks[:, 0]]]
    return np.unique(blocks, axis=0) if len(blocks) else blocks


def all_blocks(sequences: DataFrame, min_words: int) -> DataFrame:
    def work(batches):
        for pdf in batches:
            out = []
            for doc_id, key, words, again in zip(pdf["doc_id"], pdf["doc_key"], pdf["words"], pdf["again"], strict=True):
                for i, m in blocks_of(np.concatenate([[0], np.cumsum(words)]), np.asarray(again, bool), min_words):
                    k = int(m).bit_length() - 1
                    out.append((None if pd.isna(doc_id) else int(doc_id), key, int(i), int(m), k, int(i + m - (1 << k))))
            yield pd.DataFrame(out, columns=["doc_id", "doc_key", "i", "m", "k", "j"]).astype({"doc_id": "Int64"})

    return sequences.mapInPandas(work, "doc_id long, doc_key long, i int, m int, k int, j int")


def repeated_places(spark: SparkSession, docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``(doc_key, i, span)``: blocks of ``span`` lines from line ``i`` on (blank
    lines not counted) with at least ``min_words`` words that stand at an
    earlier place too.

    For each line the shortest block with enough words that starts there, and
    the shortest that ends there, are looked up.  The union of such blocks with
    an earlier copy is the union of all maximal repeated runs of enough words:
    a line of a run lies in the block that starts at it or, near the run's end,
    in the block that ends the run."""
    lines = (docs.select("doc_id", "doc_key", F.posexplode(line_array()).alias("at", "line"))
             .withColumn("words", count_words(F.col("line"))).where(F.col("words") > 0)
             .select("doc_id", "doc_key", "at", "words", F.xxhash64("line").alias("h"), F.hash("line").alias("h2"))
             .dropDuplicates(["doc_key", "at"]))      # rows that repeat id and text are one document
    lines = C.written(spark, lines, "lines")
    # round 0: ranks of the lines that occur more than once; a block with any other line is no copy
    again = lines.groupBy("h", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h", "h2")
    named = global_rank(spark, again, ["h", "h2"], "rank0")
    marked = lines.join(named, ["h", "h2"], "left")
    # each document's sequence; i counts the lines that aren't blank
    row = F.sort_array(F.collect_list(F.struct("at", "words", "rank")))
    seq = marked.groupBy("doc_key").agg(F.min("doc_id").alias("doc_id"), row.alias("s")).where(F.exists("s", lambda x: x["rank"].isNotNull()))
    seq = C.written(spark, seq.select(
        "doc_id", "doc_key", F.transform("s", lambda x: x["words"]).alias("words"), F.transform("s", lambda x: x["rank"]).alias("rank"),
        F.transform("s", lambda x: x["rank"].isNotNull()).alias("again")), "sequences")
    C.discard(spark, lines)
    levels = [seq.select(F.lit(0).alias("k"), "doc_key", F.posexplode("rank").alias("i", "rank")).where("rank IS NOT NULL")]
    for k in range(1, int(math.log2(max(min_words, 1))) + 1):    # no block has more lines than min_words
        have = levels[-1].select("doc_key", "i", F.col("rank").alias("a"))
        after = levels[-1].select("doc_key", (F.col("i") - (1 << (k - 1))).alias("i"), F.col("rank").alias("b"))
        pairs = C.written(spark, have.join(after, ["doc_key", "i"]), f"pairs{k}")
        multi = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a", "b")
        named = global_rank(spark, multi, ["a", "b"], f"rank{k}")
        levels.append(C.written(spark, pairs.join(named, ["a", "b"]).select(F.lit(k).alias("k"), "doc_key", "i", "rank"), f"level{k}"))
        C.discard(spark, pairs)
    ranks = levels[0]
    for level in levels[1:]:
        ranks = ranks.unionByName(level)
    blocks = all_blocks(seq.select("doc_id", "doc_key", "words", "again"), min_words)
    places = (blocks.join(ranks.withColumnRenamed("rank", "a"), ["k", "doc_key", "i"])
              .join(ranks.select("k", "doc_key", F.col("i").alias("j"), F.col("rank").alias("b")), ["k", "doc_key", "j"]))
    places = C.written(spark, places.select("doc_id", "doc_key", "i", "m", "a", "b"), "places")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "doc_key", "i")
    earliest = (places.groupBy("m", "a", "b").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("copies"))
                .where("copies > 1").drop("copies"))
    return (places.join(earliest, ["m", "a", "b"]).where(~place.eqNullSafe(F.col("first")))
            .select("doc_key", "i", F.col("m").alias("span")))


def cut_spans(text: pd.Series, starts: pd.Series, spans: pd.Series) -> pd.DataFrame:
    """The text without the lines of the spans; null where nothing is cut."""
    out = []
    for t, s, m in zip(text, starts, spans, strict=True):
        if t is None:
            out.append((None, 0, 0))
            continue
        lines = t.split("\n")
        full = [i for i, x in enumerate(lines) if SPLIT.sub("", x)]
        gone = {full[i] for a, b in zip(s, m, strict=True) for i in range(a, a + b)}
        out.append(("\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone), len(full) - len(gone)))
    return pd.DataFrame(out, columns=["text", "cut", "left"])


def dedup_lines(spark: SparkSession, docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with all its columns, ``text`` without the later copies of
    repeated line runs, and ``lines_cut``, ``lines_left`` (lines that aren't
    blank).

    Runs of lines with at least ``min_words`` words are looked for in all whole
    texts; the copy with the smallest ``(doc_id, line)`` stays (null ids come
    last).  Blank lines neither make nor break a run and are left where they
    are.  A line that is kept keeps its text.  Null and empty texts are left
    alone; rows that agree in id and text are one document and cut alike.
    Other columns pass through under any name; columns that are already called
    ``lines_cut`` or ``lines_left`` are replaced."""
    names = docs.columns
    others = F.struct(F.lit(True).alias("_"), *[F.col(f"`{c}`") for c in names if c != "text"])     # names can't clash in there
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("doc_key"), others.alias("row"))
    spans = C.written(spark, repeated_places(spark, keyed.where("text IS NOT NULL").select("doc_id", "doc_key", "text"), min_words), "spans")
    cuts = (spans.groupBy("doc_key").agg(F.collect_set(F.struct("i", "span")).alias("c"))
            .select("doc_key", F.col("c.i").alias("starts"), F.col("c.span").alias("spans")))
    out = (keyed.select("doc_key", "text", "row").join(cuts, "doc_key", "left")
           .withColumn("new", F.pandas_udf(cut_spans, "text string, cut int, left int")(F.when(F.col("starts").isNotNull(), F.col("text")), "starts", "spans")))
    full = F.size(F.filter(line_array(), lambda x: count_words(x) > 0))
    return out.select(*[F.coalesce("new.text", "text").alias("text") if c == "text" else F.col("row").getField(c).alias(c)
                        for c in names if c not in ("lines_cut", "lines_left")],
                      F.coalesce("new.cut", F.lit(0)).cast("long").alias("lines_cut"),
                      F.when(F.col("new.text").isNotNull(), F.col("new.left")).when(F.col("text").isNull(), 0).otherwise(full)
                      .cast("long").alias("lines_left"))
