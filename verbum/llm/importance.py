"""Target-distribution importance resampling with segment de-duplication.

Newlines separate words, so a text is the sequence of its lines: the counts of
features (runs of one to three words, hashed by crc32) inside a distinct line
are computed once and multiplied by the line's occurrences, and runs that cross
a line end are added document by document.  A document's weight is put together
in the same way from weights of distinct lines.

The crc32 of runs comes from the crc32 of single words: appending a word
multiplies the register by a power of x, which is a table lookup.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from verbum.llm import common as C

BUCKETS = 10_000
TEXT_BYTES = 2 << 20       # texts that a task cuts at once
HOT = 4096                 # lines with over 1/HOT of all line occurrences are joined by broadcast: at most HOT lines
CHUNK = 65_536             # equal rows that are written in one go

# Fixed value: after lower-casing A-Z, words are runs of other bytes than
# \x00-\x2F, \x3A-\x60 and \x7B-\x7F; here those bytes become spaces, but for
# the line end.
TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 or b == 10 else 32 for b in range(256))


def byte_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


BYTE = byte_table()


def step(crc: np.ndarray) -> np.ndarray:
    """The register after one more zero byte."""
    return BYTE[crc & np.uint32(255)] ^ (crc >> np.uint32(8))


def shift_tables(n: int) -> np.ndarray:
    """``[k, i, b]``: byte ``b`` at place ``i`` of a register, after ``k`` zero bytes."""
    out = np.empty((n, 4, 256), np.uint32)
    now = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * i) for i in range(4)])
    for k in range(n):
        out[k] = now
        now = step(now)
    return out


SHIFT = shift_tables(64)


def double_tables() -> list[np.ndarray]:
    """Tables of 64, 128, 256 ... zero bytes."""
    now, out = step(SHIFT[63]), []
    for _ in range(32):
        out.append(now)
        now = lookup(now, now)
    return out


def lookup(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """Registers through one table ``[i, b]`` or one of each element ``[element, i, b]``."""
    out = np.zeros_like(crc)
    for i in range(4):
        out ^= table[i][crc >> np.uint32(8 * i) & np.uint32(255)]
    return out


DOUBLE = double_tables()


def append(before: np.ndarray, crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """crc32 of two strings set together, from those of both and the length of
    the second."""
    flat, at = SHIFT.reshape(-1), (length & 63) * 1024
    out = np.zeros_like(before)
    for i in range(4):
        out ^= flat[at + 256 * i + (before >> np.uint32(8 * i) & np.uint32(255))]
    k, rest = 0, length >> 6
    while rest.any():
        odd = np.flatnonzero(rest & 1)
        out[odd] = lookup(DOUBLE[k], out[odd])
        k, rest = k + 1, rest >> 1
    return out ^ crc


def word_crcs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """crc32 of the words that start at ``starts``."""
    order = np.argsort(-np.minimum(lengths, 65), kind="stable")
    at, n = starts[order], lengths[order]
    crc = np.full(len(at), 0xFFFFFFFF, np.uint32)
    long = int(np.searchsorted(-n, -64, "left"))              # words of over 64 bytes come first
    for k in range(int(min(n.max(initial=0), 64))):
        live = int(np.searchsorted(-np.minimum(n, 65), -k, "left"))
        crc[long:live] = BYTE[(crc[long:live] ^ data[at[long:live] + k]) & np.uint32(255)] ^ (crc[long:live] >> np.uint32(8))
    crc ^= np.uint32(0xFFFFFFFF)
    for j in range(long):
        crc[j] = zlib.crc32(data[at[j]:at[j] + n[j]])
    out = np.empty_like(crc)
    out[order] = crc
    return out


SPACE = np.uint32(zlib.crc32(b" "))


def runs(data, starts, lengths, at2, at3):
    """crc32 of the pairs of words that start at the words ``at2`` and of the
    triples that start at ``at3``, and of all single words."""
    crc = word_crcs(data, starts, lengths)
    with_space = step(crc) ^ SPACE
    pair_at = np.union1d(at2, at3)
    pair = append(with_space[pair_at], crc[pair_at + 1], lengths[pair_at + 1])
    triple = append(step(pair[np.searchsorted(pair_at, at3)]) ^ SPACE, crc[at3 + 2], lengths[at3 + 2])
    return crc, pair[np.searchsorted(pair_at, at2)], triple


def bytes_of(texts: pa.Array) -> tuple[bytes, np.ndarray]:
    """The texts' bytes, each text closed by one separator, and where each
    begins; null texts are empty."""
    flat = pc.binary_join_element_wise(pc.fill_null(texts.cast(pa.large_string()), ""), pa.scalar("", pa.large_string()), pa.scalar("\x00", pa.large_string()))
    flat = flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat
    flat = flat.take(pa.array(np.arange(len(flat))))
    offsets = np.frombuffer(flat.buffers()[1], np.int64)[:len(flat) + 1]
    return (flat.buffers()[2].to_pybytes() if len(flat) else b"")[:int(offsets[-1])], offsets


def words_in(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes with words set free, and starts and lengths of the words."""
    data = np.frombuffer(raw.translate(TO_WORDS), np.uint8)
    word = (data != 32) & (data != 10)
    turn = np.flatnonzero(np.diff(np.r_[False, word, False].view(np.int8)))
    return data, turn[::2], turn[1::2] - turn[::2]


def line_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and number of the line of every run inside the lines ``texts``."""
    raw, offsets = bytes_of(texts)
    data, starts, lengths = words_in(raw)
    line = np.searchsorted(offsets, starts, "right") - 1
    at2, at3 = (np.flatnonzero(line[k:] == line[:max(len(line) - k, 0)]) for k in (1, 2))
    found = runs(data, starts, lengths, at2, at3)
    return np.concatenate(found) % np.uint32(BUCKETS), np.concatenate([line, line[at2], line[at3]])


def cut(docs: DataFrame) -> DataFrame:
    """Documents in segments: ``(row, doc_id, n_words, across, lines, times)``
    with the buckets of runs across line ends, and the md5 of each distinct line
    that has words, with how often the document has it."""
    def work(batches):
        C.give_back()
        for batch in batches:
            for part in C.text_batches(batch, limit=TEXT_BYTES):
                raw, offsets = bytes_of(part.column(2))
                data, starts, lengths = words_in(raw)
                n = len(starts)
                ends = np.flatnonzero(data == 10)
                doc = np.searchsorted(offsets, starts, "right") - 1
                line = np.searchsorted(ends, starts)
                at2, at3 = (np.flatnonzero((doc[k:] == doc[:max(n - k, 0)]) & (line[k:] != line[:max(n - k, 0)])) for k in (1, 2))
                # only the words next to a line end are needed
                need = np.unique(np.concatenate([at2, at2 + 1, at3, at3 + 1, at3 + 2]))
                here2, here3 = np.searchsorted(need, at2), np.searchsorted(need, at3)
                _, two, three = runs(data, starts[need], lengths[need], here2, here3)
                bucket = (np.concatenate([two, three]) % np.uint32(BUCKETS)).astype(np.int32)
                whose = np.concatenate([doc[at2], doc[at3]])
                order = np.argsort(whose, kind="stable")
                across = pa.ListArray.from_arrays(pa.array(np.searchsorted(whose[order], np.arange(part.num_rows + 1)).astype(np.int32)), pa.array(bucket[order]))
                first = np.flatnonzero(np.r_[True, (line[1:] != line[:-1]) | (doc[1:] != doc[:-1])]) if n else np.zeros(0, np.int64)
                keys = [{} for _ in range(part.num_rows)]
                close = np.r_[ends, len(raw)]
                for d, at, to in zip(doc[first].tolist(), line[first].tolist(), close[line[first]].tolist(), strict=True):
                    begin = max(int(offsets[d]), int(ends[at - 1]) + 1 if at else 0)
                    key = hashlib.md5(raw[begin:min(to, int(offsets[d + 1]) - 1)]).digest()
                    keys[d][key] = keys[d].get(key, 0) + 1
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.bincount(doc, minlength=part.num_rows).astype(np.int64)), across,
                     pa.array([list(k) for k in keys], pa.list_(pa.binary())), pa.array([list(k.values()) for k in keys], pa.list_(pa.int64()))],
                    ["row", "doc_id", "n_words", "across", "lines", "times"])
        C.give_back()

    return (docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(work, "row long, doc_id long, n_words long, across array<int>, lines array<binary>, times array<long>"))


def distinct_lines(docs: DataFrame) -> DataFrame:
    """``(line, n)``: every distinct line and how often the texts hold it."""
    lines = docs.select(F.explode(F.split("text", "\n", -1)).alias("line"))
    return lines.where("line != ''").groupBy("line").agg(F.count(F.lit(1)).alias("n"))


def histogram(total: np.ndarray):
    at = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])


def count_lines(lines: DataFrame) -> DataFrame:
    """``(bucket, n)``, a histogram of each task: counts of runs inside the
    lines, times the lines' occurrences."""
    def work(batches):
        C.give_back()
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in C.text_batches(batch, "line", TEXT_BYTES):
                bucket, line = line_features(part.column(0))
                np.add.at(total, bucket, part.column(1).to_numpy()[line])
        yield histogram(total)

    return lines.select("line", "n").mapInArrow(work, "bucket long, n long")


def count_across(segments: DataFrame) -> DataFrame:
    def work(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=BUCKETS)
        yield histogram(total)

    return segments.select("across").mapInArrow(work, "bucket long, n long")


def bucket_counts(lines: DataFrame, segments: DataFrame) -> np.ndarray:
    """How many features of the cut texts each bucket holds: ``BUCKETS`` numbers."""
    rows = count_lines(lines).unionByName(count_across(segments)).groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS, np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the ratio of both smoothed shares of each bucket."""
    s, t = float(raw.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((float(b + 1) * s) / (float(a + 1) * t))) for a, b in zip(raw.tolist(), target.tolist(), strict=True)], np.int64)


def weigh_lines(lines: DataFrame, shipped) -> DataFrame:
    """``(key, n, weight)``: md5, occurrences and sum of gains of every line."""
    def work(batches):
        C.give_back()
        gain = shipped.value
        for batch in batches:
            for part in C.text_batches(batch, "line", TEXT_BYTES):
                bucket, line = line_features(part.column(0))
                weight = np.zeros(part.num_rows, np.int64)
                np.add.at(weight, line, gain[bucket])
                keys = [hashlib.md5(x.as_buffer()).digest() for x in part.column(0)]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), part.column(1), pa.array(weight)], ["key", "n", "weight"])
        C.give_back()

    return lines.select("line", "n").mapInArrow(work, "key binary, n long, weight long")


def weigh_across(segments: DataFrame, shipped) -> DataFrame:
    def work(batches):
        gain = shipped.value
        for batch in batches:
            across = batch.column(3)
            n = pc.list_value_length(across).to_numpy(zero_copy_only=False)
            weight = np.zeros(batch.num_rows, np.int64)
            np.add.at(weight, np.repeat(np.arange(batch.num_rows), n), gain[across.flatten().to_numpy()])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(weight)], ["row", "doc_id", "n_words", "weight"])

    return segments.select("row", "doc_id", "n_words", "across").mapInArrow(work, "row long, doc_id long, n_words long, weight long")


def noise(seed: int):
    """floor of -1000 ln(-ln u), u from the sha256 of ``<seed>:<doc_id>``."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")).cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(spark: SparkSession, docs: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, seed: int = 42) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` for every row of ``docs``
    (``doc_id``, ``text``); ``target`` (``text``) sets the wanted distribution.

    ``weight`` adds the gains of a document's features, ``score`` adds Gumbel
    noise that the id decides, and of the N documents with at least
    ``min_words`` words the floor(percent * N / 100) highest scores are drawn
    and ranked from 1, ties to the smaller id; ``rank`` is null for the rest.

    Null and empty texts have no features and weight 0.  A row without id has no
    score, isn't counted in N and is never drawn.  Rows that repeat an id are
    rows of their own; where id, features and weight agree too, they take
    consecutive ranks.  Without any target text, gains follow the smoothed
    counts alone; an empty table gives an empty one.  Further columns are
    ignored.  Texts of any length are cut whole."""
    docs, target = docs.select("doc_id", "text"), target.select(F.lit(None).cast("long").alias("doc_id"), "text")
    counts, held = [], []
    for name, texts in (("docs", docs), ("target", target)):
        segments = C.written(spark, cut(texts), f"segments-{name}")
        lines = C.written(spark, distinct_lines(texts), f"lines-{name}")
        counts.append(bucket_counts(lines, segments))
        held.append((segments, lines))
    (segments, lines), shipped = held[0], spark.sparkContext.broadcast(gains(*counts))
    weights = C.written(spark, weigh_lines(lines, shipped), "line-weights")
    all_lines = weights.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    frequent = F.col("n") * HOT > all_lines              # so that there are fewer than HOT
    has = (segments.select("row", F.explode(F.arrays_zip("lines", "times")).alias("at"))
           .select("row", F.col("at.lines").alias("key"), F.col("at.times").alias("times")))
    hot = weights.where(frequent).select("key", F.col("weight").alias("hot_weight"))
    has = has.join(F.broadcast(hot), "key", "left")
    parts = (has.where("hot_weight IS NOT NULL").select("row", (F.col("hot_weight") * F.col("times")).alias("weight"))
             .unionByName(has.where("hot_weight IS NULL").join(weights.where(~frequent).select("key", "weight"), "key")
                          .select("row", (F.col("weight") * F.col("times")).alias("weight"))))
    none = F.lit(None).cast("long")
    whole = (parts.select("row", none.alias("doc_id"), none.alias("n_words"), "weight").unionByName(weigh_across(segments, shipped))
             .groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.sum("weight").alias("weight")))
    n = F.col("n_words")
    shares = (whole.withColumn("n_features", n + F.greatest(n - 1, F.lit(0)) + F.greatest(n - 2, F.lit(0)))
              .withColumn("score", F.col("weight") + noise(seed))
              .withColumn("fit", (n >= min_words) & F.col("doc_id").isNotNull())
              .groupBy("doc_id", "n_features", "weight", "score", "fit").agg(F.count(F.lit(1)).alias("m")))
    shares = C.written(spark, shares, "scores")
    C.discard(spark, *[t for pair in held for t in pair], weights)
    return ranked(spark, shares, percent)


def ranked(spark: SparkSession, shares: DataFrame, percent: int) -> DataFrame:
    """One row for each of the ``m`` rows that a row of ``shares`` stands for,
    with the rank of those that are drawn.  Ranks come from quantile ranges of
    the score: places inside a range, plus the sizes of the ranges before."""
    fit = C.with_range(shares.where("fit"), "score", C.partitions(spark), descending=True)
    inside = Window.partitionBy("_range").orderBy(F.desc("score"), "doc_id", "n_features", "weight").rowsBetween(Window.unboundedPreceding, -1)
    sizes = {r["_range"]: r["m"] for r in fit.groupBy("_range").agg(F.sum("m").alias("m")).collect()}     # a row for each range
    before, base = 0, []
    for k in sorted(sizes):
        base.append((k, before))
        before += sizes[k]
    drawn = percent * before // 100
    base = spark.createDataFrame(base, "_range int, _base long")
    fit = (fit.withColumn("_in", F.coalesce(F.sum("m").over(inside), F.lit(0))).join(F.broadcast(base), "_range")
           .withColumn("_before", F.col("_in") + F.col("_base")))
    names = ["doc_id", "n_features", "weight", "score", "m"]
    out = fit.select(*names, "_before").unionByName(shares.where("NOT fit").select(*names, F.lit(None).cast("long").alias("_before")))
    # equal rows are written out again in chunks
    out = out.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1, F.lit(CHUNK).cast("long"))))
    out = out.withColumn("_k", F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + CHUNK, F.col("m")) - 1)))
    rank = F.col("_before") + F.col("_k") + 1
    return out.select("doc_id", "n_features", "weight", "score", F.when(rank <= drawn, rank).alias("rank"))


# crc32 byte by byte over the hex digits of a feature; its table comes from the same rule as BYTE
ORACLE = r"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, i:
           CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
texts AS (
  SELECT 0 AS kind, row_number() OVER () AS k, doc_id, text FROM documents
  UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark),
split AS (
  SELECT kind, k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
features AS (
  SELECT kind, k, unnest(list_concat(w, list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]),
                                     list_transform(range(1, greatest(len(w) - 1, 1)), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f
  FROM split),
counted AS (SELECT kind, k, f, count(*) AS n FROM features GROUP BY ALL),
buckets AS (
  SELECT f, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(strlen(f)), lambda i: CAST('0x' || substr(hex(f), 2 * i + 1, 2) AS BIGINT))),
                                        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM counted), crc_table),
held AS (
  SELECT bucket, coalesce(sum(n) FILTER (kind = 0), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (kind = 1), 0)::DOUBLE AS t
  FROM counted JOIN buckets USING (f) GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(((t + 1) * ((SELECT sum(s) FROM held) + 10000)) / ((s + 1) * ((SELECT sum(t) FROM held) + 10000)))) AS BIGINT) AS g FROM held),
weights AS (SELECT k, sum(n * g) AS weight FROM counted JOIN buckets USING (f) JOIN gains USING (bucket) WHERE kind = 0 GROUP BY k),
scored AS (
  SELECT k, doc_id, len(w) AS n, CAST(len(w) + greatest(len(w) - 1, 0) + greatest(len(w) - 2, 0) AS BIGINT) AS n_features,
         CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST('0x' || substr(sha256('42:' || doc_id), 1, 8) AS BIGINT) AS h
  FROM split LEFT JOIN weights USING (k) WHERE kind = 0),
final AS (SELECT *, CAST(weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM scored),
ranked AS (SELECT k, row_number() OVER (ORDER BY score DESC, doc_id, n_features, weight) AS r FROM final WHERE n >= 20 AND doc_id IS NOT NULL)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 5 * (SELECT count(*) FROM ranked) // 100 THEN r END AS rank
FROM final LEFT JOIN ranked USING (k)
"""
