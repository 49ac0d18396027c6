"""Toxicity by a factorization machine over hashed terms.

A text's features are the hash buckets of its distinct terms; the logit is a
bias, a weight for each bucket and the inner product of factor vectors for
each pair of buckets, so that two terms may be toxic together that aren't
alone.  Fitted on a bounded sample of labelled rows on the driver; a bucket
that tells the labels apart too little there has weight and factors zero, so
that long texts don't add up noise.  Scored on every whole text by Arrow
batches.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from verbum.llm import common as C
from verbum.llm.quality import fold

BUCKETS = 1 << 18     # hash buckets of terms
FACTORS = 4           # length of a bucket's factor vector
SAMPLE_ROWS = 1500    # labelled rows of each label that the fit may use
SAMPLE_TEXT = 16384   # bytes; longer labelled texts aren't taken into the sample
MIN_DOCS = 4          # sample texts that must hold a bucket's term, else it stays zero
SCREEN = 5.0          # standard errors between the labels' shares that a bucket needs, else it stays zero
STEPS = 300
TEXT_BYTES = 1 << 20  # texts that a task scores at once


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of the distinct terms of whole texts, and offsets.

    Terms are the lower-cased runs of letters and digits of each word; hashing
    is done once for each distinct word of the slice."""
    codes, offsets, words = C.words_of(texts, lower=False)
    parts = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.utf8_lower(words), r"[^\p{L}\p{N}]+", " "))
    n = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    enc = parts.flatten().dictionary_encode()
    known = enc.dictionary
    bucket = (C.hash_words(known) % np.uint64(BUCKETS)).astype(np.int64)
    bucket[pc.equal(known, "").to_numpy(zero_copy_only=False)] = -1
    flat = bucket[enc.indices.to_numpy(zero_copy_only=False)] if len(enc) else np.zeros(0, np.int64)
    ends = np.concatenate([[0], np.cumsum(n)])
    doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
    pair = np.unique(doc * np.int64(max(len(words), 1)) + codes)           # distinct words of each text
    doc, code = pair // max(len(words), 1), pair % max(len(words), 1)
    times = n[code]
    at = np.repeat(ends[code], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    doc, found = np.repeat(doc, times), flat[at]
    pair = np.unique(doc[found >= 0] * np.int64(BUCKETS) + found[found >= 0])
    return pair % BUCKETS, np.searchsorted(pair // BUCKETS, np.arange(len(texts) + 1))


@dataclass
class Machine:
    """Bias, weights ``[slot]`` and factors ``[slot, k]`` of the buckets that
    aren't zero; ``slot`` maps buckets to them, or to -1."""
    bias: float
    slot: np.ndarray
    weight: np.ndarray
    factor: np.ndarray

    def logits(self, buckets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        at = self.slot[buckets]
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[at >= 0]
        return self.bias + pair_sums(at[at >= 0], doc, len(offsets) - 1, self.weight, self.factor)[0]

    def probabilities(self, buckets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(buckets, offsets), -40, 40)))


def pair_sums(at, doc, n, weight, factor) -> tuple[np.ndarray, np.ndarray]:
    """Weights plus inner products of all pairs of factors, for each text, in
    time of the terms: half the square of the sum less the sum of squares."""
    sums = np.zeros((n, factor.shape[1]))
    squares = np.zeros(n)
    if len(at):
        for k in range(factor.shape[1]):
            sums[:, k] = np.bincount(doc, factor[at, k], n)
        squares = np.bincount(doc, (factor[at] ** 2).sum(1), n)
    linear = np.bincount(doc, weight[at], n) if len(at) else np.zeros(n)
    return linear + ((sums ** 2).sum(1) - squares) / 2, sums


def screened(buckets: np.ndarray, offsets: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Buckets that at least ``MIN_DOCS`` texts have and whose share of texts
    differs between the labels by at least ``SCREEN`` standard errors."""
    toxic = np.repeat(y == 1, np.diff(offsets))
    have = [np.bincount(buckets[toxic == k], minlength=BUCKETS) for k in (False, True)]
    n = [(y != 1).sum(), (y == 1).sum()]
    share = (have[0] + have[1]) / len(y)
    error = np.sqrt(share * (1 - share) * (1 / n[0] + 1 / n[1])) + 1e-12
    return np.flatnonzero((have[0] + have[1] >= MIN_DOCS) & (np.abs(have[1] / n[1] - have[0] / n[0]) >= SCREEN * error))


def fit_machine(buckets: np.ndarray, offsets: np.ndarray, y: np.ndarray, seed: int = 7, steps: int = STEPS,
                rate: float = 0.05, ridge: float = 2e-4) -> Machine:
    """Adam over the whole sample on the log loss, classes weighted alike, with
    a square penalty on weights and factors of the screened buckets."""
    rng = np.random.default_rng(seed)
    used = screened(buckets, offsets, y)
    slot = np.full(BUCKETS, -1, np.int64)
    slot[used] = np.arange(len(used))
    at = slot[buckets]
    doc, at = np.repeat(np.arange(len(y)), np.diff(offsets))[at >= 0], at[at >= 0]
    balance = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y != 1).sum())
    p = [np.zeros(len(used)), rng.normal(0, 0.1, (len(used), FACTORS)), np.zeros(1)]
    m, u = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p]
    for t in range(1, steps + 1):
        w, v, bias = p
        logit, sums = pair_sums(at, doc, len(y), w, v)
        err = (1 / (1 + np.exp(-np.clip(logit + bias[0], -40, 40))) - y) * balance
        dw = np.bincount(at, err[doc], len(used))
        dv = np.stack([np.bincount(at, err[doc] * sums[doc, k], len(used)) for k in range(FACTORS)], 1) - v * dw[:, None]
        for k, g in enumerate((dw + ridge * w, dv + ridge * v, np.array([err.sum()]))):
            m[k] += 0.1 * (g - m[k])
            u[k] += 0.001 * (g * g - u[k])
            p[k] = p[k] - rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(u[k] / (1 - 0.999 ** t)) + 1e-8)
    return Machine(float(p[2][0]), slot, p[0], p[1])


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, may_learn: Column | None = None) -> Machine:
    """The machine from at most ``sample_rows`` labelled documents of each
    label, chosen by the hash of their id; rows with a null id or label are left
    out, and a document that is ever labelled 1 is labelled 1.  The bias is
    moved to the labels' true shares.  Without rows of both labels every text
    gets even odds, or the odds of the one label."""
    marked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
              .dropna().where(may_learn if may_learn is not None else F.lit(True))
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(F.col("toxic").isin(0, 1)))
    share = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}           # two rows
    picked = None
    for label in (0, 1):
        part = marked.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
        picked = part if picked is None else picked.unionByName(part)
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
            .where(F.octet_length("text") <= SAMPLE_TEXT)
            .join(F.broadcast(picked), "doc_id")                       # at most 2 * sample_rows ids
            .dropDuplicates(["doc_id"]).toArrow().sort_by("doc_id"))
    y = rows.column("toxic").to_numpy().astype(np.float64)
    if not len(y) or y.min() == y.max():
        return Machine(0.0 if not len(y) else (4.0 if y[0] else -4.0), np.full(BUCKETS, -1, np.int64), np.zeros(0), np.zeros((0, FACTORS)))
    buckets, offsets = terms(rows.column("text").combine_chunks())
    machine = fit_machine(buckets, offsets, y)
    machine.bias += float(np.log(share[1] / share[0]))                 # fitted with both labels alike
    del rows, buckets
    C.give_back()
    return machine


def with_scores(spark: SparkSession, docs: DataFrame, machine: Machine, column: str = "score") -> DataFrame:
    """``docs`` with all its columns and the probability of label 1 of each
    whole text; null and empty texts get that of no terms at all, equal texts
    equal scores, rows without id a score as well.  A column of the name
    ``column`` is replaced; others of any name stay.  An empty table gives an
    empty one."""
    shipped = spark.sparkContext.broadcast(machine)
    docs = docs.drop(column)
    schema, names = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]), docs.columns
    text = names.index("text")

    def score(batches):
        C.give_back()
        machine = shipped.value
        for batch in batches:
            for part in C.text_batches(batch.rename_columns([f"c{k}" for k in range(len(names))]), f"c{text}", TEXT_BYTES):
                p = machine.probabilities(*terms(part.column(text)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p, pa.float64())], [*names, column])
        C.give_back()

    return docs.mapInArrow(score, schema)


def score_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for each row of ``docs``; the
    machine learns from labels outside the held-out fifth.  A row without id is
    never learnt from and counts as held out."""
    docs = docs.select("doc_id", "text")
    machine = fit(spark, docs, labels, may_learn=fold(modulus=5) != 0)
    return with_scores(spark, docs, machine).select(
        "doc_id", F.coalesce(fold(modulus=5) == 0, F.lit(True)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
