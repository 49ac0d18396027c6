"""Quality classifier: random-indexing word vectors, pooled per document, and a
two-layer numpy network with temperature-calibrated probabilities.

Fitted on a bounded sample of labelled rows on the driver; scored on every
whole text by Arrow batches.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from verbum.llm import common as C

DIM = 48              # dimensions of index and context vectors
NONZERO = 6           # entries of a sparse index vector
WINDOW = 2            # neighbours on each side that make a word's context
SAMPLE_ROWS = 1200    # labelled rows of each label that the fit may use
SAMPLE_TEXT = 32768   # bytes; longer labelled texts aren't taken into the sample
MIN_COUNT = 5         # sample occurrences that give a word a context vector of its own
HIDDEN = 32


def index_vectors(hashes: np.ndarray) -> np.ndarray:
    """Sparse random vectors with entries +1 and -1, derived from word hashes."""
    out = np.zeros((len(hashes), DIM), np.float32)
    rows = np.arange(len(hashes))
    for k in range(NONZERO):
        h = C.mix(hashes + np.uint64(k + 1))
        out[rows, (h % np.uint64(DIM)).astype(np.int64)] += np.where((h >> np.uint64(40)) & np.uint64(1), 1.0, -1.0)
    return out / np.float32(np.sqrt(NONZERO))


def units(words: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Core (lower-cased letters and digits) and form (its case pattern with
    the punctuation around it) of each word."""
    core = pc.replace_substring_regex(words, r"[^\p{L}\p{N}]+", "")
    marks = pc.replace_substring_regex(words, r"[\p{L}\p{N}]+", "")
    case = pc.if_else(pc.and_(pc.utf8_is_upper(core), pc.greater(pc.utf8_length(core), 1)), "A",
                      pc.if_else(pc.utf8_is_title(core), "T", pc.if_else(pc.equal(core, ""), "_", "a")))
    return pc.utf8_lower(core), pc.binary_join_element_wise(case.cast(pa.large_string()), marks.cast(pa.large_string()), pa.scalar("~", pa.large_string()))


@dataclass
class Vectors:
    """Context vectors of the units that the sample holds often enough."""
    cores: pa.Array
    core_vectors: np.ndarray
    forms: pa.Array
    form_vectors: np.ndarray

    def of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Vectors (known units; zero for the rest) and index vectors of words,
        and whether the core is known."""
        core, form = units(words)
        vec = np.zeros((len(words), 2 * DIM), np.float32)
        for side, known, table in ((0, self.cores, self.core_vectors), (1, self.forms, self.form_vectors)):
            at = pc.fill_null(pc.index_in((core, form)[side], value_set=known), -1).to_numpy(zero_copy_only=False)
            found = at >= 0 if side == 0 else found
            vec[at >= 0, side * DIM:(side + 1) * DIM] = table[at[at >= 0]]
        return vec, index_vectors(C.hash_words(core)), found


def learn_vectors(texts: list[str]) -> Vectors:
    """Random indexing: a unit's vector is the sum of the index vectors of the
    forms and cores next to its occurrences, scaled to length one."""
    codes, offsets, words = C.words_of(pa.array(texts, pa.large_string()), lower=False)
    doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
    found = []
    core, form = units(words)
    index = index_vectors(C.hash_words(core))
    index += index_vectors(C.hash_words(form))
    for unit in (core, form):
        enc = unit.dictionary_encode()
        ids = enc.indices.to_numpy(zero_copy_only=False)[codes]
        n = np.bincount(ids, minlength=len(enc.dictionary))
        keep = np.flatnonzero(n >= MIN_COUNT)
        slot = np.full(len(n), -1)
        slot[keep] = np.arange(len(keep))
        at = slot[ids]
        total = np.zeros((len(keep), DIM), np.float32)
        for d in range(1, WINDOW + 1):
            for a, b in ((slice(None, -d), slice(d, None)), (slice(d, None), slice(None, -d))):
                ok = (doc[a] == doc[b]) & (at[a] >= 0)
                pair, m = np.unique(at[a][ok] * np.int64(len(index)) + codes[b][ok], return_counts=True)
                for lo in range(0, len(pair), 50_000):
                    some = pair[lo:lo + 50_000]
                    np.add.at(total, some // len(index), index[some % len(index)] * m[lo:lo + 50_000, None].astype(np.float32))
        total /= np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-6)
        found += [enc.dictionary.take(pa.array(keep)), total]
    return Vectors(*found)


def pooled(texts: pa.Array, vectors: Vectors, chunk: int = 20_000) -> np.ndarray:
    """Features of whole texts: the mean word vector; the concentration of the
    index vectors; how alike neighbouring words are; the share of known words;
    the number of words."""
    codes, offsets, words = C.words_of(texts, lower=False)
    out = np.zeros((len(texts), 2 * DIM + 4), np.float32)
    vec, index, found = vectors.of(words)
    start = 0
    while start < len(texts):                       # a slice of documents with about `chunk` words
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + chunk, "right")) - 1)
        n = np.diff(offsets[start:stop + 1])
        sums = np.zeros((stop - start, 3 * DIM + 2), np.float64)
        for lo in range(offsets[start], offsets[stop], chunk):      # a longer text comes in parts
            c = codes[lo:min(lo + chunk, offsets[stop])]
            doc = np.searchsorted(offsets, np.arange(lo, lo + len(c)), "right") - 1 - start
            after = codes[lo + 1:lo + len(c) + 1]
            alike = np.zeros(len(c), np.float32)
            alike[:len(after)] = np.einsum("ij,ij->i", index[c[:len(after)]], index[after])
            ends = offsets[1:][(offsets[1:] > lo) & (offsets[1:] <= lo + len(c))] - 1 - lo
            alike[ends] = 0
            first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
            known = found[c].astype(np.float32)
            sums[doc[first]] += np.add.reduceat(np.hstack([vec[c], index[c], alike[:, None], known[:, None]]), first, axis=0)
        m = np.maximum(n, 1)[:, None]
        mean = sums / m
        out[start:stop] = np.hstack([mean[:, :2 * DIM], np.linalg.norm(mean[:, 2 * DIM:3 * DIM], axis=1, keepdims=True),
                                     sums[:, -2:-1] / np.maximum(n - 1, 1)[:, None], mean[:, -1:], np.log1p(n)[:, None] / 10])
        start = stop
    return out


@dataclass
class Network:
    """Two layers: tanh units, then one logit divided by the temperature."""
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def fit_network(x: np.ndarray, y: np.ndarray, seed: int = 11, epochs: int = 60, batch: int = 128) -> Network:
    """Adam on the cross entropy, classes weighted alike; the temperature is the
    one that gives held-back fifths of the sample the least log loss."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    back, rest = order[: len(y) // 5], order[len(y) // 5:]
    mean, scale = x[rest].mean(0), x[rest].std(0) + 1e-3
    d = x.shape[1]
    p = [rng.normal(0, 1 / np.sqrt(d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    weight = np.where(y == 1, 0.5 / max(y[rest].mean(), 1e-3), 0.5 / max(1 - y[rest].mean(), 1e-3))
    z = (x - mean) / scale
    for _ in range(epochs):
        rng.shuffle(rest)
        for s in range(0, len(rest), batch):
            i = rest[s:s + batch]
            h = np.tanh(z[i] @ p[0] + p[1])
            err = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -40, 40))) - y[i]) * weight[i] / len(i)
            back_h = np.outer(err, p[2]) * (1 - h * h)
            grads = [z[i].T @ back_h + 1e-4 * p[0], back_h.sum(0), h.T @ err + 1e-4 * p[2], np.array([err.sum()])]
            t += 1
            for k, g in enumerate(grads):
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.001 * (g * g - v[k])
                p[k] = p[k] - 0.01 * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
    net = Network(mean, scale, p[0], p[1], p[2], float(p[3][0]))
    if len(back):
        logit = net.logits(x[back])
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
        loss = [np.logaddexp(0, np.where(y[back] == 1, -1, 1) * logit / g).mean() for g in grid]
        net.temperature = float(grid[int(np.argmin(loss))])
    return net


def fold(doc_id="doc_id", modulus: int = 3) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(modulus))


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS,
        may_learn: Column | None = None) -> tuple[Vectors, Network]:
    """Vectors and network from at most ``sample_rows`` labelled documents of
    each label, chosen by the hash of their id; rows with a null id or label are
    left out, and of repeated labels of a document the smallest counts."""
    marked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
              .dropna().where(may_learn if may_learn is not None else F.lit(True))
              .groupBy("doc_id").agg(F.min("quality").alias("quality")).where(F.col("quality").isin(0, 1)))
    picked = None
    for label in (0, 1):
        part = marked.where(F.col("quality") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
        picked = part if picked is None else picked.unionByName(part)
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
            .where(F.octet_length("text") <= SAMPLE_TEXT)
            .join(F.broadcast(picked), "doc_id")            # at most 2 * sample_rows ids
            .dropDuplicates(["doc_id"]).toArrow().sort_by("doc_id"))
    texts, y = rows.column("text").to_pylist(), rows.column("quality").to_numpy().astype(np.float64)
    vectors = learn_vectors(texts)
    x = np.concatenate([np.zeros((0, 2 * DIM + 4)), *[pooled(pa.array(texts[lo:lo + 200], pa.large_string()), vectors) for lo in range(0, len(texts), 200)]])
    if not len(y) or y.min() == y.max():             # nothing to tell apart: the one label, or even odds
        net = Network(np.zeros(2 * DIM + 4), np.ones(2 * DIM + 4), np.zeros((2 * DIM + 4, HIDDEN)), np.zeros(HIDDEN),
                      np.zeros(HIDDEN), 0.0 if not len(y) else (4.0 if y[0] else -4.0))
    else:
        net = fit_network(x, y)
    del rows, texts, x
    C.give_back()
    return vectors, net


def with_scores(spark: SparkSession, docs: DataFrame, model: tuple[Vectors, Network], column: str = "score") -> DataFrame:
    """``docs`` with all its columns and the probability of label 1 of each
    whole text; null and empty texts have a score too.  A column of the name
    ``column`` is replaced."""
    shipped = spark.sparkContext.broadcast(model)
    docs = docs.drop(column)
    schema, names = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]), docs.columns

    def score(batches):
        C.give_back()
        vectors, net = shipped.value
        for batch in batches:
            for part in C.text_batches(batch, limit=1 << 20):
                p = net.probabilities(pooled(part.column(names.index("text")), vectors).astype(np.float64))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p, pa.float64())], [*names, column])
        C.give_back()

    return docs.mapInArrow(score, schema)
