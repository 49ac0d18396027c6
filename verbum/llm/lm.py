"""Language-model scores by deleted interpolation.

The probability of a token is a mixture of its relative frequency behind the
token before it, its relative frequency, and a uniform share.  The weights
depend on how often the context was seen (a bucket each for 1, 2 and 3 times,
then one for each power of two) and are learned by expectation-maximisation on held-out counts: the development
fold of the training documents is scored with the counts of the others.

Counts cover the whole corpus and never sit in one place.  Documents are held
in chunks; a chunk asks for the totals of its distinct words and word pairs, the
requests are added up by hash range, and the totals go back to the chunk.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from verbum.llm import common as C

MIN_CONTEXT = 1        # a context that was never seen has no distribution of its own
OWN = 4                # contexts seen less often have a bucket for each count
CHUNK = 16 << 20       # text bytes of a chunk
FOLDS, HELD, DEV = 7, 2, 3          # crc32(doc_id as text) mod 7: held out; development fold
END, START = np.uint64(0x454E44), np.uint64(0x53544152)    # hashes of the end token and of the place before a text
GRID = 16              # steps per factor of ten in the histogram that EM reads
BUCKETS = 48


def fold(doc_id="doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS)), F.lit(0)).cast("int")


def pack(a: np.ndarray) -> bytes:
    """Compressed array, byte planes apart."""
    a = np.ascontiguousarray(a)
    return zstandard.ZstdCompressor(level=3).compress(a.view(np.uint8).reshape(len(a), -1).T.tobytes())


def unpack(data, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(raw.T).view(kind).reshape(-1)


def pack_sorted(h: np.ndarray) -> bytes:
    return pack(np.diff(h, prepend=np.uint64(0)))


def unpack_sorted(data) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def ranges(h: np.ndarray, parts: int) -> np.ndarray:
    """Borders in sorted hashes of ``parts`` equal ranges of hash values."""
    edges = np.array([((k << 64) // parts) for k in range(1, parts)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(h, edges), [len(h)]])


def chunks_of(docs: DataFrame) -> DataFrame:
    """Chunks of whole documents: ids, fold, number of tokens, the sorted word
    hashes and each token's place in them.  The development fold has chunks of
    its own."""
    def work(batches):
        seq = 0
        for batch in batches:
            folds = batch.column(1).to_numpy(zero_copy_only=False)
            for dev in (True, False):
                mine = batch.filter(pa.array((folds == DEV) == dev))
                for part in C.text_batches(mine, "text", CHUNK):
                    codes, offsets, words = C.words_of(part.column(2))
                    hashes = np.concatenate([C.hash_words(words), [END]]).astype(np.uint64)
                    n = np.diff(offsets) + 1
                    token = np.full(int(n.sum()), len(words), np.int64)
                    inside = np.ones(len(token), bool)
                    inside[np.cumsum(n) - 1] = False
                    token[inside] = codes
                    sorted_h, back = np.unique(hashes, return_inverse=True)
                    # frequent words get small numbers, which pack better
                    place = back[token].astype(np.int64)
                    by = np.argsort(-np.bincount(place, minlength=len(sorted_h)), kind="stable")
                    number = np.empty(len(by), np.int64)
                    number[by] = np.arange(len(by))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([(TaskContext.get().partitionId() << 24) + seq]), pa.array([dev]), pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
                         pa.array([pack(part.column(1).to_numpy(zero_copy_only=False).astype(np.uint8))]), pa.array([pack(n.astype(np.uint32))]),
                         pa.array([pack_sorted(sorted_h)]), pa.array([pack(by.astype(np.uint32))]), pa.array([pack(number[place].astype(np.uint32))])],
                        ["chunk", "dev", "doc_ids", "folds", "lengths", "words", "order", "tokens"])
                    seq += 1

    return docs.mapInArrow(work, "chunk long, dev boolean, doc_ids array<long>, folds binary, lengths binary, words binary, order binary, tokens binary")


def rows_of(batches):
    """Rows as dicts, one in memory at a time, with the memory of the last one
    given back."""
    C.give_back()
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]
            C.give_back(caches=False)


class Chunk:
    """A chunk's arrays: word hashes, tokens (places in them), documents, folds."""

    def __init__(self, row: dict):
        self.doc_ids = row["doc_ids"]
        self.folds, self.n = unpack(row["folds"], np.uint8), unpack(row["lengths"], np.uint32).astype(np.int64)
        self.words = unpack_sorted(row["words"])
        self.token = unpack(row["order"], np.uint32).astype(np.int64)[unpack(row["tokens"], np.uint32)]
        self.doc = np.repeat(np.arange(len(self.n)), self.n)
        self.fold = self.folds[self.doc]

    def pairs(self, totals: np.ndarray):
        """Distinct pairs worth counting: ``(hashes, pair of each such token,
        the tokens)``.  Context and word must have been seen in training."""
        starts = np.cumsum(self.n) - self.n
        before = np.concatenate([[0], self.token[:-1]])
        seen = totals[0][before] >= MIN_CONTEXT
        seen[starts] = True
        at = np.flatnonzero(seen & (totals[0][self.token] > 0))
        left = self.words[before]
        left[starts] = START
        h, back = np.unique(C.join_hashes(left[at], self.words[self.token[at]]), return_inverse=True)
        return h, back, at


def counts_in(place: np.ndarray, fold: np.ndarray, n: int) -> np.ndarray:
    """Training occurrences, and those in the development fold."""
    return np.stack([np.bincount(place[fold != HELD], minlength=n), np.bincount(place[fold == DEV], minlength=n)]).astype(np.uint32)


def requests(chunk: int, h: np.ndarray, counts: np.ndarray, parts: int) -> pa.RecordBatch:
    cut = ranges(h, parts)
    full = [p for p in range(parts) if cut[p + 1] > cut[p]]
    return pa.RecordBatch.from_arrays(
        [pa.array(full, pa.int32()), pa.array([chunk] * len(full), pa.int64()), pa.array([pack_sorted(h[cut[p]:cut[p + 1]]) for p in full], pa.binary()),
         pa.array([pack(counts[:, cut[p]:cut[p + 1]].reshape(-1)) for p in full], pa.binary())], ["part", "chunk", "hashes", "counts"])


REQUEST = "part int, chunk long, hashes binary, counts binary"
REPLY = "part int, chunk long, counts binary"


def add_up(asked: DataFrame, parts: int) -> DataFrame:
    """Totals for each chunk's hashes in the order they were asked for; chunk -1
    has the number of distinct trained hashes and their occurrences."""
    def work(key, table):
        hashes = [unpack_sorted(x.as_buffer()) for x in table.column("hashes")]
        sizes = [len(x) for x in hashes]
        distinct, place = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.zeros((2, len(distinct)), np.int64)
        counts = np.concatenate([unpack(x.as_buffer(), np.uint32).reshape(2, -1) for x in table.column("counts")], axis=1)
        for k in (0, 1):
            total[k] = np.bincount(place, weights=counts[k], minlength=len(distinct)).astype(np.int64)
        ends = np.cumsum(sizes)
        replies = [pack(total[:, place[b - n:b]].astype(np.uint64).reshape(-1)) for b, n in zip(ends, sizes, strict=True)]
        stats = pack(np.array([(total[0] > 0).sum(), total[0].sum(), total[1].sum()], np.uint64))
        chunks = [*table.column("chunk").to_pylist(), -1]
        return pa.table({"part": pa.array([key[0].as_py()] * len(chunks), pa.int32()), "chunk": pa.array(chunks, pa.int64()),
                         "counts": pa.array([*replies, stats], pa.binary())})

    return asked.repartition(parts, "part").groupBy("part").applyInArrow(work, REPLY)


def gathered(replies: DataFrame, name: str) -> DataFrame:
    return (replies.where("chunk >= 0").groupBy("chunk")
            .agg(F.transform(F.sort_array(F.collect_list(F.struct("part", "counts"))), lambda x: x["counts"]).alias(name)))


def totals_of(blobs) -> np.ndarray:
    return np.concatenate([unpack(b, np.uint64).astype(np.int64).reshape(2, -1) for b in blobs], axis=1) if blobs else np.zeros((2, 0), np.int64)


def bucket(c: np.ndarray) -> np.ndarray:
    """The count itself below ``OWN`` (0: never seen), then one for each power of two."""
    power = np.log2(np.maximum(c, 1)).astype(np.int64) + OWN - int(np.log2(OWN))
    return np.where(c < OWN, np.maximum(c, 0), np.minimum(power, BUCKETS - 1))


def parts_of(ch: Chunk, words: np.ndarray, pairs: np.ndarray, h_back_at, n: int, n_contexts: int):
    """Per token: context bucket, bigram and unigram relative frequencies, from
    one column of counts."""
    h, back, at = h_back_at
    starts = np.cumsum(ch.n) - ch.n
    context = words[np.concatenate([[0], ch.token[:-1]])]
    context[starts] = n_contexts
    both = np.zeros(len(ch.token), np.int64)
    both[at] = pairs[back]
    p2 = both / np.maximum(context, 1)
    p2[context < MIN_CONTEXT] = 0.0
    del both
    return bucket(context), p2, words[ch.token] / max(n, 1)


def learn_weights(histogram: list[tuple[int, int, int, int]], uniform: float, rounds: int = 200) -> np.ndarray:
    """EM for the weights (bigram, unigram, uniform) of each bucket.  The
    histogram counts development tokens by bucket and by the rounded logarithms
    of both frequencies over the uniform share (-1: the frequency is zero)."""
    weights = np.full((BUCKETS, 3), np.nan)
    rows = np.array(histogram, float).reshape(-1, 4)
    for b in np.unique(rows[:, 0]).astype(int):
        mine = rows[rows[:, 0] == b]
        ratio = np.stack([*[np.where(mine[:, k] < 0, 0.0, 10.0 ** (mine[:, k] / GRID - 20)) for k in (1, 2)], np.ones(len(mine))], 1)
        w = np.array([1.0, 1.0, 1.0]) / 3
        for _ in range(rounds):
            share = ratio * w
            share /= share.sum(1, keepdims=True)
            new = (share * mine[:, 3:]).sum(0) / mine[:, 3].sum()
            done = np.abs(new - w).max() < 1e-7
            w = new
            if done:
                break
        w = np.maximum(w, [0.0, 1e-6, 1e-6])
        weights[b] = w / w.sum()
    known = np.flatnonzero(~np.isnan(weights[:, 0]))
    for b in range(BUCKETS):                        # a bucket without development tokens takes the nearest one's
        if np.isnan(weights[b, 0]):
            near = known[known > 0]
            weights[b] = weights[near[np.argmin(np.abs(near - b))]] if b and len(near) else (weights[0] if len(known) and known[0] == 0 else [0.0, 0.9, 0.1])
    weights[0] = [0.0, *(weights[0, 1:] / weights[0, 1:].sum())]
    return weights


def score_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``
    for every row of ``docs`` (``doc_id``, ``text``).

    Tokens are the words (A-Z lower-cased) and one end token; null texts are
    empty and have the end token alone.  Documents whose fold is ``HELD`` teach
    nothing; a null id has fold 0.  ``base_score`` is the add-one unigram log10
    probability, ``score`` the interpolated model's.  Rows that repeat an id
    count each.  With no training document all words are unknown."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), fold().alias("fold"), F.col("text").cast("string").alias("text"))
    chunks = C.written(spark, chunks_of(rows), "chunks")
    size = chunks.agg(F.sum(F.octet_length("words") + F.octet_length("tokens"))).first()[0] or 0
    parts = max(C.partitions(spark), int(size) >> 24)

    def ask_words(batches):
        for row in rows_of(batches):
            ch = Chunk(row)
            yield requests(row["chunk"], ch.words, counts_in(ch.token, ch.fold, len(ch.words)), parts)

    words = C.written(spark, add_up(chunks.mapInArrow(ask_words, REQUEST), parts), "word-totals")

    def documents_in(batches):
        for batch in batches:
            for lengths, folds in zip(batch.column(0), batch.column(1), strict=True):
                f = unpack(folds.as_py(), np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array([int((f != HELD).sum())]), pa.array([int((f == DEV).sum())])], ["train", "dev"])

    counted = chunks.select("lengths", "folds").mapInArrow(documents_in, "train long, dev long").agg(F.sum("train"), F.sum("dev")).first()
    n_train, n_dev = int(counted[0] or 0), int(counted[1] or 0)
    stats = [unpack(bytes(r["counts"]), np.uint64).astype(np.int64) for r in words.where("chunk = -1").collect()]      # one row for each part
    v, n, dev_n = (int(sum(s[k] for s in stats)) for k in range(3))

    def ask_pairs(batches):
        for row in rows_of(batches):
            ch = Chunk(row)
            h, back, at = ch.pairs(totals_of(row["word_totals"]))
            yield requests(row["chunk"], h, counts_in(back, ch.fold[at], len(h)), parts)

    known = gathered(words, "word_totals")
    pairs = C.written(spark, add_up(chunks.drop("doc_ids").withColumn("doc_ids", F.array().cast("array<long>")).join(known, "chunk").mapInArrow(ask_pairs, REQUEST), parts), "pair-totals")
    ready = chunks.join(known, "chunk").join(gathered(pairs, "pair_totals"), "chunk", "left")
    uniform = 1 / (v + 1)

    def development(batches):
        for row in rows_of(batches):
            ch = Chunk(row)
            words, pairs = totals_of(row["word_totals"]), totals_of(row["pair_totals"])
            hba = ch.pairs(words)
            b, p2, p1 = parts_of(ch, words[0] - words[1], (pairs[0] - pairs[1]) if len(hba[0]) else pairs[0], hba, n - dev_n, n_train - n_dev)
            cell = np.stack([b, *[np.where(p > 0, np.rint((np.log10(np.maximum(p, 1e-300) / uniform) + 20) * GRID), -1) for p in (p2, p1)]], 1).astype(np.int64)
            cells, times = np.unique(cell, axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cells[:, 0]), pa.array(cells[:, 1]), pa.array(cells[:, 2]), pa.array(times)], ["b", "x", "y", "n"])

    cells = ready.where("dev").mapInArrow(development, "b long, x long, y long, n long").groupBy("b", "x", "y").agg(F.sum("n").alias("n"))
    weights = learn_weights([tuple(r) for r in cells.collect()], uniform)      # cells of a fixed grid
    if not n:
        weights[:] = [0.0, 0.0, 1.0]

    def score(batches):
        for row in rows_of(batches):
            ch = Chunk(row)
            words, pairs = totals_of(row["word_totals"]), totals_of(row["pair_totals"])
            b, p2, p1 = parts_of(ch, words[0], pairs[0], ch.pairs(words), n, n_train)
            p2 *= weights[b, 0]
            p2 += weights[b, 1] * p1
            p2 += weights[b, 2] * uniform
            model = np.log10(p2)
            c = words[0][ch.token]
            base = np.log10((c + 1) / (n + v + 1))
            at = np.cumsum(ch.n) - ch.n
            yield pa.RecordBatch.from_arrays(
                [pa.array(ch.doc_ids, pa.int64()), pa.array(ch.folds == HELD), pa.array(ch.n), pa.array(np.add.reduceat((c > 0).astype(np.int64), at)),
                 pa.array([n] * len(at), pa.int64()), pa.array(np.add.reduceat(base, at)), pa.array(np.add.reduceat(model, at))],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return ready.mapInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
