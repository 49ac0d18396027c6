"""Token files by static range asymmetric numeral systems (rANS).

All blocks share one table of id frequencies, counted over the whole corpus.  A
block holds up to ``LANES * STEPS`` ids, coded by interleaved lanes into one
stream of 32-bit words.  Every ``SEGMENT`` steps the lanes' states and the place
in the stream are kept as a checkpoint, so the segments of a block decode side
by side; blocks need nothing but the table.  Every block has a checksum.
"""

from __future__ import annotations

import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from verbum.llm import common as C, tokens as K

LANES, STEPS, SEGMENT = 32, 1024, 256
BITS = 20                        # the frequencies add up to 2 ** BITS
LOW = np.uint64(1 << 31)         # least state; a state has up to 63 bits
STRIPE = 1 << 20                 # ids of one record of the file, whole documents


def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies that add up to ``2 ** BITS``, at least one for each id that occurs."""
    total, goal = int(counts.sum()), 1 << BITS
    freq = np.where(counts > 0, np.maximum(1, counts.astype(np.float64) * goal // max(total, 1)), 0).astype(np.int64)
    while total and (off := goal - int(freq.sum())):
        if off > 0:
            freq[int(np.argmax(counts))] += off
        else:                                       # take from the most frequent
            top = np.argsort(freq)[::-1][:max(1, -off)]
            top = top[freq[top] > 1]
            freq[top[:-off]] -= 1
    return freq


class Table:
    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.base = (np.cumsum(freq) - freq).astype(np.uint64)
        self._slots = None

    @property
    def slots(self) -> np.ndarray:
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self.freq)), self.freq.astype(np.int64)).astype(np.uint16)
        return self._slots


def encode_blocks(ids: np.ndarray, table: Table) -> list[bytes]:
    """The blocks of an id sequence, coded all at once."""
    if not len(ids):
        return []
    per = LANES * STEPS
    n_blocks = -(-len(ids) // per)
    filled = np.full(n_blocks * per, int(np.argmax(table.freq)), np.int64)
    filled[:len(ids)] = ids
    rows = filled.reshape(n_blocks, STEPS, LANES)
    used = np.full(n_blocks, STEPS)
    used[-1] = -(-(len(ids) - (n_blocks - 1) * per) // LANES)        # steps of the last block
    state = np.full((n_blocks, LANES), LOW, np.uint64)
    words = np.zeros((STEPS, n_blocks, LANES), np.uint32)
    moved = np.zeros((STEPS, n_blocks, LANES), bool)
    marks = {}
    for t in range(STEPS - 1, -1, -1):
        live = n_blocks if t < used[-1] else n_blocks - 1            # only the last block is shorter
        if not live:
            continue
        s = rows[:live, t]
        f, x = table.freq[s], state[:live]
        out = x >= (f << np.uint64(63 - BITS))
        words[t, :live], moved[t, :live] = x.astype(np.uint32), out
        x = np.where(out, x >> np.uint64(32), x)
        q = x // f
        state[:live] = (q << np.uint64(BITS)) + (x - q * f) + table.base[s]
        if t % SEGMENT == 0:
            marks[t] = state.copy()
    blocks = []
    for b in range(n_blocks):
        sizes = moved[:, b].sum(1)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        stream = words[:, b][moved[:, b]].tobytes()
        at = range(0, int(used[b]), SEGMENT)
        heads = b"".join(struct.pack("<I", ends[t]) + marks[t][b].tobytes() for t in at)
        n = min(per, len(ids) - b * per)
        body = struct.pack("<II", n, len(at)) + heads + stream
        blocks.append(struct.pack("<II", len(body), zlib.crc32(body)) + body)
    return blocks


def decode_blocks(data: bytes, table: Table) -> np.ndarray:
    """The ids of blocks laid end to end; raises on a wrong checksum."""
    units, place = [], 0                            # (block, step, first word, state)
    streams, counts, words = [], [], 0
    while place < len(data):
        size, check = struct.unpack_from("<II", data, place)
        body = data[place + 8:place + 8 + size]
        if zlib.crc32(body) != check:
            raise ValueError("wrong checksum of a block")
        n, segments = struct.unpack_from("<II", body)
        at = 8
        for k in range(segments):
            first, = struct.unpack_from("<I", body, at)
            units.append((len(counts), k * SEGMENT, words + first, np.frombuffer(body, np.uint64, LANES, at + 4)))
            at += 4 + 8 * LANES
        stream = np.frombuffer(body, np.uint32, offset=at)
        streams.append(stream)
        counts.append(n)
        words += len(stream)
        place += 8 + size
    if not units:
        return np.zeros(0, np.int64)
    stream = np.concatenate([*streams, np.zeros(1, np.uint32)])
    state = np.array([u[3] for u in units], np.uint64)
    next_word = np.array([u[2] for u in units], np.int64)
    steps = np.array([min(SEGMENT, -(-counts[u[0]] // LANES) - u[1]) for u in units])
    out = np.zeros((len(units), SEGMENT, LANES), np.uint16)
    mask = np.uint64((1 << BITS) - 1)
    order = np.argsort(-steps, kind="stable")       # longer units first, so that live ones are a prefix
    state, next_word = state[order], next_word[order]
    for t in range(int(steps.max())):
        live = int((steps > t).sum())
        x = state[:live]
        slot = x & mask
        s = table.slots[slot.astype(np.int64)]
        out[:live, t] = s
        x = table.freq[s] * (x >> np.uint64(BITS)) + slot - table.base[s]
        need = x < LOW
        rank = np.cumsum(need, axis=1)
        word = stream[np.minimum(next_word[:live, None] + rank - 1, len(stream) - 1).clip(0)]
        state[:live] = np.where(need, (x << np.uint64(32)) | word, x)
        next_word[:live] += rank[:, -1]
    back = np.empty(len(units), np.int64)
    back[order] = np.arange(len(units))
    ids, per = [], LANES * STEPS
    out = out[back].reshape(len(units), SEGMENT * LANES)
    first = 0
    for b, n in enumerate(counts):
        mine = -(-n // (SEGMENT * LANES))
        ids.append(out[first:first + mine].reshape(-1)[:min(n, per)])
        first += mine
    return np.concatenate(ids).astype(np.int64)


@lru_cache(maxsize=2)
def worker_encoder(name: str, cached: int = K.CACHED) -> K.Encoder:
    C.give_back(caches=False)                       # what earlier tasks of this worker left
    return K.Encoder(name, cached, special_as_text=False)


C.WORKER_CACHES.append(worker_encoder.cache_clear)


def tokenised(docs: DataFrame, name: str, end: int) -> DataFrame:
    """``(_range, doc_id, n, ids)``: the ids of each whole text with the end id,
    as compressed 16-bit integers."""
    def work(batches):
        enc, pack = worker_encoder(name), zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for part in C.text_batches(batch, "text", 4 << 20):
                ids, offsets = K.with_end(*enc.encode(part.column(2)), end)
                blobs = [pack.compress(ids[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(np.diff(offsets)), pa.array(blobs, pa.binary())],
                                                 ["_range", "doc_id", "n", "ids"])

    return docs.select("_range", "doc_id", "text").mapInArrow(work, "_range int, doc_id long, n long, ids binary")


def count_ids(tokens: DataFrame, vocabulary: int) -> np.ndarray:
    """Occurrences of each id in the corpus; one number for each id of the vocabulary."""
    def work(batches):
        unpack, total = zstandard.ZstdDecompressor(), np.zeros(vocabulary, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                ids = b"".join(unpack.decompress(blob.as_buffer()) for blob in batch.column(0).slice(lo, 256))
                total += np.bincount(np.frombuffer(ids, np.uint16), minlength=vocabulary)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["id", "n"])

    out = np.zeros(vocabulary, np.int64)
    for row in tokens.select("ids").mapInArrow(work, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[row["id"]] = row["n"]
    return out


def write_token_file(spark: SparkSession, docs: DataFrame, path: str | None = None, name: str = K.WORDS, end: int = 1) -> str:
    """Encode ``docs`` (``doc_id``, ``text``) into a token file in ascending
    ``doc_id`` order (null ids first; rows that share an id by their ids) and
    return its path.

    The file is a folder: ``table`` (ids and frequencies), ``ranges`` (ids in
    each range of documents and before it) and ``stripes`` (records of whole
    documents with their lengths and blocks).  Null texts are empty; every
    document has at least the end id.  An empty corpus gives empty tables."""
    path = path or C.shared_path(spark, "token-file")
    ranged = C.with_range(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
                          "doc_id", 4 * C.partitions(spark))
    w = Window.partitionBy("_range").orderBy("doc_id", "ids")
    ordered = C.written(spark, tokenised(ranged, name, end)
                        .withColumn("row", F.row_number().over(w))
                        .withColumn("before", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")), "tokens")
    from tokenizers import Tokenizer
    vocabulary = max(Tokenizer.from_file(C.vocabulary_file(name)).get_vocab_size(), end + 1)
    freq = scaled(count_ids(ordered, vocabulary))
    spark.createDataFrame([(int(i), int(freq[i])) for i in np.flatnonzero(freq)], "id int, freq long").coalesce(1).write.parquet(f"{path}/table")
    sizes = ordered.groupBy("_range").agg(F.sum("n").alias("n"))
    C.prefix_offsets(sizes, "_range", "n").join(sizes, "_range").write.parquet(f"{path}/ranges")
    shipped = spark.sparkContext.broadcast(freq)

    def stripes(batches):
        table, unpack = Table(shipped.value), zstandard.ZstdDecompressor()
        held, ids, total, last = [], [], 0, None

        def record():
            blocks = encode_blocks(np.concatenate(ids), table)
            return pa.RecordBatch.from_arrays(
                [pa.array([held[0][0]], pa.int32()), pa.array([held[0][3]], pa.int32()), pa.array([held[0][4]], pa.int64()), pa.array([[h[1] for h in held]], pa.list_(pa.int64())),
                 pa.array([[h[2] for h in held]], pa.list_(pa.int64())), pa.array([b"".join(blocks)], pa.binary())],
                ["_range", "row", "before", "doc_ids", "lengths", "blocks"])

        for batch in batches:
            for r, d, n, row, before, blob in zip(*[batch.column(c).to_pylist() if c != "ids" else batch.column(c) for c in ("_range", "doc_id", "n", "row", "before", "ids")], strict=True):
                if held and (total >= STRIPE or last != (r, row - 1)):
                    yield record()
                    held, ids, total = [], [], 0
                held.append((r, d, n, row, before))
                ids.append(np.frombuffer(unpack.decompress(blob.as_buffer()), np.uint16))
                total, last = total + n, (r, row)
        if held:
            yield record()

    ordered.mapInArrow(stripes, "_range int, row int, before long, doc_ids array<long>, lengths array<long>, blocks binary").write.parquet(f"{path}/stripes")
    C.discard(spark, ordered)
    return path


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` from a token file: ``ids`` are
    little-endian unsigned 32-bit integers, ``start`` the ids of all documents
    before."""
    freq = {r["id"]: r["freq"] for r in spark.read.parquet(f"{path}/table").collect()}      # one row for each id
    table = np.zeros(max(freq, default=0) + 1, np.int64)
    table[list(freq)] = list(freq.values())
    shipped = spark.sparkContext.broadcast(table)

    def work(batches):
        worker_encoder.cache_clear()                # decoding needs no encoder that this worker may still hold
        decoder = Table(shipped.value)
        for batch in batches:
            for r, before, doc_ids, lengths, blocks in zip(*[batch.column(c) for c in ("_range", "before", "doc_ids", "lengths", "blocks")], strict=True):
                n = np.array(lengths.as_py(), np.int64)
                ids = decode_blocks(blocks.as_py(), decoder).astype("<u4")
                ends = np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r.as_py()] * len(n), pa.int32()), pa.array(doc_ids.as_py(), pa.int64()), pa.array(before.as_py() + ends - n), pa.array(n),
                     pa.array([ids[b - k:b].tobytes() for b, k in zip(ends, n, strict=True)], pa.binary())],
                    ["_range", "doc_id", "start", "n_tokens", "ids"])

    docs = spark.read.parquet(f"{path}/stripes").select("_range", "before", "doc_ids", "lengths", "blocks").mapInArrow(
        work, "_range int, doc_id long, start long, n_tokens long, ids binary")
    ranges = spark.read.parquet(f"{path}/ranges").select("_range", "offset")
    return (docs.join(F.broadcast(ranges), "_range")           # a few rows for each partition
            .select("doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids"))
