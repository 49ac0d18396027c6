"""Best-fit packing of documents into token sequences by linear grouping.

All decisions need only the number of pieces of each length (a table of at most
``size`` rows): large lengths are rounded up to the largest length of their
equal-cardinality group, configurations of the few rounded lengths are chosen,
the actual pieces take the places of the rounded ones, and what is left over and
the small pieces go best-fit.  The plan is kept as runs of equal bins, so that
its size doesn't follow the corpus; every piece finds its place by its rank
among the pieces of its length.
"""

from __future__ import annotations

import bisect
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from verbum.llm import common as C, rans as R, tokens as K

SIZE = 2048
GROUPS = (2048, 512, 128, 32)    # numbers of groups that are tried; the plan with the fewest sequences wins
SMALL = 64                       # pieces up to this length are left to best fit
CACHED = 200_000                 # pieces that a worker remembers
RANK_BUCKETS = 64                # a length's pieces are ranked in so many parts


@dataclass
class Run:
    """Equal placements: ``count`` pieces of one length, from rank ``rank`` on,
    at ``offset`` in the sequences from ``bin`` on."""
    length: int
    rank: int
    count: int
    bin: int
    offset: int


class Bins:
    """Open bins as runs ``(first bin, count)`` under their free room."""

    def __init__(self, size: int, taken: np.ndarray):
        self.size, self.runs, self.n = size, {}, 0
        self.free: list[int] = []                   # free rooms that have runs, sorted
        self.rank = taken                           # next rank of each length
        self.out: list[Run] = []

    def put(self, room: int, first: int, count: int):
        if room > 0:
            if room not in self.runs:
                self.runs[room] = []
                bisect.insort(self.free, room)
            self.runs[room].append((first, count))

    def place(self, length: int, first: int, count: int, room: int):
        self.out.append(Run(length, int(self.rank[length]), count, first, self.size - room))
        self.rank[length] += count

    def open(self, lengths: list[int], count: int):
        """``count`` new bins with these lengths each."""
        room = self.size
        for x in lengths:
            self.place(x, self.n, count, room)
            room -= x
        self.put(room, self.n, count)
        self.n += count

    def best_fit(self, length: int, count: int):
        """Put pieces where the least room is left, into new bins at last."""
        while count:
            at = bisect.bisect_left(self.free, length)
            if at == len(self.free):
                each = self.size // length
                if count >= each:
                    self.open([length] * each, count // each)
                    count %= each
                else:
                    self.open([length] * count, 1)
                    count = 0
                continue
            room = self.free[at]
            first, n = self.runs[room].pop()
            take = min(n, count)
            if n > take:
                self.runs[room].append((first + take, n - take))
            if not self.runs[room]:
                del self.runs[room]
                self.free.pop(at)
            self.place(length, first, take, room)
            self.put(room - length, first, take)
            count -= take


def configurations(counts: dict[int, int], size: int):
    """``(lengths, times)``: the largest length left, and with it the few
    lengths that fill its sequence best (a knapsack over the lengths left that
    prefers large ones), as often as all of them last."""
    left = {x: n for x, n in counts.items() if n}
    order = sorted(left, reverse=True)
    while left:
        top = next(x for x in order if x in left)
        order = order[order.index(top):]
        room, chosen = size - top, [top]
        left[top] -= 1
        while room:
            # the best filling by one or two more lengths decides the next
            have = [x for x in order if left.get(x, 0) > 0 and x <= room]
            if not have:
                break
            arr = np.array(have[::-1])
            best, pick = arr[-1], int(arr[-1])
            second = np.searchsorted(arr, room - arr, "right") - 1
            ok = second >= 0
            fill = np.where(ok, arr + arr[np.maximum(second, 0)], arr)
            k = int(np.argmax(fill + arr / (4.0 * size)))
            if fill[k] > best:
                pick = int(arr[k])
            chosen.append(pick)
            left[pick] -= 1
            room -= pick
        need = {x: chosen.count(x) for x in set(chosen)}
        times = 1 + min(left[x] // c for x, c in need.items())
        for x, c in need.items():
            left[x] -= c * (times - 1)
            if not left[x]:
                del left[x]
        yield chosen, times


def plan(histogram: np.ndarray, size: int = SIZE, groups=GROUPS, small: int = SMALL) -> list[Run]:
    """Placements of all pieces; ``histogram[x]`` pieces have length ``x``."""
    best = None
    for k in groups:
        bins = Bins(size, np.zeros(size + 1, np.int64))
        if histogram[size]:
            bins.open([size], int(histogram[size]))
        large = np.arange(small + 1, size)
        large = large[histogram[large] > 0]
        total = int(histogram[large].sum())
        # equal-cardinality groups of the large pieces; each is rounded up to its largest length
        ends = np.cumsum(histogram[large])
        group = np.minimum((ends - 1) * k // max(total, 1), k - 1)
        rounded = {int(large[group == g].max()): [(int(x), int(histogram[x])) for x in large[group == g]] for g in np.unique(group)}
        stock = {top: list(reversed(members)) for top, members in rounded.items()}     # actual pieces, longest first
        for chosen, times in configurations({top: sum(n for _, n in m) for top, m in rounded.items()}, size):
            while times:                            # substitute actual pieces, in runs that all places last for
                use, need = [], {}
                for top in sorted(chosen, reverse=True):
                    queue, skip = stock[top], need.get(top, 0)
                    for x, n in queue:
                        if skip < n:
                            use.append((top, x))
                            break
                        skip -= n
                    need[top] = need.get(top, 0) + 1
                counts = {}
                for top, x in use:
                    counts[top, x] = counts.get((top, x), 0) + 1
                times_here = min([times, *[max(1, next(n for y, n in stock[top] if y == x) // c) for (top, x), c in counts.items()]])
                bins.open(sorted((x for _, x in use), reverse=True), times_here)
                for (top, x), c in counts.items():
                    queue = stock[top]
                    at = next(i for i, (y, _) in enumerate(queue) if y == x)
                    queue[at] = (x, queue[at][1] - c * times_here)
                    if not queue[at][1]:
                        queue.pop(at)
                times -= times_here
        for x in range(min(small, size - 1), 0, -1):
            if histogram[x]:
                bins.best_fit(x, int(histogram[x]))
        if best is None or bins.n < best.n:
            best = bins
    return best.out


def pieces_of(docs: DataFrame, size: int = SIZE, name: str = K.BYTES, end: int = 0, with_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids])`` of every document:
    whole if it has up to ``size`` ids with the end id, else cut from its end so
    that only the first piece may be shorter."""
    def work(batches):
        enc = R.worker_encoder(name, CACHED)
        for batch in batches:
            for part in C.text_batches(batch, "text", 2 << 20):
                ids, offsets = K.with_end(*enc.encode(part.column(1)), end)
                ids = ids.astype("<u4")
                n = np.diff(offsets)
                many = -(-n // size)
                doc = np.repeat(np.arange(len(n)), many)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
                stop = n[doc] - (many[doc] - 1 - piece) * size
                start = np.maximum(stop - size, 0)
                raw = [ids[a:b].tobytes() for a, b in zip(offsets[doc] + start, offsets[doc] + stop, strict=True)]
                columns = [part.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(stop - start),
                           pa.array([zlib.crc32(r) for r in raw], pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns, names = [*columns, pa.array(raw, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)
        C.give_back(caches=False)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        work, "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else ""))


def pack(spark: SparkSession, docs: DataFrame, size: int = SIZE, name: str = K.BYTES, end: int = 0, with_ids: bool = False) -> DataFrame:
    """The pieces of ``docs`` (``doc_id``, ``text``) with ``sequence_id`` and
    ``offset`` (gapless from 0 in each sequence).

    Null texts are empty documents with the end id alone.  Rows that repeat an
    id, or have none, are packed each.  An empty table gives no rows.  The plan
    is made on the driver from one number for each length; its runs are sent to
    the tasks, which look up each piece by its rank among its length.  A length
    that very many pieces share is ranked in ``RANK_BUCKETS`` parts."""
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "start"), F.lit(RANK_BUCKETS)).cast("int")
    pieces = C.written(spark, pieces_of(docs, size, name, end, with_ids).withColumn("part", F.col("length").cast("int") * RANK_BUCKETS + bucket), "pieces")
    counts = pieces.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    numbers = {r["part"]: r["n"] for r in counts.collect()}          # at most size * RANK_BUCKETS rows
    histogram, before = np.zeros(size + 1, np.int64), {}
    for part in sorted(numbers):
        before[part] = int(histogram[part // RANK_BUCKETS])
        histogram[part // RANK_BUCKETS] += numbers[part]
    runs = plan(histogram, size)
    runs.sort(key=lambda r: (r.length, r.rank))
    table = np.array([(r.length, r.rank, r.count, r.bin, r.offset) for r in runs], np.int64).reshape(-1, 5)
    shipped = spark.sparkContext.broadcast((table, before))
    ranked = pieces.withColumn("rank", F.row_number().over(Window.partitionBy("part").orderBy("doc_id", "piece", "ids_crc32")) - 1)
    keep = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def work(batches):
        C.give_back()                               # the encoder's work is done
        table, before = shipped.value
        keys = table[:, 0] * (1 << 44) + table[:, 1]
        for batch in batches:
            part = batch.column("part").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("rank").to_numpy(zero_copy_only=False).astype(np.int64)
            rank += np.fromiter((before[p] for p in part.tolist()), np.int64, len(part))
            at = np.searchsorted(keys, part // RANK_BUCKETS * (1 << 44) + rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(table[at, 3] + rank - table[at, 1]), pa.array(table[at, 4])],
                [*keep, "sequence_id", "offset"])

    return ranked.select(*keep, "part", "rank").mapInArrow(
        work, "doc_id long, piece int, start long, length long, ids_crc32 long, " + ("ids binary, " if with_ids else "") + "sequence_id long, offset long")
