"""MinHash near-duplicates with tensored banding and exact verification.

A document draws ``COLLECTIONS`` small collections of minhashes; every pair of
collections is one banding table, so 14 collections of two minhashes give 91
tables of four: 28 minhashes where plain banding computes 364.  Documents with
the same key in a table are candidates; candidates are confirmed on their full
shingle sets, and the links are merged into components.

At a similarity of 0.8 a collection agrees with probability 0.64, and a pair is
found when two of the 14 agree: it is missed with probability 1.6e-5.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from verbum.llm import common as C

COLLECTIONS = 14
ROWS = 2                       # minhashes of a collection
AGREE = 11                     # of the 28 minhashes; at 0.8 fewer agree with probability 1e-6
TEXT_BYTES = 2 << 20           # texts that a task shingles at once
SHINGLE = 5                    # words
SIMILARITY = 80                # per cent


def shingle_sets(codes: np.ndarray, offsets: np.ndarray, hashes: np.ndarray, width: int):
    """Distinct shingle hashes of each row: ``(values, offsets)``, sorted in a
    row.  Fewer words than ``width`` are one shingle; no words, none."""
    h = hashes[codes] if len(codes) else np.zeros(0, np.uint64)
    n = np.diff(offsets)
    doc = np.repeat(np.arange(len(n)), n)
    sh = h.copy()
    for k in range(1, width):
        step = np.zeros_like(sh)
        inside = np.arange(len(h)) + k < np.repeat(offsets[1:], n)
        at = np.flatnonzero(inside)
        step[at] = h[at + k]
        sh = C.join_hashes(sh, step)
    left = np.repeat(offsets[1:], n) - np.arange(len(h))         # words from here on
    keep = (left >= width) | ((left == np.repeat(n, n)) & (np.repeat(n, n) < width))
    sh, doc = sh[keep], doc[keep]
    order = np.lexsort((sh, doc))
    sh, doc = sh[order], doc[order]
    new = np.r_[True, (sh[1:] != sh[:-1]) | (doc[1:] != doc[:-1])] if len(sh) else np.zeros(0, bool)
    sh, doc = sh[new], doc[new]
    return sh, np.searchsorted(doc, np.arange(len(n) + 1))


def minhashes(sets: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """``n`` minhashes of 32 bits for each row; rows without shingles have zeros."""
    rows = len(offsets) - 1
    out = np.zeros((rows, n), np.uint32)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        for k in range(n):
            with np.errstate(over="ignore"):
                h = (sets ^ C.mix(np.uint64([k + 1]))[0]) * np.uint64(0x9E3779B97F4A7C15)
                h = ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)
            out[full, k] = np.minimum.reduceat(h.astype(np.uint32), offsets[:-1][full])
    return out


def sequence_hashes(codes, offsets, hashes) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each row's whole word sequence."""
    h = hashes[codes] if len(codes) else np.zeros(0, np.uint64)
    n = np.diff(offsets)
    place = (np.arange(len(h)) - np.repeat(offsets[:-1], n)).astype(np.uint64)
    out = []
    for salt in (1, 2):
        term = C.join_hashes(h + np.uint64(salt), place)
        sums = np.zeros(len(n), np.uint64)
        full = np.flatnonzero(n)
        if len(full):
            with np.errstate(over="ignore"):
                sums[full] = np.add.reduceat(term, offsets[:-1][full])
        out.append(C.join_hashes(sums, n.astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def sketches(docs: DataFrame, width: int) -> DataFrame:
    def work(batches):
        C.give_back()
        for batch in batches:
            for part in C.text_batches(batch, limit=TEXT_BYTES):
                codes, offsets, words = C.words_of(part.column(1))
                hashes = C.hash_words(words)
                sets, ends = shingle_sets(codes, offsets, hashes, width)
                mins = minhashes(sets, ends, COLLECTIONS * ROWS)
                h1, h2 = sequence_hashes(codes, offsets, hashes)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(h1), pa.array(h2), pa.array(np.diff(ends)), pa.array([m.tobytes() for m in mins], pa.binary())],
                    ["doc_id", "h1", "h2", "n_shingles", "mins"])
        C.give_back()

    return docs.mapInArrow(work, "doc_id long, h1 long, h2 long, n_shingles long, mins binary")


def table_keys(nodes: DataFrame) -> DataFrame:
    """``(key, node, n)``: the 91 banding keys of every node."""
    pairs = list(combinations(range(COLLECTIONS), 2))

    def work(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                m = np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint32).reshape(part.num_rows, COLLECTIONS, ROWS).astype(np.uint64)
                c = C.mix(m[:, :, 0] << np.uint64(32) | m[:, :, 1])
                keys = np.stack([C.join_hashes(c[:, a] + np.uint64(a * COLLECTIONS + b), c[:, b]) for a, b in pairs], 1)
                again = np.repeat(np.arange(part.num_rows), len(pairs))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.reshape(-1).view(np.int64)), part.column(0).take(pa.array(again)), part.column(1).take(pa.array(again))],
                    ["key", "node", "n"])

    return nodes.select("node", "n", "mins").mapInArrow(work, "key long, node long, n long")


def alike(pairs: DataFrame) -> DataFrame:
    """Pairs whose sketches agree often enough, with the count."""
    def work(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(batch.num_rows, COLLECTIONS * ROWS) for c in ("ma", "mb"))
            same = (a == b).sum(1)
            keep = pa.array(same >= AGREE)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep), pa.array(same[same >= AGREE])], ["a", "b", "same"])

    return pairs.mapInArrow(work, "a long, b long, same long")


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    """``(node, h1, set)``: the sorted shingle hashes of whole texts."""
    def work(batches):
        C.give_back()
        for batch in batches:
            for part in C.text_batches(batch, limit=TEXT_BYTES):
                codes, offsets, words = C.words_of(part.column(1))
                hashes = C.hash_words(words)
                sets, ends = shingle_sets(codes, offsets, hashes, width)
                h1, _ = sequence_hashes(codes, offsets, hashes)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(h1), pa.array([sets[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())],
                    ["node", "h1", "set"])
        C.give_back()

    return docs.mapInArrow(work, "node long, h1 long, set binary")


def confirmed(pairs: DataFrame, similarity: int) -> DataFrame:
    """``(a, b, linked)`` by the exact sets ``sa`` and ``sb``."""
    def work(batches):
        for batch in batches:
            out = []
            for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                out.append(100 * shared >= similarity * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(out, pa.bool_())], ["a", "b", "linked"])

    return pairs.select("a", "b", "sa", "sb").mapInArrow(work, "a long, b long, linked boolean")


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``(node, comp)`` with the smallest node of each component of ``edges``
    (``u``, ``v``), for nodes that aren't the smallest themselves: alternating
    large-star and small-star steps, which end in logarithmically many rounds."""
    order = lambda df: df.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, mark = C.written(spark, order(edges), "edges"), None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = order(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = order(joined.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*"))
        after = C.written(spark, small, "edges")
        C.discard(spark, now)
        state = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        now = after
        if state == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("comp"))
        mark = state


def near_duplicates(spark: SparkSession, docs: DataFrame, width: int = SHINGLE, similarity: int = SIMILARITY) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for each row of ``docs``
    (``doc_id``, ``text``).

    Words are lower-cased (A-Z) and split at white space; a document's set is
    its distinct ``width``-word shingles (a shorter text is one shingle).  Two
    documents are linked when their similarity is at least ``similarity`` per
    cent; ``component_id`` is the smallest id that links reach, and the
    document with that id is kept.  Empty and null texts have no shingles and
    link with nothing.  A row without id is linked with nothing and kept, with
    a null component.  Rows that repeat an id and text are alike; of rows with
    one id and several texts each is a text of its own under that id.

    Equal word sequences are one node from the start, so a large group of
    copies costs one row for each copy.  In a bucket every member is first
    compared with the bucket's smallest node; where members are then still in
    different components, ``group_links`` decides between them, so the work
    doesn't follow the square of a group."""
    rows = C.written(spark, sketches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), width), "sketches")
    nodes = C.written(spark, rows.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("h1", "h2")
                      .agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("mins").alias("mins")), "nodes")
    keys = table_keys(nodes)
    same = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("head"), F.sum(F.xxhash64("node").bitwiseAND(F.lit((1 << 40) - 1))).alias("sig"))
    # buckets with the same members stand for each other
    buckets = C.written(spark, same.where("size > 1").groupBy("size", "head", "sig").agg(F.min("key").alias("key")), "buckets")
    member = C.written(spark, keys.join(C.maybe_broadcast(buckets.select("key", "head"), buckets.count()), "key"), "members")
    # each member with the head of its bucket
    heads = nodes.select(F.col("node").alias("head"), F.col("n").alias("nh"))
    fits = F.least("n", "nh") * 100 >= F.greatest("n", "nh") * similarity
    found = (member.where("node != head").groupBy("head", "node", "n").agg(F.count(F.lit(1)).alias("t")).join(heads, "head")
             .where(fits).select(F.col("head").alias("a"), F.col("node").alias("b")))
    ends = nodes.select("node", "mins")
    found = C.written(spark, alike(
        found.join(ends.select(F.col("node").alias("a"), F.col("mins").alias("ma")), "a")
        .join(ends.select(F.col("node").alias("b"), F.col("mins").alias("mb")), "b")), "pairs")
    links = C.written(spark, verify(spark, docs, nodes, found, width, similarity).where("linked")
                      .select(F.col("a").alias("u"), F.col("b").alias("v")), "links")
    comp = None if links.isEmpty() else components(spark, links)     # (node, comp) where they differ
    # buckets whose members are in several components
    here = with_comp(member, comp)
    mixed = here.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x != y").select("key")
    mixed = C.written(spark, member.join(mixed, "key"), "mixed")
    if not mixed.isEmpty():
        links = group_links(spark, docs, nodes, mixed, links, width, similarity)
        comp = None if links.isEmpty() else components(spark, links)
    out = rows.join(nodes.select("h1", "h2", "node"), ["h1", "h2"], "left")
    if comp is not None:
        out = out.join(comp, "node", "left")
        out = out.withColumn("c", F.coalesce("comp", "node"))
    else:
        out = out.withColumn("c", F.col("node"))
    component = F.when(F.col("doc_id").isNull(), None).when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("c"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def with_comp(member: DataFrame, comp: DataFrame | None) -> DataFrame:
    if comp is None:
        return member.withColumn("comp", F.col("node"))
    return member.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def verify(spark: SparkSession, docs: DataFrame, nodes: DataFrame, pairs: DataFrame, width: int, similarity: int) -> DataFrame:
    """``pairs`` with ``linked``, by the full sets of both texts."""
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    return by_sets(pairs, sets_of(spark, docs, nodes, wanted, width), similarity)


def by_sets(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    return confirmed(pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a")
                     .join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b"), similarity)


def sets_of(spark: SparkSession, docs: DataFrame, nodes: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``(node, set)`` of the wanted nodes, written."""
    wanted = C.written(spark, wanted.join(nodes.select("node", "h1"), "node"), "wanted")
    text = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .join(C.maybe_broadcast(wanted.select(F.col("node").alias("doc_id")).distinct(), wanted.count()), "doc_id"))
    sets = full_sets(text.select("doc_id", "text"), width).join(wanted.select("node", "h1"), ["node", "h1"], "left_semi").dropDuplicates(["node", "h1"])
    return C.written(spark, sets.select("node", "set"), "sets")


def deltas(rows: DataFrame, similarity: int) -> DataFrame:
    """Each set as its symmetric difference from the set of its pivot, with the
    slack ``(100 + s) * |difference| - (100 - s) * |set|``."""
    def work(batches):
        for batch in batches:
            lists, slack, start = [], [], 0
            for i, (x, p) in enumerate(zip(batch.column("set"), batch.column("pivot_set"), strict=True)):
                x = np.frombuffer(x.as_buffer(), np.int64)
                y = np.setxor1d(x, np.frombuffer(p.as_buffer(), np.int64), assume_unique=True)
                lists.append(y)
                slack.append((100 + similarity) * len(y) - (100 - similarity) * len(x))
                if i + 1 == batch.num_rows or sum(map(len, lists)) > 1 << 18:
                    part = batch.slice(start, len(lists))
                    ends = np.concatenate([[0], np.cumsum([len(y) for y in lists])]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("pivot"), part.column("by_pivot"), part.column("node"), pa.array(slack, pa.int64()),
                         pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists)))],
                        ["pivot", "by_pivot", "node", "slack", "delta"])
                    lists, slack, start = [], [], i + 1

    return (rows.select("pivot", "by_pivot", "node", "set", "pivot_set")
            .mapInArrow(work, "pivot long, by_pivot boolean, node long, slack long, delta array<long>"))


def group_links(spark: SparkSession, docs: DataFrame, nodes: DataFrame, mixed: DataFrame, links: DataFrame, width: int, similarity: int) -> DataFrame:
    """``links`` and those that join the components of the ``mixed`` buckets'
    members: one link or more between any two components that have some.

    Buckets that share members form a group, and the head of most members is
    its pivot P.  A text X is held as its difference from the pivot, D = X xor P:
    copies of one text have short ones, made of their own edits.  Two of them
    differ by D1 xor D2, so with ``s`` per cent they are linked exactly when

        2 * (100 + s) * |D1 and D2| >= slack1 + slack2.

    Where the right side isn't positive no shingle need be shared, and both are
    linked with the member of least slack: this makes the bulk of a group one
    component without a comparison.  Other pairs must share elements.  These
    are ordered from the rarest on, and two texts meet at an element only if
    what both have left from there on is enough; an element that one component
    alone holds can't join two and counts as unshared.  No link is lost.

    Texts of less than half the pivot's size would carry its shingles: they are
    held as they are (``by_pivot`` false), and those that may be linked with one
    on the other side are held both ways."""
    group = components(spark, mixed.where("node != head").select(F.col("head").alias("u"), F.col("node").alias("v")))
    at = C.written(spark, mixed.select("node", "n").distinct()
                   .join(group, "node", "left").select("node", "n", F.coalesce("comp", "node").alias("group")), "groups")
    most = mixed.groupBy(F.col("head").alias("node")).agg(F.count(F.lit(1)).alias("m")).join(at, "node")
    pivot = (most.groupBy("group").agg(F.max(F.struct("m", (-F.col("node")).alias("k"), F.col("n").alias("np"))).alias("p"))
             .select("group", (-F.col("p.k")).alias("pivot"), F.col("p.np").alias("np")))
    at = C.written(spark, at.join(pivot, "group").select("node", "n", "pivot", "np"), "pivots")
    sets = sets_of(spark, docs, nodes, at.select("node").distinct(), width)
    large = (at.where("2 * n >= np").join(sets, "node").withColumn("by_pivot", F.lit(True))
             .join(sets.select(F.col("node").alias("pivot"), F.col("set").alias("pivot_set")), "pivot"))
    small = (at.where(F.col("n") * similarity < F.col("np") * 50).join(sets, "node").withColumn("by_pivot", F.lit(False))
             .withColumn("pivot_set", F.lit(b"")))
    held = C.written(spark, deltas(large.unionByName(small, allowMissingColumns=True), similarity), "deltas")
    least = held.groupBy("pivot", "by_pivot").agg(F.min(F.struct("slack", "node")).alias("least"))
    held = held.join(C.maybe_broadcast(least, at.select("pivot").distinct().count() * 2), ["pivot", "by_pivot"])
    sure = held.where((F.col("slack") + F.col("least.slack") <= 0) & (F.col("node") != F.col("least.node")))
    links = C.written(spark, links.unionByName(sure.select(F.col("node").alias("u"), F.col("least.node").alias("v"))), "links")
    held = with_comp(held, None if links.isEmpty() else components(spark, links))
    element = ["pivot", "by_pivot", "e"]
    posts = held.select("pivot", "by_pivot", "node", "comp", "slack", F.col("least.slack").alias("least"), F.explode("delta").alias("e"))
    common = (posts.groupBy(*element).agg(F.count(F.lit(1)).alias("holders"), F.min("comp").alias("x"), F.max("comp").alias("y"))
              .where("x != y").drop("x", "y"))
    rest = Window.partitionBy("pivot", "by_pivot", "node").orderBy(F.desc("holders"), "e")
    posts = posts.join(common, element).withColumn("left", F.row_number().over(rest))
    twice = 2 * (100 + similarity)
    posts = C.written(spark, posts.where(F.col("left") * twice >= F.col("slack") + F.col("least"))
                      .select(*element, "node", "comp", "slack", "left"), "posts")
    other = posts.select(*element, *[F.col(c).alias(c + "2") for c in ("node", "comp", "slack", "left")])
    enough = F.least("left", "left2") * twice >= F.col("slack") + F.col("slack2")
    pairs = (posts.join(other, element).where((F.col("node") < F.col("node2")) & (F.col("comp") != F.col("comp2")) & enough)
             .select(F.col("node").alias("a"), F.col("node2").alias("b")).distinct())
    pairs = C.written(spark, pairs, "pairs")
    new = by_sets(pairs, sets, similarity).where("linked").select(F.col("a").alias("u"), F.col("b").alias("v"))
    return links.unionByName(C.written(spark, new, "links"))
