"""Benchmark decontamination: BM25 over an inverted index of test items, with
block-max WAND, queried by every passage of every document.

The test items are the indexed texts and the passages the queries.  A passage
that holds at least 0.8 of an item's five-word shingles holds all its words but
a fifth, so its score cannot fall below the item's own score less its heaviest
words; that bound is the item's threshold, and nothing above it is missed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from verbum.llm import common as C

K1, B = 1.2, 0.75
SHINGLE = 5           # words of a shingle
OVERLAP = 0.8         # share of an item's shingles, and of each half of them, that a leak holds
BLOCK = 8             # neighbouring postings that share one block maximum
ITEM_BYTES = 16 << 20  # items indexed at once; more items are taken in several passes


@dataclass
class Index:
    """Impact-ordered index of a block of items; items are numbered by length."""
    item_ids: np.ndarray
    terms: pa.Array
    start: np.ndarray            # postings of term t: start[t] to start[t + 1]
    items: np.ndarray
    weights: np.ndarray
    highest: np.ndarray          # largest weight of each term
    block_max: np.ndarray        # terms x item blocks
    threshold: np.ndarray
    essential: np.ndarray        # terms without any of which no item reaches its threshold; the last: no term
    shingles: list               # per item: distinct shingle hashes in order
    width: np.ndarray            # per item: words of a shingle
    window: int                  # words of half a passage


def lower_words(texts: pa.Array):
    texts = texts.cast(pa.large_string())
    return C.words_of(pc.utf8_lower(texts.take(pa.array(np.arange(len(texts))))), lower=False)


def build_index(items: list[tuple[int, str]], df: dict[str, int], n_items: int, avg_len: float, short_items: bool = False) -> Index:
    """Index of ``(item_id, text)``; document frequencies are those of all items.
    With ``short_items`` a passage is cut into shingles as short as the item."""
    codes, offsets, words = lower_words(pa.array([t for _, t in items], pa.large_string()))
    order = np.argsort(np.diff(offsets), kind="stable")
    hashes = C.hash_words(words)
    term, item, weight, threshold, shingles, longest = [], [], [], [], [], 1
    essential = np.zeros(len(words) + 1, bool)
    size = pc.utf8_length(words).to_numpy(zero_copy_only=False) if len(words) else np.zeros(0)
    dfs = np.array([df.get(w, 1) for w in words.to_pylist()], float)
    idf = np.log(1 + (n_items - dfs + 0.5) / (dfs + 0.5))
    for at, o in enumerate(order):
        own = codes[offsets[o]:offsets[o + 1]]
        longest = max(longest, len(own))
        t, tf = np.unique(own, return_counts=True)
        w = idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(own) / max(avg_len, 1)))
        sh = shingle_hashes(hashes[own])
        sh = sh[np.sort(np.unique(sh, return_index=True)[1])]
        lost = int(np.floor((1 - OVERLAP) * len(sh) + 1e-9))
        # the heaviest terms, one more than may be missing; of equal weights the longest words, which are rarer
        essential[t[np.lexsort((-size[t], -np.round(w, 9)))[:lost + 1]]] = True
        threshold.append(w.sum() - np.sort(w)[::-1][:lost].sum() if len(own) else np.inf)
        term.append(t), item.append(np.full(len(t), at)), weight.append(w), shingles.append(sh)
    term, item, weight = (np.concatenate(x) if x else np.zeros(0) for x in (term, item, weight))
    by = np.lexsort((item, term))
    term, item, weight = term[by].astype(np.int64), item[by].astype(np.int32), weight[by].astype(np.float32)
    start = np.searchsorted(term, np.arange(len(words) + 1))
    block_max = np.zeros((len(words) + 1, -(-max(len(items), 1) // BLOCK)), np.float32)   # the last row: no term
    np.maximum.at(block_max, (term, item // BLOCK), weight)
    return Index(np.array([items[o][0] for o in order], np.int64), words, start, item, weight, block_max.max(1),
                 block_max, np.array(threshold, np.float32) * np.float32(1 - 1e-5), essential, shingles,
                 np.clip(np.diff(offsets)[order], 1, SHINGLE) if short_items else np.full(len(order), SHINGLE), longest)


def shingle_hashes(h: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """Hashes of all shingles; a shorter text is one shingle, none without words."""
    if not len(h):
        return h[:0]
    n = min(width, len(h))
    out = h[:len(h) - n + 1]
    for k in range(1, n):
        out = C.join_hashes(out, h[k:len(h) - n + 1 + k])
    return out


def wand(index: Index, terms: np.ndarray):
    """Items whose score over the distinct query ``terms`` reaches their
    threshold, by block-max WAND: cursors ordered by item, the pivot where the
    sum of highest weights reaches the least threshold, block maxima before any
    scoring."""
    lists = [(index.items[index.start[t]:index.start[t + 1]], index.weights[index.start[t]:index.start[t + 1]], t) for t in terms]
    at = [0] * len(lists)
    least = float(index.threshold.min())
    while True:
        live = sorted((i for i in range(len(lists)) if at[i] < len(lists[i][0])), key=lambda i: lists[i][0][at[i]])
        total, pivot = 0.0, None
        for n, i in enumerate(live):
            total += index.highest[lists[i][2]]
            if total >= least:
                pivot = n
                break
        if pivot is None:
            return
        item = int(lists[live[pivot]][0][at[live[pivot]]])
        while pivot + 1 < len(live) and lists[live[pivot + 1]][0][at[live[pivot + 1]]] == item:
            pivot += 1
        block = item // BLOCK
        bound = sum(index.block_max[lists[i][2], block] for i in live[:pivot + 1])
        if bound < index.threshold[item]:
            if bound < index.threshold[block * BLOCK:(block + 1) * BLOCK].min():     # nothing before the next block or list
                ahead = lists[live[pivot + 1]][0][at[live[pivot + 1]]] if pivot + 1 < len(live) else np.iinfo(np.int32).max
                to = min((block + 1) * BLOCK, int(ahead))
            else:
                to = item + 1
            for i in live[:pivot + 1]:
                at[i] += int(np.searchsorted(lists[i][0][at[i]:], to))
            continue
        score = 0.0
        for i in live[:pivot + 1]:
            at[i] += int(np.searchsorted(lists[i][0][at[i]:], item))
            if at[i] < len(lists[i][0]) and lists[i][0][at[i]] == item:
                score += float(lists[i][1][at[i]])
                at[i] += 1
        if score >= index.threshold[item]:
            yield item, score


def leaks_of(index: Index, texts: pa.Array):
    """``(row, item, first word, score, question, answer, overlap)`` of leaks.

    Passages are two neighbouring windows, each as long as the longest item, so
    that any stretch of an item's length lies in one.  Only passages with an
    essential term of some item can reach a threshold; the block maxima of their
    terms, then WAND, decide on those, and what WAND finds is verified on the
    shingles: the first half of an item's shingles is its question, the second
    its answer."""
    codes, offsets, words = lower_words(texts)
    known = pc.fill_null(pc.index_in(words, value_set=index.terms), len(index.terms)).to_numpy(zero_copy_only=False).astype(np.int64)
    at = np.flatnonzero(index.essential[known][codes])
    if not len(at):
        return
    hashes = C.hash_words(words)
    size = index.window
    doc = np.searchsorted(offsets, at, "right") - 1
    half = (at - offsets[doc]) // size
    # the windows of essential terms, as the first and as the second half of a passage
    places = np.unique(np.concatenate([np.c_[doc, half], np.c_[doc, half - 1][half > 0]]), axis=0)
    least = np.array([index.threshold[b * BLOCK:(b + 1) * BLOCK].min() for b in range(index.block_max.shape[1])])
    for d, h in places:
        begin, stop = offsets[d] + h * size, min(offsets[d] + (h + 2) * size, offsets[d + 1])
        query = np.unique(known[codes[begin:stop]])
        query = query[query < len(index.terms)]
        if (index.block_max[query].sum(0) >= least).any():
            for item, score in wand(index, query):
                want = index.shingles[item]
                have = shingle_hashes(hashes[codes[begin:stop]], int(index.width[item]))
                hit = np.isin(want, have)
                half = (len(want) + 1) // 2
                question, answer = hit[:half].mean(), hit[half:].mean() if half < len(want) else hit.mean()
                if hit.mean() >= OVERLAP and question > 0 and answer > 0:
                    yield int(d), int(index.item_ids[item]), int(h * size), score, question, answer, hit.mean()


def find_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, item_bytes: int = ITEM_BYTES,
               short_items: bool = False) -> DataFrame:
    """One row for each document and test item that it leaks: ``doc_id``,
    ``item_id``, ``first_word`` of the passage, ``score``, ``question_overlap``,
    ``answer_overlap``, ``shingle_overlap`` (the best passage).

    Words are lower-cased.  A leak holds at least 0.8 of an item's
    distinct five-word shingles, some of its first half (the question) and some
    of its second (the answer), in one passage.  Items that are null or have no
    words are in no leak, nor are null and empty texts; items that repeat are
    each reported.  An item of fewer than five words is one shingle: with
    ``short_items`` any text that holds its words in a row leaks it, without
    only a text that is this item.  Rows that repeat a ``doc_id`` (or have none)
    give one row for that id; other columns are not read.

    Items beyond ``item_bytes`` are taken in blocks, each one pass over the
    documents; term statistics are those of all items."""
    items = (benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text"))
             .where("text IS NOT NULL AND item_id IS NOT NULL").distinct())
    lower = F.lower("text")
    words = items.select("item_id", F.explode(F.filter(F.split(lower, C.WORD_BREAK), lambda w: w != "")).alias("w"), F.xxhash64("text").alias("t"))
    stats = items.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    n_blocks = -(-int(stats["b"] or 0) // item_bytes)
    length = words.count()
    df = words.groupBy("w").agg(F.count_distinct("item_id", "t").alias("df"))
    found = None
    for block in range(n_blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block)
        rows = [(r["item_id"], r["text"]) for r in mine.orderBy("item_id", "text").collect()]    # about item_bytes
        own = words.join(mine.select("item_id").distinct(), "item_id").select("w").distinct()
        index = spark.sparkContext.broadcast(build_index(
            rows, {r["w"]: r["df"] for r in df.join(own, "w").collect()}, int(stats["n"]), length / max(int(stats["n"]), 1), short_items))

        def search(batches, index=index):
            C.give_back()
            for batch in batches:
                for part in C.text_batches(batch):
                    ids = part.column(0)
                    out = list(leaks_of(index.value, part.column(1)))
                    if out:
                        at, *rest = zip(*out, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [ids.take(pa.array(at)), *[pa.array(c, t) for c, t in zip(rest, (pa.int64(), pa.int64(), *[pa.float64()] * 4), strict=True)]],
                            ["doc_id", "item_id", "first_word", "score", "question_overlap", "answer_overlap", "shingle_overlap"])

        part = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
            search, "doc_id long, item_id long, first_word long, score double, question_overlap double, answer_overlap double, shingle_overlap double")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "doc_id long, item_id long, first_word long, score double, question_overlap double, answer_overlap double, shingle_overlap double")
    best = F.max_by(F.struct("first_word", "score", "question_overlap", "answer_overlap", "shingle_overlap"),
                    F.struct("shingle_overlap", "score", -F.col("first_word")))
    return found.groupBy("doc_id", "item_id").agg(best.alias("x")).select("doc_id", "item_id", "x.*")
