"""Contexts that were seen once, twice or three times carry bigrams."""

import zlib

import numpy as np

from verbum.llm import lm


def test_rare_counts_have_buckets_of_their_own():
    b = lm.bucket(np.array([0, 1, 2, 3, 4, 7, 8, 15, 16, 1 << 60]))
    assert b[0] == 0 and len(set(b[:5])) == 5 and (b < lm.BUCKETS).all()
    assert b[4] == b[5] and b[6] == b[7] and b[5] < b[6] < b[8] < b[9]


def test_pairs_behind_rare_words_count(spark):
    """Every word is seen at most three times; a held-out text in its order must
    score above one with the same words in another order."""
    fold = lambda d: zlib.crc32(str(d).encode()) % lm.FOLDS
    ids = {f: [d for d in range(2000) if fold(d) == f] for f in range(lm.FOLDS)}
    train, dev, held = ids[0] + ids[1] + ids[4], ids[lm.DEV], ids[lm.HELD]
    rows = []
    for i in range(60):                             # word pair i: i % 3 + 1 training texts in all
        rows += [(d, f"a{i} b{i}") for d in train[3 * i:3 * i + i % 3] + [dev[i]]]
    pairs = [i for i in range(60) if i % 3]
    rows.append((held[0], " ".join(f"a{i} b{i}" for i in pairs)))
    rows.append((held[1], " ".join(f"a{i} b{j}" for i, j in zip(pairs, pairs[1:] + pairs[:1]))))
    got = lm.score_documents(spark, spark.createDataFrame(rows, "doc_id long, text string")).toPandas().set_index("doc_id")
    assert got.held_out[held[0]] and abs(got.base_score[held[0]] - got.base_score[held[1]]) < 1e-9
    assert got.score[held[0]] > got.score[held[1]] + 0.1 * len(pairs)
