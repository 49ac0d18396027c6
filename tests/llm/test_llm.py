"""Training-data operators: defined results on small awkward tables, and
brute-force twins over the driver's smallest tables."""

import bisect
import collections
import math
import re
import zlib

import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from verbum.llm import common as C, decontaminate, linededup, lm, neardup, packing, quality, rans, shards, spotsigs, tokens, urlfilter

FOLD = str.maketrans(C.UPPER, C.LOWER)
LONG = "\n".join(f"line {i} has quite a few words of its own number {i * 7} to be told apart from others" for i in range(400))
ROWS = [(1, "One two three four five six seven eight nine ten eleven twelve.\nshort", "en"),
        (2, "One two three four five six seven eight nine ten eleven twelve.\nother line", None),
        (3, "", "en"), (4, None, "en"), (5, "   \n\t ", "de"), (6, LONG, "en"), (7, LONG, "en"), (8, "ünïcode  wörds here", None),
        (None, "no id here but words", "en"), (None, None, None), (9, "same row", "x"), (9, "same row", "x"), (10, "same row", "y")]
SCHEMA = "doc_id long, text string, lang string, score double, node long, n long, slot int, key string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, clashing column names."""
    return spark.createDataFrame([(*r, 0.5, 1, 2, 3, "k") for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs():
    return pd.read_parquet(f"{SF_SMALL}/documents.parquet").sort_values("doc_id").reset_index(drop=True)


def words(text):
    return [w for w in re.split(C.WORD_BREAK, (text or "").translate(FOLD)) if w]


def run(spark, name):
    return E.queries()[name](spark, SF_SMALL).toPandas()


# --- words -------------------------------------------------------------------

def test_words_of_slices():
    import pyarrow as pa
    texts = pa.array(["x" * 5, "Àb Cd", None, " a\x0bb  c ", ""])
    codes, offsets, found = C.words_of(texts.slice(1))
    got = [[found[int(c)].as_py() for c in codes[a:b]] for a, b in zip(offsets[:-1], offsets[1:])]
    assert got == [["Àb", "cd"], [], ["a", "b", "c"], []]


# --- 1 URL filters -----------------------------------------------------------

URLS = [(1, "https://A.Example.org/es/x", "block", "example.org/es/"), (2, "http://example.org/en/12?q=1", "block", "example.org/en/1"),
        (3, "http://example.org/fr/1", "allow", "org/"), (4, "http://notexample.org", None, None), (5, "ftp://x.com/de/1#f", "block", "com/de/"),
        (6, "http://x.com/fr/", "allow", "com/fr/"), (7, None, None, None), (8, "no scheme.org/", None, None), (9, "http://myorg/", None, None),
        (9, "http://x.org/", "allow", "org/"), (None, "http://x.org/#a?b", "allow", "org/")]


def test_url_rules(spark):
    pages = spark.createDataFrame([(k, u, "t") for k, u, _, _ in URLS], "page_id long, url string, verdict string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = urlfilter.judge_urls(spark, pages, labels).toPandas()
    want = collections.Counter((k, r, v or "allow") for k, u, v, r in URLS)
    key = lambda x: None if pd.isna(x) else x
    assert collections.Counter((key(r.page_id) if r.page_id == r.page_id else None, key(r.rule), r.verdict) for r in got.itertuples()) == want
    assert set(got[got.page_id.isin([7, 8])].host) == {""}


def test_url_rules_are_mined(spark):
    pages = spark.createDataFrame([(i, f"http://{'bad' if i % 4 == 0 else 'good'}.example.net/en/{i}") for i in range(400)], "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(200)] + [(None, 0, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    got = urlfilter.judge_urls(spark, pages, labels).toPandas()
    assert (got.verdict == np.where(got.page_id % 4 == 0, "block", "allow")).all()
    assert urlfilter.judge_urls(spark, pages.limit(0), labels).count() == 0


# --- 2 decontamination -------------------------------------------------------

def leaks_by_force(texts, items):
    out = {}
    sets = {i: {tuple(w[k:k + 5]) for k in range(len(w) - 4)} for i, w in ((i, words((t or "").lower())) for i, t in items)}
    for d, t in texts:
        w = words((t or "").lower())
        have = {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
        for i, s in sets.items():
            if s and len(have & s) >= 0.8 * len(s):
                out[d, i] = len(have & s) / len(s)
    return out


def test_leaks(spark, docs):
    items = pd.read_parquet(f"{SF_SMALL}/benchmark.parquet")
    got = run(spark, "op2_decontaminate")
    want = leaks_by_force(zip(docs.doc_id, docs.text), zip(items.item_id, items.text))
    assert {(r.doc_id, r.item_id): round(r.shingle_overlap, 9) for r in got.itertuples()} == {k: round(v, 9) for k, v in want.items()}
    assert want


def test_leaks_in_blocks_and_odd_tables(spark, odd, none):
    rng = np.random.default_rng(3)
    item = lambda: " ".join(rng.choice(["alpha", "beta", "of", "the", "gamma", "delta", "rho", "sigma", "tau", "omega", "kappa"], 25))
    texts = [item() for _ in range(40)]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(90, None), (None, "x"), (91, ""), (92, "few words")], "item_id long, text string")
    corpus = [(i, " ".join([item(), texts[i % 40] if i % 3 else "", item(), " ".join(words(texts[i % 40])[:-3]) if i % 5 == 0 else ""])) for i in range(80)]
    want = leaks_by_force(corpus, enumerate(texts))
    df = spark.createDataFrame(corpus, "doc_id long, text string")
    for size in (1 << 20, 500):
        got = decontaminate.find_leaks(spark, df, bench, item_bytes=size).toPandas()
        assert set(zip(got.doc_id, got.item_id)) == set(want)
    assert decontaminate.find_leaks(spark, odd, bench).count() == 0
    assert decontaminate.find_leaks(spark, none, bench).count() == 0
    assert decontaminate.find_leaks(spark, odd, bench.limit(0)).count() == 0


# --- 3 shards ----------------------------------------------------------------

def check_shards(got, n_shards):
    counts = got.groupby("shard").size()
    assert counts.max() - (counts.min() if len(counts) == n_shards else 0) <= 1
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))


def test_shards(spark, odd, none, docs):
    got = run(spark, "op3_shards")
    check_shards(got, 24)
    got = got.sort_values("doc_id")
    assert list(got.doc_id) == list(docs.doc_id)
    assert list(got["size"]) == [len(t.encode()) + 8 for t in docs.text]
    assert list(got.text_crc32) == [zlib.crc32(t.encode()) for t in docs.text]
    small = shards.shuffle_into_shards(spark, odd, 3).toPandas()
    check_shards(small, 3)
    assert len(small) == len(ROWS) and small.doc_id.isna().sum() == 2
    assert shards.shuffle_into_shards(spark, none, 3).count() == 0
    again = shards.shuffle_into_shards(spark, odd.where("doc_id IS NOT NULL").repartition(5), 3).toPandas()
    first = shards.shuffle_into_shards(spark, odd.where("doc_id IS NOT NULL"), 3).toPandas()
    order = ["shard", "slot", "doc_id"]
    assert again.sort_values(order)[order].values.tolist() == first.sort_values(order)[order].values.tolist()


# --- 4 token file and 7 packing ----------------------------------------------

def library(name, texts, end):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(C.vocabulary_file(name))
    t.encode_special_tokens = True
    return [np.array([*e.ids, end], "<u4") for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


AWKWARD = ["", " ", "  a", "a  b", "a \n b", "x\n\ny\n", "don't  stop 123 ##", "É́ é", "中文 字", "a\x1c b", "a  b", None, "<|endoftext|> Hi", "ΣΑΣ İ", "ﬁ ½ ²3 ab12cd"]


@pytest.mark.parametrize("name", [tokens.WORDS, tokens.BYTES])
def test_pieces_give_the_library_ids(name):
    import pyarrow as pa
    rng = np.random.default_rng(5)
    letters = [" ", " ", "\n", "a", "B", "'s", "1", ".", "é", "́", "\t", "ß", "½", "​", "|"]
    texts = AWKWARD + ["".join(rng.choice(letters, rng.integers(0, 14))) for _ in range(1500)]
    enc = tokens.Encoder(name)
    for _ in range(2):                               # fresh and from the cache
        ids, offsets = enc.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == [x[:-1].tolist() for x in library(name, texts, 0)]


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 8192, 8193, 32768, 32769, 70001])
def test_rans_round_trip(n):
    ids = np.minimum(np.random.default_rng(n).geometric(0.01, n), 49000)
    freq = rans.scaled(np.bincount(ids, minlength=49408))
    assert freq.sum() in (0, 1 << rans.BITS) and (freq[ids] > 0).all()
    data = b"".join(rans.encode_blocks(ids, rans.Table(freq)))
    assert (rans.decode_blocks(data, rans.Table(freq)) == ids).all()
    if n > 100:
        with pytest.raises(ValueError):
            rans.decode_blocks(data[:-1] + bytes([data[-1] ^ 1]), rans.Table(freq))


def test_token_file(spark, odd, none, docs):
    got = run(spark, "op4_token_file").sort_values("doc_id")
    ids = library(tokens.WORDS, docs.text, 1)
    n = np.array([len(x) for x in ids])
    assert list(got.doc_id) == list(docs.doc_id) and list(got.n_tokens) == list(n) and list(got.start) == list(np.cumsum(n) - n)
    assert list(got.ids_crc32) == [zlib.crc32(x.tobytes()) for x in ids]
    small = rans.read_token_file(spark, rans.write_token_file(spark, odd)).toPandas().sort_values("start")
    assert len(small) == len(ROWS) and list(small.start) == list(np.cumsum(small.n_tokens) - small.n_tokens)
    assert small.doc_id.isna().tolist() == [True, True] + [False] * 11 and small.doc_id[2:].is_monotonic_increasing
    assert rans.read_token_file(spark, rans.write_token_file(spark, none)).count() == 0


def best_fit_decreasing(lengths, size):
    free, bins = [], 0
    for x in sorted(lengths, reverse=True):
        i = bisect.bisect_left(free, x)
        bins, room = (bins + 1, size) if i == len(free) else (bins, free.pop(i))
        if room > x:
            bisect.insort(free, room - x)
    return bins


def check_packing(got, size):
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g.length.sum() <= size and list(g.offset) == list(np.cumsum(g.length) - g.length)


def test_packing(spark, odd, none, docs):
    got = run(spark, "op7_packing")
    check_packing(got, 2048)
    assert got.sequence_id.nunique() <= best_fit_decreasing(got.length, 2048)
    by = {d: x for d, x in zip(docs.doc_id, library(tokens.BYTES, docs.text, 0))}
    assert got.groupby("doc_id").length.sum().to_dict() == {d: len(x) for d, x in by.items()}
    for r in got.itertuples():
        assert zlib.crc32(by[r.doc_id][r.start:r.start + r.length].tobytes()) == r.ids_crc32
        assert r.length == 2048 or r.piece == 0
    small = packing.pack(spark, odd, size=64, with_ids=True).toPandas()
    check_packing(small, 64)
    assert small.doc_id.isna().sum() == 2 and (small.ids.map(len) == 4 * small.length).all()
    assert packing.pack(spark, none).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_every_piece(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 101, 3000) if seed % 2 else np.clip(rng.normal(40, 15, 3000).astype(int), 1, 100)
    runs = packing.plan(np.bincount(lengths, minlength=101), size=100, small=5)
    bins = collections.defaultdict(list)
    for r in runs:
        for k in range(r.count):
            bins[r.bin + k].append((r.offset, r.length))
    assert sorted(x for b in bins.values() for _, x in b) == sorted(lengths)
    for b in bins.values():
        end = 0
        for offset, x in sorted(b):
            assert offset == end
            end += x
        assert end <= 100
    assert len(bins) <= 1.02 * best_fit_decreasing(lengths, 100) + 1


# --- 5 language model --------------------------------------------------------

def test_scores(spark, docs):
    got = run(spark, "op5_lm_scores").sort_values("doc_id").reset_index(drop=True)
    text = [[*words(t), None] for t in docs.text]
    held = np.array([zlib.crc32(str(d).encode()) % 7 == 2 for d in docs.doc_id])
    c = collections.Counter(w for t, h in zip(text, held) if not h for w in t)
    n, v = sum(c.values()), len(c)
    assert list(got.held_out) == list(held) and list(got.n_tokens) == [len(t) for t in text]
    assert list(got.n_known) == [sum(c[w] > 0 for w in t) for t in text] and set(got.train_tokens) == {n}
    assert np.allclose(got.base_score, [sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t) for t in text])
    assert got[got.held_out].score.sum() > got[got.held_out].base_score.sum()


def test_scores_by_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(rng.choice(["a", "b", "c", "d", f"w{i}"], 30, p=[.4, .3, .2, .05, .05]))) for i in range(120)]
    got = lm.score_documents(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).toPandas().set_index("doc_id")
    fold = {d: zlib.crc32(str(d).encode()) % 7 for d, _ in rows}
    text = {d: [*words(t), "</s>"] for d, t in rows}

    def tables(keep):
        uni, bi, ctx = collections.Counter(), collections.Counter(), collections.Counter()
        for d, t in text.items():
            if keep(fold[d]):
                uni.update(t)
                bi.update(zip(["<s>", *t], t))
                ctx.update(["<s>", *t[:-1]])
                ctx["</s>"] += 1
        return uni, bi, ctx

    uni, bi, ctx = tables(lambda f: f != 2)
    n, v = sum(uni.values()), len(uni)
    u2, b2, c2 = tables(lambda f: f not in (2, 3))
    hist = collections.Counter()
    cell = lambda p: -1 if p <= 0 else round((math.log10(p * (v + 1)) + 20) * lm.GRID)
    for d, t in text.items():
        if fold[d] == 3:
            for left, w in zip(["<s>", *t], t):
                p2 = b2[left, w] / c2[left] if c2[left] >= lm.MIN_CONTEXT and ctx[left] >= lm.MIN_CONTEXT else 0
                hist[int(lm.bucket(np.array([c2[left]]))[0]), cell(p2), cell(u2[w] / sum(u2.values()))] += 1
    weights = lm.learn_weights([(*k, m) for k, m in hist.items()], 1 / (v + 1))
    for d, t in text.items():
        want = 0
        for left, w in zip(["<s>", *t], t):
            a = weights[int(lm.bucket(np.array([ctx[left]]))[0])]
            p2 = bi[left, w] / ctx[left] if ctx[left] >= lm.MIN_CONTEXT and uni[w] else 0
            want += math.log10(a[0] * p2 + a[1] * uni[w] / n + a[2] / (v + 1))
        assert got.score[d] == pytest.approx(want, rel=1e-6), d


def test_scores_of_odd_tables(spark, odd, none):
    got = lm.score_documents(spark, odd).toPandas()
    assert len(got) == len(ROWS) and np.isfinite(got.score).all() and (got.n_tokens >= 1).all()
    assert lm.score_documents(spark, none).count() == 0


# --- 6 near-duplicates -------------------------------------------------------

def components_by_force(rows, width, similarity):
    sets = {}
    for d, t in rows:
        w = words(t)
        sets[d] = {tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for a, i in enumerate(ids):
        for j in ids[a + 1:]:
            s, t = sets[i], sets[j]
            k = len(s & t)
            if k and 100 * k >= similarity * (len(s) + len(t) - k):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def test_near_duplicates(spark, docs):
    got = run(spark, "op6_near_duplicates")
    want = components_by_force(zip(docs.doc_id, docs.text), 2, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.itertuples()} == want
    assert (got.kept == (got.doc_id == got.component_id)).all()


def test_near_duplicate_chains(spark):
    """A drifting chain: neighbours are alike, its ends are not."""
    rng = np.random.default_rng(9)
    w = [f"w{i}" for i in range(60)]
    rows = []
    for d in range(60):
        if d:
            w[int(rng.integers(60))] = f"n{d}"
        rows.append((1000 - d, " ".join(w)))
    got = neardup.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), width=2).toPandas()
    want = components_by_force(rows, 2, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.itertuples()} == want


def test_near_duplicates_of_odd_tables(spark, odd, none):
    got = neardup.near_duplicates(spark, odd).toPandas()
    assert len(got) == len(ROWS)
    assert got[got.doc_id.isna()].component_id.isna().all() and got[got.doc_id.isna()].kept.all()
    by = got.dropna(subset="doc_id").drop_duplicates("doc_id").set_index("doc_id")
    assert by.component_id[7] == 6 and by.component_id[10] == 9 and by.n_shingles[3] == 0 and by.kept[5]
    assert neardup.near_duplicates(spark, none).count() == 0


# --- 8 quality ---------------------------------------------------------------

def test_quality(spark, docs):
    got = run(spark, "op8_quality").sort_values("doc_id")
    assert list(got.held_out) == [zlib.crc32(str(d).encode()) % 3 == 1 for d in docs.doc_id]
    labels = pd.read_parquet(f"{SF_SMALL}/labels.parquet")
    seen = got[got.held_out].merge(labels, on="doc_id")
    assert (seen.predicted == seen.quality).mean() >= 0.9
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()


def test_quality_of_odd_tables(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (None, 1), (6, None), (7, 1)], "doc_id long, quality int")
    model = quality.fit(spark, odd, labels)
    got = quality.with_scores(spark, odd, model).toPandas()
    assert len(got) == len(ROWS) and got.score.between(0, 1).all() and list(got.columns) == [*[c for c in odd.columns if c != "score"], "score"]
    assert quality.with_scores(spark, none, quality.fit(spark, none, labels)).count() == 0


# --- 9 fingerprints ----------------------------------------------------------

def signatures_by_force(text):
    w = [x for x in re.split(C.WORD_BREAK, (text or "").lower()) if x]
    anchors = set(spotsigs.ANCHORS)
    content = [x for x in w if x not in anchors]
    out, seen = set(), 0
    for i, x in enumerate(w):
        if x in anchors or len(content) == len(w):
            at = i + 1 if len(content) == len(w) else i - seen
            out.add((x, *(content[at + k] if at + k < len(content) else None for k in range(spotsigs.CHAIN))))
            seen += 1
    return out


def test_fingerprints(spark, docs):
    import hashlib
    got = run(spark, "op9_fingerprints").set_index("doc_id")
    text = dict(zip(docs.doc_id, docs.text))
    down = sorted(text, reverse=True)
    alike = lambda a, b: 1.0 if not a and not b else len(a & b) / len(a | b)
    for d, after in zip(down, down[1:] + down[:1]):
        t, half = text[d], len(text[d]) // 2
        edited = t[:len(t) - half] + text[after][:half]
        r = got.loc[d]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        mine = signatures_by_force(t)
        assert len(r.fingerprint) == spotsigs.HEX * len(mine)
        assert r.near_edited == pytest.approx(alike(mine, signatures_by_force(edited)), abs=1e-9)
        assert r.near_next == pytest.approx(alike(mine, signatures_by_force(text[after])), abs=1e-9)


def test_fingerprints_of_odd_tables(spark, odd, none):
    got = spotsigs.edited_fingerprints(spark, odd).toPandas()
    assert len(got) == len(ROWS) and got.near_next.between(0, 1).all()
    by = got.dropna(subset="doc_id").drop_duplicates("doc_id").set_index("doc_id")
    assert by.fingerprint[6] == by.fingerprint[7] and by.fingerprint[9] == by.fingerprint[10] and by.fingerprint[3] == ""
    assert by.near_next[7] == 1.0 and by.near_next[10] == 1.0
    assert spotsigs.edited_fingerprints(spark, none).count() == 0


def test_fingerprint_pairs(spark, docs):
    got = spotsigs.near_pairs(spark.createDataFrame(docs[["doc_id", "text"]]), 0.7).toPandas()
    first = {}
    for d, t in zip(docs.doc_id, docs.text):
        s = frozenset(signatures_by_force(t))
        if s:
            first.setdefault(s, d)
    sets = sorted(((d, s) for s, d in first.items()), key=lambda x: x[0])
    want = {(a, b) for k, (a, s) in enumerate(sets) for b, t in sets[k + 1:] if len(s & t) >= 0.7 * len(s | t)}
    assert set(zip(got.doc_id, got.other_id)) == want


# --- 10 line dedup -----------------------------------------------------------

def lines_by_force(rows, least):
    """Lines left of each document, by trying every run at every place."""
    seqs = {d: [(i, x) for i, x in enumerate(t.split("\n")) if re.sub(C.WORD_BREAK, "", x)] for d, t in rows}
    count = lambda x: len([w for w in re.split(C.WORD_BREAK, x) if w])
    seen, cut = set(), collections.defaultdict(set)
    for d in sorted(seqs):
        s = seqs[d]
        for e in range(1, len(s) + 1):
            for b in range(e):
                run_ = tuple(x for _, x in s[b:e])
                if sum(map(count, run_)) >= least:
                    first = next(((d2, b2) for d2 in sorted(seqs) if d2 <= d for b2 in range(len(seqs[d2]) - len(run_) + 1)
                                  if tuple(x for _, x in seqs[d2][b2:b2 + len(run_)]) == run_))
                    if first != (d, b):
                        cut[d].update(i for i, _ in s[b:e])
    return {d: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in cut[d]) for d, t in rows}


@pytest.mark.parametrize("least", [1, 3, 5])
def test_line_dedup_by_force(spark, least):
    rng = np.random.default_rng(least)
    lines = ["a b", "c", "d e f", "", "g h i j", "k l m n o p", " ", "q"]
    rows = [(d, "\n".join(rng.choice(lines, rng.integers(0, 9)))) for d in range(14)]
    got = linededup.dedup_lines(spark, spark.createDataFrame(rows, "doc_id long, text string"), least).toPandas()
    assert dict(zip(got.doc_id, got.text)) == lines_by_force(rows, least)


def test_line_dedup_of_odd_tables(spark, odd, none):
    got = linededup.dedup_lines(spark, odd).toPandas()
    assert len(got) == len(ROWS) and list(got.columns) == [*odd.columns, "lines_cut", "lines_left"]
    by = got.dropna(subset="doc_id").drop_duplicates("doc_id").set_index("doc_id")
    assert by.text[1] == ROWS[0][1] and by.text[2] == "other line" and by.lines_cut[7] == 400 and by.lines_left[7] == 0 and by.text[6] == LONG
    assert by.text[4] is None and by.text[3] == "" and by.text[5] == "   \n\t "
    assert linededup.dedup_lines(spark, none).count() == 0


# --- pipeline ----------------------------------------------------------------

def test_pipeline(spark, docs):
    import corpus_pipeline as P
    frame = C.read(spark, SF_SMALL, "documents")
    for name, stage in P.STAGES[:-1]:
        before = frame.toPandas().set_index("doc_id")
        frame = C.written(spark, stage(spark, frame, SF_SMALL), "test-stage")
        after = frame.toPandas().set_index("doc_id")
        assert frame.columns == list(docs.columns) and set(after.index) <= set(before.index)
        if name == "line dedup":
            want = lines_by_words(before)
            assert after.text.to_dict() == want
        elif name == "MinHash near-dedup":
            parts = components_by_force(before.text.items(), 5, 80)
            assert set(after.index) == {d for d, (_, c) in parts.items() if c == d}
        elif name == "benchmark decontamination":
            items = pd.read_parquet(f"{SF_SMALL}/benchmark.parquet")
            gone = {d for d, _ in leaks_by_force(before.text.items(), zip(items.item_id, items.text))}
            assert set(after.index) == set(before.index) - gone
        if name != "line dedup":
            assert (after.text == before.text[after.index]).all()
    packed = P.STAGES[-1][1](spark, frame, SF_SMALL).toPandas()
    check_packing(packed, 2048)
    assert set(packed.doc_id) == set(after.index)


def lines_by_words(before, least=linededup.MIN_WORDS):
    """Texts after line dedup, by the shortest long-enough run from and to each
    line; documents without a line left are missing."""
    count = lambda x: len([w for w in re.split(C.WORD_BREAK, x) if w])
    seqs = {d: [(i, x, count(x)) for i, x in enumerate(before.text[d].split("\n")) if count(x)] for d in sorted(before.index)}
    first, blocks = {}, []
    for d, s in seqs.items():
        for b in range(len(s)):
            total = 0
            for e in range(b, len(s)):
                total += s[e][2]
                if total >= least:
                    blocks.append((d, b, e))
                    break
        for e in range(len(s)):
            total = 0
            for b in range(e, -1, -1):
                total += s[b][2]
                if total >= least:
                    blocks.append((d, b, e))
                    break
    for d, b, e in sorted(set(blocks)):
        first.setdefault(tuple(x for _, x, _ in seqs[d][b:e + 1]), (d, b))
    cut = collections.defaultdict(set)
    for d, b, e in set(blocks):
        if first[tuple(x for _, x, _ in seqs[d][b:e + 1])] != (d, b):
            cut[d].update(i for i, _, _ in seqs[d][b:e + 1])
    out = {}
    for d, s in seqs.items():
        if not cut[d] or len(cut[d]) < len(s):
            out[d] = "\n".join(x for i, x in enumerate(before.text[d].split("\n")) if i not in cut[d])
    return out


def test_pipeline_of_no_documents(spark, tmp_path):
    import corpus_pipeline as P
    frame = C.read(spark, SF_SMALL, "documents").limit(0)
    for _, stage in P.STAGES:
        frame = stage(spark, frame, SF_SMALL)
    assert frame.count() == 0


def test_queries_are_registered():
    names = E.queries()
    assert sum(bool(re.match(r"op\d+_", n)) for n in names) == 13 and "pipeline" in names
