"""Clashing column names, test items of few words and long labelled URLs."""

import itertools

import pytest

from verbum.llm import decontaminate, linededup, urlfilter

LINE = "one two three four five six seven eight nine ten eleven"


def test_line_dedup_keeps_columns_of_any_name(spark):
    names = ["starts", "spans", "doc_key", "new", "row", "_new", "i", "span", "c", "at", "a.b"]
    rows = [(k, f"{LINE}\nown line number {k}", *[f"{n}{k}" for n in names], 7) for k in (1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names) + ", lines_cut int")
    got = {r["doc_id"]: r.asDict() for r in linededup.dedup_lines(spark, docs).collect()}
    for k in (1, 2):
        assert [got[k][n] for n in names] == [f"{n}{k}" for n in names]
        assert got[k]["lines_cut"] == k - 1
    assert got[2]["text"] == "own line number 2"


def test_short_items_are_found_inside_texts(spark):
    texts = {1: "x y z alpha beta gamma u v w", 2: "Alpha beta gamma", 3: "alpha beta", 4: "beta gamma alpha", 5: "word", 6: None, 7: "",
             8: "so alpha beta  x gamma alpha gamma", 9: "p q " * 40 + "one two three four " + "r s " * 40, 10: "one two three four five six"}
    items = {1: "alpha beta gamma", 2: "word", 3: "one two three four", 4: "one two three four five six seven eight", 5: "alpha gamma", 6: " "}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    want = set()
    for (d, t), (i, x) in itertools.product(texts.items(), items.items()):
        have, need = (t or "").lower().split(), x.split()
        n = min(5, len(need))
        grams = {tuple(need[k:k + n]) for k in range(len(need) - n + 1)} if need else set()
        found = {tuple(have[k:k + n]) for k in range(len(have) - n + 1)}
        if grams and len(grams & found) >= 0.8 * len(grams):
            want.add((d, i))
    got = decontaminate.find_leaks(spark, docs, bench, short_items=True)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want
    assert {(1, 1), (2, 1), (9, 3), (8, 5), (5, 2)} <= want
    alone = decontaminate.find_leaks(spark, docs, bench)
    assert {(r["doc_id"], r["item_id"]) for r in alone.collect()} == {(2, 1), (5, 2)}


def rules_by_force(rows, floor, confidence, lift=1.2):
    """Minimal rules over all token sets of small URLs."""
    n, out = len(rows), {}
    tokens = sorted({t for s, _ in rows for t in s})
    for size in range(1, 4):
        for need in itertools.combinations(tokens, size):
            hits = [label for s, label in rows if set(need) <= s]
            for label in (urlfilter.BLOCK, urlfilter.ALLOW):
                k = hits.count(label)
                share = sum(x == label for _, x in rows) / n
                if k >= floor * n - 1e-9 and k / len(hits) >= confidence and k / len(hits) / share >= lift:
                    out[need, label] = k / len(hits)
    return {(need, label): c for (need, label), c in out.items()
            if not any(lab == label and set(m) < set(need) and o >= c for (m, lab), o in out.items())}


def test_mined_rules_by_force(spark):
    rows = []
    for k in range(60):
        tokens = {f"a{k % 3}", f"b{k % 4}", f"c{k % 5}"}
        rows.append((tokens, urlfilter.BLOCK if k % 4 == 0 and k % 3 else urlfilter.ALLOW))
    df = spark.createDataFrame([(sorted(s), label) for s, label in rows], "tokens array<string>, label string")
    got = {(tuple(r["tokens"]), r["label"]): r["confidence"] for r in urlfilter.mine_rules(df, 0.05, 0.6).collect()}
    want = rules_by_force(rows, 0.05, 0.6)
    assert set(got) == set(want) and want
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_long_labelled_urls(spark):
    long = "/".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200))
    urls = [f"http://good.example.net/en/{i}" for i in range(20)] + [f"http://bad.example.net/{long}/{i}" for i in range(20, 24)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i < 20), 0) for i in range(24)], "doc_id long, quality int, toxic int")
    got = {r["page_id"]: r["verdict"] for r in urlfilter.judge_urls(spark, pages, labels).collect()}
    assert got == {i: "allow" if i < 20 else "block" for i in range(24)}
