"""Frequent word groups: tokens stay with their documents."""

from verbum.operators import weighting as W


def test_tokens_stay_with_their_documents(spark):
    """all tokens were shuffled by word, and again by sentence."""
    texts = ["a b c a b", "a b x a b c", "c a", "b"]
    toks = spark.createDataFrame([(d, 0, p, t) for d, s in enumerate(texts) for p, t in enumerate(s.split())], "doc_id long, sent_id int, pos int, token string")
    out = W.frequent_word_groups(toks.repartition("doc_id"), min_support=3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(token" not in plan and plan.count("Exchange hashpartitioning(doc_id") == 1
    got = {(r.doc_id, r.start, r.word_group) for r in out.collect()}
    assert got == {(0, 0, "a b c a b"), (0, 1, "b c a b"), (0, 2, "c a b"), (0, 3, "a b"), (1, 0, "a b"), (1, 3, "a b c"), (1, 4, "b c"), (2, 0, "c a")}
