"""A8 rows need no row for the terms of a single document."""

from verbum.operators import weighting as W


def test_rare_terms_left_out(spark):
    tf = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (2, "a", 1), (2, "c", 3), (3, "d", 1), (3, None, 1), (None, "e", 2)], "doc_id long, term string, n long")
    few = W.document_frequency(tf).filter("df > 1")
    got = W.l2_weights(tf, dfreq=few, above_one=True)
    plain = lambda df: sorted(((r["doc_id"], r["term"], round(r["w"], 12)) for r in df.collect()), key=str)
    assert few.count() == 1 and plain(got) == plain(W.l2_weights(tf)) and got.count() == 6
