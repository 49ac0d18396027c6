"""Rows that repeat id and text are one document, cut alike."""

import collections

import pytest

from verbum.llm import linededup

LINE = "{} one two three four five six seven eight nine ten".format


@pytest.mark.parametrize("doc_id", [3, None])
def test_repeated_rows_of_several_lines(spark, doc_id):
    long, ends_short = "\n".join(map(LINE, "AB")), f"{LINE('P')}\n{LINE('Q')}\nq\nr"
    rows = [(doc_id, long), (doc_id, long), (doc_id, ends_short), (doc_id, ends_short), (doc_id, ends_short)]
    got = linededup.dedup_lines(spark, spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
    assert collections.Counter(got.text) == collections.Counter(t for _, t in rows) and (got.lines_cut == 0).all()


@pytest.mark.parametrize("doc_id", [3, None])
def test_repeated_rows_are_cut_alike(spark, doc_id):
    late = "\n".join(map(LINE, "ABC"))
    rows = [(1, LINE("B")), (doc_id, late), (doc_id, late)]
    got = linededup.dedup_lines(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).toPandas()
    want = [LINE("B")] + ["\n".join(map(LINE, "AC"))] * 2
    assert sorted(got.text) == sorted(want) and sorted(got.lines_cut) == [0, 1, 1]
