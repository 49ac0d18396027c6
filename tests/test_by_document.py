"""Queries on tokens: one exchange of the text by document, none of the tokens."""

import pytest
from pyspark.sql import functions as F

from verbum.operators import extract as X, preprocess as P
from verbum.plans import load_all


@pytest.fixture(scope="module")
def many_files(spark, tmp_path_factory):
    """A corpus of more splits than the session has cores."""
    sf = str(tmp_path_factory.mktemp("corpus"))
    text = F.concat(F.lit("Cou going there. He saw the table and "), F.col("id").cast("string"), F.lit(" chairs. It was running.\nCou Dupier is here."))
    spark.range(60).select(F.col("id").alias("doc_id"), text.alias("text")).repartition(24).write.parquet(sf + "/documents.parquet")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")
    yield sf
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]


@pytest.mark.parametrize("name", ["sentence_predicates", "person_spans", "noun_entities", "summary_matrix"])
def test_tokens_are_not_exchanged_by_sentence(spark, many_files, name):
    seen = _exchanges(load_all()[0][name](spark, many_files))
    assert seen and not [x for x in seen if "sent_id" in x]


def test_spans_pronouns_and_frames(spark):
    lex = spark.createDataFrame(
        [("anna", "NOUN", "anna", "nomn", "anna", True, False), ("berg", "NOUN", "berg", "nomn", "berg", True, False),
         ("karls", "NOUN", "karl", "gent", "karl", True, False), ("she", "NPRO", "she", "nomn", "she", False, True),
         ("sees", "VERB", "see", None, "sees", False, False), ("cat", "NOUN", "cat", "nomn", "cat", False, False)],
        "token string, pos_tag string, lemma string, gcase string, nominative string, person boolean, pronoun_3rd boolean")
    docs = spark.createDataFrame([(1, "Anna Berg sees karls cat. She sees. Anna xx berg. xx. She sees she"), (2, "She sees cat"), (None, "Anna. She sees")], "doc_id long, text string")
    t = P.tokens(docs.repartition("doc_id"))
    spans = {(r["sent_id"], r["start"], r["n_tokens"], r["person"]) for r in X.person_spans(t, lex).where("doc_id = 1").collect()}
    assert spans == {(0, 0, 2, "Anna Berg"), (0, 3, 1, "Karl"), (2, 0, 1, "Anna"), (2, 2, 1, "Berg")}
    told = sorted(tuple(r) for r in X.coreference(t, lex).collect())
    assert told == [(1, 1, 0, "She", "Karl"), (1, 4, 0, "She", "Berg"), (1, 4, 2, "she", "Berg")]
    grammar = spark.createDataFrame([("see", ["#$", "#ESS", "#$", "?"])], "verb string, slots array<string>")
    framed = sorted(tuple(r) for r in X.frames(t, lex, grammar).collect())
    assert framed == [(1, 0, "see", "Anna Berg|cat|Karl|"), (1, 1, "see", "|||"), (1, 4, "see", "|||"), (2, 0, "see", "|cat||")]
