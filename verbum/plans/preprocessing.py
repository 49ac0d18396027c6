"""Preprocessing queries (P1–P8, P11, P15, P16) over ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from verbum.operators import preprocess as P
from verbum.plans import sqlparts as Q
from verbum.plans.registry import query
from verbum.sources import tables, words


@query("sentences", sql=f"""
WITH {Q.sentences()}
SELECT doc_id, sent_id, sentence FROM sentences""")
def q_sentences(spark, sf):
    """Every sentence piece with its raw position."""
    return P.sentences(tables.documents(spark, sf))


@query("sentences_nonempty", sql=r"""
WITH s AS (
  SELECT doc_id,
         list_filter(list_transform(string_split(replace(text, chr(10), ' '), '.'),
                     lambda x: replace(regexp_replace(x, '^\s+|\s+$', '', 'g'), ',', '')),
                     lambda x: length(x) > 0) AS a
  FROM documents)
SELECT doc_id, (generate_subscripts(a, 1) - 1)::BIGINT AS sent_id, unnest(a) AS sentence FROM s""")
def q_sentences_nonempty(spark, sf):
    """Empty sentences removed, renumbered densely."""
    return P.sentences(tables.documents(spark, sf), drop_empty=True)


@query("tokens", sql=f"""
WITH {Q.tokens()}
SELECT doc_id, sent_id, pos, token FROM tokens""")
def q_tokens(spark, sf):
    """Word tokens, alphabetic and longer than one character."""
    return P.tokens(tables.documents(spark, sf))


@query("sentence_token_counts_min4", sql=f"""
WITH {Q.tokens(min_words=4)}
SELECT doc_id, COUNT(DISTINCT sent_id)::BIGINT AS n_sentences, COUNT(*)::BIGINT AS n_tokens
FROM tokens GROUP BY doc_id""")
def q_tokens_min4(spark, sf):
    """Sentences with at least four words (the summariser's setting)."""
    t = P.tokens(tables.documents(spark, sf), min_words=4)
    return t.groupBy("doc_id").agg(F.countDistinct("sent_id").alias("n_sentences"),
                                   F.count("*").alias("n_tokens"))


@query("class_tokens", sql=f"""
WITH {Q.class_tokens()}
SELECT doc_id, pos, token FROM ctoks""")
def q_class_tokens(spark, sf):
    """P5: classification tokenizer."""
    return P.class_tokens(tables.documents(spark, sf))


@query("lower_text_lengths", sql="""
SELECT doc_id, length(lower(text))::BIGINT AS n_chars, md5(lower(text)) AS text_md5 FROM documents""")
def q_lower_text(spark, sf):
    """Raw lower-cased documents (digest per document)."""
    d = P.lower_text(tables.documents(spark, sf))
    return d.select("doc_id", F.length("text").alias("n_chars"), F.md5("text").alias("text_md5"))


@query("library_tokens", sql=f"""
WITH {Q.lib_tokens()}
SELECT doc_id, pos, token FROM ltoks""")
def q_library_tokens(spark, sf):
    """Default vectoriser analyser."""
    return P.library_tokens(tables.documents(spark, sf))


@query("min_length_tokens", sql=f"""
WITH {Q.tokens()}
SELECT doc_id, sent_id, pos, token FROM tokens
WHERE length(token) >= 3 AND regexp_full_match(token, '\\p{{L}}+')""")
def q_min_length(spark, sf):
    """Minimum word length 3."""
    return P.min_length(P.tokens(tables.documents(spark, sf)), 3)


_SW = ", ".join(f"('{w}')" for w in words.stop_words_local())


@query("stop_word_removal", sql=f"""
WITH {Q.tokens()}, sw(word) AS (VALUES {_SW})
SELECT doc_id, sent_id, pos, token FROM tokens
WHERE lower(token) NOT IN (SELECT word FROM sw)""")
def q_stop_words(spark, sf):
    """List-based stop-word removal (the bundled multilingual list)."""
    return P.remove_stop_words(P.tokens(tables.documents(spark, sf)), words.stop_words(spark))


@query("compiled_text", sql=f"""
WITH {Q.tokens()}
SELECT doc_id, string_agg(token, ' ' ORDER BY sent_id, pos) AS text FROM tokens GROUP BY doc_id""")
def q_compiled(spark, sf):
    """Tokens joined back into one text per document."""
    return P.compile_text(P.tokens(tables.documents(spark, sf)))
