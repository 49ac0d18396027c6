"""Sentence and token preprocessing.

Long form is canonical: ``sentences(doc_id, sent_id, sentence)`` and
``tokens(doc_id, sent_id, pos, token)``.  Positions come from
``posexplode`` on per-row arrays, so no window or shuffle is needed to
number anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from verbum.functions import text as T
from verbum.functions.joins import broadcast_checked


def sentences(corpus: DataFrame, drop_empty: bool = False, doc_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """P1 (and P2 with ``drop_empty``): split documents into sentences.

    With ``drop_empty`` the empty pieces are removed *before* numbering, so
    ``sent_id`` is renumbered densely without a window."""
    arr = T.split_sentences(text_col)
    if drop_empty:
        arr = F.filter(arr, lambda s: F.length(s) > 0)
    return corpus.select(F.col(doc_col).alias("doc_id"),
                         F.posexplode(arr).alias("sent_id", "sentence"))


def sentence_tokens(sents: DataFrame, min_words: int = 1) -> DataFrame:
    """P3 + P4 on a sentences table: one array row per surviving sentence.

    Sentences of one character or less are skipped; sentences with fewer
    than ``min_words`` tokens are dropped (the sentence id is kept, so the
    original text stays aligned by key)."""
    toks = (sents.filter(F.length("sentence") > 1)
            .select("doc_id", "sent_id", T.word_tokens("sentence").alias("tokens")))
    return toks.filter(F.size("tokens") >= F.lit(max(min_words, 1)))


def tokens(corpus: DataFrame, min_words: int = 1, doc_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """P1→P3→P4: ``tokens(doc_id, sent_id, pos, token)`` keeping case."""
    st = sentence_tokens(sentences(corpus, doc_col=doc_col, text_col=text_col), min_words)
    return st.select("doc_id", "sent_id", F.posexplode("tokens").alias("pos", "token"))


def class_tokens(corpus: DataFrame, drop_latin_initial: bool = False,
                 doc_col: str = "doc_id", text_col: str = "text", keep=()) -> DataFrame:
    """P5: classification tokenizer, ``(doc_id, pos, token)`` (+ ``keep`` columns)."""
    return corpus.select(F.col(doc_col).alias("doc_id"), *keep,
                         F.posexplode(T.class_tokens(text_col, drop_latin_initial)).alias("pos", "token"))


def lower_text(corpus: DataFrame, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The raw lower-cased document."""
    return corpus.select(F.col(doc_col).alias("doc_id"), F.lower(text_col).alias("text"))


def library_tokens(corpus: DataFrame, doc_col: str = "doc_id", text_col: str = "text",
                   keep=()) -> DataFrame:
    """Default vectoriser analyser, ``(doc_id, pos, token)``."""
    return corpus.select(F.col(doc_col).alias("doc_id"), *keep,
                         F.posexplode(T.library_tokens(text_col)).alias("pos", "token"))


def min_length(toks: DataFrame, n: int = 3, token_col: str = "token") -> DataFrame:
    """Keep alphabetic tokens of at least ``n`` characters."""
    return toks.filter((F.length(token_col) >= n) & F.col(token_col).rlike(r"^\p{L}+$"))


def remove_stop_words(toks: DataFrame, stop_words: DataFrame, token_col: str = "token",
                      case_insensitive: bool = True) -> DataFrame:
    """Drop tokens found in a stop-word table ``(word)``.

    The stop list is broadcast after a size check (it is a word list, but a
    user may pass a big one)."""
    sw = stop_words.select(F.lower("word").alias("_sw") if case_insensitive else F.col("word").alias("_sw")).distinct()
    key = F.lower(token_col) if case_insensitive else F.col(token_col)
    return toks.join(broadcast_checked(sw), key == F.col("_sw"), "left_anti")


def compile_text(toks: DataFrame, token_col: str = "token") -> DataFrame:
    """Per document, all tokens in (sentence, position) order joined by
    one space.  One row per document; the sort is inside that row."""
    g = toks.groupBy("doc_id").agg(
        F.array_sort(F.collect_list(F.struct("sent_id", "pos", F.col(token_col).alias("t")))).alias("_a"))
    return g.select("doc_id", F.array_join(F.transform("_a", lambda s: s["t"]), " ").alias("text"))


def preprocess(corpus: DataFrame, lexicon: DataFrame | None = None, min_word_size: int = 3,
               cut_adj: bool = False, min_words: int = 1) -> DataFrame:
    """P1→P3→P9→P12→P14, returning normalised tokens.

    Without a lexicon this is P16 (pass-through: tokens only)."""
    toks = tokens(corpus, min_words=min_words)
    if lexicon is None:
        return toks
    from verbum.operators import morphology as M
    toks = M.remove_pos_stop_words(toks, lexicon, min_word_size=min_word_size, cut_adj=cut_adj)
    toks = M.lemmatize(toks, lexicon)
    return M.fix_case(toks, lexicon)


def passthrough(corpus: DataFrame) -> DataFrame:
    """Tokens without removal or lemmatisation."""
    return tokens(corpus)
