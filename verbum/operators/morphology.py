"""Lexicon-driven preprocessing.

Several parses per token are pre-aggregated once into one row per token
with boolean flags, so joining tokens to the lexicon never multiplies
rows.  The lexicon is keyed by vocabulary, not by corpus size; it is
broadcast only after its size is checked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from verbum.functions.joins import broadcast_checked

# POS groups and thresholds of the analyser rules.
STOP_POS = ("PREP", "ADVB", "COMP", "CONJ", "PRCL")
ADJ_POS = ("ADJF", "ADJS")
CLASS_DROP_POS = ("NUMR", "PREP", "CONJ", "PRCL", "INTJ")
ACTION_POS = ("VERB", "INFN", "PRTF", "PRTS", "GRND")
STOP_SCORE, PERSON_SCORE, NPRO_SCORE, ACTION_SCORE = 0.25, 0.05, 0.2, 0.2

# Readable names of the 17 POS codes (None → '').
POS_NAMES = {
    "NOUN": "Имя сушествительное",
    "ADJF": "Имя прилагательное",
    "ADJS": "Имя прилагательное (краткое)",
    "COMP": "Компаратив",
    "VERB": "Глагол (личная форма)",
    "INFN": "Глагол (инфинитив)",
    "PRTF": "Причастие (полное)",
    "PRTS": "Причастие (краткое)",
    "GRND": "Деепричастие",
    "NUMR": "Числительное",
    "ADVB": "Наречие",
    "NPRO": "Местоимение-существительное",
    "PRED": "Предикатив",
    "PREP": "Предлог",
    "CONJ": "Союз",
    "PRCL": "Частица",
    "INTJ": "Междометие",
}


def _has(tags: Column, g: str) -> Column:
    return F.array_contains(F.split(tags, ","), g)


def aggregate_parses(parses: DataFrame) -> DataFrame:
    """One row per token: top-parse fields (POS as ``pos_tag``) and the
    threshold flags."""
    p = parses
    s = F.col("score")
    name_like = _has(F.col("tags"), "Name") | _has(F.col("tags"), "Surn") | _has(F.col("tags"), "Patr")
    return p.groupBy("token").agg(
        F.min_by("pos", "rank").alias("pos_tag"),
        F.min_by("lemma", "rank").alias("lemma"),
        F.min_by("gcase", "rank").alias("gcase"),
        F.min_by("nominative", "rank").alias("nominative"),
        F.min_by("tags", "rank").alias("top_tags"),
        F.bool_or(F.col("pos").isin(*STOP_POS) & (s >= STOP_SCORE)).alias("stop_pos"),
        F.bool_or(F.col("pos").isin(*ADJ_POS) & (s >= STOP_SCORE)).alias("adj_pos"),
        F.bool_or(name_like & (s >= PERSON_SCORE)).alias("person"),
        F.bool_or(_has(F.col("tags"), "Surn") & (s >= PERSON_SCORE)).alias("surname"),
        F.bool_or((F.col("pos") == "NPRO") & (s >= NPRO_SCORE)).alias("_npro"),
        F.bool_or(((F.col("pos") == "NPRO") | name_like) & (s >= NPRO_SCORE)).alias("person_or_pronoun"),
        F.bool_or(F.col("pos").isin(*ACTION_POS) & (s >= ACTION_SCORE)).alias("action"),
    ).select("token", "pos_tag", "lemma", "gcase", "nominative", "stop_pos", "adj_pos", "person", "surname",
             "person_or_pronoun", "action", F.col("_npro").alias("pronoun"),
             (F.col("_npro") & ~_has(F.col("top_tags"), "1per")).alias("pronoun_3rd"))


def _join(toks: DataFrame, lex: DataFrame, token_col: str = "token") -> DataFrame:
    lx = broadcast_checked(lex.withColumnRenamed("token", "_lt"))
    return toks.join(lx, F.lower(F.col(token_col)) == F.col("_lt"), "left").drop("_lt")


def remove_pos_stop_words(toks: DataFrame, lex: DataFrame, min_word_size: int = 3,
                          cut_adj: bool = False) -> DataFrame:
    """P9 (+P8): drop short tokens and tokens any of whose parses is a
    preposition/adverb/comparative/conjunction/particle (also adjectives
    with ``cut_adj``) at score ≥ 0.25."""
    t = toks.filter((F.length("token") >= min_word_size) & F.col("token").rlike(r"^\p{L}+$"))
    j = _join(t, lex)
    drop = F.coalesce(F.col("stop_pos"), F.lit(False))
    if cut_adj:
        drop = drop | F.coalesce(F.col("adj_pos"), F.lit(False))
    return j.filter(~drop).select(*toks.columns)


def class_pos_filter(toks: DataFrame, lex: DataFrame) -> DataFrame:
    """P10: drop tokens whose top parse is a numeral, preposition,
    conjunction, particle or interjection; the rest become their lemma."""
    j = _join(toks, lex)
    keep = ~F.coalesce(F.col("pos_tag").isin(*CLASS_DROP_POS), F.lit(False))
    cols = [c for c in toks.columns if c != "token"]
    return j.filter(keep).select(*cols, F.coalesce("lemma", F.lower("token")).alias("token"))


def lemmatize(toks: DataFrame, lex: DataFrame) -> DataFrame:
    """Top parse's normal form, except given names / patronymics
    (person but not surname), which stay as written."""
    j = _join(toks, lex)
    keep_as_is = F.coalesce(F.col("person") & ~F.col("surname"), F.lit(False))
    cols = [c for c in toks.columns if c != "token"]
    return j.select(*cols, F.when(keep_as_is, F.col("token"))
                    .otherwise(F.coalesce("lemma", F.col("token"))).alias("token"))


def fix_case(toks: DataFrame, lex: DataFrame | None = None, mode: str = "lower") -> DataFrame:
    """``mode="lower"`` lower-cases everything (what the reference's
    check does in effect); ``mode="persons"`` capitalises person tokens."""
    if mode == "lower" or lex is None:
        return toks.withColumn("token", F.lower("token"))
    j = _join(toks, lex)
    cap = F.concat(F.upper(F.substring("token", 1, 1)), F.lower(F.expr("substring(token, 2)")))
    cols = [c for c in toks.columns if c != "token"]
    return j.select(*cols, F.when(F.coalesce("person", F.lit(False)), cap).otherwise(F.lower("token")).alias("token"))


def pos_name(pos_col="pos_tag") -> Column:
    """Readable POS name; NULL → ''."""
    m = F.create_map(*[x for k, v in POS_NAMES.items() for x in (F.lit(k), F.lit(v))])
    c = F.col(pos_col) if isinstance(pos_col, str) else pos_col
    return F.when(c.isNull(), F.lit("")).otherwise(F.coalesce(m[c], F.lit("")))


def sentence_predicates(toks: DataFrame, lex: DataFrame) -> DataFrame:
    """P20: per sentence, does it contain an action word; a person or pronoun."""
    j = _join(toks, lex)
    return j.groupBy("doc_id", "sent_id").agg(
        F.bool_or(F.coalesce("action", F.lit(False))).alias("has_action"),
        F.bool_or(F.coalesce("person_or_pronoun", F.lit(False))).alias("has_person"))


def documents_containing(toks: DataFrame, words: DataFrame, token_col: str = "token") -> DataFrame:
    """Documents containing any of ``words(word)`` (exact match)."""
    hit = toks.select("doc_id", F.col(token_col).alias("word")).join(words.select("word"), "word", "left_semi")
    return hit.select("doc_id").distinct()
