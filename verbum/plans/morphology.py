"""Lexicon-driven preprocessing and extraction queries (P9, P10, P12–P14,
P17–P21, X1–X9) with the suffix-rule lexicon derived from the corpus."""

from __future__ import annotations

from pyspark.sql import functions as F

from verbum.operators import extract as X, morphology as M, preprocess as P, weighting as W
from verbum.plans import sqlparts as Q
from verbum.plans.registry import query
from verbum.session import written
from verbum.sources import tables
from verbum.sources.lexicon import derived_parses, parses_sql

_NAME = ("(list_contains(string_split(tags, ','), 'Name') OR list_contains(string_split(tags, ','), 'Surn') "
         "OR list_contains(string_split(tags, ','), 'Patr'))")
_POSNAME = "CASE " + " ".join(f"WHEN pos = '{k}' THEN '{v}'" for k, v in M.POS_NAMES.items()) + " ELSE '' END"

_LEX = f"""{Q.tokens()},
vt AS (SELECT DISTINCT lower(token) AS t FROM tokens),
lexp AS ({parses_sql('vt')}),
top AS (SELECT * FROM lexp WHERE rank = 1),
flags AS (SELECT token,
  bool_or(pos IN ('PREP','ADVB','COMP','CONJ','PRCL') AND score >= 0.25) AS stop_pos,
  bool_or(pos IN ('ADJF','ADJS') AND score >= 0.25) AS adj_pos,
  bool_or({_NAME} AND score >= 0.05) AS person,
  bool_or(list_contains(string_split(tags, ','), 'Surn') AND score >= 0.05) AS surname,
  bool_or(pos = 'NPRO' AND score >= 0.2) AS pronoun,
  bool_or((pos = 'NPRO' OR {_NAME}) AND score >= 0.2) AS person_or_pronoun,
  bool_or(pos IN ('VERB','INFN','PRTF','PRTS','GRND') AND score >= 0.2) AS action
  FROM lexp GROUP BY token),
lex AS (SELECT top.token, top.pos, top.lemma, top.gcase, top.nominative, f.stop_pos, f.adj_pos, f.person, f.surname,
               f.pronoun, f.person_or_pronoun, f.action,
               f.pronoun AND NOT list_contains(string_split(top.tags, ','), '1per') AS pronoun_3rd
        FROM top JOIN flags f ON top.token = f.token),
ann AS (SELECT t.doc_id, t.sent_id, t.pos, t.token, l.pos AS tag, COALESCE(l.lemma, lower(t.token)) AS lemma, l.gcase,
               COALESCE(l.nominative, lower(t.token)) AS nominative, COALESCE(l.person, false) AS person,
               COALESCE(l.pronoun_3rd, false) AS pronoun_3rd
        FROM tokens t LEFT JOIN lex l ON lower(t.token) = l.token)"""

_PERSONS = f"""{_LEX},
ps0 AS (SELECT *, CASE WHEN person AND NOT (COALESCE(lag(person) OVER w, false)
                        AND (lag(gcase) OVER w IS NOT DISTINCT FROM gcase) AND lag(pos) OVER w = pos - 1)
                  THEN 1 ELSE 0 END AS s
        FROM ann WINDOW w AS (PARTITION BY doc_id, sent_id ORDER BY pos)),
ps1 AS (SELECT *, SUM(s) OVER (PARTITION BY doc_id, sent_id ORDER BY pos) AS span FROM ps0),
persons AS (SELECT doc_id, sent_id, MIN(pos) AS start, COUNT(*) AS n_tokens,
                   string_agg(upper(substr(nominative, 1, 1)) || lower(substr(nominative, 2)), ' ' ORDER BY pos) AS person
            FROM ps1 WHERE person GROUP BY doc_id, sent_id, span),
nn AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id, sent_id ORDER BY pos) AS isl
       FROM ann WHERE tag = 'NOUN' AND NOT person),
ents AS (SELECT doc_id, sent_id, MIN(pos) AS start, string_agg(lower(nominative), ' ' ORDER BY pos) AS entity
         FROM nn GROUP BY doc_id, sent_id, isl),
acts AS (SELECT doc_id, sent_id, pos, lower(lemma) AS action FROM ann WHERE tag IN ('VERB', 'INFN'))"""

_FRAMES = f"""{_PERSONS},
fa AS (SELECT doc_id, sent_id, arg_min(action, pos) AS action FROM acts GROUP BY doc_id, sent_id),
p1 AS (SELECT doc_id, sent_id, arg_min(person, start) AS p FROM persons GROUP BY doc_id, sent_id),
e1 AS (SELECT doc_id, sent_id, arg_min(entity, start) AS e FROM ents GROUP BY doc_id, sent_id),
fr AS (SELECT fa.doc_id, fa.sent_id, fa.action, COALESCE(p1.p, '') || '|' || COALESCE(e1.e, '') AS args
       FROM fa LEFT JOIN p1 ON fa.doc_id = p1.doc_id AND fa.sent_id = p1.sent_id
       LEFT JOIN e1 ON fa.doc_id = e1.doc_id AND fa.sent_id = e1.sent_id)"""


def _toks(spark, sf):
    return P.tokens(tables.documents_by_id(spark, sf))


def _words(spark, sf):
    """Tokens for the lexicon, which is grouped by token: the scan stays as it is."""
    return P.tokens(tables.documents(spark, sf))


def _lex(toks):
    """The lexicon, written once: every join counts it and reads it again."""
    return written(M.aggregate_parses(derived_parses(toks)))


@query("lexicon", sql=f"""
WITH {_LEX}
SELECT token, pos, {_POSNAME} AS pos_name, lemma, gcase, nominative, stop_pos::BIGINT AS stop_pos,
       adj_pos::BIGINT AS adj_pos, person::BIGINT AS person, surname::BIGINT AS surname,
       pronoun::BIGINT AS pronoun, pronoun_3rd::BIGINT AS pronoun_3rd,
       person_or_pronoun::BIGINT AS person_or_pronoun, action::BIGINT AS action FROM lex""")
def q_lexicon(spark, sf):
    """Derived lexicon with the P13 / P19 / P20 flags and P18 POS names."""
    lex = _lex(_words(spark, sf))
    return lex.select("token", F.col("pos_tag").alias("pos"), M.pos_name("pos_tag").alias("pos_name"), "lemma", "gcase", "nominative",
                      "stop_pos", "adj_pos", "person", "surname", "pronoun", "pronoun_3rd",
                      "person_or_pronoun", "action")


@query("pos_stop_removal", sql=f"""
WITH {_LEX}
SELECT t.doc_id, t.sent_id, t.pos, t.token FROM tokens t LEFT JOIN lex l ON lower(t.token) = l.token
WHERE length(t.token) >= 3 AND regexp_full_match(t.token, '\\p{{L}}+') AND NOT COALESCE(l.stop_pos, false)""")
def q_pos_stop(spark, sf):
    """POS-based stop-word removal (minimum word size 3)."""
    t = _toks(spark, sf)
    return M.remove_pos_stop_words(t, _lex(_words(spark, sf)), min_word_size=3)


@query("class_pos_filter", sql=f"""
WITH {_LEX}, {Q.class_tokens()},
cl AS (SELECT DISTINCT token AS t FROM ctoks),
clp AS ({parses_sql('cl')}),
ctop AS (SELECT token, pos, lemma FROM clp WHERE rank = 1)
SELECT c.doc_id, c.pos, COALESCE(l.lemma, c.token) AS token FROM ctoks c LEFT JOIN ctop l ON c.token = l.token
WHERE NOT COALESCE(l.pos IN ('NUMR', 'PREP', 'CONJ', 'PRCL', 'INTJ'), false)""")
def q_class_pos(spark, sf):
    """P10: classification POS filter + lemmas on classification tokens."""
    ct = P.class_tokens(tables.documents(spark, sf))
    return M.class_pos_filter(ct, _lex(ct))


@query("normalized_word_frequency", sql=f"""
WITH {_LEX},
p9 AS (SELECT t.doc_id, t.token FROM tokens t LEFT JOIN lex l ON lower(t.token) = l.token
       WHERE length(t.token) >= 3 AND regexp_full_match(t.token, '\\p{{L}}+') AND NOT COALESCE(l.stop_pos, false)),
p12 AS (SELECT p9.doc_id, CASE WHEN COALESCE(l.person AND NOT l.surname, false) THEN p9.token
                              ELSE COALESCE(l.lemma, p9.token) END AS token
        FROM p9 LEFT JOIN lex l ON lower(p9.token) = l.token)
SELECT doc_id, lower(token) AS term, COUNT(*)::BIGINT AS n FROM p12 GROUP BY doc_id, lower(token)""")
def q_normalized_tf(spark, sf):
    """P1→P3→P9→P12→P14 then A1 (the full preprocessing chain)."""
    t = _toks(spark, sf)
    lex = _lex(_words(spark, sf))
    return W.term_frequency(P.preprocess(tables.documents(spark, sf), lexicon=lex))


@query("sentence_predicates", sql=f"""
WITH {_LEX}
SELECT t.doc_id, t.sent_id, bool_or(COALESCE(l.action, false))::BIGINT AS has_action,
       bool_or(COALESCE(l.person_or_pronoun, false))::BIGINT AS has_person
FROM tokens t LEFT JOIN lex l ON lower(t.token) = l.token GROUP BY t.doc_id, t.sent_id""")
def q_sentence_pred(spark, sf):
    """P20: sentences containing an action / a person or pronoun."""
    t = _toks(spark, sf)
    return M.sentence_predicates(t, _lex(_words(spark, sf)))


@query("documents_containing_word", sql=f"""
WITH {Q.tokens()}
SELECT DISTINCT doc_id FROM tokens WHERE token = 'the'""")
def q_contains(spark, sf):
    """Documents containing the word 'the'."""
    words = spark.range(1).select(F.lit("the").alias("word"))
    return M.documents_containing(_toks(spark, sf), words)


@query("person_spans", sql=f"""
WITH {_PERSONS}
SELECT doc_id, sent_id, start, n_tokens::BIGINT AS n_tokens, person FROM persons""")
def q_persons(spark, sf):
    """Person spans (consecutive person tokens of one case)."""
    t = _toks(spark, sf)
    return X.person_spans(t, _lex(_words(spark, sf)))


@query("coreference", sql=f"""
WITH {_PERSONS},
lastp AS (SELECT doc_id, sent_id, arg_max(person, start) AS lastp FROM persons GROUP BY doc_id, sent_id),
sents AS (SELECT DISTINCT doc_id, sent_id FROM tokens),
sp AS (SELECT s.doc_id, s.sent_id, last_value(l.lastp IGNORE NULLS) OVER (PARTITION BY s.doc_id ORDER BY s.sent_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS person
       FROM sents s LEFT JOIN lastp l ON s.doc_id = l.doc_id AND s.sent_id = l.sent_id)
SELECT a.doc_id, a.sent_id, a.pos, a.token AS pronoun, sp.person FROM ann a
JOIN sp ON a.doc_id = sp.doc_id AND a.sent_id = sp.sent_id WHERE a.pronoun_3rd AND sp.person IS NOT NULL""")
def q_coref(spark, sf):
    """Pronouns resolved to the last person of an earlier sentence."""
    t = _toks(spark, sf)
    return X.coreference(t, _lex(_words(spark, sf)))


@query("organisations", sql=f"""
WITH {Q.sentences()},
m AS (SELECT doc_id, sent_id,
             regexp_extract_all(sentence, '(ОАО|ЗАО|ООО)\\s*["«]([^"»]+)["»]', 1) AS p,
             regexp_extract_all(sentence, '(ОАО|ЗАО|ООО)\\s*["«]([^"»]+)["»]', 2) AS n FROM sentences),
u AS (SELECT doc_id, sent_id, unnest(p) AS p, unnest(n) AS n FROM m)
SELECT doc_id, sent_id, p || ' "' || n || '"' AS org FROM u""")
def q_orgs(spark, sf):
    """Organisation names after a legal-form prefix."""
    return X.organisations(P.sentences(tables.documents(spark, sf)))


@query("noun_entities", sql=f"""
WITH {_PERSONS}
SELECT doc_id, sent_id, start, entity FROM ents""")
def q_entities(spark, sf):
    """Maximal noun runs as entities."""
    t = _toks(spark, sf)
    return X.noun_entities(t, _lex(_words(spark, sf)))


@query("actions", sql=f"""
WITH {_PERSONS}
SELECT doc_id, sent_id, pos, action FROM acts""")
def q_actions(spark, sf):
    """Action words (finite verbs and infinitives) with their lemma."""
    t = _toks(spark, sf)
    return X.actions(t, _lex(_words(spark, sf)))


@query("frames", sql=f"""
WITH {_FRAMES}
SELECT doc_id, sent_id, action, args FROM fr""")
def q_frames(spark, sf):
    """X6 + X8: one frame per sentence (first action; person slot, entity
    slot) with restored names, under the default grammar."""
    t = _toks(spark, sf)
    lex = _lex(_words(spark, sf))
    return X.frames(t, lex, X.default_grammar(X.actions(t, lex)))


@query("extraction_listing", sql=f"""
WITH {_PERSONS}
SELECT 'person' AS kind, person AS value, COUNT(DISTINCT doc_id)::BIGINT AS n_docs FROM persons GROUP BY person
UNION ALL SELECT 'entity', entity, COUNT(DISTINCT doc_id)::BIGINT FROM ents GROUP BY entity
UNION ALL SELECT 'action', action, COUNT(DISTINCT doc_id)::BIGINT FROM acts GROUP BY action""")
def q_listing(spark, sf):
    """Persons, entities and actions of the corpus with document counts."""
    t = _toks(spark, sf)
    lex = _lex(_words(spark, sf))
    return X.listing(X.person_spans(t, lex), X.noun_entities(t, lex), X.actions(t, lex))


@query("rewrite_rules", sql=f"""
WITH {_FRAMES},
top_act AS (SELECT action FROM fr GROUP BY action ORDER BY COUNT(*) DESC, action LIMIT 1),
nx AS (SELECT *, lead(action) OVER (PARTITION BY doc_id ORDER BY sent_id) AS nxt FROM fr),
kept AS (SELECT nx.* FROM nx CROSS JOIN top_act t WHERE NOT (nx.action = t.action AND COALESCE(nx.nxt = t.action, false)))
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY sent_id) - 1)::BIGINT AS seq, action, args FROM kept""")
def q_rewrite(spark, sf):
    """Rewrite rules over each document's frame sequence.  Rule set:
    two consecutive frames of the corpus's most frequent action collapse into
    one with the later frame's person and object."""
    t = _toks(spark, sf)
    lex = _lex(_words(spark, sf))
    fr = written(X.frames(t, lex, X.default_grammar(X.actions(t, lex))))
    top = fr.groupBy("action").count().orderBy(F.desc("count"), "action").first()
    rules = [] if top is None else [{
        "source_scheme": [[top["action"], "#1", "#2"], [top["action"], "#1", "#3"]],
        "replace_scheme": [[top["action"], "#1", "#3"]]}]
    return X.apply_rules(fr, rules)
