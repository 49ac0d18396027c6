r"""DuckDB fragments shared by the oracle SQL strings.

They restate, in DuckDB's dialect, the column expressions of
``verbum.functions.text``: same regex classes (``\p{L}`` behaves the same in
Java regex and RE2), same order of operations.
"""

# P1 sentences (raw positions) over a table with (doc_id, text)
SENTENCES = r"""
sentences AS (
  SELECT doc_id, (generate_subscripts(s, 1) - 1)::BIGINT AS sent_id, unnest(s) AS sentence
  FROM (SELECT doc_id,
               list_transform(string_split(replace(text, chr(10), ' '), '.'),
                              lambda x: replace(regexp_replace(x, '^\s+|\s+$', '', 'g'), ',', '')) AS s
        FROM {src}))"""

# P3 tokens from the sentences CTE
TOKENS = r"""
sent_tokens AS (
  SELECT doc_id, sent_id,
         list_filter(regexp_extract_all(sentence, '[\p{L}\p{N}_-]+'),
                     lambda t: regexp_full_match(t, '\p{L}{2,}')) AS toks
  FROM sentences WHERE length(sentence) > 1),
tokens AS (
  SELECT doc_id, sent_id, (generate_subscripts(toks, 1) - 1)::BIGINT AS pos, unnest(toks) AS token
  FROM sent_tokens WHERE len(toks) >= {min_words})"""

# P5 classification tokens over a table with (doc_id, text, ...)
CLASS_TOKENS = r"""
ctoks AS (
  SELECT doc_id{keep}, (generate_subscripts(a, 1) - 1)::BIGINT AS pos, unnest(a) AS token
  FROM (SELECT doc_id{keep},
               list_filter(string_split_regex(regexp_replace(lower(text), '[^\p{L}\s]', '', 'g'), '\s'),
                           lambda t: length(t) > 0) AS a
        FROM {src}))"""

# P7 library tokens
LIB_TOKENS = r"""
ltoks AS (
  SELECT doc_id{keep}, (generate_subscripts(a, 1) - 1)::BIGINT AS pos, unnest(a) AS token
  FROM (SELECT doc_id{keep}, regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}') AS a FROM {src}))"""

# labelled corpus: documents ⋈ labels with split (test = doc_id % 5 = 0)
LABELLED = r"""
lab AS (
  SELECT d.doc_id, d.text, CAST(l.{label} AS VARCHAR) AS label,
         CASE WHEN d.doc_id % 5 = 0 THEN 'test' ELSE 'train' END AS split
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def sentences(src: str = "documents") -> str:
    return SENTENCES.replace("{src}", src)


def tokens(src: str = "documents", min_words: int = 1) -> str:
    return sentences(src) + "," + TOKENS.replace("{min_words}", str(max(min_words, 1)))


def class_tokens(src: str = "documents", keep: str = "") -> str:
    return CLASS_TOKENS.replace("{src}", src).replace("{keep}", keep)


def lib_tokens(src: str = "documents", keep: str = "") -> str:
    return LIB_TOKENS.replace("{src}", src).replace("{keep}", keep)


def labelled(label: str = "quality") -> str:
    return LABELLED.replace("{label}", label)
