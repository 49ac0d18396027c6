"""Tokenisation and sentence splitting as built-in column expressions.

Regexes use ``\\p{L}`` / ``\\p{N}`` explicitly because ``\\w`` is ASCII-only
in Java regex; the same classes behave identically in RE2, so the DuckDB
oracles can use the same patterns.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Character classes of the tokenizers.
WORD_CHARS = r"[\p{L}\p{N}_-]+"          # word tokenizer: runs of letters, digits, '_' and '-'
ALPHA_TOKEN = r"^\p{L}{2,}$"              # kept tokens: letters only, at least two
LIBRARY_TOKEN = r"[\p{L}\p{N}_]{2,}"      # vectoriser default: two or more word characters
NON_LETTER_SPACE = r"[^\p{L}\s]"          # classification tokenizer: dropped characters
LATIN_INITIAL = r"^[^A-z]"                # classification tokenizer: optional first-char filter


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_sentences(text) -> Column:
    """Newlines become spaces, split on '.', strip, delete commas.

    Returns ``array<string>``; empty pieces are kept (positions matter)."""
    parts = F.split(F.regexp_replace(col(text), "\n", " "), r"\.")
    return F.transform(parts, lambda s: F.regexp_replace(F.regexp_replace(s, r"^\s+|\s+$", ""), ",", ""))


def word_tokens(sentence) -> Column:
    """Word tokens of a sentence, keeping alphabetic tokens of length > 1.

    A token with a hyphen or a digit is dropped, not split."""
    toks = F.regexp_extract_all(col(sentence), F.lit(WORD_CHARS), 0)
    return F.filter(toks, lambda t: t.rlike(ALPHA_TOKEN))


def class_tokens(text, drop_latin_initial: bool = False) -> Column:
    """P5: lower-case, keep letters and whitespace, split on single
    whitespace characters, drop empties; optionally drop tokens whose first
    character lies in ``A-z``."""
    cleaned = F.regexp_replace(F.lower(col(text)), NON_LETTER_SPACE, "")
    toks = F.filter(F.split(cleaned, r"\s"), lambda t: F.length(t) > 0)
    if drop_latin_initial:
        toks = F.filter(toks, lambda t: t.rlike(LATIN_INITIAL))
    return toks


def library_tokens(text) -> Column:
    """The vectoriser's default analyser — lower-case, runs of two or more
    word characters."""
    return F.regexp_extract_all(F.lower(col(text)), F.lit(LIBRARY_TOKEN), 0)
