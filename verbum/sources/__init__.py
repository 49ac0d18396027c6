"""Sources: driver tables, text-file corpora, category sheets, stop words,
grammar/rule JSON and the lexicon."""
