"""Whole texts to token ids by the public tokenizers, by Arrow batches.

Both vocabularies cut a text into words before any merging and never look
across the cut, so a text's ids are those of its pieces laid end to end.  Each
distinct piece of a batch goes through the tokenizers library once and stays in
a bounded cache of the worker: pieces of Latin-1 are cut into words here and the
words go to the library's BPE model, other pieces go through its whole chain.
Texts where a cut beside a blank could matter, and texts that hold the string
of a special token, are encoded whole.
"""

from __future__ import annotations

import os
import re
from array import array
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from verbum.llm import common as C

WORDS = "word_bpe_49k.json"      # lower-cased, white space dropped
BYTES = "byte_bpe_50k.json"      # byte level; a blank belongs to the word behind it
# A blank beside another white space (Unicode's, and the separators \x1c-\x1f):
# the byte-level cut depends on the whole run there.
BLANK_RUN = r" [\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] "
CACHED = 400_000                 # pieces, and words, that a worker remembers


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``starts[i], ..., starts[i] + lengths[i] - 1`` of all ``i`` in a row."""
    ends = np.cumsum(lengths, dtype=np.int64)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


# Letters and numbers of Latin-1; its texts are in normal form C already.
LETTER, NUMBER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
# Pieces of Latin-1 without apostrophes or white space other than single line
# feeds inside: their cut into words needs no look at the surroundings.
SIMPLE = re.compile("(?:[\x21-\x26\x28-\x7e\xa1-\xff]+(?:\n(?=[^\n]))?)*")
LETTERS, MARKS = re.compile(f"[{LETTER}]+"), ".,;:!?"
SINGLE_NUMBERS = re.compile(f"[{LETTER}]+|[{NUMBER}]|[^\n{LETTER}{NUMBER}]+")
NUMBER_RUNS = re.compile(f"[{LETTER}]+|[{NUMBER}]+|\n|[^\n{LETTER}{NUMBER}]+")


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others
    for the letters from 256 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """Ids of whole texts: ``encode(texts)`` gives ``(ids, offsets)``.

    ``special_as_text``: the strings of the vocabulary's special tokens are
    ordinary text; else, as the library has it by default, each is one id."""

    def __init__(self, name: str, cached: int = CACHED, special_as_text: bool = True):
        self.cached = cached
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(C.vocabulary_file(name))
        self.lib.encode_special_tokens = special_as_text
        self.special = [] if special_as_text else [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.keeps_blanks = name != WORDS
        letters = byte_letters()
        self.spelled = {chr(c): "".join(letters[x] for x in chr(c).encode()) for c in range(256)}
        self.ascii = str.maketrans({c: t for c, t in self.spelled.items()})
        self.cut = NUMBER_RUNS if self.keeps_blanks else SINGLE_NUMBERS
        self.words, self.place, self.n = {}, {}, 0
        self.store, self.start, self.length = np.zeros(1 << 20, np.uint16), np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.lib.encode_batch(texts, add_special_tokens=False)]

    def word(self, w: str) -> bytes:
        """Ids of one word by the library's BPE model, as 16-bit integers."""
        got = self.words.get(w)
        if got is None:
            got = array("H", [t.id for t in self.lib.model.tokenize(w.translate(self.ascii))]).tobytes()
            if len(self.words) < self.cached:
                self.words[w] = got
        return got

    def piece(self, p: str) -> bytes:
        mark = p[-1:] in MARKS and len(p) > 1       # most pieces: one word, perhaps with a mark behind it
        core = p[p[:1] == " ":len(p) - mark]
        if core.isalpha() and (core.isascii() or LETTERS.fullmatch(core)):
            p = p if self.keeps_blanks else p.lower()
            return self.word(p[:-1]) + self.word(p[-1]) if mark else self.word(p)
        if not SIMPLE.fullmatch(p, 1 if p[:1] == " " else 0):
            return array("H", self.lib.encode(p, add_special_tokens=False).ids).tobytes()
        if not self.keeps_blanks:
            p = p.lower()
        elif p[:1] == " ":
            first, *rest = self.cut.findall(p, 1) or [""]
            return b"".join(map(self.word, [" " + first, *rest]))
        return b"".join(map(self.word, self.cut.findall(p)))

    def slots(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and length of each distinct piece's ids, and the ids they lie
        in: the store of the cache, with those behind it that it has no room for."""
        slot = np.fromiter(map(self.place.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(slot < 0)
        start, length = self.start[slot], self.length[slot]
        if not len(missing):
            return start, length, self.store
        new = [pieces[i] for i in missing.tolist()]
        got = [self.piece(p) for p in new]
        lengths = np.fromiter(map(len, got), np.int32, len(got)) // 2
        total = int(lengths.sum())
        while self.n + total > len(self.store):
            self.store = np.concatenate([self.store, np.zeros_like(self.store)])
        self.store[self.n:self.n + total] = np.frombuffer(b"".join(got), np.uint16)
        starts = self.n + np.cumsum(lengths) - lengths
        start[missing], length[missing] = starts, lengths
        have = len(self.place)
        room = min(len(new), self.cached - have)
        if room > 0:
            while have + room > len(self.start):
                self.start, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length))
            self.start[have:have + room], self.length[have:have + room] = starts[:room], lengths[:room]
            self.place.update(zip(new[:room], range(have, have + room), strict=True))
            self.n += int(lengths[:room].sum())
        return start, length, self.store

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        texts = texts.take(pa.array(np.arange(len(texts))))
        odd = np.zeros(len(texts), bool)
        if self.keeps_blanks:
            odd = pc.match_substring_regex(texts, BLANK_RUN).to_numpy(zero_copy_only=False).astype(bool)
        for t in self.special:                      # cut out before anything else, so such a text goes whole
            odd |= pc.match_substring(texts, t).to_numpy(zero_copy_only=False).astype(bool)
        if not self.keeps_blanks:
            texts = pc.replace_substring(texts, "\n", " ")
        plain = pc.if_else(pa.array(odd), pa.scalar("", pa.large_string()), texts) if odd.any() else texts
        lists = pc.split_pattern(plain, " ")
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        codes, parts = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()
        if self.keeps_blanks:                       # all but a text's first part have the blank before them
            first = np.zeros(len(codes), bool)
            first[(np.cumsum(counts) - counts)[counts > 0]] = True
            heads, at = np.unique(codes[first], return_inverse=True)
            codes[first] = len(parts) + at
            parts = [" " + p for p in parts] + [parts[i] for i in heads.tolist()]
        start, length, store = self.slots(parts)
        each = length[codes]
        ids = store[ragged(start[codes], each)]
        sums = np.concatenate([[0], np.cumsum(each, dtype=np.int64)])
        ends = np.cumsum(counts)
        n = sums[ends] - sums[ends - counts]
        if odd.any():
            n[odd] = 0                              # an empty part may have had no id anyway
            cut = np.concatenate([[0], np.cumsum(sums[ends] - sums[ends - counts])])
            texts_odd = self.whole([texts[int(i)].as_py() for i in np.flatnonzero(odd)])
            rows, k = [], 0
            for i in range(len(texts)):
                if odd[i]:
                    rows.append(np.array(texts_odd[k], np.uint16))
                    k += 1
                else:
                    rows.append(ids[cut[i]:cut[i + 1]])
            n = np.array([len(r) for r in rows], np.int64)
            ids = np.concatenate(rows) if rows else ids[:0]
        return ids, np.concatenate([[0], np.cumsum(n)]).astype(np.int64)


def with_end(ids: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Append the id ``end`` to every row."""
    n = np.diff(offsets)
    out = np.full(len(ids) + len(n), end, np.uint16)
    inside = np.ones(len(out), bool)
    ends = np.cumsum(n + 1)
    inside[ends - 1] = False
    out[inside] = ids
    return out, np.concatenate([[0], ends]).astype(np.int64)
