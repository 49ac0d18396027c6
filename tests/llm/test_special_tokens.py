"""Strings of special tokens in texts: the library's own ids, as the queries
that write and pack tokens have them."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from verbum.llm import common as C, packing, rans, tokens

PLAIN = ["", None, "plain words", "a  b\n c", "<|endoftext", "< |endoftext|>", "<|ENDOFTEXT|>"]
TEXTS = PLAIN + ["<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|>b", "x\n<|startoftext|>  y\n\n<|endoftext|>z", " <|endoftext|><|endoftext|> "]


def library(name, texts):
    from tokenizers import Tokenizer
    return [e.ids for e in Tokenizer.from_file(C.vocabulary_file(name)).encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("name", [tokens.WORDS, tokens.BYTES])
def test_ids_are_the_library_default(name):
    rng = np.random.default_rng(2)
    parts = ["a", " ", "\n", "<|endoftext|>", "<|", "|>", "B1", "é"]
    texts = TEXTS + ["".join(rng.choice(parts, rng.integers(0, 10))) for _ in range(400)]
    enc = rans.worker_encoder(name)
    for _ in range(2):
        ids, offsets = enc.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == library(name, texts)
    rans.worker_encoder.cache_clear()


def test_token_file_and_packing(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    want = [np.array([*x, 1], "<u4") for x in library(tokens.WORDS, TEXTS)]
    got = rans.read_token_file(spark, rans.write_token_file(spark, docs)).toPandas().sort_values("doc_id")
    assert got.n_tokens.tolist() == [len(x) for x in want]
    assert [zlib.crc32(x) for x in got.ids] == [zlib.crc32(x.tobytes()) for x in want]
    want = [np.array([*x, 0], "<u4") for x in library(tokens.BYTES, TEXTS)]
    got = packing.pack(spark, docs).toPandas().sort_values("doc_id")
    assert got.length.tolist() == [len(x) for x in want]
    assert got.ids_crc32.tolist() == [zlib.crc32(x.tobytes()) for x in want]
