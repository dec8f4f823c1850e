"""Ids against the public tokenizer's own library."""

import os
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from paperloom.llm import bpe

FILE = os.path.join(bpe.TOKENIZERS, bpe.VOCABULARY)
if not os.path.exists(FILE):
    pytest.skip("no tokenizers here", allow_module_level=True)


@pytest.fixture(scope="module")
def peer():
    t = Tokenizer.from_file(FILE)
    t.encode_special_tokens = True
    return t


def samples():
    rng = random.Random(9)
    letters = "abcdefgh ZÉé'ts12 \t\n" + "".join(map(chr, (0xA0, 0x3000, 0x85, 0x1C, 0x6F22, 0x5B57, 0x1F642, 0x200D, 0x17F, 0x3A9, 0xBD, 0xB2, 0x301))) + ".,-_=<|>"
    out = ["".join(rng.choices(letters, k=rng.randrange(1, 80))) for _ in range(4_000)]
    return [*out, "<|endoftext|>", "a" * 9_000, " " * 5_000, "=" * 5_001, "aaaa" * 50, "don't we'll I'VE", "\n\n\n", "x"]


def test_ids_equal_the_library(peer):
    texts = samples()
    ids, counts = bpe.encoder(bpe.TOKENIZERS, bpe.VOCABULARY).encode(texts)
    ends = np.cumsum(counts)
    for text, e, a, b in zip(texts, peer.encode_batch(texts, add_special_tokens=False), ends - counts, ends, strict=True):
        assert e.ids == ids[a:b].tolist(), text[:50]


def test_memory_is_bounded(monkeypatch, peer):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    tool = bpe.Encoder(FILE)
    for text in samples()[:300]:
        ids, counts = tool.encode([text, None, ""])
        assert ids.tolist() == peer.encode(text, add_special_tokens=False).ids and counts.tolist()[1:] == [0, 0]


def test_frames(spark, peer):
    df = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "Hello wörld", 5), (3, "Hello wörld", 5)], "doc_id bigint, text string, ids int")
    got = sorted((r["doc_id"], r["ids"]) for r in bpe.encode_texts(df, ["doc_id"], "text").collect())
    hello = peer.encode("Hello wörld", add_special_tokens=False).ids
    assert got == [(1, []), (2, []), (3, hello), (3, hello)]
    assert bpe.encode_texts(df, ["doc_id"], "text").dtypes == [("doc_id", "bigint"), ("ids", "array<bigint>")]
    assert {r["doc_id"]: r["n_tokens"] for r in bpe.count_tokens(df, ["doc_id"], "text").collect()} == {1: 0, 2: 0, 3: len(hello)}
    assert bpe.encode_texts(df.where("false"), ["doc_id"], "text").count() == 0
