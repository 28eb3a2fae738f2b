from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers as public
import pytest
import tiktoken

from trialscope.llm import byte_bpe
from trialscope.llm.common import shipped
from trialscope.llm.mph import MinimalPerfectHash

from .fixtures import documents, odd_rows

VOCABULARY = public.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = byte_bpe.read_ranks(shipped(VOCABULARY))
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_minimal_and_exact():
    words = [f"w{i}".encode() for i in range(5000)]
    table = MinimalPerfectHash(words)
    found = table.find(words)
    assert sorted(found.tolist()) == list(range(5000))
    assert all(table.keys[i] == w for i, w in zip(found, words, strict=True))
    assert (table.find([f"v{i}".encode() for i in range(5000)]) == -1).all()
    assert MinimalPerfectHash([]).find([b"a"]).tolist() == [-1]
    with pytest.raises(ValueError):
        MinimalPerfectHash([b"a", b"a"])


def test_random_texts_like_the_library(reference):
    rng = random.Random(1)
    letters = list("abcdeéßñ文漢 \n\t'.!1²½_\x1c\xa0　\0") + ["  ", " the", "ing", "\r\n", "'ll", "\U0001f600"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(4000)]
    tokenizer = byte_bpe.ByteBpe((shipped(VOCABULARY), public.PATTERN), memory=50)
    for i in range(0, len(texts), 500):
        coded = tokenizer.encode(texts[i : i + 500])
        for text, ids in zip(texts[i : i + 500], coded, strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text), repr(text)
            assert tokenizer.decode(ids) == text.encode()


def test_long_words_use_the_same_merges(reference):
    tokenizer = byte_bpe.ByteBpe((shipped(VOCABULARY), public.PATTERN))
    for text in ("a" * 9000, "abc" * 5000, "é" * 3000):
        assert np.frombuffer(tokenizer.encode([text])[0], "<u4").tolist() == reference.encode_ordinary(text)


def test_frames(spark, reference):
    docs = documents(spark, odd_rows())
    out = byte_bpe.decode(byte_bpe.encode(docs, VOCABULARY, public.PATTERN), VOCABULARY, public.PATTERN)
    assert set(out.columns) == set(docs.columns)
    rows = out.collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        text = r.text or ""
        assert np.frombuffer(r.ids, "<u4").tolist() == reference.encode_ordinary(text)
        assert r.n_tokens == len(r.ids) // 4
        assert hashlib.sha256(r.decoded).digest() == hashlib.sha256(text.encode()).digest()
        assert r.score == "x"


def test_empty_frame(spark):
    docs = documents(spark, [])
    assert byte_bpe.decode(byte_bpe.encode(docs, VOCABULARY, public.PATTERN), VOCABULARY, public.PATTERN).count() == 0
