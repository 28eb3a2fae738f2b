from __future__ import annotations

import random

import numpy as np
import public_tokenizers as public
import pytest
from tokenizers import Tokenizer

from trialscope.llm import token_counts
from trialscope.llm.common import shipped

from .fixtures import documents, odd_rows

MODEL = public.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def counted():
    library = Tokenizer.from_file(MODEL)
    return lambda texts: [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(shipped(MODEL))


def test_random_texts_like_the_library(counter, counted):
    rng = random.Random(2)
    letters = list("abstmdrvle'' \n!.1é中ΣİǅAB$<|>½Ⅷ́\x1c\x85") + ["<|endoftext|>", "'re", "'ll", " it's", "ing"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    assert counter.count(texts).tolist() == counted(texts)


def test_every_class_of_character(counter, counted):
    texts = [f"a{chr(x)}b1{chr(x)}{chr(x)} 'r{chr(x)}e'{chr(x)}s" for x in (*range(0x3000), *range(0xF900, 0xFFFE), 0x1F600)]
    assert counter.count(texts).tolist() == counted(texts)


def test_scan_equals_one_state_after_the_other():
    rng = np.random.default_rng(1)
    table = token_counts.transitions()
    for n in (1, 127, 128, 129, 5000):
        kinds = rng.integers(10, size=n).astype("u1")
        state, want = token_counts.GAP, []
        for k in kinds:
            state = table[k, state]
            want.append(state)
        assert token_counts.states(kinds, table).tolist() == want


def test_tables_are_emptied_when_full(counted):
    small = token_counts.Counter(shipped(MODEL))
    small.words.most = 20
    texts = [f"word{i} another{i}" for i in range(300)]
    got = [small.count([t])[0] for t in texts]
    assert got == counted(texts)


def test_long_texts_in_pieces(counter, counted):
    text = "it's a long text " * 200_000 + "x" * 30_000
    assert counter.count([text, None, ""]).tolist() == [*counted([text]), 0, 0]


def test_frames(spark, counted):
    docs = documents(spark, odd_rows())
    rows = token_counts.count_tokens(docs, MODEL).collect()
    assert len(rows) == len(odd_rows())
    assert [r.n_tokens for r in rows] == counted([r.text or "" for r in rows])
    assert token_counts.count_tokens(documents(spark, []), MODEL).count() == 0
