from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from trialscope.llm import lm_scoring
from trialscope.llm.common import held_out

from .fixtures import documents, odd_rows, prose


def out_of_fit(key) -> bool:
    return key is not None and zlib.crc32(str(key).encode()) % 5 == 1


def brute(rows):
    """(n_tokens, n_known, N, base, score) per row, with a trie of dictionaries."""
    trie, counts = defaultdict(Counter), Counter()
    for key, text in rows:
        if out_of_fit(key):
            continue
        counts.update((text or "").encode().lower().split() + [None])
        data = b"\xff" * 3 + (text or "").encode() + b"\xff"
        for i in range(3, len(data)):
            for k in range(4):
                trie[data[i - k : i]][data[i]] += 1
    total, kinds = sum(counts.values()), len(counts)
    whole = total + 0.5 * (kinds + 1)
    out = []
    for key, text in rows:
        tokens = (text or "").encode().lower().split() + [None]
        base = math.fsum(math.log10((counts[t] + 0.5) / whole) for t in tokens)
        data, score = b"\xff" * 3 + (text or "").encode() + b"\xff", 0.0
        for i in range(3, len(data)):
            gone: set[int] = set()
            for k in range(3, -1, -1):
                left = {b: n for b, n in trie.get(data[i - k : i], {}).items() if b not in gone}
                if not left:
                    continue
                size = sum(left.values()) + len(left)
                if data[i] in left:
                    score += math.log10(left[data[i]] / size)
                    break
                score += math.log10(len(left) / size)
                gone |= left.keys()
            else:
                score -= math.log10(256 - len(gone))
        out.append((key, len(tokens), sum(counts[t] > 0 for t in tokens), total, base, score))
    return out


def rows_of(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.randint(0, 60)).title() + rng.choice(["", "é", "文", "\0", "!?"])) for i in range(60)]
    return rows + [(i + 100 if i else i, t and t[:4000]) for i, t in odd_rows()]


@pytest.mark.parametrize(("frequent", "rows"), [(250_000, 100_000), (5, 100_000), (20, 40), (0, 1)])
def test_like_dictionaries(spark, frequent, rows):
    data = rows_of(10)
    docs = documents(spark, data)
    got = lm_scoring.score(docs, held_out("doc_id", 5, 1), frequent=frequent, rows=rows).collect()
    want = brute(data)
    assert len(got) == len(want)

    def order(row):
        return (row[0] or -1, row[1], row[-1])

    given = [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got]
    for a, b in zip(sorted(given, key=order), sorted(want, key=order), strict=True):
        assert a[:4] == b[:4]
        assert a[4] == pytest.approx(b[4], rel=1e-9) and a[5] == pytest.approx(b[5], rel=1e-5)
    assert all(r.held_out == out_of_fit(r.doc_id) for r in got)


def test_nothing_to_learn_from(spark):
    assert lm_scoring.score(documents(spark, []), F.lit(False)).count() == 0
    rows = lm_scoring.score(documents(spark, [(1, "ab c"), (2, None)]), F.lit(True)).collect()
    assert {(r.doc_id, r.n_tokens, r.n_known, r.train_tokens) for r in rows} == {(1, 3, 0, 0), (2, 1, 0, 0)}
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].score == pytest.approx(-5 * math.log10(256), rel=1e-6)
    assert by_id[1].base_score == pytest.approx(0)


def test_adaptive_code_is_a_probability():
    # All texts of two letters and their continuations share what one byte has.
    first = [10 ** lm_scoring.adaptive(None)]
    assert first[0] == pytest.approx(1 / 256)
    assert lm_scoring.adaptive("abab" * 50) > lm_scoring.adaptive("".join(random.Random(1).choices("abcdefgh", k=200)))
