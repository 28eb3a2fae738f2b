from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from trialscope.llm import collocations

from .fixtures import odd_rows, word


def brute(rows, longest, least, cover, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in candidates.items():
            cuts = [
                (10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]])
                for k in range(1, len(p))
            ]
            score, _, left, right = min(cuts)
            inside = any(
                len(q) > len(p) and 100 * b >= cover * a and any(q[i : i + len(p)] == p for i in range(len(q)))
                for q, b in candidates.items()
            )
            if not inside:
                found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def corpus(seed: int):
    rng = random.Random(seed)
    words = [word(rng) for _ in range(12)] + ["Ünd", "文字", "a\x1cb", "\x00", "don't"]
    weights = [1 / (i + 1) for i in range(len(words))]

    def text():
        chosen = rng.choices(words, weights, k=rng.randint(0, 60))
        return "".join(w + rng.choice([" ", " ", " ", " ", "  ", "\t", ", ", ".\n", "! "]) for w in chosen)

    rows = [(rng.choice(["en", "en", "de", None]), text()) for _ in range(120)]
    return rows + [("en", "New York Stock Exchange " * 3)] * 9 + [(None, None), ("fr", ""), ("de", "  ...  ")]


@pytest.mark.parametrize(("longest", "least", "budget"), [(3, 3, 10**6), (3, 2, 40), (2, 3, 40), (4, 3, 15), (3, 1, 1)])
def test_like_brute_force(spark, monkeypatch, longest, least, budget):
    rows = corpus(1)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = collocations.collocations(df, longest=longest, least=least, budget=budget, top=50).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, longest, least, 50, 50)


def test_small_batches_and_odd_rows(spark, monkeypatch):
    rows = [(str(k or "")[:1], t) for k, t in odd_rows()] + corpus(2)
    rows = [(lang, t[:3000] if t else t) for lang, t in rows]
    df = spark.createDataFrame(rows, "lang string, text string").selectExpr(
        "*", "'x' AS a", "'x' AS phrase", "1 AS rank", "'x' AS h", "'x' AS n"
    )
    got = collocations.collocations(df, least=4, cover=80, top=None).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 3, 4, 80, None)


def test_counts_of_groups_of_any_size(spark):
    df = spark.createDataFrame(corpus(3), "lang string, text string").select(
        F.coalesce("lang", F.lit("und")).alias("lang"), "text"
    )
    words = collocations.cut(collocations.count_words(df))
    tables = [
        sorted(map(tuple, collocations.count_phrases(df, words, 3, 3, budget).collect()))
        for budget in (1, 7, 100, 10**6)
    ]
    assert tables[0] and all(t == tables[0] for t in tables)
    with pytest.raises(ValueError):
        collocations.count_phrases(df, words, 1)


def test_exact_scores_beyond_64_bits(spark):
    a, left, right = 9_876_543_210_123, 9_999_999_999_999, 9_876_543_210_987
    df = spark.createDataFrame([(a, left, right), (10, 10, 10), (1, 3, 7)], "a long, l long, r long")
    got = [r[0] for r in df.select(collocations._floor_score("a", "l", "r")).collect()]
    assert got == [10**6 * x * x // (y * z) for x, y, z in [(a, left, right), (10, 10, 10), (1, 3, 7)]]


def test_no_rows(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(empty).count() == 0
    assert collocations.collocations(spark.createDataFrame([("en", None)], "lang string, text string")).count() == 0
