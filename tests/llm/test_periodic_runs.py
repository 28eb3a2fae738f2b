from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trialscope.llm import periodic_runs, queries

from .fixtures import documents, odd_rows, prose


def brute(words):
    """Runs by comparing all words that are some period apart."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(6, 4 * q):
                found.setdefault((start, i + q), q)
    return sorted((a, b - a, q) for (a, b), q in found.items())


def left_over(words, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


@settings(max_examples=400, deadline=None)
@given(
    st.lists(st.integers(0, 3), max_size=40),
    st.integers(1, 9),
    st.integers(1, 6),
    st.lists(st.integers(0, 3), max_size=20),
)
def test_runs_of_repeated_stretches(stretch, period, times, rest):
    words = [str(x).encode() for x in stretch + stretch[-period:] * times + rest]
    found = periodic_runs.find(words)
    assert found == brute(words)
    assert periodic_runs.collapsed(words, found) == left_over(words, found)


def test_nested_overlapping_and_neighbouring_runs():
    a, b, c = b"a", b"b", b"c"
    for words in (
        ([a] * 6 + [b]) * 5,
        [a] * 6 + [b] * 7 + [a, b] * 5 + [c, a, b] * 4 + [c],
        ([a, b] * 4 + [c]) * 4 + [a, b, a],
        [a] * 5,
        [a, b] * 3 + [a],
        [b"%d" % (i % 97) for i in range(97 * 4)],
        [b"%d" % (i % 97) for i in range(97 * 4 - 1)],
    ):
        assert periodic_runs.find(words) == brute(words)


def test_the_grammar_derives_the_text():
    rng = random.Random(4)
    ids = [rng.randrange(6) for _ in range(400)] * 3
    g = periodic_runs.Grammar(ids, 6, periodic_runs.Counter(zip(ids, ids[1:])))

    def derived(x):
        return [x] if x < 6 else derived(g.halves[x - 6][0]) + derived(g.halves[x - 6][1])

    assert sum((derived(x) for _, x in g.top), []) == ids
    assert all(derived(6 + i) == ids[at : at + n] for i, (at, n) in enumerate(zip(g.place, g.size)))
    pairs = list(zip([x for _, x in g.top], [x for _, x in g.top][1:]))
    assert max(pairs.count(p) for p in pairs if p[0] != p[1]) == 1


def test_odd_rows(spark):
    rng = random.Random(9)
    rows = odd_rows() + [(20, "spam " * 5_000), (21, (prose(rng, 300) + " ") * 6), (22, "a\x0bb\x0cc \x1c d")]
    found = periodic_runs.find_runs(documents(spark, rows), keep=["doc_id", "score"])
    assert found.columns == ["doc_id", "score", "runs", "collapsed"]
    got = sorted(((r.doc_id or -1, [tuple(x) for x in r.runs], r.collapsed) for r in found.collect()), key=str)
    want = []
    for key, text in rows:
        words = (text or "").encode().split()
        runs = brute(words) if key in (20, 21) or len(words) < 100 else []
        want.append((key or -1, runs, left_over(words, runs).decode()))
    assert got == sorted(want, key=str)
    # Kept columns named like an output are replaced; the text is left out.
    clash = documents(spark, rows).withColumn("runs", F.lit("x")).drop("text").withColumn("text", F.lit("b b"))
    assert periodic_runs.find_runs(clash).where("collapsed = 'b b' AND size(runs) = 0").count() == len(rows)


def test_query_like_brute_force(spark):
    path = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries.op13_periodic_runs(spark, path).collect()}
    texts = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(texts)
    some = 0
    for key, text in texts:
        words, h = (text or "").encode().split(), zlib.crc32(str(key).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        runs, r = brute(words), got[key]
        some += bool(runs)
        lines = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
        assert r.n_runs == len(runs) and r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(left_over(words, runs)).hexdigest()
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r.start, r.length, r.period) == best
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
    assert some > 5


@pytest.mark.parametrize("n", [1, 20_000])
def test_long_texts_of_one_word(n):
    assert periodic_runs.find([b"x"] * n) == ([(0, n, 1)] if n > 5 else [])
