from __future__ import annotations

import random

import numpy as np
import pytest

from trialscope.llm import near_duplicates
from trialscope.llm.components import components
from trialscope.llm.near_duplicates import least_matches, shingles

from .fixtures import documents, odd_rows, prose, word


def brute(rows: list[tuple]) -> dict[int, tuple[int, int]]:
    """id -> (set size, component) by comparing all pairs of sets of word tuples."""
    sets, parent = {}, {}
    for key, text in rows:
        words = (text or "").encode().lower().split()
        n = min(5, len(words))
        sets[key] = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()
        parent[key] = key

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {k: (len(sets[k]), root(k)) for k in keys}


@pytest.mark.parametrize("crowd", [64, 1])
def test_like_all_pairs(spark, crowd, monkeypatch):
    # With a small crowd and small blocks most buckets are compared block by block.
    monkeypatch.setattr(near_duplicates, "BLOCK", 4 if crowd == 1 else 256)
    rng = random.Random(4)
    rows, key = [], 0
    for _ in range(12):
        base = prose(rng, 120).split()
        # The base comes last: its copies may be alike through it alone.
        for _ in range(rng.randint(1, 25)):
            copy = list(base)
            for _ in range(rng.choice((0, 1, 2, 3, 4))):
                copy[rng.randrange(len(copy))] = word(rng)
            rows.append((key := key + 1, " ".join(copy)))
        rows.append((key := key + 1, " ".join(base)))
    rows += [(key + 1, None), (key + 2, ""), (key + 3, "a b"), (key + 4, "A b"), (key + 5, "a b c")]
    found = near_duplicates.near_duplicates(documents(spark, rows), crowd=crowd)
    got = {r.doc_id: r for r in found.collect()}
    want = brute(rows)
    assert {k: (r.n_shingles, r.component_id) for k, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_many_copies_linked_through_one(spark):
    rng = random.Random(5)
    base = prose(rng, 200).split()
    rows = [(1000, " ".join(base))]
    for i in range(80):
        copy = list(base)
        for at in range(i % 40, 200, 40):
            copy[at] = f"new{i}at{at}"
        rows.append((i, " ".join(copy)))
    got = near_duplicates.near_duplicates(documents(spark, rows), crowd=8).collect()
    want = brute(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_odd_rows(spark):
    got = near_duplicates.near_duplicates(documents(spark, odd_rows())).collect()
    assert len(got) == len(odd_rows())
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].n_shingles == by_id[2].n_shingles == by_id[3].n_shingles == 0
    assert by_id[None].component_id is None and by_id[None].kept
    assert by_id[6].component_id == 6 and by_id[8].n_shingles == 1
    assert near_duplicates.near_duplicates(documents(spark, [])).count() == 0


def test_pruning_is_the_posterior():
    # Beta(m + 1, n - m + 1) by counting: the tail at the bound reaches the chance, below it does not.
    rng = np.random.default_rng(1)
    (n, least), *_ = least_matches(40, 40, 0.75, 0.01)
    draws = [(rng.beta(m + 1, n - m + 1, 400_000) >= 0.75).mean() for m in (least, least - 1)]
    assert draws[0] >= 0.009 and draws[1] < 0.011


def test_shingles_of_few_words():
    assert len(shingles("a b c")) == 1 and len(shingles(" ")) == 0 and len(shingles(None)) == 0
    assert len(shingles("a b c d e f a b c d e")) == 6


@pytest.mark.parametrize("shape", ["chain", "star", "mixed", "none"])
def test_components(spark, shape):
    rng = random.Random(6)
    edges = {
        "chain": [(i, i + 1) for i in range(60)],
        "star": [(500, i) for i in range(60)],
        "mixed": [(rng.randrange(200), rng.randrange(200)) for _ in range(120)],
        "none": [],
    }[shape]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    loops = {x for x in parent if all(a == b for a, b in edges if x in (a, b))}
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent if x not in loops}
