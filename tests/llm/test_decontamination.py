from __future__ import annotations

import random
import re

import numpy as np

from trialscope.llm import decontamination
from trialscope.llm.decontamination import grams, shape, winnowed

from .fixtures import documents, odd_rows, prose


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, items):
    wanted = {}
    for name, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            wanted.setdefault(tuple(w[i : i + n]), set()).add(name)
    out = {}
    for key, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in wanted}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in wanted:
                    hit |= set(range(i, i + n))
                    found |= wanted[tuple(w[i : i + n])]
        out[key] = (len(w), len(hit), sorted(map(str, found)))
    return out


def test_like_all_windows(spark):
    rng = random.Random(7)
    items = [(i, prose(rng, rng.choice((1, 2, 4, 7, 9, 10, 11, 30)))) for i in range(40)]
    items += [(100, None), (101, ""), (102, "?!"), (103, "a a a a a a a a a a a a a a"), (100, items[0][1])]
    docs = []
    for i in range(120):
        parts = [prose(rng, rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            w = (rng.choice(items)[1] or "").split()
            a = rng.randint(0, max(0, len(w) - 10))
            parts += [" ".join(w[a : a + rng.randint(5, 20)]).upper(), prose(rng, rng.randint(0, 20))]
        docs.append((i, ", ".join(parts)))
    docs += [(500, "a " * 40), (501, None), (502, "")]
    items_frame = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS key")
    got = decontamination.overlaps(documents(spark, docs), items_frame).collect()
    assert {r.key: (r.n_words, r.n_hit, r["items"]) for r in got} == brute(docs, items)
    assert all(sum(s.end - s.start for s in r.spans) == r.n_hit for r in got)


def test_odd_rows_and_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontamination.overlaps(documents(spark, odd_rows()), none).collect()
    assert len(got) == len(odd_rows()) and all(r.n_hit == 0 and r.spans == [] for r in got)
    some = spark.createDataFrame([(1, "same text here"), (None, "id that")], "item_id long, text string")
    got = {r.key: r for r in decontamination.overlaps(documents(spark, odd_rows()), some).collect()}
    assert got[6].n_hit == 3 and got[6]["items"] == ["1"]
    assert got[None].n_hit == 2 and got[None]["items"] == []
    assert decontamination.overlaps(documents(spark, []), some).count() == 0


def test_no_run_without_a_fingerprint():
    rng = np.random.default_rng(3)
    for length in range(1, 11):
        k, w = shape(length)
        assert k + w - 1 == length
        h = grams(rng.integers(5, size=200).astype("u8"), k)
        kept = set(winnowed(h, w).tolist())
        for i in range(len(h) - w + 1):
            least = h[i : i + w].min()
            assert {j for j in range(i, i + w) if h[j] == least} <= kept
