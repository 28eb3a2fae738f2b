from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from trialscope.llm import ann

SCHEMA = "vec_id long, embedding array<float>"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS v", "3 AS part", "4 AS query").repartition(3)


def brute(rows, k=20):
    good = {}
    for key, v in rows:
        ok = key is not None and v is not None and all(c is not None and np.isfinite(c) for c in v) and any(v)
        if ok:
            good.setdefault(key, np.array(v, "f4").astype("f8"))
    keys = sorted(good)
    out = {}
    for q in keys:
        if q % 20 == 0:
            near = sorted(((-(good[q] * good[x]).sum(), x) for x in keys if x != q))[:k]
            for i, (s, x) in enumerate(near, 1):
                out[q, i] = (x, -s)
    return out


def found(df):
    return {(r.query_id, r.rank): (r.vec_id, r.score) for r in df.collect()}


def assert_same(got, want):
    assert got.keys() == want.keys()
    for k, (x, s) in got.items():
        assert x == want[k][0] and s == pytest.approx(want[k][1], rel=1e-12)


def test_exact_with_one_part(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-3, 4, 6).astype("f4").tolist()) for i in range(300)]
    same = rng.normal(size=6).astype("f4").tolist()
    rows += [(i, same) for i in range(300, 420)]
    rows += [(500, None), (520, [0.0] * 6), (540, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (560, [float("nan")] * 6)]
    rows += [(580, [float("inf")] + [0.0] * 5), (600, []), (None, [1.0] * 6), (20, rows[20][1])]
    assert_same(found(ann.search(frame(spark, rows), F.col("vec_id") % 20 == 0)), brute(rows))


def test_tiles_do_not_matter(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).astype("f4").tolist()) for i in range(400)]
    got = ann.search(frame(spark, rows), F.col("vec_id") % 20 == 0, block=50, chunk=5)
    assert_same(found(got), brute(rows))


def test_few_and_no_vectors(spark):
    asks = F.col("vec_id") % 20 == 0
    assert ann.search(frame(spark, []), asks).count() == 0
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [1.0, 2.0, 3.0])]
    assert found(ann.search(frame(spark, rows), asks)) == {(0, 1): (1, 0.5)}


def test_recall_with_learned_parts(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16))
    x = centres[rng.integers(40, size=5000)] + 0.4 * rng.normal(size=(5000, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(x.astype("f4"))]
    got = found(ann.search(frame(spark, rows), F.col("vec_id") % 20 == 0, per_part=300))
    want = brute(rows)
    assert got.keys() == want.keys()
    sets = {}
    for table, side in ((got, 0), (want, 1)):
        for (q, _), (v, _) in table.items():
            sets.setdefault(q, (set(), set()))[side].add(v)
    assert np.mean([len(a & b) / len(b) for a, b in sets.values()]) >= 0.9


def test_parts_are_balanced_and_near():
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(200, 8)) + 3 * c for c in np.eye(8)[:4]])
    graph = ann.neighbours(x, 10)
    part = ann.partitioned(x, graph, 2)
    assert np.bincount(part).tolist() == [200] * 4
    assert (part[:, None] == part[graph]).mean() > 0.6
