"""Nearest neighbours by inner product with learned partitions.

A bounded sample of the vectors is joined to a neighbour graph, which is halved again and again into
balanced parts with few edges between them.  A small network learns from each sample vector to
predict the parts of its neighbours.  Every vector is filed under its likeliest part; a query goes to
the likeliest parts until their probabilities add up to ``mass``, and all vectors there are ranked by
their inner product in double precision.

Equal vectors are filed once, with the smallest ids that any result can need, so groups of copies
take no more room than their results.  The work is dealt out in tiles of bounded numbers of vectors
and queries: neighbouring small parts share a tile, in which one task keeps a query's best of all its
parts there, and a part that holds most vectors is shared by many tiles.  A query is sent once to each
tile that holds any of its parts, and ranked against the vectors of its own parts only.

Vectors that are null, zero, hold null or non-finite components or do not have the commonest number
of components take no part, nor do rows without id.  Ties go to the smaller id; repeated rows count
once; a query never finds rows of its own id.  With fewer vectors than ``least`` there is one part,
and the search is exact.  Other columns are not looked at.
"""

from __future__ import annotations

from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import Model, cut
from .nets import TwoLayers


def neighbours(x: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` rows with the largest inner product with each row, itself left out."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), "i8")
    for i in range(0, len(x), 1024):
        scores = x[i : i + 1024] @ x.T
        scores[np.arange(len(scores)), np.arange(i, i + len(scores))] = -np.inf
        out[i : i + 1024] = np.argpartition(scores, -k, axis=1)[:, -k:]
    return out


def halved(x: np.ndarray, edges: np.ndarray, rounds: int = 30) -> np.ndarray:
    """A side for each row of ``x``: as many on either side, few ``edges`` (pairs of rows) across."""
    n = len(x)
    middle = x - x.mean(axis=0)
    way = np.linalg.eigh(middle.T @ middle)[1][:, -1]
    side = np.zeros(n, bool)
    side[np.argsort(middle @ way, kind="stable")[n // 2 :]] = True
    best, least = side.copy(), np.inf
    a, b = edges.T
    rng = np.random.default_rng(17)
    for _ in range(rounds):
        across = side[a] != side[b]
        if across.sum() < least:
            best, least = side.copy(), across.sum()
        # What moving a row to the other side saves, alone.
        signed = np.where(across, 1.0, -1.0)
        gain = np.bincount(a, signed, n) + np.bincount(b, signed, n)
        ups, downs = (np.flatnonzero(s)[np.argsort(-gain[s], kind="stable")] for s in (~side, side))
        m = min(len(ups), len(downs))
        good = np.flatnonzero(gain[ups[:m]] + gain[downs[:m]] > 0)
        # Neighbours that move together do not save what each saves alone: move some of them.
        good = good[rng.random(len(good)) < 0.5]
        if not len(good):
            break
        side[ups[good]], side[downs[good]] = True, False
    return best


def partitioned(x: np.ndarray, graph: np.ndarray, depth: int) -> np.ndarray:
    """One of 2^depth parts for each row, of equal sizes up to one."""
    part = np.zeros(len(x), "i8")
    edges = np.stack([np.repeat(np.arange(len(x)), graph.shape[1]), graph.ravel()], axis=1)
    for _ in range(depth):
        new = part * 2
        for p in np.unique(part):
            rows = np.flatnonzero(part == p)
            place = np.full(len(x), -1)
            place[rows] = np.arange(len(rows))
            own = place[edges]
            new[rows] += halved(x[rows], own[(own >= 0).all(axis=1)])
        part = new
    return part


class Router:
    """Likeliest parts of vectors."""

    def __init__(self, model: TwoLayers | None) -> None:
        self.net = model

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        if self.net is None:
            return np.ones((len(x), 1))
        out = self.net.logits(x.astype("f4")).astype("f8")
        out = np.exp(out - out.max(axis=1, keepdims=True))
        return out / out.sum(axis=1, keepdims=True)

    def parts(self, x: np.ndarray, mass: float) -> list[np.ndarray]:
        p = self.probabilities(x)
        order = np.argsort(-p, axis=1, kind="stable")
        enough = (np.cumsum(np.take_along_axis(p, order, axis=1), axis=1) < mass).sum(axis=1) + 1
        return [row[:n] for row, n in zip(order, enough.tolist(), strict=True)]


def fit(vectors: DataFrame, count: int, *, least: int, per_part: int, sample: int, depth: int) -> Router:
    """A router from at most ``sample`` of the ``count`` vectors (columns id, v)."""
    if count < least:
        return Router(None)
    depth = max(1, min(depth, round(log2(count / per_part))))
    limit = int((1 << 40) * min(1.0, sample / count))
    chosen = vectors.where(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 40)) < limit).limit(sample).toArrow()
    order = np.argsort(chosen.column("id").to_numpy())
    x = matrix(chosen.column("v").combine_chunks())[order]
    depth = min(depth, int(log2(max(2, len(x) // 32))))
    graph = neighbours(x, 20)
    part = partitioned(x, graph, depth)
    shares = np.zeros((len(x), 1 << depth), "f4")
    np.add.at(shares, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 1 / graph.shape[1])
    net = TwoLayers(x.astype("f4"), 64, 9, 1 << depth)
    net.fit(x.astype("f4"), shares, epochs=20, rate=3e-3, decay=1e-4)
    return Router(net)


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as rows of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype("f8")
    return flat.reshape(len(column), -1)


def _filed(vectors: DataFrame, router: Model) -> DataFrame:
    """The vectors with their likeliest part."""
    schema = T.StructType([*vectors.schema.fields, T.StructField("part", T.IntegerType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                part = router.get().probabilities(matrix(batch.column("v"))).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part, pa.int32())], schema=arrow)

    return vectors.mapInArrow(run, schema)


def _routed(queries: DataFrame, router: Model, mass: float) -> DataFrame:
    """The queries with their likeliest parts, as a list."""
    schema = T.StructType([*queries.schema.fields, T.StructField("parts", T.ArrayType(T.IntegerType()))])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                parts = [p.tolist() for p in router.get().parts(matrix(batch.column("v")), mass)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(parts, pa.list_(pa.int32()))], schema=arrow)

    return queries.mapInArrow(run, schema)


def tiles_of_parts(sizes: dict[int, int], block: int) -> dict[int, tuple[int, int]]:
    """For each part, its first tile and how many it has: parts in a row share one as long as it holds no
    more than ``block`` vectors, and a larger part has several of its own."""
    out, tile, used = {}, 0, 0
    for part in sorted(sizes):
        n = sizes[part]
        if used and used + n > block:
            tile, used = tile + 1, 0
        count = ceil(n / block) or 1
        out[part] = (tile, count)
        if count > 1:
            tile, used = tile + count, 0
        else:
            used += n
    return out


def _best(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """(query, id, score): each tile's ``k`` best vectors for each of its queries, of the query's parts."""
    schema = T.StructType.fromDDL("query long, id long, score double")
    arrow = to_arrow_schema(schema)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return arrow.empty_table()
        right = right.sort_by("id")
        names, ids = left.column("query").to_numpy(), right.column("id").to_numpy()
        q, x = (matrix(t.column("v").combine_chunks()) for t in (left, right))
        kinds, part = np.unique(right.column("part").to_numpy(), return_inverse=True)
        routes = left.column("parts").to_pylist()
        out, n = [], min(k, len(x))
        for i in range(0, len(q), 32):
            some = q[i : i + 32]
            own = np.array([np.isin(kinds, r) for r in routes[i : i + 32]])
            scores = np.where(own[:, part], some @ x.T, -np.inf)
            # All that may tie with the last one: sums in another order differ in the last places.
            last = np.partition(scores, -n, axis=1)[:, -n, None]
            last = np.where(np.isfinite(last), last - 1e-9 * np.maximum(1, np.abs(last)), -np.inf)
            row, near = np.nonzero((scores >= last) & (scores > -np.inf))
            exact = (some[row] * x[near]).sum(axis=1)
            order = np.lexsort((near, -exact, row))
            sizes = np.bincount(row, minlength=len(some))
            place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            order = order[place < n]
            out.append((names[i : i + 32][row[order]], ids[near[order]], exact[order]))
        return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], schema=arrow)

    tile = ["tile", "chunk"]
    return queries.groupBy(*tile).cogroup(vectors.groupBy(*tile)).applyInArrow(run, schema)


def search(
    vectors: DataFrame,
    is_query: Column,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 20,
    mass: float = 0.95,
    least: int = 450,
    per_part: int = 1600,
    sample: int = 8192,
    depth: int = 7,
    block: int = 32_768,
    chunk: int = 8192,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row for which ``is_query`` holds."""
    raw = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"), is_query.alias("asks"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    raw = raw.where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(~bad & F.exists("v", lambda x: x != 0))
    sizes = raw.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    raw = raw.where(F.size("v") == (sizes[0] if sizes else 0))
    # Of equal vectors only the k + 1 smallest ids can be in a result; the smallest stands for all.
    first = Window.partitionBy("v").orderBy("id")
    classes = (
        raw.select("id", "v").distinct().withColumn("i", F.row_number().over(first)).where(F.col("i") <= k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .select(F.col("ids")[0].alias("id"), "ids", "v")
    )
    classes = cut(classes)
    asking = cut(
        raw.where("asks").select(F.col("id").alias("query"), "v").distinct()
        .join(classes.select("id", "v"), "v").select("query", "id")
    )
    spark = vectors.sparkSession
    count = classes.count()
    router = fit(
        classes.select("id", "v"), count, least=least, per_part=per_part, sample=sample, depth=depth
    )
    router = Model(spark, router, lambda x: x)
    filed = cut(_filed(classes.select("id", "v"), router))
    asked = classes.join(asking.select("id").distinct(), "id", "left_semi").select(F.col("id").alias("query"), "v")
    asked = cut(_routed(asked, router, mass))
    # Which tiles a part has; there are no more parts than two to the power of depth.
    tiles = tiles_of_parts(dict(filed.groupBy("part").count().collect()), block)
    n_parts = 1 + max([0, *tiles])
    first, count = (F.array(*[F.lit(tiles.get(p, (0, 0))[i]) for p in range(n_parts)]) for i in (0, 1))
    chunks = max(1, ceil(asked.count() / chunk))
    place = F.pmod(F.xxhash64("id"), F.greatest(F.get(count, F.col("part")), F.lit(1))).cast("int")
    tiled = filed.withColumn("tile", F.get(first, F.col("part")) + place)
    tiled = tiled.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    of_part = F.transform(
        F.filter("parts", lambda p: F.coalesce(F.get(count, p), F.lit(0)) > 0),
        lambda p: F.sequence(F.get(first, p), F.get(first, p) + F.get(count, p) - 1),
    )
    asked = asked.withColumn("tile", F.explode(F.array_distinct(F.flatten(of_part))))
    asked = asked.withColumn("chunk", F.pmod(F.xxhash64("query"), F.lit(chunks)).cast("int"))
    best = _best(asked, tiled, k + 1)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    top = best.withColumn("i", F.row_number().over(order)).where(F.col("i") <= k + 1).drop("i")
    # From classes to their rows: the k + 1 best rows serve every query of a class.
    rows = top.join(classes.select("id", F.explode("ids").alias("vec_id")), "id").select("query", "vec_id", "score")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    rows = rows.withColumn("i", F.row_number().over(order)).where(F.col("i") <= k + 1)
    lists = rows.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("i", "vec_id", "score"))).alias("found"))
    answers = asking.join(lists, asking["id"] == lists["query"]).select(asking["query"].alias("query_id"), "found")
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return answers.select("query_id", F.posexplode(others).alias("i", "x")).select(
        "query_id",
        (F.col("i") + 1).cast("int").alias("rank"),
        F.col("x.vec_id").alias("vec_id"),
        F.col("x.score").alias("score"),
    )
