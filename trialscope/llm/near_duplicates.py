"""MinHash near-duplicates with sequential Bayesian verification.

A text is lower-cased (A-Z only) and cut at ``[\\x20\\x09-\\x0D]``; its set holds the distinct runs of
``size`` words (all words as one run if there are fewer; nothing without words).  Documents with
equal sets form a class, of which the smallest id goes on.  Signatures are banded; classes that
share a band are candidates.  A candidate pair's signatures are compared in batches: after each one
the pair is dropped if, with a uniform prior, the posterior probability that its similarity reaches
the threshold is below ``miss``.  Survivors are confirmed on their full sets.

Pairs are not enumerated within a band's bucket.  All its members are first compared with one of
them, the one that meets the most others in all bands; the links found give components, and buckets
whose members are already connected are done.  In the others a member outside the first leader's
component is compared with all members of other components; what still lies in several components
then is compared across components only: as pairs in buckets of at most ``crowd`` members, and in
larger ones block by block in memory, where nothing but links is emitted.  Every candidate pair is
thus compared, or its ends are already connected, so the components are those of all candidate pairs.

Pairs of the threshold's similarity share no band with probability (1 - t^rows)^bands: 2e-5 by
default, and less the more similar they are.  Sets hold 64-bit hashes of runs.

Null texts and texts without words have no set and are linked to nothing.  Rows that repeat an id
count as one document; if their texts differ, one of them stands for it.  Rows with a null id are
linked to nothing, have no component and are kept.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import compact, forget, slices, texts_of
from .components import components

_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Members of a large bucket, and bytes of their texts, that are compared with as many others in one task.
BLOCK, BLOCK_BYTES = 1024, 4 << 20


def shingles(text: str | None, size: int = 5) -> np.ndarray:
    """The sorted distinct hashes of a text's runs of words."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, "u8")
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), "u8", len(words))
    run = min(size, len(words))
    n = len(h) - run + 1
    out = h[:n].copy()
    for i in range(1, run):
        out = out * _STEP + h[i : n + i]
    out += np.uint64(run)
    out = (out ^ (out >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(out ^ (out >> np.uint64(29)))


class Signer:
    """Signatures of ``bands`` * ``rows`` minima of random linear functions, 16 bits of each."""

    def __init__(self, bands: int, rows: int, seed: int = 1) -> None:
        rng = np.random.default_rng(seed)
        self.factors = rng.integers(1 << 32, size=bands * rows, dtype="u4") | np.uint32(1)
        self.terms = rng.integers(1 << 32, size=bands * rows, dtype="u4")

    def sign(self, hashes: np.ndarray) -> bytes:
        x = (hashes >> np.uint64(32)).astype("u4")
        least = np.full(len(self.factors), 0xFFFFFFFF, "u4")
        for i in range(0, len(x), 512):
            y = x[i : i + 512, None] * self.factors + self.terms
            np.minimum(least, y.min(axis=0), out=least)
        return ((least * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype("<u2").tobytes()


def least_matches(total: int, batch: int, threshold: float, miss: float) -> list[tuple[int, int]]:
    """For each batch end n: the fewest matches m with P(similarity >= threshold | m of n) >= miss.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1), whose upper tail is the
    probability that n + 1 draws of the threshold's chance give at most m successes.
    """
    out = []
    for n in range(batch, total + 1, batch):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append((n, m))
    return out


def _signed(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """(id, digest, n_shingles, class, signature) of each document; class is null for empty sets."""
    kind = docs.schema["id"].dataType
    schema = T.StructType.fromDDL("digest long, n_shingles long, class binary, signature binary")
    schema = T.StructType([T.StructField("id", kind), *schema.fields])
    arrow = to_arrow_schema(schema)
    signer = Signer(bands, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [shingles(t, size) for t in texts_of(part, "text")]
                columns = [
                    part.column("id"),
                    part.column("digest"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([signer.sign(s) if len(s) else None for s in sets], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return docs.mapInArrow(run, schema)


def signatures(column: pa.Array) -> np.ndarray:
    """A binary column of signatures as rows of numbers."""
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(len(column), -1)


def likely(
    x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray, steps: list[tuple[int, int]]
) -> tuple[np.ndarray, np.ndarray]:
    """Those pairs of rows x[i], y[j] that no batch of their signatures rules out."""
    matches, done = np.zeros(len(i), "i8"), 0
    for n, least in steps:
        matches += (x[i, done:n] == y[j, done:n]).sum(axis=1)
        alive = matches >= least
        i, j, matches, done = i[alive], j[alive], matches[alive], n
    return i, j


def alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _verified(
    pairs: DataFrame, classes: DataFrame, size: int, threshold: float, steps: list[tuple[int, int]]
) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets reach the threshold."""
    rows = pairs.join(classes.select(F.col("id").alias("b"), F.struct("signature", "text").alias("y")), "b").join(
        classes.select(F.col("id").alias("a"), F.struct("signature", "text").alias("x")), "a"
    )
    rows = rows.select(
        "a",
        "b",
        F.col("x.signature").alias("x"),
        F.col("y.signature").alias("y"),
        F.col("x.text").alias("text_x"),
        F.col("y.text").alias("text_y"),
    )
    schema = T.StructType([rows.schema["a"], rows.schema["b"]])
    arrow = to_arrow_schema(schema)
    percent = round(100 * threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        last, set_x = None, np.zeros(0, "u8")
        for whole in batches:
            for part in slices(whole, "text_y"):
                x, y = (signatures(part.column(c)) for c in "xy")
                each = np.arange(part.num_rows)
                part = part.take(pa.array(likely(x, y, each, each, steps)[0]))
                left, keep = part.column("a").to_pylist(), []
                for i, a in enumerate(left):
                    if a != last:
                        last, set_x = a, shingles(part.column("text_x")[i].as_py(), size)
                    if alike(set_x, shingles(part.column("text_y")[i].as_py(), size), percent):
                        keep.append(i)
                part = part.take(pa.array(keep, pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], schema=arrow)

    return rows.mapInArrow(run, schema)


def _labelled(members: DataFrame, roots: DataFrame) -> DataFrame:
    return members.join(roots.select(F.col("node").alias("id"), "root"), "id", "left").withColumn(
        "root", F.coalesce("root", "id")
    )


def _led(open_rows: DataFrame) -> DataFrame:
    """Pairs (a, b): in each bucket the member with the greatest mass, and all of other components."""
    best = open_rows.groupBy("bucket").agg(F.max_by(F.struct("id", "root"), F.struct("mass", F.negative("id"))).alias("m"))
    return (
        open_rows.join(best, "bucket")
        .where(F.col("root") != F.col("m.root"))
        .select(F.col("m.id").alias("a"), F.col("id").alias("b"))
        .distinct()
    )


def _crowded(
    rows: DataFrame, classes: DataFrame, size: int, threshold: float, steps: list[tuple[int, int]], band_rows: int
) -> DataFrame:
    """Links (a, b) across components within large buckets: rows of (band, bucket, n, id, root).

    A bucket is cut into blocks of about ``BLOCK`` members and ``BLOCK_BYTES`` of texts, and each pair of blocks is compared in a
    task's memory, so pairs are not emitted but links are.  A pair that shares several bands is
    compared in the first of them.
    """
    sized = rows.join(classes.select("id", F.octet_length("text").alias("bytes")), "id")
    total = F.sum("bytes").over(Window.partitionBy("bucket"))
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK, total / BLOCK_BYTES)).cast("int")
    dealt = sized.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    tiles = dealt.select(
        "band", "bucket", "block", "id", "root", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).select("*", F.least("block", "other").alias("tile_a"), F.greatest("block", "other").alias("tile_b"))
    tiles = tiles.join(classes, "id")
    kind = rows.schema["id"].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])
    arrow = to_arrow_schema(schema)
    percent = round(100 * threshold)

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, roots = table.column("id").to_pylist(), table.column("root").to_pylist()
        if len(set(roots)) < 2:
            return arrow.empty_table()
        band, block = table.column("band")[0].as_py(), table.column("block").to_numpy()
        sign = signatures(table.column("signature"))
        group = {r: r for r in roots}

        def top(r):
            while group[r] != r:
                group[r] = r = group[group[r]]
            return r

        number = {r: k for k, r in enumerate(group)}
        root = np.array([number[r] for r in roots])
        # Which earlier bands hash alike: those pairs are compared there.
        earlier = sign[:, : band * band_rows].reshape(len(ids), band, band_rows)
        sets: dict[int, np.ndarray] = {}

        def of(k: int) -> np.ndarray:
            if k not in sets:
                sets[k] = shingles(table.column("text")[k].as_py(), size)
            return sets[k]

        one = table.column("tile_a")[0].as_py()
        within = one == table.column("tile_b")[0].as_py()
        links: list[tuple[int, int]] = []
        rest = np.arange(len(ids)) if within else np.flatnonzero(block != one)
        for k in range(len(ids)) if within else np.flatnonzero(block == one).tolist():
            j = rest[rest > k] if within else rest
            j = j[root[j] != root[k]]
            j = likely(sign, sign, np.full(len(j), k), j, steps)[1]
            if band:
                j = j[~(earlier[j] == earlier[k]).all(axis=2).any(axis=1)]
            for other in j.tolist():
                x, y = top(roots[k]), top(roots[other])
                if x != y and alike(of(k), of(other), percent):
                    group[y] = x
                    links.append((k, other))
        a, b = (table.column("id").take(pa.array([x[i] for x in links], pa.int64())) for i in (0, 1))
        return pa.Table.from_arrays([a, b], schema=arrow)

    return tiles.groupBy("bucket", "tile_a", "tile_b").applyInArrow(run, schema)


def near_duplicates(
    documents: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    size: int = 5,
    threshold: float = 0.75,
    bands: int = 40,
    rows: int = 5,
    batch: int = 40,
    miss: float = 1e-6,
    crowd: int = 64,
) -> DataFrame:
    """(key, n_shingles, component_id, kept) for each row; ``kept`` marks the smallest id of each."""
    docs = documents.select(F.col(key).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("digest"))
    signed = compact(_signed(docs, size, bands, rows), 20_000)
    some = signed.where("class is not null and id is not null")
    stands = some.groupBy("id").agg(F.min(F.struct("class", "digest")).alias("s")).select("id", "s.*")
    firsts = stands.groupBy("class").agg(F.min(F.struct("id", "digest")).alias("s")).select("class", "s.*")
    one = ["id", "digest"]
    classes = some.join(firsts.select(one), one).dropDuplicates(one).select(*one, "signature")
    banded = classes.select(
        "id",
        F.posexplode(
            F.array(*[
                F.xxhash64(F.lit(i), F.substring("signature", 2 * rows * i + 1, 2 * rows)) for i in range(bands)
            ])
        ).alias("band", "bucket"),
    )
    shared = compact(
        banded.withColumn("n", F.count("*").over(Window.partitionBy("bucket"))).where("n > 1")
    )
    mass = shared.groupBy("id").agg(F.sum("n").alias("mass"))
    members = compact(shared.select("band", "bucket", "id").join(mass, "id"))
    wanted = members.select("id").distinct().join(firsts.select(one), "id")
    texts = docs.join(wanted, one, "left_semi").dropDuplicates(one)
    full = compact(some.join(wanted, one, "left_semi").dropDuplicates(one).join(texts, one).select("id", "signature", "text"), 10_000)

    steps = least_matches(bands * rows, batch, threshold, miss)

    links, open_rows = None, members.withColumn("root", F.col("id"))
    for step in range(3):
        if step < 2:
            found = _verified(_led(open_rows), full, size, threshold, steps)
        else:
            sized = open_rows.withColumn("n", F.count("*").over(Window.partitionBy("bucket")))
            small, large = sized.where(F.col("n") <= crowd), sized.where(F.col("n") > crowd)
            x, y = (small.select("bucket", F.col("id").alias(c), F.col("root").alias(f"root_{c}")) for c in "ab")
            pairs = x.join(y, "bucket").where("a < b and root_a <> root_b").select("a", "b").distinct()
            found = _verified(pairs, full, size, threshold, steps)
            found = found.union(_crowded(large, full, size, threshold, steps, rows))
        links = compact(found if links is None else links.union(found))
        roots = components(links)
        if step < 2:
            labelled = _labelled(members, roots)
            several = labelled.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y"))
            open_rows = compact(labelled.join(several.where("x <> y").select("bucket"), "bucket"))
            if open_rows.isEmpty():
                break

    # Rows that repeat an id go where the one that stands for it goes.
    rooted = (
        stands.select(F.col("id").alias("member"), "class")
        .join(firsts.select("class", "id"), "class")
        .join(roots.select(F.col("node").alias("id"), "root"), "id", "left")
        .select(F.col("member").alias("id"), F.coalesce("root", "id").alias("root"))
    )
    out = signed.select("id", "n_shingles").join(rooted, "id", "left")
    root = F.coalesce("root", "id")
    return out.select(
        F.col("id").alias(key),
        "n_shingles",
        root.alias("component_id"),
        F.coalesce(F.col("id") == root, F.lit(True)).alias("kept"),
    )


#: The same links and components as SQL over documents.
EXPECTED = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS g
  FROM w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
  FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (
  SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * k >= 75 * (x.n + y.n - k)),
both_ways AS MATERIALIZED (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, t.b FROM reach r JOIN both_ways t ON r.b = t.a),
root AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM root LEFT JOIN n USING (doc_id)
"""
