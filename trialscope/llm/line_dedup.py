"""Removal of passages that earlier documents hold too, by pairwise alignment.

A text's lines are compared without surrounding white space; blank lines match nothing and do not
interrupt a block.  Overlapping documents are found through the hashes of lines they share: each
document is paired with the first document that holds the line and, for rare lines (in at most
``rare`` documents), with the nearest earlier one too.  It is also paired with the first holder of
each of its shortest runs of two or more lines that have ``min_words`` words, from each line forwards
and backwards.  Every two neighbouring lines of a common block lie in such a run of the block, so no
block is missed however many documents hold its lines, and there are at most two pairs per line or
run and document.  Each pair's lines are aligned with patience diff: common ends
are matched, lines that are unique in both sides and in the same order anchor the rest, and the gaps
between anchors are aligned likewise.  A run of aligned lines that is unbroken in both documents is a
common block.  An alignment has each line once and in one order, so what it leaves of repeated or
swapped passages is looked up by the same shortest runs, wherever they are in the earlier document;
those that overlap are one block.  So a line goes if it lies in any run of ``min_words`` words that
both documents have.  Blocks of at least ``min_words`` words are deleted from the document with the larger
id, lines and line ends; shorter ones stay.

The first holder of a line has no earlier partner for it, so one copy of everything stays.

Null and empty texts stay as they are and share nothing.  Rows with a null id stay as they are, and
repeats of a row lose the same lines.  Where an id comes with different texts, its rows share
partners and each row is aligned by itself, with all texts of the earlier id.  Lines of an own document that repeat are left alone.
Other columns pass through.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import cut, forget, slices, texts_of


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, sorted by their first part, whose second parts increase."""
    tops: list[int] = []
    tails: list[int] = []
    before = [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(tops, j)
        before[k] = tails[at - 1] if at else -1
        tops[at : at + 1] = [j]
        tails[at : at + 1] = [k]
    out, k = [], tails[-1] if tails else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned places (i, j) with a[i] == b[j], both increasing."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, i_end, j, j_end = todo.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            out.append((i_end, j_end))
        if i == i_end or j == j_end:
            continue
        in_a, in_b = Counter(a[i:i_end]), Counter(b[j:j_end])
        places = {x: k for k, x in enumerate(b[j:j_end], j) if in_b[x] == 1}
        unique = [(k, places[x]) for k, x in enumerate(a[i:i_end], i) if in_a[x] == 1 and x in places]
        anchors = _increasing(unique)
        for x, y in anchors:
            todo.append((i, x, j, y))
            out.append((x, y))
            i, j = x + 1, y + 1
        if anchors:
            todo.append((i, i_end, j, j_end))
    return sorted(out)


def blocks(matched: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """(first place in b, number of places) of each run that is unbroken on both sides."""
    start = 0
    for k in range(1, len(matched) + 1):
        last = matched[k - 1]
        if k == len(matched) or matched[k] != (last[0] + 1, last[1] + 1):
            yield matched[start][1], k - start
            start = k


def left_over(
    a: np.ndarray, b: np.ndarray, words: np.ndarray, found: list[tuple[int, int]], min_words: int
) -> Iterator[tuple[int, int]]:
    """(first place in b, number of places) of blocks that ``a`` has anywhere, if not inside ``found``.

    ``words`` are the words of the lines of ``b``.
    """
    inside = np.isin(b, a)
    bounds = np.flatnonzero(np.diff(np.r_[False, inside, False]))
    size = sizes(words)
    at = sorted(found)
    wanted = [
        (i, j)
        for i, j in zip(bounds[::2].tolist(), bounds[1::2].tolist(), strict=True)
        if size[j] - size[i] >= min_words and (i, j - i) not in found
    ]
    if not wanted:
        return
    lines, first = np.unique(b, return_index=True)
    place = np.minimum(np.searchsorted(lines, a), len(lines) - 1)
    # Lines that b does not have may count as empty: no run over them is in b.
    words_a = np.where(lines[place] == a, words[first][place], 0)
    raw_a, raw_b = a.tobytes(), b.tobytes()
    held = {raw_a[8 * i : 8 * j] for i, j in zip(*(x.tolist() for x in runs(sizes(words_a), min_words)), strict=True)}
    spans = []
    for i, j in wanted:
        spans += [(k, k + 1) for k in range(i, j) if words[k] >= min_words]
        starts, ends = runs(sizes(words[i:j]), min_words)
        spans += [(x, y) for x, y in zip((starts + i).tolist(), (ends + i).tolist(), strict=True) if raw_b[8 * x : 8 * y] in held]
    merged: list[list[int]] = []
    for i, j in sorted(spans):
        if merged and i < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], j)
        else:
            merged.append([i, j])
    for i, j in merged:
        k = bisect_right(at, (i, len(b))) - 1
        if k < 0 or sum(at[k]) < j:
            yield i, j - i


def _lined(docs: DataFrame) -> DataFrame:
    """(id, digest, hashes, words) per row; a blank line's hash is 0."""
    schema = T.StructType.fromDDL("digest long, hashes binary, words binary")
    schema = T.StructType([docs.schema["id"], *schema.fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for part in slices(batch, "text"):
                hashes, words = [], []
                for text in texts_of(part, "text"):
                    lines = [x.strip().encode() for x in text.split("\n")] if text else []
                    hashes.append(
                        np.array([xxhash.xxh3_64_intdigest(x) | 1 if x else 0 for x in lines], "u8").tobytes()
                    )
                    words.append(np.array([len(x.split()) for x in lines], "u4").tobytes())
                columns = [part.column("id"), part.column("digest")]
                columns += [pa.array(hashes, pa.binary()), pa.array(words, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return docs.mapInArrow(run, schema)


def runs(size: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the shortest runs of two or more lines with ``min_words`` words.

    They are taken from each line forwards and from each line backwards; ``size`` has the words
    before each line, and all words at the end.
    """
    n = len(size) - 1
    k = np.arange(max(n - 1, 0))
    end = np.maximum(k + 2, np.searchsorted(size, size[k] + min_words, "left"))
    start = np.minimum(k, np.searchsorted(size, size[k + 2] - min_words, "right") - 1)
    both = np.unique(np.r_[(k * (n + 1) + end)[end <= n], (start * (n + 1) + k + 2)[start >= 0]])
    return both // (n + 1), both % (n + 1)


def sizes(words: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(words, dtype="i8")])


def _key_rows(lined: DataFrame, min_words: int) -> DataFrame:
    """(id, hash) of each distinct line that is not blank (odd) and of each of the ``runs`` (even)."""
    schema = T.StructType([lined.schema["id"], T.StructField("hash", T.LongType())])
    arrow = to_arrow_schema(schema)

    def keys(hashes: bytes, words: bytes) -> np.ndarray:
        lines, count = np.frombuffer(hashes, "i8"), np.frombuffer(words, "u4")
        count, lines = count[lines != 0], lines[lines != 0]
        raw, (start, end) = lines.tobytes(), runs(sizes(count), min_words)
        spans = zip((8 * start).tolist(), (8 * end).tolist(), strict=True)
        of_runs = np.array([xxhash.xxh3_64_intdigest(raw[i:j]) & ~1 for i, j in spans], "u8")
        return np.unique(np.concatenate([lines, of_runs.view("i8")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            columns = (texts_of(batch, c) for c in ("hashes", "words"))
            sets = [keys(*row) for row in zip(*columns, strict=True)]
            rows = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
            flat = np.concatenate(sets) if sets else np.zeros(0, "i8")
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(rows)), pa.array(flat, pa.int64())], schema=arrow
            )

    return lined.select("id", "hashes", "words").mapInArrow(run, schema)


def _pairs(lined: DataFrame, min_words: int, rare: int) -> DataFrame:
    """(earlier, later) ids of documents that share a line or run, at most two per key and document."""
    keys = _key_rows(lined.where("id is not null"), min_words)
    stats = keys.groupBy("hash").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("n"))
    shared = cut(keys.join(stats.where("first <> last").drop("last"), "hash"))
    star = shared.where("id <> first").select(F.col("first").alias("earlier"), F.col("id").alias("later"))
    near = shared.where((F.col("n") <= rare) & (F.col("hash").bitwiseAND(1) == 1)).select(
        F.lag("id").over(Window.partitionBy("hash").orderBy("id")).alias("earlier"), F.col("id").alias("later")
    )
    return star.union(near.where("earlier < later")).distinct()


def _deletions(lined: DataFrame, pairs: DataFrame, min_words: int) -> DataFrame:
    """(id, digest, start, count) of deleted runs of lines, blank lines inside them included."""
    # All texts of an id one after the other; no line has the hash 2, which stands between them.
    earlier = lined.groupBy("id").agg(F.collect_set("hashes").alias("x")).select(F.col("id").alias("earlier"), "x")
    between = "aggregate(x, X'', (all, one) -> concat(all, X'0200000000000000', one))"
    earlier = earlier.withColumn("x", F.expr(between))
    later = lined.select(F.col("id").alias("later"), "digest", F.col("hashes").alias("y"), "words").distinct()
    rows = pairs.join(later, "later").join(earlier, "earlier").select("later", "digest", "x", "y", "words")
    schema = T.StructType.fromDDL("digest long, start int, count int")
    schema = T.StructType([T.StructField("id", rows.schema["later"].dataType), *schema.fields])
    arrow = to_arrow_schema(schema)

    def cuts(x: bytes, y: bytes, words: bytes) -> Iterator[tuple[int, int]]:
        a, b, count = np.frombuffer(x, "u8"), np.frombuffer(y, "u8"), np.frombuffer(words, "u4")
        places = np.flatnonzero(b)
        a, b, count = a[a != 0], b[places], count[places]
        size = sizes(count)
        found = [(j, n) for j, n in blocks(patience(a.tolist(), b.tolist())) if size[j + n] - size[j] >= min_words]
        for j, n in chain(found, left_over(a, b, count, found, min_words)):
            yield int(places[j]), int(places[j + n - 1] - places[j]) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            columns = (texts_of(batch, c) for c in ("x", "y", "words"))
            found = [list(cuts(*row)) for row in zip(*columns, strict=True)]
            at = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            flat = [c for f in found for c in f]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("later").take(at),
                    batch.column("digest").take(at),
                    pa.array([c[0] for c in flat], pa.int32()),
                    pa.array([c[1] for c in flat], pa.int32()),
                ],
                schema=arrow,
            )

    return rows.mapInArrow(run, schema).distinct()


def _gaps(deleted: DataFrame) -> DataFrame:
    """(id, digest, kept, n_removed): what stays between the deleted runs, as (first line, lines).

    The last stretch has -1 lines: it goes on to the end of the text.
    """
    by = ["id", "digest"]
    order = Window.partitionBy(*by).orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    between = F.struct("before", (F.col("start") - F.col("before")).alias("n"))
    runs = (
        deleted.select(*by, "start", (F.col("start") + F.col("count")).alias("end"))
        .withColumn("before", F.coalesce(before, F.lit(0)))
        .groupBy(*by)
        .agg(
            F.sort_array(F.collect_list(F.when(F.col("start") > F.col("before"), between))).alias("kept"),
            F.max("end").alias("end"),
            F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", "before"))).alias("n_removed"),
        )
    )
    return runs.select(
        *by,
        F.expr("concat(kept, array(named_struct('before', end, 'n', -1)))").alias("kept"),
        F.col("n_removed").cast("long").alias("n_removed"),
    )


def dedup_lines(
    documents: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    min_words: int = 20,
    rare: int = 64,
    lines: str = "n_lines",
    removed: str = "n_removed",
) -> DataFrame:
    """The rows with the passages deleted, and the numbers of ``lines`` before and ``removed``."""
    docs = documents.select(F.col(key).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("digest"))
    lined = cut(_lined(docs))
    gaps = _gaps(_deletions(lined.where("id is not null"), _pairs(lined, min_words, rare), min_words))
    same = (F.col(f"d.{key}") == F.col("g.id")) & (F.xxhash64(f"d.{text}") == F.col("g.digest"))
    rows = documents.alias("d").join(gaps.alias("g"), same, "left")
    parts = F.split(F.col(f"d.{text}"), "\n", -1)

    def stretch(k):
        rest = F.greatest(F.lit(0), F.size(parts) - k["before"])
        return F.slice(parts, k["before"] + 1, F.when(k["n"] < 0, rest).otherwise(k["n"]))

    cleaned = F.array_join(F.flatten(F.transform("g.kept", stretch)), "\n")
    cleaned = F.when(F.col("g.kept").isNull(), F.col(f"d.{text}")).otherwise(cleaned)
    others = [c for c in documents.columns if c not in (lines, removed)]
    return rows.select(
        *[cleaned.alias(text) if c == text else F.col(f"d.`{c}`") for c in others],
        F.when(F.length(f"d.{text}") > 0, F.size(parts)).otherwise(0).cast("long").alias(lines),
        F.coalesce("g.n_removed", F.lit(0)).cast("long").alias(removed),
    )
