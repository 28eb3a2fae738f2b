"""Benchmark decontamination by winnowing.

Texts are lower-cased (A-Z only) and read as words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.  A window is
a run of ``length`` words of an item; an item with fewer words, but not none, is one shorter window.
From every run of ``w`` consecutive k-grams (k + w - 1 = window length) the smallest hash is kept as
a fingerprint.  A document that holds a window holds the same ``w`` k-grams, so it keeps the same
smallest hash there: no window can be missed.  Fingerprints of documents and items are joined, and
each hit is extended to the windows around it, which are compared word by word.

Before the join, document fingerprints that no item can have are dropped by a bitmap of fixed size;
it is filled by the items alone and only ever lets too many through.

Null texts and texts without words have no windows.  An item or document id may be null; a null item
id counts as no item in lists, but its windows are hit.  Rows that repeat an id with another text
are kept apart; repeated rows get the same result.  Other columns pass through; columns of the
result's names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import Model, cut, slices, texts_of

#: Words are runs of digits, letters a-z and all bytes above 0x7F; A-Z become a-z.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)
_BITS = 22
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_WORDS).split() if text else []


def shape(length: int) -> tuple[int, int]:
    """Words in a gram and grams in a run for windows of ``length`` words."""
    k = (length + 1) // 2
    return k, length - k + 1


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of ``k`` words, from the words' hashes."""
    n = len(hashes) - k + 1
    h = hashes[:n].copy()
    for i in range(1, k):
        h = h * _STEP + hashes[i : n + i]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _sliding(x: np.ndarray, w: int, pick) -> np.ndarray:
    out, n = x[: len(x) - w + 1], len(x) - w + 1
    for i in range(1, w):
        out = pick(out, x[i : n + i])
    return out


def winnowed(h: np.ndarray, w: int) -> np.ndarray:
    """Places of the grams that are smallest in some run of ``w`` of them."""
    least = _sliding(h, w, np.minimum)
    # A gram is kept if it equals the smallest of one of the runs that hold it.
    around = _sliding(np.pad(least, w - 1), w, np.maximum)
    return np.flatnonzero(around == h)


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), "u8", len(words))


def _item_windows(items: DataFrame, item_id: str, text: str, length: int) -> DataFrame:
    """(item, length, fingerprint, window) of each window of each item."""
    rows = items.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text"))
    schema = T.StructType.fromDDL("item string, length int, fingerprint long, window string")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                out: list[list] = [[], [], [], []]
                for item, value in zip(texts_of(part, "item"), texts_of(part, "text"), strict=True):
                    words = words_of(value)
                    if not words:
                        continue
                    size = min(length, len(words))
                    k, w = shape(size)
                    least = _sliding(grams(_hashes(words), k), w, np.minimum).view("i8")
                    out[0] += [item] * len(least)
                    out[1] += [size] * len(least)
                    out[2] += least.tolist()
                    out[3] += [b" ".join(words[i : i + size]).decode() for i in range(len(least))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, f.type) for x, f in zip(out, arrow, strict=True)], schema=arrow
                )

    return rows.mapInArrow(run, schema).distinct()


def _bitmap(windows: DataFrame) -> tuple[list[int], np.ndarray]:
    """The lengths of windows and a bitmap of their fingerprints, both of bounded size."""
    lengths = [r[0] for r in windows.select("length").distinct().collect()]
    place = F.col("fingerprint").bitwiseAND((1 << _BITS) - 1)
    chunks = (
        windows.groupBy(F.shiftrightunsigned(place, 5).alias("chunk"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(fingerprint & 31 as int))")).alias("bits"))
        .collect()
    )
    bitmap = np.zeros(1 << (_BITS - 5), "u4")
    for chunk, bits in chunks:
        bitmap[chunk] = bits
    return sorted(lengths), bitmap


_CANDIDATES = "array<struct<length:int,fingerprint:long,start:int,words:array<string>>>"


def _candidates(documents: DataFrame, key: str, text: str, lengths: list[int], bitmap: np.ndarray) -> DataFrame:
    """Per row: key, digest of the text, number of words, fingerprints that items may share."""
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType
    schema = T.StructType.fromDDL(f"digest long, n_words long, found {_CANDIDATES}")
    schema = T.StructType([T.StructField("key", kind), *schema.fields])
    arrow = to_arrow_schema(schema)
    model = Model(documents.sparkSession, (lengths, bitmap), lambda x: x, keep=1)

    def found(value: str | None) -> tuple[int, list[dict]]:
        words = words_of(value)
        out: list[dict] = []
        lengths, bitmap = model.get()
        if not lengths or len(words) < lengths[0]:
            return len(words), out
        hashes = _hashes(words)
        for size in lengths:
            if size > len(words):
                break
            k, w = shape(size)
            h = grams(hashes, k)
            kept = winnowed(h, w)
            place = h[kept] & np.uint64((1 << _BITS) - 1)
            bit = bitmap[place >> np.uint64(5)] >> (place & np.uint64(31)).astype("u4") & np.uint32(1)
            for p in kept[bit == 1].tolist():
                a = max(0, p - w + 1)
                span = [x.decode() for x in words[a : p + k + w - 1]]
                out.append({"length": size, "fingerprint": int(h[p].view("i8")), "start": a, "words": span})
        return len(words), out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = texts_of(part, "text")
                digests = [xxhash.xxh3_64_intdigest(t or "") - (1 << 63) for t in texts]
                counts, lists = zip(*map(found, texts), strict=True)
                columns = [part.column("key"), pa.array(digests, pa.int64()), pa.array(counts, pa.int64())]
                columns.append(pa.array(lists, arrow.field("found").type))
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return rows.mapInArrow(run, schema)


def overlaps(
    documents: DataFrame,
    items: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    length: int = 10,
) -> DataFrame:
    """One row per document row: key, digest, n_words, n_hit, spans (of hit words) and items."""
    windows = cut(_item_windows(items, item_id, item_text, length))
    base = cut(_candidates(documents, key, text, *_bitmap(windows)))
    one = ["key", "digest"]
    candidates = base.select(*one, F.inline("found")).distinct()
    prints = windows.select("length", "fingerprint").distinct()
    # Extending a hit: all windows that hold the shared gram.
    around = (
        candidates.join(prints, ["length", "fingerprint"], "left_semi")
        .where(F.size("words") >= F.col("length"))
        .select(*one, "length", "start", "words", F.explode(F.expr("sequence(0, size(words) - length)")).alias("i"))
        .select(
            *one,
            "length",
            (F.col("start") + F.col("i")).alias("start"),
            F.array_join(F.slice("words", F.col("i") + 1, F.col("length")), " ").alias("window"),
        )
        .distinct()
    )
    hits = around.join(windows.select("length", "window", "item"), ["length", "window"])
    hits = hits.withColumn("end", F.col("start") + F.col("length"))
    by = [F.col(c) for c in one]
    # The union of the hit windows: each adds what reaches past those that start before it.
    order = Window.partitionBy(*by).orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    spans = (
        hits.groupBy(*by, "start")
        .agg(F.max("end").alias("end"))
        .withColumn("before", F.coalesce(before, F.lit(0)))
        .withColumn("span", F.sum((F.col("start") > F.col("before")).cast("int")).over(order))
        .groupBy(*by, "span")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy(*by)
        .agg(
            F.sum(F.col("end") - F.col("start")).cast("long").alias("n_hit"),
            F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"),
        )
    )
    named = hits.groupBy(*by).agg(F.sort_array(F.collect_set("item")).alias("items"))

    def same(x: str, y: str) -> Column:
        """Equal keys; a null id is a key like any other."""
        parts = [F.col(f"{x}.{c}").eqNullSafe(F.col(f"{y}.{c}")) for c in one]
        return parts[0] & parts[1]

    found = spans.alias("s").join(named.alias("n"), same("s", "n")).select("s.*", "items")
    return (
        base.drop("found")
        .alias("d")
        .join(found.alias("f"), same("d", "f"), "left")
        .select(
            "d.key",
            "d.digest",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("spans", F.expr("cast(array() as array<struct<start:int,end:int>>)")).alias("spans"),
            F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
        )
    )


#: The same as SQL over documents and benchmark, in the shape of the query.
EXPECTED = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS l, array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS g
  FROM i, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(s) WHERE len(w) > 0),
ls AS (SELECT DISTINCT l FROM iw),
dw AS (
  SELECT doc_id, l, s, array_to_string(w[s:s + l - 1], ' ') AS g
  FROM d, ls, unnest(range(1, len(w) - l + 2)) AS t(s) WHERE len(w) >= l),
hits AS (SELECT doc_id, s, l, item_id FROM dw JOIN iw USING (l, g)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(s, s + l)) AS t(p) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
  FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""
