"""Language-model scoring by prediction by partial matching over bytes, and a word baseline.

The model is a trie of byte contexts up to ``ORDER`` bytes long, counted over all training texts; a
text is preceded by ``ORDER`` end marks and followed by one, so every byte and the end are counted
below a full context, and a shorter context's counts are sums over the longer ones'.  A byte that the
longest known context has seen gets count / (total + distinct); otherwise the escape, distinct /
(total + distinct), is paid and the next shorter context is asked, without the bytes that the longer
one has seen, down to an even choice among the bytes that were never seen at all.

Whatever is excluded depends on the context alone, so all probabilities of a context form one row of
a table, and scoring a text is two look-ups per byte.  All contexts that end in the same byte need
each other and the two shortest contexts only.  Contexts are therefore dealt to parts by their last
byte, and each part's table is sent to the executors by itself: a last byte has at most 65,793
contexts, so a part is bounded whatever the corpus.  With more than ``rows`` contexts in all, the
texts are read once per part and the parts' sums are added.

The baseline needs the corpus count of each word of each text.  The most frequent words, at most
``frequent`` of them, are looked up in a table sent to the executors; only the other words of a text
go through a join with the word counts.

Null texts count as empty; an empty text is its end mark.  Without training texts all bytes are
equally likely and N and V are 0: base scores then are those of the formula with 0.5 / 0.5.  Rows
that repeat an id with the same text get the same scores, with other texts their own.  Other columns
are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import Model, cut, slices, texts_of

ORDER = 3
#: A byte that UTF-8 never uses: stands before texts and ends them.
END = 0xFF


def codes(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Each byte and end mark with its context, as 32-bit numbers, and where each text starts."""
    mark = bytes([END])
    data = [t.encode() if t else b"" for t in texts]
    # Every text is followed by as many marks as the next one's context needs.
    flat = np.frombuffer(mark * ORDER + b"".join(x + mark * ORDER for x in data), "u1").astype("u4")
    grams = flat[:-3] << 24 | flat[1:-2] << 16 | flat[2:-1] << 8 | flat[3:]
    lengths = np.array([len(x) for x in data])
    begin = np.concatenate([[0], np.cumsum(lengths + ORDER)[:-1]]) if len(data) else np.zeros(0, "i8")
    # Only the first mark after a text is an event.
    event = np.zeros(len(grams) + 1, "i4")
    np.add.at(event, begin, 1)
    np.add.at(event, begin + lengths + 1, -1)
    keep = np.cumsum(event[:-1]) > 0
    return grams[keep], np.concatenate([[0], np.cumsum(lengths + 1)])


def gram_counts(docs: DataFrame) -> DataFrame:
    """(gram, n): how often each byte follows each context of ``ORDER`` bytes, over column text."""
    schema = T.StructType.fromDDL("gram long, n long")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Counts of slices are merged like the digits of a binary counter, so each is merged rarely.
        piles: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for part in slices(batch, "text"):
                piles.append(np.unique(codes(texts_of(part, "text"))[0], return_counts=True))
                while len(piles) > 1 and 2 * len(piles[-1][0]) > len(piles[-2][0]):
                    piles.append(_merged(piles.pop(), piles.pop()))
        while len(piles) > 1:
            piles.append(_merged(piles.pop(), piles.pop()))
        for grams, counts in piles:
            for i in range(0, len(grams), 1 << 16):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(grams[i : i + (1 << 16)].astype("i8")),
                        pa.array(counts[i : i + (1 << 16)].astype("i8")),
                    ],
                    schema=arrow,
                )

    return docs.select("text").mapInArrow(run, schema).groupBy("gram").agg(F.sum("n").alias("n"))


def _merged(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    grams, at = np.unique(np.concatenate([x[0], y[0]]), return_inverse=True)
    return grams, np.bincount(at, np.concatenate([x[1], y[1]]), len(grams)).astype("i8")


class Ppm:
    """Log10 probabilities of all bytes in all contexts that end in one of some last bytes.

    ``grams`` and ``counts`` are those whose context ends in these bytes, ``zero`` the counts of all
    256 bytes without context.
    """

    def __init__(self, model: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]) -> None:
        grams, counts, zero, self.own = model
        self.zero = zero.astype("f8")
        self.even = np.where(zero == 0, 1.0 / max(1, np.count_nonzero(zero == 0)), 0.0)
        self._build(grams.astype("i8"), counts)

    @staticmethod
    def _row(counts: np.ndarray, out: np.ndarray, below: np.ndarray) -> np.ndarray:
        """Probabilities of one level, without the bytes in ``out``; the rest escapes to ``below``."""
        left = np.where(out, 0.0, counts)
        total, kinds = left.sum(axis=-1, keepdims=True), np.count_nonzero(left, axis=-1, keepdims=True)
        whole = np.maximum(total + kinds, 1)
        escape = np.where(total > 0, kinds / whole, 1.0)
        return np.where(left > 0, left / whole, np.where(counts > 0, 0.0, escape * below))

    def _build(self, grams: np.ndarray, counts: np.ndarray) -> None:
        # Per length of context: context and byte as one number, and its count.
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        for k in range(1, ORDER + 1):
            keys, at = np.unique(grams & ((1 << 8 * k + 8) - 1), return_inverse=True)
            self.levels.append((keys, np.bincount(at, counts, len(keys))))
        contexts = [np.unique(keys >> 8) for keys, _ in self.levels]
        # A context that was never met is treated like the longest part of it that was; row 0 of the
        # table stands for no context at all.
        self.row_of = np.zeros(1 << 24, "i4")
        log = np.empty((1 + sum(map(len, contexts)), 256), "f4")
        log[0] = np.log10(self._row(self.zero, np.zeros(256, bool), self.even))
        offset = 1
        for k, names in enumerate(contexts, 1):
            for i in range(0, len(names), 1024):
                block = names[i : i + 1024]
                log[offset + i : offset + i + len(block)] = np.log10(self._level(k, block))
            self.row_of.reshape(-1, 1 << 8 * k)[:, names] = offset + np.arange(len(names), dtype="i4")
            offset += len(names)
        self.log = log.ravel()
        del self.levels

    def _counts(self, k: int, names: np.ndarray) -> np.ndarray:
        """Counts of all bytes after contexts of ``k`` bytes."""
        keys, counts = self.levels[k - 1]
        names, at = np.unique(names, return_inverse=True)
        first, end = np.searchsorted(keys, names << 8), np.searchsorted(keys, (names + 1) << 8)
        row = np.repeat(np.arange(len(names)), end - first)
        place = np.arange(len(row)) + np.repeat(first - (np.cumsum(end - first) - (end - first)), end - first)
        dense = np.zeros((len(names), 256))
        dense[row, keys[place] & 0xFF] = counts[place]
        return dense[at]

    def _level(self, k: int, names: np.ndarray) -> np.ndarray:
        """Rows of contexts of ``k`` bytes, built from the shortest context up."""
        seen = [self._counts(j, names & ((1 << 8 * j) - 1)) for j in range(k, 0, -1)]
        seen.append(np.broadcast_to(self.zero, seen[0].shape))
        below = np.broadcast_to(self.even, seen[0].shape)
        for j in range(len(seen) - 1, 0, -1):
            # What the next longer context has seen is out of the question here.
            below = self._row(seen[j], seen[j - 1] > 0, below)
        return self._row(seen[0], np.zeros(seen[0].shape, bool), below)

    def scores(self, texts: Sequence[str | None]) -> np.ndarray:
        """For each text, the sum of log10 probabilities of the events whose context is in this part."""
        grams, starts = codes(texts)
        if not len(starts) - 1:
            return np.zeros(0)
        bits = self.log[self.row_of[grams >> 8].astype("i8") * 256 + (grams & 0xFF)].astype("f8")
        if self.own is not None:
            bits *= self.own[grams >> 8 & 0xFF]
        return np.add.reduceat(bits, starts[:-1])


def adaptive(text: str | None) -> float:
    """Log10 probability of a text by a model that starts empty and learns each byte after coding it."""
    counts: dict[bytes, Counter] = {}
    data = bytes([END]) * ORDER + (text.encode() if text else b"") + bytes([END])
    total = 0.0
    for i in range(ORDER, len(data)):
        out: set[int] = set()
        for k in range(ORDER, -1, -1):
            seen = counts.get(data[i - k : i], Counter())
            left = {b: n for b, n in seen.items() if b not in out}
            if not left:
                continue
            whole = sum(left.values()) + len(left)
            if data[i] in left:
                total += math.log10(left[data[i]] / whole)
                break
            total += math.log10(len(left) / whole)
            out |= left.keys()
        else:
            total -= math.log10(256 - len(out))
        for k in range(ORDER + 1):
            counts.setdefault(data[i - k : i], Counter())[data[i]] += 1
    return total


def models(docs: DataFrame, rows: int = 100_000) -> list[Model]:
    """The trained model in parts of about ``rows`` contexts, from the texts in ``docs``."""
    spark = docs.sparkSession
    counted = cut(gram_counts(docs))
    last = F.shiftrightunsigned("gram", 8).bitwiseAND(0xFF)
    zero = np.zeros(256)
    for symbol, n in counted.groupBy(F.col("gram").bitwiseAND(0xFF).alias("s")).agg(F.sum("n").alias("n")).collect():
        zero[symbol] = n
    context = F.shiftrightunsigned("gram", 8)
    sizes = counted.select(last.alias("last"), context.alias("c")).distinct().groupBy("last").count().collect()
    parts: list[list[int]] = [[]]
    filled = 0
    for byte, n in sorted(sizes):
        if filled and filled + n > rows:
            parts.append([])
            filled = 0
        parts[-1].append(byte)
        filled += n
    out = []
    known = {byte for byte, _ in sizes}
    parts[0] += [b for b in range(256) if b not in known]
    for part in parts:
        own = None if len(parts) == 1 else np.isin(np.arange(256), part)
        frame = (counted if own is None else counted.where(last.isin(part))).orderBy("gram").toArrow()
        grams, n = (frame.column(c).to_numpy() for c in ("gram", "n"))
        out.append(Model(spark, (grams.astype("u4"), n, zero, own), Ppm, keep=1))
    return out


def words_of(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over column text, words as bytes; each text also counts one end, which is no word."""
    schema = T.StructType.fromDDL("word binary, n long")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            columns = [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(columns, schema=arrow)

        for batch in batches:
            for part in slices(batch, "text"):
                for text in texts_of(part, "text"):
                    counts.update(words_of(text))
                if len(counts) > 500_000:
                    yield rows()
        yield rows()

    return docs.select("text").mapInArrow(run, schema).groupBy("word").agg(F.sum("n").alias("n"))


def _tokens(docs: DataFrame, table: Model, part: Model) -> DataFrame:
    """Per row: id, digest, n_tokens, n_known and logs of its frequent words, its other words, score."""
    kind = docs.schema["id"].dataType
    schema = T.StructType.fromDDL(
        "digest long, n_tokens long, n_known long, logs double, score double, words array<binary>, times array<int>"
    )
    schema = T.StructType([T.StructField("id", kind), T.StructField("held_out", T.BooleanType()), *schema.fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_of, ppm = table.get(), part.get()
        for batch in batches:
            for piece in slices(batch, "text"):
                texts = texts_of(piece, "text")
                out: list[list] = [[] for _ in range(6)]
                for text in texts:
                    words = words_of(text)
                    found = list(map(log_of.get, words))
                    known = [x for x in found if x is not None]
                    other = Counter(w for w, x in zip(words, found, strict=True) if x is None)
                    row = (
                        xxhash.xxh3_64_intdigest(text or "") - (1 << 63),
                        len(words) + 1,
                        len(known),
                        math.fsum(known),
                        list(other),
                        list(other.values()),
                    )
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
                out.insert(4, ppm.scores(texts))
                columns = [piece.column("id"), piece.column("held_out")]
                columns += [pa.array(x, f.type) for x, f in zip(out, list(arrow)[2:], strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return docs.mapInArrow(run, schema)


def _part_scores(docs: DataFrame, part: Model) -> DataFrame:
    schema = T.StructType([docs.schema["id"], *T.StructType.fromDDL("digest long, more double").fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ppm = part.get()
        for batch in batches:
            for piece in slices(batch, "text"):
                texts = texts_of(piece, "text")
                digests = [xxhash.xxh3_64_intdigest(t or "") - (1 << 63) for t in texts]
                columns = [piece.column("id"), pa.array(digests, pa.int64()), pa.array(ppm.scores(texts))]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return docs.select("id", "text").mapInArrow(run, schema)


def score(
    documents: DataFrame,
    held_out: Column,
    *,
    key: str = "doc_id",
    text: str = "text",
    frequent: int = 250_000,
    rows: int = 100_000,
) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row.

    Learns from the rows for which ``held_out`` is false.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col(key).alias("id"), held_out.alias("held_out"), F.col(text).alias("text"))
    train = docs.where(~F.col("held_out"))
    counts = cut(word_counts(train))
    n_words, n_kinds = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    ends = train.count()
    total, kinds = n_words + ends, n_kinds + (1 if ends else 0)
    whole = math.log10(total + 0.5 * (kinds + 1))
    top = counts.orderBy(F.desc("n"), "word").limit(frequent).toArrow()
    logs = np.log10(top.column("n").to_numpy() + 0.5)
    # All other words are at most as frequent as these.
    least = int(top.column("n").to_numpy().min()) if len(top) else total
    table = Model(spark, (top.column("word").to_pylist(), logs), lambda x: dict(zip(x[0], x[1].tolist(), strict=True)))
    parts = models(train, rows)
    base = cut(_tokens(docs, table, parts[0]))

    one = ["id", "digest"]
    others = (
        base.where(F.size("words") > 0)
        .dropDuplicates(one)
        .select(*one, F.explode(F.arrays_zip("words", "times")).alias("w"))
        .select(*one, F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    )
    # Frequent words never get here, so their counts need not be joined.
    joined = others.join(counts.where(F.col("n") <= least), "word", "left")
    rest = joined.groupBy(*one).agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("more_logs"),
    )
    same = F.col("b.id").eqNullSafe(F.col("r.id")) & (F.col("b.digest") == F.col("r.digest"))
    out = base.drop("words", "times").alias("b").join(rest.alias("r"), same, "left").select("b.*", "more_known", "more_logs")
    for part in parts[1:]:
        more = _part_scores(docs, part).dropDuplicates(one)
        same = F.col("b.id").eqNullSafe(F.col("r.id")) & (F.col("b.digest") == F.col("r.digest"))
        out = out.alias("b").join(more.alias("r"), same).select("b.*", "more")
        out = out.withColumn("score", F.col("score") + F.col("more")).drop("more")
    tokens = F.col("n_tokens")
    end = math.log10(ends + 0.5)
    return out.select(
        F.col("id").alias(key),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0)) + F.lit(1 if ends else 0)).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) + F.lit(end) - tokens * F.lit(whole)).alias("base_score"),
        "score",
    )
