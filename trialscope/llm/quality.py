"""Quality classifier: random-indexing word vectors pooled per document, and a two-layer network.

Each white-space word is read as its lower-cased letters and digits, the marks around them and, for
words in capitals, a token for that; tokens are hashed into ``BUCKETS`` buckets, which bounds all
tables.  Every bucket has a sparse random index vector.  Its word vector is the sum of the index
vectors of its neighbours (two on each side) over all documents, centred and scaled, joined with its
own index vector.  A document is the mean and spread of its tokens' vectors, the share of tokens that
repeat the one before, and its length.  The network is fitted on a bounded
sample of labelled rows and its probabilities are calibrated with a temperature on rows left out of
the fit; word vectors use all documents and no labels.

Null, empty and blank texts pool to zero and are scored like any other.  Without labels of both
kinds the score is the share of label 1, or 0.5 without any.  Rows whose label is neither 0 nor 1 are
not learned from.  Repeated rows get the same score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import Memo, Model, bounded_sample, forget, pieces_of, runs, slices, texts_of
from .nets import TwoLayers, sigmoid, temperature

BUCKETS, SIZE, ONES = 8192, 32, 4
_MARKS = re.compile(r"[^\w\s]+|_+")


def index_vectors() -> np.ndarray:
    """A sparse vector of +1 and -1 for each bucket; bucket 0 stands between texts and has none."""
    rng = np.random.default_rng(11)
    out = np.zeros((BUCKETS, SIZE), "i1")
    places = rng.random((BUCKETS, SIZE)).argpartition(ONES, axis=1)[:, :ONES]
    np.put_along_axis(out, places, rng.choice([-1, 1], (BUCKETS, ONES)).astype("i1"), axis=1)
    out[0] = 0
    return out


def bucket(token: str) -> int:
    return 1 + xxhash.xxh3_64_intdigest(token) % (BUCKETS - 1)


def tokens(word: str) -> list[str]:
    """What a white-space word is read as."""
    if word.isalnum():
        marks, core = [], word
    else:
        marks, core = _MARKS.findall(word), _MARKS.sub("", word)
    out = [core.lower()] if core else []
    if len(core) > 1 and core.isupper():
        out.append("\0capitals")
    return out + ["\0" + m[:3] for m in marks]


def coded(word: str) -> bytes:
    """The buckets of a word's tokens, two bytes each."""
    if word.isalnum() and not word.isupper():
        return bucket(word.lower()).to_bytes(2, "little")
    return b"".join(bucket(t).to_bytes(2, "little") for t in tokens(word))


class Reader:
    """Buckets of texts, words remembered."""

    def __init__(self, memory: int = 300_000) -> None:
        self.memo = Memo(memory)

    def read(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of all texts, each followed by two zeros, and where each text starts."""
        self.memo.make_room()
        memo, parts = self.memo, []
        for text in texts:
            words = text.split() if text else []
            found = list(map(memo.get, words))
            if None in found:
                for i, x in enumerate(found):
                    if x is None:
                        found[i] = memo[words[i]] = coded(words[i])
            parts.append(b"".join(found) + b"\0\0\0\0")
        return np.frombuffer(b"".join(parts), "<u2"), runs(len(p) // 2 for p in parts)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Word vectors of all buckets, from the neighbours in all texts of ``docs`` (column text)."""
    names = [f"v{i}" for i in range(SIZE)]
    schema = T.StructType.fromDDL("bucket int, " + ", ".join(f"{n} double" for n in names))
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        index, sums, reader = index_vectors(), np.zeros((BUCKETS, SIZE), "i8"), Reader()
        for batch in batches:
            for part in slices(batch, "text", 1 << 19):
                ids, _ = reader.read(texts_of(part, "text"))
                own = index[ids]
                # Four neighbours' components fit in a byte.
                near = np.zeros_like(own)
                for k in (1, 2):
                    near[k:] += own[:-k]
                    near[:-k] += own[k:]
                order = np.argsort(ids, kind="stable")
                sorted_ids = ids[order]
                starts = np.flatnonzero(np.r_[True, sorted_ids[1:] != sorted_ids[:-1]])
                sums[sorted_ids[starts]] += np.add.reduceat(near[order], starts, axis=0, dtype="i4")
        rows = np.flatnonzero(np.abs(sums).sum(axis=1))
        columns = [pa.array(rows, pa.int32())] + [pa.array(sums[rows, i].astype("f8")) for i in range(SIZE)]
        yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    total = docs.select("text").mapInArrow(run, schema).groupBy("bucket").agg(*(F.sum(n).alias(n) for n in names))
    got = total.toPandas()
    context = np.zeros((BUCKETS, SIZE))
    context[got["bucket"].to_numpy()] = got[names].to_numpy()
    context[0] = 0
    context /= np.maximum(np.linalg.norm(context, axis=1, keepdims=True), 1e-9)
    context -= context.mean(axis=0)
    context[0] = 0
    return np.hstack([context, index_vectors() / ONES**0.5]).astype("f4")


class Pooler:
    """Features of texts: the mean and spread of their tokens' vectors, repetition, length."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.vectors, self.squares, self.reader = vectors, vectors * vectors, Reader()

    def features(self, texts: Sequence[str | None]) -> np.ndarray:
        ids, starts = self.reader.read(texts)
        counts = np.diff(starts) - 2
        text = np.repeat(np.arange(len(texts)), np.diff(starts))
        repeats = np.add.reduceat((ids == np.roll(ids, 1)) & (ids > 0), starts[:-1], dtype="i8")
        whole = np.maximum(counts, 1)[:, None]
        parts = []
        # How often each text holds each bucket, for some texts at a time.
        for i in range(0, len(texts), 64):
            a, b = starts[i], starts[min(i + 64, len(texts))]
            n = min(64, len(texts) - i)
            held = np.bincount((text[a:b] - i) * BUCKETS + ids[a:b], minlength=n * BUCKETS)
            held = held.reshape(n, BUCKETS).astype("f4")
            held[:, 0] = 0
            parts.append((held @ self.vectors, held @ self.squares))
        middle, square = (np.concatenate(p) / whole for p in zip(*parts, strict=True))
        spread = np.sqrt(np.maximum(square - middle**2, 0))
        more = np.stack([repeats / whole[:, 0], np.log1p(counts) / 10], axis=1)
        return np.hstack([middle, spread, more]).astype("f4")


def fit_network(features: np.ndarray, labels: np.ndarray, seed: int = 3):
    """(network or None, temperature, constant score) from labelled rows."""
    if len(set(labels.tolist())) < 2:
        return None, 1.0, float(labels.mean()) if len(labels) else 0.5
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(labels))
    held, rest = order[: len(order) // 5], order[len(order) // 5 :]
    net = TwoLayers(features[rest], 32, seed)
    net.fit(features[rest], labels[rest], epochs=40)
    logits = net.logits(features[held]) if len(held) else np.zeros(0)
    return net, temperature(logits, labels[held]), 0.0


class Scorer:
    def __init__(self, model: tuple) -> None:
        vectors, (self.net, self.temperature, self.constant) = model
        self.pooler = Pooler(vectors)

    def scores(self, texts: Sequence[str | None]) -> np.ndarray:
        if self.net is None:
            return np.full(len(texts), self.constant)
        return sigmoid(self.net.logits(self.pooler.features(texts)).astype("f8") / self.temperature)


def fit(
    documents: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    per_label: int = 3000,
) -> Model:
    """Word vectors from all documents, and a network from about ``per_label`` rows of each label.

    ``labels`` holds key and label of the rows to learn from.
    """
    docs = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    vectors = word_vectors(docs)
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).where("label in (0, 1)")
    chosen = bounded_sample(known, "label", "key", per_label)
    rows = docs.join(chosen, "key").select("text", "label").limit(8 * per_label).toPandas()
    rows = rows.sort_values(["label", "text"], ignore_index=True)
    pooler = Pooler(vectors)
    parts = [pooler.features(rows["text"][i : i + 200].tolist()) for i in range(0, len(rows), 200)]
    features = np.concatenate(parts) if parts else np.zeros((0, 1), "f4")
    net = fit_network(features, rows["label"].to_numpy("f8"))
    return Model(documents.sparkSession, (vectors, net), Scorer, keep=1)


def score(documents: DataFrame, model: Model, *, text: str = "text", output: str = "score") -> DataFrame:
    """The rows with the probability of label 1; a column of the output's name is replaced.

    Only the text goes to the Python workers, and only the score comes back.
    """

    @F.arrow_udf(T.DoubleType())
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        with model.loaded() as scorer:
            for texts in batches:
                parts = [scorer.scores(part.to_pylist()) for part in pieces_of(texts, 1 << 19)]
                yield pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    others = [F.col(f"`{c}`") for c in documents.columns if c != output]
    return documents.select(*others, scored(F.col(f"`{text}`").cast("string")).alias(output))
