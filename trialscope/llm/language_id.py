"""Language identification by a linear-chain conditional random field over the words of a text.

A word is a run of letters, lower-cased, with the apostrophes inside it.  Its features are its
prefixes and suffixes of one to three characters, its character bigrams and trigrams with the word's
ends, its length and the word itself (the lexicon); features are hashed into ``BUCKETS`` buckets with
one weight per language.  Learned transition weights between languages tie neighbouring words
together, forward-backward gives each word's probability of each language, and a text's language is
the one with the largest mean over its words; the mean is the score.

The field is fitted by gradient steps on sequences spliced from spans of labelled texts in different
languages, so that it has seen switches.  It learns from a bounded sample of labelled rows; text and
label are its only inputs.  Very long texts are worked on in stretches of ``STRETCH`` words whose
messages overlap by ``LAP`` words on both sides.

Null texts and texts without a letter are ``und`` with score 0, as is everything if no row has both
text and label.  With one label alone, all other texts get it with score 1.  Repeated rows get the
same result.  Other columns pass through; columns of the outputs' names are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import Memo, Model, bounded_sample, slices, texts_of
from .nets import Adam

BUCKETS, STRETCH, LAP = 1 << 15, 2000, 50
#: Letters, with apostrophes between them; the rest of \\w is digits, other numbers and underscores.
_WORDS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")


def features(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the features of lower-cased words, word after word, and how many each word has."""
    n, lengths = len(words), np.array([len(w) for w in words], "i8")
    points = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le"), "u4").astype("u8")
    begin = np.cumsum(lengths + 2) - (lengths + 2)
    owner = np.repeat(np.arange(n), lengths + 2)
    left = (begin + lengths + 2)[owner] - np.arange(len(points))

    def code(kind: int, *parts: np.ndarray) -> np.ndarray:
        h = np.full(len(parts[0]), kind, "u8")
        for part in parts:
            h = (h ^ part) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return (h % np.uint64(BUCKETS)).astype("i4")

    def run(kind: int, at: np.ndarray, k: int) -> np.ndarray:
        return code(kind, *(points[at + i] for i in range(k)))

    whole = np.fromiter(map(xxhash.xxh3_64_intdigest, words), "u8", n)
    rows = [np.arange(n), np.arange(n)]
    found = [code(1, whole), code(2, np.minimum(lengths, 12).astype("u8"))]
    for k in (2, 3):
        at = np.flatnonzero(left >= k)
        rows.append(owner[at])
        found.append(run(2 + k, at, k))
    for k in (1, 2, 3):
        long = np.flatnonzero(lengths >= k)
        rows += [long, long]
        found += [run(10 + k, begin[long] + 1, k), run(20 + k, begin[long] + 1 + lengths[long] - k, k)]
    row = np.concatenate(rows)
    return np.concatenate(found)[np.argsort(row, kind="stable")], np.bincount(row, minlength=n)


class Field:
    """Weights of features (``emit``), transitions (``move``) and first words (``first``)."""

    def __init__(self, languages: list[str], memory: int = 250_000) -> None:
        n = len(languages)
        self.languages = languages
        self.w = {
            "emit": np.zeros((BUCKETS, n), "f4"),
            "move": np.zeros((n, n), "f4"),
            "first": np.zeros(n, "f4"),
        }
        self.memory = memory

    def emissions(self, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The summed weights of each word's features, scaled by the root of their number."""
        sums = np.add.reduceat(self.w["emit"][flat], np.cumsum(sizes) - sizes, axis=0)
        return sums / np.sqrt(sizes)[:, None].astype("f4")

    def marginals(self, scores: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward-backward over sequences of emission scores that stand one after the other.

        Gives each word's probabilities and the summed probabilities of neighbouring pairs.  All
        sequences run in step, longest first.
        """
        n = scores.shape[1]
        order = np.argsort(-lengths, kind="stable")
        begin = (np.cumsum(lengths) - lengths)[order]
        sizes = lengths[order]
        longest = int(sizes[0]) if len(sizes) else 0
        active = np.searchsorted(-sizes, -np.arange(longest), side="left").tolist()
        local = np.exp(scores - scores.max(axis=1, keepdims=True)).astype("f8") + 1e-12
        move = np.exp(self.w["move"] - self.w["move"].max()).astype("f8")
        first = np.exp(self.w["first"] - self.w["first"].max()).astype("f8")
        ahead, back = np.empty_like(local), np.ones_like(local)
        pairs = np.zeros((n, n))
        for k in range(longest):
            at = begin[: active[k]] + k
            x = local[at] * (first if k == 0 else ahead[at - 1] @ move)
            ahead[at] = x / x.sum(axis=1, keepdims=True)
        for k in range(longest - 2, -1, -1):
            at = begin[: active[k + 1]] + k
            after = local[at + 1] * back[at + 1]
            x = after @ move.T
            scale = x.sum(axis=1, keepdims=True)
            back[at] = x / scale
            both = np.einsum("ti,tj->tij", ahead[at], after) * move
            pairs += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        out = ahead * back
        return out / out.sum(axis=1, keepdims=True), pairs

    def fit(self, texts: Sequence[str], labels: Sequence[int], epochs: int = 4, seed: int = 13) -> None:
        """Gradient steps on the likelihood of spliced sequences of at most 60 words."""
        rng = np.random.default_rng(seed)
        vocabulary: dict[str, int] = {}
        spans: list[tuple[np.ndarray, int]] = []
        for text, label in zip(texts, labels, strict=True):
            words = [vocabulary.setdefault(w, len(vocabulary)) for w in _WORDS.findall(text.lower())]
            spans += [(np.array(words[i : i + 20]), int(label)) for i in range(0, len(words), 20)]
        if not spans:
            return
        flat, count = features(list(vocabulary))
        offset = np.cumsum(count) - count
        adam = Adam(self.w, 0.02)
        n = len(self.languages)
        for _ in range(epochs):
            todo = rng.permutation(len(spans))
            for i in range(0, len(todo), 192):
                chosen = [spans[k] for k in todo[i : i + 192]]
                words = np.concatenate([s for s, _ in chosen])
                truth = np.concatenate([np.full(len(s), y) for s, y in chosen])
                # Up to three spans in a row make a sequence.
                heads = np.arange(len(chosen)) % 3 == 0
                lengths = np.add.reduceat([len(s) for s, _ in chosen], np.flatnonzero(heads))
                kinds, at = np.unique(words, return_inverse=True)
                sizes = count[kinds]
                own = flat[np.repeat(offset[kinds] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
                p, pairs = self.marginals(self.emissions(own, sizes)[at], lengths)
                wrong = p.copy()
                wrong[np.arange(len(truth)), truth] -= 1
                per_kind = np.stack([np.bincount(at, wrong[:, j], len(kinds)) for j in range(n)], axis=1)
                per_kind /= np.sqrt(sizes)[:, None]
                slope = np.zeros((BUCKETS, n))
                np.add.at(slope, own, np.repeat(per_kind, sizes, axis=0))
                start = np.zeros(len(truth), bool)
                start[np.cumsum(lengths) - lengths] = True
                seen = np.zeros((n, n))
                np.add.at(seen, (truth[:-1][~start[1:]], truth[1:][~start[1:]]), 1)
                total = len(truth)
                adam.step({
                    "emit": (slope / total + 1e-7 * self.w["emit"]).astype("f4"),
                    "move": ((pairs - seen) / total + 1e-3 * self.w["move"]).astype("f4"),
                    "first": (wrong[start].sum(axis=0) / total + 1e-3 * self.w["first"]).astype("f4"),
                })


class Tagger:
    """Words' languages by a fitted field; emission scores of words are remembered."""

    def __init__(self, field: Field) -> None:
        self.field = field
        self.memo = Memo(field.memory)

    def words(self, texts: Sequence[str | None]) -> list[list[str]]:
        # Texts without a letter have no words, whatever else the pattern finds in them.
        return [_WORDS.findall(t.lower()) if t and any(map(str.isalpha, t)) else [] for t in texts]

    def word_probabilities(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of all words, one text after the other, and each text's number of words."""
        words = self.words(texts)
        lengths = np.array([len(w) for w in words], "i8")
        self.memo.make_room()
        new = list(set(chain.from_iterable(words)) - self.memo.keys())
        for i in range(0, len(new), 20_000):
            part = new[i : i + 20_000]
            for w, row in zip(part, self.field.emissions(*features(part)), strict=True):
                self.memo[w] = row.tobytes()
        n = len(self.field.languages)
        known = self.memo.__getitem__
        scores = np.frombuffer(b"".join(map(known, chain.from_iterable(words))), "f4").reshape(-1, n)
        out = np.empty(scores.shape)
        begin = np.cumsum(lengths) - lengths
        # Stretches with some words around them; what is around is not used.
        core = [
            (b + i, b + min(i + STRETCH, m), b, b + m)
            for b, m in zip(begin.tolist(), lengths.tolist(), strict=True)
            for i in range(0, m, STRETCH)
        ]
        if core:
            wide = [(max(lo, a - LAP), min(hi, e + LAP)) for a, e, lo, hi in core]
            at = np.concatenate([np.arange(a, e) for a, e in wide])
            p, _ = self.field.marginals(scores[at], np.array([e - a for a, e in wide]))
            sizes = [e - a for a, e in wide]
            low, high = (np.repeat([c[i] for c in core], sizes) for i in (0, 1))
            inside = (at >= low) & (at < high)
            out[at[inside]] = p[inside]
        return out, lengths

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], list[float]]:
        names, scores = ["und"] * len(texts), [0.0] * len(texts)
        if not self.field.languages:
            return names, scores
        p, lengths = self.word_probabilities(texts)
        some = np.flatnonzero(lengths)
        if len(some):
            begin = (np.cumsum(lengths) - lengths)[some]
            means = np.add.reduceat(p, begin, axis=0) / lengths[some, None]
            best = means.argmax(axis=1)
            for i, k, x in zip(some.tolist(), best.tolist(), means.max(axis=1).tolist(), strict=True):
                names[i], scores[i] = self.field.languages[k], min(1.0, x)
        return names, scores


def fit(labelled: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "lang", per_label: int = 400) -> Model:
    """A field from about ``per_label`` of the rows of each label."""
    rows = labelled.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(label).cast("string").alias("label"))
    rows = rows.where(F.col("text").isNotNull())
    got = bounded_sample(rows, "label", "key", per_label).select("text", "label").toPandas()
    got = got.sort_values(["label", "text"], ignore_index=True)
    names = sorted(got["label"].unique())
    field = Field(names)
    if len(names) > 1:
        number = {x: i for i, x in enumerate(names)}
        field.fit(got["text"].tolist(), [number[x] for x in got["label"]])
    return Model(labelled.sparkSession, field, Tagger)


def identify(
    documents: DataFrame, model: Model, *, text: str = "text", output: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """The rows with the predicted language and its mean probability."""
    fields = [f for f in documents.schema.fields if f.name not in (output, score)]
    schema = T.StructType([*fields, T.StructField(output, T.StringType()), T.StructField(score, T.DoubleType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = model.get()
        for batch in batches:
            for part in slices(batch, text):
                names, scores = tagger.predict(texts_of(part, text))
                columns = [part.column(f.name) for f in list(arrow)[:-2]]
                columns += [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return documents.mapInArrow(run, schema)


def label_words(documents: DataFrame, model: Model, *, text: str = "text", output: str = "words") -> DataFrame:
    """The rows with their words, each with its likeliest language and probability."""
    fields = [f for f in documents.schema.fields if f.name != output]
    kind = T.StructType.fromDDL(f"{output} array<struct<word:string,lang:string,score:double>>")
    schema = T.StructType([*fields, *kind.fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = model.get()
        for batch in batches:
            for part in slices(batch, text):
                texts = texts_of(part, text)
                names = tagger.field.languages
                p, _ = tagger.word_probabilities(texts) if names else (np.zeros((0, 1)), None)
                found, at = [], 0
                for words in tagger.words(texts):
                    rows = p[at : at + len(words)] if names else []
                    at += len(words)
                    found.append([
                        {"word": w, "lang": names[int(x.argmax())], "score": float(x.max())}
                        for w, x in zip(words, rows, strict=bool(names))
                    ])
                columns = [part.column(f.name) for f in list(arrow)[:-1]]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, arrow.field(output).type)], schema=arrow)

    return documents.mapInArrow(run, schema)
