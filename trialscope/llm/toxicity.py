"""Toxicity by a bidirectional gated recurrent network with attention pooling, written in numpy.

A text is read as lower-cased words.  A run of more than ``LONG`` letters and digits, as in scripts
without spaces, is read as pieces of ``PIECE`` characters, each half as many after the one before and
the last one at the end; each piece counts as a word.  A word's input is its own vector, if it is one of the words
known from the fit, and the mean vector of its hashed character trigrams.  Windows of ``WINDOW``
words, each ``STRIDE`` after the one before and the last one at the end, cover the whole text; every
window is scored, and the text's score is that of its worst window.

The fit sees labels of whole texts only: in each round a toxic text is represented by its worst
window so far, a clean one by its worst and a random one.  At first a window's weight is the sum of
the log odds of its words and trigrams between toxic and clean texts, which is also where their
vectors start from.  In training windows some words are exchanged for words of clean texts.  It learns
from a bounded sample of labelled rows; texts are the only inputs.

Null texts and texts without words are one empty window.  Without labels of both kinds the score is
the share of label 1, or 0 without any.  Rows whose label is neither 0 nor 1 are not learned from.
Repeated rows get the same score.  Other columns pass through; columns of the outputs' names are
replaced.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
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
from .nets import Adam, sigmoid

WINDOW, STRIDE, LONG, PIECE = 24, 16, 40, 12
TRIGRAMS, OWN, CHARS, HIDDEN, ATTEND = 8192, 12, 12, 12, 12
_WORDS = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    """The words of a text, with overlapping pieces in place of long ones."""
    found = _WORDS.findall(text.lower())
    if max(map(len, found), default=0) <= LONG:
        return found
    out = []
    for word in found:
        last = len(word) - PIECE
        out += [word[i : i + PIECE] for i in (*range(0, last, PIECE // 2), last)] if len(word) > LONG else [word]
    return out


def trigrams(word: str) -> array:
    ends = f"^{word}$"
    return array("H", [xxhash.xxh3_64_intdigest(ends[i : i + 3]) % TRIGRAMS for i in range(len(ends) - 2)])


def windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts of so many words, one after the other: each window's first word, size and text."""
    n = np.maximum(1, -(-(lengths - WINDOW) // STRIDE) + 1)
    text = np.repeat(np.arange(len(lengths)), n)
    k = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    inside = np.minimum(k * STRIDE, np.maximum(lengths[text] - WINDOW, 0))
    return (np.cumsum(lengths) - lengths)[text] + inside, np.minimum(lengths[text], WINDOW), text


def recurrent(px: np.ndarray, mask: np.ndarray, u: np.ndarray, c: np.ndarray, back: bool, saved: list | None = None):
    """States of a gated recurrent layer over projected inputs (time, window, 3 * HIDDEN)."""
    steps, n, _ = px.shape
    h = np.zeros((n, HIDDEN), "f4")
    out = np.empty((steps, n, HIDDEN), "f4")
    for t in range(steps)[:: -1 if back else 1]:
        g = h @ u
        gates = sigmoid(px[t, :, : 2 * HIDDEN] + g[:, : 2 * HIDDEN])
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        q = g[:, 2 * HIDDEN :] + c
        new = np.tanh(px[t, :, 2 * HIDDEN :] + r * q)
        if saved is not None:
            saved.append((t, h, z, r, q, new))
        h = h + mask[t] * (1 - z) * (new - h)
        out[t] = h
    return out


def recurrent_slopes(d_out: np.ndarray, mask: np.ndarray, u: np.ndarray, saved: list):
    """Slopes of inputs, ``u`` and ``c`` from those of the states."""
    dpx = np.zeros((*d_out.shape[:2], 3 * HIDDEN), "f4")
    du, dc, dh = np.zeros_like(u), np.zeros(HIDDEN, "f4"), np.zeros(d_out.shape[1:], "f4")
    for t, h, z, r, q, new in reversed(saved):
        dh = dh + d_out[t]
        d = dh * mask[t]
        d_new = d * (1 - z) * (1 - new * new)
        d_z = d * (h - new) * z * (1 - z)
        d_r = d_new * q * r * (1 - r)
        d_q = d_new * r
        dpx[t] = np.hstack([d_z, d_r, d_new])
        dg = np.hstack([d_z, d_r, d_q])
        du += h.T @ dg
        dc += d_q.sum(axis=0)
        dh = dh - d + d * z + dg @ u.T
    return dpx, du, dc


class Net:
    """Weights, scores of windows and their slopes.  Word 0 is any word that the fit did not know."""

    def __init__(self, known: list[str], odds: np.ndarray, seed: int = 19) -> None:
        rng = np.random.default_rng(seed)

        def some(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) * shape[0] ** -0.5).astype("f4")

        self.slope, self.shift = 1.0, 0.0
        self.number = {w: i for i, w in enumerate(known, 1)}
        size = OWN + CHARS
        self.w = {
            "words": (0.1 * rng.standard_normal((len(known) + 1, OWN))).astype("f4"),
            "chars": (0.1 * rng.standard_normal((TRIGRAMS, CHARS))).astype("f4"),
            "attend": some(2 * HIDDEN, ATTEND), "ask": some(ATTEND),
            "out": some(2 * HIDDEN), "bias": np.full(1, -1, "f4"),
        }
        self.w["words"][0] = 0
        self.w["words"][1:, 0] = odds
        for d in "fb":
            self.w |= {f"x{d}": some(size, 3 * HIDDEN), f"y{d}": np.zeros(3 * HIDDEN, "f4")}
            self.w |= {f"u{d}": some(HIDDEN, 3 * HIDDEN), f"c{d}": np.zeros(HIDDEN, "f4")}

    def inputs(self, own: np.ndarray, grams: list[Sequence[int]]) -> np.ndarray:
        """Input vectors of words: rows of known words and means over trigrams."""
        means = []
        for i in range(0, len(grams), 20_000):
            part = grams[i : i + 20_000]
            sizes = np.array([len(g) for g in part])
            flat = self.w["chars"][np.fromiter(chain.from_iterable(part), "i4", sizes.sum())]
            means.append(np.add.reduceat(flat, np.cumsum(sizes) - sizes, axis=0) / sizes[:, None])
        return np.hstack([self.w["words"][own], np.concatenate(means)]).astype("f4")

    def logits(self, x: np.ndarray, at: np.ndarray, sizes: np.ndarray, saved: dict | None = None) -> np.ndarray:
        """Scores of windows, given as places ``at`` (time, window) in input vectors ``x``."""
        mask = (np.arange(len(at))[:, None] < sizes)[:, :, None].astype("f4")
        states = []
        for d in "fb":
            px = (x @ self.w[f"x{d}"] + self.w[f"y{d}"])[at]
            keep = None if saved is None else saved.setdefault(d, [])
            states.append(recurrent(px, mask, self.w[f"u{d}"], self.w[f"c{d}"], d == "b", keep))
        h = np.concatenate(states, axis=2)
        u = np.tanh(h @ self.w["attend"])
        s = np.where(mask[:, :, 0] > 0, u @ self.w["ask"], np.float32(-1e9))
        a = np.exp(s - s.max(axis=0)) * mask[:, :, 0]
        a /= np.maximum(a.sum(axis=0), 1e-9)
        pooled = np.einsum("tb,tbh->bh", a, h)
        if saved is not None:
            saved |= {"mask": mask, "h": h, "u": u, "a": a, "pooled": pooled}
        return pooled @ self.w["out"] + self.w["bias"][0]

    def slopes(self, x: np.ndarray, at: np.ndarray, d_logit: np.ndarray, saved: dict) -> tuple[dict, np.ndarray]:
        """Slopes of the weights above the inputs, and of ``x``."""
        mask, h, u, a, pooled = (saved[k] for k in ("mask", "h", "u", "a", "pooled"))
        out = {"out": pooled.T @ d_logit, "bias": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * self.w["out"]
        d_a = np.einsum("tbh,bh->tb", h, d_pooled)
        d_s = a * (d_a - (a * d_a).sum(axis=0))
        out["ask"] = np.einsum("tbk,tb->k", u, d_s)
        d_u = d_s[:, :, None] * self.w["ask"] * (1 - u * u)
        out["attend"] = np.einsum("tbh,tbk->hk", h, d_u)
        d_h = a[:, :, None] * d_pooled + d_u @ self.w["attend"].T
        dx = np.zeros_like(x)
        for d, part in zip("fb", (d_h[:, :, :HIDDEN], d_h[:, :, HIDDEN:]), strict=True):
            dpx, out[f"u{d}"], out[f"c{d}"] = recurrent_slopes(part, mask, self.w[f"u{d}"], saved[d])
            flat = np.zeros((len(x), 3 * HIDDEN), "f4")
            np.add.at(flat, at.ravel(), dpx.reshape(-1, 3 * HIDDEN))
            out[f"x{d}"], out[f"y{d}"] = x.T @ flat, flat.sum(axis=0)
            dx += flat @ self.w[f"x{d}"].T
        return out, dx


def places(first: np.ndarray, sizes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Word numbers (time, window); places after a window's end repeat some word."""
    steps = np.minimum(np.arange(WINDOW)[:, None], np.maximum(sizes - 1, 0))
    return words[np.minimum(first + steps, max(len(words) - 1, 0))] if len(words) else np.zeros(steps.shape, "i8")


def fit_net(
    texts: Sequence[str], labels: np.ndarray, rounds: int = 8, steps: int = 400, known: int = 20_000, seed: int = 23
) -> Net:
    """A network from texts and their labels, of which both kinds occur.

    A quarter of the texts is only used to turn worst windows' logits into probabilities of texts.
    Few texts are gone through several times a round, to make ``steps`` steps of 64 windows in all.
    """
    rng = np.random.default_rng(seed)
    held = rng.random(len(texts)) < 0.25
    if all(len(set(labels[part].tolist())) == 2 for part in (held, ~held)):
        kept_texts, kept_labels = [t for t, h in zip(texts, held, strict=True) if h], labels[held]
        texts, labels = [t for t, h in zip(texts, held, strict=True) if not h], labels[~held]
    else:
        kept_texts, kept_labels = list(texts), labels
    read = [words_of(t) for t in texts]
    read_sets = [[set(w) for w, y in zip(read, labels, strict=True) if y == k] for k in (0, 1)]
    counts = [Counter(chain.from_iterable(sets)) for sets in read_sets]
    both = counts[0] + counts[1]
    pieces: dict[str, array] = {}
    for w in both:
        pieces[w] = trigrams(w)
    names = sorted((w for w, n in both.items() if n >= 3), key=lambda w: (-both[w], w))[:known]
    share = [[(c[w] + 0.5) / ((labels == k).sum() + 1) for w in names] for k, c in enumerate(counts)]
    odds = np.clip(np.log(share[1]) - np.log(share[0]), -3, 5) / 2 if names else np.zeros(0)
    net = Net(names, odds.astype("f4"))
    # Trigrams start from their odds too, which new words made of the same pieces share.
    seen = np.zeros((2, TRIGRAMS))
    for k in (0, 1):
        for w in read_sets[k]:
            seen[k, np.unique(np.fromiter(chain.from_iterable(pieces[x] for x in w), "i4"))] += 1
    rates = (seen + 2) / (np.array([[len(read_sets[0])], [len(read_sets[1])]]) + 4)
    net.w["chars"][:, 0] = np.clip(np.log(rates[1] / rates[0]), -3, 5) / 2
    kinds: dict[str, int] = {}
    words = np.array([kinds.setdefault(w, len(kinds)) for w in chain.from_iterable(read)], "i8")
    own = np.array([net.number.get(w, 0) for w in kinds], "i4")
    grams = [pieces[w] for w in kinds] or [[0]]
    first, sizes, text = windows(np.array([len(r) for r in read], "i8"))
    starts = np.searchsorted(text, np.arange(len(read) + 1))
    adam = Adam(net.w, 6e-3)
    start = net.inputs(own, grams) if len(own) else np.zeros((1, OWN + CHARS), "f4")
    weight = start[:, 0] + start[:, OWN]
    # Words of clean texts, to put in the place of others.
    plain = words[np.repeat(labels == 0, [len(r) for r in read])]
    worst = np.where(np.arange(WINDOW)[:, None] < sizes, weight[places(first, sizes, words)], 0).sum(axis=0)
    per_round = max(1, (len(read) + int((labels == 0).sum())) // 64)
    # Clean windows are more numerous.
    weight_of = np.where(labels > 0, min(8.0, (labels == 0).sum() / (labels == 1).sum()), 1.0)
    passes = max(1, round(steps / rounds / per_round))
    for _ in range(rounds):
        top = np.array([a + worst[a:b].argmax() for a, b in zip(starts[:-1], starts[1:], strict=True)])
        clean = np.flatnonzero(labels == 0)
        spans = starts[clean + 1] - starts[clean]
        random = [starts[clean] + (rng.random(len(clean)) * spans).astype("i8") for _ in range(passes)]
        chosen = np.concatenate([rng.permutation(np.concatenate([top, r])) for r in random])
        for i in range(0, len(chosen), 64):
            w = chosen[i : i + 64]
            at = places(first[w], sizes[w], words)
            if len(plain):
                # What surrounds telling words is exchanged, so that it is not learned by heart, and
                # in toxic windows so are some of the telling words, so that one is enough.
                telling = weight[at] > 1
                swap = rng.random(at.shape) < np.where(telling, np.where(labels[text[w]] > 0, rng.random(len(w)) * 0.8, 0), 0.5)
                swap &= ~(telling & (np.cumsum(telling, axis=0) == 1))
                at = np.where(swap, rng.choice(plain, at.shape), at)
            used, at = np.unique(at, return_inverse=True)
            at = at.reshape(WINDOW, -1)
            lists = [grams[k] for k in used]
            row = own[used] if len(own) else np.zeros(len(used), "i4")
            x, saved = net.inputs(row, lists), {}
            truth = labels[text[w]]
            d = (sigmoid(net.logits(x, at, sizes[w], saved)) - truth) * weight_of[text[w]] / len(w)
            slopes, dx = net.slopes(x, at, d.astype("f4"), saved)
            slopes["words"] = np.zeros_like(net.w["words"])
            np.add.at(slopes["words"], row, dx[:, :OWN])
            slopes["words"][0] = 0
            slopes["chars"] = np.zeros_like(net.w["chars"])
            counts_of = np.array([len(g) for g in lists])
            np.add.at(
                slopes["chars"],
                np.fromiter(chain.from_iterable(lists), "i4", counts_of.sum()),
                np.repeat(dx[:, OWN:] / counts_of[:, None], counts_of, axis=0),
            )
            adam.step({k: g.astype("f4") + 1e-5 * net.w[k] for k, g in slopes.items()})
        x = net.inputs(own, grams) if len(own) else np.zeros((1, OWN + CHARS), "f4")
        worst = np.concatenate([
            net.logits(x, places(first[i : i + 4096], sizes[i : i + 4096], words), sizes[i : i + 4096])
            for i in range(0, len(first), 4096)
        ])
    judge, tops = Judge(net), []
    for i in range(0, len(kept_texts), 100):
        scores, _, starts = judge.window_scores(kept_texts[i : i + 100], raw=True)
        tops += np.maximum.reduceat(scores, starts[:-1]).tolist()
    net.slope, net.shift = calibrated(np.array(tops), kept_labels)
    return net


def calibrated(logits: np.ndarray, labels: np.ndarray, prior: float = 1.0) -> tuple[float, float]:
    """Slope and shift that make logits fit labels, by Newton steps with a weak prior towards 1 and 0."""
    slope, shift = 1.0, 0.0
    x = np.stack([logits, np.ones(len(logits))], axis=1)
    for _ in range(50):
        p = sigmoid(np.clip(x @ [slope, shift], -30, 30))
        push = x.T @ (p - labels) + prior * np.array([slope - 1, 0.1 * shift])
        bend = (x * (p * (1 - p))[:, None]).T @ x + prior * np.diag([1, 0.1])
        step = np.linalg.solve(bend, push)
        step *= min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        slope, shift = max(0.05, slope - step[0]), shift - step[1]
    return float(slope), float(shift)


class Judge:
    """Scores of all windows of texts."""

    def __init__(self, model: Net | float) -> None:
        self.net = model if isinstance(model, Net) else None
        self.constant = 0.0 if self.net else model
        self.memo = Memo(200_000)

    def window_scores(
        self, texts: Sequence[str | None], raw: bool = False
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of each window, its first word within the text, and offsets of the texts' windows.

        ``raw`` gives logits that are not calibrated.
        """
        read = [words_of(t) if t else [] for t in texts]
        lengths = np.array([len(r) for r in read], "i8")
        first, sizes, text = windows(lengths)
        starts = np.searchsorted(text, np.arange(len(texts) + 1))
        inside = first - (np.cumsum(lengths) - lengths)[text]
        if self.net is None:
            return np.full(len(first), self.constant), inside, starts
        kinds = {w: i for i, w in enumerate(dict.fromkeys(chain.from_iterable(read)))}
        words = np.fromiter(map(kinds.__getitem__, chain.from_iterable(read)), "i8", lengths.sum())
        self.memo.make_room()
        new = [w for w in kinds if w not in self.memo]
        for i in range(0, len(new), 20_000):
            part = new[i : i + 20_000]
            rows = self.net.inputs(np.array([self.net.number.get(w, 0) for w in part]), [trigrams(w) for w in part])
            for w, row in zip(part, rows, strict=True):
                self.memo[w] = row.tobytes()
        x = np.frombuffer(b"".join(map(self.memo.__getitem__, kinds)), "f4").reshape(-1, OWN + CHARS)
        if not len(x):
            x = np.zeros((1, OWN + CHARS), "f4")
        out = [
            self.net.logits(x, places(first[i : i + 2048], sizes[i : i + 2048], words), sizes[i : i + 2048])
            for i in range(0, len(first), 2048)
        ]
        logits = np.concatenate(out).astype("f8")
        return logits if raw else sigmoid(self.net.slope * logits + self.net.shift), inside, starts


def fit(
    documents: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    per_label: int = 1500,
) -> Model:
    """A network from about ``per_label`` rows of each label; ``labels`` holds key and label."""
    docs = documents.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text is not null")
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).where("label in (0, 1)")
    chosen = bounded_sample(known, "label", "key", per_label)
    rows = docs.join(chosen, "key").select("text", "label").limit(8 * per_label).toPandas()
    rows = rows.sort_values(["label", "text"], ignore_index=True)
    y = rows["label"].to_numpy("f4")
    if len(set(y.tolist())) == 2:
        model: Net | float = fit_net(rows["text"].tolist(), y)
    else:
        model = float(y.mean()) if len(y) else 0.0
    return Model(documents.sparkSession, model, Judge)


def score(
    documents: DataFrame,
    model: Model,
    *,
    text: str = "text",
    output: str = "score",
    count: str = "n_windows",
    worst: str = "worst_word",
) -> DataFrame:
    """The rows with the worst window's probability, the number of windows and its first word's place."""
    fields = [f for f in documents.schema.fields if f.name not in (output, count, worst)]
    new = [T.StructField(output, T.DoubleType()), T.StructField(count, T.LongType()), T.StructField(worst, T.LongType())]
    schema = T.StructType([*fields, *new])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = model.get()
        for batch in batches:
            for part in slices(batch, text, 1 << 19):
                scores, inside, starts = judge.window_scores(texts_of(part, text))
                top = [a + int(scores[a:b].argmax()) for a, b in zip(starts[:-1], starts[1:], strict=True)]
                columns = [part.column(f.name) for f in list(arrow)[:-3]]
                columns += [pa.array(scores[top]), pa.array(np.diff(starts), pa.int64()), pa.array(inside[top], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return documents.mapInArrow(run, schema)
