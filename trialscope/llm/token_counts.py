"""Token counts of a word-level BPE tokenizer, compiled to finite-state transducers.

Two deterministic transducers run one after the other over the normalised text (NFC, lower case).

The first reads classes of characters and finds where pre-tokens start.  It has nine states.  The
text is cut into chunks of equal length; each chunk's map from the state before it to the state
after it is computed for all states at once, the maps are composed by a parallel prefix scan, and
with the state before each chunk known, all chunks are run side by side.

The second reads the bytes of a pre-token; each transition bears the number of tokens that the
encoding gains (or loses) by that byte, and the last byte of a word has transitions of its own.  The
encoding of a prefix ends in exactly one token that is valid after the encoding of the rest, so a
state holds the longest suffix that can still become part of a token, and for each place in it the
last token and the relative count.  States and transitions are made when they are first met and kept
in tables of bounded size, which are emptied when full; all pre-tokens of a batch run in step.

Special strings in a text count as one token each and separate what is around them.  Null and empty
texts have no tokens.  Very long texts are read in pieces cut at white space.  Other columns, repeated
rows included, pass through; a column with the name of the output is replaced.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import Model, runs, shipped, slices, texts_of, with_columns

# Classes of characters: the letters of contractions after an apostrophe have their own.
SPACE, MARK, APOSTROPHE, NUMBER, LETTER, STMD, R, V, L, E = range(10)
# States after a character: in or after which kind of pre-token it stands; the last three have read
# an apostrophe and a letter that may go on to a contraction.
GAP, WORD, DIGIT, MARKS, QUOTE, SHORT, QUOTE_R, QUOTE_V, QUOTE_L = range(9)


def classes() -> np.ndarray:
    """The class of every code point."""
    out = np.full(0x110000, MARK, "u1")
    step = 0x800
    for start in range(0, 0x110000, step):
        if 0xD800 <= start < 0xE000:
            continue
        some = "".join(map(chr, range(start, start + step)))
        for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
            for found in regex.finditer(pattern, some):
                out[start + found.start() : start + found.end()] = kind
    for letters, kind in (("'", APOSTROPHE), ("stmd", STMD), ("r", R), ("v", V), ("l", L), ("e", E)):
        for x in letters:
            out[ord(x)] = kind
    return out


def transitions() -> np.ndarray:
    """next[class, state] of the first transducer."""
    out = np.zeros((10, 9), "u1")
    for kind in range(10):
        for state in range(9):
            letter = kind >= LETTER
            if kind == SPACE:
                to = GAP
            elif kind == NUMBER:
                to = DIGIT
            elif kind == MARK:
                to = MARKS
            elif kind == APOSTROPHE:
                to = MARKS if state in (MARKS, QUOTE) else QUOTE
            elif state == QUOTE and kind == STMD:
                to = SHORT
            elif state == QUOTE and kind in (R, V, L):
                to = {R: QUOTE_R, V: QUOTE_V, L: QUOTE_L}[kind]
            elif state in (QUOTE_R, QUOTE_V) and kind == E or state == QUOTE_L and kind == L:
                to = SHORT
            else:
                assert letter
                to = WORD
            out[kind, state] = to
    return out


def states(kinds: np.ndarray, table: np.ndarray, length: int = 128) -> np.ndarray:
    """The state after each character, by chunk maps and a prefix scan over them."""
    n = len(kinds)
    chunks = -(-n // length)
    grid = np.zeros((chunks, length), "u1")
    grid.ravel()[:n] = kinds
    steps = np.ascontiguousarray(grid.T)
    flat, width = table.ravel(), table.shape[1]
    maps = np.broadcast_to(np.arange(width, dtype="u1"), (chunks, width))
    for k in range(length):
        maps = flat[steps[k][:, None].astype("u2") * width + maps]
    # Each map becomes the composition of itself with all maps before it.
    shift = 1
    while shift < chunks:
        maps = np.concatenate([maps[:shift], np.take_along_axis(maps[shift:], maps[:-shift], axis=1)])
        shift *= 2
    state = np.concatenate([[GAP], maps[:-1, GAP]]).astype("u1")
    out = np.empty((length, chunks), "u1")
    for k in range(length):
        state = flat[steps[k].astype("u2") * width + state]
        out[k] = state
    return out.T.ravel()[:n]


def starts(after: np.ndarray) -> np.ndarray:
    """Where pre-tokens start; the last state has to be GAP."""
    before = np.concatenate([[GAP], after[:-1]])
    ahead = np.concatenate([after[1:], [GAP]])
    pending = after >= QUOTE_R
    return (
        (after == WORD) & (before != WORD) & (before < QUOTE_R)
        | (after == DIGIT)
        | (after == MARKS) & (before != MARKS) & (before != QUOTE)
        | (after == QUOTE)
        | pending & (ahead != SHORT)
    )


def _byte_of() -> dict[str, int]:
    """The byte that each printable stand-in of a byte-level vocabulary means."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


Token = tuple[bytes, bool]


class WordCounter:
    """The second transducer.  Tokens are (bytes, whether they end a word)."""

    #: Mark of a last byte whose transition is not known yet.
    UNKNOWN = np.iinfo("i1").min

    def __init__(self, data: bytes, most: int = 50_000) -> None:
        model = json.loads(data)["model"]
        suffix, byte_of = model["end_of_word_suffix"], _byte_of()

        def token(x: str) -> Token:
            last = x.endswith(suffix)
            return bytes(byte_of[c] for c in (x.removesuffix(suffix) if last else x)), last

        self.ranks: dict[tuple[Token, Token], int] = {}
        for rank, pair in enumerate(model["merges"]):
            x, y = map(token, pair.split(" ") if isinstance(pair, str) else pair)
            self.ranks[x, y] = rank
        self.known = {(x[0] + y[0], y[1]) for x, y in self.ranks}
        self.known |= {(bytes([b]), last) for b in range(256) for last in (False, True)}
        self.prefixes = {t[:i] for t, last in self.known for i in range(len(t) + (not last))} | {b""}
        self.valid: dict[tuple[Token, Token], bool] = {}
        self.most = most
        self.reset()

    def reset(self) -> None:
        self.number: dict[tuple, int] = {}
        self.keys: list[tuple] = []
        self.next = np.full((256, 256), -1, "i4")
        self.gain = np.zeros((256, 256), "i1")
        self.last = np.full((256, 256), self.UNKNOWN, "i1")
        self._state((b"", ((None, 0),)))

    def _state(self, key: tuple) -> int:
        if key not in self.number:
            self.number[key] = len(self.keys)
            self.keys.append(key)
            if len(self.keys) > len(self.next):
                size = len(self.next)
                more = min(size, self.most - size) if size < self.most else 4096
                self.next = np.concatenate([self.next, np.full((more, 256), -1, "i4")])
                self.gain = np.concatenate([self.gain, np.zeros((more, 256), "i1")])
                self.last = np.concatenate([self.last, np.full((more, 256), self.UNKNOWN, "i1")])
        return self.number[key]

    def merged(self, parts: list[Token]) -> list[Token]:
        """The tokens that merging in order of rank, leftmost first, makes of ``parts``."""
        while len(parts) > 1:
            found = [(r, i) for i in range(len(parts) - 1) if (r := self.ranks.get((parts[i], parts[i + 1]))) is not None]
            if not found:
                break
            i = min(found)[1]
            x, y = parts[i], parts[i + 1]
            parts[i : i + 2] = [(x[0] + y[0], y[1])]
        return parts

    def _follows(self, x: Token, y: Token) -> bool:
        """Whether the encoding of both texts together is just the two tokens."""
        if (x, y) not in self.valid:
            if len(self.valid) > 150_000:
                self.valid.clear()
            atoms = [(bytes([b]), False) for b in x[0]] + [(bytes([b]), False) for b in y[0]]
            atoms[-1] = (atoms[-1][0], y[1])
            self.valid[x, y] = self.merged(atoms) == [x, y]
        return self.valid[x, y]

    def _step(self, key: tuple, byte: int, last: bool) -> tuple[tuple | None, int]:
        suffix, places = key
        text = suffix + bytes([byte])
        for n in range(1, len(text) + 1):
            token = (text[-n:], last)
            if token in self.known:
                before, count = places[n - 1]
                if before is None or self._follows(before, token):
                    break
        else:
            raise AssertionError("a single byte is always a token")
        gain = count + 1
        if last:
            return None, gain
        while text not in self.prefixes:
            text = text[1:]
        rest = tuple((t, c - gain) for t, c in places[: len(text)])
        return (text, ((token, 0), *rest)), gain

    def _fill(self, pairs: np.ndarray, last: bool) -> None:
        for pair in np.unique(pairs).tolist():
            state, byte = divmod(pair, 256)
            key, gain = self._step(self.keys[state], byte, last)
            if last:
                self.last[state, byte] = gain
            else:
                to = self._state(key)
                self.next[state, byte], self.gain[state, byte] = to, gain

    def count(self, data: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Tokens of each word, given as places in ``data``."""
        if len(self.keys) > self.most:
            self.reset()
        order = np.argsort(-length, kind="stable")
        first, length = first[order], length[order]
        state, total = np.zeros(len(order), "i8"), np.zeros(len(order), "i8")
        longest = int(length[0]) if len(length) else 0
        # Words with more than k bytes stand in front.
        longer = np.searchsorted(-length, -np.arange(longest + 1), side="left")
        for k in range(longest):
            on, end = int(longer[k + 1]), int(longer[k])
            pairs = state[:end] * 256 + data[first[:end] + k]
            if on < end:
                gain = self.last.ravel()[pairs[on:]]
                new = gain == self.UNKNOWN
                if new.any():
                    self._fill(pairs[on:][new], True)
                    gain = self.last.ravel()[pairs[on:]]
                total[on:end] += gain
            if on:
                to = self.next.ravel()[pairs[:on]]
                if (new := to < 0).any():
                    self._fill(pairs[:on][new], False)
                    to = self.next.ravel()[pairs[:on]]
                total[:on] += self.gain.ravel()[pairs[:on]]
                state[:on] = to
        out = np.empty_like(total)
        out[order] = total
        return out


class Counter:
    """Counts tokens of texts with the two transducers."""

    def __init__(self, data: bytes) -> None:
        self.kinds, self.table, self.words = classes(), transitions(), WordCounter(data)
        special = [t["content"] for t in json.loads(data)["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))) or r"(?!)")

    def segments(self, text: str, size: int = 1 << 20) -> Iterator[str]:
        """Normalised parts of the text between special strings, not longer than they need be."""
        for part in self.special.split(text):
            at = 0
            while at < len(part):
                gap = regex.search(r"\s", part, pos=at + size) if len(part) - at > size else None
                end = gap.start() if gap else len(part)
                yield self.normal(part[at:end])
                at = end

    @staticmethod
    def normal(text: str) -> str:
        if text.isascii():
            return text.lower()
        # Letters are lowered one by one: a final sigma is like any other.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def _counted(self, texts: list[str], owners: list[int], total: np.ndarray) -> None:
        whole = "\n".join(texts) + "\n"
        points = np.frombuffer(whole.encode("utf-32-le"), "u4")
        data = np.frombuffer(whole.encode(), "u1")
        after = states(self.kinds[points], self.table)
        width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        place = np.cumsum(width) - width
        begin = np.flatnonzero(starts(after))
        # A pre-token ends where the next one starts or a gap does.
        edge = np.concatenate([begin, np.flatnonzero((after == GAP))])
        edge.sort()
        end = edge[np.searchsorted(edge, begin, side="right")]
        first = place[begin]
        counts = self.words.count(data, first, place[end] - first)
        ends = runs(len(t) + 1 for t in texts)[1:]
        owner = np.asarray(owners)[np.searchsorted(ends, begin, side="right")]
        total += np.bincount(owner, counts, minlength=len(total)).astype("i8")

    def count(self, texts: Sequence[str | None]) -> np.ndarray:
        total, parts, owners, size = np.zeros(len(texts), "i8"), [], [], 0
        for i, text in enumerate(texts):
            if not text:
                continue
            total[i] += sum(1 for _ in self.special.finditer(text))
            for part in self.segments(text):
                parts.append(part)
                owners.append(i)
                size += len(part)
                if size > 1 << 20:
                    self._counted(parts, owners, total)
                    parts, owners, size = [], [], 0
        if parts:
            self._counted(parts, owners, total)
        return total


def count_tokens(df: DataFrame, tokenizer: str, *, text: str = "text", output: str = "n_tokens") -> DataFrame:
    """Add the number of tokens of each text."""
    model = Model(df.sparkSession, shipped(tokenizer), Counter)
    fields = [f for f in df.schema.fields if f.name != output]
    schema = T.StructType([*fields, T.StructField(output, T.LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = model.get()
        for batch in batches:
            for part in slices(batch, text):
                counts = counter.count(texts_of(part, text))
                yield with_columns(part, arrow, {output: pa.array(counts, pa.int64())})

    return df.mapInArrow(run, schema)
