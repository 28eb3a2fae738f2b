"""Byte-level BPE encoding and decoding.

A text is split by the tokenizer's pattern.  Pre-tokens that are in the vocabulary as a whole are
resolved by a minimal perfect hash, many at a time; the others are merged with a heap of candidate
pairs over a linked list of byte ranges, lowest rank first and leftmost among equals.

Null texts count as empty.  Empty texts have no ids.  Texts are worked on in pieces of bounded size,
cut only where the pattern always ends a match.  All other columns, repeated rows included, pass through; a column with the name of the output
is replaced.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator, Sequence
from functools import cached_property
from heapq import heapify, heappop, heappush
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import Model, shipped, slices, texts_of, with_columns, without_cycle_search
from .mph import MinimalPerfectHash

#: Where every match ends: before white space that follows something else.
_CHUNK = regex.compile(r"\s*+\S++|\s++")
#: White space inside which a space stands that is not the last of its run.
_WIDE = re.compile(r"\s \s|\s \Z|\A \s")


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks of a file with one base64 token and its rank per line."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


def chunked(text: str) -> tuple[str, list[str]]:
    """The text cut where every match ends: the first chunk, and the others."""
    if _WIDE.search(text):
        chunks = _CHUNK.findall(text)
    else:
        # Each space then either follows something else or ends a run of white space, and a match
        # starts there in both cases.
        chunks = text.replace(" ", "\0 ").split("\0") if "\0" not in text else _CHUNK.findall(text)
    return chunks[0], chunks[1:]


class Recent:
    """A dictionary of two generations: when the younger one has outgrown its bound, the older one goes.

    What is used again passes into the younger generation, so frequent keys stay.
    """

    def __init__(self, bound: int) -> None:
        self.bound, self.young, self.old = bound, {}, {}

    def missing(self, keys: set) -> list:
        """Keys of neither generation; the others are in the younger one from now on."""
        if len(self.young) > self.bound:
            self.old, self.young = self.young, {}
        new = keys - self.young.keys()
        known = new & self.old.keys()
        old, young = self.old, self.young
        for key in known:
            young[key] = old[key]
        return list(new - known)


class TokenBytes:
    """What ids stand for, as the decoding Python workers hold it."""

    def __init__(self, model: tuple[bytes, str]) -> None:
        ranks = read_ranks(model[0])
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.flat = np.frombuffer(b"".join(self.bytes_of), "u1")
        self.length_of = np.array([len(x) for x in self.bytes_of], "i8")
        self.start_of = np.cumsum(self.length_of) - self.length_of

    def decode(self, packed: bytes | None) -> bytes:
        return b"".join(self._decoded(packed[i : i + (4 << 20)]) for i in range(0, len(packed or b""), 4 << 20))

    def _decoded(self, packed: bytes) -> bytes:
        ids = np.frombuffer(packed, "<u4")
        lengths = self.length_of[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1])
        place = np.repeat(self.start_of[ids] - (ends - lengths), lengths) + np.arange(total, dtype="i8")
        return self.flat[place].tobytes()


class ByteBpe:
    """The tokenizer of one vocabulary, as the Python workers hold it.

    The pattern has to end every match before white space that follows something else; the ids of
    what stands between two such places are remembered, up to ``memory`` of them.
    """

    def __init__(self, model: tuple[bytes, str], memory: int = 280_000) -> None:
        data, pattern = model
        self.model = model
        self.ranks = read_ranks(data)
        self.split = regex.compile(pattern).findall
        self.whole = MinimalPerfectHash(list(self.ranks))
        self.whole_ids = np.array([self.ranks[k] for k in self.whole.keys], "<u4")
        self.byte_ids = [self.ranks[bytes([i])] for i in range(256)]
        # right[x][y]: what x and y merge to, which is also the merge's rank.
        self.right: list[dict[int, int]] = [{} for _ in range(max(self.ranks.values(), default=-1) + 1)]
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                if (x := self.ranks.get(token[:i])) is not None:
                    if (y := self.ranks.get(token[i:])) is not None:
                        self.right[x][y] = rank
        self.chunks, self.words = Recent(memory // 2), Recent(memory // 4)

    def merged(self, word: bytes) -> list[int]:
        """Ids of a pre-token that is not in the vocabulary as a whole."""
        # Ranges of bytes are known by their first byte: ids[i] is the range's id, after[i] the start
        # of the next one, before[i] of the one in front, joint[i] the rank of merging it with the
        # next (-1: none).  A heap entry whose rank is no longer its range's is out of date.  Entries
        # hold rank and start, as small integers for all but very long words.
        n, right = len(word), self.right
        shift = 12 if n < 4096 else 32
        mask = (1 << shift) - 1
        byte_ids = self.byte_ids
        ids = [byte_ids[b] for b in word]
        joint = [right[x].get(y, -1) for x, y in pairwise(ids)]
        heap = [r << shift | i for i, r in enumerate(joint) if r >= 0]
        if not heap:
            return ids
        joint.append(-1)
        heapify(heap)
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        while heap:
            entry = heappop(heap)
            a = entry & mask
            rank = entry >> shift
            if joint[a] != rank:
                continue
            b = after[a]
            after[a] = c = after[b]
            ids[a] = rank
            joint[b] = -1
            if c < n:
                before[c] = a
                joint[a] = r = right[rank].get(ids[c], -1)
                if r >= 0:
                    heappush(heap, r << shift | a)
            else:
                joint[a] = -1
            if a:
                p = before[a]
                joint[p] = r = right[ids[p]].get(rank, -1)
                if r >= 0:
                    heappush(heap, r << shift | p)
        out, a = [], 0
        while a < n:
            out.append(ids[a])
            a = after[a]
        return out

    def learn(self, words: Sequence[str]) -> None:
        """Remember the ids of pre-tokens."""
        coded = [w.encode() for w in words]
        places = self.whole.find(coded)
        known = np.where(places >= 0, self.whole_ids[places], 0).astype("<u4").tobytes()
        ids_of = self.words.young
        for i, place in enumerate(places.tolist()):
            ids = known[4 * i : 4 * i + 4] if place >= 0 else array("I", self.merged(coded[i])).tobytes()
            ids_of[words[i]] = ids

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut = [chunked(t) if t else ("", ()) for t in texts]
        new = self.chunks.missing(set().union((c[0] for c in cut), *(c[1] for c in cut)))
        split = [self.split(c) for c in new]
        self.learn(self.words.missing(set().union(*split)))
        ids, chunks = self.words.young.__getitem__, self.chunks.young
        for chunk, words in zip(new, split, strict=True):
            chunks[chunk] = b"".join(map(ids, words))
        ids = chunks.__getitem__
        return [ids(first) + b"".join(map(ids, rest)) for first, rest in cut]

    @cached_property
    def table(self) -> TokenBytes:
        return TokenBytes(self.model)

    def decode(self, packed: bytes | None) -> bytes:
        return self.table.decode(packed)


def _carried(df: DataFrame, keep: Sequence[str] | None, *fields: T.StructField) -> tuple[list[str], T.StructType]:
    """The columns that pass through, and the schema of the result; columns named like new ones do not."""
    names = {f.name for f in fields}
    own = [f for f in df.schema.fields if f.name not in names and (keep is None or f.name in keep)]
    return [f.name for f in own], T.StructType(own + list(fields))


def encode(
    df: DataFrame,
    vocabulary: str,
    pattern: str,
    text: str = "text",
    output: str = "ids",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add the ids of each text, packed as little-endian unsigned 32-bit integers, and ``n_tokens``.

    Only the columns ``keep`` pass through, if given; texts that are not needed any more should not.
    """
    model = Model(df.sparkSession, (shipped(vocabulary), pattern), ByteBpe, keep=2)
    new = T.StructField(output, T.BinaryType()), T.StructField("n_tokens", T.LongType())
    own, schema = _carried(df, keep, *new)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = model.get()
        for batch in batches:
            for part in slices(batch, text):
                with without_cycle_search():
                    ids = tokenizer.encode(texts_of(part, text))
                counts = pa.array([len(x) // 4 for x in ids], pa.int64())
                yield with_columns(part, arrow, {output: pa.array(ids, pa.binary()), "n_tokens": counts})

    return df.select(*[f"`{c}`" for c in dict.fromkeys([*own, text])]).mapInArrow(run, schema)


def decode(
    df: DataFrame,
    vocabulary: str,
    pattern: str,
    ids: str = "ids",
    output: str = "decoded",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add the bytes that packed ids stand for; null ids give no bytes."""
    model = Model(df.sparkSession, (shipped(vocabulary), pattern), TokenBytes, keep=2)
    own, schema = _carried(df, keep, T.StructField(output, T.BinaryType()))
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.get()
        for batch in batches:
            for part in slices(batch, ids, 8 << 20):
                out = pa.array([table.decode(x) for x in texts_of(part, ids)], pa.binary())
                yield with_columns(part, arrow, {output: out})

    return df.select(*[f"`{c}`" for c in dict.fromkeys([*own, ids])]).mapInArrow(run, schema)
