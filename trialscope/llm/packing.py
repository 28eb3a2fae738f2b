"""Texts as token sequences of bounded size: dominance reduction, then best fit.

``pieces`` turns each text into ids and cuts those of long ones, so that every piece but a text's
first has the full size.  ``pack`` puts rows of given lengths together in as few sequences as it can:

* Only how many rows have which length matters, so the plan is made from the histogram of lengths, at
  most ``size`` numbers, however many rows there are.
* Reduction by dominance (Martello and Toth): for the longest length left, a sequence of one, two or
  three rows is fixed, for as many rows at once as there are, wherever no other set of rows that goes
  with such a row could be better: the set's members take up no less than what each alternative could
  put in their stead.  Fixed rows leave the instance, until no sequence can be fixed any more.
* The remaining rows go, longest first, each to the fullest sequence with room for it.
* A plan is a list of patterns (lengths, number of sequences).  Rows of one length are numbered in
  hashed buckets, whose counts are summed up, so that no length has to meet in one task, and a row's
  number says which sequence is its own.

Null texts count as empty and have the end id only.  Empty tables give no rows.  Rows that are equal,
null keys included, are rows of their own.  Columns named like an output are replaced; all others
pass through.  Lengths must be from 1 to ``size``; null lengths or others raise an error.
"""

from __future__ import annotations

import json
from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import Model, cut, shipped, slices, texts_of

#: Where every match of a byte-level pattern ends: before white space that follows something else.
_CHUNK = regex.compile(r"(?:\s*+\S++){1,20000}|\s++")
_LONG = 1 << 18


# --- tokens ---------------------------------------------------------------------------------------


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in vocabularies of byte-level tokenizers, and the byte.

    Printable Latin-1 characters stand for themselves, the other bytes are numbered from 256.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def read_tokenizer(data: bytes) -> dict:
    """Ranks and special ids of a byte-level tokenizer's JSON file whose merges stand in order of their ids.

    Other kinds of files raise an error.
    """
    file = json.loads(data)
    model, split = file["model"], file["pre_tokenizer"]
    plain = not any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
    if model["type"] != "BPE" or split["type"] != "ByteLevel" or split["add_prefix_space"] or file["normalizer"]:
        raise ValueError("not a byte-level tokenizer without prefix space and normalizer")
    special = {t["content"]: t["id"] for t in file["added_tokens"]}
    if not plain or any(t[x] for t in file["added_tokens"] for x in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("options of the tokenizer that are not supported")
    byte_of = byte_alphabet()
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [model["vocab"][a + b] for a, b in merges]
    if any(a >= b for a, b in zip(ids, ids[1:], strict=False)):
        raise ValueError("merges are not in the order of their ids")
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    return {"mergeable_ranks": ranks, "special_tokens": special}


def _encoding(model: tuple[bytes, str]) -> tiktoken.Encoding:
    data, pattern = model
    return tiktoken.Encoding("pieces", pat_str=pattern, **read_tokenizer(data))


def _ids(encoding: tiktoken.Encoding, text: str, end: int) -> np.ndarray:
    """Ids of a text and the end id.  A long text goes in parts, cut where every match ends."""
    parts = [text] if len(text) < _LONG else _CHUNK.findall(text)
    coded = [encoding.encode_to_numpy(x, allowed_special="all") for x in parts if x]
    return np.concatenate([*coded, [end]]).astype("<u4")


def pieces(
    df: DataFrame,
    vocabulary: str,
    pattern: str,
    end: int = 2,
    size: int = 1024,
    text: str = "text",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """One row per piece: the columns ``keep`` (default: all others), piece, start, length and packed ids.

    Ids are as the tokenizers library gives them without added special tokens; special strings in a
    text become their ids.  A text of more than ``size`` ids is cut so that only its first piece may
    be shorter.  ``pattern`` is the split pattern of the tokenizer's kind.
    """
    out = ["piece", "start", "length", "ids"]
    keep = [c for c in (df.columns if keep is None else keep) if c not in (*out, text)]
    own = [f for f in df.schema.fields if f.name in keep]
    numbers = [T.StructField(x, T.LongType()) for x in out[1:3]]
    schema = T.StructType(
        [*own, T.StructField("piece", T.IntegerType()), *numbers, T.StructField("ids", T.BinaryType())]
    )
    arrow = to_arrow_schema(schema)
    model = Model(df.sparkSession, (shipped(vocabulary), pattern), _encoding, keep=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = model.get()
        for batch in batches:
            for part in slices(batch, text):
                rows, starts, lengths, numbers, ids = [], [], [], [], []
                for row, value in enumerate(texts_of(part, text)):
                    coded = _ids(encoding, value or "", end)
                    first = (len(coded) - 1) % size + 1
                    edges = [0, *range(first, len(coded) + 1, size)]
                    for number, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                        rows.append(row)
                        numbers.append(number)
                        starts.append(a)
                        lengths.append(b - a)
                        ids.append(coded[a:b].tobytes())
                carried = part.select([f.name for f in own]).take(pa.array(rows, pa.int64()))
                new = [pa.array(numbers, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64())]
                arrays = [*carried.columns, *new, pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [a.cast(f.type) for a, f in zip(arrays, arrow, strict=True)], schema=arrow
                )

    return df.select(*[f"`{f.name}`" for f in own], f"`{text}`").mapInArrow(run, schema)


# --- the plan -------------------------------------------------------------------------------------

Pattern = tuple[int, tuple[int, ...]]


class _Left:
    """How many rows of each length are left, and questions about them."""

    def __init__(self, counts: Mapping[int, int]) -> None:
        self.count = {s: n for s, n in counts.items() if n > 0}
        self.sizes = sorted(self.count)

    def take(self, lengths: Sequence[int], times: int) -> None:
        for s in lengths:
            self.count[s] -= times
            if not self.count[s]:
                self.sizes.remove(s)

    def most(self, lengths: Sequence[int]) -> int:
        """How many sequences of these lengths there are rows for."""
        return min(self.count.get(s, 0) // lengths.count(s) for s in lengths)

    def largest(self, room: int, used: Sequence[int] = ()) -> int:
        """The largest length that fits, beside those in use; 0 if there is none."""
        i = bisect_left(self.sizes, room + 1) - 1
        while i >= 0:
            s = self.sizes[i]
            if self.count[s] > used.count(s):
                return s
            i -= 1
        return 0

    def smallest(self, n: int, used: Sequence[int]) -> list[int]:
        """The n smallest lengths, repeated as often as there are rows, beside those in use."""
        found: list[int] = []
        for s in self.sizes:
            found += [s] * min(n - len(found), self.count[s] - used.count(s))
            if len(found) == n:
                break
        return found


def dominating(left: _Left, size: int, s: int) -> tuple[int, ...] | None:
    """A set with length ``s`` that dominates every other feasible set with it, if up to three rows show it."""
    room = size - s
    k = left.largest(room, (s,))
    if not k:
        return (s,)
    if k == room:
        return (s, k)
    three = left.smallest(3, (s,))
    if len(three) < 2 or three[0] + three[1] > room:
        return (s, k)
    if len(three) == 3 and sum(three) <= room:
        return None
    # Only pairs compete.  {k} covers a pair that is no longer than k; {k, b} also one whose shorter
    # member is no longer than b, as its longer one is never longer than k.
    b = left.largest(room - k, (s, k))
    uncovered = best = 0
    for y in left.sizes:
        if 2 * y > room or left.count[y] <= (y == s):
            continue
        x = left.largest(room - y, (s, y))
        if x >= y:
            best = max(best, x + y)
            if y > b and x + y > k:
                uncovered += 1
    if best <= k:
        return (s, k)
    return (s, k, b) if b and not uncovered else None


def reduce_by_dominance(counts: Mapping[int, int], size: int) -> tuple[list[Pattern], dict[int, int]]:
    """Sequences fixed because they dominate, and how many rows of each length are left."""
    left, fixed = _Left(counts), []
    again = True
    while again:
        again = False
        for s in sorted(left.sizes, reverse=True):
            while left.count[s] and (chosen := dominating(left, size, s)):
                times = left.most(chosen)
                left.take(chosen, times)
                fixed.append((times, chosen))
                again = True
    return fixed, {s: left.count[s] for s in left.sizes}


def best_fit(counts: Mapping[int, int], size: int) -> list[Pattern]:
    """Rows from the longest to the shortest, each in the fullest sequence with room; equal ones at once."""
    open_: dict[int, list[list]] = {}
    rooms: list[int] = []

    def put(room: int, times: int, lengths: tuple[int, ...]) -> None:
        if room not in open_:
            open_[room] = []
            insort(rooms, room)
        open_[room].append([times, lengths])

    for s in sorted(counts, reverse=True):
        n = counts[s]
        while n:
            i = bisect_left(rooms, s)
            if i == len(rooms):
                room, times, lengths = size, n, ()
            else:
                room = rooms[i]
                times, lengths = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[i]
            # A sequence that got one such row is the fullest with room for the next.
            each = min(room // s, n)
            used = min(times, n // each)
            put(room - each * s, used, lengths + (s,) * each)
            if times > used and lengths:
                put(room, times - used, lengths)
            n -= used * each
    return [(times, lengths) for x in open_.values() for times, lengths in x]


def plan(counts: Mapping[int, int], size: int) -> list[Pattern]:
    """Patterns that hold exactly the given numbers of lengths, each within ``size``."""
    fixed, left = reduce_by_dominance(counts, size)
    return fixed + best_fit(left, size)


def _slots(patterns: Sequence[Pattern]) -> dict[str, np.ndarray]:
    """For each length, runs of its rows' numbers: ``first`` number, sequence of that one, offset there.

    Consecutive numbers of a run go to consecutive sequences.
    """
    slots, used, base = [], {}, 0
    for times, lengths in patterns:
        offset = 0
        for s in lengths:
            slots.append((s, used.get(s, 0), base, offset))
            used[s] = used.get(s, 0) + times
            offset += s
        base += times
    table = np.array(sorted(slots), "i8").reshape(-1, 4)
    edges = {int(s): (int(a), int(b)) for s, a, b in zip(*_spans(table[:, 0]), strict=True)}
    return {"edges": edges, "first": table[:, 1], "sequence": table[:, 2], "offset": table[:, 3]}


def _spans(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, "i8")
    return values[starts], starts, np.r_[starts[1:], len(values)][: len(starts)]


# --- the rows -------------------------------------------------------------------------------------


def numbered(df: DataFrame, group: str, order: Sequence[str], output: str, per_bucket: int = 100_000) -> DataFrame:
    """Add each row's number, from 0, among the rows of its group; ``order`` has to tell rows apart
    that are not equal.

    Groups are dealt to hashed buckets of about ``per_bucket`` rows of the whole table at most, numbered
    there, and the buckets' counts are summed up.  ``df`` is read three times.
    """
    buckets = max(64, -(-df.count() // per_bucket))
    bucket = F.pmod(F.xxhash64(*order), F.lit(buckets))
    dealt = df.withColumn("__bucket", bucket)
    sizes = dealt.groupBy(F.col(group).alias("__group"), F.col("__bucket").alias("__part")).agg(
        F.count("*").alias("__n")
    )
    before = Window.partitionBy("__group").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("__group", "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(group, "__bucket").orderBy(*order)
    dealt = dealt.withColumn("__inside", F.row_number().over(inside) - 1)
    joined = dealt.join(sizes, (F.col(group) == F.col("__group")) & (F.col("__bucket") == F.col("__part")))
    number = (F.col("__before") + F.col("__inside")).cast("long").alias(output)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns if c != output], number)


def pack(df: DataFrame, order: Sequence[str], length: str = "length", size: int = 1024) -> DataFrame:
    """Add ``sequence_id`` and ``offset``: rows of one sequence stand one after the other from 0.

    ``order`` names columns that tell rows apart that are not equal.
    """
    rows = cut(df.select(*[F.col(f"`{c}`") for c in df.columns if c not in ("sequence_id", "offset")]))
    counts = {s: n for s, n in rows.groupBy(length).count().collect()} if rows.columns else {}
    if any(s is None or not 0 < s <= size for s in counts):
        raise ValueError(f"lengths have to be from 1 to {size}")
    model = Model(df.sparkSession, _slots(plan(counts, size)), lambda x: x, keep=1)
    name = "__number"
    own = T.StructType(rows.schema.fields)
    schema = T.StructType(
        [*own.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    arrow = to_arrow_schema(schema)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = model.get()
        for batch in batches:
            lengths = batch.column(length).to_numpy(zero_copy_only=False)
            number = batch.column(name).to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(number), "i8"), np.zeros(len(number), "i8")
            for s in np.unique(lengths).tolist():
                a, b = slots["edges"][s]
                these = np.flatnonzero(lengths == s)
                at = a + np.searchsorted(slots["first"][a:b], number[these], "right") - 1
                sequence[these] = slots["sequence"][at] + number[these] - slots["first"][at]
                offset[these] = slots["offset"][at]
            carried = [batch.column(f.name) for f in own.fields]
            yield pa.RecordBatch.from_arrays([*carried, pa.array(sequence), pa.array(offset)], schema=arrow)

    return numbered(rows, length, order, name).mapInArrow(place, schema)
