"""Periodic runs of words, found on a grammar of each text, and texts without their repetitions.

Re-Pair replaces the most frequent pair of neighbouring symbols by a new symbol until no pair occurs
twice; what is left is the top sequence.  A run lies across the border between the two halves of
exactly one node of the derivation it is contained in, so runs are looked for once per rule, at the
border of its halves, and at the borders of the top sequence, halved like a balanced tree.  What a
rule holds is then carried to all places it derives, and only intervals that no other one of their
period contains are kept.

At a border, a run of four periods has two of them on one side: a square that starts (or ends)
there, which the Z function of that side shows.  A border is looked at only if it lies in a stretch
of words whose pairs all occur at least three times, as all pairs inside a run do.

A run is a stretch of words with smallest period q and length ``max(6, 4 * q)`` or more that no
neighbouring word extends.  Null texts have no words, and neither runs nor a word left; empty texts
too.  Rows are worked on one by one, so repeated rows, ties and null keys stay as they are.  A text
is one unit of work: memory is in proportion to the longest text.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator, Sequence
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import slices

#: Least length of a run in words, and in periods.
LEAST, PERIODS = 6, 4

RUNS = T.ArrayType(
    T.StructType([T.StructField(x, T.LongType(), False) for x in ("start", "length", "period")]), False
)

Run = tuple[int, int, int]


class Grammar:
    """Re-Pair over numbers: ``halves`` of each new symbol, its ``size``, a place it stands at, and the top.

    Among equally frequent pairs the oldest goes first, which pairs a long repeated stretch level by
    level, so that its rules are about as deep as the logarithm of its length.
    """

    def __init__(self, ids: Sequence[int], first_new: int, counts: Counter) -> None:
        n = len(ids)
        symbol, after, before = list(ids), list(range(1, n + 1)), list(range(-1, n - 1))
        places: dict[tuple[int, int], list[int]] = defaultdict(list)
        frequent = {pair for pair, count in counts.items() if count > 1}
        for i, pair in enumerate(zip(ids, ids[1:], strict=False)):
            if pair in frequent:
                places[pair].append(i)
        queue = [(-len(at), age, pair) for age, (pair, at) in enumerate(places.items())]
        heapify(queue)
        age = len(queue)
        self.first_new, self.halves, self.size, self.place = first_new, [], [], []
        while queue:
            count, _, pair = heappop(queue)
            left, right = pair
            standing, end = [], -1
            for i in places[pair]:
                # A pair of equal symbols may overlap the one before it.
                if symbol[i] == left and i >= end and (j := after[i]) < n and symbol[j] == right:
                    standing.append(i)
                    end = after[j]
            if len(standing) < 2:
                continue
            if len(standing) < -count:
                places[pair] = standing
                heappush(queue, (-len(standing), age, pair))
                age += 1
                continue
            new = first_new + len(self.halves)
            self.halves.append(pair)
            self.size.append(self.length(left) + self.length(right))
            self.place.append(standing[0])
            made = defaultdict(list)
            for i in standing:
                j = after[i]
                after[i] = k = after[j]
                symbol[i], symbol[j] = new, -1
                if (p := before[i]) >= 0:
                    made[symbol[p], new].append(p)
                if k < n:
                    before[k] = i
                    made[new, symbol[k]].append(i)
            for pair, at in made.items():
                if len(at) > 1:
                    places[pair] = at
                    heappush(queue, (-len(at), age, pair))
                    age += 1
        self.top: list[tuple[int, int]] = []
        i = 0
        while i < n:
            self.top.append((i, symbol[i]))
            i = after[i]

    def length(self, symbol: int) -> int:
        return 1 if symbol < self.first_new else self.size[symbol - self.first_new]


def z_values(s: Sequence[int], most: int) -> list[int]:
    """For each q up to ``most``: how far s goes on like itself from q."""
    n, z, left, right = len(s), [0] * (most + 1), 0, 0
    for q in range(1, most + 1):
        k = min(right - q, z[q - left]) if q < right else 0
        if q + k >= right:
            while q + k < n and s[k] == s[q + k]:
                k += 1
            left, right = q, q + k
        z[q] = k
    return z


def _squares(s: Sequence[int]) -> list[tuple[int, int]]:
    """(period, reach) of the squares s starts with; multiples of a shorter period are left out."""
    most, found = len(s) // 2, []
    if not most:
        return found
    for q, k in enumerate(z_values(s, most)):
        if q and k >= q and not any(q % p == 0 and reach >= 2 * q for p, reach in found):
            found.append((q, q + k))
    return found


def runs_across(ids: Sequence[int], start: int, border: int, end: int) -> list[Run]:
    """Runs of ids[start:end] that go across ``border``, as (start, end, period)."""
    found: dict[tuple[int, int], int] = {}
    for q, reach in _squares(ids[border:end]):
        a = border
        while a > start and ids[a - 1] == ids[a - 1 + q]:
            a -= 1
        b = border + reach
        if a < border and b - a >= max(LEAST, PERIODS * q):
            found[a, b] = min(q, found.get((a, b), q))
    for q, reach in _squares(ids[start:border][::-1]):
        b = border
        while b < end and ids[b] == ids[b - q]:
            b += 1
        a = border - reach
        if b > border and b - a >= max(LEAST, PERIODS * q):
            found[a, b] = min(q, found.get((a, b), q))
    return [(a, b, q) for (a, b), q in found.items()]


def repeated_borders(ids: Sequence[int], counts: Counter) -> bytearray:
    """1 at each border (named by the word behind it) that a run may go across, 0 elsewhere."""
    mark, start = bytearray(len(ids) + 1), None
    often = [counts[pair] >= PERIODS - 1 for pair in zip(ids, ids[1:], strict=False)]
    for i, yes in enumerate([*often, False]):
        if yes and start is None:
            start = i
        elif not yes and start is not None:
            if i - start >= LEAST - 1:
                mark[start + 1 : i + 1] = b"\1" * (i - start)
            start = None
    return mark


def find(words: Sequence[bytes]) -> list[Run]:
    """All runs of a sequence of words as (start, length, period), by start, then period."""
    if len(words) < 2:
        return []
    number: dict[bytes, int] = {}
    ids = [number.setdefault(w, len(number)) for w in words]
    counts = Counter(zip(ids, ids[1:], strict=False))
    grammar = Grammar(ids, len(number), counts)
    borders = repeated_borders(ids, counts)
    if 1 not in borders:
        return []

    # Runs of each rule, relative to where it starts; rules come after the rules they are made of.
    first_new, size = grammar.first_new, grammar.size
    own: list[list[Run]] = []
    holds: list[bool] = []
    for (left, right), n, at in zip(grammar.halves, size, grammar.place, strict=True):
        border = at + grammar.length(left)
        here = n >= LEAST and borders[border]
        own.append([(a - at, b - at, q) for a, b, q in runs_across(ids, at, border, at + n)] if here else [])
        holds.append(bool(own[-1]) or any(x >= first_new and holds[x - first_new] for x in (left, right)))

    found: list[Run] = []
    todo = [(at, x) for at, x in grammar.top if x >= first_new and holds[x - first_new]]
    while todo:
        at, x = todo.pop()
        x -= first_new
        found += [(at + a, at + b, q) for a, b, q in own[x]]
        left, right = grammar.halves[x]
        if right >= first_new and holds[right - first_new]:
            todo.append((at + grammar.length(left), right))
        if left >= first_new and holds[left - first_new]:
            todo.append((at, left))

    # The top sequence, where only stretches between borders that no run goes across are halved.
    starts = [at for at, _ in grammar.top] + [len(ids)]
    cuts = [i for i, at in enumerate(starts) if not borders[at]]
    halve = [(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if b - a > 1]
    while halve:
        a, b = halve.pop()
        middle = (a + b) // 2
        found += runs_across(ids, starts[a], starts[middle], starts[b])
        halve += [(x, y) for x, y in ((a, middle), (middle, b)) if y - x > 1]
    return _merged(found)


def _merged(found: list[Run]) -> list[Run]:
    """Intervals of one period that lie in another one of it go, as do longer periods of the same interval."""
    kept: dict[tuple[int, int], int] = {}
    period, reach = 0, 0
    for q, a, minus_b in sorted((q, a, -b) for a, b, q in found):
        if q != period:
            period, reach = q, -1
        if -minus_b > reach:
            reach = -minus_b
            kept.setdefault((a, reach), q)
    return sorted((a, b - a, q) for (a, b), q in kept.items())


def collapsed(words: Sequence[bytes], runs: Sequence[Run]) -> bytes:
    """The words that no run holds after its first period, joined by spaces."""
    if not runs:
        return b" ".join(words)
    gone = bytearray(len(words))
    for start, length, period in runs:
        gone[start + period : start + length] = b"\1" * (length - period)
    return b" ".join(w for w, x in zip(words, gone, strict=True) if not x)


def find_runs(
    df: DataFrame,
    text: str = "text",
    keep: Sequence[str] | None = None,
    runs: str = "runs",
    output: str = "collapsed",
    rewrite: Callable[[dict, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """The columns ``keep`` (default: all others), ``runs`` as (start, length, period), and ``output``, the text collapsed.

    Words are what stands between ASCII white space.  ``rewrite``, if given, gets the kept columns of
    a row and its words, and returns the words to look at.  Kept columns named like an output are
    replaced by it.
    """
    keep = [c for c in (df.columns if keep is None else keep) if c not in (runs, output, text)]
    own = [f for f in df.schema.fields if f.name in keep]
    schema = T.StructType([*own, T.StructField(runs, RUNS), T.StructField(output, T.StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                texts = part.column(text).cast(pa.binary()).to_pylist()
                rows = part.select([f.name for f in own])
                given = rows.to_pylist() if rewrite else [{}] * len(texts)
                all_runs, all_left = [], []
                for row, data in zip(given, texts, strict=True):
                    words = (data or b"").split()
                    if rewrite:
                        words = rewrite(row, words)
                    found = find(words)
                    all_runs.append([dict(zip(("start", "length", "period"), x, strict=True)) for x in found])
                    all_left.append(collapsed(words, found))
                new = [
                    pa.array(all_runs, arrow.field(runs).type),
                    pa.array(all_left, pa.binary()).cast(arrow.field(output).type),
                ]
                yield pa.RecordBatch.from_arrays([*rows.columns, *new], schema=arrow)

    return df.select(*[f"`{f.name}`" for f in own], f"`{text}`").mapInArrow(run, schema)
