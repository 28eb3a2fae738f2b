"""Phrases whose words stand together more often than their parts would, counted in suffix subtrees.

The counting follows ERA, an index construction that cuts the suffix tree of a text into subtrees
by prefix, each small enough for memory:

1. *Frequencies of prefixes.* One pass counts the words of each language.  A prefix that is rarer
   than a phrase has to be is dropped, and so is what follows it.
2. *Vertical partitioning.* Words with more suffixes than the memory budget are extended by their
   next word, and pairs still above it by their third: such prefixes get subtrees of their own.
   All prefixes are hashed to slots, and neighbouring slots are put together to groups as long as
   the sum of their frequencies stays within the budget.
3. *Subtrees.* A second pass sends each suffix, cut after the longest phrase's number of words, to
   its prefix's group, equal ones of a batch once with their number.  Each group is one task's
   work on its own: suffixes are sorted, which puts every node of the truncated subtree in one
   stretch, and a node's frequency is the total of the leaves below it.

Words are lower-cased in A-Z; pieces of a text are split at ``.,;:!?`` and line ends, words at blanks
and tabs.  Everything is per language; a null language is ``und``.  Null and empty texts, and a table
without rows, give nothing.  Repeated rows count each.  Other columns are not read, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Model, cut, slices

_END = 0xFF  # never part of UTF-8
_TABLE = bytes(
    _END if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
#: Words gathered in a task before equal suffixes are put together, and bytes of text split at once.
_GATHER, _PIECE = 500_000, 1 << 20
_SLOT_BITS = 20


class _Numbers(dict):
    """Words by first appearance; -1 is the end of a piece."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self) - 1
        return number


class _Gathered:
    """The texts of one language as numbers of words."""

    def __init__(self) -> None:
        self.numbers, self.parts, self.texts, self.size = _Numbers({b"\xff": -1}), [], [], 0

    def add(self, text: bytes) -> int:
        """Take a text; returns how many words have been numbered for it."""
        self.texts.append(text)
        self.size += len(text)
        return self.split() if self.size > _PIECE else 0

    def split(self) -> int:
        data = b"\xff".join([*self.texts, b""]).translate(_TABLE).replace(b"\xff", b" \xff ").split()
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, data), "i4", len(data)))
        self.texts, self.size = [], 0
        return len(data)

    def whole(self) -> tuple[list[bytes], np.ndarray]:
        self.split()
        self.numbers.pop(b"\xff")
        return list(self.numbers), np.concatenate(self.parts)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """(language, distinct words, numbers of the words of all texts in order), -1 where a piece ends."""
    langs: dict[str, _Gathered] = {}
    words = 0
    for batch in batches:
        for part in slices(batch, batch.schema.names[1]):
            names = part.column(0).to_pylist()
            for lang, text in zip(names, part.column(1).cast(pa.binary()).to_pylist(), strict=True):
                if text:
                    words += langs.setdefault("und" if lang is None else lang, _Gathered()).add(text)
            if words > _GATHER:
                yield from _flushed(langs)
                words = 0
    yield from _flushed(langs)


def _flushed(langs: dict[str, _Gathered]) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    while langs:
        lang, gathered = langs.popitem()
        yield lang, *gathered.whole()


def _hashes(lang: str, words: Sequence[bytes]) -> np.ndarray:
    salt = xxhash.xxh64_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, salt) for w in words), "u8", len(words))


def count_words(df: DataFrame) -> DataFrame:
    """lang, phrase (one word), a: of a table with the columns lang and text."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("h", pa.int64()), ("a", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, ids in _segments(batches):
            if not words:
                continue
            counts = np.bincount(ids[ids >= 0], minlength=len(words))
            hashes = _hashes(lang, words).view("i8")
            table = [pa.repeat(lang, len(words)), pa.array(words, pa.binary()).cast(pa.string())]
            whole = pa.RecordBatch.from_arrays([*table, pa.array(hashes), pa.array(counts)], schema=schema)
            for i in range(0, len(words), 50_000):
                yield whole.slice(i, 50_000)

    return (
        df.mapInArrow(run, "lang string, phrase string, h bigint, a bigint")
        .groupBy("lang", "phrase")
        .agg(F.first("h").alias("h"), F.sum("a").alias("a"))
    )


# --- vertical partitioning ------------------------------------------------------------------------


def _slot(h: Column | np.ndarray):
    """The slot of a 64-bit hash: its highest bits."""
    if isinstance(h, Column):
        return F.shiftrightunsigned(h, 64 - _SLOT_BITS)
    return (h >> np.uint64(64 - _SLOT_BITS)).astype("i8")


def _mixed(h: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Hashes of prefixes that go on by one word."""
    x = h * np.uint64(0x9E3779B97F4A7C15) + by
    x ^= x >> np.uint64(29)
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _heavy(counted: DataFrame, budget: int) -> np.ndarray:
    """Hashes of prefixes above the budget: no more of them than all frequencies have budgets in them."""
    found = counted.where(F.col("a") > budget).select("h").distinct().toArrow()["h"].to_numpy()
    return np.sort(found.view("u8"))


def _groups(loads: DataFrame, budget: int) -> np.ndarray:
    """The group of each slot; loads: slot, a.  Neighbouring slots share a group within the budget."""
    table = loads.toArrow()
    load = np.zeros(1 << _SLOT_BITS, "i8")
    load[table["slot"].to_numpy()] = table["a"].to_numpy()
    ends = np.cumsum(load)
    group, start, number = np.zeros(len(load), "i4"), 0, 0
    while start < len(load):
        base = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, base + budget, "right")))
        group[start:end] = number
        start, number = end, number + 1
    return group


def _in(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def _bitmap(frequent: DataFrame, most_bits: int = 27) -> np.ndarray:
    """A bitmap of the hashes of frequent words, about 16 bits for each up to ``2 ** most_bits`` in all.

    Words that are in it by chance cost room in a subtree, where their counts are exact.
    """
    bits = min(most_bits, max(10, (16 * frequent.count()).bit_length()))
    place = F.shiftrightunsigned("h", 64 - bits)
    rows = frequent.groupBy(F.shiftrightunsigned(place, 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - bits}) & 63 AS int))")).alias("set")
    )
    table = rows.toArrow()
    out = np.zeros(1 << (bits - 6), "u8")
    out[table["word"].to_numpy()] = table["set"].to_numpy().view("u8")
    return out


def _may_be_frequent(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    place = h >> np.uint64(64 - (len(bitmap).bit_length() - 1 + 6))
    return (bitmap[(place >> np.uint64(6)).astype("i8")] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def _next(ids: np.ndarray, by: int, last: np.ndarray) -> np.ndarray:
    """For each place, the number of the word ``by`` places on, -1 where ``last`` holds -1."""
    out = np.full(len(ids), -1, ids.dtype)
    out[: len(ids) - by] = ids[by:]
    out[last < 0] = -1
    return out


def _pairs_of_heavy(df: DataFrame, bitmap: Model, heavy: Model) -> DataFrame:
    """h, slot and a of the pairs that start with words above the budget."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, ids in _segments(batches):
            if not words:
                continue
            h = _hashes(lang, words)
            long_, may = _in(h, heavy.get()), _may_be_frequent(bitmap.get(), h)
            at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
            at = at[long_[ids[at]] & may[ids[at + 1]]]
            both, counts = np.unique(_mixed(h[ids[at]], h[ids[at + 1]]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(both.view("i8")), pa.array(counts.astype("i8"))], ["h", "a"])

    return df.mapInArrow(run, "h bigint, a bigint").groupBy("h").agg(F.sum("a").alias("a"))


# --- subtrees -------------------------------------------------------------------------------------


def _suffixes(df: DataFrame, depth: int, plan: Model, bitmap: Model) -> DataFrame:
    """Suffixes of at most ``depth`` words, equal ones of a batch once: one row per batch, group and first
    word, with what follows the word (lines of words joined by spaces), the packed counts of these lines,
    and the depth from which nodes are counted in that group."""
    texts = [("lang", pa.string()), ("word", pa.string()), ("rest", pa.string())]
    schema = pa.schema([("group", pa.int32()), *texts, ("counts", pa.binary()), ("depth", pa.int8())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group_of, heavy, heavy_pairs = plan.get()
        for lang, words, ids in _segments(batches):
            if not words or len(ids) < 2:
                continue
            h = _hashes(lang, words)
            ids[(ids >= 0) & ~np.append(_may_be_frequent(bitmap.get(), h), False)[ids]] = -1
            parts = [ids]
            for by in range(1, depth):
                parts.append(_next(ids, by, parts[-1]))
            # A suffix of one word tells nothing that the counts of words do not.
            at = np.flatnonzero((parts[0] >= 0) & (parts[1] >= 0))
            parts = [p[at] for p in parts]
            code, bound = parts[0].astype("i8"), len(words)
            for p in parts[1:]:
                if bound > (1 << 62) // (len(words) + 1):
                    code = np.unique(code, return_inverse=True)[1]
                    bound = len(code)
                code = code * (len(words) + 1) + p + 1
                bound *= len(words) + 1
            order = np.argsort(code)
            code = code[order]
            starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.zeros(0, "i8")
            first, counts = order[starts], np.diff(np.r_[starts, len(code)])
            del code, at, order
            parts = [p[first] for p in parts]
            prefix = h[parts[0]]
            extend = _in(prefix, heavy)
            for by, table in ((1, heavy_pairs), (2, None)):
                if not extend.any() or by >= depth:
                    break
                goes_on = extend & (parts[by] >= 0)
                prefix[goes_on] = _mixed(prefix[goes_on], h[parts[by][goes_on]])
                extend = goes_on & _in(prefix, table) if table is not None else goes_on
            # What a pair above the budget is extended to counts from the third word on there, and is
            # counted as the pair alone, in a few rows of each batch, in the pair's own group.
            spread = np.flatnonzero(extend)
            group, least_depth = group_of[_slot(prefix)], np.where(extend, 3, 2).astype("i1")
            if len(spread):
                pairs, place = np.unique(
                    parts[0][spread].astype("i8") * len(words) + parts[1][spread], return_inverse=True
                )
                sums = np.bincount(place, counts[spread], len(pairs)).astype("i8")
                head = [pairs // len(words), pairs % len(words)]
                own = group_of[_slot(_mixed(h[head[0]], h[head[1]]))]
                none = np.full(len(pairs), -1)
                parts = [np.r_[p, x] for p, x in zip(parts, [*head, *[none] * (depth - 2)], strict=True)]
                group, counts = np.r_[group, own], np.r_[counts, sums]
                least_depth = np.r_[least_depth, np.full(len(pairs), 2, "i1")]
            # Suffixes of one first word go together to its group, as one row.
            order = np.lexsort((parts[0], least_depth, group))
            key = np.stack([group[order], least_depth[order], parts[0][order]])
            new = np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(0)]) if len(order) else order
            key, ends = key[:, new], np.r_[new[1:], len(order)]
            strings = pa.array(words, pa.binary()).cast(pa.string())
            for i in range(0, len(new), 4_000):
                some = order[new[i] : ends[min(i + 4_000, len(new)) - 1]]
                columns = [strings.take(pa.array(p[some], mask=p[some] < 0)) for p in parts[1:]]
                joined = pc.binary_join_element_wise(*columns, " ", null_handling="skip")
                edges = np.r_[new[i : i + 4_000], ends[min(i + 4_000, len(new)) - 1]] - new[i]
                rest = pc.binary_join(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), joined), "\n")
                numbers = counts[some].astype("<i4").tobytes()
                first = [int(e) for e in 4 * edges]
                packed = [numbers[x:y] for x, y in zip(first, first[1:], strict=False)]
                kinds = key[:, i : i + 4_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(kinds[0], pa.int32()),
                        pa.repeat(lang, len(rest)),
                        strings.take(pa.array(kinds[2])),
                        rest,
                        pa.array(packed, pa.binary()),
                        pa.array(kinds[1], pa.int8()),
                    ],
                    schema=schema,
                )

    return df.mapInArrow(run, "group int, lang string, word string, rest string, counts binary, depth tinyint")


def _subtree(leaves: pa.Table, depth: int, least: int) -> Iterator[pa.Table]:
    """Nodes of two words and more of a truncated suffix subtree that at least ``least`` suffixes go through."""
    lines = pc.split_pattern(leaves["rest"].combine_chunks(), "\n")
    row = np.repeat(np.arange(len(lines)), pc.list_value_length(lines).to_numpy())
    lists = pc.split_pattern(pc.list_flatten(lines), " ")
    lengths = pc.list_value_length(lists).to_numpy()
    coded = pc.list_flatten(lists).dictionary_encode()
    first = leaves["word"].combine_chunks().dictionary_encode()
    langs = leaves["lang"].combine_chunks().dictionary_encode()
    words = np.full((len(row), depth), -1, "i4")
    words[:, 0] = first.indices.to_numpy()[row]
    words[:, 1:][np.arange(depth - 1) < lengths[:, None]] = coded.indices.to_numpy()
    lang = langs.indices.to_numpy()[row]
    counted = np.frombuffer(b"".join(leaves["counts"].to_pylist()), "<i4").astype("i8")
    from_ = leaves["depth"].to_numpy()[row]
    # Sorted suffixes: each node is a stretch of leaves that agree in their first words.
    order = np.lexsort((*words.T[::-1], lang))
    words, lang, counted, from_ = words[order], lang[order], counted[order], from_[order]
    new = np.r_[True, lang[1:] != lang[:-1]]
    for k in range(depth):
        new = new | np.r_[True, words[1:, k] != words[:-1, k]]
        if not k:
            continue
        starts = np.flatnonzero(new)
        totals = np.r_[0, np.cumsum(np.where(from_ <= k + 1, counted, 0))]
        counts = totals[np.r_[starts[1:], len(words)]] - totals[starts]
        starts, counts = starts[counts >= least], counts[counts >= least]
        real = words[starts, k] >= 0
        starts, counts = starts[real], counts[real]
        columns = [first.dictionary.take(pa.array(words[starts, 0]))]
        columns += [coded.dictionary.take(pa.array(words[starts, j])) for j in range(1, k + 1)]
        yield pa.table(
            {
                "lang": langs.dictionary.take(pa.array(lang[starts])),
                "phrase": pc.binary_join_element_wise(*columns, " "),
                "words": pa.array(np.full(len(starts), k + 1, "i4")),
                "a": pa.array(counts),
            }
        )


def count_phrases(
    df: DataFrame, words: DataFrame, longest: int = 3, least: int = 10, budget: int = 500_000, groups: int = 256
) -> DataFrame:
    """lang, phrase, words (their number), a: of phrases of 2 to ``longest`` words that occur ``least`` times.

    ``words`` holds the counts of words.  ``budget`` is the number of suffixes that a group of subtrees may
    have; it is less where that makes fewer than ``groups`` groups for the cores to work on, but not
    under 10,000 for their sake.
    """
    if longest < 2:
        raise ValueError("phrases have two words at least")
    spark = df.sparkSession
    whole = words.agg(F.sum("a")).first()[0] or 0
    budget = min(budget, max(10_000, whole // groups))
    frequent = words.where(F.col("a") >= least)
    bitmap_bits = _bitmap(frequent)
    bitmap = Model(spark, bitmap_bits, lambda x: x, keep=3)
    heavy = _heavy(frequent, budget)
    heavy_pairs = np.zeros(0, "u8")
    loads = frequent.where(F.col("a") <= budget).select("h", "a")
    if len(heavy):
        pairs = cut(_pairs_of_heavy(df, bitmap, Model(spark, heavy, lambda x: x, keep=3)))
        heavy_pairs = _heavy(pairs, budget) if longest > 2 else heavy_pairs
        # Pairs above the budget are spread over all slots by their third word.
        loads = loads.union(pairs.where(F.col("a") <= budget).select("h", "a"))
    by_slot = loads.groupBy(_slot(F.col("h")).alias("slot")).agg(F.sum("a").alias("a"))
    groups = _groups(by_slot, budget)
    plan = Model(spark, (groups, heavy, heavy_pairs), lambda x: x, keep=3)
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("a", pa.int64())])

    def build(leaves: pa.Table) -> pa.Table:
        return pa.concat_tables(t.cast(schema) for t in _subtree(leaves, longest, least))

    return (
        _suffixes(df, longest, plan, bitmap)
        .groupBy("group")
        .applyInArrow(build, "lang string, phrase string, words int, a bigint")
    )


# --- collocations ---------------------------------------------------------------------------------


def _floor_score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)) of counts under 10 ** 14, in exact decimals."""

    def number(c: str) -> Column:
        return F.col(c).cast("decimal(14,0)")

    above = number(a) * number(a) * F.lit(1_000_000).cast("decimal(7,0)")
    below = number(left) * number(right)
    return ((above - above % below) / below).cast("long")


def collocations(
    df: DataFrame,
    lang: str = "lang",
    text: str = "text",
    longest: int = 3,
    least: int = 10,
    cover: int = 50,
    top: int | None = 2000,
    budget: int = 500_000,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the phrases whose words hold together best in each language.

    Candidates are the phrases of 2 to ``longest`` words that occur at least ``least`` times (a).  Cut
    in two, a candidate scores floor(1000000 * a * a / (l * r)) for l and r occurrences of the parts;
    its lowest-scoring cut counts, the first of equal ones.  A candidate whose words lie in a longer one
    that occurs in ``cover`` percent of its places or more is dropped.  The rest is ranked by score, a
    and phrase; ``top`` of each language are returned (None: all).  n: all words of the language.
    """
    # The select also keeps columns of the same names apart.
    source = df.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text"))
    words = cut(count_words(source))
    phrases = cut(count_phrases(source, words, longest, least, budget))
    totals = words.groupBy("lang").agg(F.sum("a").alias("n"))

    counts = words.where(F.col("a") >= least).select("lang", "phrase", "a").union(phrases.select("lang", "phrase", "a"))
    cuts = F.expr(
        "transform(sequence(1, words - 1), k -> struct(k, substring_index(phrase, ' ', k) AS head, "
        "substring_index(phrase, ' ', k - words) AS tail))"
    )
    cut_up = phrases.select("lang", "phrase", "a", F.inline(cuts))
    scored = (
        cut_up.join(counts.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l")), ["lang", "head"])
        .join(counts.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r")), ["lang", "tail"])
        .withColumn("score", _floor_score("a", "l", "r"))
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    )
    inner = F.expr(
        "flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1), "
        "i -> array_join(slice(split(phrase, ' '), i, m), ' '))))"
    )
    covered = (
        phrases.where("words > 2")
        .select("lang", F.explode(inner).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    left = scored.join(covered, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < cover * F.col("a"))
    )
    best_first = F.desc("cut.score"), F.desc("a"), "phrase"
    if top is not None:
        # The best of each bucket first, so that a language's last task has a bounded number of rows.
        bucket = F.pmod(F.xxhash64("phrase"), F.lit(64))
        within = Window.partitionBy("lang", "bucket").orderBy(*best_first)
        left = left.withColumn("bucket", bucket).withColumn("place", F.row_number().over(within))
        left = left.where(F.col("place") <= top).drop("place", "bucket")
    ranked = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best_first)))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n",
        F.col("cut.score").alias("score"),
    )


EXPECTED = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
lists AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
phrases AS (
    SELECT lang, m AS words, unnest(list_transform(range(1, len(w) - m + 2),
        lambda i: array_to_string(list_slice(w, i, i + m - 1), ' '))) AS phrase
    FROM lists, (VALUES (1), (2), (3)) AS t(m)),
f AS (SELECT lang, words, phrase, count(*) AS a FROM phrases GROUP BY ALL),
totals AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE words = 1 GROUP BY lang),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND a >= 10),
cuts AS (
    SELECT c.lang, c.phrase, c.a, k, l.a AS l, r.a AS r,
        ((1000000::HUGEINT * c.a * c.a) // (l.a::HUGEINT * r.a))::BIGINT AS score
    FROM (SELECT *, unnest(range(1, words)) AS k FROM candidates) c
    JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(list_slice(c.w, 1, k), ' ')
    JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(list_slice(c.w, k + 1, c.words), ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
covered AS (
    SELECT lang, phrase, max(a) AS longer FROM (
        SELECT lang, a, unnest([array_to_string(list_slice(w, 1, 2), ' '), array_to_string(list_slice(w, 2, 3), ' ')])
            AS phrase FROM candidates WHERE words = 3) GROUP BY ALL),
ranked AS (
    SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank,
        b.phrase, a, l, r, score
    FROM best b LEFT JOIN covered c ON b.lang = c.lang AND b.phrase = c.phrase
    WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
