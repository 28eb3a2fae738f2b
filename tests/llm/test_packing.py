from __future__ import annotations

import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trialscope.llm import packing, queries

from .fixtures import documents, odd_rows, prose

os.environ["TOKENIZERS_PARALLELISM"] = "false"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def fewest(lengths, size):
    """The least number of sequences, by trying all."""
    lengths, best = sorted(lengths, reverse=True), len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for j, room in enumerate(rooms):
            if room >= lengths[i] and room not in rooms[:j]:
                place(i + 1, rooms[:j] + [room - lengths[i]] + rooms[j + 1 :])
        place(i + 1, rooms + [size - lengths[i]])

    place(0, [])
    return best


@settings(max_examples=300, deadline=None)
@given(st.integers(4, 40).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=9))))
def test_reduction_keeps_an_optimum(case):
    size, lengths = case
    fixed, left = packing.reduce_by_dominance(Counter(lengths), size)
    rest = [s for s, n in left.items() for _ in range(n)]
    assert sum(n for n, _ in fixed) + fewest(rest, size) == fewest(lengths, size)
    planned = packing.plan(Counter(lengths), size)
    placed = Counter()
    for n, pattern in planned:
        assert sum(pattern) <= size
        for s in pattern:
            placed[s] += n
    assert placed == Counter(lengths)
    assert sum(n for n, _ in planned) <= max(fewest(lengths, size) + 1, 1)


def test_best_fit_is_the_plain_one():
    rng = random.Random(5)
    for _ in range(50):
        size = rng.choice([30, 100])
        lengths = [rng.randint(1, size) for _ in range(rng.randint(0, 200))]
        rooms: list[int] = []
        for s in sorted(lengths, reverse=True):
            fit = min((r for r in rooms if r >= s), default=None)
            if fit is not None:
                rooms.remove(fit)
            rooms.append((size if fit is None else fit) - s)
        got = packing.best_fit(Counter(lengths), size)
        assert sorted(size - sum(p) for n, p in got for _ in range(n)) == sorted(rooms)


def test_many_rows_cost_no_more_than_few():
    counts = {s: 10**10 + s * 7919 % 1000 for s in range(1, 1025)}
    planned = packing.plan(counts, 1024)
    assert len(planned) < 5_000
    least = -(-sum(s * n for s, n in counts.items()) // 1024)
    assert sum(n for n, _ in planned) <= 1.001 * least


def test_ids_are_those_of_the_library(spark):
    library = tokenizers.Tokenizer.from_file(VOCABULARY)
    rng = random.Random(6)
    rows = odd_rows() + [
        (30, "a  b   c\x1c\x1dd\x85 e\n\n\n f'll we'd <|endoftext|><|endoftext|>"),
        (31, " " * 3000 + "x" + "\n" * 500),
        (32, "".join(chr(rng.choice([0x41, 0xE9, 0x4E00, 0x1F600, 0x300, 0x20, 0x0A])) for _ in range(4000))),
    ]
    cut_up = packing.pieces(documents(spark, rows), VOCABULARY, public_tokenizers.PATTERN, 2, 64)
    # The columns ids and n_tokens of the table clash: ids is replaced, the other one passes through.
    assert cut_up.columns.count("ids") == 1 and "n_tokens" in cut_up.columns and "text" not in cut_up.columns
    parts = defaultdict(list)
    for r in cut_up.collect():
        parts[r.doc_id].append(r)
    for key, text in rows:
        want = library.encode(text or "", add_special_tokens=False).ids + [2]
        copies = sum(1 for k, _ in rows if k == key)
        here = sorted(parts[key], key=lambda r: r.piece)[::copies]
        assert len(parts[key]) == copies * len(here)
        assert sum((np.frombuffer(r.ids, "<u4").tolist() for r in here), []) == want
        assert [r.length for r in here[1:]] == [64] * (len(here) - 1) and 0 < here[0].length <= 64
        assert [r.start for r in here] == [sum(x.length for x in here[:i]) for i in range(len(here))]


def check(rows, size):
    """All rows of (sequence, offset, length) stand gapless in sequences of the size."""
    sequences = defaultdict(list)
    for sequence, offset, length in rows:
        sequences[sequence].append((offset, length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= size
    return len(sequences)


def test_rows_are_placed_once(spark):
    rng = random.Random(7)
    rows = [(i % 900, rng.choice([7, 7, 7, rng.randint(1, 50)])) for i in range(1000)] + [(None, 3), (None, 3)]
    df = spark.createDataFrame(rows, "key int, length long").withColumn("offset", F.lit("x")).repartition(5)
    got = packing.pack(df, ["key", "length"], size=50)
    assert got.columns == ["key", "length", "sequence_id", "offset"]
    placed = got.collect()
    assert sorted((r.key or -1, r.length) for r in placed) == sorted((k or -1, n) for k, n in rows)
    n = check([(r.sequence_id, r.offset, r.length) for r in placed], 50)
    assert n == sum(n for n, _ in packing.plan(Counter(n for _, n in rows), 50))
    with pytest.raises(ValueError):
        packing.pack(df, ["key"], size=10)


def test_buckets_number_rows_of_a_length(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 7).alias("g"))
    for per_bucket in (10, 100_000):
        got = packing.numbered(df, "g", ["id"], "n", per_bucket).groupBy("g").agg(
            F.count("*").alias("rows"), F.count_distinct("n").alias("kinds"), F.max("n").alias("last")
        )
        assert all(r.rows == r.kinds == r.last + 1 for r in got.collect())


def test_query(spark):
    path = "/root/testdata/sf0.001"
    library = tokenizers.Tokenizer.from_file(VOCABULARY)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    got = queries.op11_packing(spark, path).collect()
    used = check([(r.sequence_id, r.offset, r.length) for r in got], 1024)
    assert used <= 1.01 * -(-sum(r.length for r in got) // 1024) + 1
    parts = defaultdict(dict)
    for r in got:
        parts[r.doc_id][r.piece] = r
    for key, text in texts.items():
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        assert sum(r.length for r in parts[key].values()) == len(ids)
        for r in parts[key].values():
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())


def test_tokenizers_of_other_kinds_are_refused():
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as file, pytest.raises(ValueError):
        packing.read_tokenizer(file.read())


def test_long_texts_go_in_parts():
    model = (open(VOCABULARY, "rb").read(), public_tokenizers.PATTERN)
    encoding = packing._encoding(model)
    text = prose(random.Random(8), 120_000) + "\n" * 30_000 + "x" * 300
    assert packing._ids(encoding, text, 2).tolist() == encoding.encode_ordinary(text) + [2]
