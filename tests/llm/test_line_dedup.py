from __future__ import annotations

import random

from trialscope.llm import line_dedup
from trialscope.llm.line_dedup import blocks, patience

from .fixtures import documents, odd_rows, prose


def test_alignment_is_increasing_and_equal():
    rng = random.Random(8)
    for _ in range(300):
        a = [rng.randrange(12) for _ in range(rng.randrange(20))]
        b = [rng.randrange(12) for _ in range(rng.randrange(20))]
        found = patience(a, b)
        assert all(a[i] == b[j] for i, j in found)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(found, found[1:], strict=False))
        assert sum(n for _, n in blocks(found)) == len(found)
    assert patience([1, 2, 3, 4], [9, 2, 3, 8]) == [(1, 1), (2, 2)]
    assert patience([1, 2, 3], [1, 2, 3]) == [(0, 0), (1, 1), (2, 2)]


def brute(rows, min_words=20):
    """Lines left when every document is aligned with every earlier one."""
    out = {}
    split = {k: [x.strip() for x in t.split("\n")] for k, t in rows}
    for k, text in rows:
        gone = set()
        places = [i for i, x in enumerate(split[k]) if x]
        for e, _ in rows:
            if e < k:
                a, b = [x for x in split[e] if x], [split[k][i] for i in places]
                for j, n in blocks(patience(a, b)):
                    if sum(len(x.split()) for x in b[j : j + n]) >= min_words:
                        gone |= set(range(places[j], places[j + n - 1] + 1))
        out[k] = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
    return out


def test_planted_passages(spark):
    rng = random.Random(9)
    passages = ["\n".join(prose(rng, rng.randint(8, 40)) for _ in range(rng.randint(1, 4))) for _ in range(6)]
    passages = [p for p in passages if len(p.split()) > 50]
    header = prose(rng, 6)
    rows = []
    for i in range(60):
        lines = [header, *(prose(rng, rng.randint(1, 15)) for _ in range(rng.randint(0, 6)))]
        if i % 3 == 0:
            lines.insert(rng.randint(0, len(lines)), passages[i % len(passages)])
        if i % 7 == 0:
            lines += ["", "  ", ""]
        rows.append((i, "\n".join(lines)))
    rows += [(100, rows[3][1]), (101, rows[3][1])]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(documents(spark, rows)).collect()}
    assert {k: r.text for k, r in got.items()} == brute(rows)
    for p in passages:
        assert sum(p in r.text for r in got.values()) == (1 if any(p in t for _, t in rows) else 0)
    texts = dict(rows)
    for k, r in got.items():
        assert r.n_removed or r.text == texts[k]
        assert r.n_lines == texts[k].count("\n") + 1


def test_odd_rows(spark):
    docs = documents(spark, odd_rows())
    got = line_dedup.dedup_lines(docs)
    assert set(got.columns) == set(docs.columns) | {"n_removed"}
    rows = got.collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in rows) == sorted((k or 0, t or "") for k, t in odd_rows())
    assert line_dedup.dedup_lines(documents(spark, [])).count() == 0


def test_repeated_rows_lose_the_same_lines(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"a\n{passage}"), (2, f"b\n{passage}\nc"), (2, f"b\n{passage}\nc"), (3, passage), (None, passage)]
    got = line_dedup.dedup_lines(documents(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == sorted(
        [(0, passage), (1, f"a\n{passage}"), (2, "b\nc"), (2, "b\nc"), (3, "")]
    )


def test_short_lines_with_other_first_holders(spark):
    # No line of the passage has min_words words, and another document holds each of them first.
    lines = [" ".join(f"p{i}w{k}" for k in range(15)) for i in range(4)]
    for n in (40, 200):
        rows = [(i, f"own {i}\n{line}\nend {i}") for i, line in enumerate(lines, 1)]
        rows += [(i, "\n".join([f"own {i}", *lines, f"end {i}"])) for i in range(5, n)]
        # Up to 64 holders the nearest earlier one counts too: here it holds each line alone.
        rows += [(n + i, f"own {n + i}\n{line}\nend {n + i}") for i, line in enumerate(lines)]
        rows.append((n + 4, "\n".join(["own", *lines, "end"])))
        got = {r.doc_id: r.text for r in line_dedup.dedup_lines(documents(spark, rows)).collect()}
        assert got == brute(rows)
        assert sum("\n".join(lines) in x for x in got.values()) == 1


def test_all_texts_of_an_earlier_id_count(spark):
    passages = [" ".join(f"p{i}w{k}" for k in range(30)) for i in range(2)]
    rows = [(1, f"a\n{passages[0]}"), (1, f"b\n{passages[1]}"), (2, "c\n" + "\n".join(passages))]
    got = line_dedup.dedup_lines(documents(spark, rows)).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [*rows[:2], (2, "c")]


def common_runs(rows, min_words):
    """Lines left without any run of ``min_words`` words that an earlier document has, by trying all."""
    out = {}
    for k, text in rows:
        b = [(i, x.strip()) for i, x in enumerate(text.split("\n")) if x.strip()]
        gone = set()
        for e, other in rows:
            a = [x.strip() for x in other.split("\n") if x.strip()] if e < k else []
            for i in range(len(a)):
                for j in range(len(b)):
                    n = 0
                    while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n][1]:
                        n += 1
                    if sum(len(x.split()) for x in a[i : i + n]) >= min_words:
                        gone |= set(range(b[j][0], b[j + n - 1][0] + 1))
        out[k] = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
    return out


def test_repeated_and_swapped_passages(spark):
    p, q = ("\n".join(" ".join(f"{c}{i}w{k}" for k in range(9)) for i in range(3)) for c in "pq")
    rows = [(1, f"x\n{p}\ny"), (2, f"z\n{p}\nw\n{p}\nv"), (3, f"s\n{q}\nt\n{p}\nu\n{q}")]
    rows += [(i, f"own {i}\n{p}\nend {i}\n{q}\nlast {i}\n\n{q}") for i in range(4, 80)]
    rows.append((90, f"a\n{q}\nb\n\n{p}\n\n{p}\nc"))
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(documents(spark, rows)).collect()}
    assert got == common_runs(rows, 20)
    assert got[2] == "z\nw\nv"
    assert got[3] == f"s\n{q}\nt\nu\n{q}"
    assert all(p not in x and q not in x for k, x in got.items() if k > 3)


def test_any_lines_against_all_runs(spark):
    rng = random.Random(10)
    kinds = [" ".join(f"l{i}w{k}" for k in range(1 + i % 7)) for i in range(9)] + ["", " "]
    rows = [(i, "\n".join(rng.choices(kinds, k=rng.randint(0, 25)))) for i in range(80)]
    for min_words in (1, 6, 14):
        got = line_dedup.dedup_lines(documents(spark, rows), min_words=min_words, rare=3).collect()
        assert {r.doc_id: r.text for r in got} == common_runs(rows, min_words)
