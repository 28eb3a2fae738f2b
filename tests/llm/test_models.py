"""The classifiers: held-out accuracy on the given tables, slopes against differences, odd rows."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest

from trialscope.llm import language_id, quality, queries, toxicity
from trialscope.llm.nets import TwoLayers, sigmoid, temperature

from .fixtures import documents, odd_rows, prose

SF = "/root/testdata/sf0.01"


def held(spark, rows, label):
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    return [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]


def test_quality_of_held_out_rows(spark):
    pairs = held(spark, queries.op10_quality(spark, SF).collect(), "quality")
    assert len(pairs) > 50 and np.mean([(s >= 0.7) == y for s, y in pairs]) > 0.95


def test_toxicity_of_held_out_rows(spark):
    pairs = held(spark, queries.op7_toxicity(spark, SF).collect(), "toxic")
    # Few labelled toxic texts in four languages are there to learn from at this size.
    assert len(pairs) > 80 and np.mean([(s >= 0.7) == y for s, y in pairs]) > 0.93


def test_language_of_held_out_rows(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in queries.op5_language_id(spark, SF).collect() if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in rows]) > 0.97


def two_languages(n: int) -> list[tuple[str, str]]:
    rng = random.Random(11)
    kinds = {"aa": "ta ri mo ne su", "bb": "lok ekk viz daz pox"}

    def text(syllables):
        return " ".join("".join(rng.choices(syllables.split(), k=rng.randint(1, 3))) for _ in range(rng.randint(5, 40)))

    return [(k, text(kinds[k])) for k in kinds for _ in range(n)]


def test_words_of_mixed_text(spark):
    rows = two_languages(40)
    frame = spark.createDataFrame([(i, t, k) for i, (k, t) in enumerate(rows)], "doc_id long, text string, lang string")
    model = language_id.fit(frame)
    docs = documents(spark, [(900, "tari mone sumo riri neta LOKEKK vizdaz poxlok ekkekk dazviz"), (901, "12 ½ !"), *odd_rows()])
    got = {r.doc_id: r for r in language_id.label_words(docs, model).collect()}
    assert [w.lang for w in got[900].words] == ["aa"] * 5 + ["bb"] * 5 and got[901].words == []
    assert all(0.5 <= w.score <= 1 for w in got[900].words)
    named = language_id.identify(docs, model).collect()
    assert len(named) == len(odd_rows()) + 2
    for r in named:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred in ("aa", "bb")) == letters and 0 <= r.score <= 1
    assert language_id.identify(documents(spark, []), model).count() == 0


def test_language_without_labels(spark):
    docs = documents(spark, odd_rows())
    none = language_id.fit(docs.selectExpr("doc_id", "text", "cast(null AS string) AS lang"))
    assert {r.lang_pred for r in language_id.identify(docs, none).collect()} == {"und"}
    one = language_id.fit(docs.selectExpr("doc_id", "text", "'zz' AS lang"))
    got = language_id.identify(docs, one).collect()
    assert {r.lang_pred for r in got} == {"und", "zz"}


def test_marginals_like_all_paths():
    rng = np.random.default_rng(1)
    field = language_id.Field(["a", "b", "c"])
    field.w["move"][:] = rng.normal(size=(3, 3))
    field.w["first"][:] = rng.normal(size=3)
    lengths = np.array([4, 1, 3])
    scores = rng.normal(size=(8, 3)).astype("f4")
    got, pairs = field.marginals(scores, lengths)
    begin, want_pairs = 0, np.zeros((3, 3))
    for n in lengths:
        s, want, total, mine = scores[begin : begin + n], np.zeros((n, 3)), 0.0, np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            w = field.w["first"][path[0]] + sum(s[i, k] for i, k in enumerate(path))
            w = np.exp(w + sum(field.w["move"][a, b] for a, b in zip(path, path[1:], strict=False)))
            total += w
            for i, k in enumerate(path):
                want[i, k] += w
            for a, b in zip(path, path[1:], strict=False):
                mine[a, b] += w
        assert np.allclose(got[begin : begin + n], want / total, atol=1e-5)
        want_pairs += mine / total
        begin += n
    assert np.allclose(pairs, want_pairs, atol=1e-5)


def test_stretches_hardly_change_long_texts(spark, monkeypatch):
    rows = two_languages(30)
    field = language_id.Field(["aa", "bb"])
    field.fit([t for _, t in rows], [k == "bb" for k, _ in rows])
    text = " ".join(t for _, t in rows)
    whole, _ = language_id.Tagger(field).word_probabilities([text, "tari", text])
    monkeypatch.setattr(language_id, "STRETCH", 100)
    parts, _ = language_id.Tagger(field).word_probabilities([text, "tari", text])
    assert np.abs(whole - parts).max() < 1e-6


def test_recurrent_slopes_like_differences():
    rng = np.random.default_rng(2)
    net = toxicity.Net(["a", "b", "c"], np.zeros(3, "f4"))
    net.w = {k: w.astype("f8") for k, w in net.w.items()}
    x = rng.normal(size=(5, toxicity.OWN + toxicity.CHARS))
    at, sizes = rng.integers(5, size=(toxicity.WINDOW, 3)), np.array([24, 7, 0])

    def loss():
        return float(net.logits(x, at, sizes) @ np.array([1.0, -2.0, 0.5]))

    saved: dict = {}
    net.logits(x, at, sizes, saved)
    slopes, dx = net.slopes(x, at, np.array([1.0, -2.0, 0.5]), saved)
    for name, slope in [*slopes.items(), ("input", dx)]:
        table = x if name == "input" else net.w[name]
        for _ in range(4):
            place = tuple(rng.integers(n) for n in table.shape)
            keep, step = table[place], 1e-2
            table[place] = keep + step
            up = loss()
            table[place] = keep - step
            down = loss()
            table[place] = keep
            assert slope[place] == pytest.approx((up - down) / (2 * step), rel=0.03, abs=3e-3), name


def test_windows_cover_every_word():
    lengths = np.array([0, 1, 23, 24, 25, 36, 37, 500])
    first, sizes, text = toxicity.windows(lengths)
    begin = np.cumsum(lengths) - lengths
    for i, n in enumerate(lengths):
        seen = set()
        for f, s in zip(first[text == i] - begin[i], sizes[text == i], strict=True):
            assert 0 <= f and f + s <= n
            seen |= set(range(f, f + s))
        assert seen == set(range(n)) and (text == i).any()


def test_toxicity_of_odd_rows(spark):
    rng = random.Random(12)
    rows = [(i, prose(rng, 20 * (1 + i % 16)) + (" vile brute" if i % 2 else "")) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(3, None), (None, 1), (900, 7)], "doc_id long, toxic int")
    model = toxicity.fit(documents(spark, rows), labels)
    docs = documents(spark, [*odd_rows(), (50, prose(rng, 300) + " VILE, brute " + prose(rng, 300)), (51, prose(rng, 600))])
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert got[50].score >= 0.7 > got[51].score and 280 <= got[50].worst_word <= 301
    assert all(0 <= r.score <= 1 and r.n_windows >= 1 for r in got.values())
    assert toxicity.score(documents(spark, []), model).count() == 0
    nothing = toxicity.fit(documents(spark, rows), labels.limit(0))
    assert {r.score for r in toxicity.score(docs, nothing).collect()} == {0.0}


def test_quality_of_odd_rows(spark):
    rng = random.Random(13)
    rows = [(i, prose(rng, 50) if i % 2 else " ".join([prose(rng, 1)] * 30)) for i in range(300)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)] + [(3, None), (None, 1)], "doc_id long, quality int")
    docs = documents(spark, rows)
    model = quality.fit(docs, labels)
    got = quality.score(docs, model).collect()
    assert np.mean([(r.score >= 0.5) == r.doc_id % 2 for r in got]) > 0.95
    odd = quality.score(documents(spark, odd_rows()), model).collect()
    assert len(odd) == len(odd_rows()) and all(0 <= r.score <= 1 for r in odd)
    assert quality.score(documents(spark, []), model).count() == 0
    nothing = quality.fit(documents(spark, []), labels.limit(0))
    assert {r.score for r in quality.score(docs, nothing).collect()} == {0.5}


def test_word_vectors_do_not_depend_on_partitions(spark):
    rng = random.Random(14)
    docs = documents(spark, [(i, prose(rng, 30)) for i in range(40)])
    a, b = (quality.word_vectors(docs.repartition(n)) for n in (1, 7))
    assert np.allclose(a, b, atol=1e-6)


def test_temperature_makes_sure_scores_less_sure():
    rng = np.random.default_rng(5)
    truth = rng.random(2000) < 0.5
    logits = np.where(truth, 1.0, -1.0) + rng.normal(size=2000)
    t = temperature(6 * logits, truth.astype("f8"))
    p = sigmoid(6 * logits / t)
    assert 2 < t and abs(p[p > 0.8].mean() - truth[p > 0.8].mean()) < 0.05


def test_two_layers_learn_what_one_can_not():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(2000, 2)).astype("f4")
    y = (x[:, 0] * x[:, 1] > 0).astype("f8")
    net = TwoLayers(x, 16, 1)
    net.fit(x, y, epochs=30)
    assert ((net.logits(x) > 0) == y).mean() > 0.93


def test_words_without_spaces_are_read_to_their_end():
    rng = random.Random(15)
    for n in (1, 39, 40, 41, 42, 47, 48, 49, 500):
        word = "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(n))
        pieces = toxicity.words_of(word)
        assert max(map(len, pieces)) <= 40 and (n > 40 or pieces == [word])
        # Whatever is no longer than half a piece is inside one.
        assert all(any(word[i : i + 6] in p for p in pieces) for i in range(max(1, n - 5)))
    assert toxicity.words_of(f"One {'a' * 41} two") == ["one", *["a" * 12] * 6, "two"]


def test_toxic_end_of_a_text_without_spaces():
    rng = random.Random(16)
    words = ["".join(chr(0x4E00 + rng.randrange(400)) for _ in range(rng.randint(1, 3))) for _ in range(30)]

    def unspaced(n):
        return "".join(rng.choices(words, k=n))

    insult = "\u6eda\u5f00\u91ce\u517d\u53bb\u6b7b"
    texts = [unspaced(rng.randint(30, 150)) + insult * (i % 2) for i in range(1200)]
    judge = toxicity.Judge(toxicity.fit_net(texts, np.arange(1200, dtype="f4") % 2))
    plain = [unspaced(n) for n in (30, 60, 300, 2000) for _ in range(5)]
    scores = []
    for text in [*plain, *(t + insult for t in plain)]:
        scores.append(judge.window_scores([text])[0].max())
    right = [(s >= 0.7) == (i >= len(plain)) for i, s in enumerate(scores)]
    assert np.mean(right) > 0.9
    assert all(b > a for a, b in zip(scores[: len(plain)], scores[len(plain) :], strict=True))
