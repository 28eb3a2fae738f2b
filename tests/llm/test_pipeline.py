"""The pipeline against plain Python versions of what its stages promise."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers as public
import pytest
import tiktoken

import corpus_pipeline
from trialscope.llm import byte_bpe, queries
from trialscope.llm.common import shipped

from .fixtures import prose
from .test_decontamination import brute as brute_overlaps
from .test_line_dedup import brute as brute_lines
from .test_near_duplicates import brute as brute_groups


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with clean and bad documents, passages, near copies and benchmark texts."""
    rng = random.Random(15)
    path = str(tmp_path_factory.mktemp("tables"))
    items = [(i, prose(rng, 25)) for i in range(5)]
    rows, labels = [], []
    passage = prose(rng, 70)
    for i in range(400):
        good = i % 5 > 0
        text = "\n".join(prose(rng, 30) for _ in range(4)) if good else " ".join([prose(rng, 1).upper() + "!!"] * 60)
        if good and i % 20 == 1:
            text = passage + "\n" + text
        if good and i % 20 == 2:
            text += "\n" + items[i % 5][1]
        if good and i % 20 == 3:
            words = rows[i - 1 if i % 40 == 3 else i - 2][1].split(" ")
            words[len(words) // 2] = "changed"
            words[3] = "other"
            text = " ".join(words)
        rows.append((i, text))
        labels.append((i, int(good), 0))
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), "x") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, score string")
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, items


def test_stage_by_stage(spark, folder):
    path, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").cache()
    columns = docs.columns
    before = {r.doc_id: r.text for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)

    def step(name, docs):
        out = stages[name](spark, docs, path).cache()
        assert name == "byte_bpe" or out.columns == columns
        return out, {r.doc_id: r for r in out.collect()}

    docs, rows = step("quality", docs)
    assert sum(i % 5 > 0 for i in rows) >= 0.97 * 320 and sum(i % 5 == 0 for i in rows) <= 4
    before = {i: r.text for i, r in rows.items()}

    docs, rows = step("line_dedup", docs)
    want = {i: t for i, t in brute_lines(sorted(before.items())).items() if t.strip() or not before[i].strip()}
    assert {i: r.text for i, r in rows.items()} == want
    assert all(r.n_chars == len(r.text) for r in rows.values())
    before = {i: r.text for i, r in rows.items()}

    docs, rows = step("near_duplicates", docs)
    assert set(rows) == {i for i, (_, root) in brute_groups(sorted(before.items())).items() if i == root}
    before = {i: r.text for i, r in rows.items()}

    docs, rows = step("decontamination", docs)
    hits = brute_overlaps(before.items(), items)
    assert set(rows) == {i for i in before if not hits[i][1]}

    _, out = step("byte_bpe", docs)
    ranks = byte_bpe.read_ranks(shipped(public.path("byte_bpe_multi_50k.tiktoken")))
    library = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert set(out) == set(rows)
    for i, r in out.items():
        assert r.exact and np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(rows[i].text)


def test_run_is_the_stages(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path).cache()
    assert sorted(map(str, corpus_pipeline.run(spark, path).collect())) == sorted(map(str, docs.collect()))


def test_odd_and_empty_documents(spark, folder, tmp_path):
    path, _ = folder
    schema = spark.read.parquet(f"{path}/documents.parquet").schema
    odd = [(None, None, None, None, None, None), (1, "", "en", "s", 0, None), (1, "", "en", "s", 0, None), (2, "a\n\nb", None, "s", 4, None)]
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, path).cache()
        assert docs.count() <= len(rows)


def test_every_query_is_registered():
    names = sorted(queries.QUERIES)
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert queries.EXPECTED_SQL.keys() <= queries.QUERIES.keys()


def test_columns_pass_whatever_their_names(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").where("doc_id < 120")
    names = ["quality_score", "Quality_Score_", "lines_removed", "lines_in_all", "id_that_goes", "id_that_is_hit",
             "__quality", "__removed", "__lines", "__going", "__hit", "digest", "key", "kept"]
    docs = docs.selectExpr("*", *[f"concat('{n} ', doc_id) AS `{n}`" for n in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all(r[n] == f"{n} {r.doc_id}" for r in rows for n in names), name
    assert all(r.exact for r in corpus_pipeline.token_ids(spark, docs, path).collect())
