"""Memory that Python workers keep from one stage to the next."""

from __future__ import annotations

import corpus_pipeline
from trialscope.llm import common, quality


def test_a_task_holds_one_python_worker(spark):
    docs = spark.createDataFrame([(1, "some words here"), (2, None), (3, "")], "doc_id long, text string")
    ids = corpus_pipeline.token_ids(spark, docs, "")
    plan = ids._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    assert [r.exact for r in ids.orderBy("doc_id").collect()] == [True, True, True]


def test_a_model_that_is_kept_alone_drops_those_of_other_jobs(spark):
    common._MODELS["of another job"] = object()
    model = quality.fit(
        spark.createDataFrame([(1, "some words"), (2, "other words")], "doc_id long, text string"),
        spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, quality int"),
    )
    with model.loaded():
        assert list(common._MODELS) == [model.name]
    assert not common._MODELS


def test_tasks_without_a_model_drop_those_of_other_jobs():
    common._MODELS["of another job"] = object()
    common.forget()
    assert not common._MODELS
