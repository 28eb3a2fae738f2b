"""From raw documents to token ids: quality, line dedup, near-duplicates, benchmark passages, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's docs.  All stages but the last return the columns of documents.  Extra
columns pass through, whatever their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trialscope.llm import byte_bpe, decontamination, line_dedup, near_duplicates, quality
from trialscope.llm.common import cut, held_out, read, shared_folder

#: Documents whose probability of good quality is lower than this are rejected.
LEAST_QUALITY = 0.5


def _unused(docs: DataFrame, name: str) -> str:
    """A column name that the table does not have, whatever the case of its letters."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    It learns from the labels of three quarters of the ids, and word vectors from all documents.
    """
    labels = read(spark, sf_dir, "labels", "doc_id", "quality").where(~held_out("doc_id", 4, 2))
    model, score = quality.fit(docs, labels), _unused(docs, "quality_score")
    scored = quality.score(docs, model, output=score)
    return scored.where(F.col(score) >= LEAST_QUALITY).select(*_columns(docs))


def unrepeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that earlier ones hold.

    A document of which no text is left goes; ``n_chars``, if it is a column, follows the text.
    """
    removed, lines = _unused(docs, "lines_removed"), _unused(docs, "lines_in_all")
    left = line_dedup.dedup_lines(docs, removed=removed, lines=lines)
    changed = F.col(removed) > 0
    left = left.where(~changed | (F.trim(F.regexp_replace("text", r"\s", " ")) != ""))
    n_chars = F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast("long").alias("n_chars")
    return left.select(*[n_chars if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates; the rows that repeat its id stay with it."""
    found = near_duplicates.near_duplicates(docs)
    going = _unused(docs, "id_that_goes")
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias(going)).distinct()
    return docs.join(gone, F.col("doc_id") == F.col(going), "left_anti")


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word of a benchmark window; rows of one id go together."""
    found = decontamination.overlaps(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))
    hit = _unused(docs, "id_that_is_hit")
    hits = found.where("n_hit > 0").select(F.col("key").alias(hit)).distinct()
    return docs.join(hits, F.col("doc_id").eqNullSafe(F.col(hit)), "left_anti")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (packed, little-endian, 32 bits) and whether decoding gives the text back.

    Texts are compared by their digests, so that they go to the Python workers once and not back.
    The ids are written before they are decoded: a task that does both would hold two workers, which
    an executor then keeps for all that follows.
    """
    model = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("digest")
    ids = cut(byte_bpe.encode(docs.select("doc_id", "text", digest), *model, keep=["doc_id", "digest"]))
    return byte_bpe.decode(ids, *model).select(
        "doc_id", "n_tokens", "ids", (F.sha2("decoded", 256) == F.col("digest")).alias("exact")
    )


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("line_dedup", unrepeated_lines),
    ("near_duplicates", one_of_each_group),
    ("decontamination", no_benchmark),
    ("byte_bpe", token_ids),
]

#: The stages are models, alignments and a tokenizer, which SQL can not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages; what they write goes to a new folder under the checkpoint folder."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
