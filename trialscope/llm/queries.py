"""The named query of each operator, over the whole of its tables, and SQL where it can say the same."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    ann,
    byte_bpe,
    collocations,
    decontamination,
    language_id,
    line_dedup,
    lm_scoring,
    near_duplicates,
    packing,
    periodic_runs,
    quality,
    token_counts,
    toxicity,
)
from .common import held_out, read


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    ids = byte_bpe.encode(read(spark, sf_dir, "documents", "doc_id", "text"), *model, keep=["doc_id"])
    return byte_bpe.decode(ids, *model).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 20 == 0)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(read(spark, sf_dir, "documents", "doc_id", "text")).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "n_lines",
        "n_removed",
        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars_left"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"),
    )


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return near_duplicates.near_duplicates(docs)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = language_id.fit(docs.where(~held_out("doc_id", 4, 2)))
    return language_id.identify(docs.select("doc_id", "text"), model).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out("doc_id", 4, 2).alias("held_out"),
        "lang_pred",
        "score",
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json")).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > 2048).alias("over_limit"),
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    labels = read(spark, sf_dir, "labels", "doc_id", "toxic").where(~held_out("doc_id", 3, 1))
    return toxicity.score(docs, toxicity.fit(docs, labels)).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out("doc_id", 3, 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "n_windows",
        "worst_word",
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.overlaps(
        read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text")
    )
    return found.select(
        F.col("key").cast("long").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return lm_scoring.score(docs, held_out("doc_id", 5, 1))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    labels = read(spark, sf_dir, "labels", "doc_id", "quality").where(~held_out("doc_id", 4, 2))
    return quality.score(docs, quality.fit(docs, labels)).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out("doc_id", 4, 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    model = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
    cut_up = packing.pieces(docs, *model, end=2, size=1024).select(
        F.col("doc_id").cast("long").alias("doc_id"), "piece", "start", "length", F.crc32("ids").alias("ids_crc32")
    )
    return packing.pack(cut_up, ["doc_id", "piece", "ids_crc32"], "length", 1024)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents", "lang", "text"))


def _planted(row: dict, words: list[bytes]) -> list[bytes]:
    """Words of a tenth of the documents, from some place on repeated with some period."""
    h = zlib.crc32(str(row["doc_id"]).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    found = periodic_runs.find_runs(docs, keep=["doc_id"], rewrite=_planted)
    longest = F.expr("array_max(transform(runs, r -> struct(r.length AS n, -r.start AS s, -r.period AS p, r)))")
    lines = F.expr("array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\n'), '')")
    return found.withColumn("best", longest["r"]).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_ann": op2_ann,
    "op3_line_dedup": op3_line_dedup,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_language_id": op5_language_id,
    "op6_token_counts": op6_token_counts,
    "op7_toxicity": op7_toxicity,
    "op8_decontamination": op8_decontamination,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_quality": op10_quality,
    "op11_packing": op11_packing,
    "op12_collocations": op12_collocations,
    "op13_periodic_runs": op13_periodic_runs,
}

EXPECTED_SQL: dict[str, str] = {
    "op4_near_duplicates": near_duplicates.EXPECTED,
    "op8_decontamination": decontamination.EXPECTED,
    "op12_collocations": collocations.EXPECTED,
}
