"""Small tables with everything that an operator may meet."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SYLLABLES = ["ta", "ri", "mo", "ne", "su", "lo", "ke", "vi", "da", "po"]


def word(rng: random.Random) -> str:
    return "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))


def prose(rng: random.Random, n: int) -> str:
    return " ".join(word(rng) for _ in range(n))


def documents(spark: SparkSession, rows: list[tuple], extra: bool = True) -> DataFrame:
    """doc_id and text, and columns whose names operators use inside or for their results."""
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    if extra:
        names = ["ids", "n_tokens", "score", "key", "digest", "id", "n_lines", "kept", "label", "decoded"]
        df = df.selectExpr("*", *[f"'x' AS {n}" for n in names])
    return df


def odd_rows() -> list[tuple]:
    """Null and empty texts, a null id, repeats, white space only, a long text and a long word."""
    rng = random.Random(3)
    long = prose(rng, 30_000)
    return [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (None, "an id that is null"),
        (4, long),
        (5, "x" * 20_000),
        (6, "same text here, twice"),
        (6, "same text here, twice"),
        (7, "Ünïcödé 文字 \U0001f600 and <|endoftext|> 12½"),
        (8, "one"),
    ]
