"""Running a stream over the files that are there, and reading back what it emitted."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trialscope.sources.storage import is_folder, scratch_path


def read_files_as_stream(spark: SparkSession, path: str) -> DataFrame:
    """A file stream with the schema of the Parquet file or folder at ``path``."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if is_folder(spark, path):
        return reader.parquet(path)
    folder, name = path.rsplit("/", 1)
    return reader.option("pathGlobFilter", name).parquet(folder)


# Sessions are merged within each task before they are shuffled by user, so a user with a large
# share of the events arrives as sessions, not as events.
STREAM_SETTINGS = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the duration of a block; a stream keeps those it was started with."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


class LateRows(RuntimeError):
    """Rows came later than the watermark allows, so the result would lack them."""


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that a query dropped as late, as far as its last 100 progress reports tell."""
    return sum(
        state["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for state in progress["stateOperators"]
    )


def run_available(
    rows: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    closing: Mapping[str, object],
    name: str,
) -> DataFrame:
    """Process everything available in append mode into Parquet files and return them.

    ``closing`` is a row far in the future.  It comes from a second source of the same stream after
    all others, so the watermark passes what is open and every result is emitted; results of its
    own stay open.  Rows that came too late raise ``LateRows``.

    The file sink commits each micro-batch once, so a restart after a lost executor neither
    repeats nor loses rows.
    """
    spark = rows.sparkSession
    root = scratch_path(spark, name)
    ends = f"{root}/closing"
    spark.createDataFrame([], rows.schema).write.parquet(ends)
    united = rows.unionByName(spark.readStream.schema(rows.schema).parquet(ends))
    stream = build(united)

    def run() -> None:
        query = (
            stream.writeStream.outputMode("append")
            .format("parquet")
            .option("path", f"{root}/data")
            .option("checkpointLocation", f"{root}/state")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        if late := dropped_rows(query):
            raise LateRows(f"{late} rows of {name} came after the watermark had passed them")

    with settings(spark, STREAM_SETTINGS):
        run()
        last = spark.range(1).select(
            *[F.lit(closing[f.name]).cast(f.dataType).alias(f.name) for f in rows.schema]
        )
        last.write.mode("append").parquet(ends)
        run()
    return spark.read.schema(stream.schema).parquet(f"{root}/data")
