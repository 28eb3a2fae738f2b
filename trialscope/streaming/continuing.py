"""Streams that go on over many arrivals of files, and can be read in full after each of them.

A stream has one folder, which survives restarts:

* ``accepted``: rows of the source that came in time, each id once (first query),
* ``closed``: results that the watermark has passed (second query, over ``accepted``),
* ``late``: rows that came after the watermark had passed them, found by an anti-join of the ids in
  newly taken files with the accepted ones, not by counters of the engine,
* ``audited``: which source files have been looked through for late rows,
* the two queries' checkpoints, whose state holds what is still open.

A reading unites the closed results with the open ones, which come from the state of the last finished
micro-batch.  So nothing has to be closed artificially, and no fact is read again.  The second query
sees accepted rows only in the order of their acceptance, so its watermark is never ahead of the first
one's and it drops nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialscope.sources.versions import exists
from trialscope.streaming.allocation import allocated_days, open_days
from trialscope.streaming.replay import STREAM_SETTINGS, LateRows, dropped_rows, settings
from trialscope.streaming.sessions import open_sessions, session_windows


@dataclass(frozen=True)
class Kind:
    """What a stream computes.

    ``results`` maps the accepted rows, as a stream with watermark, to results in append mode.
    ``still_open`` makes the same columns from the state of its operator; ``key`` names what tells
    results apart.
    """

    columns: tuple[str, ...]
    row_id: str
    event_time: str
    results: Callable[[DataFrame], DataFrame]
    still_open: Callable[[DataFrame], DataFrame]
    key: tuple[str, ...]
    wanted: Callable[[], Column] = lambda: F.lit(True)


SESSIONS = Kind(
    columns=("event_id", "user_id", "event_timestamp"),
    row_id="event_id",
    event_time="event_timestamp",
    results=session_windows,
    still_open=open_sessions,
    key=("user_id", "session_start"),
)
ALLOCATION = Kind(
    columns=("experiment_id", "experiment_name", "variant", "user_id", "assignment_timestamp"),
    row_id="experiment_id",
    event_time="assignment_timestamp",
    results=allocated_days,
    still_open=open_days,
    key=("metric_date", "experiment_name", "variant"),
    wanted=lambda: ~F.col("is_holdout"),
)


@dataclass(frozen=True)
class Continuing:
    """One stream under ``root``.

    ``source`` is a folder to which Parquet files are added; ``prepare`` turns its rows, as a batch or
    as a stream, into rows with the kind's columns.  ``delay`` is how far a row may be behind the newest.
    """

    spark: SparkSession
    root: str
    source: str
    kind: Kind
    delay: str = "1 day"
    prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows
    files_per_batch: int | None = None

    def _rows(self, raw: DataFrame) -> DataFrame:
        """Rows that count: wanted ones whose time is known."""
        time = self.kind.event_time
        rows = self.prepare(raw).where(self.kind.wanted()).select(*self.kind.columns)
        return rows.withColumn(time, F.col(time).cast("timestamp")).where(F.col(time).isNotNull())

    def _run(self, rows: DataFrame, name: str) -> int:
        """One query over what is available; returns how many rows it dropped as late, as far as told."""
        query = (
            rows.writeStream.outputMode("append")
            .format("parquet")
            .option("path", f"{self.root}/{name}")
            .option("checkpointLocation", f"{self.root}/{name}-state")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return dropped_rows(query)

    def _files(self) -> list[str]:
        if not exists(self.spark, self.source):
            return []
        return self.spark.read.parquet(self.source).inputFiles()

    def advance(self) -> None:
        """Take the files that have arrived.  May be repeated after a failure at any point."""
        files = self._files()
        if not files:
            return
        reader = self.spark.readStream.schema(self.spark.read.parquet(files[0]).schema)
        if self.files_per_batch:
            reader = reader.option("maxFilesPerTrigger", self.files_per_batch)
        incoming = self._rows(reader.parquet(self.source)).withWatermark(self.kind.event_time, self.delay)
        with settings(self.spark, STREAM_SETTINGS):
            self._run(incoming.dropDuplicatesWithinWatermark([self.kind.row_id]), "accepted")
            accepted = self._accepted()
            again = self.spark.readStream.schema(accepted.schema).parquet(f"{self.root}/accepted")
            results = self.kind.results(again.withWatermark(self.kind.event_time, self.delay))
            if lost := self._run(results, "closed"):
                raise LateRows(f"{lost} accepted rows of {self.root} were dropped")
        self._audit(files)

    def _accepted(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/accepted")

    def _audit(self, files: list[str]) -> None:
        """Look for late rows in the files that no earlier audit has seen.

        Late rows are written before the files are noted, and again to the same place if that fails.
        """
        number, known = 0, set()
        if exists(self.spark, f"{self.root}/audited"):
            noted = self.spark.read.parquet(f"{self.root}/audited")
            number = noted.agg(F.max("audit")).first()[0] + 1
            known = {row.file for row in noted.select("file").collect()}
        new = [file for file in files if file not in known]
        if not new:
            return
        given = self._rows(self.spark.read.parquet(*new))
        accepted = self._accepted().select(F.col(self.kind.row_id).alias("_accepted"))
        late = given.join(accepted, F.col(self.kind.row_id).eqNullSafe(F.col("_accepted")), "left_anti")
        late.write.mode("overwrite").parquet(f"{self.root}/late/audit={number}")
        notes = self.spark.createDataFrame([(number, file) for file in new], "audit bigint, file string")
        notes.coalesce(1).write.mode("append").parquet(f"{self.root}/audited")

    def late_rows(self) -> DataFrame:
        """All rows that came too late to be part of the results, with the audit that found them."""
        noted = self.spark.read.parquet(f"{self.root}/audited").select("audit").distinct()
        schema = T.StructType([*self._accepted().schema, T.StructField("audit", T.LongType())])
        late = self.spark.read.schema(schema).parquet(f"{self.root}/late")
        return late.join(noted, "audit", "left_semi")

    def closed(self) -> DataFrame:
        """Results that can not change any more."""
        return self.spark.read.parquet(f"{self.root}/closed")

    def now(self) -> DataFrame:
        """All results as of the last finished run, the open ones included (``is_open``)."""
        state = self.spark.read.format("statestore").option("operatorId", 0).load(f"{self.root}/closed-state")
        open_, closed = self.kind.still_open(state), self.closed()
        # A run that is under way may have written results that the state still holds.
        open_ = open_.join(closed.select(*self.kind.key), list(self.kind.key), "left_anti")
        return closed.withColumn("is_open", F.lit(False)).unionByName(open_.withColumn("is_open", F.lit(True)))
