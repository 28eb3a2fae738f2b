"""Daily active users per arm: a stream of events joined to the published version of the assignments.

Each run resolves the newest version when it starts and joins its micro-batches to that one, so a run is
consistent however many files it takes.  A version that adds assignments between two runs also concerns
days that earlier runs have passed: the run catches up by joining the user-days seen so far to the
added assignments only.  Readings leave out what belongs to assignments that the newest version no
longer has.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialscope.sources import versions
from trialscope.streaming.replay import read_files_as_stream

ARM_OF_USER = ("experiment_name", "variant", "user_id")


def _arms(assignments: DataFrame) -> DataFrame:
    return assignments.where(~F.col("is_holdout")).select(*ARM_OF_USER).distinct()


@dataclass(frozen=True)
class Activity:
    """A stream under ``root`` over the Parquet files of ``source`` (user_id and event_timestamp, after
    ``prepare``), with the assignments of the table ``experiments`` published under ``tables``."""

    spark: SparkSession
    root: str
    source: str
    tables: str
    delay: str = "1 day"
    prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows

    def _runs(self) -> tuple[int, int]:
        """Number of finished runs and the version that the last one joined."""
        if not versions.exists(self.spark, f"{self.root}/runs"):
            return 0, 0
        runs = self.spark.read.parquet(f"{self.root}/runs")
        last = runs.agg(F.count("*"), F.max_by("version", "run")).first()
        return last[0], last[1]

    def _assignments(self, version: int) -> versions.Entry:
        tables = versions.at(self.spark, self.tables, version)
        if "experiments" not in tables:
            raise LookupError(f"no assignments are published under {self.tables}")
        return tables["experiments"]

    def advance(self) -> None:
        """Take the files that have arrived, with the newest assignments.  May be repeated after a failure."""
        run, before = self._runs()
        version = versions.latest(self.spark, self.tables)
        entry = self._assignments(version)
        arms = _arms(versions.read(self.spark, entry))
        if before and before != version:
            self._catch_up(run, self._assignments(before), entry)
        active = (
            self.prepare(read_files_as_stream(self.spark, self.source))
            .select("user_id", F.col("event_timestamp").cast("timestamp").alias("event_timestamp"))
            .where(F.col("event_timestamp").isNotNull())
            .withColumn("activity_date", F.to_date("event_timestamp"))
            .withWatermark("event_timestamp", self.delay)
            .dropDuplicatesWithinWatermark(["user_id", "activity_date"])
            .select("user_id", "activity_date")
            .join(arms, "user_id", "left")
        )
        query = (
            active.writeStream.outputMode("append")
            .format("parquet")
            .option("path", f"{self.root}/active")
            .option("checkpointLocation", f"{self.root}/active-state")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        noted = self.spark.createDataFrame([(run, version)], "run bigint, version bigint")
        noted.coalesce(1).write.mode("append").parquet(f"{self.root}/runs")

    def _catch_up(self, run: int, before: versions.Entry, now: versions.Entry) -> None:
        """User-days of users whose assignments are new, written where a repeated run writes them again."""
        more = versions.added(before, now)
        if more is not None:
            new = _arms(versions.read(self.spark, more))
        else:
            old = _arms(versions.read(self.spark, before))
            new = _arms(versions.read(self.spark, now)).join(old, list(ARM_OF_USER), "left_anti")
        seen = self.spark.read.parquet(f"{self.root}/active").select("user_id", "activity_date").distinct()
        seen.join(new, "user_id").write.mode("overwrite").parquet(f"{self.root}/caught/run={run}")

    def daily_active(self) -> DataFrame:
        """metric_date, experiment_name, variant, active_users: as of the last run and the newest version."""
        columns = ["user_id", "activity_date", "experiment_name", "variant"]
        rows = self.spark.read.parquet(f"{self.root}/active").select(*columns).where("variant IS NOT NULL")
        if versions.exists(self.spark, f"{self.root}/caught"):
            rows = rows.unionByName(self.spark.read.parquet(f"{self.root}/caught").select(*columns))
        version = versions.latest(self.spark, self.tables)
        arms = _arms(versions.read(self.spark, self._assignments(version)))
        return (
            rows.distinct()
            .join(arms, list(ARM_OF_USER), "left_semi")
            .groupBy(F.col("activity_date").alias("metric_date"), "experiment_name", "variant")
            .agg(F.count("user_id").alias("active_users"))
        )
