"""Streams over several arrivals: the same as their batch operators, after each arrival and after restarts."""

from __future__ import annotations

import datetime as dt
import os
import random
import tempfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.tiny import assignment, tables
from trialscope.operators import reports, sessions
from trialscope.sources import storage, versions
from trialscope.streaming import activity, allocation, continuing
from trialscope.streaming.replay import settings

COLUMNS = ("session_id", "user_id", "session_start", "session_end", "page_count", "is_bounce")


@pytest.fixture()
def root():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture(autouse=True)
def few_partitions(spark):
    with settings(spark, {"spark.sql.shuffle.partitions": "2"}):
        yield


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def events(spark, stamps):
    start = dt.datetime(2024, 1, 1)
    data = [(i, u, start + dt.timedelta(seconds=s) if s is not None else None) for i, u, s in stamps]
    return spark.createDataFrame(data, "event_id long, user_id string, event_timestamp timestamp_ntz")


def batch(df):
    return sessions.sessionize(df.dropDuplicates(["event_id"])).select(*COLUMNS)


def as_batch(df):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")}).select(*COLUMNS)


def test_readings_equal_the_batch_after_each_arrival_and_restart(spark, root):
    rng = random.Random(5)
    day = 86400
    arrivals, number = [], 0
    for k in range(3):
        some = []
        for _ in range(80):
            # Up to twenty hours behind the newest of the arrival before.
            some.append((number, f"u{rng.randint(0, 6)}", rng.randint(k * 2 * day - 20 * 3600 * (k > 0), (k + 1) * 2 * day)))
            number += 1
        arrivals.append(some)
    # A user who is active across all arrivals without a gap, repeated rows, and a row without time.
    long = [(1000 + i, "long", i * 3 * 3600) for i in range(48)]
    for k in range(3):
        arrivals[k] += [x for x in long if k * 2 * day <= x[2] < (k + 1) * 2 * day] + arrivals[k][:10]
    arrivals[1].append((5000, "nobody", None))
    so_far = []
    for some in arrivals:
        events(spark, some).repartition(2).write.mode("append").parquet(f"{root}/in")
        so_far += some
        stream = continuing.Continuing(spark, f"{root}/stream", f"{root}/in", continuing.SESSIONS)
        stream.advance()
        now = stream.now()
        assert rows(as_batch(now)) == rows(batch(events(spark, so_far)))
        assert stream.late_rows().isEmpty()
        # What is closed stays as it is.
        assert {r.user_id for r in now.where("is_open").collect()} >= {"long"}
        stream.advance()
        assert rows(as_batch(stream.now())) == rows(as_batch(now))
    assert stream.closed().count() > 50


def test_daily_allocation_with_open_days(spark, root):
    t = tables(spark)
    arriving = [t["experiments"].where("experiment_id < 'x3'"), t["experiments"].where("experiment_id >= 'x3'")]
    seen = None
    for some in arriving:
        some.write.mode("append").parquet(f"{root}/in")
        seen = some if seen is None else seen.unionByName(some)
        stream = continuing.Continuing(spark, f"{root}/stream", f"{root}/in", continuing.ALLOCATION)
        stream.advance()
        expected = reports.daily_srm_check(t.replacing(experiments=seen))
        assert rows(allocation.monitored(stream.now()).select(*expected.columns)) == rows(expected)


def test_late_rows_are_kept_over_many_micro_batches(spark, root):
    """150 micro-batches of one file each; every tenth brings a row that is a day and more too late."""
    base = dt.datetime(2024, 1, 1)
    late, taken = [], []
    for i in range(150):
        stamp = base + dt.timedelta(hours=i)
        some = [(2 * i, "a", stamp)]
        if i % 10 == 9 and i > 30:
            late.append((2 * i + 1, "b", base + dt.timedelta(minutes=i)))
            some.append(late[-1])
        taken.append((f"{root}/in/{i:04d}.parquet", some))
    os.mkdir(f"{root}/in")
    kind = pa.schema([("event_id", pa.int64()), ("user_id", pa.string()), ("event_timestamp", pa.timestamp("us"))])
    for number, (path, some) in enumerate(taken):
        pq.write_table(pa.table([list(c) for c in zip(*some)], schema=kind), path)
        os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))
    with settings(spark, {"spark.sql.shuffle.partitions": "1"}):
        stream = continuing.Continuing(
            spark, f"{root}/stream", f"{root}/in", continuing.SESSIONS, files_per_batch=1
        )
        stream.advance()
    assert {tuple(r) for r in stream.late_rows().select("event_id", "user_id").collect()} == {r[:2] for r in late}
    given = spark.read.parquet(f"{root}/in").where("user_id = 'a'")
    assert rows(as_batch(stream.now())) == rows(batch(given))
    # An audit that failed before it was noted is done again without doubling its rows.
    stream.advance()
    assert stream.late_rows().count() == len(late)


def test_daily_active_users_follow_the_published_assignments(spark, root):
    t = tables(spark)
    people = [assignment(f"p{i}", "A", "variant" if i % 2 else "control", f"u{i}", holdout=i == 5) for i in range(8)]
    assigned = tables(spark, experiments=people)["experiments"]
    storage.bulk_load({"experiments": assigned.where("user_id < 'u4'")}, f"{root}/tables")
    day, given = 86400, []

    def expected(now):
        return rows(
            events(spark, given).select("user_id", F.to_date("event_timestamp").alias("metric_date")).distinct()
            .join(now.where("not is_holdout"), "user_id")
            .groupBy("metric_date", "experiment_name", "variant").agg(F.count_distinct("user_id").alias("active_users"))
        )

    def take(k):
        some = [(k * 100 + i, f"u{i % 9}", k * day + i * 1800) for i in range(40)]
        given.extend(some)
        events(spark, some).write.mode("append").parquet(f"{root}/in")
        stream = activity.Activity(spark, f"{root}/stream", f"{root}/in", f"{root}/tables")
        stream.advance()
        return rows(stream.daily_active())

    assert take(0) == expected(assigned.where("user_id < 'u4'"))
    # Users that are assigned later count for the days that were taken before, too.
    storage.bulk_load({"experiments": assigned}, f"{root}/tables")
    assert take(1) == expected(assigned)
    # A replaced table: arms have changed, and an assignment is gone.
    changed = assigned.where("user_id <> 'u2'").withColumn(
        "variant", F.when(F.col("user_id") == "u3", "control").otherwise(F.col("variant"))
    )
    storage.bulk_load({"experiments": changed}, f"{root}/tables", truncate_first=True)
    assert take(2) == expected(changed)
    with pytest.raises(LookupError):
        activity.Activity(spark, f"{root}/other", f"{root}/in", f"{root}/nowhere").advance()
    assert versions.latest(spark, f"{root}/tables") == 3 and t
