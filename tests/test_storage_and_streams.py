from __future__ import annotations

import datetime as dt
import random
import tempfile
import threading

import pytest
from pyspark.sql import functions as F

from tests.tiny import ROWS, at, one, tables
from trialscope import schemas as S
from trialscope.operators import constraints, reporting, reports, sessions, views
from trialscope.plans import refresh, registry
from trialscope.sources import lookups, storage
from trialscope.streaming import allocation, replay
from trialscope.streaming.sessions import stream_sessionize


@pytest.fixture()
def root():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_csv_round_trip(spark, root):
    t = tables(spark)
    written = storage.sink_raw(t, root)
    assert written["orders"] == 6
    back = storage.scan_tables(spark, root)
    for name in S.CORE_TABLES:
        assert rows(back[name].na.fill("")) == rows(t[name].na.fill("")), name
    assert views.experiment_summary(t).collect() and views.experiment_summary(back).collect()


def test_csv_columns_are_found_by_name(spark, root):
    with open(f"{root}/orders.csv", "w") as f:
        f.write("payment_status,order_id,user_id,session_id,event_id,order_timestamp,order_value,"
                "is_refund,payment_method,extra\n"
                "completed,o1,u1,s1,,2024-01-01 10:00:00+00:00,12.5,False,paypal,x\n"
                "refunded,o2,u1,s1,e1,2024-01-02T10:00:00,oops,True,paypal,y\n")
    orders = storage.scan_tables(spark, root)["orders"]
    assert orders.columns == [c.split()[0] for c in S.TABLE_DDL["orders"].split(", ")]
    first, second = one(orders, order_id="o1"), one(orders, order_id="o2")
    assert float(first["order_value"]) == 12.5 and first["is_refund"] is False
    assert first["event_id"] is None and first["order_timestamp"].hour == 10
    assert second["order_value"] is None and second["is_refund"] is True


def test_absent_files_are_left_out(spark, root):
    t = tables(spark)
    storage.sink_raw({"users": t["users"], "orders": t["orders"]}, root, "parquet")
    assert set(storage.scan_tables(spark, root, "parquet")) == {"users", "orders"}
    assert set(storage.scan_tables(spark, f"{root}/nowhere")) == set()


def test_bulk_load_appends_or_replaces(spark, root):
    t = tables(spark)
    assert list(storage.bulk_load(t, root)) == list(S.CORE_TABLES)
    # The same rows again add nothing; new ones are added.
    assert set(storage.bulk_load(t, root).values()) == {0}
    assert storage.read_loaded(spark, root)["events"].count() == 7
    more = t["events"].limit(2).withColumn("event_id", F.concat(F.lit("new"), F.col("event_id")))
    assert storage.bulk_load({"events": more}, root) == {"events": 2}
    assert storage.read_loaded(spark, root)["events"].count() == 9
    assert storage.read_loaded(spark, root)["users"].count() == t["users"].count()
    log = storage.load_log(spark, root).collect()
    assert {r.version for r in log} == {1, 2, 3} and all(r.seconds > 0 for r in log)
    loaded = storage.bulk_load(t, root, truncate_first=True)
    expected = spark.createDataFrame([*loaded.items()], "table_name string, row_count long")
    report = storage.row_count_reconcile(storage.read_loaded(spark, root), expected)
    assert {r.ok for r in report.collect()} == {True}
    wrong = spark.createDataFrame([("users", 99), ("absent", 1)], "table_name string, row_count long")
    assert {r.ok for r in storage.row_count_reconcile(t, wrong).collect()} == {False}


def test_refresh_publishes_the_last_complete_version(spark, root):
    t = tables(spark)
    refresh.refresh_materialized(spark, t, root)
    name = "mv_user_experiment_summary"
    before = refresh.read_materialized(spark, root, name)
    assert before.count() == 5
    fewer = t.replacing(experiments=t["experiments"].where("experiment_name = 'A'"))
    refresh.refresh_materialized(spark, fewer, root)
    assert refresh.read_materialized(spark, root, name).count() == 4
    assert before.count() == 5
    # A version whose pointer was never written stays invisible.
    t["experiments"].write.parquet(f"{root}/{name}/unfinished")
    assert refresh.read_materialized(spark, root, name).count() == 4
    with pytest.raises(LookupError):
        refresh.read_materialized(spark, root, "absent")


def test_exports_skip_empty_datasets(spark, root):
    bundle = reporting.dataset_bundle(tables(spark))
    bundle["nothing"] = bundle["user_level_data"].where("1 = 0")
    written = storage.export_datasets(bundle, root)
    assert set(written) == set(reporting.DATASETS)
    back = spark.read.option("header", True).csv(f"{root}/user_level_data")
    assert back.count() == 5 and "user_id" in back.columns


def test_exports_are_written_some_at_a_time(spark, root, monkeypatch):
    both = threading.Barrier(2, timeout=60)
    write = storage._observed_write

    def meeting(*args):
        both.wait()
        return write(*args)

    monkeypatch.setattr(storage, "_observed_write", meeting)
    one_row = spark.range(1)
    assert storage.export_datasets({"a": one_row, "b": one_row.where("id > 0")}, root) == {"a": 1}
    assert storage.export_datasets({}, root) == {}


def test_a_failed_export_raises(spark, root):
    bad = spark.range(1).select(F.raise_error(F.lit("no such thing")).cast("string").alias("x"))
    with pytest.raises(Exception, match="no such thing"):
        storage.export_datasets({"good": spark.range(1), "bad": bad}, root)


@pytest.mark.parametrize("name", ["export_datasets", "dataset_bundle"])
def test_datasets_derive_the_sessions_once(spark, name):
    t, made = tables(spark), spark.sparkContext.accumulator(0)

    def count(pages):
        made.add(1)
        return pages

    counted = F.udf(count, "int").asNondeterministic()
    counting = t["sessions"].withColumn("page_count", counted("page_count")).withColumn("is_bounce", F.col("page_count") == 1)
    n = t["sessions"].count()
    rows_ = registry._OVER_TABLES[name](spark, t.replacing(sessions=counting)).collect()
    assert {r.dataset for r in rows_} == set(reporting.DATASETS)
    assert made.value == n


def test_lookups_keep_existing_rows(spark):
    t = tables(spark)
    seeded = lookups.seed_lookups(spark, t)
    channels = {r.channel_name: r.channel_id for r in seeded["acquisition_channels"].collect()}
    assert channels["email"] == 1 and channels["direct"] == 2
    assert sorted(channels.values()) == list(range(1, 10))
    countries = {r.country_code: r for r in seeded["countries"].collect()}
    assert len(countries) == 22
    regions = {r.region_name: r.region_id for r in seeded["regions"].collect()}
    assert countries["JP"].region_id == regions["Asia Pacific"]


def test_standard_lookups(spark):
    standard = lookups.standard_lookups(spark)
    assert {n: df.count() for n, df in standard.items()} == {
        "regions": 5, "countries": 20, "devices": 3, "browsers": 6, "acquisition_channels": 9,
        "event_types": 18,
    }
    assert one(standard["event_types"], event_name="purchase")["event_type_id"] == 9
    assert one(standard["countries"], country_code="BR")["region_id"] == 4


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get(storage.CHECKPOINT_KEY, None)
    assert named is None or storage.shared_folder(spark) == named.rstrip("/")
    assert storage.scratch_path(spark, "a") != storage.scratch_path(spark, "a")


def _events(spark, stamps):
    data = [(i, u, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s))
            for i, (u, s) in enumerate(stamps)]
    return spark.createDataFrame(data, "event_id long, user_id string, event_timestamp timestamp_ntz")


def _brute(stamps, gap):
    expected = set()
    for u in {u for u, _ in stamps}:
        run = []
        for s, i in sorted((s, i) for i, (v, s) in enumerate(stamps) if v == u):
            if run and s - run[-1][0] > gap:
                expected.add((min(i for _, i in run), u, len(run)))
                run = []
            run.append((s, i))
        expected.add((min(i for _, i in run), u, len(run)))
    return expected


def test_sessions_match_brute_force_with_a_hot_user(spark):
    rng = random.Random(3)
    stamps = [("hot", rng.randint(0, 400_000)) for _ in range(900)]
    stamps += [(f"u{rng.randint(0, 30)}", rng.randint(0, 400_000)) for _ in range(900)]
    # Exactly one gap apart belongs together, a second more does not; also before the epoch.
    stamps += [("edge", 0), ("edge", 3600), ("edge", 7201), ("old", -2_000_000_000), ("old", -1_999_999_000)]
    events = _events(spark, stamps)
    found = {(r.session_id, r.user_id, r.page_count)
             for r in sessions.sessionize(events, gap_minutes=60).collect()}
    assert found == _brute(stamps, 3600)
    windows = events.groupBy("user_id", F.session_window("event_timestamp", "60 minutes")).count()
    assert windows.count() == len(found)
    tagged = sessions.with_session_id(events, gap_minutes=60).groupBy("session_id", "user_id").count()
    assert {tuple(r) for r in tagged.collect()} == found


def test_derived_orders(spark):
    found = {r.order_id: r.order_value for r in sessions.derive_orders(tables(spark)["events"]).collect()}
    assert {k: float(v) for k, v in found.items()} == {"e2": 20.0, "e6": 50.0}
    with pytest.raises(ValueError):
        sessions.derive_orders(tables(spark)["events"].drop("revenue"))


@pytest.mark.parametrize("kind", ["small", "large", "uuid"])
def test_assignment_is_stable_split_and_independent(spark, kind):
    identity = {
        "small": F.col("id"),
        "large": F.col("id") + F.lit(1_200_000_000_000_000_000),
        "uuid": F.regexp_replace(F.md5(F.col("id").cast("string")), "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"),
    }[kind]
    users = spark.range(40000).select(identity.alias("user_id"))
    plan = (("a", 500), ("b", 420), ("c", 200))
    first = sessions.assign_variants(users, plan).cache()
    assert rows(first.groupBy("experiment_name", "variant", "assignment_date").count()) == rows(
        sessions.assign_variants(users.repartition(5), plan)
        .groupBy("experiment_name", "variant", "assignment_date").count())
    wide = (
        first.where("not is_holdout").groupBy("user_id").pivot("experiment_name", list("abc"))
        .agg(F.first(F.col("variant") == "variant")).cache()
    )
    for name, share in (("a", 0.5), ("b", 0.42), ("c", 0.2)):
        for other in "abc".replace(name, ""):
            for arm in (True, False):
                found = wide.where(F.col(other) == arm).agg(F.avg(F.col(name).cast("int"))).first()[0]
                assert found == pytest.approx(share, abs=0.02), (name, other, arm)
    held = first.where("is_holdout and experiment_name = 'a'")
    assert held.where("variant <> 'control'").isEmpty() and 650 < held.count() < 950
    days = first.where("experiment_name = 'b'").groupBy("assignment_date").count().collect()
    assert len(days) == 14 and min(d["count"] for d in days) > 2500
    with pytest.raises(ValueError):
        sessions.assign_variants(users, (("a", 1), ("a", 2)))


def _closed(name: str):
    return {"event_id": 10**6, "user_id": name, "event_timestamp": dt.datetime(9999, 1, 1)}


def test_streamed_sessions_equal_batch_sessions(spark, root):
    rng = random.Random(5)
    stamps = [(f"u{rng.randint(0, 20)}", rng.randint(0, 3 * 86400)) for _ in range(600)]
    events = _events(spark, stamps)
    # Repeated events are dropped; the closing row itself leaves no session.
    doubled = events.unionByName(events.where("event_id < 50"))
    doubled.coalesce(1).write.parquet(f"{root}/in")
    stream = replay.read_files_as_stream(spark, f"{root}/in")
    found = replay.run_available(stream, stream_sessionize, _closed("end"), "test")
    columns = ("session_id", "user_id", "page_count", "duration_seconds", "is_bounce")
    assert rows(found.select(*columns)) == rows(sessions.sessionize(events).select(*columns))


def test_rows_that_come_too_late_are_not_lost_in_silence(spark, root):
    _events(spark, [("a", 10 * 86400)]).coalesce(1).write.parquet(f"{root}/in")
    _events(spark, [("late", 0), ("late", 60)]).withColumn("event_id", F.col("event_id") + 10).coalesce(
        1).write.parquet(f"{root}/more")
    schema = spark.read.parquet(f"{root}/in").schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
    first, second = reader.parquet(f"{root}/in"), reader.parquet(f"{root}/more")
    ok = replay.run_available(first.unionByName(second), stream_sessionize, _closed("end"), "test")
    assert ok.count() == 2
    early = {**_closed("end"), "event_timestamp": dt.datetime(2023, 1, 1)}
    with pytest.raises(replay.LateRows):
        replay.run_available(first, stream_sessionize, early, "test")


def test_late_events_are_dropped_and_counted(spark, root):
    first = _events(spark, [("a", 10 * 86400)])
    first.coalesce(1).write.parquet(f"{root}/in")
    stream = spark.readStream.schema(first.schema).parquet(f"{root}/in")
    query = (
        stream_sessionize(stream).writeStream.outputMode("append").format("parquet")
        .option("path", f"{root}/out").option("checkpointLocation", f"{root}/state").start()
    )
    query.processAllAvailable()
    _events(spark, [("late", 0), ("late", 60)]).withColumn("event_id", F.col("event_id") + 10).coalesce(
        1).write.mode("append").parquet(f"{root}/in")
    query.processAllAvailable()
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress
                  for op in p["stateOperators"])
    query.stop()
    assert dropped >= 2
    assert "late" not in {r.user_id for r in spark.read.parquet(f"{root}/out").collect()}


def test_streamed_allocation_is_the_batch_check(spark, root):
    t = tables(spark, experiments=ROWS["experiments"] + [
        ("z", "A", "control", "u9", at(30), False)])
    t["experiments"].write.parquet(f"{root}/in")
    stream = replay.read_files_as_stream(spark, f"{root}/in")
    closing = {"experiment_id": "end", "experiment_name": "", "variant": "control", "user_id": "end",
               "assignment_timestamp": dt.datetime(9999, 1, 1), "is_holdout": False}
    days = allocation.monitored(
        replay.run_available(stream, allocation.stream_daily_allocation, closing, "test"))
    row = one(days, experiment_name="A", metric_date=at(1).date())
    assert (row["daily_users_control"], row["daily_users_variant"]) == (1, 1)
    assert row["actual_daily_variant_fraction"] == 0.5
    batch = reports.daily_srm_check(t)
    assert rows(days.select(*batch.columns)) == rows(batch)


def test_csv_keeps_texts(spark, root):
    odd = ["a\nb", 'say "hi"', "", None, " lead and trail ", "a,b", "x\r\ny", "\\", '"', "NULL", "é\tz"]
    events = tables(spark)["events"].limit(1).drop("page_url").crossJoin(
        spark.createDataFrame([(x, i) for i, x in enumerate(odd)], "page_url string, i int"))
    events = events.withColumn("event_id", F.col("i").cast("string"))
    storage.sink_raw({"events": events.select(*S.declared_columns("events"))}, root)
    back = storage.scan_tables(spark, root)["events"]
    assert {int(r.event_id): r.page_url for r in back.collect()} == dict(enumerate(odd))
    assert back.where("event_timestamp is null").isEmpty()


def test_unreadable_values_are_counted(spark, root):
    with open(f"{root}/orders.csv", "w") as f:
        f.write("order_id,order_value,is_refund\no1,12.5,False\no2,oops,maybe\no3,,True\n")
    lost = {(r.table_name, r.column_name): r.lost for r in storage.unreadable_values(spark, root).collect()}
    assert lost == {("orders", "order_id"): 0, ("orders", "order_value"): 1, ("orders", "is_refund"): 1}
    assert storage.unreadable_values(spark, f"{root}/nowhere").isEmpty()


def test_empty_and_absent_tables_can_be_read_back(spark, root):
    t = tables(spark)
    none = {n: df.where("1 = 0") for n, df in t.items() if n in ("events", "experiments")}
    storage.bulk_load({**none, "users": t["users"]}, root)
    back = storage.read_loaded(spark, root)
    assert set(back) == {"users", "events", "experiments"}
    assert back["events"].count() == 0 and back["users"].count() == t["users"].count()
    assert set(storage.read_loaded(spark, f"{root}/nowhere")) == set()
    empty = t.replacing(experiments=t["experiments"].where("1 = 0"))
    refresh.refresh_materialized(spark, empty, f"{root}/views")
    for name in views.MATERIALIZED_VIEWS:
        assert refresh.read_materialized(spark, f"{root}/views", name).count() == 0


def test_a_failed_load_leaves_the_version_before(spark, root):
    t = tables(spark)
    storage.bulk_load(t, root)
    broken = t["orders"].withColumn("order_value", F.raise_error(F.lit("no")).cast("decimal(12,2)"))
    with pytest.raises(Exception, match="no"):
        storage.bulk_load({"users": t["users"].where("1 = 0"), "orders": broken}, root, truncate_first=True)
    assert storage.read_loaded(spark, root)["users"].count() == t["users"].count()


def test_derived_orders_pass_the_contract(spark):
    orders = sessions.derive_orders(tables(spark)["events"])
    found = constraints.schema_check({"orders": orders}).collect()
    assert not [r for r in found if r.severity == "ERROR" and r.column_name != "session_id"]


def test_files_without_quoted_line_ends_are_split(spark, root):
    with open(f"{root}/orders.csv", "w") as f:
        f.write("order_id,payment_method\n" + "".join(f'o{i},"say ""x"" {i}"\n' for i in range(20_000)))
    from trialscope.streaming.replay import settings

    with settings(spark, {"spark.sql.files.maxPartitionBytes": "65536", "spark.sql.files.openCostInBytes": "1"}):
        assert not storage._has_quoted_line_ends(spark, f"{root}/orders.csv")
        orders = storage.scan_tables(spark, root)["orders"]
        assert orders.rdd.getNumPartitions() > 3
        assert orders.count() == 20_000 and orders.where("payment_method = 'say \"x\" 19999'").count() == 1
    with open(f"{root}/users.csv", "w") as f:
        f.write('user_id,operating_system\nu1,"two\nlines"\nu2,x\n')
    assert storage._has_quoted_line_ends(spark, f"{root}/users.csv")
    assert storage.scan_tables(spark, root)["users"].count() == 2
