"""Several writers at once, and views brought up to date from what a version added."""

from __future__ import annotations

import re
import tempfile
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tests.tiny import ROWS, at, order, session, tables, user, assignment
from trialscope.operators import views
from trialscope.plans import refresh
from trialscope.sources import storage, versions
from trialscope.streaming.replay import settings


@pytest.fixture()
def root():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture(autouse=True)
def few_partitions(spark):
    with settings(spark, {"spark.sql.shuffle.partitions": "2"}):
        yield


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_one_writer_creates_a_file(spark, root):
    def create(i):
        return versions.create_once(spark, f"{root}/a/1.json", f"writer {i}\n" * 1000)

    with ThreadPoolExecutor(16) as pool:
        done = list(pool.map(create, range(64)))
    assert done.count(True) == 1
    lines = open(f"{root}/a/1.json").read().splitlines()
    assert len(lines) == 1000 and len(set(lines)) == 1 and lines[0] == f"writer {done.index(True)}"


def test_rename_without_replacement(spark, root):
    """What file systems other than local ones use."""
    files, target = versions._file_system(spark, f"{root}/b/1.json")
    assert versions._renamed_once(spark, files, f"{root}/b/.one", target, "first")
    assert not versions._renamed_once(spark, files, f"{root}/b/.two", target, "second")
    assert open(f"{root}/b/1.json").read() == "first"
    assert not versions.exists(spark, f"{root}/b/.two")


def test_version_numbers_are_never_given_twice(spark, root):
    entry = versions.Entry((), "{}", 0, 0.0)

    def publish(i):
        return versions.publish(spark, root, {f"t{i}": entry})

    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(publish, range(12)))
    assert sorted(numbers) == list(range(1, 13)) and versions.latest(spark, root) == 12
    with pytest.raises(versions.Conflict):
        versions.publish(spark, root, {}, base=11)
    assert versions.publish(spark, root, {"x": entry}, base=12) == 13
    assert versions.log(spark, root).count() == 13
    assert set(versions.at(spark, root, 13)) == {"x"}


def test_two_loads_at_once_both_survive(spark, root):
    t = tables(spark)
    storage.bulk_load(t, root)
    # Both start from version 1; o8 is in both of them.
    one = tables(spark, orders=[order(x, "u1", "s1", at(4), 7) for x in ("o7", "o8")])
    two = tables(spark, orders=[order(x, "u2", "s2", at(4), 9) for x in ("o8", "o9")])
    first, second = storage.stage({"orders": one["orders"]}, root), storage.stage({"orders": two["orders"]}, root)
    users = storage.stage({"users": tables(spark, users=[user("u9")])["users"]}, root)
    assert storage.publish(spark, root, first)["orders"].rows == 2
    assert storage.publish(spark, root, second)["orders"].rows == 1
    storage.publish(spark, root, users)
    back = storage.read_loaded(spark, root)
    found = {r.order_id: r.order_value for r in back["orders"].collect()}
    assert set(found) == {f"o{i}" for i in range(1, 10)} and found["o8"] == 7
    assert back["orders"].count() == 9 and back["users"].count() == 7
    assert versions.latest(spark, root) == 4

    with ThreadPoolExecutor(3) as pool:
        parts = [
            {"orders": tables(spark, orders=[order(f"p{i}", "u1", "s1", at(5), 1)])["orders"]} for i in range(3)
        ]
        assert list(pool.map(lambda part: storage.bulk_load(part, root), parts)) == [{"orders": 1}] * 3
    assert storage.read_loaded(spark, root)["orders"].count() == 12
    assert versions.latest(spark, root) == 7


def test_a_load_that_replaces_does_not_remove_what_it_has_not_seen(spark, root):
    t = tables(spark)
    storage.bulk_load(t, root)
    replacing = storage.stage({"orders": t["orders"].limit(1)}, root, truncate_first=True)
    adding = storage.stage({"orders": tables(spark, orders=[order("o7", "u1", "s1", at(4), 7)])["orders"]}, root)
    storage.publish(spark, root, adding)
    with pytest.raises(versions.Conflict):
        storage.publish(spark, root, replacing)
    # And the other way round: rows are not added to a table that was replaced.
    adding = storage.stage({"orders": tables(spark, orders=[order("o8", "u1", "s1", at(4), 7)])["orders"]}, root)
    storage.bulk_load(t, root, truncate_first=True)
    with pytest.raises(versions.Conflict):
        storage.publish(spark, root, adding)
    assert storage.read_loaded(spark, root)["orders"].count() == 6


def views_of(spark, root):
    return {name: rows(refresh.read_materialized(spark, root, name)) for name in views.MATERIALIZED_VIEWS}


def expected(t):
    return {name: rows(build(t)) for name, build in views.MATERIALIZED_VIEWS.items()}


MORE = {
    "orders": [
        order("n1", "u1", "s1", at(1, 12), "5.50"), order("n2", "u2", "s3", at(3, 9), "8.00"),
        order("n3", "u3", "s1", at(9), "1.00"), order("n4", "u2", "s2", at(2), "3.00", "refunded", True),
        ("n5", "u4", "s4", None, None, order("x", "u4", "s4", at(1), 1)[5], "paypal", False, "completed"),
    ],
    "sessions": [session("s8", "u3", at(5, 10), at(5, 11), 4), session("s9", "u2", at(6), at(6), 1, True)],
}


def test_views_follow_added_facts(spark, root):
    t = tables(spark)
    lookups = {n: t[n] for n in ("devices", "countries", "regions", "acquisition_channels")}

    def refreshed():
        return refresh.refresh_from_changes(spark, root, f"{root}/views", lookups)

    def now():
        return t.replacing(**storage.read_loaded(spark, root))

    storage.bulk_load(t, root)
    assert refreshed() == "everything" and views_of(spark, f"{root}/views") == expected(t)
    assert refreshed() == "nothing" and versions.latest(spark, f"{root}/views") == 1
    storage.bulk_load({"events": t["events"].limit(0)}, root)
    assert refreshed() == "nothing"

    more = tables(spark, **MORE)
    storage.bulk_load({"orders": more["orders"]}, root)
    assert refreshed() == "facts" and views_of(spark, f"{root}/views") == expected(now())
    storage.bulk_load({"sessions": more["sessions"]}, root)
    assert refreshed() == "facts" and views_of(spark, f"{root}/views") == expected(now())

    # A user whose assignment came first, a new assignment, and a second assignment row of a user.
    people = tables(spark, users=[user("u7")], experiments=[
        assignment("y1", "A", "variant", "u7", 2), assignment("y2", "B", "variant", "u3", 1),
        assignment("y3", "A", "control", "u1", 4), assignment("y4", "A", "control", "u8", 2)])
    storage.bulk_load({"experiments": people["experiments"]}, root)
    assert refreshed() == "states" and views_of(spark, f"{root}/views") == expected(now())
    storage.bulk_load({"users": people["users"], "orders": tables(spark, orders=[
        order("n9", "u7", "s1", at(2), 4)])["orders"]}, root)
    assert refreshed() == "states" and views_of(spark, f"{root}/views") == expected(now())

    storage.bulk_load(t, root, truncate_first=True)
    assert refreshed() == "everything" and views_of(spark, f"{root}/views") == expected(t)


def files_read(df):
    plan = df._jdf.queryExecution().toString()
    return re.findall(r"InMemoryFileIndex\(\d+ paths\)\[([^\]]*)\]", plan)


def test_only_new_files_and_touched_parts_are_read(spark, root, monkeypatch):
    rows_ = {
        "users": [user(f"u{i}") for i in range(200)],
        "experiments": [assignment(f"x{i}", "A", "variant" if i % 2 else "control", f"u{i}", 1 + i % 9) for i in range(200)],
        "orders": [order(f"o{i}", f"u{i}", "s1", at(1 + i % 9), 10) for i in range(200)],
        "sessions": [session(f"s{i}", f"u{i}", at(1), at(1, 2)) for i in range(200)],
    }
    t = tables(spark, **rows_)
    lookups = {n: t[n] for n in ("devices", "countries", "regions", "acquisition_channels")}
    storage.bulk_load(t, root)
    refresh.refresh_from_changes(spark, root, f"{root}/views", lookups)
    base = versions.current(spark, f"{root}/views")[1]
    storage.bulk_load({"orders": tables(spark, orders=[order("new", "u7", "s7", at(3), 5)])["orders"]}, root)

    read = []
    parquet = type(spark.read).parquet
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *paths, **o: read.extend(paths) or parquet(self, *paths, **o))
    entered = []
    original = refresh._from_facts

    def facts(spark, root, t, new, old):
        # Tables are named before; what counts is which of them the plans really scan.
        entered.append({n: set(e.paths) for n, e in versions.current(spark, root)[1].items()})
        lazy = {n: t[n] for n in ("orders", "sessions", "users")}
        broken = t.replacing(**{n: df.where(F.raise_error(F.lit(f"{n} was read")).isNull()) for n, df in lazy.items()})
        return original(spark, root, broken, new, old)

    monkeypatch.setattr(refresh, "_from_facts", facts)
    assert refresh.refresh_from_changes(spark, root, f"{root}/views", lookups) == "facts" and entered
    monkeypatch.undo()

    after = versions.current(spark, f"{root}/views")[1]
    for name, touched in (("_state_users", 1), ("mv_user_experiment_summary", 1), ("_state_user_days", 1)):
        old, new = set(base[name].paths), set(after[name].paths)
        assert len(new - old) == touched and len(old - new) == touched
        # Parts that stay are not even listed.
        assert not (set(read) & (old & new))
    assert views_of(spark, f"{root}/views") == expected(t.replacing(**storage.read_loaded(spark, root)))


def test_refreshing_twice_at_once(spark, root):
    t = tables(spark)
    lookups = {n: t[n] for n in ("devices", "countries", "regions", "acquisition_channels")}
    storage.bulk_load(t, root)
    with ThreadPoolExecutor(2) as pool:
        read = list(pool.map(lambda _: refresh.refresh_from_changes(spark, root, f"{root}/views", lookups), range(2)))
    assert "everything" in read and views_of(spark, f"{root}/views") == expected(t)
    assert ROWS
