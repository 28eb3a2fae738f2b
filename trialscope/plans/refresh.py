"""Materialized views as versioned Parquet tables, recomputed or brought up to date from changes.

A refresh writes new files and publishes them together (see ``sources.versions``), so a reader never sees
half-written files or one view newer than another.

``refresh_from_changes`` keeps, beside the views, additive states of the facts:

* per user: orders, revenue, last order, sessions and their sums, dealt to hashed buckets,
* per user and day: orders and revenue, dealt by day,
* per day and arm: the counts that the daily view is a window over.

A version of the tables that only adds files to ``orders`` and ``sessions`` is folded to the same grain,
and merged with the buckets and days it touches; the files of the others stay as they are.  Added users
or assignments are joined to the states once, still without reading old facts.  Everything is computed
anew where a table was replaced.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialscope.operators import views
from trialscope.operators.views import MATERIALIZED_VIEWS
from trialscope.sources import versions
from trialscope.sources.tables import Tables

#: Number of buckets that users are dealt to; a parameter of a folder of views, fixed by its first refresh.
BUCKETS = 64

_USERS, _DAYS, _DAILY = "_state_users", "_state_user_days", "_state_daily"
_USER_VIEW, _DAILY_VIEW = "mv_user_experiment_summary", "mv_daily_conversion"
_SOURCE = "_source_"


def refresh_materialized(
    spark: SparkSession, t: Mapping[str, DataFrame], root: str
) -> dict[str, str]:
    """Recompute and publish all materialized views; returns the path of each new version."""
    entries = {}
    for name, build in MATERIALIZED_VIEWS.items():
        path = f"{root}/{name}/{uuid.uuid4().hex}"
        view, start = build(t), time.monotonic()
        writer = view.hint("rebalance", "experiment_name").write
        writer.partitionBy("experiment_name").parquet(path)
        seconds = time.monotonic() - start
        entries[name] = versions.Entry((path,), view.schema.json(), -1, seconds)
    versions.publish(spark, root, entries)
    return {name: entry.paths[0] for name, entry in entries.items()}


def read_materialized(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The last published version of a view."""
    tables = versions.current(spark, root)[1]
    if name not in tables:
        raise LookupError(f"{name} has not been published under {root}")
    return versions.read(spark, tables[name])


# --- states that are dealt to parts ---------------------------------------------------------------


def _bucket() -> Column:
    return F.pmod(F.xxhash64("user_id"), F.lit(BUCKETS))


def _part_of(path: str) -> str:
    """The value that a part's folder is named after."""
    return path.rsplit("=", 1)[1]


@dataclass(frozen=True)
class _Parts:
    """A table whose rows are dealt to parts by a column; each part is a folder of its own."""

    spark: SparkSession
    root: str
    name: str
    by: Column

    def of(self, df: DataFrame) -> list[str]:
        """The parts that rows belong to: at most the number of buckets, or of days."""
        return [row[0] for row in df.select(self.by.cast("string")).distinct().collect()]

    def write(self, df: DataFrame, old: versions.Entry | None = None, touched: Iterable[str] = ()) -> versions.Entry:
        """New files for the rows of ``df``; parts of ``old`` that are not in ``touched`` stay as they are."""
        start, path = time.monotonic(), f"{self.root}/{self.name}/{uuid.uuid4().hex}"
        dealt = df.withColumn("_part", self.by.cast("string")).hint("rebalance", "_part")
        dealt.write.partitionBy("_part").parquet(path)
        new = [f"{path}/{name}" for name in versions.folders(self.spark, path)]
        stay = [p for p in (old.paths if old else ()) if _part_of(p) not in set(touched)]
        return versions.Entry((*stay, *new), df.schema.json(), -1, time.monotonic() - start)

    def read(self, entry: versions.Entry, parts: Iterable[str] | None = None) -> DataFrame:
        """The whole table, or only some of its parts, as one scan."""
        chosen = [p for p in entry.paths if parts is None or _part_of(p) in set(parts)]
        schema = T.StructType.fromJson(json.loads(entry.schema))
        return self.spark.read.schema(schema).parquet(*chosen) if chosen else self.spark.createDataFrame([], schema)


def _stores(spark: SparkSession, root: str) -> tuple[_Parts, _Parts, _Parts]:
    day = F.col("metric_date")
    return _Parts(spark, root, _USERS, _bucket()), _Parts(spark, root, _DAYS, day), _Parts(spark, root, _USER_VIEW, _bucket())


# --- folding and merging --------------------------------------------------------------------------


def _merged(rows: DataFrame, *keys: str) -> DataFrame:
    """One row per key: sums are added, the latest time and any purchase win; unknown sums stay unknown."""
    how = {"bought": F.bool_or, "last_purchase_date": F.max}
    kinds = {c: kind for c, kind in rows.dtypes if c not in keys}
    return rows.groupBy(*keys).agg(*[how.get(c, F.sum)(c).cast(kind).alias(c) for c, kind in kinds.items()])


def _folded_users(t: Mapping[str, DataFrame]) -> DataFrame:
    """Orders and sessions folded to one row per user."""
    united = views.orders_by_user(t).unionByName(views.sessions_by_user(t), allowMissingColumns=True)
    return _merged(united, "user_id")


def _folded_days(t: Mapping[str, DataFrame]) -> DataFrame:
    """Purchases of each user and day; those without a day never belong to one."""
    return views.sales_by_user_day(t).where(F.col("metric_date").isNotNull())


def refresh_from_changes(
    spark: SparkSession, tables_root: str, root: str, lookups: Mapping[str, DataFrame], attempts: int = 5
) -> str:
    """Bring the views under ``root`` up to the newest version of the tables; returns what was read.

    * ``nothing``: the version has no new orders, sessions, users or assignments,
    * ``facts``: the added files of facts, the parts of states and views they touch, and the assignments,
    * ``states``: also the states, the users and all assignments, but no old facts,
    * ``everything``: all tables.

    ``lookups`` are the tables that give users the names of their dimensions; views do not follow a
    change of theirs.  If someone else refreshes at the same time, what is still to do is done again.
    """
    for _ in range(attempts):
        _, now = versions.current(spark, tables_root)
        base, published = versions.current(spark, root)
        read, entries = _refreshed(spark, root, now, published, lookups)
        if read == "nothing":
            return read
        sources = {_SOURCE + name: entry for name, entry in now.items()}
        try:
            versions.publish(spark, root, {**entries, **sources}, base)
            return read
        except versions.Conflict:
            continue
    raise versions.Conflict(f"{root} was refreshed by others {attempts} times in a row")


def _refreshed(spark, root, now, published, lookups) -> tuple[str, dict[str, versions.Entry]]:
    needed = ("orders", "sessions", "users", "experiments")
    t = Tables({**lookups, **{name: versions.read(spark, now[name]) for name in needed}})
    if _DAILY not in published:
        return "everything", _from_everything(spark, root, t)
    changes = {name: versions.added(published.get(_SOURCE + name), now[name]) for name in needed}
    if any(change is None for change in changes.values()):
        return "everything", _from_everything(spark, root, t)
    grown = {name for name, change in changes.items() if change.paths}
    if not grown:
        return "nothing", {}
    new = Tables({name: versions.read(spark, change) for name, change in changes.items()})
    if grown <= {"orders", "sessions"}:
        return "facts", _from_facts(spark, root, t, new, published)
    return "states", _from_states(spark, root, t, new, published)


def _from_everything(spark: SparkSession, root: str, t: Tables) -> dict[str, versions.Entry]:
    users, days, view = _stores(spark, root)
    state, by_day = users.write(_folded_users(t)), days.write(_folded_days(t))
    return {_USERS: state, _DAYS: by_day, **_all_views(spark, root, t, users.read(state), days.read(by_day))}


def _all_views(spark, root, t, users: DataFrame, days: DataFrame) -> dict[str, versions.Entry]:
    """Both views from the whole states."""
    view = views.user_behaviour(views.profiled_assignments(t).join(users, "user_id", "left"))
    counts = views.daily_counts(views.assigned_per_day(t), views.sales_per_day(days, t))
    return {_USER_VIEW: _stores(spark, root)[2].write(view), **_daily_views(spark, root, counts)}


def _grown_states(spark, root, new: Tables, old):
    """Entries of the states with new facts, and the buckets and days that these touch."""
    users, days, _ = _stores(spark, root)
    folded, by_day = _folded_users(new), _folded_days(new)
    buckets, dates = users.of(folded), days.of(by_day)
    state = _merged(users.read(old[_USERS], buckets).unionByName(folded), "user_id")
    by_day = _merged(days.read(old[_DAYS], dates).unionByName(by_day), "user_id", "metric_date")
    entries = {_USERS: users.write(state, old[_USERS], buckets), _DAYS: days.write(by_day, old[_DAYS], dates)}
    return entries, buckets, dates


def _from_states(spark, root, t: Tables, new: Tables, old) -> dict[str, versions.Entry]:
    users, days, _ = _stores(spark, root)
    entries, _, _ = _grown_states(spark, root, new, old)
    return entries | _all_views(spark, root, t, users.read(entries[_USERS]), days.read(entries[_DAYS]))


def _from_facts(spark, root, t: Tables, new: Tables, old) -> dict[str, versions.Entry]:
    users, days, view = _stores(spark, root)
    entries, buckets, dates = _grown_states(spark, root, new, old)

    # What the view says of the assignments stays; what it says of the facts is made anew.
    assignments = view.read(old[_USER_VIEW], buckets).select(*views.ASSIGNMENT)
    behaviour = views.user_behaviour(assignments.join(users.read(entries[_USERS], buckets), "user_id", "left"))
    entries[_USER_VIEW] = view.write(behaviour, old[_USER_VIEW], buckets)

    counts = versions.read(spark, old[_DAILY])
    touched = F.col("metric_date").cast("string").isin(dates)
    assigned = counts.where(touched).select("metric_date", *views.ARM, "users_assigned")
    again = views.daily_counts(assigned, views.sales_per_day(days.read(entries[_DAYS], dates), t))
    return entries | _daily_views(spark, root, counts.where(~touched).unionByName(again))


def _daily_views(spark: SparkSession, root: str, counts: DataFrame) -> dict[str, versions.Entry]:
    """The counts per day and arm, and the view, which is windows over them."""
    out = {}
    for name, build in ((_DAILY, lambda df: df), (_DAILY_VIEW, lambda df: views.with_cumulative_rate(views.daily_rates(df)))):
        df, path, start = build(counts), f"{root}/{name}/{uuid.uuid4().hex}", time.monotonic()
        df.hint("rebalance").write.parquet(path)
        out[name] = versions.Entry((path,), df.schema.json(), -1, time.monotonic() - start)
        counts = versions.read(spark, out[_DAILY])
    return out
