"""Reading, loading and exporting canonical tables.

Files are written by the executors, split by Spark's own partitioning; nothing is gathered on
the driver or forced into one task.  Row counts of writes come from observed metrics of the
write itself, so no table is scanned a second time to be counted.
"""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trialscope import schemas as S
from trialscope.sources import versions
from trialscope.sources.tables import Tables

CHECKPOINT_KEY = "spark.checkpoint.dir"
WRITES_AT_A_TIME = 3


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as named by the cluster in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="trialscope-")
    spark.conf.set(CHECKPOINT_KEY, made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used before."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def table_path(root: str, table: str) -> str:
    return f"{root}/{table}"


def _status(spark: SparkSession, path: str):
    """The Hadoop file status of a path, or None when nothing is there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.getFileStatus(target) if files.exists(target) else None


def is_folder(spark: SparkSession, path: str) -> bool:
    status = _status(spark, path)
    return status is not None and status.isDirectory()


def _declared(table: str) -> list[tuple[str, str]]:
    """(column, type) pairs of a canonical table."""
    return [tuple(column.split()) for column in S.TABLE_DDL[table].split(", ")]


# How CSV files are written and read: quotes are doubled, NULL has a mark of its own (an empty field
# counts as NULL too), an empty text is quoted, white space and microseconds are kept.  A text that is the mark itself
# is read as NULL.
_CSV = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "\\N",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _has_quoted_line_ends(spark: SparkSession, path: str) -> bool:
    """Whether any line has an odd number of quotes, as one has whose text goes on in the next line."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()


def _raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text.  Line ends inside quotes belong to the text.

    Files that hold such line ends can not be split and are read by one task each; others are split like
    any text file.  Which it is takes one look at the lines, by many tasks, up to the first one found.
    """
    whole = _has_quoted_line_ends(spark, path)
    return spark.read.options(**_CSV).option("multiLine", whole).csv(path)


def _read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Declared columns by header name, so the order in the file does not matter.

    A value that can not be read becomes NULL; ``unreadable_values`` counts them, and the quality
    gate reports those that must not be NULL.
    """
    raw = _raw_csv(spark, path)
    return raw.select(
        *[F.col(c).try_cast(kind).alias(c) for c, kind in _declared(table) if c in raw.columns]
    )


def _source_path(spark: SparkSession, root: str, table: str, source: str) -> str | None:
    paths = [table_path(root, table), f"{table_path(root, table)}.{source}"]
    return next((p for p in paths if _status(spark, p) is not None), None)


def unreadable_values(
    spark: SparkSession, root: str, tables: Sequence[str] = S.CORE_TABLES
) -> DataFrame:
    """(table_name, column_name, lost): values of CSV files that become NULL when they are read."""
    parts = []
    for table in tables:
        path = _source_path(spark, root, table, "csv")
        if path is None:
            continue
        raw = _raw_csv(spark, path)
        columns = [(c, kind) for c, kind in _declared(table) if c in raw.columns]
        lost = [
            F.struct(
                F.lit(c).alias("column_name"),
                F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull()).alias("lost"),
            ).alias(c)
            for c, kind in columns
        ]
        row = raw.agg(*lost).select(F.inline(F.array(*[c for c, _ in columns])))
        parts.append(row.select(F.lit(table).alias("table_name"), "*"))
    empty = spark.createDataFrame([], "table_name string, column_name string, lost bigint")
    return reduce(DataFrame.unionByName, parts, empty)


def scan_tables(
    spark: SparkSession, root: str, source: str = "csv", tables: Sequence[str] = S.CORE_TABLES
) -> Tables:
    """Tables under ``root`` as ``<table>`` or ``<table>.<source>``; absent ones are left out."""
    found: dict[str, DataFrame] = {}
    for table in tables:
        path = _source_path(spark, root, table, source)
        if path is None:
            continue
        if source == "csv":
            found[table] = _read_csv(spark, path, table)
        else:
            found[table] = spark.read.schema(S.TABLE_DDL[table]).format(source).load(path)
    return Tables(found)


def _observed_write(df: DataFrame, path: str, source: str, mode: str, partition_by=()) -> int:
    counted = Observation()
    writer = df.observe(counted, F.count(F.lit(1)).alias("n")).write.mode(mode).format(source)
    if source == "csv":
        writer = writer.options(**_CSV)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return counted.get["n"]


def sink_raw(t: Mapping[str, DataFrame], root: str, source: str = "csv") -> dict[str, int]:
    """Write the core tables under ``root``; returns the rows written per table."""
    return {
        table: _observed_write(t[table], table_path(root, table), source, "overwrite")
        for table in S.CORE_TABLES
        if table in t
    }


def written_once(spark: SparkSession, t: Tables, root: str, tables: Sequence[str]) -> Tables:
    """``t`` with the named tables written under ``root`` and read from there.

    For tables that are expensive to derive and used by several jobs, each of which would derive them anew.
    """
    kept = {}
    for table in tables:
        t[table].write.parquet(table_path(root, table))
        kept[table] = spark.read.schema(t[table].schema).parquet(table_path(root, table))
    return t.replacing(**kept)


# Day columns by which the large tables are laid out, for partition pruning on date filters.
LAYOUT = {
    "sessions": ("session_date", "session_start"),
    "events": ("event_date", "event_timestamp"),
    "orders": ("order_date", "order_timestamp"),
}


class Staged(dict):
    """Entries of tables that are written but not published, and the version they are made from."""

    def __init__(self, base: int, before: Mapping[str, versions.Entry], replace: bool) -> None:
        super().__init__()
        self.base, self.before, self.replace = base, before, replace


def _write_part(df: DataFrame, root: str, table: str) -> tuple[str, int, float]:
    """Write rows to a new folder of a table; its path, the rows and the seconds it took.

    Facts are partitioned by day.  The rebalance hint gathers the rows of a day for few large
    files and lets adaptive execution split days that are too large for one task.
    """
    days = (LAYOUT[table][0],) if table in LAYOUT else ()
    if days:
        df = df.hint("rebalance", *days)
    path, start = f"{table_path(root, table)}/{uuid.uuid4().hex}", time.monotonic()
    rows = _observed_write(df, path, "parquet", "errorifexists", days)
    return path, rows, time.monotonic() - start


def stage(t: Mapping[str, DataFrame], root: str, truncate_first: bool = False) -> Staged:
    """Write the core tables as Parquet, parents before children, without publishing them.

    Unless ``truncate_first``, rows are added to those of the published version, except rows whose
    primary key it holds already, so a load can be repeated.
    """
    spark = next(iter(t.values())).sparkSession if t else None
    base, published = versions.current(spark, root) if spark else (0, {})
    before = {} if truncate_first else published
    staged = Staged(base, before, truncate_first)
    for table in S.CORE_TABLES:
        if table not in t:
            if table in before:
                staged[table] = before[table]
            continue
        df, earlier = t[table], before.get(table)
        if earlier is not None:
            key = S.PRIMARY_KEYS[table]
            df = df.join(versions.read(spark, earlier).select(key), key, "left_anti")
        if table in LAYOUT:
            day, ts = LAYOUT[table]
            df = df.withColumn(day, F.to_date(ts))
        path, rows, seconds = _write_part(df, root, table)
        paths = (*(earlier.paths if earlier else ()), path)
        staged[table] = versions.Entry(paths, df.schema.json(), rows, seconds)
    return staged


def rebase(spark: SparkSession, root: str, staged: Staged) -> Staged:
    """The same rows on top of the newest version, which others have published in the meantime.

    Rows that the others added win over rows of the same primary key here; only a table in which
    both have some is written again.  ``Conflict`` is raised where the newest version does not just go
    on from the one that ``staged`` is based on, or if ``staged`` replaces tables.
    """
    version, newest = versions.current(spark, root)
    moved = Staged(version, newest, False)
    moved.update({name: entry for name, entry in newest.items() if name not in staged})
    for table, entry in staged.items():
        known = staged.before.get(table)
        if entry == known:
            if table in newest:
                moved[table] = newest[table]
            continue
        now = newest.get(table, versions.Entry((), entry.schema, 0, 0.0))
        others = versions.added(known, now)
        if staged.replace or others is None:
            raise versions.Conflict(f"{table} was replaced after version {staged.base}, which the load is based on")
        path, rows, seconds = entry.paths[-1], entry.rows, entry.seconds
        if others.paths:
            key = S.PRIMARY_KEYS[table]
            own = versions.read(spark, versions.Entry((path,), entry.schema, rows, seconds))
            taken = versions.read(spark, others).select(key)
            if not own.join(taken, key, "left_semi").isEmpty():
                path, rows, seconds = _write_part(own.join(taken, key, "left_anti"), root, table)
        moved[table] = versions.Entry((*now.paths, path), entry.schema, rows, seconds)
    return moved


def publish(spark: SparkSession, root: str, staged: Staged, attempts: int = 100) -> Staged:
    """Publish staged tables, on top of what others published since; returns what was published."""
    for _ in range(attempts):
        try:
            versions.publish(spark, root, staged, staged.base)
            return staged
        except versions.Conflict:
            staged = rebase(spark, root, staged)
    raise versions.Conflict(f"{root} was changed by others {attempts} times in a row")


def bulk_load(
    t: Mapping[str, DataFrame], root: str, truncate_first: bool = False
) -> dict[str, int]:
    """``stage`` and publish at once; returns the rows written per table of ``t``.

    Until everything is written readers see the version before, also after a failure.  Of loads at the
    same time, those that add rows all go in; one that replaces tables which others have changed since
    it began raises ``versions.Conflict``.
    """
    staged = stage(t, root, truncate_first)
    if staged:
        staged = publish(next(iter(t.values())).sparkSession, root, staged)
    return {table: entry.rows for table, entry in staged.items() if table in t}


def read_staged(spark: SparkSession, staged: Mapping[str, versions.Entry]) -> Tables:
    return Tables({table: versions.read(spark, entry) for table, entry in staged.items()})


def read_loaded(spark: SparkSession, root: str) -> Tables:
    """The tables that were loaded under ``root``, with the types they were loaded with."""
    return read_staged(spark, versions.current(spark, root)[1])


def load_log(spark: SparkSession, root: str) -> DataFrame:
    """(version, published_at, table_name, rows, seconds, rows_per_second) of every load."""
    return (
        versions.log(spark, root)
        .select("version", "published_at", F.explode("tables").alias("table_name", "e"))
        .select(
            "version",
            "published_at",
            "table_name",
            "e.rows",
            "e.seconds",
            F.when(F.col("e.seconds") > 0, F.col("e.rows") / F.col("e.seconds")).alias(
                "rows_per_second"
            ),
        )
    )


def row_counts(t: Mapping[str, DataFrame], tables: Sequence[str] = S.CORE_TABLES) -> DataFrame:
    """(table_name, row_count) per table."""
    united = None
    for table in tables:
        row = t[table].agg(
            F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("row_count")
        )
        united = row if united is None else united.unionByName(row)
    return united


def row_count_reconcile(t: Mapping[str, DataFrame], expected: DataFrame) -> DataFrame:
    """Actual against expected row counts; ``expected`` has (table_name, row_count)."""
    tables = [name for name in S.CORE_TABLES if name in t]
    actual = row_counts(t, tables).withColumnRenamed("row_count", "actual")
    return (
        expected.withColumnRenamed("row_count", "expected")
        .join(actual, "table_name", "left")
        .select(
            "table_name",
            "expected",
            "actual",
            F.coalesce(F.col("expected") == F.col("actual"), F.lit(False)).alias("ok"),
        )
    )


def export_datasets(datasets: Mapping[str, DataFrame], root: str) -> dict[str, int]:
    """Write each dataset as CSV with a header; returns the rows of the non-empty ones.

    Whether a dataset is empty is known from its own write, so no query runs twice; a dataset
    without rows leaves no data file and is not reported.  Some are written at a time, so that the
    few long tasks at the end of one do not keep the executors waiting.
    """
    if not datasets:
        return {}

    def write(name: str) -> int:
        return _observed_write(datasets[name], f"{root}/{name}", "csv", "overwrite")

    spark = next(iter(datasets.values())).sparkSession
    with ThreadPoolExecutor(WRITES_AT_A_TIME) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(write), name) for name in datasets}
    rows = {name: job.result() for name, job in running.items()}
    return {name: n for name, n in rows.items() if n > 0}


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """An exported dataset with all columns as text."""
    return _raw_csv(spark, path)
