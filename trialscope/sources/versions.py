"""Versioned tables: files are written first and then published together by one numbered pointer file.

A reader sees all tables of a version or none of them, and a write that fails leaves the version before
in place.  The pointer of version n + 1 can be created only once, so of writers that publish at the same
time one gets the number and the others learn that they lost the race; what they then do is theirs to
decide (``storage.bulk_load`` puts its rows on top of the version that won).
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Mapping
from dataclasses import asdict, dataclass
from datetime import UTC, datetime
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINTER = "_versions"
_ENTRY = "struct<paths:array<string>,schema:string,rows:bigint,seconds:double>"
_DDL = f"version bigint, published_at timestamp, tables map<string,{_ENTRY}>"


class Conflict(RuntimeError):
    """Someone else has published since the version that a write is based on."""


@dataclass(frozen=True)
class Entry:
    """Where a table's files are, their schema, and what the last write of them took."""

    paths: tuple[str, ...]
    schema: str
    rows: int
    seconds: float


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _file_system(spark, path)
    return files.exists(target)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, sorted."""
    files, target = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(target) if s.isDirectory())


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its whole content; False if there is one of that name already.

    Of several writers exactly one succeeds: on local and mounted folders by a hard link, elsewhere by
    a rename that does not replace its target, which has to be atomic there, as it is on HDFS.
    """
    files, target = _file_system(spark, path)
    files.mkdirs(target.getParent())
    draft = f"{target.getParent().toUri().getPath()}/.{uuid.uuid4().hex}"
    if files.getUri().getScheme() == "file":
        with open(draft, "w") as file:
            file.write(text)
            file.flush()
            os.fsync(file.fileno())
        try:
            os.link(draft, target.toUri().getPath())
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
        return True
    return _renamed_once(spark, files, f"{target.getParent()}/{os.path.basename(draft)}", target, text)


def _renamed_once(spark: SparkSession, files, draft: str, target, text: str) -> bool:
    gateway, jvm = spark.sparkContext._gateway, spark.sparkContext._jvm
    source = jvm.org.apache.hadoop.fs.Path(draft)
    stream = files.create(source, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), conf)
    plain = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(source, target, plain)
    except Py4JJavaError as error:
        files.delete(source, False)
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def _pointer(root: str, version: int) -> str:
    return f"{root}/{POINTER}/{version:020d}.json"


def latest(spark: SparkSession, root: str) -> int:
    """The number of the newest version, 0 without any; from the names of the pointer files."""
    files, folder = _file_system(spark, f"{root}/{POINTER}")
    if not files.exists(folder):
        return 0
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return max((int(n.removesuffix(".json")) for n in names if n[0].isdigit()), default=0)


def log(spark: SparkSession, root: str) -> DataFrame:
    """All pointer rows under ``root``."""
    if not latest(spark, root):
        return spark.createDataFrame([], _DDL)
    return spark.read.schema(_DDL).json(f"{root}/{POINTER}")


def at(spark: SparkSession, root: str, version: int) -> dict[str, Entry]:
    """The tables of a version; version 0 has none.  Fetches one row to the driver."""
    if not version:
        return {}
    row = spark.read.schema(_DDL).json(_pointer(root, version)).first()
    return {n: Entry(tuple(e.paths), e.schema, e.rows, e.seconds) for n, e in row.tables.items()}


def current(spark: SparkSession, root: str) -> tuple[int, dict[str, Entry]]:
    """The newest version and its tables."""
    version = latest(spark, root)
    return version, at(spark, root, version)


def publish(spark: SparkSession, root: str, tables: Mapping[str, Entry], base: int | None = None) -> int:
    """Make ``tables`` the next version; its number is returned.

    With ``base``, the version that ``tables`` were made from has to be the newest still, otherwise
    ``Conflict`` is raised and nothing is published.
    """
    while True:
        newest = latest(spark, root)
        if base is not None and newest != base:
            raise Conflict(f"version {newest} of {root} was published after version {base}")
        row = {
            "version": newest + 1,
            "published_at": datetime.now(UTC).isoformat(),
            "tables": {name: asdict(entry) for name, entry in tables.items()},
        }
        if create_once(spark, _pointer(root, newest + 1), json.dumps(row) + "\n"):
            return newest + 1


def read(spark: SparkSession, entry: Entry) -> DataFrame:
    """A published table; one without rows or files is empty."""
    schema = T.StructType.fromJson(json.loads(entry.schema))
    parts = [spark.read.schema(schema).parquet(path) for path in entry.paths]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def added(before: Entry | None, now: Entry) -> Entry | None:
    """What ``now`` has beyond ``before``; None if it does not just go on from there."""
    known = before.paths if before else ()
    if now.paths[: len(known)] != known:
        return None
    return Entry(now.paths[len(known) :], now.schema, now.rows, now.seconds)
