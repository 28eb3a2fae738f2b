"""Helpers shared by the operators: reading, reliable checkpoints, batches of bounded size."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lower-cases A-Z only; every other byte stays.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    """The named columns of a table, read by Spark from any file system it knows."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, which executors and driver share.

    Only a local session without one gets a temporary folder; on a cluster it would not be shared.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        given = context.getConf().get("spark.checkpoint.dir")
        if not given and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(given or tempfile.mkdtemp(prefix="trialscope-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def compact(df: DataFrame, per_part: int = 50_000) -> DataFrame:
    """``cut``, then read in no more partitions than its rows need.

    Tables that loops go over are often much smaller than what they were made from; with few
    partitions, what reads them writes few shuffle files.
    """
    df = cut(df)
    return df.coalesce(max(1, -(-df.count() // per_part)))


def held_out(key: Column | str, modulus: int, remainder: int) -> Column:
    """True where crc32 of the key, written as text, leaves ``remainder``."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def slices(batch: pa.RecordBatch, column: str, size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces whose texts add up to about ``size`` bytes; one row at least each."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    piece = (np.cumsum(lengths, dtype="i8") - lengths) // size
    starts = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
    for a, b in zip(starts, np.r_[starts[1:], len(piece)], strict=True):
        yield batch.slice(a, b - a)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str | None]:
    return batch.column(column).to_pylist()


def with_columns(batch: pa.RecordBatch, schema: pa.Schema, new: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch with columns added or replaced, in the order of ``schema``."""
    arrays = [new[f.name].cast(f.type) if f.name in new else batch.column(f.name) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def bounded_sample(
    rows: DataFrame, label: str, key: str, per_label: int, seed: int = 7
) -> DataFrame:
    """About ``per_label`` rows of each label, at most twice as many in all, chosen by hash of ``key``.

    The choice does not depend on the order of the rows.  Rows without label or key are left out.
    It is meant for fitting only; ``rows`` should be narrow, as they are read twice.
    """
    rows = rows.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    counts = rows.groupBy(label).count().orderBy(F.desc("count"), label).limit(1000).collect()
    if not counts:
        return rows.limit(0)
    scale = 1 << 40
    share = F.lit(0)
    for value, n in counts:
        limit = scale if n <= per_label else int(scale * per_label / n)
        share = F.when(F.col(label) == F.lit(value), F.lit(limit)).otherwise(share)
    draw = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(seed)), F.lit(scale))
    return rows.where(draw < share).limit(2 * per_label * len(counts))


class Memo(dict):
    """A dictionary that is emptied when it has grown past its bound."""

    def __init__(self, bound: int) -> None:
        super().__init__()
        self.bound = bound

    def make_room(self) -> None:
        if len(self) > self.bound:
            self.clear()


_MODELS: dict[str, object] = {}


def forget() -> None:
    """Drop the models of other jobs, and give back the memory that they and old batches took.

    Python workers serve one stage after the other, and what a stage has freed stays with them
    otherwise.  Tasks that need no model start with this.
    """
    _MODELS.clear()
    pa.default_memory_pool().release_unused()
    # Only glibc has it.
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


class Model:
    """A value sent to the executors, and what ``build`` makes of it once in each Python worker."""

    def __init__(self, spark: SparkSession, value, build, keep: int = 4) -> None:
        self.sent = spark.sparkContext.broadcast(value)
        self.name, self.build, self.keep = uuid.uuid4().hex, build, keep

    def get(self):
        if self.name not in _MODELS:
            if self.keep == 1:
                forget()
            while len(_MODELS) >= self.keep:
                _MODELS.pop(next(iter(_MODELS)))
            _MODELS[self.name] = self.build(self.sent.value)
        return _MODELS[self.name]

    @contextmanager
    def loaded(self):
        """The model for the length of one task; the worker, which other stages use again, keeps nothing."""
        try:
            yield self.get()
        finally:
            forget()


@contextmanager
def without_cycle_search() -> Iterator[None]:
    """No search for reference cycles in code that makes many small objects and no cycles."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def pieces_of(values: pa.Array, size: int = 2 << 20) -> Iterator[pa.Array]:
    """Texts in pieces that add up to about ``size`` bytes; one text at least each."""
    for part in slices(pa.record_batch([values], ["x"]), "x", size):
        yield part.column(0)


def runs(lengths: Iterable[int]) -> np.ndarray:
    """Offsets of consecutive runs of the given lengths, the end included."""
    return np.concatenate([[0], np.cumsum(np.fromiter(lengths, "i8"))])


def shipped(path: str) -> bytes:
    """A local file of the driver, read there so that executors need not have it."""
    with open(os.fspath(path), "rb") as file:
        return file.read()
