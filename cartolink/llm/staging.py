"""Tables written between two steps, in the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections import defaultdict
from collections.abc import Hashable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own: str | None = None
#: Paths of tables that are not to outlast the work they are for, by that work.
_passing: dict[Hashable, list[str]] = defaultdict(list)
_work: ContextVar[Hashable] = ContextVar("work", default=None)


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``.  Unset, a temporary folder, in local mode only, as in tests."""
    global _own
    base = spark.conf.get("spark.checkpoint.dir", "")
    if base:
        return base
    master = spark.sparkContext.master
    if master.startswith("local-cluster") or not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if _own is None:
        _own = tempfile.mkdtemp(prefix="cartolink-")
        atexit.register(shutil.rmtree, _own, ignore_errors=True)
    return _own


@contextmanager
def work(key: Hashable) -> Iterator[None]:
    """What is staged inside belongs to ``key``, until ``release(spark, key)``."""
    token = _work.set(key)
    try:
        yield
    finally:
        _work.reset(token)


#: Rows in a batch that goes to a Python worker, where whole texts or sets are in a row.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
MOST_ROWS = 1_000


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches of ``MOST_ROWS`` at most, so that what tasks and workers hold is bounded; as it was afterwards."""
    was = spark.conf.get(BATCH_ROWS, "10000")
    if not 0 < int(was) <= MOST_ROWS:
        spark.conf.set(BATCH_ROWS, str(MOST_ROWS))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, was)


def staged(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again.

    Cuts the lineage as ``checkpoint()`` does, but column by column, so a later
    reader takes only what it needs.  A lost executor costs no recomputation.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    if not keep and _work.get() is not None:
        _passing[_work.get()].append(path)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, key: Hashable) -> None:
    """Delete the tables staged for ``key``, and no others.  Only once all that reads them has been written."""
    for name in _passing.pop(key, ()):
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Sieve:
    """Bits that keys set: a key whose bit isn't set is for certain not in the table.

    Keys are 64-bit hashes.  There are 16 bits or more for each key, so of other keys 1 in 16 passes
    at most, up to 4 million keys; the bits take no more than ``MOST``, 8 MB, whatever the number, and
    with more keys more others pass.  What passes has to meet the table in a join, which alone decides.
    """

    MOST = 1 << 26

    def __init__(self, table: DataFrame, key: str):
        bits = min(self.MOST, 1 << (16 * table.count()).bit_length() | 1 << 12)
        bits = 1 << (bits.bit_length() - 1)
        self.spark, self.bits, self.table = table.sparkSession, bits, None
        at = F.col(key).bitwiseAND(bits - 1).alias("at")
        got = table.select(at).groupBy(F.shiftright("at", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("bits")).toArrow()
        self.words = np.zeros(bits // 64, np.int64)
        self.words[got["word"].to_numpy()] = got["bits"].to_numpy()

    def may(self, key: Column) -> Column:
        """False only for keys that are not in the table."""
        if self.table is None:
            one = pa.table({"words": pa.ListArray.from_arrays([0, len(self.words)], pa.array(self.words))})
            self.table = staged(self.spark.createDataFrame(one), "sieve")
        at = key.bitwiseAND(self.bits - 1)
        word = F.get(self.table.scalar(), F.shiftright(at, 6).cast("int"))
        return F.call_function("getbit", word, at.bitwiseAND(63).cast("int")) == 1


def may_hold(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """``Sieve.may`` for an array of keys."""
    at = keys.view(np.uint64) & np.uint64(64 * len(words) - 1)
    return ((words.view(np.uint64)[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)


def without(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """``rows`` whose ``key`` is not in ``gone``.  Only rows that the sieve can't clear are shuffled.

    Merged at any size, so that what a small table shows is the plan of a large one.
    """
    may = Sieve(gone, key).may(F.col(key))
    return rows.where(~may).unionByName(rows.where(may).join(gone.hint("merge"), key, "left_anti"))
