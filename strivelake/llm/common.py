"""Small helpers shared by the training-data operators."""
from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager
from types import ModuleType

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strivelake.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Characters that end a word: ASCII white space / every ASCII character but letters and digits.
SPACE = r"[\x20\x09-\x0D]+"
NON_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# A table is broadcast only when its measured row count is at most this; rows are narrow
# (two or three numbers or one word), so this stays in the tens of megabytes.
BROADCAST_ROWS = 500_000

# A task of its own pays for this many documents; small tables are not spread over more tasks.
TASK_ROWS = 4096


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sized(df: DataFrame, rows: int | None) -> DataFrame:
    """``df`` in no more tasks than ``rows`` documents need, however many partitions a shuffle makes."""
    return df if rows is None else df.coalesce(max(1, -(-rows // TASK_ROWS)))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared scratch folder and read back: later steps do not recompute
    it, survive lost executors, and the planner knows its size."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    if _SCOPES:
        _SCOPES[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


_SCOPES: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted at the end: write what is derived from them before."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            delete_folder(spark, path)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs inside are deleted as soon as a job ends, not with the session."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def worker_memory() -> dict:
    """What a Python worker keeps between tasks. Functions of this package are shipped by value, with
    module variables that are new in each task."""
    return sys.modules.setdefault("strivelake_worker_memory", ModuleType("strivelake_worker_memory")).__dict__


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a table of this job, in whichever file system it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII text takes the fast path."""
    return (F.when(F.length(text) == F.octet_length(text), F.lower(text))
            .otherwise(F.translate(text, UPPER, UPPER.lower())))


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting the rows; a larger side is left to a shuffle join.

    ``df`` should be staged (or cheap): it is counted here.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


def space_words(text: Column) -> Column:
    """Words between ASCII white space (an empty array for null, empty or blank text)."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE)
    return F.filter(parts, lambda w: w != "")


def space_word_count(text: Column) -> Column:
    """Number of words between ASCII white space, without building a filtered array."""
    return split_count(F.split(F.coalesce(text, F.lit("")), SPACE))


def split_count(parts: Column) -> Column:
    """Non-empty parts of a split on runs: only the first and the last one can be empty."""
    empty_ends = (F.when(F.size(parts) == 1, (parts[0] == "").cast("long"))
                  .otherwise((parts[0] == "").cast("long")
                             + (F.element_at(parts, -1) == "").cast("long")))
    return F.size(parts).cast("long") - empty_ends


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def python_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound the rows of an Arrow batch, so a batch of long texts fits a Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))
