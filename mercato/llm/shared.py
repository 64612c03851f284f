"""What the operators share: stored intermediate tables, patterns and file names."""

from __future__ import annotations

import ctypes
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
# The same white space for str.split after translate(): all of it becomes a space.
SPACES = {c: " " for c in range(9, 14)}


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local one only for a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="checkpoints-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


_PASSING: ContextVar[list[str] | None] = ContextVar("passing", default=None)


@contextmanager
def recorded_tables() -> Iterator[list[str]]:
    """The paths of the tables stored within, for ``remove_tables``."""
    paths: list[str] = []
    outer = _PASSING.set(paths)
    try:
        yield paths
    finally:
        _PASSING.reset(outer)


def remove_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables, when what is read from them must have been written."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while paths:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(paths.pop())
        at.getFileSystem(conf).delete(at, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    What follows reads files instead of repeating the work, also after an executor is
    lost. The files stay, for the lazy result may be read at any time; they stand under
    ``<spark.checkpoint.dir>/llm/<application id>`` and can go when the application ends,
    or with ``remove_tables``.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if (paths := _PASSING.get()) is not None:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, whose Python workers import it; once per application."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        folder = tempfile.mkdtemp(prefix="py-files-")
        context.addPyFile(
            shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name)
        )
        _SHIPPED.add(context.applicationId)
    return spark


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def broadcast_if_small(df: DataFrame, most: int = 64 << 20) -> DataFrame:
    """``df``, a stored table, with a broadcast hint if its files have at most ``most`` bytes.

    A larger one is joined by a shuffle; the result is the same.
    """
    spark = df.sparkSession
    files = df.inputFiles()
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    size = 0
    for file in files:
        at = path(file)
        size += at.getFileSystem(conf).getFileStatus(at).getLen()
        if size > most:
            return df
    return F.broadcast(df)


@contextmanager
def arrow_batches(spark: SparkSession, most: str = "4m") -> Iterator[None]:
    """Batches that go to Python within have at most about ``most`` bytes, or a single row.

    By default they may have 64 MB, which the executor and its Python worker hold several
    times. Only for steps that run within, not for what is returned lazily.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, most)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def small(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in slices, which bounds what a task unpacks from them at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _trim() -> Callable[[int], int] | None:
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):  # another C library
        return None


def tidy(
    work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` that gives freed memory back to the system at its end.

    Python workers serve task after task, and what the allocators keep of one stage would
    count against the executor in the next.
    """

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        if trim := _trim():
            trim(0)

    return tidied


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def tokenizer_path(file: str) -> str:
    """``file`` itself, or the place of a public tokenizer of that name. Called in tasks."""
    if os.path.isabs(file):
        return file
    import public_tokenizers

    return public_tokenizers.path(file)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


# CTE for SQL checks: the table of the 32-bit checksum, one list, from its polynomial.
CRC_SQL = """crc_table AS MATERIALIZED (
  SELECT list(c ORDER BY i) AS crc_of FROM (
    SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END, i) AS c
    FROM range(256) AS t(i))
)"""


def crc_sql(letters: str) -> str:
    """SQL for the checksum of a text of code points up to 255, next to ``CRC_SQL``."""
    utf8 = (
        f"flatten(list_transform(string_split({letters}, ''), lambda x: CASE WHEN unicode(x) < 128 "
        "THEN [CAST(unicode(x) AS BIGINT)] ELSE [192 + unicode(x) // 64, 128 + unicode(x) % 64] END))"
    )
    return (
        f"xor(4294967295, list_reduce({utf8}, lambda c, b: xor(c // 256, crc_of[xor(c, b) % 256 + 1]), "
        "CAST(4294967295 AS BIGINT)))"
    )
