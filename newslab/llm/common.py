"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newslab.session import scratch_path

#: The six ASCII white-space characters that separate words in every contract here.
WORD_GAP = r"[\x20\x09-\x0D]+"
WORD_GAP_CHARS = " \t\n\x0b\x0c\r"
#: Shuffle files of a finished query go at once instead of when the driver next collects its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One supplied table, read by Spark only (the folder may be in a store that only Spark reaches)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: cuts lineage, survives lost executors.

    The query's shuffle files are removed when it ends, so steps written one after the other need the disk of the
    largest of them only.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with _setting(spark, _CLEANUP, "true"):
        df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables made by ``written`` that no later step reads."""
    for t in tables:
        spark = t.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(t.scratch)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def give_back() -> None:
    """Return what this worker process holds but doesn't use: it is kept for later tasks beside an executor that is not idle."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # not every system has glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def giving_back(run: Callable) -> Callable:
    """A function over a task's batches that gives its memory back when the task ends."""
    @wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))
