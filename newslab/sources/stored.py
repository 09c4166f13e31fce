"""Tables that Spark derives from the supplied ones, written once per session and input under the shared folder.

Later queries re-read them (lineage cut, survives executor loss).  An entry is found again by the application, the input
folder with the files and times of its tables, and its name: changed input is built anew.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from newslab.session import scratch_path

_ENTRIES: dict = {}
TABLES = ("documents", "labels", "events")


def _hadoop_path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def key(spark: SparkSession, sf_dir: str, name: str, tables: Sequence[str] = TABLES) -> tuple:
    state = []
    for t in tables:
        path, fs = _hadoop_path(spark, f"{sf_dir.rstrip('/')}/{t}.parquet")
        found = fs.globStatus(path)
        state.append((t, found[0].getModificationTime(), found[0].getLen()) if found else (t,))
    return (spark.sparkContext.applicationId, sf_dir.rstrip("/"), tuple(state), name)


def once(spark: SparkSession, sf_dir: str, name: str, build: Callable, tables: Sequence[str] = TABLES):
    """The value that ``build`` returned for this key the first time."""
    k = key(spark, sf_dir, name, tables)
    if k not in _ENTRIES:
        _ENTRIES[k] = build()
    return _ENTRIES[k]


def materialise(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame], tables: Sequence[str] = TABLES) -> DataFrame:
    def write() -> str:
        path = scratch_path(spark, name)
        build().write.mode("overwrite").parquet(path)
        return path

    return spark.read.parquet(once(spark, sf_dir, name, write, tables))


def input_bytes(spark: SparkSession, sf_dir: str, table: str) -> int:
    path, fs = _hadoop_path(spark, f"{sf_dir.rstrip('/')}/{table}.parquet")
    return fs.getContentSummary(path).getLength()


def bucketed(df: DataFrame, name: str, id_col: str, buckets: int, most_files: int) -> str:
    """Store ``df`` in ``buckets`` hash buckets of ``id_col``; the name of the table, for joins without an exchange.

    Each writing task adds a file to every bucket, so nothing is shuffled; only where that would make more than
    ``most_files`` files are the rows first dealt by bucket, once, and every later join is spared it.
    """
    spark = df.sparkSession
    if df.rdd.getNumPartitions() * buckets > most_files:
        df = df.repartition(buckets, id_col)
    path = scratch_path(spark, name)
    table = "newslab_" + path.rsplit("/", 1)[1].replace("-", "_")
    df.write.mode("overwrite").bucketBy(buckets, id_col).option("path", path).saveAsTable(table)
    return table
