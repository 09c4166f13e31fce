"""File sources and sinks: CSV headline tables, the news store, JSON reports.

Paths live under the shared folder named by ``spark.checkpoint.dir`` (see
``newslab.session.scratch_path``), never on a machine-local disk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslab import schema as S
from newslab.session import scratch_path

_CSV_OPTS = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',  # doubled quotes, as RFC 4180 and pandas
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": "",
    "emptyValue": '""',
}


def write_news_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**_CSV_OPTS).csv(path)


def read_news(spark: SparkSession, path: str, schema: T.StructType = S.RAW_NEWS) -> DataFrame:
    """CSV with header, declared schema, quoted newlines and doubled quotes.

    Empty fields (quoted or not) read as null, like a pandas CSV reader.
    """
    opts = dict(_CSV_OPTS)
    opts["emptyValue"] = ""
    return spark.read.schema(schema).options(**opts).option("mode", "FAILFAST").csv(path)


def read_news_tolerant(spark: SparkSession, path: str, quarantine: str, schema: T.StructType = S.RAW_NEWS) -> DataFrame:
    """S1 for tables with broken records: a record that doesn't fit the schema (too few or many fields, a wrong type) costs
    itself only.  Good rows are returned; broken ones go to ``quarantine`` as (record, file), one row each.

    The table is parsed once, into a written copy that both are read from.
    """
    opts = _CSV_OPTS | {"emptyValue": "", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_record"}
    parsed = spark.read.schema(T.StructType([*schema.fields, T.StructField("_record", T.StringType())])).options(**opts).csv(path)
    copy = scratch_path(spark, "csv-parsed")
    parsed.withColumn("_file", F.col("_metadata.file_path")).write.parquet(copy)
    rows = spark.read.parquet(copy)
    rows.filter("_record is not null").select(F.col("_record").alias("record"), F.col("_file").alias("file")).write.mode("overwrite").parquet(quarantine)
    return rows.filter("_record is null").select(*schema.names)


STORE_SALTS = 8


def append_news(df: DataFrame, path: str, run: str, required: tuple[str, ...] = ("title", "sentiment"),
                salts: int = STORE_SALTS) -> None:
    """Add one run's scored rows, partitioned by run, validity and day, in a single pass.

    Rows missing a required field land under ``valid=0`` (quarantine).  A repeated run replaces its own partitions
    instead of adding its rows again.  Rows are dealt by day and a salt, so a day is written by at most ``salts`` tasks
    and a hot day by more than one.
    """
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull()
    rows = df.withColumns({"run": F.lit(run), "valid": ok.cast("int"), "date": F.to_date("created_at")})
    salt = F.pmod(F.xxhash64(*[F.col(c) for c, t in df.dtypes if t in ("string", "bigint", "int")]), F.lit(salts))
    (rows.repartition("date", salt).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run", "valid", "date").parquet(path))


def load_news_store(spark: SparkSession, path: str, days: Sequence[str | None] | None = None) -> DataFrame:
    """The valid rows of all runs; with ``days`` (one at least) only these partitions are listed and read (None: rows without
    a time)."""
    if days is None:
        return spark.read.parquet(path).filter("valid = 1").drop("valid", "run")
    parts = [f"{path}/run=*/valid=1/date={'__HIVE_DEFAULT_PARTITION__' if d is None else d}" for d in days]
    rows = spark.read.option("basePath", path).parquet(*parts)
    return rows.withColumn("date", F.col("date").cast("string").cast("date")).drop("valid", "run")


def store_days(spark: SparkSession, path: str) -> list[str | None]:
    """Days with valid rows, newest first, rows without a time last; from the names of the partitions alone."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/run=*/valid=1/date=*")
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    names = {f.getPath().getName().split("=", 1)[1] for f in found}
    dated = sorted((n for n in names if not n.startswith("__")), reverse=True)
    return [*dated, *([None] if len(dated) < len(names) else [])]


def load_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).filter("valid = 0").drop("valid", "run")


def write_report(df: DataFrame, path: str) -> None:
    """Nested JSON report (one line per report row)."""
    df.coalesce(1).write.mode("overwrite").json(path)


def load_trials(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.TRIALS).parquet(path)


def append_trials(df: DataFrame, path: str) -> None:
    df.select(*[f.name for f in S.TRIALS.fields]).write.mode("append").parquet(path)
