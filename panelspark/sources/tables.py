"""Tables: versioned snapshots, appended history and report files.

A snapshot is a folder ``version=<n>`` of Parquet files. It counts once it is published, so
a job may write it, derive other tables from it and publish it last; a run that dies half-way
leaves the current snapshot in place. Jobs that write several tables do so through a run
(``panelspark.sources.runs``), which publishes them together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MARKER = "_PUBLISHED"


def version_folder(table: str, version: int) -> str:
    return f"{table}/version={version:012d}"


def write_version(df: DataFrame, table: str, version: int) -> DataFrame:
    """Write a snapshot to its own folder and read it back; unpublished remains are replaced."""
    spark, path = df.sparkSession, version_folder(table, version)
    if exists(spark, f"{path}/{_MARKER}"):
        raise FileExistsError(f"version {version} of {table} is already published")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def publish(spark: SparkSession, table: str, version: int, by: str = "") -> None:
    """Make a version count; ``by`` names the run that made it."""
    path, fs = file_system(spark, f"{version_folder(table, version)}/{_MARKER}")
    marker = fs.create(path, True)
    marker.write(bytearray(by.encode()))
    marker.close()


def published_by(spark: SparkSession, table: str, version: int) -> str:
    """The run that made a published version, empty where none was named."""
    path, fs = file_system(spark, f"{version_folder(table, version)}/{_MARKER}")
    marker = fs.open(path)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(marker)).decode()
    finally:
        marker.close()


def read_version(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """A snapshot, by default the newest published one."""
    if version is None:
        version = latest_version(spark, table)
    return spark.read.parquet(version_folder(table, version))


def published_versions(spark: SparkSession, table: str) -> list[int]:
    """Published versions, oldest first."""
    path, fs = file_system(spark, f"{table}/version=*/{_MARKER}")
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in fs.globStatus(path) or [])


def latest_version(spark: SparkSession, table: str) -> int:
    found = published_versions(spark, table)
    if not found:
        raise FileNotFoundError(f"no published version of {table}")
    return found[-1]


def read_or_empty(spark: SparkSession, table: str, schema) -> DataFrame:
    """An appended table, or no rows where it does not exist yet."""
    if exists(spark, table):
        return spark.read.schema(schema).parquet(table)
    return spark.createDataFrame([], schema)


def file_system(spark: SparkSession, text: str):
    """A path and the file system that holds it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(text)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, text: str) -> bool:
    path, fs = file_system(spark, text)
    return fs.exists(path)


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> None:
    """A catalog table bucketed and sorted by its key.

    Joins and aggregates on the key then read it without a shuffle.
    """
    df.write.bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(name)


def append_history(df: DataFrame, table: str, partitions: Sequence[str] = ("year", "month")) -> None:
    """Append rows to a table partitioned by month, so that a month reads only its folder.

    Rows are rebalanced by month at run time: a small month gets one file, and a large one is
    split over many tasks.
    """
    df.hint("rebalance", *partitions).write.mode("append").partitionBy(*partitions).parquet(table)


def append_rows(df: DataFrame, table: str) -> None:
    df.write.mode("append").parquet(table)


def with_inserted_at(df: DataFrame) -> DataFrame:
    return df.withColumn("inserted_at", F.date_trunc("minute", F.current_timestamp()))


def write_report(df: DataFrame, folder: str, sep: str = ",") -> None:
    """A report as delimited text with a header, in the order of the frame."""
    df.write.mode("error").option("header", True).option("sep", sep).option("escape", '"').csv(folder)
