"""File listings and file provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions.dates import period_key


def file_list(spark: SparkSession, folder: str, extension: str | None = None, recursive: bool = False) -> DataFrame:
    """Path, modification time and size of the files of a folder; contents stay unread."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if extension:
        reader = reader.option("pathGlobFilter", f"*{extension}")
    return reader.load(folder).select("path", "modificationTime", "length")


def oldest_and_newest(files: DataFrame) -> DataFrame:
    """First and last file by modification time; an empty listing fails the job."""
    count = F.count("*")
    empty = count == 0
    return files.agg(
        F.when(empty, F.raise_error(F.lit("no files")).cast("bigint")).otherwise(count).alias("file_count"),
        F.min_by("path", F.struct("modificationTime", "path")).alias("oldest"),
        F.max_by("path", F.struct("modificationTime", "path")).alias("newest"),
    )


def rows_by_file(df: DataFrame) -> DataFrame:
    """Rows that each file of a scan holds, with the file's size, time and date; files without rows are absent.

    ``df`` is a scan, whose metadata is used. The listing of a folder (``file_list``) has the empty ones too.
    """
    meta = F.col("_metadata")
    return (
        df.select(meta["file_path"].alias("path"), meta["file_size"].alias("length"), meta["file_modification_time"].alias("modificationTime"))
        .groupBy("path", "length", "modificationTime")
        .agg(F.count("*").alias("row_count"))
    )


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def with_provenance(df: DataFrame) -> DataFrame:
    """Date, year and month of the file a row was read from."""
    day = F.to_date("_metadata.file_modification_time")
    return df.select(
        "*", day.alias("download_date"), F.year(day).alias("year"), F.month(day).alias("month")
    )


def file_batches(files: DataFrame, site: str, year: str, month: str) -> DataFrame:
    """Files per site and month, with the name of the processed file they form."""
    return files.groupBy(site, year, month).agg(F.count("*").alias("file_count")).withColumn(
        "batch", period_key(F.col(site), F.col(month), F.col(year))
    )
