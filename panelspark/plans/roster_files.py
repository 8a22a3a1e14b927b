"""From raw roster pages to a published month, and whether new sheets are due."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.operators import checks
from panelspark.operators.keys import coverage
from panelspark.plans.audit import failure_logged
from panelspark.plans.roster_month import (
    RosterTables, file_sites, mapped_roster, month_column, run_roster_month, scanned_rows,
)
from panelspark.schemas import MEMBERSHIP_LOG, ROSTER_FIELDS
from panelspark.session import materialize
from panelspark.sources.delimited import read_processed, staged_roster, write_roster
from panelspark.sources.files import file_list, file_name
from panelspark.sources.html import table_headers


def check_files(spark: SparkSession, raw: str, clinics: DataFrame) -> tuple[int, int]:
    """Year and month of the raw pages of a folder.

    Stops where there is no page, where pages are of unknown clinics or an active clinic has none, where they are not all of
    one month, and where a page lacks a field. Only names and headers are read.
    """
    names = file_list(spark, raw, ".xls", recursive=True).select(file_name(F.col("path")).alias("path"))
    files = materialize(file_sites(names, clinics), "roster-files")
    if files.isEmpty():
        raise checks.CheckFailed("No roster files")
    sites = files.select(F.coalesce("site", "path").alias("site"))
    active = clinics.where("is_active = 1")
    message = checks.coverage_message(coverage(sites, "site", active, "clinic_key"), "clinic files")
    if message:
        raise checks.CheckFailed(message)
    months = files.select("file_year", "file_month").distinct().limit(2).collect()
    if len(months) > 1 or None in months[0]:
        raise checks.CheckFailed("The roster files are not of one month")
    absent = F.array_except(F.lit(ROSTER_FIELDS), "_header")
    missing = table_headers(spark, raw).select(
        F.concat_ws(" lacks ", file_name(F.col("path")), F.array_join(absent, ", ")).alias("file")).where(F.size(absent) > 0)
    checks.enforce(missing, "Missing fields", "file")
    return months[0].file_year, months[0].file_month


def run_roster_files(
    spark: SparkSession, raw: str, processed: str, clinics: DataFrame, stored: RosterTables, run_at: dt.datetime,
) -> int:
    """Check and process the raw pages of a folder, and apply their month; returns the published version.

    The processed files of a month lie in a folder of their own, which a repeated run replaces. What stops
    the processing is logged as a failed run.
    """
    with failure_logged(spark, stored.log, MEMBERSHIP_LOG, run_at):
        year, month = check_files(spark, raw, clinics)
        folder = f"{processed}/{year}-{month:02d}"
        write_roster(month_column(scanned_rows(spark, raw, clinics), month), folder, mode="overwrite")
    staged = mapped_roster(staged_roster(read_processed(spark, folder)), clinics)
    return run_roster_month(spark, staged, clinics, stored, year, month, run_at)


def fetch_due(spark: SparkSession, processed: str, published: dt.date, as_of: dt.date) -> bool:
    """Whether sheets published on a day should be fetched: none is there yet, or they are newer than the newest one.

    ``processed`` is the folder of the sheets that were fetched before.
    """
    newest = file_list(spark, processed, recursive=True).agg(F.max(F.to_date("modificationTime")).alias("last_file"))
    due = checks.new_data_due(
        F.coalesce("last_file", F.lit(dt.date(1900, 1, 1))), F.lit(published), F.lit(as_of))
    return bool(newest.select(due.alias("due")).first().due)
