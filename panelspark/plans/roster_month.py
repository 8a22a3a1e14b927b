"""The monthly roster: raw pages to processed rows, and processed rows to the membership."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions import dates as D
from panelspark.functions import text as X
from panelspark.operators import checks, lookup
from panelspark.operators import roster as R
from panelspark.operators.keys import coverage, not_in_months
from panelspark.plans.audit import audited_run
from panelspark.schemas import (
    MEMBERSHIP_HISTORY, MEMBERSHIP_LOG, PROCESSED_FIELDS, ROSTER_CONSTRAINTS, ROSTER_FIELDS,
)
from panelspark.session import materialize
from panelspark.sources import tables
from panelspark.sources.files import file_name
from panelspark.sources.html import html_table, scan_html_tables


# The texts that the log holds for a month that doesn't follow the last one.
GATE_MESSAGES = {"duplicate": "Already updated this month", "gap": "Potentially missed a month"}


def processed_rows(files: DataFrame, clinics: DataFrame) -> DataFrame:
    """Normalized rows of raw roster pages, duplicates removed.

    ``files`` has ``html``, ``path`` and ``download_date``. Site, month and year come from
    the path; a path without a known site fails the job.
    """
    return _normalized(html_table(_with_site(files, clinics), "html", [*_SITE, "download_date"], ROSTER_FIELDS))


def scanned_rows(spark: SparkSession, folder: str, clinics: DataFrame, glob: str = "*.xls") -> DataFrame:
    """The same from the files of a folder, large ones read by many tasks; sites and months come from file names."""
    rows = scan_html_tables(spark, folder, ROSTER_FIELDS, glob).withColumn("path", file_name(F.col("path")))
    return _normalized(_with_site(rows, clinics))


_SITE = ["site", "file_month", "file_year"]


def file_sites(df: DataFrame, clinics: DataFrame) -> DataFrame:
    """Site, month and year of each path, NULL where it names none."""
    return lookup.map_contained(
        df, "path", lookup.plan_sites(clinics), "phc_key", "clinic_key", "site", order="id", last=True
    ).withColumns({"file_month": D.month_number(F.col("path")), "file_year": D.file_year(F.col("path"))})


def _with_site(df: DataFrame, clinics: DataFrame) -> DataFrame:
    return file_sites(df, clinics).withColumn("site", lookup.required(F.col("site"), F.col("path")))


def _normalized(rows: DataFrame) -> DataFrame:
    c = F.col
    line1, line2 = c("Residential Address1"), c("Residential Address2")
    city, state, zip_ = c("Residential City"), c("Residential State"), c("Residential Zip")
    values = {
        "BIC_HIK": c("`BIC#/HIK#`"),
        "Clinic": c("site"),
        "LastName": X.double_quotes(c("Last Name")),
        "FirstName": X.double_quotes(c("First Name")),
        "DOB": D.parse_date(c("Birth")),
        "Sex": X.sex_roster(c("Sex")),
        "PhoneNumber": X.phone(c("`Residential Phone#`")),
        "Address": X.address(line1, line2),
        "City": city,
        "State": state,
        "ZipCode": zip_,
        "FullAddress": X.full_address(line1, line2, city, state, zip_),
        "RecordNumber": c("`Record#`"),
        "RP": c("RP"),
        "EffDate": D.parse_date(c("Eff Date")),
        "EndDate": D.parse_date(c("End Date")),
        "OtherInsurance": c("Other Insurnace"),
        "NewMember": X.flag_text(c("New Member"), "*"),
        "Month": F.lit(1),
        "PHPCurrentFlag": F.lit(1),
        "SpecialMemberFlag": X.special_member(c("site")),
        "LastUpdated": c("download_date"),
    }
    return rows.select(
        *[values[name].alias(name) for name in PROCESSED_FIELDS],
        D.period_key(c("site"), c("file_month"), c("file_year")).alias("period"),
    ).distinct()


def month_column(processed: DataFrame, month: int) -> DataFrame:
    """Name the month column of one month's rows after the month."""
    return processed.withColumnRenamed("Month", D.MONTHS[month - 1][:3])


def month_columns(processed: DataFrame, month: str) -> DataFrame:
    """The months of a year side by side: a row per member and site, 1 in the columns of months that list it, else 0.

    ``month`` is the number of a row's month. Columns are fixed, so nothing is read to find them.
    """
    flags = [
        F.coalesce(F.max(F.when(F.col(month) == i, F.col("Month"))), F.lit(0)).alias(name[:3])
        for i, name in enumerate(D.MONTHS, 1)
    ]
    return processed.groupBy("BIC_HIK", "Clinic").agg(*flags, F.max("SpecialMemberFlag").alias("SpecialMemberFlag"))


def mapped_roster(staged: DataFrame, clinics: DataFrame) -> DataFrame:
    """Staged rows with the id of the first active clinic whose key the site text contains."""
    active = lookup.active_values(clinics, "clinic_key", "id")
    return lookup.map_contained(staged, "clinic_text", active, "clinic_key", "id", "clinic_id")


def check_roster(roster: DataFrame, clinics: DataFrame) -> None:
    """Stop on clinics missing or unmapped, required nulls, malformed ids and broken rules."""
    active = clinics.where("is_active = 1")
    label = roster.select(lookup.label(F.col("clinic_id"), F.col("clinic_text")).alias("clinic"))
    message = checks.coverage_message(coverage(label, "clinic", active, "id"))
    if message:
        raise checks.CheckFailed(message)
    found = materialize(
        checks.constraint_violations(roster, ROSTER_CONSTRAINTS, {"clinic_id": (clinics, "id")}), "broken-rules")
    counts = {
        (row.rule, row.column_name): row["count"]
        for row in found.groupBy("rule", "column_name").count().collect()
    }
    where = f" in {found.inputFiles()[0].rsplit('/', 1)[0]}" if counts else ""
    if any(rule == "not_null" for rule, _ in counts):
        raise checks.CheckFailed(f"A required field has no value{where}")
    ids = checks.id_violations(roster, "cin", clinics, "clinic_key").select(
        F.format_string("%s in %s file", "cin", "clinic").alias("error")
    )
    checks.enforce(ids, "Malformed member ids", "error")
    if counts:
        broken = ", ".join(f"{rule} {column}: {n}" for (rule, column), n in sorted(counts.items()))
        raise checks.CheckFailed(f"Staged rows do not fit the table: {broken}{where}")


@dataclass(frozen=True)
class RosterTables:
    """Folders of the tables; jobs that share a membership share its registry of runs."""

    membership: str
    history: str
    log: str
    reports: str

    @property
    def runs(self) -> str:
        return f"{self.membership}-runs"


def run_roster_month(
    spark: SparkSession,
    roster: DataFrame,
    clinics: DataFrame,
    stored: RosterTables,
    year: int,
    month: int,
    run_at: dt.datetime,
    replace: bool = False,
) -> int:
    """Check and apply one month; returns the version it published.

    The staged rows are stored first, so that checks, gate and merge parse the files once.
    Membership, history, report and audit row are published together: a run that dies changes
    nothing, and may be repeated with other rows. A month that is already published is refused,
    unless it is to be replaced and was published last.
    """
    key = f"roster {year}-{month:02d}"
    with audited_run(spark, stored.runs, key, stored.log, MEMBERSHIP_LOG, run_at) as (run, log):
        log.update(year=year, month=month)
        roster = checks.staged(roster, "staged-roster")
        check_roster(roster, clinics)
        replace = replace and run.replaces(stored.membership)
        base = (run.base(stored.membership) if replace else tables.read_version(spark, stored.membership)).drop("merge_action")
        status = R.continuity_gate(base, roster).first().status
        if status not in ("ok", "rollover"):
            raise checks.CheckFailed(GATE_MESSAGES.get(status, "No download date to compare"))
        merged, version = run.snapshot(
            R.apply_roster(base, roster, month, status == "rollover", run_at), stored.membership,
            int(run_at.strftime("%Y%m%d%H%M")),
        )
        history = tables.read_or_empty(spark, stored.history, MEMBERSHIP_HISTORY)
        if replace:
            history = run.without_own(history)
        new_rows = not_in_months(R.history_rows(merged), history, ["cin"])
        run.rows(tables.with_inserted_at(new_rows), stored.history, keep_earlier=not replace)
        log.update(R.merge_counts(merged).first().asDict())
        run.report(R.arrivals(merged), f"{stored.reports}/NR_{month:02d}-{year}-{version}")
    return version
