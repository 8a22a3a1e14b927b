"""A measures file: mapping, checks, reconciliation of its members and the history append."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace
from itertools import groupby

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from panelspark.operators import checks, lookup
from panelspark.operators import reconcile as C
from panelspark.operators.keys import coverage
from panelspark.operators.summary import measure_summary
from panelspark.plans.audit import audit_row, audited_run
from panelspark.schemas import (
    MEASURE_MEMBER_CONSTRAINTS, MEASURES_LOG, MEMBERSHIP_HISTORY,
)
from panelspark.session import materialize, shared_folder, spread_by_rows
from panelspark.sources import tables
from panelspark.sources.runs import RUN, Run


# Fixed value: the text that the log holds for an upload ahead of the month's membership.
STALE = "The membership is not yet updated for this month, so the measures are not uploaded"


def mapped_measures(staged: DataFrame, clinics: DataFrame, measures_map: DataFrame) -> DataFrame:
    """Clinic by the first plan id its text contains, measure by its text without the year."""
    names = lookup.active_values(measures_map, "measure", "id").withColumnRenamed("id", "measure_no")
    df = lookup.map_contained(staged, "clinic_text", lookup.plan_sites(clinics), "phc_key", "id", "clinic_id")
    return lookup.map_trimmed(df, "measure_text", names, "measure", "measure_no", "measure_id")


def check_measures(df: DataFrame, clinics: DataFrame, measures_map: DataFrame) -> str:
    """Stop on unmapped clinics; returns the warning about clinics and measures not seen."""
    checks.enforce(
        lookup.unmapped(df, "clinic_id", "clinic_text"), "Unmapped clinics", "clinic_text"
    )
    lines = []
    for title, column, expected in (
        ("Clinic", "clinic_id", clinics),
        ("Measure", "measure_id", measures_map),
    ):
        sides = coverage(lookup.mapped_only(df, column), column, expected.where("is_active = 1"), "id")
        missing = checks.joined_values(sides.where("side = 'missing'"), "value")
        lines.append(f"{title} - " + (f"without rows: {missing}" if missing is not None else "all seen"))
    return "\n".join(lines)


@dataclass(frozen=True)
class Reconciled:
    """What a measures file changes: the new membership and the history rows to append."""

    membership: DataFrame
    history: DataFrame


def reconcile(
    measures: DataFrame,
    membership: DataFrame,
    history: DataFrame,
    year: int,
    month: int,
    as_of: dt.date,
    staged: DataFrame | None = None,
) -> Reconciled | None:
    """Add unknown members and re-activate known ones; None if the file needs neither.

    Each half runs only if the file has members it concerns. A membership not loaded in the
    month of ``as_of`` stops the upload. Membership, distinct members of the file and their history
    bits are joined once and stored; what the file needs is counted while they are written, and
    the new membership and history are read off the stored rows.
    """
    staged = C.staged_members(measures) if staged is None else staged
    found = Observation("file-needs")
    rows = materialize(C.side_by_side(membership, staged, history, year).observe(found, *C.needs(month)), "side-by-side")
    counts = found.get
    insert, reactivate = counts["unknown"] > 0, counts["unrecorded"] > 0
    if not (insert or reactivate):
        return None
    last = counts["last_download"]
    if last is None or (last.year, last.month) != (as_of.year, as_of.month):
        raise checks.CheckFailed(STALE)
    return Reconciled(
        C.applied(rows, as_of, insert, reactivate), C.history_of_file(rows, year, month, as_of, insert, reactivate)
    )


@dataclass(frozen=True)
class MeasureTables:
    """Folders of the tables; jobs that share a membership share its registry of runs."""

    membership: str
    history: str
    measures: str
    summary: str
    log: str

    @property
    def runs(self) -> str:
        return f"{self.membership}-runs"


def run_measures_file(
    spark: SparkSession,
    staged: DataFrame,
    file_name: str,
    clinics: DataFrame,
    measures_map: DataFrame,
    stored: MeasureTables,
    download_date: dt.date,
    run_at: dt.datetime,
    key: str | None = None,
) -> None:
    """Apply one staged sheet (``download_date``, ``year`` and ``month`` are columns of it).

    Everything it changes is published together. A sheet that comes again replaces its own rows; sheets
    of one name and another date are other uploads, unless ``key`` names the upload.
    """
    key = key or f"sheet {download_date:%Y-%m-%d} {file_name}"
    with audited_run(spark, stored.runs, key, stored.log, MEASURES_LOG, run_at) as (run, log):
        log.update(file_name=file_name, download_date=download_date)
        mapped = checks.staged(mapped_measures(staged, clinics, measures_map), "staged-measures")
        log["warning_message"] = check_measures(mapped, clinics, measures_map)
        rows = lookup.mapped_only(mapped, "measure_id")
        log["insert_count"] = rows.count()
        lost = checks.stored_values(lookup.unmapped(mapped, "measure_id", "measure_text"), "measure_text")
        if lost:
            log["warning_message"] += f"\nUnmapped measures: {lost}"
        again = run.replaces(stored.membership)
        membership = run.base(stored.membership).drop("merge_action")
        history = tables.read_or_empty(spark, stored.history, MEMBERSHIP_HISTORY)
        if again:
            history = run.without_own(history)
        members = materialize(C.staged_members(rows), "staged-members")
        changes = reconcile(
            rows, membership, history, download_date.year, download_date.month, run_at.date(), members
        )
        if changes is not None:
            broken = checks.constraint_violations(
                members, MEASURE_MEMBER_CONSTRAINTS, {"clinic_id": (clinics, "id")}
            )
            checks.enforce(
                broken.select(F.concat_ws(" ", "rule", "column_name", "key_value").alias("error")),
                "Staged rows do not fit the table",
                "error",
            )
            membership, _ = run.snapshot(changes.membership, stored.membership, int(run_at.strftime("%Y%m%d%H%M")))
            run.rows(tables.with_inserted_at(changes.history), stored.history, keep_earlier=not again)
        elif again:  # what the earlier sheet changed is taken back
            run.snapshot(membership, stored.membership)
            run.rows(history.limit(0).drop(RUN), stored.history)
        spread = spread_by_rows(rows, "cin")
        appended = C.with_eligibility(spread, membership)
        run.rows(tables.with_inserted_at(appended), stored.measures, rebalance=spread is rows)
        run.rows(tables.with_inserted_at(measure_summary(appended)), stored.summary)


@dataclass(frozen=True)
class Sheet:
    """One waiting sheet; ``key`` names its upload."""

    path: str
    name: str
    download_date: dt.date
    key: str


def run_measures_sheets(
    spark: SparkSession,
    staged: DataFrame,
    sheets: Sequence[Sheet],
    clinics: DataFrame,
    measures_map: DataFrame,
    stored: MeasureTables,
    clock: Callable[[], dt.datetime],
) -> Iterator[Sheet]:
    """Apply several staged sheets in their order (``path`` tells them apart); yields each one when it is published.

    The tables end as if the sheets came one by one with ``run_measures_file``, but sheets of one month that follow each other
    share a run: mapping, checks, the join with membership and history and all writing are done once for them.
    Sheets with anything a check objects to are applied on their own, so that they stop the upload at their place.
    """
    groups = [[i] for i in range(len(sheets))]
    if len(sheets) > 1:
        numbers = spark.createDataFrame([(s.path, i) for i, s in enumerate(sheets)], "path string, sheet int")
        mapped = checks.staged(
            mapped_measures(staged.join(F.broadcast(numbers), "path"), clinics, measures_map), "staged-measures")
        members = materialize(C.staged_members(lookup.mapped_only(mapped, "measure_id"), by=["sheet"]), "staged-members")
        alone = _objected(mapped, members, clinics)
        months = [(s.download_date.year, s.download_date.month) for s in sheets]
        groups = [
            list(g) for _, g in groupby(range(len(sheets)), lambda i: (months[i], i if i in alone else -1))
        ]
    for group in groups:
        if len(group) > 1 and _run_together(spark, mapped, members, sheets, group, clinics, measures_map, stored, clock()):
            yield from (sheets[i] for i in group)
            continue
        for sheet in (sheets[i] for i in group):
            run_measures_file(
                spark, staged.where(F.col("path") == sheet.path), sheet.name, clinics, measures_map, stored,
                sheet.download_date, clock(), key=sheet.key,
            )
            yield sheet


def _objected(mapped: DataFrame, members: DataFrame, clinics: DataFrame) -> set[int]:
    """The sheets with unmapped clinics or members that break a rule."""
    rules = replace(MEASURE_MEMBER_CONSTRAINTS, key=("sheet", "cin"))
    broken = checks.constraint_violations(members, rules, {"clinic_id": (clinics, "id")})
    unknown = broken.where("rule = 'foreign_key'").select(F.col("key_value").alias("clinic_id"))
    by_clinic = members.join(unknown, members["clinic_id"].cast("string") == unknown["clinic_id"], "left_semi").select("sheet")
    of_rules = broken.where("rule <> 'foreign_key'").select(F.split_part("key_value", F.lit("|"), F.lit(1)).cast("int").alias("sheet"))
    unmapped = mapped.where(F.col("clinic_id").isNull()).select("sheet")
    return {row.sheet for row in unmapped.union(of_rules).union(by_clinic).distinct().collect()}


def _run_together(
    spark: SparkSession,
    mapped: DataFrame,
    members: DataFrame,
    sheets: Sequence[Sheet],
    group: Sequence[int],
    clinics: DataFrame,
    measures_map: DataFrame,
    stored: MeasureTables,
    run_at: dt.datetime,
) -> bool:
    """Apply sheets of one month in one run; False, with nothing done, if the membership may be stale for one of them."""
    first, last = group[0], group[-1]
    as_of, (year, month) = run_at.date(), (sheets[first].download_date.year, sheets[first].download_date.month)
    of_group = F.col("sheet").between(first, last)
    mapped, members = mapped.where(of_group), members.where(of_group)
    run = Run(spark, stored.runs, f"{sheets[first].key} and {len(group) - 1} more", [sheets[i].key for i in group])
    logs = {i: {"file_name": sheets[i].name, "download_date": sheets[i].download_date} for i in group}

    def log(**more) -> DataFrame:
        rows = [audit_row(spark, MEASURES_LOG, {**logs[i], **more}, run_at).first() for i in group]
        return spark.createDataFrame(rows, MEASURES_LOG)

    def named(df: DataFrame) -> DataFrame:
        return df.withColumn(RUN, run.value_of(F.col("sheet") - first)).drop("sheet")

    try:
        _note_checks(spark, mapped, clinics, measures_map, logs)
        rows = lookup.mapped_only(mapped, "measure_id")
        again = run.replaces(stored.membership)
        membership = run.base(stored.membership).drop("merge_action")
        history = tables.read_or_empty(spark, stored.history, MEMBERSHIP_HISTORY)
        if again:
            history = run.without_own(history)
        found = Observation("sheets-need")
        last_of = F.max("m.download_date")
        stays = F.col("e").isNull() | F.col("m.is_enrolled").isNull() | (F.col("m.is_enrolled") != 0)
        side = materialize(
            C.sheets_side_by_side(membership, members, history, year).observe(
                found, C.first_inserting().alias("inserting"), last_of.alias("last"),
                F.max(F.when(stays, F.col("m.download_date"))).alias("last_kept")),
            "side-by-side")
        inserting = found.get["inserting"]
        recording = [row.sheet for row in C.recording_sheets(side, year, month, inserting).collect()]
        changes = inserting is not None or bool(recording)
        now = (as_of.year, as_of.month)
        if changes and not (
                all(d is not None and (d.year, d.month) == now for d in (found.get["last"], found.get["last_kept"])) and (year, month) <= now):
            return False  # what the month's last download is behind each sheet is seen one by one
        side = C.with_acting(side, recording)
        if changes:
            run.snapshot(C.applied(side, as_of, True, True), stored.membership, int(run_at.strftime("%Y%m%d%H%M")))
            added = C.history_of_sheets(side, year, month, as_of, inserting)
            run.rows(tables.with_inserted_at(named(added)), stored.history, keep_earlier=not again)
        elif again:  # what the earlier run changed is taken back
            run.snapshot(membership, stored.membership)
            run.rows(history.limit(0).drop(RUN), stored.history)
        spread = spread_by_rows(rows, "cin")
        appended = named(C.with_eligibility_then(spread, side, as_of))
        run.rows(tables.with_inserted_at(appended), stored.measures, rebalance=spread is rows)
        run.rows(tables.with_inserted_at(measure_summary(appended, [RUN])), stored.summary)
        run.log(log(is_success=1), stored.log)
        run.commit()
    except Exception as error:
        tables.append_rows(log(failure_step=str(error)), stored.log)
        raise
    return True


def _note_checks(spark: SparkSession, mapped: DataFrame, clinics: DataFrame, measures_map: DataFrame, logs: dict[int, dict]) -> None:
    """What ``check_measures`` and the count of rows say of each sheet, from one pass over all of them."""
    columns = (("Clinic", "clinic_id", clinics), ("Measure", "measure_id", measures_map))
    lost = mapped.where(F.col("measure_id").isNull()).select("sheet", "measure_text").distinct()
    folder = shared_folder(spark, "violations")
    lost.write.partitionBy("sheet").parquet(folder)
    n_lost = spark.read.schema("measure_text string, sheet int").parquet(folder).groupBy("sheet").count()
    seen = mapped.groupBy("sheet").agg(
        F.count("measure_id").alias("rows"), *[F.collect_set(F.col(c).cast("string")).alias(c) for _, c, _ in columns])
    expected = {c: {r.v for r in t.where("is_active = 1").select(F.col("id").cast("string").alias("v")).distinct().collect()} for _, c, t in columns}
    for row in seen.join(n_lost, "sheet", "left").collect():  # sets of map keys for each sheet
        lines = []
        for title, column, _ in columns:
            missing = sorted(map(str, expected[column] - set(row[column])))
            lines.append(f"{title} - " + (f"without rows: {' & '.join(missing)}" if missing else "all seen"))
        logs[row.sheet] |= {"insert_count": row.rows, "warning_message": "\n".join(lines)}
        if row["count"]:
            logs[row.sheet]["warning_message"] += f"\nUnmapped measures: {row['count']} in {folder}/sheet={row.sheet}"
