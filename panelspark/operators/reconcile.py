"""Reconciliation of a measures file with the membership and its history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.operators.keys import except_keys
from panelspark.schemas import SHEET_ATTRIBUTES

HISTORY = ["cin", "clinic_id", "year", "month", "is_qip_eligible", "download_date"]


def of_month(history: DataFrame, year: int, month: int) -> DataFrame:
    return history.where((F.col("year") == year) & (F.col("month") == month))


def unknown_members(measures: DataFrame, membership: DataFrame) -> DataFrame:
    """Members of the file that the membership lacks."""
    return except_keys(measures, membership, ["cin"])


def unrecorded_members(measures: DataFrame, history: DataFrame, year: int, month: int) -> DataFrame:
    """Members of the file without a history row for its month."""
    return except_keys(measures, of_month(history, year, month), ["cin"])


def missing_counts(
    staged: DataFrame, membership: DataFrame, history: DataFrame, year: int, month: int
) -> DataFrame:
    """Number of unknown and of unrecorded members, from one pass over the file's members."""
    members = staged.select("cin").distinct()
    known = membership.select("cin", F.lit(1).alias("_known"))
    recorded = of_month(history, year, month).select("cin").distinct().withColumn("_recorded", F.lit(1))
    return (
        members.join(known, "cin", "left")
        .join(recorded, "cin", "left")
        .agg(
            F.count(F.when(F.col("_known").isNull(), 1)).alias("unknown"),
            F.count(F.when(F.col("_recorded").isNull(), 1)).alias("unrecorded"),
        )
    )


def staged_members(measures: DataFrame, attributes: Sequence[str] = SHEET_ATTRIBUTES, by: Sequence[str] = ()) -> DataFrame:
    """The distinct member rows of a file, or of several that ``by`` tells apart."""
    present = [c for c in attributes if c in measures.columns]
    return measures.select(*by, "cin", *present, "download_date").distinct()


def is_current(membership: DataFrame, as_of: dt.date) -> DataFrame:
    """One row telling whether the membership was loaded in the month of ``as_of``."""
    last = F.max("download_date")
    fresh = (F.year(last) == as_of.year) & (F.month(last) == as_of.month)
    return membership.agg(
        last.alias("last_download"), F.coalesce(fresh.cast("int"), F.lit(0)).alias("is_current")
    )


def month_bits(history: DataFrame, year: int) -> DataFrame:
    """One number per member with history: bit 0 for any row at all, bit m for a row in month m of ``year``.

    Bits combine on the map side, so a member costs one row per map task however long the history.
    """
    this_year = F.when(F.col("year") == year, F.expr("shiftleft(1, month)")).otherwise(F.lit(0))
    return history.groupBy("cin").agg(F.bit_or(this_year.bitwiseOR(F.lit(1))).alias("months"))


def side_by_side(membership: DataFrame, staged: DataFrame, history: DataFrame, year: int) -> DataFrame:
    """Each member of either side once: stored columns ``m``, columns of the file ``s`` and history bits ``months``."""
    rows = _joined(membership, staged, "full_outer")
    return rows.join(month_bits(history, year), "cin", "left").withColumn("months", F.coalesce("months", F.lit(0)))


def _joined(membership: DataFrame, staged: DataFrame, how: str) -> DataFrame:
    m, s = (df.select("cin", F.struct(*[c for c in df.columns if c != "cin"]).alias(side)) for df, side in ((membership, "m"), (staged, "s")))
    return m.join(s, "cin", how)


def _is_new() -> Column:
    return F.col("m").isNull()


def _lacks(month: int) -> Column:
    return F.col("s").isNotNull() & (F.col("months").bitwiseAND(F.lit(1 << month)) == 0)


def needs(month: int) -> list[Column]:
    """What ``side_by_side`` rows say of a file: members unknown, members without a row of the month, last download."""
    return [
        F.count(F.when(_is_new(), 1)).alias("unknown"),
        F.count(F.when(_lacks(month), 1)).alias("unrecorded"),
        F.max("m.download_date").alias("last_download"),
    ]


def reconcile_members(
    membership: DataFrame,
    staged: DataFrame,
    as_of: dt.date,
    insert: bool = True,
    reactivate: bool = True,
    attributes: Sequence[str] = SHEET_ATTRIBUTES,
) -> DataFrame:
    """Insert members never seen and re-activate known ones that are not enrolled.

    Both happen in one full outer join on ``cin``; ``merge_action`` is ``insert``,
    ``reactivate`` or ``keep``. Every right side uses the values from before the update.
    """
    return applied(_joined(membership, staged, "full_outer" if insert else "left"), as_of, insert, reactivate, attributes)


def applied(
    rows: DataFrame, as_of: dt.date, insert: bool, reactivate: bool, attributes: Sequence[str] = SHEET_ATTRIBUTES
) -> DataFrame:
    """The membership after a file, from rows that hold both sides."""
    month = as_of.month
    stored_columns, new_columns = rows.schema["m"].dataType.names, rows.schema["s"].dataType.names
    act = _action(reactivate)
    inserted, changed = act == "insert", act != "keep"
    enrolled = F.col("m.months_enrolled") + 1
    computed = {
        "months_enrolled": F.when(inserted, 1)
        .when(changed, enrolled)
        .otherwise(F.col("m.months_enrolled")),
        "months_missed": F.when(inserted, month - 1)
        .when(changed, month - enrolled)
        .otherwise(F.col("m.months_missed")),
        "is_enrolled": F.when(changed, 1).otherwise(F.col("m.is_enrolled")),
        "is_qip_eligible": _eligible(month, reactivate),
        "date_new_member": F.when(inserted, F.col("s.download_date")).otherwise(
            F.col("m.date_new_member")
        ),
        "download_date": F.when(changed, F.col("s.download_date")).otherwise(F.col("m.download_date")),
    }
    for name in attributes:
        if name in new_columns:
            value = F.col(f"s.{name}")
            if name == "first_name":
                value = F.coalesce(value, F.lit(""))
            old = F.col(f"m.{name}") if name in stored_columns else F.lit(None)
            computed[name] = F.when(changed, value).otherwise(old)
    passed = [c for c in stored_columns if c not in computed]
    if not insert:
        rows = rows.where(~_is_new())
    return rows.select(
        "cin",
        *[expr.alias(name) for name, expr in computed.items()],
        *[F.col(f"m.{c}").alias(c) for c in passed],
        act.alias("merge_action"),
    )


def _action(reactivate: bool) -> Column:
    known_again = F.col("s").isNotNull() & (F.col("m.is_enrolled") == 0) & F.lit(reactivate)
    return F.when(_is_new(), "insert").when(known_again, "reactivate").otherwise("keep")


def _eligible(month: int, reactivate: bool) -> Column:
    act = _action(reactivate)
    missed = F.lit(month) - (F.col("m.months_enrolled") + 1)
    return (
        F.when(act == "insert", int(month <= 3))
        .when(act == "reactivate", F.when(missed <= 3, 1).otherwise(0))
        .otherwise(F.col("m.is_qip_eligible"))
    )


def history_of_file(rows: DataFrame, year: int, month: int, as_of: dt.date, insert: bool, reactivate: bool) -> DataFrame:
    """The history rows that a file adds, from ``side_by_side`` rows.

    Members that have none at all get one, dated by their last download (if the file has unknown
    members); members of the file get one for its month unless they have it by now (if
    the file has members without). Both are tests of history bits; nothing is joined again.
    """
    new = _is_new()
    day = F.when(new, F.col("s.download_date")).otherwise(F.col("m.download_date"))
    clinic = F.when(new, F.col("s.clinic_id")).otherwise(F.col("m.clinic_id"))
    before = F.when(new, int(as_of.month <= 3)).otherwise(F.col("m.is_qip_eligible"))
    gets_first = F.lit(insert) & (F.col("months") == 0)
    has_month = gets_first & (F.year(day) == year) & (F.month(day) == month)
    gets_month = F.lit(reactivate) & _lacks(month) & ~F.coalesce(has_month, F.lit(False))

    def row(clinic: Column, eligible: Column, day: Column) -> Column:
        return F.struct(
            clinic.alias("clinic_id"), F.year(day).alias("year"), F.month(day).alias("month"),
            eligible.alias("is_qip_eligible"), day.alias("download_date"))

    first = F.when(gets_first, row(clinic, before, day))
    of_file = F.when(gets_month, row(F.col("s.clinic_id"), _eligible(as_of.month, reactivate), F.col("s.download_date")))
    if not insert:
        rows = rows.where(~new)
    return rows.where(F.col("cin").isNotNull()).select("cin", F.inline(F.array_compact(F.array(first, of_file))))


def sheets_side_by_side(membership: DataFrame, staged: DataFrame, history: DataFrame, year: int) -> DataFrame:
    """Each member of either side once: stored columns ``m``, its rows ``e`` of the sheets in their order, history bits.

    ``staged`` numbers the sheets in ``sheet`` and has a member once in each.
    """
    entry = F.struct("sheet", *[c for c in staged.columns if c not in ("cin", "sheet")])
    sheets = staged.groupBy("cin").agg(F.sort_array(F.collect_list(entry)).alias("e"))
    m = membership.select("cin", F.struct(*[c for c in membership.columns if c != "cin"]).alias("m"))
    rows = m.join(sheets, "cin", "full_outer").join(month_bits(history, year), "cin", "left")
    return rows.withColumn("months", F.coalesce("months", F.lit(0)))


def _first_entry() -> Column:
    return F.get("e", F.lit(0))


def first_inserting() -> Column:
    """The first sheet with a member that the membership lacks, an aggregate of ``sheets_side_by_side``; NULL if none."""
    return F.min(F.when(_is_new(), _first_entry()["sheet"]))


def _gets_first(inserting: int | None) -> Column:
    """Whether a member gets a first history row: a new one by its own sheet, a known one by the first sheet
    that inserts, unless an earlier sheet has recorded it."""
    if inserting is None:
        return F.lit(False)
    by_then = F.col("e").isNull() | (_first_entry()["sheet"] >= inserting)
    return (F.col("months") == 0) & (_is_new() | by_then)


def recording_sheets(rows: DataFrame, year: int, month: int, inserting: int | None) -> DataFrame:
    """The sheets with a member that has no row of the month ahead of them: ``sheet``.

    A member is recorded behind the first sheet that lists it, so only that one counts; a first row
    that an earlier sheet has given it may be of the month.
    """
    day = F.col("m.download_date")
    earlier = F.lit(False) if inserting is None else (
        _gets_first(inserting) & ~_is_new() & (_first_entry()["sheet"] > inserting) & (F.year(day) == year) & (F.month(day) == month))
    lacks = F.col("e").isNotNull() & (F.col("months").bitwiseAND(F.lit(1 << month)) == 0) & ~F.coalesce(earlier, F.lit(False))
    return rows.where(lacks).select(_first_entry()["sheet"].alias("sheet")).distinct()


def with_acting(rows: DataFrame, recording: Sequence[int]) -> DataFrame:
    """``sheets_side_by_side`` rows with the one sheet's row ``s`` that changes the member, NULL if none does.

    A new member is inserted by the first sheet that lists it. A known one that is not enrolled is
    re-activated by the first sheet listing it that re-activates at all.
    """
    again = F.filter("e", lambda x: x["sheet"].isin(list(recording)))
    acting = F.when(_is_new(), _first_entry()).when(F.col("m.is_enrolled") == 0, F.get(again, F.lit(0)))
    return rows.withColumn("s", acting)


def history_of_sheets(rows: DataFrame, year: int, month: int, as_of: dt.date, inserting: int | None) -> DataFrame:
    """The history rows that several sheets of a month add one after the other, each with its ``sheet``."""
    new, entry = _is_new(), _first_entry()
    day = F.when(new, entry["download_date"]).otherwise(F.col("m.download_date"))
    first_clinic = F.when(new, entry["clinic_id"]).otherwise(F.col("m.clinic_id"))
    before = F.when(new, int(as_of.month <= 3)).otherwise(F.col("m.is_qip_eligible"))
    giver = F.when(new, entry["sheet"]).otherwise(F.lit(inserting).cast("int"))
    gets_first = _gets_first(inserting)
    has_month = F.coalesce(gets_first & (F.year(day) == year) & (F.month(day) == month), F.lit(False))
    gets_month = F.col("e").isNotNull() & (F.col("months").bitwiseAND(F.lit(1 << month)) == 0) & ~has_month

    def row(clinic: Column, eligible: Column, day: Column, sheet: Column) -> Column:
        return F.struct(
            clinic.alias("clinic_id"), F.year(day).alias("year"), F.month(day).alias("month"),
            eligible.alias("is_qip_eligible"), day.alias("download_date"), sheet.alias("sheet"))

    first = F.when(gets_first, row(first_clinic, before, day, giver))
    of_sheet = F.when(gets_month, row(entry["clinic_id"], _eligible(as_of.month, True), entry["download_date"], entry["sheet"]))
    return rows.where(F.col("cin").isNotNull()).select("cin", F.inline(F.array_compact(F.array(first, of_sheet))))


def with_eligibility_then(measures: DataFrame, rows: DataFrame, as_of: dt.date) -> DataFrame:
    """Rows of several sheets with the eligibility behind their own sheet, which a later one may change."""
    changed = F.when(_action(True) != "keep", F.col("s.sheet"))
    states = rows.select(
        "cin", changed.alias("_from"), F.col("m.is_qip_eligible").alias("_before"), _eligible(as_of.month, True).alias("_after"))
    joined = measures.join(states, "cin").withColumn(
        "is_qip_eligible", F.when(F.col("sheet") < F.col("_from"), F.col("_before")).otherwise(F.col("_after")))
    return joined.select(
        "cin", "clinic_id", "measure_id", "year", "month", "is_compliant", "is_qip_eligible", "download_date", "sheet")


def with_eligibility(measures: DataFrame, membership: DataFrame) -> DataFrame:
    """Measure rows of known members with their eligibility at upload."""
    return measures.join(membership.select("cin", "is_qip_eligible"), "cin").select(
        "cin", "clinic_id", "measure_id", "year", "month", "is_compliant", "is_qip_eligible",
        "download_date",
    )
