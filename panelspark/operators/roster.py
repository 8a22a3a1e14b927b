"""The monthly roster: continuity gate, membership merge and month history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.schemas import ROSTER_ATTRIBUTES


def gate_status(stored: Column, incoming: Column) -> Column:
    """May a roster of date ``incoming`` follow a table last loaded on ``stored``?

    Only months are compared: ``rollover`` from December to January, ``ok`` for the next
    month, ``duplicate`` for the same one, ``gap`` otherwise and ``empty`` without a date.
    """
    old, new = F.month(stored), F.month(incoming)
    return (
        F.when(stored.isNull() | incoming.isNull(), "empty")
        .when((old == 12) & (new == 1), "rollover")
        .when(new == old, "duplicate")
        .when(new != old + 1, "gap")
        .otherwise("ok")
    )


def continuity_gate(
    base: DataFrame, incoming: DataFrame, by: Sequence[str] = (), day: str = "download_date"
) -> DataFrame:
    """Last dates of both sides and the gate status, from one aggregate over both."""
    stored = base.select(*by, F.col(day).alias("stored"), F.lit(None).cast("date").alias("incoming"))
    arrived = incoming.select(*by, F.lit(None).cast("date").alias("stored"), F.col(day).alias("incoming"))
    return (
        stored.unionByName(arrived)
        .groupBy(*by)
        .agg(F.max("stored").alias("stored"), F.max("incoming").alias("incoming"))
        .withColumn("status", gate_status(F.col("stored"), F.col("incoming")))
    )


def eligibility(month: int, months_enrolled: Column, is_enrolled: Column) -> Column:
    """Everyone up to March; in December only the enrolled; at most three months missed."""
    if month <= 3:
        return F.lit(1)
    missed = F.lit(month) - months_enrolled
    by_months = F.when(missed > 3, 0).when(missed <= 3, 1)
    return F.when(is_enrolled == 0, 0).otherwise(by_months) if month == 12 else by_months


def apply_roster(
    base: DataFrame,
    incoming: DataFrame,
    month: int,
    rollover: bool,
    run_at: dt.datetime | None = None,
    attributes: Sequence[str] = ROSTER_ATTRIBUTES,
    key: str = "cin",
) -> DataFrame:
    """The membership after a roster month, in one pass over one join.

    Reset of the flags, update of known members, insert of new ones and the eligibility of
    all are columns of the same full outer join on the key, which is unique on both sides.
    ``merge_action`` tells ``update``, ``insert`` and ``keep`` apart.
    """
    incoming = incoming.select("*", F.lit(1).alias("_new"))
    base = base.select("*", F.lit(1).alias("_old"))
    b, i = base.alias("b"), incoming.alias("i")
    known, arrived = F.col("b._old").isNotNull(), F.col("i._new").isNotNull()

    def stored(name: str) -> Column:
        return F.col(f"b.{name}")

    def fresh(name: str) -> Column:
        return F.col(f"i.{name}")

    earlier = F.lit(0) if rollover else stored("months_enrolled")
    computed = {
        "date_new_member": F.when(~known, fresh("download_date"))
        .when(arrived & (fresh("new_member") == 1), fresh("download_date"))
        .otherwise(stored("date_new_member")),
        "months_enrolled": F.when(~known, 1).when(arrived, earlier + 1).otherwise(earlier),
        "is_enrolled": F.when(arrived, fresh("is_enrolled")).otherwise(0),
        "download_date": F.when(arrived, fresh("download_date")).otherwise(stored("download_date")),
    }
    if "updated_at" in base.columns:
        now = F.lit(run_at).cast("timestamp")
        computed["updated_at"] = F.when(known & arrived, F.date_trunc("minute", now)).otherwise(
            stored("updated_at")
        )
    for name in attributes:
        if name in incoming.columns:
            old = stored(name) if name in base.columns else F.lit(None)
            computed[name] = F.when(arrived, fresh(name)).otherwise(old)
    recomputed = {"months_missed", "is_qip_eligible", key, "_old"} | computed.keys()
    passed = [stored(c).alias(c) for c in base.columns if c not in recomputed]
    merged = b.join(i, key, "full_outer").select(
        key,
        *[expr.alias(name) for name, expr in computed.items()],
        *passed,
        F.when(known & arrived, "update").when(arrived, "insert").otherwise("keep").alias("merge_action"),
    )
    return merged.withColumns(
        {
            "months_missed": F.lit(month) - F.col("months_enrolled"),
            "is_qip_eligible": eligibility(month, F.col("months_enrolled"), F.col("is_enrolled")),
        }
    )


def reset_flags(base: DataFrame, rollover: bool) -> DataFrame:
    """The reset alone, for a caller that publishes it ahead of the merge."""
    columns = {"is_enrolled": F.lit(0), "is_qip_eligible": F.lit(0)}
    if rollover:
        columns["months_enrolled"] = F.lit(0)
    return base.withColumns(columns)


def arrivals(merged: DataFrame, key: str = "cin") -> DataFrame:
    """Members the merge inserted, ordered by clinic."""
    return merged.where(F.col("merge_action") == "insert").select("clinic_id", key).orderBy("clinic_id", key)


def history_rows(membership: DataFrame, key: str = "cin") -> DataFrame:
    """A history row for every enrolled member, dated by its download."""
    return membership.where(F.col("is_enrolled") == 1).select(
        key,
        "clinic_id",
        F.year("download_date").alias("year"),
        F.month("download_date").alias("month"),
        "is_qip_eligible",
        "download_date",
    )


def enrollment_counts(membership: DataFrame) -> DataFrame:
    """Enrolled and eligible members; NULL for an empty table."""
    return membership.agg(
        F.sum(F.when(F.col("is_enrolled") == 1, 1).otherwise(0)).alias("enrolled_count"),
        F.sum(F.when(F.col("is_qip_eligible") == 1, 1).otherwise(0)).alias("qip_eligible_count"),
    )


def merge_counts(merged: DataFrame) -> DataFrame:
    """All counts of a roster run from one aggregate."""
    action = F.col("merge_action")
    return merged.agg(
        F.count(F.when(action == "update", 1)).alias("update_count"),
        F.count(F.when(action == "insert", 1)).alias("insert_count"),
        F.sum(F.when(F.col("is_enrolled") == 1, 1).otherwise(0)).alias("enrolled_count"),
        F.sum(F.when(F.col("is_qip_eligible") == 1, 1).otherwise(0)).alias("qip_eligible_count"),
    )
