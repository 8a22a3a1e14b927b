"""Newest-row and best-row selection, and retention of the last snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.session import broadcast_if_small, materialize


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per group. Each map task keeps one row of a group ahead of the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def latest_version(
    df: DataFrame, keys: Sequence[str], updated: Sequence[str], tie: str
) -> DataFrame:
    """The most recently updated row per group, missing dates last, ties by lowest id."""
    order = [F.col(c).desc_nulls_last() for c in updated] + [F.col(tie).asc()]
    return first_per_group(df, keys, order)


def last_dates(df: DataFrame, groups: Sequence[str], day: str) -> DataFrame:
    """The last date of each group, from an aggregate that combines on the map side."""
    return df.groupBy(*groups).agg(F.max(day).alias("last_date"))


def retain_latest(df: DataFrame, groups: Sequence[str], day: str, dates: DataFrame | None = None) -> DataFrame:
    """Keep the rows of each group's last date.

    A group may hold a large share of all rows, so its last date comes from an aggregate
    and not from a window over the group. ``dates`` gives it where a caller has it from fewer columns or
    joins, or keeps it. The aggregate is stored, so that its size check and its join compute it once,
    and joins by broadcast if small.
    """
    dates = materialize(last_dates(df, groups, day) if dates is None else dates, "last-dates")
    last = broadcast_if_small(dates.select(*groups, F.col("last_date").alias("_last")))
    return df.join(last, list(groups)).where(F.col(day) == F.col("_last")).drop("_last")


def retention_counts(df: DataFrame, groups: Sequence[str], day: str) -> DataFrame:
    """Rows kept and deleted per group."""
    per_day = df.groupBy(*groups, day).agg(F.count("*").alias("_rows"))
    return per_day.groupBy(*groups).agg(
        F.max_by("_rows", day).alias("kept"),
        (F.sum("_rows") - F.max_by("_rows", day)).alias("deleted"),
    )
