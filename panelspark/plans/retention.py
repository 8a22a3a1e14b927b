"""Retention of the last snapshot of each group, upload by upload."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.operators.latest import last_dates, retain_latest
from panelspark.session import broadcast_if_small, materialize
from panelspark.sources import tables
from panelspark.sources.runs import Run


def run_retention(
    spark: SparkSession,
    upload: DataFrame,
    key: str,
    table: str,
    dates_table: str,
    groups: Sequence[str],
    day: str,
    partitions: Sequence[str] = ("year", "month"),
) -> list[tuple]:
    """Add an upload to a table that keeps only the rows of each group's last date.

    The last date of every group is a small table of its own, so an upload reads and rewrites only
    the partitions that its rows belong to; ``partitions`` are among ``groups``. Rows that come late, dated before
    their group's last, are not added. Returns the rewritten partitions. An upload whose key comes again replaces what
    is left of its rows there; rows that it had superseded are gone.
    """
    run = Run(spark, f"{table}-runs", key)
    upload = materialize(upload, "upload")
    new = materialize(last_dates(upload, groups, day), "upload-dates")
    touched = [tuple(r) for r in new.select(*partitions).distinct().collect()]
    stored = _stored(spark, run, table, touched, partitions, upload)
    if tables.published_versions(spark, dates_table):
        before = tables.read_version(spark, dates_table)
        dates = before.unionByName(new).groupBy(*groups).agg(F.max("last_date").alias("last_date"))
    else:
        dates = new
    dates, _ = run.snapshot(dates, dates_table)
    changed = new.select(*groups)
    kept = retain_latest(stored, groups, day, dates.join(changed, list(groups), "left_semi"))
    unchanged = stored.join(broadcast_if_small(changed), list(groups), "left_anti")
    run.partitions(kept.unionByName(unchanged), table, partitions, touched)
    run.commit()
    return sorted(touched)


def _stored(spark: SparkSession, run: Run, table: str, touched: list[tuple], partitions: Sequence[str], upload: DataFrame) -> DataFrame:
    """The touched partitions with the upload's rows in place of those of the same key."""
    arrived = upload.withColumn("run", F.lit(run.value))
    if not touched or not tables.exists(spark, table):
        return arrived
    wanted = reduce(or_, [reduce(lambda a, b: a & b, [F.col(p) == v for p, v in zip(partitions, values, strict=True)]) for values in touched])
    earlier = run.without_own(spark.read.schema(arrived.schema).parquet(table).where(wanted))
    return earlier.unionByName(arrived)
