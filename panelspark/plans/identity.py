"""Identity matching: follow merged ids, then link unlinked members to patients."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from panelspark.operators import matching as M
from panelspark.session import materialize
from panelspark.sources.runs import Run


def run_matching(
    spark: SparkSession,
    membership_table: str,
    log_table: str,
    patients: DataFrame,
    merges: DataFrame,
    old: str,
    new: str,
    run_at: dt.datetime,
) -> int:
    """Publish a membership with followed and newly found links, and log both.

    The matches are stored first, since the membership and the log both derive from them; these are
    published together, and a repeated run replaces its own.
    """
    run = Run(spark, f"{membership_table}-runs", f"matching {run_at:%Y-%m-%d %H:%M}")
    base = run.base(membership_table)
    followed = M.rekey_merged(base, merges, old, new)
    best = materialize(M.best_matches(followed, M.current_patients(patients, followed)), "matches")
    _, version = run.snapshot(M.apply_links(followed, best), membership_table, int(run_at.strftime("%Y%m%d%H%M")))
    log = M.matching_log(best).unionByName(
        M.merged_ids(base, merges, old, new), allowMissingColumns=True
    )
    run.rows(log, log_table, partitions=())
    run.commit()
    return version
