"""Measure aggregates: the summary snapshot and performance against goals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def measure_summary(measures: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Numerators and denominators per clinic, measure and download, all and eligible; ``by`` names further groups."""
    hit = F.col("is_compliant") == 1
    eligible = F.col("is_qip_eligible") == 1
    return measures.groupBy("clinic_id", "measure_id", "year", "month", "download_date", *by).agg(
        F.count(F.when(hit & eligible, 1)).alias("qip_numerator"),
        F.count(F.when(eligible, 1)).alias("qip_denominator"),
        F.count(F.when(hit, 1)).alias("numerator"),
        F.count("*").alias("denominator"),
    )


def against_goal(summary: DataFrame, goals: DataFrame) -> DataFrame:
    """Performance in percent and whether it reaches the goal of the year.

    The goals may be an aggregate of their own, so the planner sizes them when they are there.
    """
    goal = goals.select("measure_id", "year", "percentage")
    percent = 100.0 * F.col("numerator") / F.nullif(F.col("denominator"), F.lit(0))
    return (
        summary.join(goal, ["measure_id", "year"])
        .withColumn("performance", percent)
        .withColumn("goal_met", (F.col("performance") >= F.col("percentage")).cast("int"))
    )
