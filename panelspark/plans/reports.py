"""Measure extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.dates import us_date


def blood_pressure_report(
    members: DataFrame, measures: DataFrame, readings: DataFrame, visits: DataFrame
) -> DataFrame:
    """Controlled readings after the last diagnosis visit of members in the denominator.

    The order is by clinic; member and date follow, so that one large clinic still sorts in
    many tasks.
    """
    last_visit = visits.groupBy("cin").agg(F.max(F.col("date").cast("date")).alias("last_visit"))
    in_measure = measures.where(F.col("highbp") == "Denominator").select("bic_hik")
    kept = readings.where((F.col("numerator") == 1) & (F.col("exclusion") == 0))
    return (
        members.join(in_measure, "bic_hik")
        .join(last_visit, F.col("bic_hik") == F.col("cin"))
        .join(kept, F.col("patientid") == F.col("patient_id"))
        .where(F.col("bp_date") > F.col("last_visit"))
        .orderBy("clinic", "bic_hik", "bp_date")
        .select(
            "bic_hik",
            us_date(F.col("bp_date")).alias("date"),
            "systolic",
            "diastolic",
            "clinic",
            F.concat("firstname", F.lit(" "), "lastname").alias("patient"),
            "dob",
        )
    )
