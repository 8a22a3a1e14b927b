"""Summary, goal, retention and extract queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.catalog import roles
from panelspark.catalog.registry import register
from panelspark.operators.latest import last_dates, retain_latest, retention_counts
from panelspark.operators.summary import against_goal, measure_summary
from panelspark.plans.reports import blood_pressure_report
from panelspark.plans.retention import run_retention
from panelspark.session import materialize, shared_folder

_SUMMARY = """
    SELECT clinic_id, measure_id, year, month, download_date,
           count(*) FILTER (is_compliant = 1 AND is_qip_eligible = 1) AS qip_numerator,
           count(*) FILTER (is_qip_eligible = 1) AS qip_denominator,
           count(*) FILTER (is_compliant = 1) AS numerator, count(*) AS denominator
    FROM measure_rows GROUP BY ALL"""


@register(
    "measures_summary",
    f"SELECT * REPLACE (CAST(download_date AS VARCHAR) AS download_date) FROM ({_SUMMARY})",
    ("measure_rows",),
)
def measures_summary(spark, sf_dir):
    return measure_summary(roles.measure_rows(spark, sf_dir))


@register(
    "measures_vs_goal",
    """
    SELECT clinic_id, measure_id, year, numerator, denominator, percentage,
           round(100.0 * numerator / denominator, 6) AS performance,
           CASE WHEN 100.0 * numerator / denominator >= percentage THEN 1 ELSE 0 END AS goal_met
    FROM (SELECT clinic_id, measure_id, year, count(*) FILTER (is_compliant = 1) AS numerator,
                 count(*) AS denominator
          FROM measure_rows GROUP BY ALL) JOIN goals USING (measure_id, year)""",
    ("measure_rows", "goals"),
)
def measures_vs_goal(spark, sf_dir):
    yearly = measure_summary(roles.measure_rows(spark, sf_dir)).groupBy("clinic_id", "measure_id", "year")
    totals = yearly.agg(F.sum("numerator").alias("numerator"), F.sum("denominator").alias("denominator"))
    return against_goal(totals, roles.goals(spark, sf_dir)).withColumn(
        "performance", F.round("performance", 6)
    )


@register(
    "measures_latest_retention",
    """
    SELECT o_custkey, clinic_id, measure_id, year, month, is_compliant, is_qip_eligible,
           CAST(download_date AS VARCHAR) AS download_date
    FROM measure_rows
    QUALIFY download_date = max(download_date) OVER (PARTITION BY measure_id, year, month)""",
    ("measure_rows",),
)
def measures_latest_retention(spark, sf_dir):
    groups = ["measure_id", "year", "month"]
    dates = last_dates(roles.measure_dates(spark, sf_dir), groups, "download_date")
    return retain_latest(roles.measure_rows(spark, sf_dir), groups, "download_date", dates)


@register(
    "retention_incremental",
    """
    SELECT o_custkey, clinic_id, measure_id, year, month, is_compliant, is_qip_eligible,
           CAST(download_date AS VARCHAR) AS download_date
    FROM measure_rows
    QUALIFY download_date = max(download_date) OVER (PARTITION BY measure_id, year, month)""",
    ("measure_rows",),
)
def retention_incremental(spark, sf_dir):
    """All rows in four uploads, each rewriting its own months only; the last one brings rows that are late."""
    rows = materialize(roles.measure_rows(spark, sf_dir), "measure-rows")
    folder = shared_folder(spark, "retention")
    day, even = F.dayofmonth("download_date"), F.col("year") % 2 == 0
    uploads = {"first": day.between(6, 20), "even years": (day > 20) & even, "odd years": (day > 20) & ~even, "late": day <= 5}
    for name, part in uploads.items():
        run_retention(
            spark, rows.where(part), name, f"{folder}/measures", f"{folder}/dates", ["measure_id", "year", "month"], "download_date")
    return spark.read.schema(rows.schema).parquet(f"{folder}/measures").select(*rows.columns)


def _snapshots(spark, sf_dir):
    return roles.table(spark, sf_dir, "events").select(
        "event_id",
        F.col("event_type").alias("measure"),
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        F.col("ts").cast("date").alias("download_date"),
        "user_id",
        (F.col("value") > 10).cast("int").alias("is_compliant"),
    )


_SNAPSHOTS = """
    SELECT event_id, event_type AS measure, CAST(year(ts) AS INTEGER) AS year,
           CAST(month(ts) AS INTEGER) AS month, CAST(ts AS DATE) AS download_date, user_id,
           CASE WHEN value > 10 THEN 1 ELSE 0 END AS is_compliant
    FROM events"""


@register(
    "events_latest_retention",
    f"""
    SELECT * REPLACE (CAST(download_date AS VARCHAR) AS download_date) FROM ({_SNAPSHOTS})
    QUALIFY download_date = max(download_date) OVER (PARTITION BY measure, year, month)""",
)
def events_latest_retention(spark, sf_dir):
    return retain_latest(_snapshots(spark, sf_dir), ["measure", "year", "month"], "download_date")


@register(
    "retention_counts",
    f"""
    SELECT measure, year, month, count(*) FILTER (kept) AS kept, count(*) FILTER (NOT kept) AS deleted
    FROM (SELECT *, download_date = max(download_date) OVER (PARTITION BY measure, year, month) AS kept
          FROM ({_SNAPSHOTS}))
    GROUP BY ALL""",
)
def retention_deletes(spark, sf_dir):
    return retention_counts(_snapshots(spark, sf_dir), ["measure", "year", "month"], "download_date")


@register(
    "condition_report",
    """
    WITH visits AS (SELECT o_custkey, CAST(max(o_orderdate) AS DATE) AS last_visit FROM orders GROUP BY ALL),
    status AS (SELECT o_custkey, CASE WHEN bool_or(o_orderstatus = 'F') THEN 'Denominator' ELSE 'None' END AS highbp
               FROM orders GROUP BY ALL)
    SELECT c_custkey AS bic_hik, strftime(l_shipdate, '%m/%d/%Y') AS date, l_quantity AS systolic,
           l_extendedprice AS diastolic, c_nationkey AS clinic, c_mktsegment || ' ' || c_name AS patient,
           CAST(DATE '1960-01-01' + CAST(floor(c_acctbal) AS INTEGER) AS VARCHAR) AS dob
    FROM customer JOIN status s ON s.o_custkey = c_custkey JOIN visits v ON v.o_custkey = c_custkey
         JOIN orders o ON o.o_custkey = c_custkey JOIN lineitem ON l_orderkey = o.o_orderkey
    WHERE highbp = 'Denominator' AND l_linestatus = 'F' AND l_returnflag <> 'R'
          AND CAST(l_shipdate AS DATE) > last_visit
    ORDER BY clinic""",
)
def condition_report(spark, sf_dir):
    customer = roles.table(spark, sf_dir, "customer")
    order = roles.table(spark, sf_dir, "orders")
    line = roles.table(spark, sf_dir, "lineitem")
    members = customer.select(
        F.col("c_custkey").alias("bic_hik"),
        F.col("c_custkey").alias("patientid"),
        F.col("c_nationkey").alias("clinic"),
        F.col("c_mktsegment").alias("firstname"),
        F.col("c_name").alias("lastname"),
        F.expr("date_add(DATE'1960-01-01', CAST(floor(c_acctbal) AS INT))").alias("dob"),
    )
    status = order.groupBy(F.col("o_custkey").alias("bic_hik")).agg(
        F.when(F.bool_or(F.col("o_orderstatus") == "F"), "Denominator").otherwise("None").alias("highbp")
    )
    visits = order.select(F.col("o_custkey").alias("cin"), F.col("o_orderdate").alias("date"))
    readings = line.join(order.select("o_orderkey", "o_custkey"), line.l_orderkey == order.o_orderkey).select(
        F.col("o_custkey").alias("patient_id"),
        F.col("l_shipdate").cast("date").alias("bp_date"),
        F.col("l_quantity").alias("systolic"),
        F.col("l_extendedprice").alias("diastolic"),
        (F.col("l_linestatus") == "F").cast("int").alias("numerator"),
        (F.col("l_returnflag") == "R").cast("int").alias("exclusion"),
    )
    return blood_pressure_report(members, status, readings, visits)
