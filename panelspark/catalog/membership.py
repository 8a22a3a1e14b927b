"""Roster merge, gate, reconciliation and history queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.catalog import roles
from panelspark.catalog.registry import register
from panelspark.catalog.roles import AS_OF, MONTH, YEAR
from panelspark.operators import reconcile as C
from panelspark.operators import roster as R
from panelspark.plans.measures_file import reconcile
from panelspark.session import materialize


def _merged_sql(base: str, incoming: str, month: int, rollover: bool) -> str:
    earlier = "0" if rollover else "b.months_enrolled"
    attributes = ["clinic_id", "first_name", "last_name", "dob", "record_number", "new_member"]
    columns = ", ".join(
        f"CASE WHEN i.cin IS NULL THEN b.{a} ELSE i.{a} END AS {a}" for a in attributes
    )
    return f"""
      SELECT *, CAST({month} - months_enrolled AS INTEGER) AS months_missed,
             CASE WHEN {month} IN (1, 2, 3) THEN 1
                  WHEN {month} = 12 AND is_enrolled = 0 THEN 0
                  WHEN {month} - months_enrolled > 3 THEN 0
                  WHEN {month} - months_enrolled <= 3 THEN 1 END AS is_qip_eligible
      FROM (SELECT coalesce(b.cin, i.cin) AS cin, {columns},
                   CASE WHEN b.cin IS NULL OR i.new_member = 1 THEN i.download_date
                        ELSE b.date_new_member END AS date_new_member,
                   CAST(CASE WHEN b.cin IS NULL THEN 1
                             WHEN i.cin IS NULL THEN {earlier}
                             ELSE {earlier} + 1 END AS INTEGER) AS months_enrolled,
                   CASE WHEN i.cin IS NULL THEN 0 ELSE i.is_enrolled END AS is_enrolled,
                   coalesce(i.download_date, b.download_date) AS download_date,
                   CASE WHEN b.cin IS NULL THEN 'insert' WHEN i.cin IS NULL THEN 'keep'
                        ELSE 'update' END AS merge_action
            FROM {base} b FULL JOIN {incoming} i ON b.cin = i.cin)"""


_DAYS = "* REPLACE (CAST(dob AS VARCHAR) AS dob, CAST(date_new_member AS VARCHAR) AS date_new_member, CAST(download_date AS VARCHAR) AS download_date)"
_MERGED = _merged_sql("base", "incoming", MONTH, False)


def merged_month(spark, sf_dir):
    base = roles.membership(spark, sf_dir, YEAR, MONTH)
    return R.apply_roster(base, roles.roster(spark, sf_dir, YEAR, MONTH), MONTH, False)


@register("roster_upsert_eligibility", f"SELECT {_DAYS} FROM ({_MERGED})", ("base", "incoming"))
def roster_upsert_eligibility(spark, sf_dir):
    return merged_month(spark, sf_dir)


@register(
    "roster_rollover_reset",
    f"SELECT {_DAYS} FROM ({_merged_sql('base_january', 'january', 1, True)})",
    ("base_january", "january"),
)
def roster_rollover_reset(spark, sf_dir):
    base = roles.membership(spark, sf_dir, YEAR, 1)
    return R.apply_roster(base, roles.roster(spark, sf_dir, YEAR, 1), 1, True)


@register(
    "reset_flags",
    """SELECT cin, 0 AS is_enrolled, 0 AS is_qip_eligible, 0 AS months_enrolled FROM base_january""",
    ("base_january",),
)
def reset_flags(spark, sf_dir):
    base = roles.membership(spark, sf_dir, YEAR, 1)
    return R.reset_flags(base, True).select("cin", "is_enrolled", "is_qip_eligible", "months_enrolled")


@register(
    "roster_gate_status",
    """
    SELECT clinic_id, CAST(stored AS VARCHAR) AS stored, CAST(incoming AS VARCHAR) AS incoming,
           CASE WHEN stored IS NULL OR incoming IS NULL THEN 'empty'
                WHEN month(stored) = 12 AND month(incoming) = 1 THEN 'rollover'
                WHEN month(stored) = month(incoming) THEN 'duplicate'
                WHEN month(incoming) <> month(stored) + 1 THEN 'gap'
                ELSE 'ok' END AS status
    FROM (SELECT coalesce(clinic_id, -1) AS clinic_id,
                 max(day) FILTER (side = 'stored') AS stored, max(day) FILTER (side = 'incoming') AS incoming
          FROM (SELECT clinic_id, download_date AS day, 'stored' AS side FROM base
                UNION ALL SELECT clinic_id, download_date, 'incoming' FROM incoming)
          GROUP BY GROUPING SETS ((clinic_id), ()))""",
    ("base", "incoming"),
)
def roster_gate_status(spark, sf_dir):
    base = roles.membership(spark, sf_dir, YEAR, MONTH)
    incoming = roles.roster(spark, sf_dir, YEAR, MONTH)
    whole = R.continuity_gate(base, incoming).withColumn("clinic_id", F.lit(-1))
    return R.continuity_gate(base, incoming, ["clinic_id"]).unionByName(whole)


@register(
    "new_arrivals_report",
    "SELECT clinic_id, cin FROM incoming WHERE cin NOT IN (SELECT cin FROM base) ORDER BY clinic_id, cin",
    ("base", "incoming"),
)
def new_arrivals_report(spark, sf_dir):
    return R.arrivals(merged_month(spark, sf_dir))


@register(
    "month_history_append",
    f"""
    SELECT cin, clinic_id, CAST(year(download_date) AS INTEGER) AS year,
           CAST(month(download_date) AS INTEGER) AS month, is_qip_eligible,
           CAST(download_date AS VARCHAR) AS download_date
    FROM ({_MERGED}) WHERE is_enrolled = 1""",
    ("base", "incoming"),
)
def month_history_append(spark, sf_dir):
    return R.history_rows(merged_month(spark, sf_dir))


@register(
    "enrollment_counts",
    f"""
    SELECT count(*) FILTER (merge_action = 'update') AS update_count,
           count(*) FILTER (merge_action = 'insert') AS insert_count,
           CAST(sum(is_enrolled) AS BIGINT) AS enrolled_count,
           CAST(sum(is_qip_eligible) AS BIGINT) AS qip_eligible_count
    FROM ({_MERGED})""",
    ("base", "incoming"),
)
def enrollment_counts(spark, sf_dir):
    return R.merge_counts(merged_month(spark, sf_dir))


_RECONCILED = f"""
    SELECT coalesce(m.cin, s.cin) AS cin, a.act AS merge_action,
           CASE WHEN act = 'insert' THEN 1 WHEN act = 'reactivate' THEN m.months_enrolled + 1
                ELSE m.months_enrolled END AS months_enrolled,
           CASE WHEN act = 'insert' THEN {MONTH - 1} WHEN act = 'reactivate' THEN {MONTH} - (m.months_enrolled + 1)
                ELSE m.months_missed END AS months_missed,
           CASE WHEN act = 'keep' THEN m.is_enrolled ELSE 1 END AS is_enrolled,
           CASE WHEN act = 'insert' THEN {int(MONTH <= 3)}
                WHEN act = 'reactivate' THEN CASE WHEN {MONTH} - (m.months_enrolled + 1) <= 3 THEN 1 ELSE 0 END
                ELSE m.is_qip_eligible END AS is_qip_eligible,
           CASE WHEN act = 'keep' THEN m.clinic_id ELSE s.clinic_id END AS clinic_id,
           CASE WHEN act = 'keep' THEN m.download_date ELSE s.download_date END AS download_date
    FROM finished_members m
    FULL JOIN (SELECT DISTINCT cin, clinic_id, download_date FROM upload) s ON m.cin = s.cin,
    LATERAL (SELECT CASE WHEN m.cin IS NULL THEN 'insert'
                         WHEN s.cin IS NOT NULL AND m.is_enrolled = 0 THEN 'reactivate'
                         ELSE 'keep' END AS act) a"""


def _reconciled(spark, sf_dir, upload=None):
    return reconcile(
        roles.measures_upload(spark, sf_dir) if upload is None else upload,
        roles.membership(spark, sf_dir, YEAR, MONTH + 1, finished=True),
        roles.history(spark, sf_dir),
        YEAR,
        MONTH,
        AS_OF,
    )


@register(
    "missing_members_except",
    f"""
    SELECT 'membership' AS absent_from, cin FROM (SELECT cin FROM upload EXCEPT SELECT cin FROM finished_members)
    UNION ALL
    SELECT 'history', cin FROM (SELECT cin FROM upload EXCEPT
                                SELECT cin FROM history WHERE year = {YEAR} AND month = {MONTH})""",
    ("upload", "finished_members", "history"),
)
def missing_members_except(spark, sf_dir):
    upload = roles.measures_upload(spark, sf_dir)
    members = roles.membership(spark, sf_dir, YEAR, MONTH + 1, finished=True)
    unknown = C.unknown_members(upload, members)
    unrecorded = C.unrecorded_members(upload, roles.history(spark, sf_dir), YEAR, MONTH)
    return unknown.select(F.lit("membership").alias("absent_from"), "cin").unionByName(
        unrecorded.select(F.lit("history").alias("absent_from"), "cin")
    )


@register(
    "reconcile_membership",
    f"SELECT * REPLACE (CAST(download_date AS VARCHAR) AS download_date) FROM ({_RECONCILED})",
    ("upload", "finished_members"),
)
def reconcile_membership(spark, sf_dir):
    return _reconciled(spark, sf_dir).membership.select(
        "cin", "merge_action", "months_enrolled", "months_missed", "is_enrolled",
        "is_qip_eligible", "clinic_id", "download_date",
    )


@register(
    "reconcile_history",
    f"""
    , final AS ({_RECONCILED}),
    inserted AS (
      SELECT cin, clinic_id, is_qip_eligible, download_date FROM finished_members
      UNION ALL
      SELECT cin, clinic_id, is_qip_eligible, download_date FROM final WHERE merge_action = 'insert'),
    first_rows AS (
      SELECT cin, clinic_id, CAST(year(download_date) AS INTEGER) AS year,
             CAST(month(download_date) AS INTEGER) AS month, is_qip_eligible, download_date
      FROM inserted WHERE cin NOT IN (SELECT cin FROM history)),
    month_rows AS (
      SELECT s.cin, s.clinic_id, {YEAR} AS year, {MONTH} AS month, f.is_qip_eligible, s.download_date
      FROM (SELECT DISTINCT cin, clinic_id, download_date FROM upload) s JOIN final f ON f.cin = s.cin
      WHERE s.cin NOT IN (SELECT cin FROM history WHERE year = {YEAR} AND month = {MONTH}
                          UNION ALL
                          SELECT cin FROM first_rows WHERE year = {YEAR} AND month = {MONTH}))
    SELECT * REPLACE (CAST(download_date AS VARCHAR) AS download_date)
    FROM (SELECT * FROM first_rows UNION ALL SELECT * FROM month_rows)""",
    ("upload", "finished_members", "history"),
)
def reconcile_history(spark, sf_dir):
    return _reconciled(spark, sf_dir).history


@register(
    "measures_append",
    f"""
    , final AS ({_RECONCILED})
    SELECT u.cin, u.clinic_id, u.measure_id, u.year, u.month, u.is_compliant, f.is_qip_eligible,
           CAST(u.download_date AS VARCHAR) AS download_date
    FROM upload u JOIN final f ON f.cin = u.cin""",
    ("upload", "finished_members"),
)
def measures_append(spark, sf_dir):
    upload = materialize(roles.measures_upload(spark, sf_dir), "upload")
    return C.with_eligibility(upload, _reconciled(spark, sf_dir, upload).membership)


@register(
    "freshness_gate",
    f"""
    SELECT CAST(max(download_date) AS VARCHAR) AS last_download,
           CASE WHEN year(max(download_date)) = {YEAR} AND month(max(download_date)) = {MONTH}
                THEN 1 ELSE 0 END AS is_current
    FROM finished_members""",
    ("finished_members",),
)
def freshness_gate(spark, sf_dir):
    return C.is_current(roles.membership(spark, sf_dir, YEAR, MONTH + 1, finished=True), AS_OF)
