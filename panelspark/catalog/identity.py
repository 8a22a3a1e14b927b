"""Identity-matching queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from panelspark.catalog import roles
from panelspark.catalog.registry import register
from panelspark.catalog.roles import AS_OF
from panelspark.operators import matching as M
from panelspark.operators.latest import latest_version
from panelspark.plans.identity import run_matching
from panelspark.session import shared_folder
from panelspark.sources import tables


@register(
    "latest_patient_version",
    """
    SELECT p_name, p_size, p_partkey, p_retailprice FROM part
    QUALIFY row_number() OVER (PARTITION BY p_name, p_size ORDER BY p_retailprice DESC, p_partkey) = 1""",
)
def latest_patient_version(spark, sf_dir):
    df = roles.table(spark, sf_dir, "part").select("p_name", "p_size", "p_partkey", "p_retailprice")
    return latest_version(df, ["p_name", "p_size"], ["p_retailprice"], "p_partkey")


# Row-by-row longest common subsequence over every pair of texts that may be accepted. The
# built-in edit distance allows substitutions and is never larger than the one without, so
# the length bound skips no pair above 85.
_SCORED = """
    , current AS (
      SELECT * FROM patients
      WHERE pat_id NOT IN (SELECT epic_pat_id FROM members WHERE epic_pat_id IS NOT NULL)
      QUALIFY row_number() OVER (PARTITION BY pat_name, birth_date
                                 ORDER BY update_date DESC, rec_create_date DESC, pat_id) = 1),
    m AS (SELECT cin, dob, replace(trim(lower(first_name)), '-', ' ') AS f, replace(trim(lower(last_name)), '-', ' ') AS l,
                 [trim(lower(x)) FOR x IN string_split(first_name, ' ')][1:3] AS ft,
                 [trim(lower(x)) FOR x IN string_split(last_name, ' ')][1:3] AS lt
          FROM members WHERE epic_pat_id IS NULL),
    p AS (SELECT pat_id, birth_date, trim(lower(pat_first_name)) AS f, trim(lower(pat_last_name)) AS l,
                 [trim(lower(x)) FOR x IN string_split(pat_first_name, ' ')][1:3] AS ft,
                 [trim(lower(x)) FOR x IN string_split(pat_last_name, ' ')][1:3] AS lt
          FROM current),
    pairs AS (
      SELECT cin, pat_id, dob, m.f || ' ' || m.l AS phc_name, m.l || ' ' || m.f AS flipped, p.f || ' ' || p.l AS epic_name,
             CASE WHEN list_has_any(m.ft, p.ft) AND list_has_any(m.lt, p.lt) THEN 1 ELSE 0 END AS name_match
      FROM m JOIN p ON m.dob = p.birth_date
      WHERE left(m.f, 1) IN (left(p.f, 1), left(p.l, 1)) OR left(m.l, 1) IN (left(p.f, 1), left(p.l, 1))),
    texts AS (
      SELECT a, b, [ord(x) FOR x IN string_split(a, '')] AS ca, [ord(x) FOR x IN string_split(b, '')] AS cb
      FROM (SELECT phc_name AS a, epic_name AS b, name_match FROM pairs UNION SELECT flipped, epic_name, name_match FROM pairs)
      WHERE name_match = 1 OR levenshtein(a, b) < 0.15 * (length(a) + length(b))
      GROUP BY ALL),
    scores AS (
      SELECT a, b, 200.0::DOUBLE * list_last(list_reduce([[x] FOR x IN ca],
          lambda r, x: list_reduce([[x[1], j] FOR j IN range(1, len(cb) + 1)],
            lambda acc, y: list_append(acc, greatest(acc[len(acc)], r[y[2] + 1],
                             r[y[2]] + CASE WHEN cb[y[2]] = y[1] THEN 1 ELSE 0 END)), [0::BIGINT]),
          [0::BIGINT FOR j IN range(len(cb) + 1)])) / (length(a) + length(b)) AS score
      FROM texts),
    accepted AS (
      SELECT cin, pat_id AS epic_pat_id, CAST(dob AS VARCHAR) AS dob, phc_name, epic_name, name_match,
             greatest(coalesce(s.score, 0), coalesce(t.score, 0)) AS fuzzy_score
      FROM pairs LEFT JOIN scores s ON s.a = phc_name AND s.b = epic_name
                 LEFT JOIN scores t ON t.a = flipped AND t.b = epic_name
      WHERE name_match = 1 OR greatest(coalesce(s.score, 0), coalesce(t.score, 0)) > 85)"""

_BEST = """
    SELECT * FROM accepted
    QUALIFY row_number() OVER (PARTITION BY cin ORDER BY fuzzy_score DESC, epic_pat_id) = 1"""


def _inputs(spark, sf_dir):
    members = roles.match_members(spark, sf_dir)
    return members, M.current_patients(roles.match_patients(spark, sf_dir), members)


@register(
    "match_accepted",
    f"{_SCORED} SELECT * REPLACE (round(fuzzy_score, 6) AS fuzzy_score) FROM accepted",
    ("members", "patients"),
)
def match_accepted(spark, sf_dir):
    return M.accepted_matches(*_inputs(spark, sf_dir)).withColumn("fuzzy_score", F.round("fuzzy_score", 6))


@register(
    "match_best",
    f"{_SCORED} SELECT * REPLACE (round(fuzzy_score, 6) AS fuzzy_score) FROM ({_BEST})",
    ("members", "patients"),
)
def match_best(spark, sf_dir):
    return M.best_matches(*_inputs(spark, sf_dir)).withColumn("fuzzy_score", F.round("fuzzy_score", 6))


_LARGE = _SCORED.replace("FROM patients", "FROM block_patients").replace("FROM members", "FROM block_members")


@register(
    "match_large_blocks",
    f"{_LARGE} SELECT * REPLACE (round(fuzzy_score, 6) AS fuzzy_score) FROM accepted",
    ("block_members", "block_patients"),
)
def match_large_blocks(spark, sf_dir):
    """Two blocks of half the names each, joined on tokens and, by initial, in chunks; some links hold by their tokens alone."""
    members = roles.block_members(spark, sf_dir)
    current = M.current_patients(roles.block_patients(spark, sf_dir), members)
    return M.accepted_matches(members, current, pairs_per_name=16).withColumn("fuzzy_score", F.round("fuzzy_score", 6))


@register(
    "match_links",
    f"""{_SCORED}, best AS ({_BEST})
    SELECT members.cin, coalesce(best.epic_pat_id, members.epic_pat_id) AS epic_pat_id
    FROM members LEFT JOIN best ON best.cin = members.cin""",
    ("members", "patients"),
)
def match_links(spark, sf_dir):
    members, current = _inputs(spark, sf_dir)
    return M.apply_links(members, M.best_matches(members, current)).select("cin", "epic_pat_id")


_FOLLOWED = """
    , steps AS (SELECT patient_mrg_hist, min(pat_id) AS new_id FROM merges WHERE pat_id <> patient_mrg_hist GROUP BY ALL),
    followed AS (SELECT m.* REPLACE (coalesce(new_id, epic_pat_id) AS epic_pat_id) FROM members m LEFT JOIN steps ON patient_mrg_hist = epic_pat_id)"""


@register(
    "matching_job",
    f"""{_FOLLOWED}{_SCORED.replace("FROM members", "FROM followed")}, best AS ({_BEST})
    SELECT epic_pat_id, cin, dob, phc_name, epic_name, round(fuzzy_score, 6) AS fuzzy_score FROM best
    UNION ALL
    SELECT new_id, cin, NULL, NULL, NULL, NULL FROM members JOIN steps ON patient_mrg_hist = epic_pat_id""",
    ("members", "patients", "merges"),
)
def matching_job(spark, sf_dir):
    """The log of a matching run that follows merged ids, finds links and publishes both; it is run twice."""
    folder = shared_folder(spark, "matching")
    tables.write_version(roles.match_members(spark, sf_dir), f"{folder}/membership", 1)
    tables.publish(spark, f"{folder}/membership", 1)
    for _ in range(2):
        run_matching(
            spark, f"{folder}/membership", f"{folder}/log", roles.match_patients(spark, sf_dir), roles.merge_history(spark, sf_dir),
            "patient_mrg_hist", "pat_id", dt.datetime.combine(AS_OF, dt.time(7)))
    log = spark.read.parquet(f"{folder}/log")
    return log.drop("run").withColumn("fuzzy_score", F.round("fuzzy_score", 6))


@register(
    "rekey_merged_ids",
    """
    SELECT cin, coalesce(new_id, epic_pat_id) AS epic_pat_id
    FROM linked LEFT JOIN (SELECT patient_mrg_hist, min(pat_id) AS new_id FROM merges
                           WHERE pat_id <> patient_mrg_hist GROUP BY ALL) ON patient_mrg_hist = epic_pat_id""",
    ("linked", "merges"),
)
def rekey_merged_ids(spark, sf_dir):
    return M.rekey_merged(
        roles.linked_members(spark, sf_dir), roles.merge_history(spark, sf_dir), "patient_mrg_hist", "pat_id"
    )


@register(
    "merged_id_log",
    """
    SELECT min(pat_id) AS epic_pat_id, cin FROM linked JOIN merges ON patient_mrg_hist = epic_pat_id
    WHERE pat_id <> patient_mrg_hist GROUP BY cin""",
    ("linked", "merges"),
)
def merged_id_log(spark, sf_dir):
    return M.merged_ids(
        roles.linked_members(spark, sf_dir), roles.merge_history(spark, sf_dir), "patient_mrg_hist", "pat_id"
    )
