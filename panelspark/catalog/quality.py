"""Check queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.catalog import roles
from panelspark.catalog.registry import register
from panelspark.catalog.roles import AS_OF, member_id
from panelspark.functions.dates import name_part
from panelspark.operators import checks
from panelspark.operators.keys import coverage, except_keys, is_in, not_in
from panelspark.schemas import Constraints
from panelspark.session import materialize


@register(
    "value_coverage",
    """
    SELECT 'missing' AS side, CAST(id AS VARCHAR) AS value FROM clinics
    WHERE is_active = 1 AND id NOT IN (SELECT s_nationkey FROM supplier)
    UNION ALL
    SELECT DISTINCT 'unmapped', CAST(s_nationkey AS VARCHAR) FROM supplier
    WHERE s_nationkey NOT IN (SELECT id FROM clinics WHERE is_active = 1)""",
    ("clinics",),
)
def value_coverage(spark, sf_dir):
    active = roles.clinics(spark, sf_dir).where("is_active = 1")
    return coverage(roles.table(spark, sf_dir, "supplier"), "s_nationkey", active, "id")


@register(
    "coverage_message",
    """
    SELECT side, string_agg(value, ' & ' ORDER BY value) AS message FROM (
      SELECT 'unmapped' AS side, CAST(c_nationkey AS VARCHAR) AS value FROM customer
      WHERE c_nationkey NOT IN (SELECT id FROM clinics WHERE is_active = 1) GROUP BY ALL)
    GROUP BY side""",
    ("clinics",),
)
def coverage_message(spark, sf_dir):
    active = roles.clinics(spark, sf_dir).where("is_active = 1")
    sides = coverage(roles.table(spark, sf_dir, "customer"), "c_nationkey", active, "id")
    return checks.distinct_text(sides, "value", ["side"])


@register(
    "distinct_values",
    "SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders",
)
def distinct_values(spark, sf_dir):
    return roles.table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderstatus").distinct()


@register(
    "semi_anti_members",
    """
    SELECT 'in' AS part, c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
    UNION ALL
    SELECT 'not in', c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""",
)
def semi_anti_members(spark, sf_dir):
    customer = roles.table(spark, sf_dir, "customer").select("c_custkey")
    finished = roles.table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(
        F.col("o_custkey").alias("c_custkey")
    )
    return is_in(customer, finished, ["c_custkey"]).select(F.lit("in").alias("part"), "c_custkey").unionByName(
        not_in(customer, finished, ["c_custkey"]).select(F.lit("not in").alias("part"), "c_custkey")
    )


@register(
    "required_nulls",
    """
    SELECT count(*) AS row_count, count(*) FILTER (phone_raw IS NULL) AS phone_raw_nulls,
           count(*) FILTER (line1 IS NULL) AS line1_nulls, count(*) FILTER (city IS NULL) AS city_nulls,
           count(*) FILTER (mark IS NULL) AS mark_nulls
    FROM contacts""",
    ("contacts",),
)
def required_nulls(spark, sf_dir):
    return checks.null_counts(roles.contacts(spark, sf_dir), ["phone_raw", "line1", "city", "mark"])


def _float_ids(spark, sf_dir):
    """Ids as a reader that took them for floats would hand them on for overdrawn members."""
    return roles.table(spark, sf_dir, "customer").select(
        F.when(F.col("c_acctbal") < 0, F.col("c_custkey").cast("double").cast("string"))
        .otherwise(member_id("c_custkey"))
        .alias("cin"),
        F.col("c_nationkey").cast("int").alias("clinic_id"),
    )


_FLOAT_IDS = """
    SELECT CASE WHEN c_acctbal < 0 THEN c_custkey || '.0' ELSE to_base(c_custkey, 36, 10) END AS cin,
           CAST(c_nationkey AS INTEGER) AS clinic_id
    FROM customer"""


@register(
    "id_shape",
    f"""
    , ids AS ({_FLOAT_IDS})
    SELECT cin, clinic_key AS clinic FROM ids JOIN clinics ON id = clinic_id
    WHERE length(cin) <> 10 OR contains(cin, '.0')""",
    ("clinics",),
)
def id_shape(spark, sf_dir):
    return checks.id_violations(_float_ids(spark, sf_dir), "cin", roles.clinics(spark, sf_dir), "clinic_key")


@register(
    "id_length_range",
    f"SELECT CAST(min(length(cin)) AS INTEGER) AS min_length, CAST(max(length(cin)) AS INTEGER) AS max_length FROM ({_FLOAT_IDS})",
)
def id_length_range(spark, sf_dir):
    return checks.length_range(_float_ids(spark, sf_dir), "cin")


@register(
    "constraint_violations",
    """
    , staged AS (SELECT o_custkey || '' AS cin, CAST(c_nationkey AS INTEGER) AS clinic_id,
                        NULLIF(c_mktsegment, 'HOUSEHOLD') AS first_name, o_orderpriority AS rp
                 FROM orders JOIN customer ON o_custkey = c_custkey)
    SELECT 'not_null' AS rule, 'first_name' AS column_name, cin AS key_value FROM staged WHERE first_name IS NULL
    UNION ALL SELECT 'max_length', 'rp', cin FROM staged WHERE length(rp) > 5
    UNION ALL SELECT 'exact_length', 'cin', cin FROM staged WHERE length(cin) <> 3
    UNION ALL SELECT 'primary_key', 'cin', cin FROM staged GROUP BY cin HAVING count(*) > 1
    UNION ALL SELECT DISTINCT 'foreign_key', 'clinic_id', CAST(clinic_id AS VARCHAR) FROM staged
              WHERE clinic_id NOT IN (SELECT id FROM clinics WHERE is_active = 1)""",
    ("clinics",),
)
def constraint_violations(spark, sf_dir):
    customer = roles.table(spark, sf_dir, "customer")
    staged = roles.table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_custkey").cast("string").alias("cin"),
        F.col("c_nationkey").cast("int").alias("clinic_id"),
        F.nullif("c_mktsegment", F.lit("HOUSEHOLD")).alias("first_name"),
        F.col("o_orderpriority").alias("rp"),
    )
    rules = Constraints(("cin",), ("cin", "first_name"), {"cin": 3}, {"rp": 5})
    active = roles.clinics(spark, sf_dir).where("is_active = 1")
    return checks.constraint_violations(staged, rules, {"clinic_id": (active, "id")})


@register(
    "violations_table",
    """
    , staged AS (SELECT CASE WHEN l_linenumber = 7 THEN '' ELSE CAST(l_orderkey AS VARCHAR) END AS order_no, l_linenumber AS line_no,
                        CAST(l_suppkey AS INTEGER) AS site, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_linestatus END AS state
                 FROM lineitem)
    SELECT rule, column_name, key_value, count(*) AS violations FROM (
      SELECT 'not_null' AS rule, 'state' AS column_name, order_no || '|' || line_no AS key_value FROM staged WHERE state IS NULL
      UNION ALL SELECT 'max_length', 'order_no', order_no || '|' || line_no FROM staged WHERE length(order_no) > 3
      UNION ALL (SELECT 'primary_key', 'order_no,line_no', order_no || '|' || line_no FROM staged GROUP BY order_no, line_no HAVING count(*) > 1)
      UNION ALL (SELECT DISTINCT 'foreign_key', 'site', CAST(site AS VARCHAR) FROM staged WHERE site NOT IN (SELECT id FROM clinics)))
    GROUP BY ALL""",
    ("clinics",),
)
def violations_table(spark, sf_dir):
    """The violations of every line, stored whole as a stopped job leaves them; one key is an empty text."""
    staged = roles.table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") == 7, "").otherwise(F.col("l_orderkey").cast("string")).alias("order_no"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_suppkey").cast("int").alias("site"),
        F.when(F.col("l_returnflag") != "R", F.col("l_linestatus")).alias("state"),
    )
    rules = Constraints(("order_no", "line_no"), ("state",), {}, {"order_no": 3})
    found = checks.constraint_violations(staged, rules, {"site": (roles.clinics(spark, sf_dir), "id")})
    return materialize(found, "violations").groupBy("rule", "column_name", "key_value").agg(F.count("*").alias("violations"))


@register(
    "row_count_reconciliation",
    """
    SELECT 'source' AS stage, count(*) AS row_count FROM lineitem
    UNION ALL SELECT 'staged', count(*) FROM measure_rows""",
    ("measure_rows",),
)
def row_count_reconciliation(spark, sf_dir):
    return checks.row_counts(
        source=roles.table(spark, sf_dir, "lineitem"), staged=roles.measure_rows(spark, sf_dir)
    )


def _file_names(spark, sf_dir):
    """The processed file names of all roster months: site and period."""
    customer = roles.table(spark, sf_dir, "customer")
    nation = roles.table(spark, sf_dir, "nation")
    order = roles.table(spark, sf_dir, "orders")
    return (
        order.join(customer, order.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .select(
            F.concat(
                F.replace("n_name", F.lit("_"), F.lit("")), F.lit("_"), F.date_format("o_orderdate", "MM-yyyy"), F.lit(".txt")
            ).alias("file_name")
        )
        .distinct()
    )


_FILE_NAMES = """
    SELECT DISTINCT replace(n_name, '_', '') AS site, strftime(o_orderdate, '%m-%Y') AS suffix,
           CAST(date_trunc('month', o_orderdate) AS DATE) AS period
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""


@register(
    "period_uniqueness",
    f"""
    SELECT site, count(DISTINCT period) AS periods,
           CAST(count(DISTINCT period) = 1 AS INTEGER) AS is_valid,
           CASE WHEN count(DISTINCT period) > 1 THEN 'several months'
                WHEN max(period) = DATE '{AS_OF.replace(day=1)}' THEN 'current month'
                ELSE 'other month' END AS status
    FROM (SELECT 'all' AS site, period FROM ({_FILE_NAMES})
          UNION ALL
          SELECT 'last', max(period) FROM ({_FILE_NAMES}))
    GROUP BY site""",
)
def period_uniqueness(spark, sf_dir):
    names = _file_names(spark, sf_dir)
    last = names.agg(F.max_by("file_name", F.expr("to_date(substring(file_name, -11, 7), 'MM-yyyy')")).alias("file_name"))
    every = checks.period_status(names, "file_name", AS_OF).withColumn("site", F.lit("all"))
    newest = checks.period_status(last, "file_name", AS_OF).withColumn("site", F.lit("last"))
    return every.unionByName(newest).select("site", "periods", "is_valid", "status")


@register(
    "clinic_file_check",
    f"""
    , files AS ({_FILE_NAMES}), active AS (SELECT replace(clinic_key, '_', '') AS site FROM clinics WHERE is_active = 1)
    SELECT 'missing' AS side, site AS value FROM active WHERE site NOT IN (SELECT site FROM files)
    UNION ALL
    SELECT DISTINCT 'unmapped', site FROM files WHERE site NOT IN (SELECT site FROM active)""",
    ("clinics",),
)
def clinic_file_check(spark, sf_dir):
    keyed = roles.clinics(spark, sf_dir).withColumn("clinic_key", F.replace("clinic_key", F.lit("_"), F.lit("")))
    return checks.file_coverage(
        _file_names(spark, sf_dir), name_part(F.col("file_name"), "_", 0), keyed, "clinic_key"
    )


@register(
    "missing_fields",
    """
    SELECT c_mktsegment AS layout, count(*) AS member_rows, 'RP & End Date' AS missing
    FROM customer GROUP BY ALL""",
)
def missing_fields(spark, sf_dir):
    renamed = {"c_custkey": "Record#", "c_name": "Last Name", "c_mktsegment": "layout"}
    df = roles.table(spark, sf_dir, "customer").withColumnsRenamed(renamed)
    absent = checks.missing_fields(df.columns, ["Record#", "Last Name", "RP", "End Date"])
    return df.groupBy("layout").agg(F.count("*").alias("member_rows"), F.lit(" & ".join(absent)).alias("missing"))


@register(
    "new_data_due",
    """
    SELECT c_custkey, CASE WHEN day(last_order) >= 10 AND last_order > last_ship THEN 1 ELSE 0 END AS is_due
    FROM (SELECT c_custkey, CAST(max(o_orderdate) AS DATE) AS last_order, CAST(max(l_shipdate) AS DATE) AS last_ship
          FROM customer JOIN orders ON o_custkey = c_custkey LEFT JOIN lineitem ON l_orderkey = o_orderkey
          GROUP BY ALL)""",
)
def new_data_due(spark, sf_dir):
    customer = roles.table(spark, sf_dir, "customer").select("c_custkey")
    order = roles.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    line = roles.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    dates = (
        order.join(line, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.max("o_orderdate").cast("date").alias("last_order"),
            F.max("l_shipdate").cast("date").alias("last_ship"),
        )
    )
    due = checks.new_data_due(F.col("last_ship"), F.col("last_order"), F.col("last_order"))
    return customer.join(dates, "c_custkey").select("c_custkey", due.cast("int").alias("is_due"))


@register(
    "except_null_safe",
    """
    SELECT n_name, sex_code FROM contacts
    EXCEPT SELECT n_name, sex_code FROM contacts WHERE c_acctbal > 9900""",
    ("contacts",),
)
def except_null_safe(spark, sf_dir):
    df = roles.contacts(spark, sf_dir)
    return except_keys(df, df.where("c_acctbal > 9900"), ["n_name", "sex_code"])
