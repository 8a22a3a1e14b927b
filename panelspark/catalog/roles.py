"""Membership, roster, measures and patient roles derived from the driver's tables.

Every role covers its whole table. ``SQL`` holds the same derivations as common table
expressions for the oracle; both sides are written independently of each other.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.session import spread_by_rows

# The roster month the registered queries apply, and the day they count as today.
AS_OF = dt.date(2001, 7, 31)
YEAR, MONTH = AS_OF.year, AS_OF.month


# The schemas of the driver's tables, so that a scan infers nothing.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "pages": "page_id BIGINT, url STRING, html STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def member_id(key: str) -> Column:
    """Ten characters, base 36, so that ids stay unique beyond ten decimal digits."""
    return F.lpad(F.conv(F.col(key).cast("string"), 10, 36), 10, "0")


def clinics(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("int").alias("id"),
        (F.col("n_nationkey") + 100).cast("int").alias("phc_id"),
        F.col("n_name").alias("clinic_key"),
        F.concat(F.lit("Clinic "), "n_name").alias("clinic"),
        F.col("r_name").alias("county"),
        (F.col("r_name") != "AFRICA").cast("int").alias("is_active"),
    )


def measures_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderpriority")
        .distinct()
        .select(
            F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).cast("int").alias("id"),
            F.split_part("o_orderpriority", F.lit("-"), F.lit(2)).alias("measure"),
            (F.col("o_orderpriority") != "4-NOT SPECIFIED").cast("int").alias("is_active"),
        )
    )


def customers(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """Member attributes that do not change between months."""
    return table(spark, sf_dir, "customer").select(
        *more,
        member_id("c_custkey").alias("cin"),
        F.col("c_nationkey").cast("int").alias("clinic_id"),
        F.col("c_mktsegment").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.date_add(F.lit(dt.date(1960, 1, 1)), F.floor("c_acctbal").cast("int")).alias("dob"),
    )


def orders(spark: SparkSession, sf_dir: str, since: dt.date | None = None, before: dt.date | None = None) -> DataFrame:
    """Orders as member activity; the filters are on stored columns, so that they reach the scan."""
    df = table(spark, sf_dir, "orders")
    if since is not None:
        df = df.where(F.col("o_orderdate") >= F.lit(since))
    if before is not None:
        df = df.where(F.col("o_orderdate") < F.lit(before))
    return df.select(
        member_id("o_custkey").alias("cin"),
        F.col("o_orderdate").cast("date").alias("day"),
        "o_orderkey",
        "o_orderpriority",
        "o_orderstatus",
    )


def roster(spark: SparkSession, sf_dir: str, year: int, month: int) -> DataFrame:
    """The roster of a month: customers with an order in it."""
    start = dt.date(year, month, 1)
    end = dt.date(year + month // 12, month % 12 + 1, 1)
    seen = (
        orders(spark, sf_dir, since=start, before=end)
        .groupBy("cin")
        .agg(
            F.max("day").alias("download_date"),
            F.max((F.col("o_orderpriority") == "1-URGENT").cast("int")).alias("new_member"),
            F.max("o_orderkey").cast("string").alias("record_number"),
        )
    )
    return seen.join(customers(spark, sf_dir), "cin").withColumn("is_enrolled", F.lit(1))


def membership(spark: SparkSession, sf_dir: str, year: int, month: int, finished: bool = False) -> DataFrame:
    """The membership ahead of a month: customers with any earlier order, or any that is ``finished``."""
    start = dt.date(year, month, 1)
    before = dt.date(year - (month == 1), (month - 2) % 12 + 1, 1)
    this_year = F.year("day") == year
    seen = (
        orders(spark, sf_dir, before=start)
        .groupBy("cin")
        .agg(
            F.bool_or(F.col("o_orderstatus") == "F").alias("_finished"),
            F.coalesce(
                F.bit_count(F.bit_or(F.when(this_year, F.expr("shiftleft(1, month(day))")))), F.lit(0)
            ).alias("months_enrolled"),
            F.max((F.col("day") >= before).cast("int")).alias("is_enrolled"),
            F.min("day").alias("date_new_member"),
            F.max("day").alias("download_date"),
            F.max("o_orderkey").cast("string").alias("record_number"),
        )
    )
    seen = (seen.where("_finished") if finished else seen).drop("_finished")
    return seen.join(customers(spark, sf_dir), "cin").withColumns(
        {
            "new_member": F.lit(0),
            "months_missed": F.lit(month - 1) - F.col("months_enrolled"),
            "is_qip_eligible": F.lit(1),
        }
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month history: a month counts for a member once an order of it that is not urgent is finished."""
    recorded = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") != "1-URGENT")
    return (
        orders(spark, sf_dir)
        .groupBy("cin", F.year("day").alias("year"), F.month("day").alias("month"))
        .agg(F.max("day").alias("download_date"), F.bool_or(recorded).alias("_recorded"))
        .where("_recorded")
        .drop("_recorded")
        .join(customers(spark, sf_dir).select("cin", "clinic_id"), "cin")
        .withColumn("is_qip_eligible", F.lit(1))
    )


def measure_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item: the measure is the order's priority, the clinic its nation."""
    line = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linestatus", "l_returnflag", F.col("l_shipdate").cast("date").alias("download_date")
    )
    order = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("int").alias("clinic_id")
    )
    return (
        line.join(order, line.l_orderkey == order.o_orderkey)
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            "o_custkey",
            "clinic_id",
            F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).cast("int").alias("measure_id"),
            F.year("download_date").alias("year"),
            F.month("download_date").alias("month"),
            (F.col("l_linestatus") == "F").cast("int").alias("is_compliant"),
            (F.col("l_returnflag") != "R").cast("int").alias("is_qip_eligible"),
            "download_date",
        )
    )


def measure_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measure and download date of every line item."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_shipdate").cast("date").alias("download_date"))
    order = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return line.join(order, line.l_orderkey == order.o_orderkey).select(
        F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).cast("int").alias("measure_id"),
        F.year("download_date").alias("year"),
        F.month("download_date").alias("month"),
        "download_date",
    )


def measures_upload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All line items as one file of today, with the attributes of their members."""
    line = spread_by_rows(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linestatus"), "l_orderkey")
    order = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    members = customers(spark, sf_dir, "c_custkey")
    return (
        line.join(order, line.l_orderkey == order.o_orderkey)
        .join(members, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            "cin",
            F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).cast("int").alias("measure_id"),
            (F.col("l_linestatus") == "F").cast("int").alias("is_compliant"),
            F.lit(YEAR).alias("year"),
            F.lit(MONTH).alias("month"),
            F.lit(AS_OF).alias("download_date"),
            "clinic_id", "first_name", "last_name", "dob",
            F.lit(0).alias("new_member"),
        )
    )


def goals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly goals: the share of unfinished orders of the priority, less sixteen points."""
    order = table(spark, sf_dir, "orders")
    return order.groupBy(
        F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).cast("int").alias("measure_id"),
        F.year("o_orderdate").alias("year"),
    ).agg(
        F.round(
            100.0 * F.count(F.when(F.col("o_orderstatus") != "F", 1)) / F.count("*") - 16, 2
        ).alias("percentage")
    )


def name_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-part names for matching: ``<adjective> <type>`` and ``<noun>-<brand>``."""
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        "p_size",
        "p_retailprice",
        "p_brand",
        F.concat_ws(" ", F.split_part("p_name", F.lit(" "), F.lit(1)), "p_type").alias("first_part"),
        F.concat_ws(
            "-", F.split_part("p_name", F.lit(" "), F.lit(2)), F.replace("p_brand", F.lit("#"), F.lit(""))
        ).alias("last_part"),
    )


def match_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as a member; those of the first brand are already linked."""
    return name_parts(spark, sf_dir).select(
        member_id("p_partkey").alias("cin"),
        F.when(F.col("p_brand") == "Brand#1", F.concat(F.lit("E"), "p_partkey")).alias("epic_pat_id"),
        F.date_add(F.lit(dt.date(1990, 1, 1)), F.col("p_size").cast("int")).alias("dob"),
        F.col("first_part").alias("first_name"),
        F.col("last_part").alias("last_name"),
    )


def match_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as a patient, with the parts of its name flipped or a letter dropped."""
    flipped = F.col("p_brand") < "Brand#2"
    first = F.replace("first_part", F.lit("e"), F.lit(""))
    return (
        name_parts(spark, sf_dir)
        .select(
            F.concat(F.lit("E"), "p_partkey").alias("pat_id"),
            F.when(flipped, F.col("last_part")).otherwise(first).alias("pat_first_name"),
            F.when(flipped, F.col("first_part"))
            .otherwise(F.replace("last_part", F.lit("-"), F.lit(" ")))
            .alias("pat_last_name"),
            F.date_add(F.lit(dt.date(1990, 1, 1)), F.col("p_size").cast("int")).alias("birth_date"),
            F.col("p_retailprice").alias("update_date"),
            F.col("p_partkey").alias("rec_create_date"),
        )
        .withColumn("pat_name", F.concat_ws(",", "pat_last_name", "pat_first_name"))
    )


def _letters(first: int, size: int, salt: str = "") -> Column:
    """Letters that a part's key stands for; different keys give unlike texts."""
    code = F.md5(F.concat(F.col("p_partkey").cast("string"), F.lit(salt)))
    return F.substring(F.translate(code, "0123456789abcdef", "aeioulnrstbdmkpv"), first, size)


def block_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as a member, born on one of two days."""
    return table(spark, sf_dir, "part").select(
        member_id("p_partkey").alias("cin"),
        F.lit(None).cast("string").alias("epic_pat_id"),
        F.when(F.col("p_brand") < "Brand#2", F.lit(dt.date(1990, 1, 1))).otherwise(F.lit(dt.date(1990, 1, 2))).alias("dob"),
        _letters(1, 7).alias("first_name"),
        _letters(8, 9).alias("last_name"),
    )


def block_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as a patient: a letter short, flipped, with further names, two letters more, another person, two letters changed."""
    kind, first, last = F.col("p_type"), _letters(1, 7), _letters(8, 9)

    def by_kind(short: Column, flipped: Column, further: Column, more: Column, other: Column, changed: Column) -> Column:
        cases = zip(("ECONOMY", "SMALL", "MEDIUM", "PROMO", "STANDARD"), (short, flipped, further, more, other), strict=True)
        return F.coalesce(*[F.when(kind == name, value) for name, value in cases], changed)

    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("E"), "p_partkey").alias("pat_id"),
        F.concat(F.lit("n"), "p_partkey").alias("pat_name"),
        by_kind(first, last, F.concat(first, F.lit(" "), "p_name"), F.concat(F.lit("x"), first), _letters(1, 7, "o"), first).alias("pat_first_name"),
        by_kind(
            F.substring(last, 2, 8), first, F.concat(last, F.lit(" "), "p_name"), F.concat(last, F.lit("x")), _letters(8, 9, "o"),
            F.concat(F.substring(last, 1, 3), F.lit("yy"), F.substring(last, 6, 4))).alias("pat_last_name"),
        F.when(F.col("p_brand") < "Brand#2", F.lit(dt.date(1990, 1, 1))).otherwise(F.lit(dt.date(1990, 1, 2))).alias("birth_date"),
        F.col("p_retailprice").alias("update_date"),
        F.col("p_partkey").alias("rec_create_date"),
    )


def linked_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as a member linked to an external id."""
    return table(spark, sf_dir, "customer").select(
        member_id("c_custkey").alias("cin"), F.concat(F.lit("E"), "c_custkey").alias("epic_pat_id")
    )


def merge_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overdrawn customers merged into the first customer of their nation and segment."""
    customer = table(spark, sf_dir, "customer")
    first = customer.groupBy("c_nationkey", "c_mktsegment").agg(F.min("c_custkey").alias("first_key"))
    return (
        customer.where(F.col("c_acctbal") < 0)
        .join(first, ["c_nationkey", "c_mktsegment"])
        .select(
            F.concat(F.lit("E"), "first_key").alias("pat_id"),
            F.concat(F.lit("E"), "c_custkey").alias("patient_mrg_hist"),
        )
    )


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw phone, address and flag texts of every customer."""
    customer = table(spark, sf_dir, "customer").alias("c")
    nation = table(spark, sf_dir, "nation").alias("n")
    digits = F.concat(F.lit("7"), F.right("c_name", F.lit(9)))
    segment = F.col("c_mktsegment")

    def cut(start: int, size: int) -> Column:
        return F.substring(digits, start, size)

    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        member_id("c_custkey").alias("cin"),
        "c_acctbal",
        "c_name",
        "c_mktsegment",
        "n_name",
        F.when(segment == "BUILDING", F.concat(F.lit("("), cut(1, 3), F.lit(") "), cut(4, 3), F.lit("-"), cut(7, 4)))
        .when(segment == "MACHINERY", F.concat(cut(4, 3), F.lit("-"), cut(7, 4)))
        .when(segment == "AUTOMOBILE", digits)
        .when(segment == "FURNITURE", F.concat(segment, F.lit("X")))
        .alias("phone_raw"),
        F.when(segment == "HOUSEHOLD", "-$")
        .when(segment != "FURNITURE", F.concat(F.lit(" "), F.col("c_name"), F.lit(" O'Hara St")))
        .alias("line1"),
        F.when(segment == "BUILDING", "-").when(segment == "MACHINERY", " Apt 4 ").alias("line2"),
        F.when(segment != "AUTOMOBILE", F.col("n_name")).alias("city"),
        F.when(F.col("c_acctbal") >= 0, "CA").alias("state"),
        F.right("c_name", F.lit(5)).alias("zip_code"),
        F.when(segment == "BUILDING", "F").when(segment == "MACHINERY", "M").when(
            segment == "FURNITURE", "U"
        ).alias("sex_code"),
        F.when(F.col("c_acctbal") < 0, "*").when(F.col("c_acctbal") > 5000, "Y").alias("mark"),
    )


_DIGITS = "'7' || right(c_name, 9)"
_MEASURE_ID = "CAST(split_part(o_orderpriority, '-', 1) AS INTEGER)"


def _roster_sql(year: int, month: int) -> str:
    start = dt.date(year, month, 1)
    end = dt.date(year + month // 12, month % 12 + 1, 1)
    return f"""
      SELECT s.*, c.* EXCLUDE (cin), 1 AS is_enrolled
      FROM (SELECT to_base(o_custkey, 36, 10) AS cin,
                   max(CAST(o_orderdate AS DATE)) AS download_date,
                   max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS new_member,
                   CAST(max(o_orderkey) AS VARCHAR) AS record_number
            FROM orders
            WHERE o_orderdate >= DATE '{start}' AND o_orderdate < DATE '{end}'
            GROUP BY o_custkey) s
      JOIN customers c USING (cin)"""


def _membership_sql(year: int, month: int, finished: bool = False) -> str:
    start = dt.date(year, month, 1)
    before = dt.date(year - (month == 1), (month - 2) % 12 + 1, 1)
    having = "HAVING bool_or(o_orderstatus = 'F')" if finished else ""
    return f"""
      SELECT s.*, c.* EXCLUDE (cin), 0 AS new_member,
             CAST({month - 1} - months_enrolled AS INTEGER) AS months_missed, 1 AS is_qip_eligible
      FROM (SELECT to_base(o_custkey, 36, 10) AS cin,
                   CAST(count(DISTINCT CASE WHEN year(o_orderdate) = {year}
                                            THEN month(o_orderdate) END) AS INTEGER) AS months_enrolled,
                   max(CASE WHEN o_orderdate >= DATE '{before}' THEN 1 ELSE 0 END) AS is_enrolled,
                   min(CAST(o_orderdate AS DATE)) AS date_new_member,
                   max(CAST(o_orderdate AS DATE)) AS download_date,
                   CAST(max(o_orderkey) AS VARCHAR) AS record_number
            FROM orders
            WHERE o_orderdate < DATE '{start}'
            GROUP BY o_custkey {having}) s
      JOIN customers c USING (cin)"""


_NAMES_SQL = """
      SELECT p_partkey, p_size, p_retailprice, p_brand,
             split_part(p_name, ' ', 1) || ' ' || p_type AS first_part,
             split_part(p_name, ' ', 2) || '-' || replace(p_brand, '#', '') AS last_part
      FROM part"""

# Role name -> query; a role may use the roles above it.
SQL = {
    "customers": """
      SELECT to_base(c_custkey, 36, 10) AS cin, CAST(c_nationkey AS INTEGER) AS clinic_id,
             c_mktsegment AS first_name, c_name AS last_name,
             DATE '1960-01-01' + CAST(floor(c_acctbal) AS INTEGER) AS dob
      FROM customer""",
    "clinics": """
      SELECT CAST(n_nationkey AS INTEGER) AS id, CAST(n_nationkey + 100 AS INTEGER) AS phc_id,
             n_name AS clinic_key, 'Clinic ' || n_name AS clinic, r_name AS county,
             CASE WHEN r_name <> 'AFRICA' THEN 1 ELSE 0 END AS is_active
      FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "measures_map": f"""
      SELECT DISTINCT {_MEASURE_ID} AS id, split_part(o_orderpriority, '-', 2) AS measure,
             CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN 1 ELSE 0 END AS is_active
      FROM orders""",
    "incoming": _roster_sql(YEAR, MONTH),
    "january": _roster_sql(YEAR, 1),
    "base": _membership_sql(YEAR, MONTH),
    "base_january": _membership_sql(YEAR, 1),
    "finished_members": _membership_sql(YEAR, MONTH + 1, finished=True),
    "history": """
      SELECT to_base(o_custkey, 36, 10) AS cin, CAST(c_nationkey AS INTEGER) AS clinic_id,
             CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
             1 AS is_qip_eligible, max(CAST(o_orderdate AS DATE)) AS download_date
      FROM orders JOIN customer ON o_custkey = c_custkey
      GROUP BY ALL HAVING bool_or(o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT')""",
    "measure_rows": f"""
      SELECT o_custkey, CAST(c_nationkey AS INTEGER) AS clinic_id, {_MEASURE_ID} AS measure_id,
             CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
             CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS is_compliant,
             CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END AS is_qip_eligible,
             CAST(l_shipdate AS DATE) AS download_date
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
    "upload": f"""
      SELECT c.*, m.measure_id, m.is_compliant, {YEAR} AS year, {MONTH} AS month,
             DATE '{AS_OF}' AS download_date, 0 AS new_member
      FROM measure_rows m JOIN customers c ON c.cin = to_base(m.o_custkey, 36, 10)""",
    "goals": f"""
      SELECT {_MEASURE_ID} AS measure_id, CAST(year(o_orderdate) AS INTEGER) AS year,
             round(100.0 * count(*) FILTER (o_orderstatus <> 'F') / count(*) - 16, 2) AS percentage
      FROM orders GROUP BY ALL""",
    "names": _NAMES_SQL,
    "members": """
      SELECT to_base(p_partkey, 36, 10) AS cin,
             CASE WHEN p_brand = 'Brand#1' THEN 'E' || p_partkey END AS epic_pat_id,
             DATE '1990-01-01' + CAST(p_size AS INTEGER) AS dob,
             first_part AS first_name, last_part AS last_name
      FROM names""",
    "patients": """
      SELECT *, pat_last_name || ',' || pat_first_name AS pat_name
      FROM (SELECT 'E' || p_partkey AS pat_id,
                   CASE WHEN p_brand < 'Brand#2' THEN last_part
                        ELSE replace(first_part, 'e', '') END AS pat_first_name,
                   CASE WHEN p_brand < 'Brand#2' THEN first_part
                        ELSE replace(last_part, '-', ' ') END AS pat_last_name,
                   DATE '1990-01-01' + CAST(p_size AS INTEGER) AS birth_date,
                   p_retailprice AS update_date, p_partkey AS rec_create_date
            FROM names)""",
    "linked": "SELECT to_base(c_custkey, 36, 10) AS cin, 'E' || c_custkey AS epic_pat_id FROM customer",
    "merges": """
      SELECT 'E' || min(b.c_custkey) AS pat_id, 'E' || a.c_custkey AS patient_mrg_hist
      FROM customer a JOIN customer b ON a.c_nationkey = b.c_nationkey AND a.c_mktsegment = b.c_mktsegment
      WHERE a.c_acctbal < 0
      GROUP BY a.c_custkey""",
    "contacts": f"""
      SELECT to_base(c_custkey, 36, 10) AS cin, c_acctbal, c_name, c_mktsegment, n_name,
             CASE c_mktsegment
               WHEN 'BUILDING' THEN '(' || substr({_DIGITS}, 1, 3) || ') ' || substr({_DIGITS}, 4, 3)
                                    || '-' || substr({_DIGITS}, 7, 4)
               WHEN 'MACHINERY' THEN substr({_DIGITS}, 4, 3) || '-' || substr({_DIGITS}, 7, 4)
               WHEN 'AUTOMOBILE' THEN {_DIGITS}
               WHEN 'FURNITURE' THEN 'FURNITUREX' END AS phone_raw,
             CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '-$'
                  WHEN c_mktsegment <> 'FURNITURE' THEN ' ' || c_name || ' O''Hara St' END AS line1,
             CASE c_mktsegment WHEN 'BUILDING' THEN '-' WHEN 'MACHINERY' THEN ' Apt 4 ' END AS line2,
             CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN n_name END AS city,
             CASE WHEN c_acctbal >= 0 THEN 'CA' END AS state,
             right(c_name, 5) AS zip_code,
             CASE c_mktsegment WHEN 'BUILDING' THEN 'F' WHEN 'MACHINERY' THEN 'M'
                               WHEN 'FURNITURE' THEN 'U' END AS sex_code,
             CASE WHEN c_acctbal < 0 THEN '*' WHEN c_acctbal > 5000 THEN 'Y' END AS mark
      FROM customer JOIN nation ON c_nationkey = n_nationkey""",
}

_BLOCK_NAMES = """
      SELECT p_partkey, p_name, p_type, p_retailprice,
             CASE WHEN p_brand < 'Brand#2' THEN DATE '1990-01-01' ELSE DATE '1990-01-02' END AS day,
             translate(md5(CAST(p_partkey AS VARCHAR)), '0123456789abcdef', 'aeioulnrstbdmkpv') AS w,
             translate(md5(p_partkey || 'o'), '0123456789abcdef', 'aeioulnrstbdmkpv') AS o
      FROM part"""

SQL["block_members"] = f"""
      SELECT to_base(p_partkey, 36, 10) AS cin, CAST(NULL AS VARCHAR) AS epic_pat_id, day AS dob,
             substr(w, 1, 7) AS first_name, substr(w, 8, 9) AS last_name FROM ({_BLOCK_NAMES})"""
SQL["block_patients"] = f"""
      SELECT 'E' || p_partkey AS pat_id, 'n' || p_partkey AS pat_name, day AS birth_date,
             CASE p_type WHEN 'SMALL' THEN substr(w, 8, 9) WHEN 'MEDIUM' THEN substr(w, 1, 7) || ' ' || p_name
                         WHEN 'PROMO' THEN 'x' || substr(w, 1, 7) WHEN 'STANDARD' THEN substr(o, 1, 7)
                         ELSE substr(w, 1, 7) END AS pat_first_name,
             CASE p_type WHEN 'ECONOMY' THEN substr(w, 9, 8) WHEN 'SMALL' THEN substr(w, 1, 7)
                         WHEN 'MEDIUM' THEN substr(w, 8, 9) || ' ' || p_name WHEN 'PROMO' THEN substr(w, 8, 9) || 'x'
                         WHEN 'STANDARD' THEN substr(o, 8, 9)
                         ELSE substr(w, 8, 3) || 'yy' || substr(w, 13, 4) END AS pat_last_name,
             p_retailprice AS update_date, p_partkey AS rec_create_date
      FROM ({_BLOCK_NAMES})"""

_USES = {
    "incoming": ["customers"], "january": ["customers"], "base": ["customers"],
    "base_january": ["customers"], "finished_members": ["customers"],
    "upload": ["customers", "measure_rows"], "members": ["names"], "patients": ["names"],
}


def with_roles(query: str, *roles: str) -> str:
    """A query preceded by the roles that it names and those they need."""
    wanted = {r for role in roles for r in [role, *_USES.get(role, [])]}
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in SQL.items() if name in wanted)
    return f"WITH {ctes}\n{query}" if ctes else query
