"""Scan, sink, job and stream queries."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import StreamingQueryException
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelspark.catalog import roles
from panelspark.catalog.membership import _MERGED
from panelspark.catalog.registry import register
from panelspark.catalog.roles import AS_OF, MONTH, YEAR
from panelspark.functions import text as X
from panelspark.operators.checks import CheckFailed
from panelspark.operators.latest import first_per_group
from panelspark.plans.audit import audit_row
from panelspark.plans.measures_file import MeasureTables, check_measures, mapped_measures, run_measures_file
from panelspark.plans.roster_files import run_roster_files
from panelspark.plans.roster_month import RosterTables, mapped_roster, month_columns, processed_rows, run_roster_month, scanned_rows
from panelspark.schemas import MEMBERSHIP_LOG, PROCESSED_FIELDS, SHEET_TO_MEASURES
from panelspark.session import shared_folder
from panelspark.sources import tables
from panelspark.sources.delimited import read_processed, staged_roster, write_roster
from panelspark.sources.files import file_batches, file_list, oldest_and_newest, rows_by_file, with_provenance
from panelspark.sources.html import html_rows
from panelspark.sources.sheets import read_sheets, scan_sheets, sheet_rows, staged_measures
from panelspark.streaming.backlog import run_backlog, upload_backlog

# Rows per file; files hold a range of keys, so that their number grows with the table.
_FILE_ROWS = 50_000


@register(
    "html_rows",
    r"""
    SELECT page_id, CAST(pos - 1 AS INTEGER) AS row_pos, cell FROM (
      SELECT page_id, unnest(items) AS item, unnest(range(1, len(items) + 1)) AS pos
      FROM (SELECT page_id, regexp_extract_all(html, '(?is)<li(?:\s[^>]*)?>(.*?)</li\s*>', 1) AS items FROM pages)),
      LATERAL (SELECT unnest(regexp_extract_all(item, '(?is)<a(?:\s[^>]*)?>(.*?)</a\s*>', 1)) AS raw) r,
      LATERAL (SELECT trim(replace(replace(replace(replace(regexp_replace(raw, '<[^>]*>', '', 'g'),
               '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&')) AS cell) c""",
)
def list_rows(spark, sf_dir):
    pages = roles.table(spark, sf_dir, "pages")
    return html_rows(pages, "html", ["page_id"], "li", "a").select(
        "page_id", "row_pos", F.explode("cells").alias("cell")
    )


def _roster_pages(spark, sf_dir):
    """Every customer as a row of a roster page of its nation, for the month of the role."""
    c = roles.contacts(spark, sf_dir).join(
        roles.clinics(spark, sf_dir).select("phc_id", F.col("clinic_key").alias("n_name")), "n_name"
    )
    cells = [
        F.col("cin"), F.col("c_mktsegment"), F.concat(F.lit("O'"), "c_name"), F.lit("02/28/1990"),
        F.col("sex_code"), F.lit(""), F.lit("A"), F.lit("01/01/2001"), F.lit(""), F.lit("N/A"),
        F.col("mark"), F.col("line1"), F.col("line2"), F.col("city"), F.col("state"),
        F.col("zip_code"), F.col("phone_raw"),
    ]
    row = F.concat(
        F.lit("<tr><td>"),
        F.concat_ws("</td><td>", *[F.coalesce(F.replace(x, F.lit("'"), F.lit("&#39;")), F.lit("")) for x in cells]),
        F.lit("</td></tr>"),
    )
    header = "".join(
        f"<th>{name}</th>"
        for name in [
            "BIC#/HIK#", "First Name", "Last Name", "Birth", "Sex", "Record#", "RP", "Eff Date",
            "End Date", "Other Insurnace", "New Member", "Residential Address1",
            "Residential Address2", "Residential City", "Residential State", "Residential Zip",
            "Residential Phone#",
        ]
    )
    block = F.floor(F.conv("cin", 36, 10).cast("bigint") / _FILE_ROWS).alias("block")
    return c.groupBy("phc_id", block).agg(F.collect_list(row).alias("rows")).select(
        F.concat(
            F.lit("<html><body><table>\n<tr>" + header + "</tr>\n"),
            F.array_join("rows", "\n"),
            F.lit("\n</table></body></html>"),
        ).alias("html"),
        F.concat(F.lit("in/Plan-"), "phc_id", F.lit("_1_July-2001.xls")).alias("path"),
        F.lit(AS_OF).alias("download_date"),
    )




_ROSTER_PAGES = r"""
    SELECT cin AS "BIC_HIK", n_name AS "Clinic", 'O''''' || c_name AS "LastName",
           CASE sex_code WHEN 'F' THEN 'Female' WHEN 'M' THEN 'Male' ELSE sex_code END AS "Sex",
           '1990-02-28' AS "DOB", CASE WHEN mark = '*' THEN 'TRUE' ELSE 'FALSE' END AS "NewMember",
           regexp_replace(CASE WHEN length(p) IN (7, 10) THEN p ELSE '' END, '^([0-9]{3})([0-9]{3})?([0-9]{4})$',
                          CASE WHEN length(p) = 10 THEN '\1-\2-\3' ELSE '\1-\3' END) AS "PhoneNumber",
           replace(CASE WHEN line1 = '-$' THEN '' ELSE trim(line1) END
                   || CASE WHEN line2 IS NULL OR line2 = '-' THEN '' ELSE trim(line2) END, '''', '''''') AS "Address",
           CAST(NULL AS VARCHAR) AS "OtherInsurance", 1 AS "SpecialMemberFlag",
           printf('%s_%02d-%d', n_name, 7, 2001) AS period
    FROM (SELECT *, regexp_replace(coalesce(phone_raw, 'nan'), '\W+', '', 'g') AS p FROM contacts)"""


@register("roster_pages", _ROSTER_PAGES, ("contacts",))
def roster_pages(spark, sf_dir):
    every = roles.clinics(spark, sf_dir).withColumn("is_active", F.lit(1))
    return processed_rows(_roster_pages(spark, sf_dir), every).select(
        "BIC_HIK", "Clinic", "LastName", "Sex", "DOB", "NewMember", "PhoneNumber", "Address",
        "OtherInsurance", "SpecialMemberFlag", "period",
    )


def _page_files(spark, sf_dir):
    """The same pages as files, dated as the role; their folder."""
    pages, folder = _roster_pages(spark, sf_dir), shared_folder(spark, "pages")
    number = F.row_number().over(Window.partitionBy("path").orderBy("html")).cast("string")
    named = pages.select("html", F.replace(F.split_part("path", F.lit("/"), F.lit(2)), F.lit("_1_"), F.concat(F.lit("_"), number, F.lit("_"))).alias("file"))
    named.repartition("file").write.partitionBy("file").text(f"{folder}/written")
    for row in file_list(spark, f"{folder}/written", ".txt", recursive=True).select("path").collect():  # as many as sites and blocks
        source, fs = tables.file_system(spark, row.path)
        fs.rename(source, tables.file_system(spark, f"{folder}/{source.getParent().getName().split('=', 1)[1]}")[0])
        _date_file(spark, f"{folder}/{source.getParent().getName().split('=', 1)[1]}", AS_OF)
    return folder


@register("roster_pages_split", _ROSTER_PAGES, ("contacts",))
def roster_pages_split(spark, sf_dir):
    """The pages as files that the reader cuts at row ends."""
    every = roles.clinics(spark, sf_dir).withColumn("is_active", F.lit(1))
    return scanned_rows(spark, _page_files(spark, sf_dir), every).select(
        "BIC_HIK", "Clinic", "LastName", "Sex", "DOB", "NewMember", "PhoneNumber", "Address",
        "OtherInsurance", "SpecialMemberFlag", "period",
    )


@register(
    "roster_pipeline_job",
    f"""
    SELECT {YEAR} AS year, {MONTH} AS month, count(b.cin) AS update_count, count(*) - count(b.cin) AS insert_count,
           count(*) AS enrolled_count, count(*) FILTER (coalesce(b.months_enrolled, 0) + 1 >= {MONTH - 3}) AS qip_eligible_count,
           CAST(NULL AS VARCHAR) AS failure_step, 1 AS is_success, count(*) AS history_rows, CAST(NULL AS VARCHAR) AS stopped_by
    FROM customers c LEFT JOIN base b ON b.cin = c.cin
    UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, 'Missing clinic files: SiteZ', 0, 0, 'check'""",
    ("customers", "base"),
)
def roster_pipeline_job(spark, sf_dir):
    """Raw pages of every customer to a published month; a first try is stopped by a clinic without pages."""
    folder, pages = _seeded(spark, sf_dir, MONTH), _page_files(spark, sf_dir)
    # Names of which none is part of another.
    clinics = roles.clinics(spark, sf_dir).withColumns({"is_active": F.lit(1), "clinic_key": F.concat(F.lit("Site"), F.chr(F.col("id") + 65))})
    present = roles.table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("id")).distinct()
    clinics = clinics.join(present, "id", "left_semi")
    lacking = clinics.unionByName(clinics.limit(1).withColumns({"id": F.lit(99), "phc_id": F.lit(999), "clinic_key": F.lit("SiteZ")}))
    stored = RosterTables(*(f"{folder}/{n}" for n in ("membership", "history", "log", "reports")))
    run_at, stopped = dt.datetime.combine(AS_OF, dt.time(8)), None
    try:
        run_roster_files(spark, pages, f"{folder}/processed", lacking, stored, run_at)
    except CheckFailed:
        stopped = "check"
    run_roster_files(spark, pages, f"{folder}/processed", clinics, stored, run_at)
    of_month = (F.col("year") == YEAR) & (F.col("month") == MONTH)
    recorded = spark.read.parquet(stored.history).where(of_month).count()
    good = F.col("is_success") == 1
    return spark.read.parquet(stored.log).drop("logged_at").withColumns(
        {"history_rows": F.when(good, recorded).otherwise(0).cast("long"), "stopped_by": F.when(~good, F.lit(stopped))})


@register(
    "roster_dedupe_union",
    """
    SELECT cin, clinic_id, origin FROM (
      SELECT to_base(o_custkey, 36, 10) AS cin, CAST(NULL AS INTEGER) AS clinic_id, 'orders' AS origin FROM orders
      UNION SELECT cin, clinic_id, 'customers' FROM customers)""",
    ("customers",),
)
def roster_dedupe_union(spark, sf_dir):
    seen = roles.orders(spark, sf_dir).select("cin", F.lit("orders").alias("origin"))
    listed = roles.customers(spark, sf_dir).select("cin", "clinic_id", F.lit("customers").alias("origin"))
    return seen.unionByName(listed, allowMissingColumns=True).dropDuplicates().select("cin", "clinic_id", "origin")


@register(
    "file_batches",
    """
    SELECT n_name AS site, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
           count(*) AS file_count, printf('%s_%02d-%d', n_name, month(o_orderdate), year(o_orderdate)) AS batch
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""",
)
def batches(spark, sf_dir):
    customer, nation = roles.table(spark, sf_dir, "customer"), roles.table(spark, sf_dir, "nation")
    order = roles.table(spark, sf_dir, "orders")
    files = (
        order.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("n_name").alias("site"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    )
    return file_batches(files, "site", "year", "month")


@register(
    "file_accounting",
    """
    WITH site_rows AS (
      SELECT c_nationkey AS site, count(*) AS row_count, CAST(max(o_orderdate) AS DATE) AS day
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
    SELECT site, row_count, CAST(day AS VARCHAR) AS download_date, CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month,
           row_count AS rows_in_file, 1 AS is_listed,
           CASE WHEN row_number() OVER (ORDER BY day, 'site=' || site || '/') = 1 THEN 1 ELSE 0 END AS is_oldest,
           CASE WHEN row_number() OVER (ORDER BY day DESC, 'site=' || site || '/' DESC) = 1 THEN 1 ELSE 0 END AS is_newest,
           (SELECT count(*) FROM site_rows) AS file_count
    FROM site_rows""",
)
def file_accounting(spark, sf_dir):
    """Orders written to a file per site, dated by its last order, and accounted for file by file."""
    customer = roles.table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("site"))
    rows = roles.table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "site", "o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    expected = rows.groupBy("site").agg(F.count("*").alias("row_count"), F.max("day").alias("day"))
    folder = shared_folder(spark, "site-files")
    rows.repartition("site").write.partitionBy("site").option("header", True).csv(folder)
    listed = file_list(spark, folder, ".csv", recursive=True).drop("site")
    site = F.regexp_extract("path", "site=([0-9]+)/", 1).cast("int")
    days = {r.site: r.day for r in expected.select("site", "day").collect()}  # as many as there are files
    for row in listed.select("path", site.alias("site")).collect():
        _date_file(spark, row.path, days[row.site])
    listed = file_list(spark, folder, ".csv", recursive=True).drop("site")
    ends = oldest_and_newest(listed).first()
    scan = with_provenance(spark.read.option("recursiveFileLookup", "true").option("header", True).csv(folder).select("*", "_metadata"))
    dates = scan.select(F.col("_metadata.file_path").alias("path"), "download_date", "year", "month").distinct()
    found = rows_by_file(scan).join(dates, "path").select(
        site.alias("site"), F.col("row_count").alias("rows_in_file"), "download_date", "year", "month",
        (site == _site_of(ends.oldest)).cast("int").alias("is_oldest"),
        (site == _site_of(ends.newest)).cast("int").alias("is_newest"),
        F.lit(ends.file_count).cast("long").alias("file_count"))
    in_list = listed.select(site.alias("site"), F.lit(1).alias("is_listed"))
    return found.join(in_list, "site").join(expected.select("site", "row_count"), "site")


def _date_file(spark, path, day, minute=0):
    path, fs = tables.file_system(spark, path)
    fs.setTimes(path, int(dt.datetime.combine(day, dt.time(12, minute), dt.UTC).timestamp() * 1000), -1)


def _site_of(path):
    return int(path.split("site=", 1)[1].split("/", 1)[0])


@register(
    "month_columns",
    """
    WITH listed AS (
      SELECT to_base(o_custkey, 36, 10) AS member, month(o_orderdate) AS m,
             n_name || CASE r_name WHEN 'AFRICA' THEN ' CCS' WHEN 'ASIA' THEN ' Capitated' ELSE '' END AS site
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
      WHERE year(o_orderdate) = 2000)
    SELECT member AS "BIC_HIK", site AS "Clinic",
    """
    + ", ".join(
        f"max(CASE WHEN m = {i} THEN 1 ELSE 0 END) AS \"{name}\""
        for i, name in enumerate(["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"], 1)
    )
    + """, CASE WHEN site LIKE '%CCS%' OR site LIKE '%Capitated%' THEN 0 ELSE 1 END AS "SpecialMemberFlag"
    FROM listed GROUP BY member, site""",
)
def month_columns_of_year(spark, sf_dir):
    """The rosters of a year side by side, special sites among them."""
    customer, clinics = roles.table(spark, sf_dir, "customer"), roles.clinics(spark, sf_dir)
    kind = F.when(F.col("county") == "AFRICA", " CCS").when(F.col("county") == "ASIA", " Capitated").otherwise("")
    site = F.concat("clinic_key", kind)
    seen = roles.orders(spark, sf_dir, dt.date(2000, 1, 1), dt.date(2001, 1, 1)).withColumn("file_month", F.month("day"))
    members = customer.join(clinics, F.col("c_nationkey") == F.col("id")).select(
        roles.member_id("c_custkey").alias("cin"), site.alias("Clinic"))
    rows = seen.join(members, "cin").select(
        F.col("cin").alias("BIC_HIK"), "Clinic", "file_month", F.lit(1).alias("Month"), X.special_member(F.col("Clinic")).alias("SpecialMemberFlag"))
    return month_columns(rows, "file_month")


def _processed(spark, sf_dir):
    c = roles.contacts(spark, sf_dir)
    line1, line2 = F.col("line1"), F.col("line2")
    values = {
        "BIC_HIK": F.col("cin"), "Clinic": F.col("n_name"), "LastName": F.col("c_name"),
        "FirstName": F.nullif("c_mktsegment", F.lit("HOUSEHOLD")), "DOB": F.lit("1990-02-28"),
        "Sex": X.sex_sheet(F.col("sex_code")), "PhoneNumber": X.phone(F.col("phone_raw")),
        "Address": X.address(line1, line2), "City": F.col("city"), "State": F.col("state"),
        "ZipCode": F.col("zip_code"), "NewMember": X.flag_text(F.col("mark"), "*"),
        "PHPCurrentFlag": F.lit("1"), "LastUpdated": F.lit(str(AS_OF)),
    }
    return c.select(
        *[values.get(name, F.lit(None).cast("string")).alias(name) for name in PROCESSED_FIELDS],
        F.concat("n_name", F.lit("_07-2001")).alias("period"),
    )


@register(
    "delimited_round_trip",
    rf"""
    SELECT cin, coalesce(CAST(c.hit AS VARCHAR), n_name) AS clinic_label, c_name AS last_name,
           coalesce(NULLIF(c_mktsegment, 'HOUSEHOLD'), '') AS first_name, zip_code, city,
           CASE WHEN mark = '*' THEN 1 ELSE 0 END AS new_member, '{AS_OF}' AS download_date, 1 AS is_enrolled,
           NULLIF(replace(trim((CASE WHEN line1 = '-$' THEN '' ELSE line1 END)
                        || (CASE WHEN line2 IS NULL OR line2 = '-' THEN '' ELSE line2 END)), '''', ''''''), '') AS address
    FROM contacts LEFT JOIN (SELECT n.n_name AS site, min(id) AS hit FROM nation n JOIN clinics
                             ON is_active = 1 AND contains(n.n_name, clinic_key) GROUP BY ALL) c ON site = n_name""",
    ("contacts", "clinics"),
)
def delimited_round_trip(spark, sf_dir):
    folder = shared_folder(spark, "processed")
    write_roster(_processed(spark, sf_dir), folder)
    mapped = mapped_roster(staged_roster(read_processed(spark, folder)), roles.clinics(spark, sf_dir))
    return mapped.select(
        "cin",
        F.coalesce(F.col("clinic_id").cast("string"), "clinic_text").alias("clinic_label"),
        "last_name", "first_name", "zip_code", "city", "new_member", "download_date", "is_enrolled", "address",
    )


def _write_sheets(spark, sf_dir, of="county"):
    """Every customer as a row of a measures sheet of its region, or of several, one file per sheet."""
    c = (
        roles.contacts(spark, sf_dir)
        .join(roles.clinics(spark, sf_dir).select("phc_id", "county", F.col("clinic_key").alias("n_name")), "n_name")
        .select(
            F.concat_ws(
                "-", of, F.floor(F.conv("cin", 36, 10).cast("bigint") / _FILE_ROWS).cast("string")
            ).alias("sheet"),
            F.concat_ws(
                ",", "cin", F.concat(F.lit("Site "), "phc_id"), "c_mktsegment", "c_name", F.lit("02/28/1990"),
                F.lit("11"), F.coalesce("sex_code", F.lit("")), F.coalesce("mark", F.lit("")),
                F.coalesce("phone_raw", F.lit("")), F.lit("URGENT 2001"),
                F.when(F.col("c_acctbal") > 0, "Numerator").otherwise("Denominator"),
            ).alias("line"),
        )
    )
    top = F.array(F.struct(F.lit(0).alias("place"), F.lit("Member report").alias("line")),
                  F.struct(F.lit(1).alias("place"), F.lit(",".join(SHEET_TO_MEASURES)).alias("line")))
    head = c.select("sheet").distinct().select("sheet", F.inline(top))
    folder = shared_folder(spark, "sheets")
    (
        head.unionByName(c.select("sheet", F.lit(2).alias("place"), "line"))
        .repartition("sheet")
        .sortWithinPartitions("sheet", "place")
        .select("sheet", "line")
        .write.partitionBy("sheet")
        .text(folder)
    )
    return folder


_SHEET_ROWS = r"""
    SELECT cin, 'Site ' || (100 + n_nationkey) AS clinic_text, c_mktsegment AS first_name,
           CASE WHEN sex_code = 'F' THEN 'Female' ELSE 'Male' END AS sex,
           CASE WHEN mark = 'Y' THEN 1 ELSE 0 END AS new_member, '1990-02-28' AS dob,
           CASE WHEN phone_raw IS NULL THEN NULL
                WHEN length(phone_raw) = 10 THEN regexp_replace(phone_raw, '^([0-9]{3})([0-9]{3})([0-9]{4})$', '\1-\2-\3')
                END AS phone_number,
           CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS is_compliant, r_name AS county
    FROM contacts JOIN nation USING (n_name) JOIN region ON n_regionkey = r_regionkey"""


@register("sheet_scan_split", f"SELECT * EXCLUDE (county) FROM ({_SHEET_ROWS})", ("contacts",))
def sheet_scan_split(spark, sf_dir):
    """The same sheets read line by line."""
    rows = staged_measures(scan_sheets(spark, _write_sheets(spark, sf_dir)))
    return rows.select(
        "cin", "clinic_text", "first_name", "sex", "new_member", "dob", "phone_number", "is_compliant"
    )


@register("sheet_scan", f"SELECT * EXCLUDE (county) FROM ({_SHEET_ROWS})", ("contacts",))
def sheet_scan(spark, sf_dir):
    rows = staged_measures(sheet_rows(read_sheets(spark, _write_sheets(spark, sf_dir))))
    return rows.select(
        "cin", "clinic_text", "first_name", "sex", "new_member", "dob", "phone_number", "is_compliant"
    )


@register(
    "backlog_stream",
    f"""
    SELECT county, count(*) AS member_rows, CAST(sum(is_compliant) AS BIGINT) AS compliant
    FROM ({_SHEET_ROWS}) GROUP BY county""",
    ("contacts",),
)
def backlog_stream(spark, sf_dir):
    out = shared_folder(spark, "backlog-rows")

    def keep(batch, batch_id):
        batch.select("cin", "path", "is_compliant").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    run_backlog(spark, _write_sheets(spark, sf_dir), keep, shared_folder(spark, "backlog-checkpoint"))
    county = F.regexp_extract("path", r"sheet=([^-/]*)-", 1)
    return (
        spark.read.parquet(out)
        .groupBy(F.replace(county, F.lit("%20"), F.lit(" ")).alias("county"))
        .agg(F.count("*").alias("member_rows"), F.sum("is_compliant").alias("compliant"))
    )


@register(
    "backlog_job",
    f"""
    SELECT n_nationkey AS clinic_id, count(*) AS measure_rows, CAST(sum(is_compliant) AS BIGINT) AS numerator,
           count(*) AS history_rows, count(*) AS members,
           (SELECT count(DISTINCT c_custkey // {_FILE_ROWS} || left(r_name, 1)) FROM customer JOIN nation ON c_nationkey = n_nationkey
            JOIN region ON n_regionkey = r_regionkey) AS uploads
    FROM ({_SHEET_ROWS.replace("SELECT cin,", "SELECT CAST(n_nationkey AS INTEGER) AS n_nationkey, cin,", 1)}) GROUP BY n_nationkey""",
    ("contacts",),
)
def backlog_job(spark, sf_dir):
    """All waiting sheets of one minute, one of them uploaded twice: the stream dies behind its publication."""
    folder = _seeded(spark, sf_dir, MONTH + 1, finished=True)
    stored = MeasureTables(*(f"{folder}/{n}" for n in ("membership", "history", "measures", "summary", "log")))
    tables.append_history(roles.history(spark, sf_dir).withColumn("run", F.lit("seed")), stored.history, ("year", "month", "run"))
    clinics = roles.clinics(spark, sf_dir).withColumn("is_active", F.lit(1))
    sheets, checkpoint = _write_sheets(spark, sf_dir, F.left("county", F.lit(1))), shared_folder(spark, "backlog-checkpoint")
    for minute, row in enumerate(file_list(spark, sheets, ".txt", recursive=True).select("path").collect()):  # as many as sheets
        _date_file(spark, row.path, AS_OF, minute % 60)
    run_at, published = dt.datetime.combine(AS_OF, dt.time(9)), []

    def after(path, _):
        published.append(path)
        if len(published) == 1:
            raise InterruptedError("published, and not yet recorded by the stream")

    def upload():
        upload_backlog(spark, sheets, checkpoint, clinics, roles.measures_map(spark, sf_dir), stored, lambda: run_at, after, per_batch=500)

    try:
        upload()
    except StreamingQueryException:
        upload()
    measures = spark.read.parquet(stored.measures)
    by_clinic = measures.groupBy("clinic_id").agg(F.count("*").alias("measure_rows"), F.sum("is_compliant").cast("long").alias("numerator"))
    of_month = (F.col("year") == YEAR) & (F.col("month") == MONTH)
    recorded = spark.read.parquet(stored.history).where(of_month).groupBy("clinic_id").agg(F.count("*").alias("history_rows"))
    members = tables.read_version(spark, stored.membership).groupBy("clinic_id").agg(F.count("*").alias("members"))
    uploads = measures.select("run").distinct().count()
    return by_clinic.join(recorded, "clinic_id").join(members, "clinic_id").withColumn("uploads", F.lit(uploads).cast("long"))


@register(
    "report_sheet",
    """
    SELECT CAST(c_nationkey AS VARCHAR) AS clinic, to_base(c_custkey, 36, 10) AS cin, c_name AS patient
    FROM customer""",
)
def report_sheet(spark, sf_dir):
    folder = shared_folder(spark, "report")
    report = roles.customers(spark, sf_dir).select(
        F.col("clinic_id").alias("clinic"), "cin", F.col("last_name").alias("patient")
    )
    tables.write_report(report.orderBy("clinic", "cin"), folder)
    return spark.read.schema("clinic STRING, cin STRING, patient STRING").option("header", True).csv(folder)


@register(
    "history_partitions",
    f"""
    SELECT cin, clinic_id, is_qip_eligible, CAST(download_date AS VARCHAR) AS download_date
    FROM history WHERE year = {YEAR}""",
    ("history",),
)
def history_partitions(spark, sf_dir):
    folder = shared_folder(spark, "history")
    tables.append_history(roles.history(spark, sf_dir), folder)
    stored = spark.read.parquet(folder)
    return stored.where(F.col("year") == YEAR).select("cin", "clinic_id", "is_qip_eligible", "download_date")


def _seeded(spark, sf_dir, month, finished=False):
    """A published membership of the month and empty histories in a new folder."""
    folder = shared_folder(spark, "job")
    seed = roles.membership(spark, sf_dir, YEAR, month, finished)
    tables.write_version(seed, f"{folder}/membership", 1)
    tables.publish(spark, f"{folder}/membership", 1)
    return folder


@register(
    "roster_job",
    f"""
    SELECT {YEAR} AS year, {MONTH} AS month, count(*) FILTER (merge_action = 'update') AS update_count,
           count(*) FILTER (merge_action = 'insert') AS insert_count, CAST(sum(is_enrolled) AS BIGINT) AS enrolled_count,
           CAST(sum(is_qip_eligible) AS BIGINT) AS qip_eligible_count, CAST(NULL AS VARCHAR) AS failure_step, 1 AS is_success
    FROM ({_MERGED})""",
    ("base", "incoming"),
)
def roster_job(spark, sf_dir):
    folder = _seeded(spark, sf_dir, MONTH)
    incoming = roles.roster(spark, sf_dir, YEAR, MONTH).withColumn("clinic_text", F.col("clinic_id").cast("string"))
    present = incoming.select(F.col("clinic_id").alias("id")).distinct()
    clinics = roles.clinics(spark, sf_dir).withColumn("is_active", F.lit(1)).join(present, "id", "left_semi")
    stored = RosterTables(f"{folder}/membership", f"{folder}/history", f"{folder}/log", f"{folder}/reports")
    run_roster_month(spark, incoming, clinics, stored, YEAR, MONTH, dt.datetime.combine(AS_OF, dt.time(8)))
    return spark.read.parquet(stored.log).drop("logged_at")


def _staged_upload(spark, sf_dir, measures_map):
    return (
        roles.measures_upload(spark, sf_dir)
        .join(F.broadcast(measures_map.select(F.col("id").alias("measure_id"), "measure")), "measure_id")
        .withColumn("clinic_text", F.concat(F.lit("Site "), (F.col("clinic_id") + 100).cast("string")))
        .withColumn("measure_text", F.concat("measure", F.lit(" 2001")))
        .drop("measure", "measure_id", "clinic_id")
    )


@register(
    "measures_job",
    """
    SELECT measure_id, clinic_id, count(*) AS denominator, count(*) FILTER (is_compliant = 1) AS numerator
    FROM upload WHERE measure_id <> 4 GROUP BY ALL""",
    ("upload",),
)
def measures_job(spark, sf_dir):
    folder = _seeded(spark, sf_dir, MONTH + 1, finished=True)
    clinics = roles.clinics(spark, sf_dir).withColumn("is_active", F.lit(1))
    measures_map = roles.measures_map(spark, sf_dir)
    staged = _staged_upload(spark, sf_dir, measures_map)
    stored = MeasureTables(
        f"{folder}/membership", f"{folder}/history", f"{folder}/measures", f"{folder}/summary", f"{folder}/log"
    )
    run_measures_file(
        spark, staged, "upload.xls", clinics, measures_map, stored, AS_OF, dt.datetime.combine(AS_OF, dt.time(9))
    )
    return spark.read.parquet(stored.summary).select("measure_id", "clinic_id", "denominator", "numerator")


@register(
    "upload_warning",
    """
    SELECT 'Clinic - without rows: ' || (SELECT string_agg(CAST(900 + r_regionkey AS VARCHAR), ' & ' ORDER BY r_regionkey) FROM region)
           || chr(10) || CASE WHEN (SELECT count(DISTINCT measure_id) FROM upload WHERE measure_id <> 4) = 4 THEN 'Measure - without rows: 99' END AS warning""",
    ("upload",),
)
def upload_warning(spark, sf_dir):
    """What a sheet's log says of mapped clinics and measures that it has no row of."""
    clinics = roles.clinics(spark, sf_dir).withColumn("is_active", F.lit(1)).select("id", "phc_id", "clinic_key", "is_active")
    number = (F.col("r_regionkey") + 900).cast("int")
    further = roles.table(spark, sf_dir, "region").select(number.alias("id"), number.alias("phc_id"), F.col("r_name").alias("clinic_key"), F.lit(1).alias("is_active"))
    known = roles.measures_map(spark, sf_dir)
    measures_map = known.unionByName(known.limit(1).withColumns({"id": F.lit(99), "measure": F.lit("FURTHER"), "is_active": F.lit(1)}))
    clinics = clinics.unionByName(further)
    mapped = mapped_measures(_staged_upload(spark, sf_dir, known), clinics, measures_map)
    return spark.createDataFrame([(check_measures(mapped, clinics, measures_map),)], "warning string")


@register(
    "audit_row",
    f"""
    SELECT {YEAR} AS year, {MONTH} AS month, count(*) AS insert_count, 1 AS is_success FROM lineitem""",
)
def log_row(spark, sf_dir):
    count = roles.table(spark, sf_dir, "lineitem").count()
    folder = shared_folder(spark, "log")
    values = {"year": YEAR, "month": MONTH, "insert_count": count, "is_success": 1}
    logged_at = dt.datetime.combine(AS_OF, dt.time(8, 30, 12))
    tables.append_rows(audit_row(spark, MEMBERSHIP_LOG, values, logged_at), folder)
    return spark.read.parquet(folder).select("year", "month", "insert_count", "is_success")


@register(
    "newest_file_per_site",
    """
    SELECT c_nationkey, o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey
    QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY o_orderdate DESC, o_orderkey) = 1""",
)
def newest_file_per_site(spark, sf_dir):
    customer = roles.table(spark, sf_dir, "customer")
    files = roles.table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    picked = files.select("c_nationkey", "o_orderkey", "o_orderdate")
    return first_per_group(picked, ["c_nationkey"], [F.desc("o_orderdate"), F.asc("o_orderkey")]).select(
        "c_nationkey", "o_orderkey"
    )
