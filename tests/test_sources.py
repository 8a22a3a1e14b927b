import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from panelspark.operators import checks
from panelspark.plans.audit import audited
from panelspark.plans.measures_file import MeasureTables, run_measures_file
from panelspark.plans.identity import run_matching
from panelspark.plans.roster_month import (
    RosterTables, mapped_roster, month_column, processed_rows, run_roster_month,
)
from panelspark.schemas import CLINIC_MAP, MEMBERSHIP, MEMBERSHIP_LOG, MEASURES_MAP, PROCESSED_TO_MEMBERSHIP, ROSTER_FIELDS
from panelspark.session import broadcast_if_small
from panelspark.sources import tables
from panelspark.sources.delimited import read_processed, staged_roster, write_roster
from panelspark.sources.files import file_list, oldest_and_newest
from panelspark.sources.html import cell_text, html_table, read_html_files
from panelspark.sources.sheets import read_sheets, sheet_rows, staged_measures
from panelspark.streaming.backlog import run_backlog

APR, MAY = dt.date(2024, 4, 12), dt.date(2024, 5, 11)
RUN = dt.datetime(2024, 5, 11, 9, 30)
HEADER = "CIN,PCP,Member First Name,Member Last Name,DOB,Age,Gender,NewMember,Member Phone,Measure Name,QIP Result"


def stamp(path, day):
    seconds = dt.datetime(day.year, day.month, day.day, 12, tzinfo=dt.timezone.utc).timestamp()
    os.utime(path, (seconds, seconds))


def clinics(spark):
    rows = [(1, 101, 1, "AB", "Alpha", "X", 1), (2, 102, 2, "CD", "Beta", "X", 1), (3, 103, 3, "EF", "Old", "X", 0)]
    return spark.createDataFrame(rows, CLINIC_MAP)


def page(rows, fields=ROSTER_FIELDS):
    head = "".join(f"<th>{f}</th>" for f in fields)
    body = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in row) + "</tr>\n" for row in rows)
    return f"<html><table border=1>\n<tr>{head}</tr>\n{body}</table><table><tr><td>x</td></tr></table></html>"


def member(cin, last="O&#39;Hara", new=""):
    return [
        cin, "Ann", last, "02/28/1990", "F", "R1", "A", "01/01/2024", "", "", new, "12 Elm", " #4", "Arcata",
        "CA", "95501", "(707) 555-1234",
    ]


def test_html_table_by_field_names(spark):
    html = page([["Lee", "1"], ["NA", " <b>2</b> &amp; 3 "]], ["Last Name", "Record#"])
    df = spark.createDataFrame([("p", html), ("none", "<p>no table</p>")], "path string, html string")
    got = html_table(df, "html", ["path"], ["Record#", "Last Name", "RP"]).collect()
    assert [tuple(r) for r in got] == [("p", "1", "Lee", None), ("p", "2 & 3", None, None)]


def test_character_references(spark):
    texts = {
        "Jos&eacute; &#233; &#xE9; &#X1F600;": "Jos\u00e9 \u00e9 \u00e9 \U0001F600",
        "a&amp;lt;b&#38;amp;": "a&lt;b&amp;",
        "R&D; A & B &unknown; &": "R&D; A & B &unknown; &",
        "x&nbsp;&#160;&#xa0;y&apos;": "x   y'",
        "&#0;&#xD800;&#99999999;": "\ufffd\ufffd\ufffd",
        "": "",
    }
    df = spark.createDataFrame([(k, v) for k, v in texts.items()] + [(None, None)], "cell string, want string")
    assert [r for r in df.select("cell", "want", cell_text(F.col("cell")).alias("got")).collect() if r.want != r.got] == []


def test_roster_files_are_read_by_header(spark, tmp_path):
    """Files of one folder differ in the order and number of their columns."""
    fields = list(PROCESSED_TO_MEMBERSHIP)
    for number, names in enumerate((fields, ["Extra", *reversed(fields)])):
        lines = ["%".join(names), *["%".join(f"{n} {number}{k}" for n in names) for k in range(3)]]
        (tmp_path / f"site{number}.csv").write_text("\n".join(lines) + "\n")
    got = read_processed(spark, str(tmp_path))
    assert got.columns == fields
    assert sorted(map(tuple, got.collect())) == sorted(tuple(f"{n} {f}{k}" for n in fields) for f in range(2) for k in range(3))
    (tmp_path / "short.csv").write_text("%".join(fields[1:]) + "\n" + "%".join(fields[1:]) + " x\n")
    with pytest.raises(Exception, match=f"no column {fields[0]}"):
        read_processed(spark, str(tmp_path)).collect()


@pytest.fixture
def roster_folder(tmp_path):
    """Two pages of one clinic with a shared row, and a page of another clinic."""
    pages = {
        "Plan-101_1_May-2024.xls": [member("A000000001", new="*"), member("A000000002")],
        "sub/Plan-101_2_May-2024.xls": [member("A000000002"), member("A000000003", last="Null")],
        "Plan-102_3_May-2024.xls": [member("B000000001")],
    }
    for name, rows in pages.items():
        path = tmp_path / "raw" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(page(rows))
        stamp(path, MAY)
    return tmp_path


def test_roster_pages_to_staged_rows(spark, roster_folder):
    raw = read_html_files(spark, str(roster_folder / "raw"))
    rows = processed_rows(raw, clinics(spark))
    assert rows.count() == 4
    first = rows.where("BIC_HIK = 'A000000001'").first()
    assert (first.Clinic, first.LastName, first.NewMember, first.period) == ("AB", "O''Hara", "TRUE", "AB_05-2024")
    assert first.FullAddress == "12 Elm#4 :: Arcata ~ CA | 95501"
    assert first.LastUpdated == MAY and first.PhoneNumber == "707-555-1234"
    assert "May" in month_column(rows, 5).columns
    out = str(roster_folder / "processed")
    write_roster(month_column(rows, 5), out)
    assert sorted(p.name for p in (roster_folder / "processed").glob("period=*")) == [
        "period=AB_05-2024", "period=CD_05-2024"
    ]
    staged = mapped_roster(staged_roster(read_processed(spark, out)), clinics(spark))
    got = {r.cin: r for r in staged.collect()}
    assert (got["A000000001"].clinic_id, got["B000000001"].clinic_id) == (1, 2)
    assert (got["A000000001"].new_member, got["A000000002"].new_member) == (1, 0)
    assert got["A000000003"].last_name == "Null" and got["A000000001"].dob == dt.date(1990, 2, 28)
    assert got["A000000001"].download_date == MAY and got["A000000001"].is_enrolled == 1


def test_unknown_site_fails(spark, tmp_path):
    (tmp_path / "Plan-999_1_May-2024.xls").write_text(page([member("A000000001")]))
    with pytest.raises(Exception, match="no map key in"):
        processed_rows(read_html_files(spark, str(tmp_path)), clinics(spark)).collect()


def seeded(spark, folder):
    rows = [
        {"cin": "A000000001", "clinic_id": 1, "first_name": "Ann", "last_name": "Old", "months_enrolled": 4,
         "is_enrolled": 1, "is_qip_eligible": 1, "new_member": 0, "date_new_member": APR, "download_date": APR,
         "dob": dt.date(1990, 2, 28), "epic_pat_id": None},
        {"cin": "Z000000001", "clinic_id": 2, "first_name": "Zoe", "last_name": "Gone", "months_enrolled": 1,
         "is_enrolled": 1, "is_qip_eligible": 1, "new_member": 0, "date_new_member": APR, "download_date": APR,
         "dob": dt.date(1991, 2, 28), "epic_pat_id": "E7"},
    ]
    df = spark.createDataFrame([tuple(r.get(f.name) for f in MEMBERSHIP) for r in rows], MEMBERSHIP)
    tables.write_version(df, f"{folder}/membership", 1)
    tables.publish(spark, f"{folder}/membership", 1)
    return RosterTables(*[f"{folder}/{n}" for n in ("membership", "history", "log", "reports")])


def test_roster_measures_and_matching_jobs(spark, roster_folder):
    stored = seeded(spark, roster_folder)
    rows = processed_rows(read_html_files(spark, str(roster_folder / "raw")), clinics(spark))
    roster = rows.select("*").withColumn("Month", F.lit(1))
    write_roster(roster, str(roster_folder / "processed"))
    staged = mapped_roster(staged_roster(read_processed(spark, str(roster_folder / "processed"))), clinics(spark))
    version = run_roster_month(spark, staged, clinics(spark), stored, 2024, 5, RUN)
    assert version == 202405110930 == tables.latest_version(spark, stored.membership)
    now = {r.cin: r for r in tables.read_version(spark, stored.membership).collect()}
    assert now["A000000001"].months_enrolled == 5 and now["A000000001"].last_name == "O''Hara"
    assert (now["Z000000001"].is_enrolled, now["Z000000001"].is_qip_eligible, now["Z000000001"].epic_pat_id) == (0, 0, "E7")
    log = spark.read.parquet(stored.log).first()
    assert (log.update_count, log.insert_count, log.enrolled_count, log.is_success) == (1, 3, 4, 1)
    history = spark.read.parquet(stored.history)
    assert history.where("year = 2024 AND month = 5").count() == 4
    report = spark.read.option("header", True).csv(f"{stored.reports}/NR_05-2024-{version}")
    assert [r.cin for r in report.collect()] == ["A000000002", "A000000003", "B000000001"]

    with pytest.raises(checks.CheckFailed, match="Already updated"):
        run_roster_month(spark, staged, clinics(spark), stored, 2024, 5, RUN + dt.timedelta(hours=1))
    failed = spark.read.parquet(stored.log).where("is_success = 0").first()
    assert failed.failure_step == "Already updated this month"
    assert tables.latest_version(spark, stored.membership) == version

    sheet = roster_folder / "sheets" / "a.csv"
    sheet.parent.mkdir()
    lines = ["Report", HEADER]
    lines += [f"{c},Site 102,Ann,Lee,02/28/1990,34,F,N,7075551234,Asthma 2024,{r}" for c, r in (("Z000000001", "Numerator"), ("N000000001", "x"))]
    lines += ["N000000001,Site 102,Ann,Lee,02/28/1990,34,F,N,7075551234,Unknown 2024,x"]
    sheet.write_text("\n".join(lines) + "\n")
    stamp(sheet, MAY)
    measures_map = spark.createDataFrame([(5, "as", "Asthma", 1), (6, "bp", "Pressure", 1)], MEASURES_MAP)
    uploaded = staged_measures(sheet_rows(read_sheets(spark, str(sheet.parent))))
    mt = MeasureTables(stored.membership, stored.history, *[f"{roster_folder}/{n}" for n in ("measures", "summary", "mlog")])
    for _ in range(2):
        run_measures_file(spark, uploaded, "a.csv", clinics(spark), measures_map, mt, MAY, RUN + dt.timedelta(hours=2))
    assert spark.read.parquet(mt.measures).count() == 2 and spark.read.parquet(mt.log).count() == 2
    after = {r.cin: r for r in tables.read_version(spark, stored.membership).collect()}
    assert (after["Z000000001"].is_enrolled, after["Z000000001"].months_enrolled) == (1, 2)
    assert after["N000000001"].months_missed == 4 and after["N000000001"].phone_number == "707-555-1234"
    log = spark.read.parquet(mt.log).first()
    assert log.insert_count == 2 and log.warning_message.startswith(
        "Clinic - without rows: 1\nMeasure - without rows: 6\nUnmapped measures: 1 in "
    )
    got = {(r.cin, r.measure_id, r.is_compliant, r.is_qip_eligible) for r in spark.read.parquet(mt.measures).collect()}
    assert got == {("Z000000001", 5, 1, 1), ("N000000001", 5, 0, 0)}
    summary = spark.read.parquet(mt.summary).first()
    assert (summary.clinic_id, summary.numerator, summary.denominator, summary.qip_denominator) == (2, 1, 2, 1)

    patients = spark.createDataFrame(
        [("E9", "lee,ann", "Ann", "Lee", dt.datetime(1990, 2, 28, 5), 1, 1)],
        "pat_id string, pat_name string, pat_first_name string, pat_last_name string, birth_date timestamp, "
        "update_date int, rec_create_date int",
    )
    merges = spark.createDataFrame([("E7", "E8")], "old string, new string")
    run_matching(spark, stored.membership, f"{roster_folder}/matching", patients, merges, "old", "new", RUN + dt.timedelta(hours=3))
    linked = {r.cin: r.epic_pat_id for r in tables.read_version(spark, stored.membership).collect()}
    assert (linked["Z000000001"], linked["N000000001"], linked["B000000001"]) == ("E8", "E9", None)
    log = {(r.cin, r.epic_pat_id): r.fuzzy_score for r in spark.read.parquet(f"{roster_folder}/matching").collect()}
    assert log == {("Z000000001", "E8"): None, ("N000000001", "E9"): 100.0}


def test_roster_checks_stop(spark, tmp_path):
    stored = seeded(spark, tmp_path)
    columns = "cin string, clinic_id int, clinic_text string, first_name string, last_name string, dob date, new_member int, is_enrolled int, download_date date"
    good = ("A000000001", 1, "AB", "Ann", "Lee", APR, 0, 1, MAY)
    other = ("B000000001", 2, "CD", "Bo", "Lee", APR, 0, 1, MAY)
    # The start of each message, and the values of the violations table it names.
    cases = [
        ("Missing df values: 2", None, [good]),
        ("Unmapped df values: 1 in ", ["ZZ"], [good, other, ("C000000001", None, "ZZ", "x", "y", APR, 0, 1, MAY)]),
        ("A required field has no value", None, [good, other[:4] + (None,) + other[5:]]),
        ("Malformed member ids: 1 in ", ["B1 in CD file"], [good, ("B1",) + other[1:]]),
        ("Staged rows do not fit the table: primary_key cin: 1", None, [good, good, other]),
    ]
    for message, values, rows in cases:
        with pytest.raises(checks.CheckFailed) as stop:
            run_roster_month(spark, spark.createDataFrame(rows, columns), clinics(spark), stored, 2024, 5, RUN)
        text = str(stop.value)
        assert text.startswith(message)
        if values:
            assert [r[0] for r in spark.read.parquet(text.split(" in ", 1)[1]).collect()] == values
    assert spark.read.parquet(stored.log).where("is_success = 0").count() == len(cases)
    assert tables.latest_version(spark, stored.membership) == 1


def test_backlog_runs_oldest_first(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, day in (("b.csv", dt.date(2024, 5, 3)), ("a.csv", dt.date(2024, 5, 9)), ("c.csv", dt.date(2024, 5, 1))):
        (folder / name).write_text(f"x\n{HEADER}\n{name},Site 1,A,B,02/28/1990,1,F,Y,,Asthma 2024,Numerator\n")
        stamp(folder / name, day)
    seen = []

    def handle(batch, _):
        seen.extend((r.cin, r.download_date, r.month) for r in batch.collect())

    checkpoint = str(tmp_path / "checkpoint")
    run_backlog(spark, str(folder), handle, checkpoint)
    assert seen == [("c.csv", dt.date(2024, 5, 1), 5), ("b.csv", dt.date(2024, 5, 3), 5), ("a.csv", dt.date(2024, 5, 9), 5)]
    run_backlog(spark, str(folder), handle, checkpoint)
    assert len(seen) == 3


def test_file_listing(spark, tmp_path):
    for name, day in (("a.xls", MAY), ("b.xls", APR), ("c.txt", APR)):
        (tmp_path / name).write_text("x")
        stamp(tmp_path / name, day)
    row = oldest_and_newest(file_list(spark, str(tmp_path), ".xls")).first()
    assert row.file_count == 2 and row.oldest.endswith("b.xls") and row.newest.endswith("a.xls")
    with pytest.raises(Exception, match="no files"):
        oldest_and_newest(file_list(spark, str(tmp_path), ".csv")).collect()


def test_versions_count_once_published(spark, tmp_path):
    table = str(tmp_path / "t")
    tables.write_version(spark.range(1), table, 1)
    with pytest.raises(FileNotFoundError):
        tables.latest_version(spark, table)
    tables.publish(spark, table, 1)
    tables.write_version(spark.range(5), table, 2)
    assert tables.read_version(spark, table).count() == 1
    tables.publish(spark, table, 2)
    assert tables.read_version(spark, table).count() == 5
    with pytest.raises(FileExistsError):
        tables.write_version(spark.range(1), table, 2)


def test_audit_row_on_failure(spark, tmp_path):
    with pytest.raises(RuntimeError):
        with audited(spark, str(tmp_path / "log"), MEMBERSHIP_LOG, RUN) as log:
            log["update_count"] = 3
            raise RuntimeError("step 2")
    row = spark.read.parquet(str(tmp_path / "log")).first()
    assert (row.update_count, row.failure_step, row.is_success) == (3, "step 2", 0)


def test_broadcast_only_when_small(spark):
    big, small = spark.range(1000), spark.range(10)

    def plan(limit):
        df = big.join(broadcast_if_small(small, limit), "id")
        return df._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan(10) and "strategy=broadcast" not in plan(9)


def test_sheets_are_read_by_header(spark):
    import pytest
    from pyspark.sql import functions as F

    from panelspark.schemas import SHEET_TO_MEASURES
    from panelspark.sources.sheets import sheet_rows

    names = list(SHEET_TO_MEASURES)
    shuffled = ["Plan", *reversed(names)]
    text = "title\n" + ",".join(shuffled) + "\n" + ",".join(f"{n} 1" for n in shuffled) + "\n"
    row = sheet_rows(spark.createDataFrame([(text, "f")], "value string, path string")).first()
    assert all(row[n] == f"{n} 1" for n in names)
    short = spark.createDataFrame([(text.replace("PCP", "Other", 1), "f")], "value string, path string")
    with pytest.raises(Exception, match="lacks the column PCP"):
        sheet_rows(short).select(F.max("PCP")).collect()
