"""Runs that publish together, die at any point, come again, and the jobs built on them."""

import datetime as dt
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from panelspark.operators.checks import CheckFailed
from panelspark.plans.measures_file import MeasureTables, run_measures_file
from panelspark.plans.retention import run_retention
from panelspark.plans.roster_files import fetch_due, run_roster_files
from panelspark.plans.roster_month import RosterTables, run_roster_month, scanned_rows
from panelspark.schemas import CLINIC_MAP, MEASURES_MAP, ROSTER_FIELDS, SHEET_TO_MEASURES
from panelspark.sources import runs, tables
from panelspark.sources.html import scan_html_tables
from panelspark.sources.runs import Run
from panelspark.sources.sheets import scan_sheets
from panelspark.streaming.backlog import upload_backlog

APR, MAY = dt.date(2024, 4, 20), dt.date(2024, 5, 11)
RUN = dt.datetime(2024, 5, 11, 9, 30)
ROSTER = "cin string, clinic_id int, clinic_text string, first_name string, last_name string, dob date, new_member int, is_enrolled int, download_date date"


class Killed(BaseException):
    """A crash: nothing that handles errors sees it."""


def clinics(spark):
    return spark.createDataFrame([(1, 101, 1, "AB", "Ab", "X", 1), (2, 102, 2, "CD", "Cd", "X", 1)], CLINIC_MAP)


def seeded(spark, folder):
    rows = [("A000000001", None, 1, "Ann", "Lee", APR, 4, 0, 1, 1, 0, APR, APR, None, None), ("Z000000001", "E7", 2, "Zoe", "Ng", APR, 1, 3, 1, 1, 0, APR, APR, None, None)]
    columns = "cin string, epic_pat_id string, clinic_id int, first_name string, last_name string, dob date, months_enrolled int, " \
              "months_missed int, is_enrolled int, is_qip_eligible int, new_member int, date_new_member date, download_date date, " \
              "sex string, phone_number string"
    tables.write_version(spark.createDataFrame(rows, columns), f"{folder}/membership", 1)
    tables.publish(spark, f"{folder}/membership", 1)
    return RosterTables(*(f"{folder}/{n}" for n in ("membership", "history", "log", "reports")))


def roster(spark, *rows):
    return spark.createDataFrame([(c, k, "AB" if k == 1 else "CD", f, "Lee", APR, 0, 1, MAY) for c, k, f in rows], ROSTER)


GOOD = [("A000000001", 1, "Ann"), ("B000000001", 2, "Bo")]


def state(spark, stored, *more):
    """All that readers of the tables see."""
    out = {"membership": sorted(map(repr, tables.read_version(spark, stored.membership).drop("updated_at", "merge_action").collect()))}
    for table in (stored.history, *more):
        found = spark.read.parquet(table).drop("run", "inserted_at") if tables.exists(spark, table) else None
        out[table.rsplit("/", 1)[1]] = sorted(map(repr, found.collect())) if found else []
    return out


def die_at(monkeypatch, name, call):
    """Kill the process at the n-th call of a step."""
    step, calls = getattr(runs, name), []

    def dying(*args):
        calls.append(1)
        if len(calls) == call:
            raise Killed
        return step(*args)

    monkeypatch.setattr(runs, name, dying)


def test_killed_ahead_of_commit_leaves_nothing(spark, tmp_path, monkeypatch):
    clean, stored = seeded(spark, tmp_path / "clean"), seeded(spark, tmp_path / "t")
    before = state(spark, stored)
    with monkeypatch.context() as m:
        m.setattr(Run, "commit", lambda self: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):
            run_roster_month(spark, roster(spark, *GOOD, ("C000000001", 1, "wrong")), clinics(spark), stored, 2024, 5, RUN)
    assert state(spark, stored) == before and not tables.exists(spark, stored.log)
    for target in (stored, clean):
        run_roster_month(spark, roster(spark, *GOOD), clinics(spark), target, 2024, 5, RUN)
    assert state(spark, stored, stored.log) == state(spark, clean, clean.log)
    assert runs.sweep(spark, stored.runs, -10) == 1


@pytest.mark.parametrize("call", [1, 3])
def test_killed_behind_commit_is_completed(spark, tmp_path, monkeypatch, call):
    clean, stored = seeded(spark, tmp_path / "clean"), seeded(spark, tmp_path / "t")
    run_roster_month(spark, roster(spark, *GOOD), clinics(spark), clean, 2024, 5, RUN)
    with monkeypatch.context() as m:
        die_at(m, "_move", call)
        with pytest.raises(Killed):
            run_roster_month(spark, roster(spark, *GOOD), clinics(spark), stored, 2024, 5, RUN)
    assert runs.recover(spark, stored.runs) == 1 and runs.recover(spark, stored.runs) == 0
    assert state(spark, stored, stored.log) == state(spark, clean, clean.log)


def test_a_month_is_replaced_on_demand_only(spark, tmp_path):
    clean, stored = seeded(spark, tmp_path / "clean"), seeded(spark, tmp_path / "t")
    wrong = roster(spark, *GOOD, ("C000000001", 1, "wrong"))
    first = run_roster_month(spark, wrong, clinics(spark), stored, 2024, 5, RUN)
    with pytest.raises(Exception, match="Already updated"):
        run_roster_month(spark, roster(spark, *GOOD), clinics(spark), stored, 2024, 5, RUN)
    second = run_roster_month(spark, roster(spark, *GOOD), clinics(spark), stored, 2024, 5, RUN, replace=True)
    assert second == first + 1  # two versions of one minute
    run_roster_month(spark, roster(spark, *GOOD), clinics(spark), clean, 2024, 5, RUN)
    assert state(spark, stored) == state(spark, clean)
    assert spark.read.parquet(stored.log).groupBy("is_success").count().orderBy("is_success").collect() == [(0, 1), (1, 2)]


MEASURES = "cin string, clinic_text string, measure_text string, first_name string, last_name string, dob date, sex string, " \
           "phone_number string, new_member int, is_compliant int, download_date date, year int, month int"


def sheet(spark, *rows, day=MAY):
    return spark.createDataFrame(
        [(c, "Site 102", f"{m} 2024", "Ann", "Lee", APR, "Female", None, 0, hit, day, 2024, 5) for c, m, hit in rows], MEASURES)


def measure_tables(stored):
    root = stored.membership.rsplit("/", 1)[0]
    return MeasureTables(stored.membership, stored.history, *(f"{root}/{n}" for n in ("measures", "summary", "mlog")))


def measures_map(spark):
    return spark.createDataFrame([(5, "as", "Asthma", 1), (6, "bp", "Pressure", 1)], MEASURES_MAP)


def test_a_corrected_sheet_takes_back_what_it_did(spark, tmp_path):
    clean, stored = seeded(spark, tmp_path / "clean"), seeded(spark, tmp_path / "t")
    for target in (clean, stored):
        run_roster_month(spark, roster(spark, *GOOD), clinics(spark), target, 2024, 5, RUN)

    def upload(target, name, *rows):
        run_measures_file(spark, sheet(spark, *rows), name, clinics(spark), measures_map(spark), measure_tables(target), MAY, RUN)

    right = [("A000000001", "Asthma", 1), ("Z000000001", "Asthma", 0)]
    upload(stored, "a.csv", *right, ("N000000001", "Asthma", 1), ("N000000002", "Pressure", 1))
    upload(stored, "a.csv", *right)
    upload(clean, "a.csv", *right)
    mt, cmt = measure_tables(stored), measure_tables(clean)
    assert state(spark, stored, mt.measures, mt.summary) == state(spark, clean, cmt.measures, cmt.summary)
    upload(stored, "a.csv", ("A000000001", "Asthma", 1))  # needs no change of the membership at all
    rostered = seeded(spark, tmp_path / "rostered")
    run_roster_month(spark, roster(spark, *GOOD), clinics(spark), rostered, 2024, 5, RUN)
    assert state(spark, stored) == state(spark, rostered)
    # Built upon meanwhile: its rows are replaced, what it added to the membership stays.
    upload(stored, "b.csv", ("N000000003", "Asthma", 1))
    upload(stored, "a.csv", ("A000000001", "Asthma", 0), ("N000000004", "Asthma", 0))
    members = {r.cin for r in tables.read_version(spark, stored.membership).collect()}
    assert {"N000000003", "N000000004"} <= members and "N000000001" not in members
    rows = sorted((r.cin, r.is_compliant) for r in spark.read.parquet(mt.measures).collect())
    assert rows == [("A000000001", 0), ("N000000003", 1), ("N000000004", 0)]
    assert spark.read.parquet(stored.history).groupBy("cin", "year", "month").count().where("count > 1").count() == 0


def test_failed_upload_logs_its_rows(spark, tmp_path):
    stored = seeded(spark, tmp_path)  # last loaded in April
    mt = measure_tables(stored)
    with pytest.raises(Exception, match="not yet updated"):
        run_measures_file(spark, sheet(spark, ("N000000001", "Asthma", 1)), "a.csv", clinics(spark), measures_map(spark), mt, MAY, RUN)
    row = spark.read.parquet(mt.log).first()
    assert (row.insert_count, row.is_success) == (1, 0) and row.failure_step.startswith("The membership is not yet")
    assert not tables.exists(spark, mt.measures)


def test_backlog_uploads_each_sheet_once(spark, tmp_path):
    stored = seeded(spark, tmp_path / "t")
    run_roster_month(spark, roster(spark, *GOOD), clinics(spark), stored, 2024, 5, RUN)
    folder, mt = tmp_path / "in", measure_tables(stored)
    folder.mkdir()
    header = ",".join(SHEET_TO_MEASURES)
    for i, name in enumerate(("c.csv", "a.csv", "b.csv")):
        (folder / name).write_text(f"x\n{header}\nN00000000{i},Site 102,A,B,02/28/1990,1,F,Y,,Asthma 2024,Numerator\n")
        when = dt.datetime(2024, 5, 12 + i, 12).timestamp()
        os.utime(folder / name, (when, when))
    seen = []

    def after(path, day):
        seen.append((path.rsplit("/", 1)[1], day.day))
        if len(seen) == 2:
            raise InterruptedError

    def run():
        upload_backlog(spark, str(folder), str(tmp_path / "checkpoint"), clinics(spark), measures_map(spark), mt, lambda: RUN, after)

    with pytest.raises(StreamingQueryException):
        run()
    run()
    run()
    assert seen == [("c.csv", 12), ("a.csv", 13), ("a.csv", 13), ("b.csv", 14)]
    assert sorted(r.cin for r in spark.read.parquet(mt.measures).collect()) == ["N000000000", "N000000001", "N000000002"]
    assert spark.read.parquet(mt.summary).agg(F.sum("denominator")).first()[0] == 3
    assert spark.read.parquet(stored.history).where("cin LIKE 'N%'").count() == 3
    with pytest.raises(TypeError):
        upload_backlog(spark, str(folder), clinics=clinics(spark), measures_map=measures_map(spark), stored=mt)


def test_retention_rewrites_changed_months_only(spark, tmp_path):
    schema = "measure int, id int, download_date date, year int, month int"
    groups, table, dates = ["measure", "year", "month"], str(tmp_path / "m"), str(tmp_path / "d")
    rows = [(m, i, dt.date(2024, mon, d), 2024, mon) for i, (m, mon, d) in enumerate(
        [(1, 1, 5), (1, 1, 9), (2, 1, 3), (1, 2, 5), (1, 2, 9), (1, 2, 9), (2, 2, 1), (1, 3, 1), (2, 1, 2), (3, 2, 9), (None, 3, 4)])]

    def files():
        return {str(p) for p in (tmp_path / "m").rglob("*.parquet")}

    def upload(key, *at):
        before = files()
        touched = run_retention(spark, spark.createDataFrame([rows[i] for i in at], schema), key, table, dates, groups, "download_date")
        untouched = {f for f in before if not any(f"year={y}/month={m}/" in f for y, m in touched)}
        assert untouched <= files()
        return touched

    assert upload("a", 0, 2, 3, 6, 7) == [(2024, 1), (2024, 2), (2024, 3)]
    assert upload("b", 4, 5) == [(2024, 2)]
    assert upload("b", 4, 5) == [(2024, 2)]  # comes again
    assert upload("c", 1, 8) == [(2024, 1)]  # 8 is late
    assert upload("d", 9) == [(2024, 2)]
    got = sorted(r.id for r in spark.read.parquet(table).collect())
    assert got == [1, 2, 4, 5, 6, 7, 9]
    assert tables.read_version(spark, dates).count() == 6


def page(*rows, fields=ROSTER_FIELDS):
    values = {"First Name": "Ann", "Last Name": "Lee", "Birth": "02/28/1990", "Sex": "F", "Eff Date": "01/01/2024"}
    head = "".join(f"<th>{f}</th>" for f in fields)
    body = "".join("<tr>" + "".join(f"<td>{({'BIC#/HIK#': c} | values).get(f, '')}</td>" for f in fields) + "</tr>\n" for c in rows)
    return f"<html><table>\n<tr>{head}</tr>\n{body}</table></html>"


def pages(folder, **files):
    folder.mkdir(parents=True)
    for name, text in files.items():
        (folder / f"{name}.xls").write_text(text)
        when = dt.datetime(2024, 5, 11, 12).timestamp()
        os.utime(folder / f"{name}.xls", (when, when))
    return str(folder)


def test_raw_pages_to_published_month(spark, tmp_path):
    stored, processed = seeded(spark, tmp_path / "t"), str(tmp_path / "processed")
    one, two = page("A000000001", "C000000001"), page("B000000001")
    short = page("B000000001", fields=[f for f in ROSTER_FIELDS if f not in ("RP", "Birth")])
    stops = [
        ("No roster files", {}),
        ("Missing clinic files: CD", {"Plan-101_1_May-2024": one}),
        ("Unmapped clinic files: 1 in", {"Plan-101_1_May-2024": one, "Plan-102_1_May-2024": two, "Plan-777_1_May-2024": two}),
        ("The roster files are not of one month", {"Plan-101_1_May-2024": one, "Plan-102_1_June-2024": two}),
        ("Missing fields: 1 in", {"Plan-101_1_May-2024": one, "Plan-102_1_May-2024": short}),
    ]
    for i, (message, files) in enumerate(stops):
        with pytest.raises(CheckFailed, match=message):
            run_roster_files(spark, pages(tmp_path / f"raw{i}", **files), processed, clinics(spark), stored, RUN)
    good = pages(tmp_path / "raw", **{"Plan-101_1_May-2024": one, "Plan-102_1_May-2024": two, "Plan-102_2_May-2024": two})
    run_roster_files(spark, good, processed, clinics(spark), stored, RUN)
    now = {r.cin: (r.months_enrolled, r.is_enrolled) for r in tables.read_version(spark, stored.membership).collect()}
    assert now == {"A000000001": (5, 1), "B000000001": (1, 1), "C000000001": (1, 1), "Z000000001": (1, 0)}
    log = spark.read.parquet(stored.log)
    assert sorted(r.failure_step.split(":")[0] for r in log.where("is_success = 0").collect()) == sorted(m.split(":")[0] for m, _ in stops)
    assert log.where("is_success = 1").count() == 1


def test_fetch_is_due_once_there_is_something_newer(spark, tmp_path):
    folder = pages(tmp_path / "sheets", a="x")
    day = dt.date(2024, 5, 11)
    assert fetch_due(spark, folder, day + dt.timedelta(1), dt.date(2024, 5, 12))
    assert not fetch_due(spark, folder, day, dt.date(2024, 5, 12))
    assert not fetch_due(spark, folder, day + dt.timedelta(30), dt.date(2024, 6, 9))
    (tmp_path / "none").mkdir()
    assert fetch_due(spark, str(tmp_path / "none"), day, dt.date(2024, 5, 12))


def test_large_files_are_split(spark, tmp_path):
    ids = [f"{i:010d}" for i in range(4000)]
    folder = pages(tmp_path / "raw", **{"Plan-101_1_May-2024": page(*ids), "Plan-102_1_May-2024": page("B000000001").replace("tr>", "TR>")})
    (tmp_path / "sheets").mkdir()
    head = ",".join(SHEET_TO_MEASURES)
    lines = [f"{c},Site 102,A,B,02/28/1990,1,F,Y,,Asthma 2024,Numerator" for c in ids]
    (tmp_path / "sheets" / "a.csv").write_text("\n" + head + "\n" + "\n".join(lines) + "\n\n")
    (tmp_path / "sheets" / "b.csv").write_text(f"top\nMore,{head}\nz,{lines[0]}\r\n")
    whole = scanned_rows(spark, folder, clinics(spark)).select("BIC_HIK", "Clinic", "DOB").collect()
    sheets = scan_sheets(spark, str(tmp_path / "sheets")).select("CIN", "PCP", "QIP Result").collect()
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        cut = scan_html_tables(spark, folder, ROSTER_FIELDS)
        assert cut.rdd.getNumPartitions() > 5
        assert sorted(scanned_rows(spark, folder, clinics(spark)).select("BIC_HIK", "Clinic", "DOB").collect()) == sorted(whole)
        again = scan_sheets(spark, str(tmp_path / "sheets"))
        assert again.rdd.getNumPartitions() > 5
        assert sorted(again.select("CIN", "PCP", "QIP Result").collect()) == sorted(sheets)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sorted(r.BIC_HIK for r in whole) == [*ids, "B000000001"] and {r.Clinic for r in whole if r.BIC_HIK[0] == "B"} == {"CD"}
    assert sorted(r.CIN for r in sheets) == sorted([*ids, ids[0]]) and {r["QIP Result"] for r in sheets} == {"Numerator"}


def test_sheets_of_one_run_count_as_if_one_by_one(spark, tmp_path):
    from panelspark.plans.measures_file import Sheet, run_measures_sheets

    staged_columns = "cin string, clinic_text string, measure_text string, first_name string, last_name string, dob date, sex string, " \
        "phone_number string, new_member int, is_compliant int, path string, download_date date, year int, month int"
    listed = {  # K..: known without history, M..: enrolled or not, with a row of the month or not; N..: not known
        "b": ["M0", "M1"], "a": ["M0", "K1", "K2"], "d": ["N1", "M2", "K2", "K3"], "c": ["N1", "N2", "M2", "K4", "M5"], "e": ["N2", "M1", "M0"],
        "wrong": ["N3"], "late": ["N4"]}
    days = {path: dt.date(2024, 5, 2 + i) for i, path in enumerate(listed)}
    rows = [
        (f"{cin}00000000", "nowhere" if path == "wrong" else f"Site 10{1 + n % 2}", f"{m} 2024", path + cin, "L", APR, "Male", None, 0, n % 2, path, days[path], 2024, 5)
        for path, members in listed.items() for n, cin in enumerate(members) for m in ("Asthma", "Other")[: 1 + (path == "a")]]
    staged = spark.createDataFrame(rows, staged_columns)
    base = [  # member, enrolled, last download, months of the history
        ("M0", 0, APR, [5]), ("M1", 0, APR, [5]), ("M2", 0, MAY, [4]), ("M5", 1, MAY, [3]), ("K1", 0, APR, []), ("K2", 1, MAY, []), ("K3", 0, APR, []),
        ("K4", 0, dt.date(2024, 5, 1), []), ("K5", 1, MAY, []), ("K6", None, None, [])]
    one, many = seeded(spark, tmp_path / "one"), seeded(spark, tmp_path / "many")
    like = tables.read_version(spark, one.membership).schema
    seed = [(f"{c}00000000", None, 1, c, "L", APR, 1, 3, on, 1 if c != "M2" else 0, 0, APR, day, None, None) for c, on, day, _ in base]
    past = [(f"{c}00000000", 1, 1, dt.date(2024, m, 3), 2024, m, "seed") for c, _, _, months in base for m in months]
    for stored in (one, many):
        tables.write_version(spark.createDataFrame(seed, like), stored.membership, 2)
        tables.publish(spark, stored.membership, 2)
        history = spark.createDataFrame(past, "cin string, clinic_id int, is_qip_eligible int, download_date date, year int, month int, run string")
        tables.append_history(history, stored.history, ("year", "month", "run"))
    sheets = [Sheet(path, path, days[path], f"backlog {path}") for path in listed]
    for sheet in sheets[:5]:
        run_measures_file(
            spark, staged.where(F.col("path") == sheet.path), sheet.name, clinics(spark), measures_map(spark), measure_tables(one),
            sheet.download_date, RUN, key=sheet.key)

    def together():
        done = []
        with pytest.raises(CheckFailed, match="Unmapped clinics"):
            for sheet in run_measures_sheets(spark, staged, sheets, clinics(spark), measures_map(spark), measure_tables(many), lambda: RUN):
                done.append(sheet.path)
        assert done == list(listed)[:5]  # what comes behind a sheet that fails waits
        mt = measure_tables(many)
        assert state(spark, many, mt.measures, mt.summary) == state(spark, one, mt.measures.replace("many", "one"), mt.summary.replace("many", "one"))
        for table in ("history", "measures", "summary"):  # each sheet's rows are its own
            by_sheet = [
                sorted(
                    (tuple(str(v) for v in r)) for r in spark.read.parquet(getattr(measure_tables(t), table))
                    .withColumn("run", F.substring_index("run", ".", 1)).drop("inserted_at").collect())
                for t in (one, many)]
            assert by_sheet[0] == by_sheet[1]

    together()
    assert len(tables.published_versions(spark, many.membership)) == 3  # one run for five sheets
    logs = [
        sorted(str(r) for r in spark.read.parquet(measure_tables(t).log).where("is_success = 1").drop("logged_at").withColumn(
            "warning_message", F.regexp_replace("warning_message", "in /.*", "")).collect()) for t in (one, many)]
    assert logs[0] == logs[1] and len(logs[0]) == 5
    together()  # a batch that comes again replaces what it wrote
