import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelspark import session
from panelspark.catalog import roles
from panelspark.operators import checks, keys, latest, lookup
from panelspark.operators.summary import against_goal, measure_summary
from panelspark.plans.reports import blood_pressure_report
from panelspark.schemas import Constraints


@pytest.mark.parametrize("max_keys", [200, 0])
def test_contained_keys(spark, max_keys):
    mapping = spark.createDataFrame([(1, "12"), (2, "1"), (3, "AB")], "id int, k string")
    df = spark.createDataFrame([("x12",), ("AB-1",), ("none",), ("AB",), (None,), ("AB-1",)], "t string")

    def run(last):
        out = lookup.map_contained(df, "t", mapping, "k", "id", "v", last=last, max_keys=max_keys)
        return sorted((r.t or "", r.v or 0) for r in out.collect())

    assert run(False) == [("", 0), ("AB", 3), ("AB-1", 2), ("AB-1", 2), ("none", 0), ("x12", 1)]
    assert run(True) == [("", 0), ("AB", 3), ("AB-1", 3), ("AB-1", 3), ("none", 0), ("x12", 2)]


def test_labels_and_required(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "v int, t string")
    assert [r[0] for r in df.select(lookup.label(df.v, df.t)).collect()] == ["1", "b"]
    with pytest.raises(Exception, match="no map key in: b"):
        df.select(lookup.required(df.v, df.t)).collect()


def test_trimmed_names(spark):
    mapping = spark.createDataFrame([(1, "Asthma"), (2, "")], "id int, m string")
    df = spark.createDataFrame([("Asthma 2024",), ("abc",), ("Asthma",), ("Other 2024",)], "t string")
    got = {r.t: r.v for r in lookup.map_trimmed(df, "t", mapping, "m", "id", "v").collect()}
    assert got == {"Asthma 2024": 1, "abc": 2, "Asthma": None, "Other 2024": None}
    mapped = lookup.map_trimmed(df, "t", mapping, "m", "id", "v")
    assert sorted(r.t for r in lookup.unmapped(mapped, "v", "t").collect()) == ["Asthma", "Other 2024"]
    assert lookup.mapped_only(mapped, "v").count() == 2


def test_active_values_take_the_last_of_a_key(spark):
    mapping = spark.createDataFrame([(1, "a", 1), (2, "a", 1), (3, "b", 0)], "id int, k string, is_active int")
    assert [tuple(r) for r in lookup.active_values(mapping, "k", "id").collect()] == [("a", 2)]
    assert [r.k for r in lookup.active_values(mapping, "k").collect()] == ["a", "a"]


def test_except_and_not_in_with_nulls(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "k string")
    b = spark.createDataFrame([("y",), ("z",)], "k string")
    assert {r.k for r in keys.except_keys(a, b, ["k"]).collect()} == {"x", None}
    with_null = b.unionByName(a.where("k IS NULL"))
    assert [r.k for r in keys.except_keys(a, with_null, ["k"]).collect()] == ["x"]
    assert [r.k for r in keys.not_in(a, with_null, ["k"]).collect()] == ["x", "x"]
    assert [r.k for r in keys.is_in(a, with_null, ["k"]).collect()] == ["y"]


def test_coverage_and_message(spark):
    have = spark.createDataFrame([(1,), (1,), (9,), (8,)], "v int")
    want = spark.createDataFrame([("1",), ("2",)], "id string")
    sides = keys.coverage(have, "v", want, "id")
    assert checks.coverage_message(sides).startswith("Missing df values: 2 & Unmapped df values: 2 in ")
    assert checks.coverage_message(keys.coverage(want, "id", want, "id")) is None
    assert checks.joined_values(have.limit(0), "v") is None


def test_latest_and_retention(spark):
    rows = [("a", 1, 1), ("a", 3, 2), ("a", 3, 3), ("b", None, 4), ("b", 0, 5)]
    df = spark.createDataFrame(rows, "g string, d int, id int")
    got = latest.latest_version(df, ["g"], ["d"], "id").collect()
    assert sorted((r.g, r.id) for r in got) == [("a", 2), ("b", 5)]
    kept = latest.retain_latest(df.dropna(), ["g"], "d").collect()
    assert sorted(r.id for r in kept) == [2, 3, 5]
    counts = latest.retention_counts(df.dropna(), ["g"], "d").collect()
    assert sorted(map(tuple, counts)) == [("a", 2, 1), ("b", 1, 0)]


def test_first_per_group_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), "id")
    plan = latest.first_per_group(df, ["g"], [F.desc("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_summary_and_goals(spark):
    day = dt.date(2024, 5, 1)
    rows = [(1, 1, 2024, 5, 1, 1, day), (1, 1, 2024, 5, 0, 1, day), (1, 1, 2024, 5, 1, 0, day), (2, 1, 2024, 5, 0, 0, day)]
    df = spark.createDataFrame(
        rows, "clinic_id int, measure_id int, year int, month int, is_compliant int, is_qip_eligible int, download_date date"
    )
    summary = measure_summary(df)
    got = {r.clinic_id: (r.qip_numerator, r.qip_denominator, r.numerator, r.denominator) for r in summary.collect()}
    assert got == {1: (1, 2, 2, 3), 2: (0, 0, 0, 1)}
    goals = spark.createDataFrame([(1, 2024, 66.0)], "measure_id int, year int, percentage double")
    assert {r.clinic_id: r.goal_met for r in against_goal(summary, goals).collect()} == {1: 1, 2: 0}


def test_blood_pressure_report(spark):
    day = dt.date(2024, 3, 1)
    members = spark.createDataFrame(
        [("m1", 1, "B", "Ann", "Lee", day), ("m2", 2, "A", "Bo", None, day)],
        "bic_hik string, patientid int, clinic string, firstname string, lastname string, dob date",
    )
    measures = spark.createDataFrame([("m1", "Denominator"), ("m2", "Denominator")], "bic_hik string, highbp string")
    readings = spark.createDataFrame(
        [(1, dt.date(2024, 4, 2), 120, 80, 1, 0), (1, day, 1, 1, 1, 0), (1, dt.date(2024, 4, 3), 1, 1, 1, 1), (2, dt.date(2024, 5, 1), 110, 70, 1, 0)],
        "patient_id int, bp_date date, systolic int, diastolic int, numerator int, exclusion int",
    )
    visits = spark.createDataFrame([("m1", day), ("m1", dt.date(2023, 1, 1)), ("m2", day)], "cin string, date date")
    got = [tuple(r) for r in blood_pressure_report(members, measures, readings, visits).collect()]
    assert got == [("m2", "05/01/2024", 110, 70, "A", None, day), ("m1", "04/02/2024", 120, 80, "B", "Ann Lee", day)]


def test_constraints(spark):
    rows = [("1234567890", 1, "Ann"), ("1234567890", 1, None), ("12345678.0", 2, "Ann"), ("12", 9, "toolong")]
    df = spark.createDataFrame(rows, "cin string, clinic_id int, first_name string")
    clinics = spark.createDataFrame([(1, "A"), (2, "B")], "id int, clinic_key string")
    rules = Constraints(("cin",), ("first_name",), {"cin": 10}, {"first_name": 5})
    got = {tuple(r) for r in checks.constraint_violations(df, rules, {"clinic_id": (clinics, "id")}).collect()}
    assert got == {
        ("not_null", "first_name", "1234567890"), ("primary_key", "cin", "1234567890"),
        ("exact_length", "cin", "12"), ("max_length", "first_name", "12"), ("foreign_key", "clinic_id", "9"),
    }
    ids = checks.id_violations(df, "cin", clinics, "clinic_key").collect()
    assert [tuple(r) for r in ids] == [("12345678.0", "B")]
    assert tuple(checks.length_range(df, "cin").first()) == (2, 10)
    assert tuple(checks.null_counts(df, ["first_name"]).first()) == (4, 1)
    with pytest.raises(checks.CheckFailed, match="bad: 2 in "):
        checks.enforce(df.where("length(cin) <> 10 OR cin LIKE '%.0'"), "bad", "cin")
    assert checks.missing_fields(["a"], ["a", "b"]) == ["b"]


@pytest.mark.parametrize(
    "names, status",
    [([], "no month"), (["A_04-2024.txt", "B_04-2024.txt"], "current month"), (["A_03-2024.txt"], "other month"),
     (["A_03-2024.txt", "A_04-2024.txt"], "several months")],
)
def test_period_status(spark, names, status):
    files = spark.createDataFrame([(n,) for n in names], "name string")
    row = checks.period_status(files, "name", dt.date(2024, 4, 20)).first()
    assert row.status == status and row.is_valid == int(status in ("current month", "other month"))


def test_new_data_due(spark):
    def due(last, published, today):
        df = spark.createDataFrame([(last, published, today)], "l date, p date, t date")
        return df.select(checks.new_data_due(df.l, df.p, df.t)).first()[0]

    assert due(dt.date(2024, 4, 1), dt.date(2024, 4, 8), dt.date(2024, 4, 10)) is True
    assert due(dt.date(2024, 4, 1), dt.date(2024, 4, 8), dt.date(2024, 4, 9)) is False
    assert due(dt.date(2024, 4, 8), dt.date(2024, 4, 8), dt.date(2024, 4, 20)) is False
    assert due(None, dt.date(2024, 4, 8), dt.date(2024, 4, 20)) is False


def test_enforce_counts_an_empty_text(spark):
    with pytest.raises(checks.CheckFailed, match="unmapped: 1 in "):
        checks.enforce(spark.createDataFrame([("",)], "t string"), "unmapped", "t")
    checks.enforce(spark.createDataFrame([], "t string"), "unmapped", "t")


@pytest.mark.parametrize("last", [False, True])
def test_both_plans_of_a_map_agree(spark, last):
    rows = [("a", None, 1), ("b", 5, 2), (None, 7, 0), ("c", 6, 2), ("ab", 8, None)]
    mapping = spark.createDataFrame(rows, "k string, v int, o int")
    texts = spark.createDataFrame([("xa",), ("xab",), ("bc",), ("none",), (None,), ("",)], "t string")
    small, large = (
        {r.t: r.out for r in lookup.map_contained(texts, "t", mapping, "k", "v", "out", "o", last, most).collect()} for most in (200, 1)
    )
    assert small == large
    assert small["bc"] == (6 if last else 5) and small["xa"] is None


def test_large_maps_agree_with_small_ones(spark):
    import random

    rng = random.Random(9)
    keys = ["", "a", "ab", "abc", "bca", "ca", "b\U0001f600", "\U0001f600", "zz", "É", "cab"] + ["".join(rng.choices("abcd", k=rng.randint(1, 5))) for _ in range(40)]
    mapping = [(k, f"v{i}" if i % 5 else None, rng.choice([None, 1, 2, 3, 4, 5])) for i, k in enumerate(dict.fromkeys(keys[1:]))] + [(None, "null", 9)]
    texts = [None, "", "x", "zz top", "ab\U0001f600z", "\U0001f600", "Éa"] + ["".join(rng.choices("abcdexyz", k=rng.randint(0, 12))) for _ in range(150)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for rows in (mapping, [*mapping, ("", "empty", 3)], [(None, "x", 1)]):
        m = spark.createDataFrame(rows, "k string, v string, o int")
        for last in (False, True):
            few, many, joined = (
                {r.i: r.out for r in lookup.map_contained(df, "t", m, "k", "v", "out", "o", last, keys, cells).collect()}
                for keys, cells in ((200, 1 << 21), (0, 1 << 21), (0, 1))
            )
            assert few == many == joined


@pytest.mark.parametrize("last", [False, True])
def test_repeated_keys_of_a_large_map_are_reduced_first(spark, monkeypatch, last):
    """A map of many rows and few keys needs no join, in which a text would meet every row of its keys."""
    monkeypatch.setattr(lookup, "_contained_by_substring", lambda *_: pytest.fail("joined"))
    rows = [(k, f"{k}{i}" if i % 7 else None, None if i == 20 else i // 2) for i in range(40) for k in ("a", "ab", "b")] + [(None, "null", -1)]
    mapping = spark.createDataFrame(rows, "k string, v string, o int").repartition(5)
    texts = spark.createDataFrame([("xa",), ("xab",), ("b",), ("none",), (None,), ("",)], "t string")
    got = {r.t: r.out for r in lookup.map_contained(texts, "t", mapping, "k", "v", "out", "o", last, max_keys=2, max_cells=400).collect()}
    want = {"xa": "a39", "xab": "b39", "b": "b39"} if last else {"xa": "a20", "xab": "a20", "b": "b20"}
    assert got == {"none": None, None: None, "": None} | want


def test_tasks_of_a_large_scan_grow_with_its_rows(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    few, many = (session.spread_by_rows(spark.range(n), "id") for n in (99, 3000))
    assert "Exchange" not in few._jdf.queryExecution().toString()
    assert many.rdd.getNumPartitions() == 31
    assert max(len(part) for part in many.rdd.glom().collect()) < 200
    assert sorted(r.id for r in many.collect()) == list(range(3000))


def test_upload_is_joined_in_tasks_that_grow_with_the_line_items(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "ROWS_PER_TASK", 10)
    rows = {
        "lineitem": [(i // 4, 1, 1, i % 4, 1.0, 1.0, 0.0, 0.0, "N", "FO"[i % 2], dt.datetime(2001, 7, 1)) for i in range(200)],
        "orders": [(i, i % 5, "F", 1.0, dt.datetime(2001, 7, 1), "2-HIGH") for i in range(50)],
        "customer": [(i, f"c{i}", 1, 1.0, "X") for i in range(5)],
    }
    for name, values in rows.items():
        spark.createDataFrame(values, roles.SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    upload = roles.measures_upload(spark, str(tmp_path))
    assert "REPARTITION_BY_NUM" in upload._jdf.queryExecution().toString()
    assert sorted(tuple(r) for r in upload.groupBy("cin", "is_compliant").count().collect()) == [
        (f"{c:010d}", hit, 20) for c in range(5) for hit in (0, 1)]
