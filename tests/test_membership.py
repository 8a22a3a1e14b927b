import datetime as dt

import pytest

from panelspark.operators import reconcile as C
from panelspark.operators import roster as R
from panelspark.plans.measures_file import reconcile

BASE = (
    "cin string, clinic_id int, first_name string, new_member int, date_new_member date, months_enrolled int, "
    "months_missed int, is_enrolled int, is_qip_eligible int, download_date date, mpi int, updated_at timestamp"
)
ROSTER = "cin string, clinic_id int, first_name string, new_member int, is_enrolled int, download_date date"
APR, MAY = dt.date(2024, 4, 12), dt.date(2024, 5, 11)
RUN = dt.datetime(2024, 5, 11, 9, 30, 45)


def base_row(cin, months, **changes):
    row = dict(
        cin=cin, clinic_id=1, first_name="old", new_member=1, date_new_member=APR, months_enrolled=months,
        months_missed=0, is_enrolled=1, is_qip_eligible=1, download_date=APR, mpi=7, updated_at=None,
    )
    return tuple({**row, **changes}.values())


def merged(spark, base, incoming, month, rollover=False):
    b = spark.createDataFrame(base, BASE)
    i = spark.createDataFrame(incoming, ROSTER)
    return R.apply_roster(b, i, month, rollover, RUN)


def test_merge_updates_inserts_and_keeps(spark):
    base = [base_row("a", 3), base_row("b", 0), base_row("c", None), base_row("d", 2)]
    incoming = [("a", 2, "new", 0, 1, MAY), ("e", 3, "in", 0, 1, MAY), ("c", 2, "new", 0, 1, MAY), ("d", 2, "x", 1, 1, MAY)]
    df = merged(spark, base, incoming, 5)
    got = {r.cin: r for r in df.collect()}
    assert len(got) == 5
    a, b, c, d, e = (got[k] for k in "abcde")
    assert (a.merge_action, a.clinic_id, a.first_name, a.new_member) == ("update", 2, "new", 0)
    assert (a.months_enrolled, a.months_missed, a.is_enrolled, a.is_qip_eligible, a.mpi) == (4, 1, 1, 1, 7)
    assert a.date_new_member == APR and a.download_date == MAY
    assert a.updated_at == dt.datetime(2024, 5, 11, 9, 30)
    assert (b.merge_action, b.is_enrolled, b.months_missed, b.is_qip_eligible) == ("keep", 0, 5, 0)
    assert b.download_date == APR and b.first_name == "old" and b.updated_at is None
    assert (c.months_enrolled, c.months_missed, c.is_qip_eligible) == (None, None, None)
    assert d.date_new_member == MAY
    assert (e.merge_action, e.months_enrolled, e.months_missed, e.date_new_member) == ("insert", 1, 4, MAY)
    assert (e.is_qip_eligible, e.mpi, e.updated_at) == (0, None, None)
    assert [r.cin for r in R.arrivals(df).collect()] == ["e"]
    assert {(r.cin, r.year, r.month) for r in R.history_rows(df).collect()} == {
        (c, 2024, 5) for c in ("a", "c", "d", "e")
    }
    counts = R.merge_counts(df).first()
    assert tuple(counts) == (3, 1, 4, 2)


def test_rollover_resets_months(spark):
    got = {r.cin: r for r in merged(spark, [base_row("a", 12), base_row("b", 9)], [("a", 1, "x", 0, 1, MAY)], 1, True).collect()}
    assert (got["a"].months_enrolled, got["b"].months_enrolled) == (1, 0)
    assert (got["a"].is_qip_eligible, got["b"].is_qip_eligible, got["b"].is_enrolled) == (1, 1, 0)


@pytest.mark.parametrize(
    "month, months, enrolled, eligible",
    [(3, None, 0, 1), (8, 4, 1, 0), (8, 5, 1, 1), (8, None, 1, None), (12, 12, 0, 0), (12, 9, 1, 1), (12, 8, 1, 0), (4, 0, 0, 0)],
)
def test_eligibility(spark, month, months, enrolled, eligible):
    df = spark.createDataFrame([(months, enrolled)], "m int, e int")
    assert df.select(R.eligibility(month, df.m, df.e)).first()[0] == eligible


@pytest.mark.parametrize(
    "stored, incoming, status",
    [
        (dt.date(2024, 4, 2), dt.date(2024, 5, 2), "ok"), (dt.date(2024, 4, 2), dt.date(2024, 4, 9), "duplicate"),
        (dt.date(2024, 4, 2), dt.date(2024, 6, 2), "gap"), (dt.date(2023, 12, 2), dt.date(2024, 1, 2), "rollover"),
        (dt.date(2022, 4, 2), dt.date(2024, 5, 2), "ok"), (None, dt.date(2024, 5, 2), "empty"),
    ],
)
def test_gate(spark, stored, incoming, status):
    old = spark.createDataFrame([(stored,)] if stored else [], "download_date date")
    new = spark.createDataFrame([(incoming,)], "download_date date")
    assert R.continuity_gate(old, new).first().status == status


def test_second_run_is_a_duplicate(spark):
    df = merged(spark, [base_row("a", 3)], [("a", 2, "x", 0, 1, MAY)], 5)
    again = spark.createDataFrame([("a", 2, "x", 0, 1, MAY)], ROSTER)
    assert R.continuity_gate(df, again).first().status == "duplicate"


def test_counts_of_empty_table_are_null(spark):
    empty = spark.createDataFrame([], "is_enrolled int, is_qip_eligible int")
    assert tuple(R.enrollment_counts(empty).first()) == (None, None)


MEASURES = "cin string, clinic_id int, first_name string, new_member int, measure_id int, is_compliant int, year int, month int, download_date date"
HISTORY = "cin string, clinic_id int, year int, month int, is_qip_eligible int, download_date date"


def test_reconcile_inserts_and_reactivates(spark):
    members = spark.createDataFrame(
        [
            base_row("a", 5, download_date=MAY), base_row("b", 1, is_enrolled=0, is_qip_eligible=0),
            base_row("c", 4, is_enrolled=0, is_qip_eligible=0), base_row("d", 2),
        ],
        BASE,
    )
    rows = [(c, 9, "file", 0, m, 1, 2024, 5, MAY) for c in "abcx" for m in (1, 2)]
    measures = spark.createDataFrame(rows, MEASURES)
    history = spark.createDataFrame([("a", 1, 2024, 5, 1, MAY), ("b", 1, 2024, 1, 1, APR)], HISTORY)
    done = reconcile(measures, members, history, 2024, 5, MAY)
    got = {r.cin: r for r in done.membership.collect()}
    assert {c: r.merge_action for c, r in got.items()} == {
        "a": "keep", "b": "reactivate", "c": "reactivate", "d": "keep", "x": "insert"
    }
    assert (got["b"].months_enrolled, got["b"].months_missed, got["b"].is_qip_eligible) == (2, 3, 1)
    assert (got["c"].months_enrolled, got["c"].months_missed, got["c"].is_enrolled) == (5, 0, 1)
    assert (got["x"].months_enrolled, got["x"].months_missed, got["x"].is_qip_eligible) == (1, 4, 0)
    assert got["x"].date_new_member == MAY and got["b"].date_new_member == APR
    added = {(r.cin, r.month, r.is_qip_eligible, r.clinic_id) for r in done.history.collect()}
    # c and d had no history at all: their rows come from before the re-activation.
    assert added == {("c", 4, 0, 1), ("d", 4, 1, 1), ("x", 5, 0, 9), ("b", 5, 1, 9), ("c", 5, 1, 9)}
    appended = C.with_eligibility(measures, done.membership)
    assert appended.count() == 8
    assert {r.is_qip_eligible for r in appended.where("cin = 'x'").collect()} == {0}


def test_reconcile_without_need_and_with_stale_membership(spark):
    members = spark.createDataFrame([base_row("a", 5, is_enrolled=0)], BASE)
    measures = spark.createDataFrame([("a", 9, "file", 0, 1, 1, 2024, 5, MAY)], MEASURES)
    complete = spark.createDataFrame([("a", 1, 2024, 5, 1, MAY)], HISTORY)
    assert reconcile(measures, members, complete, 2024, 5, MAY) is None
    with pytest.raises(ValueError, match="not yet updated"):
        reconcile(measures, members, complete.limit(0), 2024, 5, MAY)
