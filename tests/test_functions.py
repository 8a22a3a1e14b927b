import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from panelspark.functions import dates as D
from panelspark.functions import names as N
from panelspark.functions import text as X


def column(spark, values, expr, schema="x string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_roster_phone_drops_punctuation(spark):
    got = column(spark, ["(707) 555-1234", "555-1234", None, "ABCDEFGHIJ", "123"], X.phone(F.col("x")))
    assert got == ["707-555-1234", "555-1234", "", "ABCDEFGHIJ", ""]


def test_sheet_phone_keeps_punctuation(spark):
    got = column(spark, ["7075551234", "(707) 555-1234", "5551234", r"707\W+5551234"], X.phone(F.col("x"), False))
    assert got == ["707-555-1234", "", "555-1234", "707-555-1234"]


def test_address_and_quotes(spark):
    rows = [("12 O'Hara St", "-"), ("-$", None), (" 12 Elm-$", " Apt 4 "), (None, "x")]
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select(X.address(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == ["12 O''Hara St", "", "12 Elm-$ Apt 4", None]
    full = df.select(
        X.full_address(F.col("a"), F.col("b"), F.lit("Arcata"), F.lit(None).cast("string"), F.lit("95501"))
    ).collect()
    assert full[0][0] == "12 O''''Hara St :: Arcata ~  | 95501"
    assert full[1][0] == ":: Arcata ~  | 95501"
    assert full[3][0] is None


def test_flags_and_sex(spark):
    codes = ["F", "M", "U", None]
    assert column(spark, codes, X.sex_roster(F.col("x"))) == ["Female", "Male", "U", None]
    assert column(spark, codes, X.sex_sheet(F.col("x"))) == ["Female", "Male", "Male", "Male"]
    assert column(spark, ["*", "x", None], X.flag_text(F.col("x"), "*")) == ["TRUE", "FALSE", "FALSE"]
    assert column(spark, ["Numerator", None], X.flag(F.col("x"), "Numerator")) == [1, 0]
    assert column(spark, ["A Capitated", "CCS", "B"], X.special_member(F.col("x"))) == [0, 0, 1]


def test_null_tokens(spark):
    values = ["Null", "null", "NA", "", "Ann"]
    assert column(spark, values, X.null_tokens(F.col("x"))) == ["Null", None, None, None, "Ann"]
    assert column(spark, values, X.null_tokens(F.col("x"), [""])) == ["Null", "null", "NA", None, "Ann"]


def test_dates(spark):
    got = column(spark, ["02/28/1990", "1990-02-28", "", None], D.parse_date(F.col("x")))
    assert got == [dt.date(1990, 2, 28), dt.date(1990, 2, 28), None, None]
    assert column(spark, ["soon"], D.parse_date(F.col("x"), strict=False)) == [None]
    with pytest.raises(Exception, match="not a date: soon"):
        column(spark, ["soon"], D.parse_date(F.col("x")))


def test_periods_from_names(spark):
    names = ["Plan-101_7_April-2024.xls", "May then March 1999.xls", "none.txt"]
    assert column(spark, names, D.month_number(F.col("x"))) == [4, 3, None]
    assert column(spark, names, D.file_year(F.col("x"))) == [2024, 1999, None]
    assert column(spark, names[:1], D.month_abbreviation(D.month_number(F.col("x")))) == ["Apr"]
    assert column(spark, ["AB_04-2024.txt", "AB"], D.name_period(F.col("x"))) == [dt.date(2024, 4, 1), None]
    assert column(spark, ["a_b"], D.name_part(F.col("x"), "_", 5)) == [None]
    key = D.period_key(F.col("x"), F.lit(4), F.lit(2024))
    assert column(spark, ["AB"], key) == ["AB_04-2024"]


def test_age(spark):
    dob = F.to_date("x")
    got = column(spark, ["2000-07-31", "2000-08-01"], D.age(dob, F.lit(dt.date(2024, 7, 31))))
    assert got == [24, 23]


def test_name_tokens(spark):
    got = column(
        spark,
        ["Mary  Ann", "mary", "Mary-Ann Lee Jo Kay", None, ""],
        F.array(*[N.name_token(F.col("x"), i) for i in range(3)]),
    )
    assert got == [
        ["mary", "", "ann"], ["mary", None, None], ["mary-ann", "lee", "jo"], [None] * 3, ["", None, None]
    ]
    assert column(spark, ["Ann ann Lee"], N.name_tokens(F.col("x"))) == [["ann", "lee"]]


def test_names(spark):
    assert column(spark, [" Smith-Jones "], N.normal_name(F.col("x"))) == ["smith jones"]
    assert column(spark, [" Smith-Jones "], N.normal_name(F.col("x"), hyphens=False)) == ["smith-jones"]
    assert column(spark, [None], N.full_name(F.col("x"), F.lit("b"))) == [" b"]


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for ch in a:
        new = [0]
        for j, other in enumerate(b, start=1):
            new.append(max(new[-1], row[j], row[j - 1] + (ch == other)))
        row = new
    return row[-1]


def random_text(rng, longest):
    return "".join(rng.choice("abcdé 名") for _ in range(rng.randint(0, longest)))


def test_similarity_equals_plain_table(spark):
    rng = random.Random(7)
    pairs = [(random_text(rng, 25), random_text(rng, 25)) for _ in range(400)]
    pairs += [(random_text(rng, 90), random_text(rng, 90)) for _ in range(40)]
    pairs += [("x" * 62, "x" * 70), ("ab" * 31, "ba" * 40), ("abc" * 30, "cab" * 30)]
    df = spark.createDataFrame(pairs, "a string, b string")
    df = df.withColumn("masks", N.letter_masks("b"))
    both = N.lcs_length("a", "b"), N.lcs_length_masked("a", "b", "masks")
    for a, b, n, masked in df.select("a", "b", *both).collect():
        assert n == masked == plain_lcs(a, b), (a, b)


def test_exact_85_is_not_above(spark):
    a, b = "abcdefghijklmnopqrst", "abcdefghijklmnopq123"
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(N.similarity("a", "b")).first()[0] == 85.0


def test_cheap_test_never_rejects_a_pair_above_85(spark):
    rng = random.Random(3)
    pairs = []
    for _ in range(600):
        a = "".join(rng.choice("abcd ") for _ in range(rng.randint(1, 30)))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(b) + 1)
            if rng.random() < 0.5 and b:
                del b[min(at, len(b) - 1)]
            else:
                b.insert(at, rng.choice("abcd "))
        pairs.append((a, "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string").where("length(a) + length(b) > 0")
    df = df.withColumns({"sa": N.letter_signature("a"), "sb": N.letter_signature("b")})
    letters = N.letters_allow("sa", "sb", "length(a)", "length(b)")
    rows = df.select(
        N.similarity("a", "b").alias("s"), (letters & N.may_exceed_85("a", "b")).alias("m"), letters.alias("l")
    ).collect()
    assert any(not r.l for r in rows)
    assert any(r.s > 85 for r in rows) and any(not r.m for r in rows)
    assert all(r.m for r in rows if r.s > 85)


def test_dates_without_leading_zeros(spark):
    rows = [("1/5/2020", "2020-01-05"), ("01/05/20", "2020-01-05"), ("12/31/69", "1969-12-31"), ("2/3/68", "2068-02-03"), ("2020-1-5", "2020-01-05"), ("", None)]
    df = spark.createDataFrame(rows, "t string, want string").select("want", D.parse_date(F.col("t")).cast("string").alias("got"))
    assert all(r.want == r.got for r in df.collect())
