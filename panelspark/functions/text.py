"""Cleaning of phone numbers, addresses, flags and missing-value texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts a default pandas reader takes for a missing value.
PANDAS_NULLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def null_tokens(text: Column, tokens: Sequence[str] = PANDAS_NULLS) -> Column:
    """Missing-value texts become NULL. Pass ``[""]`` to keep a member called "Null"."""
    return F.when(~text.isin(*tokens), text)


def double_quotes(text: Column) -> Column:
    return F.replace(text, F.lit("'"), F.lit("''"))


def strip(text: Column) -> Column:
    """Strip all Unicode white space, where ``trim`` would strip blanks only."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def phone(number: Column, punctuation: bool = True) -> Column:
    """``ddd-ddd-dddd`` for ten characters, ``ddd-dddd`` for seven, else an empty text.

    With ``punctuation`` every non-word character is dropped first (roster files). Without
    it only the three characters ``\\W+`` themselves are (measures sheets).
    """
    text = F.coalesce(number.cast("string"), F.lit("nan"))
    digits = (
        F.regexp_replace(text, r"(?U)\W+", "")
        if punctuation
        else F.replace(text, F.lit(r"\W+"), F.lit(""))
    )
    ten = F.regexp_replace(digits, r"(?U)(\d{3})(\d{3})(\d{4})", "$1-$2-$3")
    seven = F.regexp_replace(digits, r"(?U)(\d{3})(\d{4})", "$1-$2")
    return (
        F.when(F.length(digits) == 10, ten).when(F.length(digits) == 7, seven).otherwise("")
    )


def address(line1: Column, line2: Column) -> Column:
    """Join two address lines without a separator; placeholders count as empty."""
    first = F.when(line1 == "-$", F.lit("")).otherwise(line1)
    second = F.when(line2.isNull() | (line2 == "-"), F.lit("")).otherwise(line2)
    return double_quotes(strip(F.concat(first, second)))


def full_address(line1: Column, line2: Column, city: Column, state: Column, zip_: Column) -> Column:
    """``address :: city ~ state | zip``; a quote of the address part is doubled twice."""
    blank = F.lit("")
    parts = F.concat(
        address(line1, line2),
        F.lit(" :: "), F.coalesce(city, blank),
        F.lit(" ~ "), F.coalesce(state, blank),
        F.lit(" | "), F.coalesce(zip_, blank),
    )
    return double_quotes(strip(parts))


def sex_roster(code: Column) -> Column:
    return F.when(code == "F", "Female").when(code == "M", "Male").otherwise(code)


def sex_sheet(code: Column) -> Column:
    """Anything but ``F`` is Male here, a missing code too."""
    return F.when(code == "F", "Female").otherwise("Male")


def flag(text: Column, yes: str) -> Column:
    return F.when(text == yes, 1).otherwise(0)


def flag_text(text: Column, yes: str) -> Column:
    return F.when(text == yes, "TRUE").otherwise("FALSE")


def special_member(site: Column) -> Column:
    """0 for sites of the two special rosters, else 1."""
    return F.when(site.contains("Capitated") | site.contains("CCS"), 0).otherwise(1)


def fill_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))
