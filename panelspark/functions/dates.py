"""Dates, periods and ages."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# English month names in calendar order.
MONTHS = (
    "January", "February", "March", "April", "May", "June", "July", "August", "September",
    "October", "November", "December",
)

DATE_FORMATS = ("M/d/yyyy", "yyyy-M-d", "yyyy-MM-dd HH:mm:ss", "M/d/yy")


def parse_date(text: Column, formats: Sequence[str] = DATE_FORMATS, strict: bool = True) -> Column:
    """The first format that fits gives the date; empty texts are NULL.

    Months and days may lack their leading zero. Years of two digits from 69 are of the last century.

    With ``strict`` a text that fits no format fails the job instead of becoming NULL.
    """
    value = F.when(text != "", text)
    parsed = F.coalesce(*[_century(F.try_to_timestamp(value, F.lit(f)).cast("date"), f) for f in formats])
    if not strict:
        return parsed
    message = F.concat(F.lit("not a date: "), value)
    return F.when(value.isNotNull() & parsed.isNull(), F.raise_error(message)).otherwise(parsed)


def _century(date: Column, pattern: str) -> Column:
    if "yyyy" in pattern:
        return date
    return F.when(F.year(date) >= 2069, F.add_months(date, -1200)).otherwise(date)


def month_number(text: Column) -> Column:
    """The first full month name, January to December, that occurs in the text."""
    hits = [F.when(text.contains(name), n) for n, name in enumerate(MONTHS, start=1)]
    return F.coalesce(*hits)


def month_abbreviation(month: Column) -> Column:
    return F.get(F.array(*[F.lit(name[:3]) for name in MONTHS]), month - 1)


def file_year(text: Column) -> Column:
    """The four digits ahead of a closing ``.xls``; NULL if there are none."""
    digits = F.regexp_extract(text, r"(\d{4})\.xls$", 1)
    return F.when(digits != "", digits).cast("int")


def name_part(text: Column, delimiter: str, index: int) -> Column:
    """Part ``index`` (from 0, or from -1 backwards) of a delimited name, NULL beyond it."""
    parts = F.split(text, re.escape(delimiter), -1)
    return F.try_element_at(parts, F.lit(index + 1 if index >= 0 else index))


def name_period(file_name: Column) -> Column:
    """First day of the month of a name that ends in ``_MM-YYYY.ext``."""
    suffix = name_part(name_part(file_name, "_", -1), ".", 0)
    return F.try_to_timestamp(suffix, F.lit("MM-yyyy")).cast("date")


def period_key(site: Column, month: Column, year: Column) -> Column:
    return F.format_string("%s_%02d-%d", site, month, year)


def age(dob: Column, as_of: Column) -> Column:
    return F.floor(F.months_between(as_of, dob) / 12).cast("int")


def us_date(day: Column) -> Column:
    return F.date_format(day, "MM/dd/yyyy")
