"""Data-quality checks.

A check returns its violations as rows, so that it scales with the data and its result can
be written, joined and counted. ``enforce`` turns violations into a hard stop.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from panelspark.functions.dates import name_period
from panelspark.operators.keys import coverage
from panelspark.schemas import Constraints
from panelspark.session import materialize, shared_folder


class CheckFailed(ValueError):
    """A hard stop; the text is the failure step of the audit row."""


def missing_fields(columns: Iterable[str], expected: Sequence[str]) -> list[str]:
    present = set(columns)
    return [name for name in expected if name not in present]


def joined_values(values: DataFrame, column: str) -> str | None:
    """Distinct values of a column joined by `` & ``, None where there are none.

    For sets that a map bounds, such as its keys without a row. Open sets go to ``stored_values``.
    """
    found = [row.v for row in values.select(F.col(column).cast("string").alias("v")).distinct().collect()]
    return " & ".join(sorted(str(v) for v in found)) if found else None


def stored_values(values: DataFrame, column: str) -> str | None:
    """Write the distinct values to a table, whole; its count and path for a message, None where there are none."""
    folder = shared_folder(values.sparkSession, "violations")
    values.select(column).distinct().write.parquet(folder)
    n = values.sparkSession.read.parquet(folder).count()
    return f"{n} in {folder}" if n else None


def distinct_text(df: DataFrame, column: str, groups: Sequence[str] = (), sep: str = " & ") -> DataFrame:
    """Distinct values per group as one sorted text, for value sets bounded by a map."""
    values = df.select(*groups, F.col(column).cast("string").alias("_v")).distinct()
    return values.groupBy(*groups).agg(
        F.array_join(F.sort_array(F.collect_list("_v")), sep).alias("message")
    )


def coverage_message(sides: DataFrame, what: str = "df values") -> str | None:
    """Text of a ``coverage`` result, None where both sets are equal.

    Values that the map lacks are an open set: they are written to a table that the text names.
    """
    missing = joined_values(sides.where("side = 'missing'"), "value")
    unmapped = stored_values(sides.where("side = 'unmapped'"), "value")
    parts = [f"{title} {what}: {text}" for title, text in (("Missing", missing), ("Unmapped", unmapped)) if text is not None]
    return " & ".join(parts) or None


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and NULLs of each required column, from one scan."""
    return df.agg(
        F.count("*").alias("row_count"),
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"{c}_nulls") for c in columns],
    )


def length_range(df: DataFrame, column: str) -> DataFrame:
    size = F.length(column)
    return df.agg(F.min(size).alias("min_length"), F.max(size).alias("max_length"))


def bad_id(key: Column, length: int = 10) -> Column:
    """Wrong length, or a number that went through a float."""
    return (F.length(key) != length) | key.contains(".0")


def id_violations(df: DataFrame, key: str, clinics: DataFrame, clinic_key: str) -> DataFrame:
    """Malformed ids with the clinic whose file holds them."""
    bad = df.where(bad_id(F.col(key))).select(key, "clinic_id").distinct()
    return bad.join(clinics.select(F.col("id").alias("clinic_id"), clinic_key), "clinic_id").select(
        key, F.col(clinic_key).alias("clinic")
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def _row_rules(df: DataFrame, rules: Constraints) -> list[Column]:
    """A struct of rule and column for each broken NOT NULL and length rule of a row, else NULL."""
    checks = [(F.col(c).isNull(), "not_null", c) for c in rules.not_null if c in df.columns]
    checks += [
        (F.length(F.col(c)) > n, "max_length", c) for c, n in rules.max_length.items() if c in df.columns
    ]
    checks += [
        (F.length(F.col(c)) != n, "exact_length", c)
        for c, n in rules.exact_length.items()
        if c in df.columns
    ]
    return [
        F.when(test, F.struct(F.lit(rule).alias("rule"), F.lit(column).alias("column_name")))
        for test, rule, column in checks
    ]


def _key_text(rules: Constraints) -> Column:
    return F.concat_ws("|", *[F.col(c).cast("string") for c in rules.key])


def row_violations(df: DataFrame, rules: Constraints) -> DataFrame:
    """Broken NOT NULL and length rules as ``(rule, column_name, key_value)`` rows.

    All rules are tested in the same scan, without a shuffle.
    """
    return (
        df.select(_key_text(rules).alias("key_value"), F.explode(F.array_compact(F.array(*_row_rules(df, rules)))).alias("v"))
        .select("v.rule", "v.column_name", "key_value")
    )


def constraint_violations(
    df: DataFrame, rules: Constraints, references: dict[str, tuple[DataFrame, str]] | None = None
) -> DataFrame:
    """Primary key, foreign key, NOT NULL and length rules of a staging table.

    The table is read once. Each row gives its broken rules, its key and its references; all are counted
    by one aggregate, which combines on the map side, so that a reference costs a row per
    value and map task. Keys that occur once and references that are known drop out behind it.
    """
    def fact(rule: Column | str, column: Column | str, value: Column, identity: Column | None = None) -> Column:
        rule, column = (F.lit(x) if isinstance(x, str) else x for x in (rule, column))
        identity = F.lit(None) if identity is None else identity
        return F.struct(
            rule.alias("rule"), column.alias("column_name"), value.alias("key_value"), identity.cast("array<string>").alias("identity"))

    key = _key_text(rules)
    facts = [F.when(r.isNotNull(), fact(r["rule"], r["column_name"], key)) for r in _row_rules(df, rules)]
    facts.append(fact("primary_key", ",".join(rules.key), key, F.array(*[F.col(c).cast("string") for c in rules.key])))
    facts += [F.when(F.col(c).isNotNull(), fact("foreign_key", c, F.col(c).cast("string"))) for c in references or {}]
    name = ["rule", "column_name", "key_value"]
    counted = df.select(F.inline(F.array_compact(F.array(*facts)))).groupBy(*name, "identity").agg(F.count("*").alias("n"))
    counted = counted.where((F.col("rule") != "primary_key") | (F.col("n") > 1))
    known = [
        table.select(F.lit("foreign_key").alias("rule"), F.lit(column).alias("column_name"), F.col(target).cast("string").alias("key_value"))
        for column, (table, target) in (references or {}).items()
    ]
    if known:
        counted = counted.join(reduce(DataFrame.unionAll, known).dropna().distinct(), name, "left_anti")
    # A broken row rule counts for each row, a repeated key or an unknown reference once.
    times = F.when(F.col("rule").isin("primary_key", "foreign_key"), F.lit(1)).otherwise(F.col("n").cast("int"))
    return counted.select(*name, F.explode(F.array_repeat(F.lit(0), times)).alias("_time")).drop("_time")


def row_counts(**frames: DataFrame) -> DataFrame:
    """One row per frame name with its number of rows."""
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("stage"), "row_count") for name, df in frames.items()]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


def staged(df: DataFrame, name: str) -> DataFrame:
    """Store staged rows, and stop unless as many are read back as were produced.

    The rows are counted while they are written, so the source is read once.
    """
    produced = Observation(name)
    stored = materialize(df.observe(produced, F.count(F.lit(1)).alias("rows")), name)
    if produced.get["rows"] != stored.count():
        raise CheckFailed("Rows were lost or doubled while staging the file")
    return stored


def period_status(files: DataFrame, name: str, as_of: dt.date) -> DataFrame:
    """Do all file names carry one month? Another month than the current is only noted."""
    period = name_period(F.col(name))
    months = files.agg(F.count_distinct(period).alias("periods"), F.max(period).alias("_last"))
    current = F.lit(as_of.replace(day=1))
    single = F.col("periods") == 1
    return months.select(
        "periods",
        single.cast("int").alias("is_valid"),
        F.when(single, F.year("_last")).alias("file_year"),
        F.when(single, F.month("_last")).alias("file_month"),
        F.when(F.col("periods") == 0, "no month")
        .when(F.col("periods") > 1, "several months")
        .when(F.col("_last") == current, "current month")
        .otherwise("other month")
        .alias("status"),
    )


def file_coverage(
    files: DataFrame, site: Column, clinics: DataFrame, clinic_key: str
) -> DataFrame:
    """Active clinics without a file, and files of unknown clinics."""
    return coverage(files.select(site.alias("site")), "site", clinics.where("is_active = 1"), clinic_key)


def new_data_due(last_file: Column, published: Column, as_of: Column, first_day: int = 10) -> Column:
    """Fetch only after day ``first_day``, and only what was published since the last file."""
    return (F.dayofmonth(as_of) >= first_day) & F.coalesce(published > last_file, F.lit(False))


def enforce(violations: DataFrame, message: str, column: str) -> None:
    """Stop if there is any violation, an empty text included; the message names the table that holds them."""
    found = stored_values(violations, column)
    if found:
        raise CheckFailed(f"{message}: {found}")
