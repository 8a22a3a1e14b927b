"""Set operations on keys.

Both sides are reduced to distinct keys before the join. The reduction combines on the map
side, so a key that holds a large share of the rows costs one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def not_in(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a known key that ``other`` lacks."""
    known = distinct_keys(other.dropna(subset=list(keys)), keys)
    return df.dropna(subset=list(keys)).join(known, list(keys), "left_anti")


def not_in_months(df: DataFrame, history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that a history partitioned by year and month lacks. Only the months of the rows are read from it.

    ``df`` should be stored, since its months are looked up first: a handful of numbers.
    """
    months = df.select("year", "month").dropna().distinct().collect()
    wanted = [(F.col("year") == r.year) & (F.col("month") == r.month) for r in months]
    return not_in(df, history.where(reduce(or_, wanted, F.lit(False))), [*keys, "year", "month"])


def is_in(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(distinct_keys(other, keys), list(keys), "left_semi")


def except_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``left`` without those of ``right``; NULL equals NULL."""
    a = distinct_keys(left, keys)
    b = distinct_keys(right, keys)
    same = [a[k].eqNullSafe(b[k]) for k in keys]
    return a.join(b, same, "left_anti")


def coverage(present: DataFrame, column: str, expected: DataFrame, expected_column: str) -> DataFrame:
    """Two-way difference of two value sets, compared as texts.

    Rows are ``(side, value)``: ``missing`` values are expected but absent, ``unmapped``
    values are present but not expected. No row means the sets are equal.
    """
    have = present.select(F.col(column).cast("string").alias("value"))
    want = expected.select(F.col(expected_column).cast("string").alias("value"))
    return except_keys(want, have, ["value"]).select(F.lit("missing").alias("side"), "value").unionByName(
        except_keys(have, want, ["value"]).select(F.lit("unmapped").alias("side"), "value")
    )
