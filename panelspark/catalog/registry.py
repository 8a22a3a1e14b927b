"""Registration of queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.catalog.roles import with_roles

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None, roles: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: portable(function(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_roles(sql, *roles)
        return function

    return add


def portable(df: DataFrame) -> DataFrame:
    """Types that compare alike in both engines: days as texts, flags as integers."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.BooleanType):
            column = column.cast("int")
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        columns.append(column.alias(field.name))
    return df.select(*columns)
