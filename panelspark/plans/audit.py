"""Audit rows: one per run, on failure too."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from panelspark.sources.runs import Run
from panelspark.sources.tables import append_rows


def audit_row(spark: SparkSession, schema: T.StructType, values: dict, logged_at: dt.datetime) -> DataFrame:
    """One row of a log table; the time has a resolution of one minute."""
    record = {"logged_at": logged_at.replace(second=0, microsecond=0), "is_success": 0, **values}
    return spark.createDataFrame([tuple(record.get(f.name) for f in schema)], schema)


@contextmanager
def audited(spark: SparkSession, table: str, schema: T.StructType, logged_at: dt.datetime) -> Iterator[dict]:
    """Collect the values of an audit row and append it, whether the run succeeds or not."""
    values: dict = {}
    try:
        yield values
        values["is_success"] = 1
    except Exception as error:
        values["failure_step"] = str(error)
        raise
    finally:
        append_rows(audit_row(spark, schema, values, logged_at), table)


@contextmanager
def failure_logged(spark: SparkSession, table: str, schema: T.StructType, logged_at: dt.datetime) -> Iterator[None]:
    """Log what stops the steps ahead of a run."""
    try:
        yield
    except Exception as error:
        append_rows(audit_row(spark, schema, {"failure_step": str(error)}, logged_at), table)
        raise


@contextmanager
def audited_run(
    spark: SparkSession, registry: str, key: str, table: str, schema: T.StructType, logged_at: dt.datetime
) -> Iterator[tuple[Run, dict]]:
    """A run and the values of its audit row.

    A run that succeeds publishes its outputs and its audit row together. One that fails publishes
    nothing but the row that says so.
    """
    run = Run(spark, registry, key)
    values: dict = {}
    try:
        yield run, values
        run.log(audit_row(spark, schema, {**values, "is_success": 1}, logged_at), table)
        run.commit()
    except Exception as error:
        append_rows(audit_row(spark, schema, {**values, "failure_step": str(error)}, logged_at), table)
        raise
