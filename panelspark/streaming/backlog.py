"""Backlog of measures sheets: one per micro-batch, or several at a time, oldest first, until none is left."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.plans.measures_file import MeasureTables, Sheet, run_measures_sheets
from panelspark.session import materialize
from panelspark.sources.files import file_name
from panelspark.sources.sheets import read_sheets, sheet_rows, staged_measures

#: What a handler gets: the staged rows, the id of the query (one for each checkpoint) and the id of the batch.
Handler = Callable[[DataFrame, str, int], None]


def run_backlog(
    spark: SparkSession,
    folder: str,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    per_batch: int = 1,
) -> None:
    """Hand the staged rows of each waiting sheet to ``handle`` and stop.

    The checkpoint remembers the sheets that are done; a sheet whose batch failed, or whose end was not
    recorded, comes again with the same batch id. So ``handle`` should replace what that id wrote before.
    """
    _run(spark, folder, lambda batch, query_id, batch_id: handle(batch, batch_id), checkpoint, per_batch)


def _run(spark: SparkSession, folder: str, handle: Handler, checkpoint: str, per_batch: int) -> None:
    sheets = read_sheets(spark, folder, stream=True, per_batch=per_batch)

    def take(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        handle(batch, query_id, batch_id)

    query = (
        staged_measures(sheet_rows(sheets))
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def upload_backlog(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    clinics: DataFrame,
    measures_map: DataFrame,
    stored: MeasureTables,
    clock: Callable[[], dt.datetime] = lambda: dt.datetime.now(dt.UTC).replace(tzinfo=None),
    after: Callable[[str, dt.date], None] = lambda path, download_date: None,
    per_batch: int = 1,
) -> None:
    """Upload all waiting sheets, oldest first; a sheet that fails stops the backlog and stays first in it.

    An upload is keyed by query, batch and file, and all of it is published at once. So each sheet counts exactly
    once: a batch that comes again, after a crash between its publication and the stream's own
    record of it, replaces what it wrote. Sheets of one micro-batch share a run where they can, with the
    same result, so that membership and history are read once for up to ``per_batch`` sheets. ``after`` is called for each sheet that is published, to archive
    it, and may be called again for the same one.
    """

    def upload(batch: DataFrame, query_id: str, batch_id: int) -> None:
        rows = materialize(batch, "backlog-batch")
        files = rows.select("path", "download_date", "modified_at", file_name(F.col("path")).alias("name")).distinct()
        sheets = [
            Sheet(f.path, f.name, f.download_date, f"backlog {query_id} {batch_id} {f.path}")
            for f in files.orderBy("modified_at", "path").collect()  # per_batch files at most
        ]
        for sheet in run_measures_sheets(spark, rows.drop("modified_at"), sheets, clinics, measures_map, stored, clock):
            after(sheet.path, sheet.download_date)

    _run(spark, folder, upload, checkpoint, per_batch)
