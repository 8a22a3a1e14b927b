"""Measures sheets: delimited text with one line above the header.

A sheet of a stream is one upload of at most 1,048,576 rows and is read as one text. Folders of
sheets are read line by line, so that large ones are split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.functions.dates import parse_date
from panelspark.functions.text import double_quotes, flag, null_tokens, phone, sex_sheet
from panelspark.schemas import SHEET_TO_MEASURES
from panelspark.session import broadcast_if_small, materialize
from panelspark.sources.files import with_provenance

MAX_COLUMNS = 64
SHEET_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in SHEET_TO_MEASURES])


def read_sheets(spark: SparkSession, folder: str, stream: bool = False, per_batch: int = 1) -> DataFrame:
    """Whole sheets, in batch or as a stream of ``per_batch`` files at a time, oldest first, with their time ``modified_at``."""
    reader = spark.readStream if stream else spark.read
    reader = reader.format("text").option("wholetext", True).option("recursiveFileLookup", "true")
    if stream:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    raw = reader.load(folder)
    modified = [F.col("_metadata.file_modification_time").alias("modified_at")] if stream else []
    return with_provenance(
        raw.select("value", F.col("_metadata.file_path").alias("path"), *modified, "_metadata")
    ).drop("_metadata")


def _cells(line: Column, sep: str) -> Column:
    ddl = ", ".join(f"c{i} STRING" for i in range(MAX_COLUMNS))
    parsed = F.from_csv(line, F.lit(ddl), {"sep": sep, "escape": '"'})
    return F.array(*[parsed[f"c{i}"] for i in range(MAX_COLUMNS)])


def _places(header: Column) -> Column:
    """Where a header names each field, 0 where it does not."""
    names = F.transform(header, lambda name: F.trim(name))
    return F.struct(*[F.coalesce(F.array_position(names, f.name), F.lit(0)).alias(f.name) for f in SHEET_SCHEMA])


def _fields() -> list[Column]:
    """The fields of a row's ``_cells`` at its sheet's places ``_at``."""
    return [
        F.when(F.col("_at")[f.name] == 0, F.raise_error(F.lit(f"a sheet lacks the column {f.name}")).cast("string"))
        .otherwise(F.get("_cells", (F.col("_at")[f.name] - 1).cast("int"))).alias(f.name)
        for f in SHEET_SCHEMA
    ]


def sheet_rows(files: DataFrame, header_line: int = 1, sep: str = ",") -> DataFrame:
    """Data rows below the header line (0 is the first line) as text columns.

    Columns are found by their name in each sheet's header, in any order and beside others. A
    sheet without one of the fields fails the job. Sheets have MAX_COLUMNS columns at most.
    """
    keep = [c for c in files.columns if c != "value"]
    lines = files.withColumn("_lines", F.split("value", "\r?\n"))
    header = _cells(F.get("_lines", F.lit(header_line)), sep)
    placed = lines.select(*keep, "_lines", _places(header).alias("_at"))
    rows = placed.select(*keep, "_at", F.posexplode("_lines").alias("_pos", "_line"))
    rows = rows.where((F.col("_pos") > header_line) & (F.col("_line") != "")).select(*keep, "_at", _cells(F.col("_line"), sep).alias("_cells"))
    return rows.select(*keep, *_fields())


def scan_sheets(spark: SparkSession, folder: str, header_line: int = 1, sep: str = ",", glob: str = "*") -> DataFrame:
    """Rows of all sheets of a folder with path and provenance, as ``sheet_rows`` gives them.

    Lines are read one by one, so a sheet of any size is read by many tasks. Each sheet's header, a line of its
    first block, is found by a scan of its own and joined by path; there are as many as sheets.
    """
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(folder)
    lines = with_provenance(raw.select("value", "_metadata")).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_start"),
        "download_date", "year", "month", F.monotonically_increasing_id().alias("_order"))
    number = F.row_number().over(Window.partitionBy("path").orderBy("_order"))
    top = lines.where("_start = 0").withColumn("_line", number).where(F.col("_line") == header_line + 1)
    headers = materialize(
        top.select("path", F.col("_order").alias("_header"), _places(_cells(F.col("value"), sep)).alias("_at")), "sheet-headers")
    below = (F.col("_start") > 0) | (F.col("_order") > F.col("_header"))
    rows = lines.where(F.col("value") != "").join(broadcast_if_small(headers), "path").where(below)
    keep = ["path", "download_date", "year", "month"]
    return rows.select(*keep, "_at", _cells(F.col("value"), sep).alias("_cells")).select(*keep, *_fields())


def staged_measures(rows: DataFrame) -> DataFrame:
    """Converted sheet rows. ``clinic_text`` and ``measure_text`` are still to be mapped.

    Missing-value texts become NULL after the conversion, so a phone number that fits no
    format ends as NULL.
    """
    df = rows.withColumnsRenamed(
        {**SHEET_TO_MEASURES, "PCP": "clinic_text", "Measure Name": "measure_text"}
    )
    texts = {
        "first_name": F.coalesce(null_tokens(double_quotes(F.col("first_name"))), F.lit("")),
        "last_name": null_tokens(double_quotes(F.col("last_name"))),
        "phone_number": null_tokens(phone(F.col("phone_number"), punctuation=False)),
        "cin": null_tokens(F.col("cin")),
    }
    return df.withColumns(texts).withColumns(
        {
            "dob": parse_date(F.col("dob")),
            "age": F.expr("try_cast(age AS INT)"),
            "sex": sex_sheet(F.col("sex")),
            "new_member": flag(F.col("new_member"), "Y"),
            "is_compliant": flag(F.col("is_compliant"), "Numerator"),
        }
    )
