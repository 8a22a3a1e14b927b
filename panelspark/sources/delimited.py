"""Processed roster files: ``%``-delimited text, one set per site and month."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions.dates import parse_date
from panelspark.functions.text import flag, null_tokens
from panelspark.schemas import PROCESSED_TO_MEMBERSHIP
from panelspark.session import broadcast_if_small, materialize

SEPARATOR = "%"
MAX_COLUMNS = 64


def write_roster(df: DataFrame, folder: str, period: str = "period", mode: str = "error") -> None:
    """Write processed rows as ``period=<site>_<MM-YYYY>/part-*`` files with a header.

    Rows are rebalanced by period: one file for most, several for a large site.
    """
    columns = [c for c in df.columns if c != period]
    (
        df.select(*columns, period)
        .hint("rebalance", period)
        .write.mode(mode)
        .partitionBy(period)
        .option("sep", SEPARATOR)
        .option("header", True)
        .option("escape", '"')
        .option("dateFormat", "yyyy-MM-dd")
        .csv(folder)
    )


def read_processed(spark: SparkSession, folder: str) -> DataFrame:
    """The columns of processed files that the membership uses, as texts, files united.

    Columns are found by their name in each file's first line, in any order and beside others. A
    file without one of them fails the job. Files have MAX_COLUMNS columns at most.
    """
    names = [f"c{i}" for i in range(MAX_COLUMNS)]
    rows = (
        spark.read.schema(", ".join(f"{name} STRING" for name in names))
        .option("sep", SEPARATOR)
        .option("escape", '"')
        .option("recursiveFileLookup", "true")
        .csv(folder)
        .select(
            F.array(*names).alias("_cells"),
            F.col("_metadata.file_path").alias("_path"),
            F.col("_metadata.file_block_start").alias("_start"),
        )
    )
    firsts = rows.withColumn("_order", F.monotonically_increasing_id()).where("_start = 0")
    firsts = firsts.groupBy("_path").agg(F.min_by("_cells", "_order").alias("_header"))
    places = [F.coalesce(F.array_position("_header", name), F.lit(0)).cast("int").alias(name) for name in PROCESSED_TO_MEMBERSHIP]
    headers = materialize(firsts.select("_path", "_header", F.struct(*places).alias("_at")), "roster-headers")
    placed = rows.join(broadcast_if_small(headers), "_path").where(F.col("_cells") != F.col("_header"))
    fields = [
        F.when(F.col("_at")[name] == 0, F.raise_error(F.concat(F.lit(f"no column {name} in "), "_path")).cast("string"))
        .otherwise(F.get("_cells", F.col("_at")[name] - 1)).alias(name)
        for name in PROCESSED_TO_MEMBERSHIP
    ]
    return placed.select(*fields)


def staged_roster(raw: DataFrame) -> DataFrame:
    """Canonical names and types; ``clinic_text`` is the site text, still to be mapped."""
    df = raw.withColumnsRenamed({**PROCESSED_TO_MEMBERSHIP, "Clinic": "clinic_text"})
    texts = [c for c in df.columns if c != "clinic_text"]
    df = df.withColumns({c: null_tokens(F.col(c)) for c in texts})
    return df.withColumns(
        {
            "first_name": F.coalesce("first_name", F.lit("")),
            "dob": parse_date(F.col("dob")),
            "eff_date": parse_date(F.col("eff_date")),
            "end_date": parse_date(F.col("end_date")),
            "download_date": parse_date(F.col("download_date")),
            "new_member": F.when(F.col("new_member").isNotNull(), flag(F.upper("new_member"), "TRUE")),
            "is_enrolled": F.expr("try_cast(is_enrolled AS INT)"),
        }
    )
