"""Rows of HTML tables, from whole documents or from files cut at row ends."""

from __future__ import annotations

from collections.abc import Sequence
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions.text import PANDAS_NULLS, null_tokens, strip
from panelspark.session import broadcast_if_small, materialize
from panelspark.sources.files import with_provenance

REFERENCE = r"&(?:#\d{1,8}|#[xX][0-9a-fA-F]{1,7}|[A-Za-z][A-Za-z0-9]*);"
NAMED = name2codepoint | {"apos": ord("'")}


def referenced(reference: Column) -> Column:
    """The character of a reference: a blank for the no-break space, U+FFFD for no code point, unknown names raw."""
    name = F.regexp_replace(reference, "[&;]", "")
    named = F.map_from_arrays(F.lit(list(NAMED)), F.lit(list(NAMED.values())))
    code = (
        F.when(name.rlike("^#[0-9]"), F.substring(name, 2, 8).try_cast("int"))
        .when(name.startswith("#"), F.conv(F.substring(name, 3, 7), 16, 10).try_cast("int"))
        .otherwise(F.try_element_at(named, name))
    )
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    known = F.when(valid, code).otherwise(0xFFFD)
    return F.when(code.isNull(), reference).when(code == 160, " ").otherwise(
        F.decode(F.unhex(F.lpad(F.hex(known), 8, "0")), "UTF-32")
    )


def resolved(text: Column) -> Column:
    """Character references resolved once, numbers and names."""
    between, found = F.split(text, REFERENCE, -1), F.regexp_extract_all(text, F.lit(REFERENCE), 0)
    pieces = F.zip_with(between, found, lambda part, r: F.concat(part, F.coalesce(referenced(r), F.lit(""))))
    return F.when(text.contains("&"), F.array_join(pieces, "")).otherwise(text)


def _untagged(cell: Column) -> Column:
    return F.regexp_replace(cell, r"(?s)<[^>]*>", "")


def cell_text(cell: Column) -> Column:
    """Text of a cell: tags dropped, character references resolved, stripped."""
    return strip(resolved(_untagged(cell)))


def cell_texts(row: Column, cell_tag: str = "td|th") -> Column:
    """The cell texts of a row. Only rows that hold a reference are searched for them."""
    cells = F.regexp_extract_all(row, element(cell_tag), 1)
    return F.when(row.contains("&"), F.transform(cells, cell_text)).otherwise(
        F.transform(cells, lambda cell: strip(_untagged(cell))))


def element(tag: str) -> Column:
    """Pattern of an element with its content as group 1; ``tag`` may hold alternatives."""
    return F.lit(rf"(?is)<(?:{tag})(?:\s[^>]*)?>(.*?)</(?:{tag})\s*>")


def html_rows(
    df: DataFrame, html: str, keep: Sequence[str], row_tag: str = "tr", cell_tag: str = "td|th"
) -> DataFrame:
    """One row per ``row_tag`` element with its position and the array of its cell texts."""
    rows = F.regexp_extract_all(F.col(html), element(row_tag), 1)
    cells = cell_texts(F.col("_row"), cell_tag)
    return df.select(*keep, F.posexplode(rows).alias("row_pos", "_row")).select(
        *keep, "row_pos", cells.alias("cells")
    )


def html_table(df: DataFrame, html: str, keep: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """The named fields of the first table of each document, all as texts.

    The first row names the columns, in any order. A field that a document lacks is NULL,
    and so are missing-value texts.
    """
    table = F.regexp_extract(F.col(html), r"(?is)<table(?:\s[^>]*)?>(.*?)</table\s*>", 1)
    header_row = F.regexp_extract(F.col("_table"), r"(?is)<tr(?:\s[^>]*)?>(.*?)</tr\s*>", 1)
    tables = df.select(*keep, table.alias("_table")).withColumn("_header", cell_texts(header_row))
    rows = html_rows(tables, "_table", [*keep, "_header"]).where(F.col("row_pos") > 0)
    return rows.select(*keep, *_named(fields))


def _named(fields: Sequence[str]) -> list[Column]:
    """The cells of a row below the names of its header, NULL for names that it lacks."""
    columns = []
    for field in fields:
        at = F.array_position("_header", F.lit(field)).cast("int")
        columns.append(null_tokens(F.get("cells", at - 1), PANDAS_NULLS).alias(field))
    return columns


def _cut_rows(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """Rows of files cut at row ends: path, block, order within the scan, position within a piece, provenance and cells."""
    pieces = (
        with_provenance(
            spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(path, lineSep="</tr>").select("value", "_metadata"))
        .select(
            F.concat("value", F.lit("</tr>")).alias("value"), F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("_start"), "download_date", "year", "month", F.monotonically_increasing_id().alias("_order"))
    )
    return html_rows(pieces, "value", ["path", "_start", "_order", "download_date", "year", "month"])


def table_headers(spark: SparkSession, path: str, glob: str = "*.xls") -> DataFrame:
    """Path, place and cells of the first row of each file that has one, from its first block."""
    place = F.struct("_order", "row_pos")
    firsts = _cut_rows(spark, path, glob).where("_start = 0").groupBy("path")
    return materialize(firsts.agg(F.min(place).alias("_first"), F.min_by("cells", place).alias("_header")), "table-headers")


def scan_html_tables(spark: SparkSession, path: str, fields: Sequence[str], glob: str = "*.xls") -> DataFrame:
    """Rows of files that hold one table each, with path and provenance, as ``html_table`` gives them.

    The reader cuts files at ``</tr>``, so a large one is read by many tasks. Each file's header is found by a scan
    of its own and joined by path; there are as many as files. A file that writes its tags otherwise is one piece.
    """
    rows, headers = _cut_rows(spark, path, glob), table_headers(spark, path, glob)
    below = (F.col("_start") > 0) | (F.struct("_order", "row_pos") > F.col("_first"))
    return rows.join(broadcast_if_small(headers), "path").where(below).select("path", "download_date", "year", "month", *_named(fields))


def read_html_files(spark: SparkSession, path: str, glob: str = "*.xls") -> DataFrame:
    """Whole files with their path and provenance."""
    reader = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    raw = reader.text(path, wholetext=True)
    return with_provenance(
        raw.select(F.col("value").alias("html"), F.col("_metadata.file_path").alias("path"), "_metadata")
    ).drop("_metadata")
