"""Stacked lookup files: several id -> description blocks in one CSV.

A block starts at a row whose second cell is ``description`` (any case); its
first cell names the block. Rows with only blank cells are skipped, cells are
trimmed, quoted commas are honoured, and rows before the first header belong
to no block. Parsing stays in the plan: lines are numbered with
``posexplode`` and each line takes the last header above it with a window per
file, so nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_stacked_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value) for every line of every file under ``path``.

    A lookup file is read whole so line order is kept; such files are small.
    """
    files = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.col("value"))
    return files.select("file", F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "value"))


def parse_stacked_lookups(lines: DataFrame) -> DataFrame:
    """(file, line_no, value) -> (block, id, description, file, line_no).

    Cells are trimmed of all white space; a doubled quote inside a quoted cell
    is a quote.
    """
    cells = lines.select(
        "file", "line_no",
        F.from_csv(F.col("value"), "c0 STRING, c1 STRING", {"escape": '"'}).alias("r"))
    cells = cells.select("file", "line_no", _stripped("r.c0").alias("c0"),
                         _stripped("r.c1").alias("c1"))
    cells = cells.filter((F.col("c0") != "") | (F.col("c1") != ""))
    is_header = F.lower(F.col("c1")) == "description"
    upto = Window.partitionBy("file").orderBy("line_no").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    tagged = cells.withColumn("_hdr", F.when(is_header, F.col("c0"))) \
        .withColumn("block", F.last("_hdr", ignorenulls=True).over(upto))
    return (tagged.filter(F.col("block").isNotNull() & ~is_header)
            .select("block", F.col("c0").alias("id"), F.col("c1").alias("description"),
                    "file", "line_no"))


def _stripped(cell: str) -> Column:
    return F.regexp_replace(F.coalesce(F.col(cell), F.lit("")), r"^\s+|\s+$", "")


def lookup(blocks: DataFrame, block: str, id_col: str | None = None,
           desc_col: str | None = None) -> DataFrame:
    """One block as (id int, description); rows whose id is not all digits are
    dropped. Of an id listed more than once the first row counts (by file, then
    line), so a decode never multiplies rows."""
    id_col = id_col or block
    desc_col = desc_col or block.replace("_id", "_desc")
    rows = blocks.filter((F.col("block") == block) & F.col("id").rlike("^[0-9]+$"))
    return rows.groupBy(F.col("id").try_cast("int").alias(id_col)).agg(
        F.min_by("description", F.struct("file", "line_no")).alias(desc_col))
