"""Raw encounter records.

``read_encounters`` takes a header CSV as it comes. ``scan_encounters`` keeps
account of every line: columns are found by the names in each file's own header,
in whatever order it has them, and lines that do not fit are set apart with a
reason instead of turning into NULLs.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

_INT = T.IntegerType()
_STR = T.StringType()
_LONG = T.LongType()

# Columns the pipeline reads, with the types their use implies. Other
# columns of the file are read as strings.
ENCOUNTER_SCHEMA = T.StructType([
    T.StructField("encounter_id", _LONG), T.StructField("patient_nbr", _LONG),
    T.StructField("race", _STR), T.StructField("gender", _STR), T.StructField("age", _STR),
    T.StructField("weight", _STR),
    T.StructField("admission_type_id", _INT), T.StructField("discharge_disposition_id", _INT),
    T.StructField("admission_source_id", _INT), T.StructField("time_in_hospital", _INT),
    T.StructField("payer_code", _STR), T.StructField("medical_specialty", _STR),
    T.StructField("num_lab_procedures", _INT), T.StructField("num_procedures", _INT),
    T.StructField("num_medications", _INT), T.StructField("number_outpatient", _INT),
    T.StructField("number_emergency", _INT), T.StructField("number_inpatient", _INT),
    T.StructField("diag_1", _STR), T.StructField("diag_2", _STR), T.StructField("diag_3", _STR),
    T.StructField("number_diagnoses", _INT), T.StructField("readmitted", _STR),
])


def read_encounters(spark: SparkSession, path: str, schema: T.StructType | None = None,
                    header: bool = True) -> DataFrame:
    """Header CSV of encounters with an explicit schema (no inference pass).

    With ``schema=None`` the header decides the columns: known columns get
    their type, every other column is read as a string.
    """
    if schema is None:
        names = spark.read.option("header", header).csv(path).columns
        known = {f.name: f for f in ENCOUNTER_SCHEMA.fields}
        schema = T.StructType([known.get(n, T.StructField(n, _STR)) for n in names])
    return (spark.read.schema(schema).option("header", header)
            .option("mode", "PERMISSIVE").csv(path))


REJECT_COLS = ["file", "line", "reason"]
_BAD = "_ws_bad"


def scan_encounters(spark: SparkSession, path: str, required: tuple[str, ...] = tuple(
        f.name for f in ENCOUNTER_SCHEMA.fields)) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) of the header CSV files under ``path``.

    ``kept`` has the required columns, typed. ``rejected`` has file, line and
    reason: ``malformed`` for a line with a value that does not fit its type or
    with too few or many fields, ``header lacks ...`` for all lines of a file whose
    header misses a column. Kept and rejected lines are all lines but headers
    and blank ones. A header is a line that names the first required column.
    Files of one layout are read together; layouts are few.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    names = F.split(F.regexp_replace(F.trim("value"), "[\"\ufeff]", ""), r"\s*,\s*")
    headers = materialize(lines.where(F.array_contains(names, required[0])).groupBy("file").agg(
        F.min("value").alias("header")), "headers")
    layouts = [r["header"] for r in headers.select("header").distinct().collect()]  # layouts, not lines
    known = {f.name: f for f in ENCOUNTER_SCHEMA.fields}
    kept, rejected = [], []
    for header in layouts:
        columns = [c.strip().lstrip("\ufeff") for c in next(csv.reader([header]))]
        files = [r["file"] for r in headers.where(F.col("header") == header).select("file").collect()]
        lacking = [c for c in required if c not in columns]
        if lacking:
            rejected.append(spark.read.text(files).where((F.col("value") != header) & (F.trim("value") != "")).select(
                F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"),
                F.lit("header lacks " + ", ".join(lacking)).alias("reason")))
            continue
        schema = T.StructType([known.get(c, T.StructField(c, _STR)) for c in columns] + [T.StructField(_BAD, _STR)])
        rows = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE") \
            .option("columnNameOfCorruptRecord", _BAD).csv(files) \
            .select(F.col("_metadata.file_path").alias("_ws_file"), *columns, _BAD)
        # written with all columns: a pruned scan would not look at the others
        rows = materialize(rows, "encounter-scan")
        kept.append(rows.where(F.col(_BAD).isNull()).select(*required))
        rejected.append(rows.where(F.col(_BAD).isNotNull()).select(
            F.col("_ws_file").alias("file"), F.col(_BAD).alias("line"), F.lit("malformed").alias("reason")))
    headless = lines.join(headers.select("file"), "file", "left_anti").where(F.trim("value") != "")
    rejected.append(headless.select("file", F.col("value").alias("line"), F.lit("no header").alias("reason")))
    empty = spark.createDataFrame([], T.StructType([known[c] for c in required]))
    out = kept[0] if kept else empty
    for k in kept[1:]:
        out = out.unionByName(k)
    bad = rejected[0]
    for r in rejected[1:]:
        bad = bad.unionByName(r)
    return out, bad


def count_lines(spark: SparkSession, path: str) -> int:
    """Lines of the files under ``path`` but headers and blank ones."""
    lines = spark.read.text(path)
    names = F.split(F.regexp_replace(F.trim("value"), "[\"\ufeff]", ""), r"\s*,\s*")
    return lines.where((F.trim("value") != "") & ~F.array_contains(names, ENCOUNTER_SCHEMA.fields[0].name)).count()
