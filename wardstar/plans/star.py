"""Cleaning and the readmission star schema.

``clean_encounters`` is one plan from raw rows to the cleaned, decoded
encounter table. ``star_tables`` derives the four dimensions and the fact
from it; ``build_star`` materialises the cleaned rows once (a Parquet table
in the shared checkpoint folder), writes the dimensions first and joins the
fact against the written dimensions.

Keys are dense row numbers in natural-key order (see ``with_surrogate_key``),
so two evaluations of a dimension agree and the fact never points at a key
the written dimension lacks.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clean import (EXCLUDED_DISPOSITIONS, NULL_TOKEN_COLUMNS, exclude_values,
                               fill_unknown, null_tokens)
from ..functions.codes import icd9_group, prior_visits, readmit_target, risk_tier
from ..functions.dates import calendar_parts, date_key
from ..operators.keys import first_by, with_surrogate_key
from ..operators.rownum import global_row_number
from ..session import materialize, run_all
from ..sources.lookups import lookup

# Start and span of the interpolated admission dates.
DATE_START = "1999-01-01"
DATE_SPAN_DAYS = 3650

# The tables' columns, as published.
LOOKUP_SPECS = [
    ("admission_type_id", "admission_type_desc"),
    ("discharge_disposition_id", "discharge_disposition_desc"),
    ("admission_source_id", "admission_source_desc"),
]
DIAGNOSIS_COLS = ["diag_1_group", "admission_type_desc", "discharge_disposition_desc",
                  "admission_source_desc"]
FACT_COLS = [
    "encounter_id", "patient_key", "department_key", "diagnosis_key", "date_key", "los_days",
    "num_lab_procedures", "num_procedures", "num_medications", "number_diagnoses",
    "prior_visits_total", "readmit_risk_flag", "readmitted", "readmitted_30d",
    "admission_year", "admission_month",
]


def _literal(values: list, kind: T.DataType) -> Column:
    """An array in the plan. Whole numbers are one literal: an expression per
    value would be made and analysed anew by every later step."""
    if isinstance(kind, T.IntegralType):
        return F.lit(np.array(values, dtype="int64")).cast(T.ArrayType(kind))
    return F.array(*[F.lit(v).cast(kind) for v in values])


def interpolate_dates(df: DataFrame, order_col: str = "encounter_id",
                      start: str = DATE_START, span_days: int = DATE_SPAN_DAYS,
                      out: str = "admission_date", num_partitions: int | None = None) -> DataFrame:
    """Spread rows evenly over ``span_days`` from ``start`` in ``order_col`` order.

    date = start + trunc(row_number / N * span) days; the last row lands on
    exactly ``span_days``. Only the order column is numbered (one narrow range
    shuffle). Its days begin at span_days + 1 values at most; those go into the
    plan as one sorted literal, in which each row finds its day by binary
    search, so the wide rows are not shuffled. Rows of one order value share a
    day; a NULL order value sorts first.
    """
    numbered = global_row_number(df.select(order_col), [order_col], out="_ws_rn",
                                 total_col="_ws_total", num_partitions=num_partitions)
    offset = ((F.col("_ws_rn") / F.col("_ws_total")) * F.lit(span_days)).cast("int")
    begins = numbered.where(F.col(order_col).isNotNull()).groupBy(offset.alias("day")).agg(
        F.min(order_col).alias("lo")).orderBy("day").collect()  # span_days + 1 rows at most
    if not begins:
        return df.withColumn(out, F.to_date(F.lit(start)))
    lows = _literal([r["lo"] for r in begins], df.schema[order_col].dataType)
    days = _literal([r["day"] for r in begins], T.IntegerType())
    steps = [1 << i for i in range(len(begins).bit_length())][::-1]
    at = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda lo, step: F.when(
        F.get(lows, lo + step) <= F.col(order_col), lo + step).otherwise(lo))
    return df.withColumn(out, F.date_add(F.to_date(F.lit(start)), F.get(days, at)))


def decode(df: DataFrame, blocks: DataFrame, specs=LOOKUP_SPECS, fill: str = "Unknown") -> DataFrame:
    """Left-join each lookup block on its id; no match gives ``fill``.

    A block has one row per id (see ``lookup``), so no row is multiplied. Each
    is written first: Spark then broadcasts it, or not, by its real size.
    """
    blocks = materialize(blocks, "lookups")  # parsed once, read by three lookups
    tables = run_all(df.sparkSession, [
        lambda i=i, d=d: materialize(lookup(blocks, i, i, d), i) for i, d in specs])
    for (id_col, _), table in zip(specs, tables):
        df = df.join(table, on=id_col, how="left")
    return df.fillna({desc: fill for _, desc in specs})


def clean_encounters(raw: DataFrame, blocks: DataFrame,
                     excluded_dispositions=EXCLUDED_DISPOSITIONS,
                     num_partitions: int | None = None) -> DataFrame:
    df = raw.drop("weight")
    df = null_tokens(df, NULL_TOKEN_COLUMNS, "?")
    df = fill_unknown(df)
    df = exclude_values(df, "discharge_disposition_id", excluded_dispositions)
    df = interpolate_dates(df, "encounter_id", num_partitions=num_partitions)
    df = df.withColumn("discharge_date", F.date_add("admission_date", F.col("time_in_hospital")))
    df = df.withColumnRenamed("time_in_hospital", "los_days")
    df = df.withColumns({
        "diag_1_group": icd9_group("diag_1"),
        "prior_visits_total": prior_visits(),
    })
    df = df.withColumns({
        "readmit_risk_flag": risk_tier("prior_visits_total", "number_inpatient"),
        "readmitted_30d": readmit_target("readmitted"),
    })
    return decode(df, blocks)


def dim_patient(clean: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """One row per patient; attributes of the earliest encounter."""
    one = first_by(clean, "patient_nbr", "encounter_id", ["race", "gender", "age"])
    return with_surrogate_key(one, ["patient_nbr"], "patient_key", num_partitions)


def dim_department(clean: DataFrame, num_partitions: int | None = None) -> DataFrame:
    d = clean.select("medical_specialty").distinct()
    return with_surrogate_key(d, ["medical_specialty"], "department_key", num_partitions)


def dim_diagnosis(clean: DataFrame, num_partitions: int | None = None) -> DataFrame:
    d = clean.select(*DIAGNOSIS_COLS).distinct()
    return with_surrogate_key(d, DIAGNOSIS_COLS, "diagnosis_key", num_partitions)


def build_calendar(df: DataFrame, lo_col: str = "admission_date",
                   hi_col: str = "discharge_date") -> DataFrame:
    """Every day from min(lo) to max(hi), with calendar parts; no collect.

    The bounds are one global aggregate row; its sequence has one element per
    calendar day, bounded by the date span, not by the row count.
    """
    bounds = df.agg(F.min(lo_col).alias("lo"), F.max(hi_col).alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY")))
                         .alias("full_date"))
    return days.withColumns(calendar_parts("full_date"))


def dim_date(clean: DataFrame) -> DataFrame:
    return build_calendar(clean, "admission_date", "discharge_date").select(
        "full_date", "date_key", "year", "month", "day", "quarter", "day_of_week")


def fact_admission(clean: DataFrame, patients: DataFrame, departments: DataFrame,
                   diagnoses: DataFrame) -> DataFrame:
    """The 16-column fact, one row per cleaned encounter.

    The dimensions are read from their written tables, so Spark knows their
    sizes: the small ones are broadcast, the patient dimension, which grows with
    the data, is joined by a shuffle on ``patient_nbr`` (AQE splits a hot
    patient).
    """
    fact = clean.join(patients.select("patient_nbr", "patient_key"), "patient_nbr", "left")
    fact = fact.join(departments.select("medical_specialty", "department_key"),
                     "medical_specialty", "left")
    fact = fact.join(diagnoses.select(*DIAGNOSIS_COLS, "diagnosis_key"), DIAGNOSIS_COLS, "left")
    fact = fact.withColumns({
        "date_key": date_key("admission_date"),
        "admission_year": F.year("admission_date"),
        "admission_month": F.month("admission_date"),
    })
    return fact.select(*FACT_COLS)


def star_tables(clean: DataFrame, num_partitions: int | None = None) -> dict[str, DataFrame]:
    """Dims (written to the checkpoint folder) and the fact from one cleaned frame."""
    build = {"dim_patient": dim_patient, "dim_department": dim_department, "dim_diagnosis": dim_diagnosis}
    made = run_all(clean.sparkSession, [
        lambda n=n, f=f: materialize(f(clean, num_partitions), n) for n, f in build.items()])
    dims = {**dict(zip(build, made)), "dim_date": dim_date(clean)}
    return {**dims, "fact_admission": fact_admission(
        clean, dims["dim_patient"], dims["dim_department"], dims["dim_diagnosis"])}


def build_star(raw: DataFrame, blocks: DataFrame, out_dir: str,
               num_partitions: int | None = None) -> dict[str, int]:
    """Clean, write the dims, then the fact partitioned by year and month.

    Returns row counts, with a fan-out guard: the fact must have one row per
    raw encounter that the disposition filter keeps, counted before any join.
    """
    from ..sources.sinks import write_star

    spark = raw.sparkSession
    out_dir = out_dir.rstrip("/")
    write_star({"clean": clean_encounters(raw, blocks, num_partitions=num_partitions)}, out_dir)
    clean = spark.read.parquet(f"{out_dir}/clean")
    # the dimensions need nothing of each other
    dims = {"dim_patient": lambda: dim_patient(clean, num_partitions),
            "dim_department": lambda: dim_department(clean, num_partitions),
            "dim_diagnosis": lambda: dim_diagnosis(clean, num_partitions), "dim_date": lambda: dim_date(clean)}
    run_all(spark, [lambda n=n, f=f: write_star({n: f()}, out_dir) for n, f in dims.items()])
    written = {k: spark.read.parquet(f"{out_dir}/{k}") for k in dims}
    fact = fact_admission(clean, written["dim_patient"], written["dim_department"],
                          written["dim_diagnosis"])
    write_star({"fact_admission": fact}, out_dir)
    counts = {k: spark.read.parquet(f"{out_dir}/{k}").count()
              for k in ["fact_admission", *dims]}
    counts["clean"] = clean.count()
    counts["expected"] = kept_encounters(raw).count()
    counts["fanout_ok"] = int(counts["fact_admission"] == counts["clean"] == counts["expected"])
    return counts


def kept_encounters(raw: DataFrame) -> DataFrame:
    """Raw encounters that are not excluded, before any lookup is joined."""
    return exclude_values(raw.select("discharge_disposition_id"), "discharge_disposition_id",
                          EXCLUDED_DISPOSITIONS)
