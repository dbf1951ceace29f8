"""Readmission marts and the training feature view."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import exact_mean_2dp, exact_pct_2dp


DEPARTMENT_MART = ("department_key", "medical_specialty", (("num_medications", "avg_medications"),))
DIAGNOSIS_MART = ("diagnosis_key", "diag_1_group", (("prior_visits_total", "avg_prior_visits"),))


def mart_sums(extra: Sequence[tuple[str, str]]) -> dict[str, Column]:
    """The whole-number sums that a mart is made of, by name; sums of parts of
    the fact may be summed again."""
    return {"_n": F.count(F.lit(1)), "_r": F.sum("readmitted_30d"), "_los": F.sum("los_days"),
            **{f"_x{i}": F.sum(src) for i, (src, _) in enumerate(extra)}}


def mart_of_sums(per_key: DataFrame, dim: DataFrame, key: str, group: str,
                 extra: Sequence[tuple[str, str]]) -> DataFrame:
    """A mart from sums per key (one or more rows per key)."""
    joined = per_key.join(dim.select(key, group), key, "inner")
    roll = joined.groupBy(group).agg(*[F.sum(c).alias(c) for c in mart_sums(extra)])
    out = roll.select(
        F.col(group),
        F.col("_n").cast("long").alias("n_encounters"),
        F.col("_r").cast("long").alias("n_readmit_30d"),
        exact_pct_2dp(F.col("_r"), F.col("_n")).alias("readmit_rate_pct"),
        exact_mean_2dp(F.col("_los"), F.col("_n")).alias("avg_los_days"),
        *[exact_mean_2dp(F.col(f"_x{i}"), F.col("_n")).alias(name)
          for i, (_, name) in enumerate(extra)])
    return out.orderBy(F.desc("n_encounters"), F.asc(group))


def mart_readmission(fact: DataFrame, dim: DataFrame, key: str, group: str,
                     extra: Sequence[tuple[str, str]] = DEPARTMENT_MART[2]) -> DataFrame:
    """Per ``group``: encounters, 30-day readmissions, rate %, mean LOS, extra means.

    Same result as joining fact to dim and grouping, but the fact is reduced
    to one row per key first (partial aggregation map-side), so only the
    per-key sums meet the dimension: the fact is never shuffled whole.
    Means and the rate are rounded half-up to 2 decimals exactly.
    """
    per_key = fact.groupBy(key).agg(*[c.alias(n) for n, c in mart_sums(extra).items()])
    return mart_of_sums(per_key, dim, key, group, extra)


def mart_by_department(fact: DataFrame, dim_department: DataFrame) -> DataFrame:
    return mart_readmission(fact, dim_department, *DEPARTMENT_MART)


def mart_by_diagnosis(fact: DataFrame, dim_diagnosis: DataFrame) -> DataFrame:
    return mart_readmission(fact, dim_diagnosis, *DIAGNOSIS_MART)


# The model's input columns and their order.
FEATURE_NUMERIC = ["los_days", "num_lab_procedures", "num_procedures", "num_medications",
                   "number_diagnoses", "prior_visits_total"]
FEATURE_CATEGORICAL = ["readmit_risk_flag", "race", "gender", "age", "medical_specialty",
                       "diag_1_group", "admission_type_desc"]


def star_features(fact: DataFrame, dim_patient: DataFrame, dim_department: DataFrame,
                  dim_diagnosis: DataFrame) -> DataFrame:
    """Inner star join to the 13 features + target, keyed by encounter.

    The dimensions are written tables, so Spark knows their sizes. The patient
    dimension grows with the data: that join shuffles, on the narrow fact
    projection, before any text column is added; small ones are broadcast.
    """
    f = fact.select("encounter_id", "patient_key", "department_key", "diagnosis_key",
                    *FEATURE_NUMERIC, "readmit_risk_flag", "readmitted_30d")
    f = f.join(dim_patient.select("patient_key", "race", "gender", "age"), "patient_key")
    f = f.join(dim_department.select("department_key", "medical_specialty"), "department_key")
    f = f.join(dim_diagnosis.select("diagnosis_key", "diag_1_group", "admission_type_desc"),
               "diagnosis_key")
    return f.select("encounter_id", *FEATURE_NUMERIC, "readmit_risk_flag", "readmitted_30d",
                    "race", "gender", "age", "medical_specialty", "diag_1_group",
                    "admission_type_desc")


STAR_NAMES = ["fact_admission", "dim_patient", "dim_department", "dim_diagnosis", "dim_date"]


def register_views(spark, curated_dir: str, names=STAR_NAMES, prefix: str = "stg_") -> list[str]:
    """Staging views: one temp view per curated table (identity projection)."""
    out = []
    for n in names:
        spark.read.parquet(f"{curated_dir.rstrip('/')}/{n}").createOrReplaceTempView(f"{prefix}{n}")
        out.append(f"{prefix}{n}")
    return out


def materialize_marts(spark, prefix: str = "stg_", database: str | None = None,
                      path: str | None = None) -> dict[str, str]:
    """Build both marts from the staging views and store them as tables
    (``saveAsTable``) or Parquet folders (``path``)."""
    fact = spark.table(f"{prefix}fact_admission")
    marts = {
        "mart_readmission_by_department":
            mart_by_department(fact, spark.table(f"{prefix}dim_department")),
        "mart_readmission_by_diagnosis":
            mart_by_diagnosis(fact, spark.table(f"{prefix}dim_diagnosis")),
    }
    where = {}
    for name, df in marts.items():
        if path:
            df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")
            where[name] = f"{path.rstrip('/')}/{name}"
        else:
            full = f"{database}.{name}" if database else name
            df.write.mode("overwrite").saveAsTable(full)
            where[name] = full
    return where
