"""Data-quality checks on star tables.

Every check returns one summary row ``(check_name, table_name, column_name,
failures, passed)``; ``run_checks`` unions a list of them. Failures follow
the usual warehouse test conventions: ``unique`` counts duplicated values
(NULLs ignored), ``not_null`` counts NULL rows, ``relationships`` counts child
rows whose non-NULL key is missing in the parent, ``accepted_values`` counts
distinct non-NULL values outside the list.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT_COLS = ["check_name", "table_name", "column_name", "failures", "passed"]

# Minimum row counts of the health check, for the full data set.
ROW_FLOORS = {
    "fact_admission": 90000, "dim_patient": 60000, "dim_department": 50,
    "dim_diagnosis": 1000, "dim_date": 1000, "stg_fact_admission": 90000,
    "mart_readmission_by_department": 10, "mart_readmission_by_diagnosis": 5,
    "snapshot_dim_patient": 60000,
}
# Accepted band of the 30-day readmission rate, in percent.
RATE_BAND = (5.0, 20.0)


def result_row(check: str, table: str, column: str, failures: Column) -> list[Column]:
    f = failures.cast("long")
    return [F.lit(check).alias("check_name"), F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"), f.alias("failures"), (f == 0).alias("passed")]


def _names(cols: Sequence[str] | str) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def check_unique(df: DataFrame, table: str, cols: Sequence[str] | str) -> DataFrame:
    """Number of key values that occur more than once (rows with a NULL key part skipped)."""
    c = _names(cols)
    keyed = df.select(*c).dropna(how="any")
    dups = keyed.groupBy(*c).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return dups.agg(*result_row("unique", table, ",".join(c), F.count(F.lit(1))))


def check_key(df: DataFrame, table: str, col: str) -> DataFrame:
    """``unique`` and ``not_null`` of one key column from a single aggregation.

    Rows are counted per key value (partial aggregation map-side); the NULL
    group gives the not-null failures, groups above one the duplicates.
    """
    per = df.groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    agg = per.agg(F.count_if(F.col(col).isNotNull() & (F.col("_n") > 1)).alias("_dup"),
                  F.coalesce(F.sum(F.when(F.col(col).isNull(), F.col("_n"))), F.lit(0))
                  .alias("_null"))
    return agg.select(F.inline(F.array(
        F.struct(*result_row("unique", table, col, F.col("_dup"))),
        F.struct(*result_row("not_null", table, col, F.col("_null"))))))


def check_not_null(df: DataFrame, table: str, col: str) -> DataFrame:
    return df.agg(*result_row("not_null", table, col, F.count_if(F.col(col).isNull())))


def check_relationships(child: DataFrame, table: str, col: str, parent: DataFrame,
                        parent_col: str) -> DataFrame:
    """Child rows whose key is not NULL and absent from the parent (anti join).

    Child rows are first counted per key (partial aggregation map-side), so
    when the parent must be shuffled the anti join moves one row per distinct
    key, not one per child row, and a hot key is collapsed before the
    shuffle. When the parent can be broadcast, the optimizer instead filters
    the child rows first and nothing is shuffled.
    """
    keys = parent.select(F.col(parent_col).alias(col))
    per_key = child.filter(F.col(col).isNotNull()).groupBy(col).agg(
        F.count(F.lit(1)).alias("_n"))
    orphans = per_key.join(keys, col, "left_anti")
    return orphans.agg(*result_row("relationships", table, col,
                             F.coalesce(F.sum("_n"), F.lit(0))))


def check_accepted_values(df: DataFrame, table: str, col: str, values: Iterable) -> DataFrame:
    bad = df.select(col).filter(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))
    return bad.agg(*result_row("accepted_values", table, col, F.count_distinct(F.col(col))))


def check_row_floor(df: DataFrame, table: str, min_rows: int) -> DataFrame:
    """Fails (1) when the table has fewer than ``min_rows`` rows."""
    n = F.count(F.lit(1))
    return df.agg(*result_row("row_floor", table, f">={min_rows}",
                        F.when(n >= min_rows, 0).otherwise(1)),
                  n.alias("n_rows"))


def check_rate_band(df: DataFrame, table: str, col: str = "readmitted_30d",
                    band: tuple[float, float] = RATE_BAND) -> DataFrame:
    """Mean of a 0/1 column, in percent, must lie inside ``band``."""
    pct = F.avg(F.col(col).cast("double")) * F.lit(100.0)
    ok = pct.isNotNull() & (pct >= band[0]) & (pct <= band[1])
    return df.agg(*result_row("rate_band", table, col, F.when(ok, 0).otherwise(1)),
                  pct.alias("rate_pct"))


def check_fanout(fact: DataFrame, clean: DataFrame, table: str = "fact_admission") -> DataFrame:
    """Absolute difference between fact rows and cleaned rows (0 = no fan-out)."""
    n_clean = clean.select(F.count(F.lit(1))).scalar()
    return fact.agg(*result_row("fanout", table, "*", F.abs(F.count(F.lit(1)) - n_clean)))


def check_fanout_count(fact: DataFrame, expected: int, table: str = "fact_admission") -> DataFrame:
    """As ``check_fanout``, against a count taken before any join."""
    return fact.agg(*result_row("fanout", table, "*", F.abs(F.count(F.lit(1)) - F.lit(expected))))


def check_rejects(rejected: DataFrame, table: str, n_lines: int, kept: DataFrame,
                  most_percent: float = 1.0) -> DataFrame:
    """Rejected lines of a scan: they and the kept rows must be all lines, and
    at most ``most_percent`` of them."""
    n_kept = kept.select(F.count(F.lit(1))).scalar()
    n = F.count(F.lit(1))
    fine = (n + n_kept == n_lines) & (n * 100.0 <= most_percent * n_lines)
    return rejected.agg(*result_row("rejects", table, f"<={most_percent}%", F.when(fine, 0).otherwise(F.greatest(n, F.lit(1)))),
                        n.alias("n_rejected"))


def run_checks(checks: Sequence[DataFrame]) -> DataFrame:
    out = checks[0].select(*RESULT_COLS)
    for c in checks[1:]:
        out = out.unionByName(c.select(*RESULT_COLS))
    return out


def summarize(results: DataFrame) -> DataFrame:
    """One row: checks run, passed, failed, and the names of failed checks."""
    name = F.concat_ws(":", "check_name", "table_name", "column_name")
    return results.agg(
        F.count(F.lit(1)).alias("n_checks"),
        F.count_if(F.col("passed")).alias("n_passed"),
        F.count_if(~F.col("passed")).alias("n_failed"),
        F.array_join(F.array_sort(F.collect_list(F.when(~F.col("passed"), name))), ",")
        .alias("failed_checks"))


def row_tests(df: DataFrame, table: str, not_null: Sequence[str] = (),
              accepted: dict[str, Iterable] | None = None) -> DataFrame:
    """All not-null and accepted-values tests of one table from one aggregate."""
    accepted = {c: list(v) for c, v in (accepted or {}).items()}
    aggs = [F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(not_null)]
    aggs += [F.count_distinct(F.when(F.col(c).isNotNull() & ~F.col(c).isin(v), F.col(c))).alias(f"_a{i}")
             for i, (c, v) in enumerate(accepted.items())]
    rows = [F.struct(*result_row("not_null", table, c, F.col(f"_n{i}"))) for i, c in enumerate(not_null)]
    rows += [F.struct(*result_row("accepted_values", table, c, F.col(f"_a{i}")))
             for i, c in enumerate(accepted)]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def star_tests(star: dict[str, DataFrame]) -> DataFrame:
    """The 15 integrity tests of the star: unique x5, not_null x6,
    relationships x3, accepted_values x1. Key tests count rows per key, the
    other tests of a table share one aggregate."""
    f = star["fact_admission"]
    checks = []
    for t, k in [("dim_patient", "patient_key"), ("dim_department", "department_key"),
                 ("dim_diagnosis", "diagnosis_key"), ("dim_date", "date_key"),
                 ("fact_admission", "encounter_id")]:
        checks.append(check_key(star[t], t, k))
    for k, t in [("patient_key", "dim_patient"), ("department_key", "dim_department"),
                 ("diagnosis_key", "dim_diagnosis")]:
        checks.append(check_relationships(f, "fact_admission", k, star[t], k))
    checks.append(row_tests(f, "fact_admission", ["patient_key"], {"readmitted_30d": [0, 1]}))
    return run_checks(checks)
