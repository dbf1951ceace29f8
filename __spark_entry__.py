"""

Every query reads the shared test tables under ``sf_dir`` (or data Spark
derives from them) and runs over whole tables.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from wardstar.functions.clean import exclude_values, fill_unknown, null_tokens  # noqa: E402
from wardstar.functions.codes import icd9_group, prior_visits, readmit_target, risk_tier  # noqa: E402
from wardstar.plans import inputs  # noqa: E402
from wardstar.session import materialize, scratch_path  # noqa: E402
from wardstar.sources.fixtures import LOOKUP_ODD_LINES, encounter_exprs  # noqa: E402
from wardstar.plans import sql_twins as tw  # noqa: E402
from wardstar.plans.marts import (FEATURE_NUMERIC, mart_by_department, mart_by_diagnosis,  # noqa: E402
                                  star_features)
from wardstar.plans.star import interpolate_dates  # noqa: E402

FLAGSHIP_SF = "/root/testdata/sf0.001"

_SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _register(name: str, sql: str | None = None):
    def deco(fn):
        _SPARK[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- cleaning
def _after_fill(spark, sf):
    return fill_unknown(null_tokens(inputs.encounter_raw(spark, sf).drop("weight")))


@_register("null_tokens", tw.with_star(
    "SELECT encounter_id, race, payer_code, medical_specialty, diag_1, diag_2, diag_3 "
    "FROM step_null"))
def q_null_tokens(spark, sf):
    df = null_tokens(inputs.encounter_raw(spark, sf))
    return df.select("encounter_id", "race", "payer_code", "medical_specialty",
                     "diag_1", "diag_2", "diag_3")


@_register("fill_unknown", tw.with_star(
    "SELECT encounter_id, race, payer_code, medical_specialty, diag_1 FROM step_fill"))
def q_fill_unknown(spark, sf):
    return _after_fill(spark, sf).select("encounter_id", "race", "payer_code",
                                         "medical_specialty", "diag_1")


@_register("exclude_dispositions", tw.with_star(
    "SELECT encounter_id, discharge_disposition_id FROM step_excl"))
def q_exclude(spark, sf):
    return exclude_values(_after_fill(spark, sf), "discharge_disposition_id") \
        .select("encounter_id", "discharge_disposition_id")


@_register("interpolated_admission_date", tw.with_star(
    "SELECT encounter_id, admission_date FROM step_dates"))
def q_interp(spark, sf):
    df = exclude_values(_after_fill(spark, sf), "discharge_disposition_id")
    return interpolate_dates(df.select("encounter_id"), "encounter_id")


@_register("discharge_date", tw.with_star(
    "SELECT encounter_id, admission_date, los_days, discharge_date FROM clean"))
def q_discharge(spark, sf):
    return inputs.encounter_star(spark, sf)["clean"].select(
        "encounter_id", "admission_date", "los_days", "discharge_date")


@_register("icd9_group", tw.with_star(
    f"SELECT encounter_id, diag_1, diag_2, diag_3, {tw.icd9_case('diag_1')} AS diag_1_group, "
    f"{tw.icd9_case('diag_2')} AS diag_2_group, {tw.icd9_case('diag_3')} AS diag_3_group "
    f"FROM step_fill"))
def q_icd9(spark, sf):
    df = _after_fill(spark, sf)
    return df.select("encounter_id", "diag_1", "diag_2", "diag_3",
                     icd9_group("diag_1").alias("diag_1_group"),
                     icd9_group("diag_2").alias("diag_2_group"),
                     icd9_group("diag_3").alias("diag_3_group"))


@_register("prior_visits", tw.with_star(
    "SELECT encounter_id, number_outpatient + number_emergency + number_inpatient "
    "AS prior_visits_total FROM enc"))
def q_prior(spark, sf):
    return inputs.encounter_raw(spark, sf).select(
        "encounter_id", prior_visits().alias("prior_visits_total"))


@_register("risk_tier", tw.with_star(
    "SELECT encounter_id, prior_visits_total, number_inpatient, readmit_risk_flag FROM clean"))
def q_risk(spark, sf):
    df = inputs.encounter_raw(spark, sf).withColumn("prior_visits_total", prior_visits())
    df = exclude_values(df, "discharge_disposition_id")
    return df.select("encounter_id", "prior_visits_total", "number_inpatient",
                     risk_tier().alias("readmit_risk_flag"))


@_register("readmit_target", tw.with_star(
    "SELECT readmitted, readmitted_30d, count(*) AS n FROM clean GROUP BY ALL"))
def q_target(spark, sf):
    df = exclude_values(inputs.encounter_raw(spark, sf), "discharge_disposition_id")
    return df.groupBy("readmitted", readmit_target().alias("readmitted_30d")) \
        .agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- lookups, star
_LOOKUP_UNION = " UNION ALL ".join(
    f"SELECT '{b}' AS block, CAST(id AS VARCHAR) AS id, trim(description) AS description "
    f"FROM ({sql}) s_{i}" for i, (b, sql) in enumerate(tw.LOOKUP_SQL.items()))
_LOOKUP_UNION += " UNION ALL SELECT block, id, description FROM (VALUES " + ", ".join(
    f"('{b}')" for b in tw.LOOKUP_SQL) + ") v(block), (VALUES ('n/a', 'Not a code'), " + ", ".join(
    f"('{i}', '{d}')" for _, i, d in LOOKUP_ODD_LINES) + ") o(id, description)"


@_register("stacked_lookup_parse", f"SELECT * FROM ({_LOOKUP_UNION}) u")
def q_stacked(spark, sf):
    return inputs.lookup_blocks(spark, sf).select("block", "id", "description")


@_register("lookup_decode", tw.with_star(
    "SELECT encounter_id, admission_type_id, admission_type_desc, discharge_disposition_id, "
    "discharge_disposition_desc, admission_source_id, admission_source_desc FROM clean"))
def q_decode(spark, sf):
    return inputs.encounter_star(spark, sf)["clean"].select(
        "encounter_id", "admission_type_id", "admission_type_desc", "discharge_disposition_id",
        "discharge_disposition_desc", "admission_source_id", "admission_source_desc")


for _name in ["dim_patient", "dim_department", "dim_diagnosis", "dim_date", "fact_admission"]:
    def _mk(name):
        def q(spark, sf):
            return inputs.encounter_star(spark, sf)[name]
        q.__name__ = f"q_{name}"
        return q
    _register(_name, tw.with_star(f"SELECT * FROM {_name}"))(_mk(_name))


@_register("fact_partitions", tw.with_star(
    "SELECT admission_year, admission_month, count(*) AS n, CAST(sum(los_days) AS BIGINT) AS days "
    "FROM fact_admission WHERE admission_year BETWEEN 2000 AND 2004 GROUP BY ALL"))
def q_fact_partitions(spark, sf):
    """The written fact read back by partition: only folders of these years."""
    fact = spark.read.parquet(f"{inputs.encounter_star(spark, sf)['folder']}/fact_admission")
    return fact.where("admission_year BETWEEN 2000 AND 2004").groupBy(
        "admission_year", "admission_month").agg(F.count(F.lit(1)).alias("n"),
                                                 F.sum("los_days").alias("days"))


@_register("fact_months", tw.with_star(
    "SELECT admission_year, admission_month, count(*) AS n, CAST(sum(los_days) AS BIGINT) AS days "
    "FROM fact_admission GROUP BY ALL"))
def q_fact_months(spark, sf):
    """The written fact read back whole, all years and months."""
    fact = spark.read.parquet(f"{inputs.encounter_star(spark, sf)['folder']}/fact_admission")
    return fact.groupBy("admission_year", "admission_month").agg(
        F.count(F.lit(1)).alias("n"), F.sum("los_days").alias("days"))


@_register("surrogate_keys", tw.with_star(
    "SELECT 'patient' AS dim, count(*) AS n, count(DISTINCT patient_key) AS n_keys, "
    "min(patient_key) AS min_key, max(patient_key) AS max_key FROM dim_patient "
    "UNION ALL SELECT 'department', count(*), count(DISTINCT department_key), "
    "min(department_key), max(department_key) FROM dim_department "
    "UNION ALL SELECT 'diagnosis', count(*), count(DISTINCT diagnosis_key), "
    "min(diagnosis_key), max(diagnosis_key) FROM dim_diagnosis"))
def q_keys(spark, sf):
    star = inputs.encounter_star(spark, sf)
    parts = []
    for dim, key in [("patient", "patient_key"), ("department", "department_key"),
                     ("diagnosis", "diagnosis_key")]:
        d = star[f"dim_{dim}"]
        parts.append(d.agg(F.lit(dim).alias("dim"), F.count(F.lit(1)).alias("n"),
                           F.countDistinct(key).alias("n_keys"), F.min(key).alias("min_key"),
                           F.max(key).alias("max_key")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@_register("global_row_number",
           "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER "
           "(ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, "
           "l_extendedprice) AS row_num FROM lineitem")
def q_rownum(spark, sf):
    from wardstar.operators.rownum import global_row_number
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
             "l_quantity", "l_extendedprice"]
    return global_row_number(li.select(*order), order).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "row_num")


# ---------------------------------------------------------------- sources, stored marts
@_register("encounter_csv_scan", tw.with_star("SELECT * FROM enc"))
def q_csv_scan(spark, sf):
    """The raw encounters as a header CSV file, read back with its schema."""
    from wardstar.sources.encounters import read_encounters
    path = scratch_path(spark, "encounters-csv")
    inputs.encounter_raw(spark, sf).write.option("header", True).csv(path)
    return read_encounters(spark, path)


def _stored_mart(spark, sf, name):
    """Staging views over the written star, marts stored from them, read back."""
    from wardstar.plans.marts import materialize_marts, register_views
    register_views(spark, inputs.encounter_star(spark, sf)["folder"], prefix="stg_query_")
    return spark.read.parquet(materialize_marts(
        spark, "stg_query_", path=scratch_path(spark, "marts"))[name])


# ---------------------------------------------------------------- marts
@_register("mart_by_department", tw.with_star(
    f"SELECT dd.medical_specialty, count(*) AS n_encounters, "
    f"CAST(sum(f.readmitted_30d) AS BIGINT) AS n_readmit_30d, "
    f"{tw.half_up_2dp('sum(f.readmitted_30d)', 'count(*)', 10000)} AS readmit_rate_pct, "
    f"{tw.half_up_2dp('sum(f.los_days)', 'count(*)', 100)} AS avg_los_days, "
    f"{tw.half_up_2dp('sum(f.num_medications)', 'count(*)', 100)} AS avg_medications "
    f"FROM fact_admission f JOIN dim_department dd ON f.department_key = dd.department_key "
    f"GROUP BY dd.medical_specialty ORDER BY n_encounters DESC"))
def q_mart_dep(spark, sf):
    s = inputs.encounter_star(spark, sf)
    return mart_by_department(s["fact_admission"], s["dim_department"])


@_register("mart_by_diagnosis", tw.with_star(
    f"SELECT di.diag_1_group, count(*) AS n_encounters, "
    f"CAST(sum(f.readmitted_30d) AS BIGINT) AS n_readmit_30d, "
    f"{tw.half_up_2dp('sum(f.readmitted_30d)', 'count(*)', 10000)} AS readmit_rate_pct, "
    f"{tw.half_up_2dp('sum(f.los_days)', 'count(*)', 100)} AS avg_los_days, "
    f"{tw.half_up_2dp('sum(f.prior_visits_total)', 'count(*)', 100)} AS avg_prior_visits "
    f"FROM fact_admission f JOIN dim_diagnosis di ON f.diagnosis_key = di.diagnosis_key "
    f"GROUP BY di.diag_1_group ORDER BY n_encounters DESC"))
def q_mart_diag(spark, sf):
    s = inputs.encounter_star(spark, sf)
    return mart_by_diagnosis(s["fact_admission"], s["dim_diagnosis"])


_FEATURES_OF = {"f": ["encounter_id", *FEATURE_NUMERIC, "readmit_risk_flag", "readmitted_30d"],
                "dp": ["race", "gender", "age"], "dd": ["medical_specialty"],
                "di": ["diag_1_group", "admission_type_desc"]}


@_register("stored_mart_by_department", _SQL["mart_by_department"])
def q_stored_dep(spark, sf):
    return _stored_mart(spark, sf, "mart_readmission_by_department")


@_register("stored_mart_by_diagnosis", _SQL["mart_by_diagnosis"])
def q_stored_diag(spark, sf):
    return _stored_mart(spark, sf, "mart_readmission_by_diagnosis")


@_register("star_features", tw.with_star(
    "SELECT " + ", ".join(f"{t}.{c}" for t, cols in _FEATURES_OF.items() for c in cols)
    + " FROM fact_admission f"
    + "".join(f" JOIN dim_{d} {t} ON f.{d}_key = {t}.{d}_key" for t, d in
              [("dp", "patient"), ("dd", "department"), ("di", "diagnosis")])))
def q_features(spark, sf):
    s = inputs.encounter_star(spark, sf)
    return star_features(s["fact_admission"], s["dim_patient"], s["dim_department"],
                         s["dim_diagnosis"])


# ---------------------------------------------------------------- quality
from wardstar.operators import quality as qa  # noqa: E402
from wardstar.operators.history import scd2_merge  # noqa: E402
from wardstar.operators.profile import profile_missing, value_counts  # noqa: E402


def _sql_check(check, table, column, failures_sql, from_sql):
    return (f"SELECT '{check}' AS check_name, '{table}' AS table_name, '{column}' AS column_name, "
            f"CAST({failures_sql} AS BIGINT) AS failures, CAST({failures_sql} AS BIGINT) = 0 "
            f"AS passed FROM {from_sql}")


def _sql_unique(table, cols):
    c = ", ".join(cols)
    nn = " AND ".join(f"{x} IS NOT NULL" for x in cols)
    return _sql_check("unique", table, ",".join(cols), "count(*)",
                      f"(SELECT {c} FROM {table} WHERE {nn} GROUP BY {c} HAVING count(*) > 1) u")


def _sql_not_null(table, col):
    return _sql_check("not_null", table, col, f"count(*) FILTER (WHERE {col} IS NULL)", table)


def _sql_rel(col, parent):
    return _sql_check("relationships", "fact_admission", col, "count(*)",
                      f"(SELECT {col} FROM fact_admission f WHERE {col} IS NOT NULL AND NOT EXISTS "
                      f"(SELECT 1 FROM {parent} p WHERE p.{col} = f.{col})) o")


_SQL_ACCEPTED = _sql_check("accepted_values", "fact_admission", "readmitted_30d",
                           "count(DISTINCT readmitted_30d)",
                           "(SELECT readmitted_30d FROM fact_admission WHERE readmitted_30d "
                           "IS NOT NULL AND readmitted_30d NOT IN (0, 1)) a")
_KEYS = [("dim_patient", "patient_key"), ("dim_department", "department_key"),
         ("dim_diagnosis", "diagnosis_key"), ("dim_date", "date_key"),
         ("fact_admission", "encounter_id")]
_RELS = [("patient_key", "dim_patient"), ("department_key", "dim_department"),
         ("diagnosis_key", "dim_diagnosis")]
_STAR_TESTS_SQL = " UNION ALL ".join(
    [x for t, k in _KEYS for x in (_sql_unique(t, [k]), _sql_not_null(t, k))]
    + [_sql_not_null("fact_admission", "patient_key")]
    + [_sql_rel(c, p) for c, p in _RELS] + [_SQL_ACCEPTED])


@_register("check_unique", tw.with_star(" UNION ALL ".join(
    [_sql_unique(t, [k]) for t, k in _KEYS]
    + [_sql_unique("lineitem", ["l_orderkey", "l_linenumber"])])))
def q_check_unique(spark, sf):
    s = inputs.encounter_star(spark, sf)
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    return qa.run_checks([qa.check_unique(s[t], t, k) for t, k in _KEYS]
                         + [qa.check_unique(li, "lineitem", ["l_orderkey", "l_linenumber"])])


@_register("check_not_null", tw.with_star(" UNION ALL ".join(
    [_sql_not_null(t, k) for t, k in _KEYS] + [_sql_not_null("fact_admission", "patient_key")])))
def q_check_not_null(spark, sf):
    s = inputs.encounter_star(spark, sf)
    return qa.run_checks([qa.check_not_null(s[t], t, k) for t, k in _KEYS]
                         + [qa.check_not_null(s["fact_admission"], "fact_admission",
                                              "patient_key")])


@_register("check_relationships", tw.with_star(" UNION ALL ".join(
    [_sql_rel(c, p) for c, p in _RELS]
    + [_sql_check("relationships", "lineitem", "l_suppkey", "count(*)",
                  "(SELECT l_suppkey FROM lineitem l WHERE l_suppkey IS NOT NULL AND NOT EXISTS "
                  "(SELECT 1 FROM supplier s WHERE s.s_suppkey = l.l_suppkey)) o")])))
def q_check_rel(spark, sf):
    s = inputs.encounter_star(spark, sf)
    f = s["fact_admission"]
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    sup = spark.read.parquet(f"{sf}/supplier.parquet")
    return qa.run_checks([qa.check_relationships(f, "fact_admission", c, s[p], c)
                          for c, p in _RELS]
                         + [qa.check_relationships(li, "lineitem", "l_suppkey", sup, "s_suppkey")])


@_register("check_accepted_values", tw.with_star(
    _SQL_ACCEPTED + " UNION ALL " + _sql_check(
        "accepted_values", "orders", "o_orderstatus", "count(DISTINCT o_orderstatus)",
        "(SELECT o_orderstatus FROM orders WHERE o_orderstatus IS NOT NULL AND "
        "o_orderstatus NOT IN ('F', 'O')) a")))
def q_check_accepted(spark, sf):
    s = inputs.encounter_star(spark, sf)
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    return qa.run_checks([
        qa.check_accepted_values(s["fact_admission"], "fact_admission", "readmitted_30d", [0, 1]),
        qa.check_accepted_values(orders, "orders", "o_orderstatus", ["F", "O"])])


def _floor_tables(spark, sf):
    """The tables that the floors name: the staging view over the written star,
    and the open and closed versions of a written patient history."""
    from wardstar.plans.marts import register_views
    from wardstar.plans.warehouse import read_history, snapshot_table
    s = inputs.encounter_star(spark, sf)
    register_views(spark, s["folder"], prefix="stg_floor_")
    snapshot = scratch_path(spark, "snapshot-dim-patient")
    snapshot_table(spark, s["dim_patient"].select("patient_nbr", "race", "gender", "age"), snapshot,
                   "patient_nbr", ["race", "gender", "age"], "2024-01-01")
    return {
        "fact_admission": s["fact_admission"], "dim_patient": s["dim_patient"],
        "dim_department": s["dim_department"], "dim_diagnosis": s["dim_diagnosis"],
        "dim_date": s["dim_date"], "stg_fact_admission": spark.table("stg_floor_fact_admission"),
        "mart_readmission_by_department": mart_by_department(s["fact_admission"],
                                                             s["dim_department"]),
        "mart_readmission_by_diagnosis": mart_by_diagnosis(s["fact_admission"],
                                                           s["dim_diagnosis"]),
        "snapshot_dim_patient": read_history(spark, snapshot),
    }


_FLOOR_SRC = {"stg_fact_admission": "fact_admission", "snapshot_dim_patient": "dim_patient",
              "mart_readmission_by_department":
                  "(SELECT DISTINCT department_key FROM fact_admission f JOIN dim_department d "
                  "USING (department_key))",
              "mart_readmission_by_diagnosis":
                  "(SELECT DISTINCT diag_1_group FROM fact_admission f JOIN dim_diagnosis d "
                  "USING (diagnosis_key))"}


@_register("check_row_floor", tw.with_star(" UNION ALL ".join(
    f"SELECT 'row_floor' AS check_name, '{t}' AS table_name, '>={m}' AS column_name, "
    f"CAST(CASE WHEN count(*) >= {m} THEN 0 ELSE 1 END AS BIGINT) AS failures, "
    f"count(*) >= {m} AS passed, count(*) AS n_rows FROM {_FLOOR_SRC.get(t, t)} x"
    for t, m in qa.ROW_FLOORS.items())))
def q_check_floor(spark, sf):
    tabs = _floor_tables(spark, sf)
    out = None
    for t, m in qa.ROW_FLOORS.items():
        r = qa.check_row_floor(tabs[t], t, m)
        out = r if out is None else out.unionByName(r)
    return out


@_register("check_rate_band", tw.with_star(
    "SELECT 'rate_band' AS check_name, 'fact_admission' AS table_name, "
    "'readmitted_30d' AS column_name, CAST(CASE WHEN avg(CAST(readmitted_30d AS DOUBLE)) * 100.0 "
    "BETWEEN 5.0 AND 20.0 THEN 0 ELSE 1 END AS BIGINT) AS failures, "
    "avg(CAST(readmitted_30d AS DOUBLE)) * 100.0 BETWEEN 5.0 AND 20.0 AS passed, "
    "avg(CAST(readmitted_30d AS DOUBLE)) * 100.0 AS rate_pct FROM fact_admission"))
def q_check_rate(spark, sf):
    return qa.check_rate_band(inputs.encounter_star(spark, sf)["fact_admission"],
                              "fact_admission")


@_register("check_fanout", tw.with_star(
    "SELECT 'fanout' AS check_name, 'fact_admission' AS table_name, '*' AS column_name, "
    "CAST(abs((SELECT count(*) FROM fact_admission) - (SELECT count(*) FROM clean)) AS BIGINT) "
    "AS failures, (SELECT count(*) FROM fact_admission) = (SELECT count(*) FROM clean) AS passed"))
def q_check_fanout(spark, sf):
    clean = inputs.encounter_star(spark, sf)["clean"]
    return qa.check_fanout(inputs.encounter_star(spark, sf)["fact_admission"], clean)


@_register("check_suite", tw.with_star(_STAR_TESTS_SQL))
def q_check_suite(spark, sf):
    return qa.star_tests(inputs.encounter_star(spark, sf))


@_register("check_summary", tw.with_star(
    "SELECT count(*) AS n_checks, count(*) FILTER (WHERE passed) AS n_passed, "
    "count(*) FILTER (WHERE NOT passed) AS n_failed, "
    "COALESCE(string_agg(CASE WHEN NOT passed THEN check_name || ':' || table_name || ':' || "
    "column_name END, ',' ORDER BY CASE WHEN NOT passed THEN check_name || ':' || table_name "
    "|| ':' || column_name END), '') AS failed_checks FROM (" + _STAR_TESTS_SQL + ") t"))
def q_check_summary(spark, sf):
    return qa.summarize(qa.star_tests(inputs.encounter_star(spark, sf)))


_RAW_STRING_COLS = ["race", "gender", "age", "weight", "payer_code", "medical_specialty",
                    "diag_1", "diag_2", "diag_3", "readmitted"]


@_register("profile_missing", tw.with_star(
    "SELECT column_name, n_missing FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} = '?') AS n_missing FROM enc"
        for c in _RAW_STRING_COLS)
    + ") m WHERE n_missing > 0 ORDER BY n_missing DESC, column_name LIMIT 15"))
def q_profile_missing(spark, sf):
    return profile_missing(inputs.encounter_raw(spark, sf), "?", 15)


@_register("value_counts", tw.with_star(
    "SELECT readmitted, count(*) AS n FROM enc GROUP BY readmitted ORDER BY n DESC, readmitted"))
def q_value_counts(spark, sf):
    return value_counts(inputs.encounter_raw(spark, sf), "readmitted")


# The columns that the original prints.
_PREVIEW = ["encounter_id", "patient_nbr", "admission_type_id", "discharge_disposition_id",
            "admission_source_id", "time_in_hospital", "diag_1", "diag_2", "diag_3", "readmitted"]


@_register("preview_encounters", tw.with_star(
    f"SELECT {', '.join(_PREVIEW)} FROM enc ORDER BY encounter_id LIMIT 10"))
def q_preview(spark, sf):
    from wardstar.operators.profile import preview
    return preview(inputs.encounter_raw(spark, sf), "encounter_id", 10, _PREVIEW)


_ENC_COLUMNS = [e.rsplit(" AS ", 1)[1].strip() for e in encounter_exprs()]


@_register("profile_schema", tw.with_star(tw.schema_profile("enc", _ENC_COLUMNS)))
def q_profile_schema(spark, sf):
    from wardstar.operators.profile import profile_schema
    return profile_schema(inputs.encounter_raw(spark, sf))


# ---------------------------------------------------------------- history
# Two versions of an attribute table derived from customer: version 2 changes
# some segments and nations, turns NULL into a value and keeps NULL = NULL;
# customers with a negative balance outside HOUSEHOLD appear only in version 2
# (new keys), HOUSEHOLD is gone from version 2 (keys that disappear); every
# customer is in one of them. Snapshots at three dates; the third run sees no
# change.
_V1_SQL = ("SELECT c_custkey AS key, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_mktsegment "
           "END AS segment, c_nationkey AS nation FROM customer "
           "WHERE c_acctbal >= 0 OR c_mktsegment = 'HOUSEHOLD'")
_V2_SQL = ("SELECT c_custkey AS key, CASE WHEN c_custkey % 7 = 0 THEN 'CHANGED' "
           "WHEN c_custkey % 20 = 0 THEN c_mktsegment WHEN c_custkey % 10 = 0 THEN NULL "
           "ELSE c_mktsegment END AS segment, "
           "CASE WHEN c_custkey % 9 = 0 THEN c_nationkey + 1 ELSE c_nationkey END AS nation "
           "FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'")


@_register("scd2_merge", f"""
WITH v1 AS ({_V1_SQL}), v2 AS ({_V2_SQL}),
j AS (SELECT v1.key AS k1, v1.segment AS s1, v1.nation AS n1, v2.key AS k2, v2.segment AS s2,
             v2.nation AS n2,
             v1.key IS NOT NULL AND v2.key IS NOT NULL AND NOT (
               v1.segment IS NOT DISTINCT FROM v2.segment AND
               v1.nation IS NOT DISTINCT FROM v2.nation) AS changed
      FROM v1 FULL OUTER JOIN v2 ON v1.key = v2.key)
SELECT k1 AS key, s1 AS segment, n1 AS nation, DATE '2024-01-01' AS valid_from,
       CASE WHEN changed THEN DATE '2024-02-01' END AS valid_to FROM j WHERE k1 IS NOT NULL
UNION ALL
SELECT k2, s2, n2, DATE '2024-02-01', CAST(NULL AS DATE) FROM j
WHERE k2 IS NOT NULL AND (k1 IS NULL OR changed)""")
def q_scd2(spark, sf):
    view = "wardstar_customer_versions"
    spark.read.parquet(f"{sf}/customer.parquet").createOrReplaceTempView(view)
    v1 = spark.sql(_V1_SQL.replace("FROM customer", f"FROM {view}"))
    v2 = spark.sql(_V2_SQL.replace("FROM customer", f"FROM {view}"))
    h = scd2_merge(None, v1, "key", ["segment", "nation"], "2024-01-01")
    h = scd2_merge(h, v2, "key", ["segment", "nation"], "2024-02-01")
    return scd2_merge(h, v2, "key", ["segment", "nation"], "2024-03-01")


# ---------------------------------------------------------------- vitals stream
from wardstar.functions import vitals as vit  # noqa: E402
from wardstar.sources.fixtures import vitals_messages  # noqa: E402
from wardstar.streaming.vitals import ALERT_COLS, parse_vitals, read_vitals_stream, run_vitals  # noqa: E402,E501

_VITALS_SQL = f"""
WITH m AS (SELECT event_id, user_id, event_type, ts,
                  CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
p AS (SELECT
  CASE WHEN event_type = 'error' THEN NULL ELSE event_id END AS encounter_id,
  CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS patient_nbr,
  CASE WHEN event_type = 'error' THEN NULL
       WHEN event_type = 'signup' THEN 'not-a-time-' || CAST(event_id AS VARCHAR)
       ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS "timestamp",
  CASE WHEN event_type = 'error' THEN NULL ELSE CAST(40 + k AS INTEGER) END AS heart_rate,
  CASE WHEN event_type = 'error' THEN NULL ELSE CAST(90 + event_id % 71 AS INTEGER) END
    AS blood_pressure_sys,
  CASE WHEN event_type = 'error' OR (event_type = 'view' AND event_id % 3 = 0) THEN NULL
       ELSE CAST(80 + event_id % 21 AS INTEGER) END AS spo2,
  event_type = 'error' AS is_malformed
  FROM m),
v AS (SELECT *, TRY_CAST("timestamp" AS TIMESTAMP) AS event_time,
  (heart_rate > {vit.HR_HIGH} OR heart_rate < {vit.HR_LOW} OR spo2 < {vit.SPO2_LOW}) AS alert_flag,
  CASE WHEN heart_rate > {vit.HR_HIGH} THEN '{vit.REASON_FAST_HR}'
       WHEN heart_rate < {vit.HR_LOW} THEN '{vit.REASON_SLOW_HR}'
       WHEN spo2 < {vit.SPO2_LOW} THEN '{vit.REASON_LOW_SPO2}' END AS alert_reason
  FROM p)
"""


@_register("vitals_parse", _VITALS_SQL + "SELECT * FROM v")
def q_vitals_parse(spark, sf):
    return parse_vitals(vitals_messages(spark, sf))


@_register("vitals_alert_flag", _VITALS_SQL +
           "SELECT alert_flag, alert_reason, count(*) AS n FROM v GROUP BY ALL")
def q_vitals_flag(spark, sf):
    p = parse_vitals(vitals_messages(spark, sf))
    return p.groupBy("alert_flag", "alert_reason").agg(F.count(F.lit(1)).alias("n"))


@_register("vitals_alerts", _VITALS_SQL + "SELECT " + ", ".join(ALERT_COLS) +
           " FROM v WHERE alert_flag")
def q_vitals_alerts(spark, sf):
    """A real stream: messages land as files, both sinks run to completion with
    an availableNow trigger, and the alert sink is read back."""
    root = scratch_path(spark, "vitals")
    vitals_messages(spark, sf).write.mode("overwrite").text(f"{root}/source")
    raw = read_vitals_stream(spark, "text", {"maxFilesPerTrigger": "4"}, f"{root}/source")
    run_vitals(spark, raw, f"{root}/all", f"{root}/alerts", f"{root}/ckpt",
               trigger={"availableNow": True}, wait=True)
    return spark.read.parquet(f"{root}/alerts")


@_register("vitals_all_rows", _VITALS_SQL + "SELECT * FROM v")
def q_vitals_all(spark, sf):
    """The all-rows sink of the same stream, read back."""
    root = scratch_path(spark, "vitals2")
    vitals_messages(spark, sf).write.mode("overwrite").text(f"{root}/source")
    raw = read_vitals_stream(spark, "text", {"maxFilesPerTrigger": "4"}, f"{root}/source")
    run_vitals(spark, raw, f"{root}/all", f"{root}/alerts", f"{root}/ckpt",
               trigger={"availableNow": True}, wait=True)
    return spark.read.parquet(f"{root}/all")


@_register("vitals_alerts_single_read", _VITALS_SQL + "SELECT " + ", ".join(ALERT_COLS) +
           " FROM v WHERE alert_flag")
def q_vitals_alerts_once(spark, sf):
    """As ``vitals_alerts``, with both sinks written by one query that reads
    the source once per micro-batch; the per-batch folders are read back
    without their ``batch_id`` column."""
    from wardstar.streaming.vitals import run_vitals_single_read
    root = scratch_path(spark, "vitals1")
    vitals_messages(spark, sf).write.mode("overwrite").text(f"{root}/source")
    raw = read_vitals_stream(spark, "text", {"maxFilesPerTrigger": "4"}, f"{root}/source")
    run_vitals_single_read(spark, raw, f"{root}/all", f"{root}/alerts", f"{root}/ckpt",
                           trigger={"availableNow": True}, wait=True)
    return spark.read.parquet(f"{root}/alerts").select(*ALERT_COLS)


# ---------------------------------------------------------------- metrics
from wardstar.operators import metrics as mx  # noqa: E402
from wardstar.operators.sampling import class_weights, stratified_split  # noqa: E402

# Scored set: document quality labels, the document length as the score and
# "length >= 2000" as the hard prediction.
_SCORE_CUT = 2000
_SCORED_SQL = (f"WITH s AS (SELECT d.doc_id, l.quality AS label, CAST(d.n_chars AS DOUBLE) AS score, "
               f"CASE WHEN d.n_chars >= {_SCORE_CUT} THEN 1 ELSE 0 END AS prediction "
               f"FROM documents d JOIN labels l ON d.doc_id = l.doc_id)")


def _scored(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "n_chars")
    lab = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    return d.join(lab, "doc_id").select(
        "doc_id", F.col("quality").alias("label"), F.col("n_chars").cast("double").alias("score"),
        (F.col("n_chars") >= _SCORE_CUT).cast("int").alias("prediction"))


@_register("confusion", _SCORED_SQL + " SELECT label AS actual, prediction AS predicted, "
           "count(*) AS n FROM s GROUP BY ALL")
def q_confusion(spark, sf):
    return mx.confusion(_scored(spark, sf), "label", "prediction")


@_register("class_report", _SCORED_SQL + """,
cm AS (SELECT label AS actual, prediction AS predicted, count(*) AS n FROM s GROUP BY ALL),
sup AS (SELECT actual AS c, sum(n) AS support FROM cm GROUP BY 1),
pre AS (SELECT predicted AS c, sum(n) AS pred FROM cm GROUP BY 1),
tp AS (SELECT actual AS c, n AS tp FROM cm WHERE actual = predicted),
per AS (SELECT COALESCE(sup.c, pre.c) AS c, COALESCE(support, 0) AS support,
               COALESCE(pred, 0) AS pred, COALESCE(tp.tp, 0) AS tp
        FROM sup FULL JOIN pre ON sup.c = pre.c LEFT JOIN tp ON tp.c = COALESCE(sup.c, pre.c)),
m AS (SELECT *, CASE WHEN pred > 0 THEN tp / pred ELSE CAST(0 AS DOUBLE) END AS precision,
             CASE WHEN support > 0 THEN tp / support ELSE CAST(0 AS DOUBLE) END AS recall FROM per),
m2 AS (SELECT *, CASE WHEN precision + recall > 0 THEN CAST(2 AS DOUBLE) * precision * recall
                      / (precision + recall) ELSE CAST(0 AS DOUBLE) END AS f1_score FROM m)
SELECT CAST(c AS VARCHAR) AS label, precision, recall, f1_score, CAST(support AS BIGINT) AS support
FROM m2
UNION ALL SELECT 'accuracy', NULL, NULL, sum(tp) / sum(support), CAST(sum(support) AS BIGINT) FROM m2
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score),
                 CAST(sum(support) AS BIGINT) FROM m2
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
                 sum(recall * support) / sum(support), sum(f1_score * support) / sum(support),
                 CAST(sum(support) AS BIGINT) FROM m2""")
def q_class_report(spark, sf):
    return mx.class_report(_scored(spark, sf), "label", "prediction")


_CUM_SQL = _SCORED_SQL + """,
g AS (SELECT score, sum(label) AS pos, count(*) - sum(label) AS neg FROM s GROUP BY score),
c AS (SELECT *,
  COALESCE(sum(pos) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    AS pos_below,
  COALESCE(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    AS neg_below FROM g),
t AS (SELECT sum(pos) AS P, sum(neg) AS N FROM g),
pr AS (SELECT score AS threshold, CAST(P - pos_below AS BIGINT) AS tp,
              CAST(N - neg_below AS BIGINT) AS fp, P FROM c, t),
pr2 AS (SELECT threshold, tp, fp,
  CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE CAST(0 AS DOUBLE) END AS precision,
  CASE WHEN P > 0 THEN tp / P ELSE CAST(1 AS DOUBLE) END AS recall FROM pr),
pr3 AS (SELECT *, CAST(2 AS DOUBLE) * precision * recall / (precision + recall + 1e-9) AS f1
        FROM pr2)
"""


@_register("roc_auc", _CUM_SQL + "SELECT CAST(2 * sum(pos * neg_below) + sum(pos * neg) AS DOUBLE)"
           " / CAST(2 * sum(pos) * sum(neg) AS DOUBLE) AS roc_auc, CAST(sum(pos) AS BIGINT) AS "
           "n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM c")
def q_roc_auc(spark, sf):
    return mx.roc_auc(_scored(spark, sf), "label", "score")


@_register("pr_curve", _CUM_SQL + "SELECT * FROM pr3")
def q_pr_curve(spark, sf):
    return mx.pr_curve(_scored(spark, sf), "label", "score")


@_register("best_threshold", _CUM_SQL + "SELECT * FROM pr3 ORDER BY f1 DESC, threshold LIMIT 1")
def q_best_threshold(spark, sf):
    return mx.best_threshold(mx.pr_curve(_scored(spark, sf), "label", "score"))


# Scored rows some of which have no score, a NaN score or no label: they are in
# no curve.
_GAPS_SQL = _CUM_SQL.replace("GROUP BY score)", "WHERE score IS NOT NULL AND NOT isnan(score) AND label IS NOT NULL "
                             "GROUP BY score)", 1).replace(
    "l.quality AS label", "CASE WHEN d.doc_id % 13 <> 0 THEN l.quality END AS label").replace(
    "CAST(d.n_chars AS DOUBLE) AS score", "CASE WHEN d.doc_id % 11 = 0 THEN NULL WHEN d.doc_id % 17 = 0 "
    "THEN 'NaN'::DOUBLE ELSE CAST(d.n_chars AS DOUBLE) END AS score")


def _scored_with_gaps(spark, sf):
    i = F.col("doc_id")
    return _scored(spark, sf).withColumns({
        "label": F.when(i % 13 != 0, F.col("label")),
        "score": F.when(i % 11 == 0, F.lit(None)).when(i % 17 == 0, F.lit(float("nan"))).otherwise(F.col("score"))})


@_register("roc_auc_with_gaps", _GAPS_SQL + "SELECT CAST(2 * sum(pos * neg_below) + sum(pos * neg) AS DOUBLE)"
           " / CAST(2 * sum(pos) * sum(neg) AS DOUBLE) AS roc_auc, CAST(sum(pos) AS BIGINT) AS "
           "n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM c")
def q_roc_auc_gaps(spark, sf):
    return mx.roc_auc(_scored_with_gaps(spark, sf), "label", "score")


@_register("pr_curve_with_gaps", _GAPS_SQL + "SELECT * FROM pr3")
def q_pr_curve_gaps(spark, sf):
    return mx.pr_curve(_scored_with_gaps(spark, sf), "label", "score")


@_register("best_threshold_with_gaps", _GAPS_SQL + "SELECT * FROM pr3 ORDER BY f1 DESC, threshold LIMIT 1")
def q_best_threshold_gaps(spark, sf):
    return mx.best_threshold(mx.pr_curve(_scored_with_gaps(spark, sf), "label", "score"))


@_register("stratified_split_counts", _SCORED_SQL + """,
n AS (SELECT label, count(*) AS n, CAST(ceil(CAST(0.2 AS DOUBLE) * count(*)) AS BIGINT) AS t
      FROM s GROUP BY label)
SELECT label, 'test' AS split, t AS n FROM n WHERE t > 0
UNION ALL SELECT label, 'train', n - t FROM n WHERE n - t > 0""")
def q_split_counts(spark, sf):
    sp = stratified_split(_scored(spark, sf), "label", 0.2, 42, "doc_id")
    return sp.groupBy("label", "split").agg(F.count(F.lit(1)).alias("n"))


@_register("balanced_weights", _SCORED_SQL + """
SELECT label, count(*) AS n, CAST(sum(count(*)) OVER () AS DOUBLE)
       / CAST(count(*) OVER () * count(*) AS DOUBLE) AS weight FROM s GROUP BY label""")
def q_weights(spark, sf):
    return class_weights(_scored(spark, sf), "label")


# ---------------------------------------------------------------- retrieval
from wardstar.operators.chunking import chunk_documents  # noqa: E402
from wardstar.operators.knn import centroids, knn  # noqa: E402
from wardstar.plans import retrieval as rt  # noqa: E402

_CHUNK_SIZE, _CHUNK_OVERLAP = 256, 32


@_register("chunk_documents", f"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[ \\t\\n\\r\\f\\x0B]+'),
                                      lambda x: x <> '') AS ws FROM documents),
n AS (SELECT doc_id, ws, len(ws) AS n FROM w WHERE len(ws) > 0),
c AS (SELECT doc_id, ws, CASE WHEN n <= {_CHUNK_SIZE} THEN 1 ELSE 1 + CAST(ceil((n - {_CHUNK_SIZE})
        / {_CHUNK_SIZE - _CHUNK_OVERLAP}) AS INTEGER) END AS nc FROM n),
e AS (SELECT doc_id, ws, CAST(unnest(range(nc)) AS INTEGER) AS chunk_id FROM c)
SELECT doc_id, chunk_id,
       CAST(len(ws[chunk_id * {_CHUNK_SIZE - _CHUNK_OVERLAP} + 1 :
                   chunk_id * {_CHUNK_SIZE - _CHUNK_OVERLAP} + {_CHUNK_SIZE}]) AS INTEGER) AS n_words,
       array_to_string(ws[chunk_id * {_CHUNK_SIZE - _CHUNK_OVERLAP} + 1 :
                          chunk_id * {_CHUNK_SIZE - _CHUNK_OVERLAP} + {_CHUNK_SIZE}], ' ') AS text
FROM e""")
def q_chunks(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return chunk_documents(docs, _CHUNK_SIZE, _CHUNK_OVERLAP)


# kNN: the query vectors are the per-label centroids of the embedding table,
# the corpus is the whole table.
_CENTROIDS_SQL = """u AS (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS v
           FROM embeddings, range(1, len(embedding) + 1) r(i) GROUP BY label, i),
q AS (SELECT label AS qid, list(v ORDER BY i) AS qv FROM u GROUP BY label)"""
_QUERY_ROWS_SQL = """q AS (SELECT vec_id AS qid, CAST(embedding AS DOUBLE[]) AS qv FROM embeddings
      WHERE vec_id % 20 = 0)"""


def _knn_sql(metric, queries=_CENTROIDS_SQL):
    if metric == "l2":
        dist = ("list_sum(list_transform(range(1, len(e.embedding) + 1), lambda j: "
                "(CAST(e.embedding[j] AS DOUBLE) - q.qv[j]) * (CAST(e.embedding[j] AS DOUBLE) "
                "- q.qv[j])))")
    else:
        dot = ("list_sum(list_transform(range(1, len(e.embedding) + 1), lambda j: "
               "CAST(e.embedding[j] AS DOUBLE) * q.qv[j]))")
        ne = ("sqrt(list_sum(list_transform(e.embedding, lambda x: CAST(x AS DOUBLE) * "
              "CAST(x AS DOUBLE))))")
        nq = "sqrt(list_sum(list_transform(q.qv, lambda x: x * x)))"
        dist = f"1.0 - CASE WHEN {ne} * {nq} > 0 THEN {dot} / ({ne} * {nq}) ELSE 0.0 END"
    return f"""
WITH {queries},
d AS (SELECT q.qid, e.vec_id, e.label, {dist} AS distance FROM q, embeddings e),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY distance, vec_id) AS rank FROM d)
"""


def _knn_spark(spark, sf, metric):
    emb = spark.read.parquet(f"{sf}/embeddings.parquet")
    q = centroids(emb, "label").withColumnRenamed("label", "qid")
    return knn(emb, q, k=3, metric=metric, payload_cols=["label"])


@_register("knn_l2", _knn_sql("l2") + "SELECT qid, vec_id, rank, round(distance, 6) AS distance "
           "FROM r WHERE rank <= 3")
def q_knn_l2(spark, sf):
    h = _knn_spark(spark, sf, "l2")
    return h.select("qid", "vec_id", F.col("rank").cast("long").alias("rank"),
                    F.round("distance", 6).alias("distance"))


@_register("knn_cosine", _knn_sql("cosine") + "SELECT qid, vec_id, rank, round(distance, 6) AS "
           "distance FROM r WHERE rank <= 3")
def q_knn_cos(spark, sf):
    h = _knn_spark(spark, sf, "cosine")
    return h.select("qid", "vec_id", F.col("rank").cast("long").alias("rank"),
                    F.round("distance", 6).alias("distance"))


@_register("knn_sources", _knn_sql("l2") + "SELECT qid, string_agg(DISTINCT CAST(label AS VARCHAR), "
           "',' ORDER BY CAST(label AS VARCHAR)) AS sources FROM r WHERE rank <= 3 GROUP BY qid")
def q_knn_sources(spark, sf):
    return rt.sources_per_query(_knn_spark(spark, sf, "l2"), "qid", "label")


# The query vectors are rows, one in twenty, so that both sides grow with the
# table; they are searched through the pivot index.
from wardstar.operators import knn_index  # noqa: E402

for _metric in ["l2", "cosine"]:
    def _mk_knn(metric):
        def q(spark, sf):
            emb = spark.read.parquet(f"{sf}/embeddings.parquet")
            rows = emb.where("vec_id % 20 = 0").select(F.col("vec_id").alias("qid"), "embedding")
            index = knn_index.build_index(emb, metric)
            return knn_index.search(index, rows, k=3).select(
                "qid", "vec_id", F.col("rank").cast("long").alias("rank"),
                (F.round("distance", 6) + F.lit(0.0)).alias("distance"))  # no -0.0
        q.__name__ = f"q_knn_rows_{metric}"
        return q
    _register(f"knn_rows_{_metric}", _knn_sql(_metric, _QUERY_ROWS_SQL) + "SELECT qid, vec_id, rank, "
              "round(distance, 6) + 0.0 AS distance FROM r WHERE rank <= 3")(_mk_knn(_metric))


_CHUNKS_SQL = _SQL["chunk_documents"].strip()
_TERMS_SQL = f"""
WITH ch AS ({_CHUNKS_SQL}),
t AS (SELECT doc_id, chunk_id, term, count(*) AS tf FROM (
        SELECT doc_id, chunk_id, unnest(string_split(text, ' ')) AS term FROM ch) GROUP BY ALL),
total AS (SELECT count(*) AS n FROM (SELECT DISTINCT doc_id, chunk_id FROM t)),
f AS (SELECT term, count(*) AS df FROM t GROUP BY term)
"""


def _idf_sql(df):
    return (f"CAST(round(1000.0 * ln(CAST((SELECT n FROM total) + 1 AS DOUBLE) "
            f"/ CAST(coalesce({df}, 0) + 1 AS DOUBLE))) AS BIGINT)")


@_register("text_embeddings", _TERMS_SQL + f"""
SELECT doc_id, chunk_id, source, term, weight FROM (
  SELECT t.doc_id, chunk_id, d.source, term, CAST(tf * {_idf_sql('df')} AS BIGINT) AS weight
  FROM t JOIN f USING (term) JOIN documents d ON t.doc_id = d.doc_id) WHERE weight > 0""")
def q_text_embeddings(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return rt.embed_chunks(chunk_documents(docs, _CHUNK_SIZE, _CHUNK_OVERLAP, keep_cols=["source"]))


_INDEXES: dict = {}


def _chunk_index(spark, sf):
    """The inverted index over the stored chunks, built once per session and
    input folder; every search of the session reads it."""
    from wardstar.plans import inverted_index as ix
    key = (spark.sparkContext.applicationId, sf.rstrip("/"))
    if key not in _INDEXES:
        docs = spark.read.parquet(f"{sf}/documents.parquet")
        store = scratch_path(spark, "chunk-store")
        rt.store_embeddings(spark, chunk_documents(docs, _CHUNK_SIZE, _CHUNK_OVERLAP, keep_cols=["source"]), store)
        _INDEXES[key] = ix.build_inverted_index(rt.stored_chunks(spark, store))
    return _INDEXES[key]


@_register("retrieve_benchmark", _TERMS_SQL + f""",
cw AS (SELECT doc_id || ':' || chunk_id AS chunk_key, doc_id, chunk_id, term, tf * {_idf_sql('df')} AS w
       FROM t JOIN f USING (term)),
qt AS (SELECT qid, term, count(*) AS tf FROM (
         SELECT item_id AS qid, unnest(list_filter(regexp_split_to_array(text, '[ \\t\\n\\r\\f\\x0B]+'),
                lambda x: x <> '')) AS term FROM benchmark) GROUP BY ALL),
qw AS (SELECT qid, term, tf * {_idf_sql('df')} AS w FROM qt LEFT JOIN f USING (term)),
cn AS (SELECT chunk_key, CAST(sum(CAST(w AS HUGEINT) * w) AS DOUBLE) AS c2 FROM cw GROUP BY 1),
qn AS (SELECT qid, CAST(sum(CAST(w AS HUGEINT) * w) AS DOUBLE) AS q2 FROM qw GROUP BY 1),
dots AS (SELECT qid, chunk_key, sum(cw.w * qw.w) AS dot FROM cw JOIN qw USING (term) GROUP BY ALL),
allc AS (SELECT DISTINCT chunk_key, d.source FROM cw JOIN documents d ON cw.doc_id = d.doc_id),
scored AS (SELECT q.item_id AS qid, allc.chunk_key, allc.source,
    CAST(1 AS DOUBLE) - CASE WHEN coalesce(dot, 0) > 0 THEN CAST(dot AS DOUBLE) / (sqrt(c2) * sqrt(q2))
                             ELSE CAST(0 AS DOUBLE) END AS distance
  FROM benchmark q CROSS JOIN allc
  LEFT JOIN dots ON dots.qid = q.item_id AND dots.chunk_key = allc.chunk_key
  LEFT JOIN cn ON cn.chunk_key = allc.chunk_key LEFT JOIN qn ON qn.qid = q.item_id),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY distance, chunk_key) AS rank FROM scored),
top AS (SELECT * FROM r WHERE rank <= 3),
s AS (SELECT qid, string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM top GROUP BY qid)
SELECT qid, chunk_key, rank, distance, source, sources FROM top JOIN s USING (qid)""")
def q_retrieve(spark, sf):
    """Benchmark items as questions against the indexed chunks: top 3 and sources."""
    from wardstar.plans import inverted_index as ix
    bench = spark.read.parquet(f"{sf}/benchmark.parquet").select(
        F.col("item_id").alias("qid"), "text")
    hits = materialize(ix.search(_chunk_index(spark, sf), bench, k=3), "hits")
    return hits.join(rt.sources_per_query(hits), "qid").withColumn("rank", F.col("rank").cast("long"))


# ---------------------------------------------------------------- readmission model
# A random forest has no SQL twin; ``readmission_score_cells`` states what SQL
# can of the scores. The model is trained once per session and input folder,
# with the published parameters, and every row is scored once into a
# predictions table (as the published job writes one); the scores, the
# high-risk list and the all-rows statistics read that table.
_MODELS: dict = {}


def _trained(spark, sf):
    from wardstar.plans.model import train_readmission
    key = (spark.sparkContext.applicationId, sf.rstrip("/"))
    if key not in _MODELS:
        s = inputs.encounter_star(spark, sf)
        feats = star_features(s["fact_admission"], s["dim_patient"], s["dim_department"],
                              s["dim_diagnosis"])
        model, data, ev = train_readmission(feats)
        from wardstar.sources.sinks import read_table, replace_table
        path = scratch_path(spark, "predictions")
        replace_table(ev["predictions"], path)
        preds = read_table(spark, path)
        _MODELS[key] = (model, data, ev, preds)
    return _MODELS[key]


@_register("readmission_scores")
def q_scores(spark, sf):
    return _trained(spark, sf)[3]


@_register("readmission_score_cells", tw.with_star(
    "SELECT label, split, n, n AS n_encounters, CAST(0 AS BIGINT) AS n_out_of_range, "
    "CAST(0 AS BIGINT) AS n_wrong_flags, CAST(0 AS BIGINT) AS n_wrong_labels FROM cells WHERE n > 0",
    "per_label AS (SELECT readmitted_30d AS label, count(*) AS n, "
    "CAST(ceil(CAST(0.2 AS DOUBLE) * count(*)) AS BIGINT) AS t FROM fact_admission GROUP BY 1),\n"
    "cells AS (SELECT label, 'test' AS split, t AS n FROM per_label "
    "UNION ALL SELECT label, 'train', n - t FROM per_label)"))
def q_score_cells(spark, sf):
    """Per label and split: predictions, distinct encounters, and predictions
    whose probability, flag or label is wrong (none)."""
    model, _, _, preds = _trained(spark, sf)
    fact = inputs.encounter_star(spark, sf)["fact_admission"].select(
        "encounter_id", F.col("readmitted_30d").alias("label"))
    p = F.col("predicted_readmit_probability")
    flag = (p >= F.lit(model.threshold)).cast("int")
    count = lambda c: F.count_if(F.coalesce(c, F.lit(True))).alias
    return preds.join(fact, "encounter_id", "left").groupBy(
        F.col("readmitted_30d").alias("label"), "split").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("encounter_id").alias("n_encounters"),
        count(~p.between(0, 1))("n_out_of_range"),
        count(F.col("predicted_readmit_flag") != flag)("n_wrong_flags"),
        count(F.col("readmitted_30d") != F.col("label"))("n_wrong_labels"))


@_register("high_risk_list")
def q_high_risk(spark, sf):
    from wardstar.plans.model import high_risk
    return high_risk(_trained(spark, sf)[3], 50)


@_register("high_risk_ranks", tw.with_star(
    "SELECT least(50, count(*)) AS n_listed, least(50, count(*)) AS n_encounters, CAST(0 AS BIGINT) AS n_missed "
    "FROM fact_admission"))
def q_high_risk_ranks(spark, sf):
    """The list's rows and encounters, and predictions off the list with a
    probability above the least on it (none)."""
    preds = _trained(spark, sf)[3]
    listed = materialize(q_high_risk(spark, sf), "high-risk")
    least = listed.select(F.min("predicted_readmit_probability")).scalar()
    missed = preds.join(listed.select("encounter_id"), "encounter_id", "left_anti").where(
        F.col("predicted_readmit_probability") > least)
    return listed.agg(F.count(F.lit(1)).alias("n_listed"), F.count_distinct("encounter_id").alias("n_encounters")) \
        .withColumn("n_missed", missed.select(F.count(F.lit(1))).scalar())


@_register("model_reload", tw.with_star(
    "SELECT count(*) AS n_scored, CAST(0 AS BIGINT) AS n_differences FROM fact_admission"))
def q_model_reload(spark, sf):
    """The model saved, loaded and run over all rows again: scores that differ
    from the stored ones (none)."""
    from wardstar.plans.model import ReadmissionModel
    model, data, _, preds = _trained(spark, sf)
    path = scratch_path(spark, "model")
    model.save(spark, path)
    again = ReadmissionModel.load(spark, path).score(data)
    both = again.select("encounter_id", F.col("predicted_readmit_probability").alias("p")).join(
        preds.select("encounter_id", F.col("predicted_readmit_probability").alias("q")), "encounter_id", "full_outer")
    same = F.col("p").eqNullSafe(F.col("q"))
    return both.agg(F.count(F.lit(1)).alias("n_scored"), F.count_if(~same).alias("n_differences"))


@_register("check_predictions_present", tw.with_star(
    "SELECT 'row_floor' AS check_name, 'predictions' AS table_name, '>=1' AS column_name, "
    "CAST(CASE WHEN count(*) >= 1 THEN 0 ELSE 1 END AS BIGINT) AS failures, count(*) >= 1 AS passed FROM fact_admission"))
def q_predictions_present(spark, sf):
    from wardstar.plans.warehouse import floor_checks
    return floor_checks({"predictions": _trained(spark, sf)[3]}, {"predictions": 1})[0]


@_register("feature_importance")
def q_importance(spark, sf):
    return _trained(spark, sf)[0].feature_importance(spark, 10)


@_register("model_evaluation")
def q_model_eval(spark, sf):
    from wardstar.plans.model import LABEL
    model, _, _, preds = _trained(spark, sf)
    test = preds.filter(F.col("split") == "test")
    auc = mx.roc_auc(test, LABEL, "predicted_readmit_probability")
    mp = test.agg(F.avg("predicted_readmit_probability").alias("mean_probability"),
                  F.avg(F.col(LABEL).cast("double")).alias("base_rate"))
    al = preds.agg(F.avg("predicted_readmit_probability").alias("mean_probability_all"),
                   F.count(F.lit(1)).alias("n_predictions"))
    n_pred = al.select("n_predictions").scalar()
    return auc.select(
        "*", mp.select("mean_probability").scalar().alias("mean_probability"),
        mp.select("base_rate").scalar().alias("base_rate"),
        F.lit(model.threshold).alias("threshold"),
        al.select("mean_probability_all").scalar().alias("mean_probability_all"),
        n_pred.alias("n_predictions"),
        # the health check's "predictions table is not empty"
        (n_pred >= 1).alias("predictions_present"))


# ---------------------------------------------------------------- later loads
from wardstar.plans import load_queries as _loads  # noqa: E402

_loads.add_vitals_queries(_VITALS_SQL)
_SPARK.update(_loads.QUERIES)
_SQL.update(_loads.ORACLE_SQL)


# ------------------------------------------------- training-data operators
try:
    import corpus_pipeline as _pipeline
    from wardstar.llm import queries as _llm
except ModuleNotFoundError as missing:  # the subpackage is optional
    if missing.name not in ("wardstar.llm", "wardstar.llm.queries", "corpus_pipeline"):
        raise
else:
    _SPARK.update(_llm.QUERIES)
    _SQL.update(_llm.ORACLE_SQL)
    _SPARK["pipeline"] = _pipeline.run
    if _pipeline.ORACLE_SQL is not None:
        _SQL["pipeline"] = _pipeline.ORACLE_SQL


# ---------------------------------------------------------------- contract
def entry(spark: SparkSession) -> DataFrame:
    """Flagship: readmission mart by department over the cleaned star."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return q_mart_dep(spark, FLAGSHIP_SF)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_SPARK)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
