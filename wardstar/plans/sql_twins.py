"""DuckDB twins of the registered Spark queries, for the correctness check.

Each string runs on DuckDB over the shared test tables and must give the same
rows as the Spark query of the same name. The encounter star is rebuilt in SQL
as a chain of CTEs; Spark builds it with the library functions.
"""

from __future__ import annotations

from ..sources.fixtures import LOOKUP_SQL, encounter_sql


def icd9_case(c: str) -> str:
    d = f"TRY_CAST({c} AS DOUBLE)"
    return (f"CASE WHEN {c} IS NULL THEN 'Unknown' "
            f"WHEN {c} LIKE 'V%' THEN 'Supplemental (V-code)' "
            f"WHEN {c} LIKE 'E%' THEN 'External cause (E-code)' "
            f"WHEN {d} >= 250 AND {d} < 251 THEN 'Diabetes' "
            f"WHEN ({d} >= 390 AND {d} <= 459) OR {d} = 785 THEN 'Circulatory' "
            f"WHEN ({d} >= 460 AND {d} <= 519) OR {d} = 786 THEN 'Respiratory' "
            f"WHEN ({d} >= 520 AND {d} <= 579) OR {d} = 787 THEN 'Digestive' "
            f"WHEN {d} >= 580 AND {d} <= 629 THEN 'Genitourinary' "
            f"WHEN {d} >= 800 AND {d} <= 999 THEN 'Injury' "
            f"WHEN {d} >= 710 AND {d} <= 739 THEN 'Musculoskeletal' "
            f"WHEN {d} >= 140 AND {d} <= 239 THEN 'Neoplasms' "
            f"ELSE 'Other' END")


RISK_CASE = ("CASE WHEN prior_visits_total >= 3 OR number_inpatient >= 2 THEN 'High' "
             "WHEN prior_visits_total >= 1 THEN 'Medium' ELSE 'Low' END")


def half_up_2dp(num: str, den: str, scale: int) -> str:
    den = f"NULLIF(CAST({den} AS BIGINT), 0)"
    return (f"((CAST({2 * scale} AS BIGINT) * CAST({num} AS BIGINT) + {den}) // (2 * {den}))"
            f" / CAST(100.0 AS DOUBLE)")


def lookup_cte(name: str, desc: str) -> str:
    return (f"SELECT CAST(id AS INTEGER) AS {name}, trim(description) AS {desc} "
            f"FROM ({LOOKUP_SQL[name]}) s")


STAR_CTES = f"""
enc AS ({encounter_sql('//')}),
lk_type AS ({lookup_cte('admission_type_id', 'admission_type_desc')}),
lk_disp AS ({lookup_cte('discharge_disposition_id', 'discharge_disposition_desc')}),
lk_src AS ({lookup_cte('admission_source_id', 'admission_source_desc')}),
step_null AS (
  SELECT * EXCLUDE (weight, race, payer_code, medical_specialty, diag_1, diag_2, diag_3),
         NULLIF(race, '?') AS race, NULLIF(payer_code, '?') AS payer_code,
         NULLIF(medical_specialty, '?') AS medical_specialty,
         NULLIF(diag_1, '?') AS diag_1, NULLIF(diag_2, '?') AS diag_2,
         NULLIF(diag_3, '?') AS diag_3
  FROM enc),
step_fill AS (
  SELECT * EXCLUDE (race, payer_code, medical_specialty),
         COALESCE(race, 'Unknown') AS race, COALESCE(payer_code, 'Unknown') AS payer_code,
         COALESCE(medical_specialty, 'Unknown') AS medical_specialty
  FROM step_null),
step_excl AS (SELECT * FROM step_fill WHERE discharge_disposition_id NOT IN (11, 19, 20, 21)),
step_rn AS (
  SELECT *, row_number() OVER (ORDER BY encounter_id) AS _rn, count(*) OVER () AS _total
  FROM step_excl),
step_dates AS (
  SELECT * EXCLUDE (_rn, _total, time_in_hospital),
         CAST(DATE '1999-01-01' + CAST(trunc(_rn / _total * 3650) AS INTEGER) AS DATE)
           AS admission_date,
         time_in_hospital AS los_days
  FROM step_rn),
step_feat AS (
  SELECT *, CAST(admission_date + los_days AS DATE) AS discharge_date,
         {icd9_case('diag_1')} AS diag_1_group,
         number_outpatient + number_emergency + number_inpatient AS prior_visits_total,
         CASE WHEN readmitted = '<30' THEN 1 ELSE 0 END AS readmitted_30d
  FROM step_dates),
clean AS (
  SELECT f.*, {RISK_CASE} AS readmit_risk_flag,
         COALESCE(t.admission_type_desc, 'Unknown') AS admission_type_desc,
         COALESCE(d.discharge_disposition_desc, 'Unknown') AS discharge_disposition_desc,
         COALESCE(s.admission_source_desc, 'Unknown') AS admission_source_desc
  FROM step_feat f
  LEFT JOIN lk_type t ON f.admission_type_id = t.admission_type_id
  LEFT JOIN lk_disp d ON f.discharge_disposition_id = d.discharge_disposition_id
  LEFT JOIN lk_src s ON f.admission_source_id = s.admission_source_id),
dim_patient AS (
  SELECT patient_nbr, race, gender, age,
         row_number() OVER (ORDER BY patient_nbr) AS patient_key
  FROM (SELECT patient_nbr, arg_min(race, encounter_id) AS race,
               arg_min(gender, encounter_id) AS gender, arg_min(age, encounter_id) AS age
        FROM clean GROUP BY patient_nbr) p),
dim_department AS (
  SELECT medical_specialty,
         row_number() OVER (ORDER BY medical_specialty) AS department_key
  FROM (SELECT DISTINCT medical_specialty FROM clean) d),
dim_diagnosis AS (
  SELECT diag_1_group, admission_type_desc, discharge_disposition_desc, admission_source_desc,
         row_number() OVER (ORDER BY diag_1_group, admission_type_desc,
                            discharge_disposition_desc, admission_source_desc) AS diagnosis_key
  FROM (SELECT DISTINCT diag_1_group, admission_type_desc, discharge_disposition_desc,
               admission_source_desc FROM clean) d),
dim_date AS (
  SELECT full_date, CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key,
         CAST(year(full_date) AS INTEGER) AS year, CAST(month(full_date) AS INTEGER) AS month,
         CAST(day(full_date) AS INTEGER) AS day, CAST(quarter(full_date) AS INTEGER) AS quarter,
         dayname(full_date) AS day_of_week
  FROM (SELECT CAST(unnest(generate_series(min(admission_date), max(discharge_date),
                                           INTERVAL 1 DAY)) AS DATE) AS full_date
        FROM clean) g),
fact_admission AS (
  SELECT c.encounter_id, p.patient_key, dd.department_key, di.diagnosis_key,
         CAST(strftime(c.admission_date, '%Y%m%d') AS INTEGER) AS date_key,
         c.los_days, c.num_lab_procedures, c.num_procedures, c.num_medications,
         c.number_diagnoses, c.prior_visits_total, c.readmit_risk_flag, c.readmitted,
         c.readmitted_30d, CAST(year(c.admission_date) AS INTEGER) AS admission_year,
         CAST(month(c.admission_date) AS INTEGER) AS admission_month
  FROM clean c
  LEFT JOIN dim_patient p ON c.patient_nbr = p.patient_nbr
  LEFT JOIN dim_department dd ON c.medical_specialty = dd.medical_specialty
  LEFT JOIN dim_diagnosis di ON c.diag_1_group = di.diag_1_group
    AND c.admission_type_desc = di.admission_type_desc
    AND c.discharge_disposition_desc = di.discharge_disposition_desc
    AND c.admission_source_desc = di.admission_source_desc)
"""


def with_star(select: str, extra_ctes: str = "") -> str:
    extra = f",\n{extra_ctes}" if extra_ctes else ""
    return f"WITH {STAR_CTES.strip()}{extra}\n{select}"


# DuckDB type names as Spark prints them (``DataType.simpleString``).
SPARK_TYPE_NAMES = {"VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int",
                    "DOUBLE": "double", "DATE": "date", "BOOLEAN": "boolean"}


def schema_profile(view: str, columns: list[str]) -> str:
    """(position, column_name, data_type, n_rows, n_cols) of ``view``.

    ``typeof`` is resolved when the query is bound, so a scalar subquery per
    column gives the column's type even for an empty view.
    """
    names = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SPARK_TYPE_NAMES.items())
    parts = [f"SELECT CAST({i + 1} AS INTEGER) AS position, '{c}' AS column_name, "
             f"typeof((SELECT {c} FROM {view} LIMIT 1)) AS t" for i, c in enumerate(columns)]
    return (f"SELECT position, column_name, CASE t {names} ELSE lower(t) END AS data_type, "
            f"(SELECT count(*) FROM {view}) AS n_rows, CAST({len(columns)} AS INTEGER) AS n_cols "
            f"FROM ({' UNION ALL '.join(parts)}) s")
