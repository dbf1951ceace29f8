"""Adapters from the shared test tables to the encounter domain.

The raw encounter file is not distributed, so the tests derive encounter rows,
code lookups, vitals messages and attribute histories from the TPC-H-like
tables by fixed rules. The same SQL expressions feed Spark and the DuckDB
oracle; only integer division is spelled differently (``DIV`` / ``//``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _diag(k: str) -> str:
    return (f"CASE {k} % 11 WHEN 0 THEN '?' WHEN 1 THEN 'V45' WHEN 2 THEN 'E812' "
            f"WHEN 3 THEN '250.83' WHEN 4 THEN '459.5' WHEN 5 THEN '785' "
            f"ELSE CAST(140 + ({k}*37) % 860 AS STRING) END")


def encounter_exprs(div: str = "DIV") -> list[str]:
    """Raw encounter columns over ``orders JOIN customer ON o_custkey = c_custkey``."""
    return [
        "o_orderkey AS encounter_id",
        "o_custkey AS patient_nbr",
        "CASE WHEN c_mktsegment = 'MACHINERY' THEN '?' ELSE c_mktsegment END AS race",
        "CASE WHEN c_nationkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender",
        "CONCAT('[', CAST(10*(o_orderkey % 10) AS STRING), '-', "
        "CAST(10*(o_orderkey % 10)+10 AS STRING), ')') AS age",
        "'?' AS weight",
        "CAST(1 + o_orderkey % 9 AS INT) AS admission_type_id",
        "CAST(1 + o_orderkey % 30 AS INT) AS discharge_disposition_id",
        "CAST(1 + o_orderkey % 27 AS INT) AS admission_source_id",
        "CAST(1 + o_orderkey % 14 AS INT) AS time_in_hospital",
        "CASE WHEN o_orderkey % 3 = 0 THEN '?' ELSE o_orderstatus END AS payer_code",
        "CASE WHEN o_custkey % 5 = 0 THEN '?' ELSE o_orderpriority END AS medical_specialty",
        "CAST(1 + o_orderkey % 97 AS INT) AS num_lab_procedures",
        "CAST(o_orderkey % 7 AS INT) AS num_procedures",
        "CAST(1 + o_orderkey % 40 AS INT) AS num_medications",
        "CAST(o_custkey % 3 AS INT) AS number_outpatient",
        "CAST(o_orderkey % 2 AS INT) AS number_emergency",
        f"CAST((o_orderkey {div} 7) % 3 AS INT) AS number_inpatient",
        f"{_diag('o_orderkey')} AS diag_1",
        f"{_diag('(o_orderkey + 1)')} AS diag_2",
        f"{_diag('(o_orderkey + 2)')} AS diag_3",
        "CAST(1 + o_orderkey % 16 AS INT) AS number_diagnoses",
        "CASE o_orderstatus WHEN 'P' THEN '<30' WHEN 'F' THEN '>30' ELSE 'NO' END AS readmitted",
    ]


def encounter_sql(div: str = "//") -> str:
    """The encounter view as one SELECT (DuckDB spelling by default)."""
    return ("SELECT " + ",\n       ".join(encounter_exprs(div))
            + "\nFROM orders JOIN customer ON o_custkey = c_custkey")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def encounters_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    customer = read_table(spark, sf_dir, "customer")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")
    return joined.selectExpr(*encounter_exprs("DIV"))


# Code lookups derived from region / nation. Ids the encounters use but the
# lookups lack (admission type 6-9, disposition 26-30, sources of ASIA
# nations) exercise the "Unknown" path; the source descriptions carry a comma
# so the CSV round trip needs quoting.
LOOKUP_SQL = {
    "admission_type_id":
        "SELECT CAST(r_regionkey + 1 AS INT) AS id, r_name AS description FROM region",
    "discharge_disposition_id":
        "SELECT CAST(n_nationkey + 1 AS INT) AS id, n_name AS description FROM nation",
    "admission_source_id":
        "SELECT CAST(n_nationkey + 1 AS INT) AS id, "
        "CONCAT(n_name, ', region ', CAST(n_regionkey AS STRING)) AS description "
        "FROM nation WHERE n_regionkey <> 2",
}
# Odd lines at the end of every block: text, then the id and description that a
# reader must see.
LOOKUP_ODD_LINES = [
    ('901,"He said ""go"" now, ok"', "901", 'He said "go" now, ok'),
    ('902\t,\tTabs around\t', "902", "Tabs around"),
    ('1,Listed twice', "1", "Listed twice"),
]


def lookup_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    region = read_table(spark, sf_dir, "region")
    nation = read_table(spark, sf_dir, "nation")
    return {
        "admission_type_id": region.select(
            (F.col("r_regionkey") + 1).cast("int").alias("id"),
            F.col("r_name").alias("description")),
        "discharge_disposition_id": nation.select(
            (F.col("n_nationkey") + 1).cast("int").alias("id"),
            F.col("n_name").alias("description")),
        "admission_source_id": nation.filter(F.col("n_regionkey") != 2).select(
            (F.col("n_nationkey") + 1).cast("int").alias("id"),
            F.concat(F.col("n_name"), F.lit(", region "),
                     F.col("n_regionkey").cast("string")).alias("description")),
    }


def _literal_lines(spark: SparkSession, rows) -> DataFrame:
    """A few fixed (place, value) rows as a JVM-side literal table."""
    structs = [F.struct(_place(*at).alias("place"), F.lit(v).alias("value")) for at, v in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def _place(block: int, part: int, at) -> Column:
    """Where a line stands: block, then header (0), rows (1) or end (2), then id."""
    at = at if isinstance(at, Column) else F.lit(at)
    return F.struct(F.lit(block).alias("block"), F.lit(part).alias("part"),
                    at.cast("long").alias("at"))


def stacked_lookup_lines(spark: SparkSession, sf_dir: str,
                         file_name: str = "ids_mapping.csv") -> DataFrame:
    """Write the lookups as one stacked CSV text, as lines (file, line_no, value).

    Each block: a header ``<block>,description``, CSV rows (quoted where
    needed, some descriptions with a leading blank), a non-numeric id row, a row
    with doubled quotes, a row with tabs, a repeated id that must lose against
    the first, and a separator line ``,``. One line sits before any header and
    one is blank; both must be ignored by the parser.
    """
    parts = [_literal_lines(spark, [((-1, 0, 0), "orphan,row before any header"), ((-1, 0, 1), "")])]
    for b, (name, tbl) in enumerate(lookup_tables(spark, sf_dir).items()):
        desc = F.when(F.col("id") % 2 == 1, F.concat(F.lit(" "), F.col("description"))) \
            .otherwise(F.col("description"))
        parts.append(tbl.select(
            _place(b, 1, F.col("id")).alias("place"),
            F.to_csv(F.struct(F.col("id").cast("string").alias("id"), desc.alias("d")))
            .alias("value")))
        parts.append(_literal_lines(spark, [
            ((b, 0, 0), f"{name},description"), ((b, 0, 1), "n/a,Not a code"),
            *(((b, 2, i), line) for i, (line, _, _) in enumerate(LOOKUP_ODD_LINES)),
            ((b, 3, 0), ",")]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    # a code file is a handful of lines: keep it in one partition
    lines = out.coalesce(1).withColumn("line_no", F.row_number().over(
        Window.partitionBy(F.lit(1)).orderBy("place")).cast("long"))
    return lines.withColumn("file", F.lit(file_name)).select("file", "line_no", "value")


def vitals_message_exprs() -> dict[str, str]:
    """Fields of a vitals message derived from one ``events`` row (SQL text).

    Heart rate 40 + k (k from ``props``), SpO2 80..100; ``view`` events with
    an id divisible by 3 carry no SpO2, ``signup`` events carry a bad time
    text and ``error`` events are not JSON at all.
    """
    return {
        "k": "CAST(get_json_object(props, '$.k') AS INT)",
        "heart_rate": "CAST(40 + CAST(get_json_object(props, '$.k') AS INT) AS INT)",
        "blood_pressure_sys": "CAST(90 + event_id % 71 AS INT)",
        "spo2": "CASE WHEN event_type = 'view' AND event_id % 3 = 0 THEN NULL "
                "ELSE CAST(80 + event_id % 21 AS INT) END",
        "timestamp": "CASE WHEN event_type = 'signup' THEN CONCAT('not-a-time-', "
                     "CAST(event_id AS STRING)) ELSE "
                     "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") END",
    }


def vitals_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON message per event (``value`` string), with extra fields."""
    e = read_table(spark, sf_dir, "events")
    x = vitals_message_exprs()
    body = F.to_json(F.struct(
        F.col("event_id").alias("encounter_id"), F.col("user_id").alias("patient_nbr"),
        F.expr(x["timestamp"]).alias("timestamp"), F.expr(x["heart_rate"]).alias("heart_rate"),
        F.expr(x["blood_pressure_sys"]).alias("blood_pressure_sys"),
        F.expr(x["spo2"]).alias("spo2"), F.col("event_type"), F.col("value")))
    junk = F.concat(F.lit("not json "), F.col("event_id").cast("string"))
    return e.select(F.when(F.col("event_type") == "error", junk).otherwise(body).alias("value"))
