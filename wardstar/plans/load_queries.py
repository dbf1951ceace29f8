"""Queries over later loads, scans with quarantine, restarted and compacted
streams and small sinks, for the driver entry, with DuckDB twins.

The cleaned encounters come in two loads, a third of the ids in the second,
which also delivers some encounters of the first again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.versions import VersionedTable
from . import inputs, loads
from . import sql_twins as tw
from .marts import DEPARTMENT_MART, DIAGNOSIS_MART

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

_FIRST = "encounter_id % 3 <> 0"
_SECOND = "encounter_id % 3 = 0 OR encounter_id % 50 = 0"
_LOADED: dict[tuple[str, str], str] = {}


def _query(name: str, sql: str):
    def deco(fn):
        QUERIES[name] = fn
        ORACLE_SQL[name] = sql
        return fn
    return deco


def two_loads(spark: SparkSession, sf_dir: str) -> str:
    """The folder of a warehouse filled by two loads, once per session and input;
    mart states are refreshed after each load."""
    at = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if at not in _LOADED:
        folder = scratch_path(spark, "loads")
        clean = inputs.encounter_star(spark, sf_dir)["clean"]
        fact = VersionedTable(spark, f"{folder}/fact_admission")
        for batch in (_FIRST, _SECOND):
            loads.load_fact(spark, clean.where(batch), folder)
            for mart in (DEPARTMENT_MART, DIAGNOSIS_MART):
                loads.refresh_mart(VersionedTable(spark, f"{folder}/state_{mart[0]}"), fact, mart)
        _LOADED[at] = folder
    return _LOADED[at]


def _members_sql(dim: str, cols: list[str]) -> str:
    c = ", ".join(cols)
    name = " || '|' || ".join(f"CAST({x} AS VARCHAR)" for x in cols)
    return (f"SELECT '{dim}' AS dim, {name} AS member, CAST(row_number() OVER (ORDER BY load, {c}) AS BIGINT) AS key, load "
            f"FROM (SELECT {c}, CAST(min(CASE WHEN {_FIRST} THEN 1 ELSE 2 END) AS INTEGER) AS load "
            f"FROM clean GROUP BY {c})")


@_query("keys_second_load", tw.with_star(" UNION ALL ".join(
    _members_sql(n, cols) for n, (cols, _) in loads.REGISTRIES.items())))
def q_keys(spark, sf):
    """All registered members after two loads: those of the first keep their keys."""
    folder = two_loads(spark, sf)
    parts = [r.read().select(F.lit(n).alias("dim"), F.concat_ws("|", *r.natural_cols).alias("member"),
                             F.col(r.key).alias("key"), "load")
             for n, r in loads.registries(spark, folder).items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_FACT_VALUES = ["encounter_id", "date_key", "los_days", "num_medications", "prior_visits_total",
                "readmit_risk_flag", "readmitted_30d", "admission_year", "admission_month"]


@_query("fact_second_load", tw.with_star(
    "SELECT " + ", ".join(f"f.{c}" for c in _FACT_VALUES)
    + ", p.patient_nbr, d.medical_specialty, g.diag_1_group, g.admission_type_desc FROM fact_admission f "
    "JOIN dim_patient p USING (patient_key) JOIN dim_department d USING (department_key) "
    "JOIN dim_diagnosis g USING (diagnosis_key)"))
def q_fact(spark, sf):
    """The fact of two loads, its keys resolved, equals the fact of one."""
    folder = two_loads(spark, sf)
    out = VersionedTable(spark, f"{folder}/fact_admission").read()
    for r in loads.registries(spark, folder).values():
        out = out.join(r.read().drop("load"), r.key)
    return out.select(*_FACT_VALUES, "patient_nbr", "medical_specialty", "diag_1_group", "admission_type_desc")


def _mart_sql(table: str, key: str, group: str, source: str, name: str) -> str:
    return tw.with_star(
        f"SELECT {group}, count(*) AS n_encounters, CAST(sum(f.readmitted_30d) AS BIGINT) AS n_readmit_30d, "
        f"{tw.half_up_2dp('sum(f.readmitted_30d)', 'count(*)', 10000)} AS readmit_rate_pct, "
        f"{tw.half_up_2dp('sum(f.los_days)', 'count(*)', 100)} AS avg_los_days, "
        f"{tw.half_up_2dp(f'sum(f.{source})', 'count(*)', 100)} AS {name} "
        f"FROM fact_admission f JOIN {table} USING ({key}) GROUP BY {group}")


def _mart(spark, sf, mart, name):
    folder = two_loads(spark, sf)
    return loads.mart_from_states(VersionedTable(spark, f"{folder}/state_{mart[0]}"),
                                  loads.registries(spark, folder)[name].read(), mart)


@_query("mart_department_states", _mart_sql(
    "dim_department", "department_key", "medical_specialty", "num_medications", "avg_medications"))
def q_mart_department(spark, sf):
    return _mart(spark, sf, DEPARTMENT_MART, "department")


@_query("mart_diagnosis_states", _mart_sql(
    "dim_diagnosis", "diagnosis_key", "diag_1_group", "prior_visits_total", "avg_prior_visits"))
def q_mart_diagnosis(spark, sf):
    return _mart(spark, sf, DIAGNOSIS_MART, "diagnosis")


@_query("keys_repeated_across_loads",
        "SELECT l_orderkey, l_linenumber, count(*) AS n_rows, count(DISTINCT l_partkey % 3) AS n_parts "
        "FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def q_repeated(spark, sf):
    """Line items in three loads; repeated keys from the states of the loads."""
    items = spark.read.parquet(f"{sf}/lineitem.parquet")
    source, state = (VersionedTable(spark, scratch_path(spark, n)) for n in ("line-items", "key-counts"))
    part = F.format_string("load-%d", F.col("l_partkey") % 3)
    for i in range(3):
        source.put_parts(items.where(F.col("l_partkey") % 3 == i), part)
        loads.refresh_key_counts(state, source, part, ["l_orderkey", "l_linenumber"])
    return loads.repeated_keys(state, ["l_orderkey", "l_linenumber"])


# Two versions of an attribute table derived from customer. In the second some
# keys are repeated: with a greater nation, which loses, or without a segment.
_V1 = ("SELECT c_custkey AS key, c_mktsegment AS segment, c_nationkey AS nation FROM customer "
       "WHERE c_custkey % 8 <> 1")
_V2 = ("SELECT c_custkey AS key, CASE WHEN c_custkey % 7 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS segment, "
       "c_nationkey AS nation FROM customer WHERE c_custkey % 11 <> 2")
_V2_REPEATED = (f"{_V2} UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'CHANGED' ELSE c_mktsegment END, "
                f"c_nationkey + 1 FROM customer WHERE c_custkey % 5 = 0 AND c_custkey % 11 <> 2 "
                f"UNION ALL SELECT c_custkey, NULL, c_nationkey FROM customer WHERE c_custkey % 60 = 0 AND c_custkey % 11 <> 2")


@_query("history_three_loads", f"""
WITH v1 AS ({_V1}), v2 AS (
  SELECT key, segment, nation FROM (SELECT *, row_number() OVER (
    PARTITION BY key ORDER BY segment NULLS FIRST, nation NULLS FIRST) AS i FROM ({_V2_REPEATED})) WHERE i = 1),
j AS (SELECT v1.key AS k1, v1.segment AS s1, v1.nation AS n1, v2.key AS k2, v2.segment AS s2, v2.nation AS n2,
        v1.key IS NOT NULL AND v2.key IS NOT NULL AND (v1.segment IS DISTINCT FROM v2.segment
          OR v1.nation IS DISTINCT FROM v2.nation) AS changed
      FROM v1 FULL OUTER JOIN v2 ON v1.key = v2.key)
SELECT k1 AS key, s1 AS segment, n1 AS nation, DATE '2024-01-01' AS valid_from,
       CASE WHEN changed THEN DATE '2024-02-01' END AS valid_to FROM j WHERE k1 IS NOT NULL
UNION ALL
SELECT k2, s2, n2, DATE '2024-02-01', CAST(NULL AS DATE) FROM j WHERE k2 IS NOT NULL AND (k1 IS NULL OR changed)""")
def q_history(spark, sf):
    """Three runs of the bucketed history; the third sees no change."""
    view = "wardstar_customer_loads"
    spark.read.parquet(f"{sf}/customer.parquet").createOrReplaceTempView(view)
    path = scratch_path(spark, "history")
    for sql, as_of in ((_V1, "2024-01-01"), (_V2_REPEATED, "2024-02-01"), (_V2_REPEATED, "2024-03-01")):
        current = spark.sql(sql.replace("FROM customer", f"FROM {view}"))
        loads.snapshot_buckets(spark, path, current, "key", ["segment", "nation"], as_of, n_buckets=16)
    return VersionedTable(spark, path).read()


@_query("star_versions", tw.with_star(
    "SELECT 'fact_admission' AS name, count(*) AS n, CAST(sum(los_days) AS BIGINT) AS total FROM fact_admission "
    "UNION ALL SELECT 'dim_patient', count(*), CAST(sum(patient_key) AS BIGINT) FROM dim_patient "
    "UNION ALL SELECT 'dim_date', count(*), CAST(sum(date_key) AS BIGINT) FROM dim_date"))
def q_star_versions(spark, sf):
    """The star replaced through commit pointers: a part of it first, then all."""
    from ..sources.sinks import read_table, replace_star
    star = inputs.encounter_star(spark, sf)
    tables = {n: star[n] for n in ("fact_admission", "dim_patient", "dim_date")}
    path = scratch_path(spark, "star-versions")
    replace_star({**tables, "fact_admission": star["fact_admission"].where("admission_year < 2003")}, path)
    replace_star(tables, path)
    parts = [read_table(spark, f"{path}/{n}").agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n"),
                                                  F.sum(c).cast("long").alias("total"))
             for n, c in (("fact_admission", "los_days"), ("dim_patient", "patient_key"), ("dim_date", "date_key"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ------------------------------------------------------------ scan with quarantine
# A third of the days in hospital is no number where the id divides by 97; files
# come with their columns forwards and backwards; one group of files has no
# column ``readmitted``.
_LACKING, _BAD_DAYS = "encounter_id % 89 = 0", "encounter_id % 97 = 0"


@_query("encounter_quarantine", tw.with_star(
    f"SELECT 'kept' AS status, readmitted AS detail, count(*) AS n, CAST(sum(time_in_hospital) AS BIGINT) AS days, "
    f"CAST(sum(encounter_id) AS BIGINT) AS ids FROM enc WHERE NOT ({_LACKING}) AND NOT ({_BAD_DAYS}) GROUP BY readmitted "
    f"UNION ALL SELECT 'rejected', 'malformed', count(*), NULL, NULL FROM enc WHERE NOT ({_LACKING}) AND {_BAD_DAYS} "
    f"UNION ALL SELECT 'rejected', 'header lacks readmitted', count(*), NULL, NULL FROM enc WHERE {_LACKING} "
    f"UNION ALL SELECT 'check', 'rejects', CAST(count(*) FILTER (WHERE {_LACKING} OR {_BAD_DAYS}) AS BIGINT), 0, count(*) FROM enc"))
def q_quarantine(spark, sf):
    """Kept rows, rejected lines by reason, and the check that they are all lines."""
    from ..operators.quality import check_rejects
    from ..sources.encounters import ENCOUNTER_SCHEMA, count_lines, scan_encounters
    names = [f.name for f in ENCOUNTER_SCHEMA.fields]
    raw = inputs.encounter_raw(spark, sf).select(*[F.col(c).cast("string") for c in names]).withColumn(
        "time_in_hospital", F.when(F.expr(_BAD_DAYS), F.concat("time_in_hospital", F.lit(" days")))
        .otherwise(F.col("time_in_hospital")))
    path = scratch_path(spark, "encounters-mixed")
    groups = [(f"NOT ({_LACKING}) AND encounter_id % 2 = 0", names), (f"NOT ({_LACKING}) AND encounter_id % 2 = 1", names[::-1]),
              (_LACKING, [c for c in names if c != "readmitted"])]
    for where, columns in groups:
        raw.where(where).select(*columns).write.mode("append").option("header", True).csv(path)
    kept, rejected = scan_encounters(spark, path)
    n = count_lines(spark, path)
    null = F.lit(None).cast("long")
    good = kept.groupBy(F.lit("kept").alias("status"), F.col("readmitted").alias("detail")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("time_in_hospital").alias("days"), F.sum("encounter_id").alias("ids"))
    bad = rejected.groupBy(F.lit("rejected").alias("status"), F.col("reason").alias("detail")).agg(
        F.count(F.lit(1)).alias("n"), F.first(null).alias("days"), F.first(null).alias("ids"))
    check = check_rejects(rejected, "encounters", n, kept, most_percent=10.0).select(
        F.lit("check").alias("status"), F.col("check_name").alias("detail"), F.col("n_rejected").alias("n"),
        F.col("failures").cast("long").alias("days"), F.lit(n).cast("long").alias("ids"))
    return good.unionByName(bad).unionByName(check)


# ------------------------------------------------------------ small sinks and sources
@_query("json_messages", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def q_json(spark, sf):
    """Rows sent as JSON messages to a text topic, read back and parsed."""
    from ..sources.sinks import publish_json
    customers = spark.read.parquet(f"{sf}/customer.parquet")
    path = scratch_path(spark, "topic")
    publish_json(customers, {"path": path}, fmt="text")
    return spark.read.text(path).select(F.from_json("value", customers.schema).alias("m")).select("m.*").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@_query("documents_from_folder", "SELECT text, strlen(text) AS n_bytes FROM benchmark")
def q_documents(spark, sf):
    """Every benchmark item as a text file of its own, read back whole."""
    from ..sources.documents import read_documents
    path = scratch_path(spark, "documents")
    spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").write.partitionBy("item_id").text(path)
    text = F.expr("left(text, length(text) - 1)")  # without the line end of the file
    return read_documents(spark, path).select(text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))


# ------------------------------------------------------------ streams
def vitals_restarted(spark, sf, run) -> str:
    """The vitals messages in two deliveries, the second after a restart of the
    stream on its checkpoint; ``run(raw, root)`` runs what is there to its end."""
    from ..sources.fixtures import vitals_messages
    from ..streaming.vitals import read_vitals_stream
    root = scratch_path(spark, "vitals-restart")
    messages = vitals_messages(spark, sf)
    half = F.crc32(F.col("value").cast("binary")) % 2
    for i in range(2):
        messages.where(half == i).write.mode("append").text(f"{root}/source")
        run(read_vitals_stream(spark, "text", {"maxFilesPerTrigger": "2"}, f"{root}/source"), root)
    return root


def add_vitals_queries(vitals_sql: str) -> None:
    """Registered by the entry, which holds the messages' DuckDB twin."""
    @_query("vitals_restart", vitals_sql + "SELECT * FROM v")
    def q_restart(spark, sf):
        from ..streaming.vitals import run_vitals

        def run(raw, root):
            run_vitals(spark, raw, f"{root}/all", f"{root}/alerts", f"{root}/ckpt", trigger={"availableNow": True}, wait=True)
        return spark.read.parquet(f"{vitals_restarted(spark, sf, run)}/all")

    @_query("vitals_compacted", vitals_sql + "SELECT * FROM v")
    def q_compacted(spark, sf):
        """Compacted after the first delivery and after the second, old folders
        removed in between."""
        from ..streaming.compaction import compact, read_sink, remove_compacted
        from ..streaming.vitals import run_vitals_single_read

        def run(raw, root):
            remove_compacted(spark, f"{root}/all")
            run_vitals_single_read(spark, raw, f"{root}/all", f"{root}/alerts", f"{root}/ckpt",
                                   trigger={"availableNow": True}, wait=True)
            compact(spark, f"{root}/all", f"{root}/ckpt/both")
        return read_sink(spark, f"{vitals_restarted(spark, sf, run)}/all").drop("batch_id")
