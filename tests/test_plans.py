"""Plan-shape checks: the scale properties the design relies on."""

from conftest import SF_SMALL
from wardstar.plans import inputs
from wardstar.plans.marts import mart_by_department


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_joins_are_broadcast(spark):
    from wardstar.plans.star import clean_encounters
    from wardstar.session import materialize
    raw = materialize(inputs.encounter_raw(spark, SF_SMALL), "raw")
    plan = _plan(clean_encounters(raw, inputs.lookup_blocks(spark, SF_SMALL)))
    assert plan.count("BroadcastHashJoin") >= 3
    assert "SortMergeJoin" not in plan


def test_mart_aggregates_fact_before_the_join(spark):
    s = inputs.encounter_star(spark, SF_SMALL)
    m = mart_by_department(s["fact_admission"], s["dim_department"])
    plan = m._jdf.queryExecution().sparkPlan().toString()
    # partial aggregation on the fact sits below the join with the dimension
    join_at = min(i for i in (plan.find("SortMergeJoin"), plan.find("BroadcastHashJoin"))
                  if i >= 0)
    assert "partial_sum" in plan[join_at:] or "partial_count" in plan[join_at:]


def test_fact_scan_prunes_columns(spark):
    s = inputs.encounter_star(spark, SF_SMALL)
    df = s["fact_admission"].groupBy("department_key").count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "department_key" in scan and "num_medications" not in scan


def test_feature_view_broadcasts_code_dimensions(spark):
    from wardstar.plans.marts import star_features
    s = inputs.encounter_star(spark, SF_SMALL)
    f = star_features(s["fact_admission"], s["dim_patient"], s["dim_department"],
                      s["dim_diagnosis"])
    plan = f._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 2  # department and diagnosis, before AQE


def test_relationship_check_counts_keys_before_the_anti_join(spark):
    import re

    from wardstar.operators import quality as qa
    s = inputs.encounter_star(spark, SF_SMALL)
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")  # a parent too big to broadcast
    try:
        chk = qa.check_relationships(s["fact_admission"], "fact_admission", "patient_key",
                                     s["dim_patient"], "patient_key")
        plan = chk._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set(key, old)
    anti = plan.find("LeftAnti")
    assert anti >= 0 and "SortMergeJoin" in plan
    # under the join, child rows are reduced to one row per key map-side
    assert re.search(r"HashAggregate\(keys=\[patient_key#\d+L?\], "
                     r"functions=\[partial_count\(1\)\]", plan[anti:])
