import glob

import pytest

from conftest import SF_SMALL
from wardstar.plans import inputs
from wardstar.operators import quality as qa
from wardstar.plans.warehouse import build_warehouse, floor_checks, read_history, snapshot_table
from wardstar.sources.fixtures import encounters_from_tables


def test_build_warehouse_end_to_end(spark, tmp_dir):
    raw = encounters_from_tables(spark, SF_SMALL)
    blocks = inputs.lookup_blocks(spark, SF_SMALL)
    out = build_warehouse(spark, raw, blocks, tmp_dir, "2024-01-01",
                          row_floors={"dim_department": 5})
    s = out["summary"]
    # the 15 star tests, the floor and the fan-out check pass; the readmission rate
    # of the fixture (~34 %) is outside the 5-20 % band, and nothing was predicted
    assert s["n_checks"] == 19 and s["failed_checks"] == \
        "rate_band:fact_admission:readmitted_30d,row_floor:predictions:>=1"
    assert out["open_patient_versions"] == out["counts"]["dim_patient"]
    seen = {}
    again = build_warehouse(spark, raw, blocks, tmp_dir, "2024-02-01", predictions=spark.range(3),
                            publish=lambda name, df: seen.update({name: df.count()}))
    # by default all nine floors are checked, and predictions as a tenth
    floors = {r.table_name for r in again["checks"].where("check_name = 'row_floor'").collect()}
    assert floors == {*qa.ROW_FLOORS, "predictions"}
    assert "predictions" not in again["summary"]["failed_checks"]
    assert again["published"] == seen and len(seen) == 7
    assert again["open_patient_versions"] == out["open_patient_versions"]  # no change, no versions
    snap = read_history(spark, f"{tmp_dir}/snapshot_dim_patient")
    assert snap.count() == out["counts"]["dim_patient"]


def test_unreadable_history_raises_and_stays(spark, tmp_dir):
    path = f"{tmp_dir}/history"
    one = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    two = spark.createDataFrame([(1, "x"), (2, "b")], "k int, v string")
    assert snapshot_table(spark, one, path, "k", ["v"], "2024-01-01") == 2
    assert snapshot_table(spark, two, path, "k", ["v"], "2024-02-01") == 2
    assert read_history(spark, path).count() == 3
    newest = sorted(glob.glob(f"{path}/version=*"))[-1]
    kept = {f: open(f, "rb").read() for f in glob.glob(f"{newest}/*.parquet")}
    for f in kept:
        with open(f, "wb") as out:
            out.write(b"broken")
    before = sorted(glob.glob(f"{path}/version=*/*.parquet"))
    with pytest.raises(Exception):
        snapshot_table(spark, one, path, "k", ["v"], "2024-03-01")
    assert set(before) <= set(glob.glob(f"{path}/version=*/*.parquet"))
    # an unfinished version does not count, the broken one is read again once mended
    for f, data in kept.items():
        with open(f, "wb") as out:
            out.write(data)
    assert read_history(spark, path).count() == 3


def test_a_missing_table_fails_its_floor(spark):
    got = qa.run_checks(floor_checks({"a": spark.range(3)}, {"a": 2, "b": 1})).collect()
    assert [(r.table_name, r.passed) for r in got] == [("a", True), ("b", False)]
