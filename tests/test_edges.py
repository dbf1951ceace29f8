"""Cases that once lost or changed data: sizes, NULL groups, offsets, plans."""

import re

from pyspark.sql import functions as F

from conftest import SF_SMALL
from wardstar.functions.rounding import exact_mean_2dp, exact_pct_2dp
from wardstar.operators import metrics as mx
from wardstar.operators.chunking import chunk_documents
from wardstar.operators.history import scd2_merge
from wardstar.operators.rownum import global_row_number
from wardstar.operators.sampling import balanced_weights, stratified_split
from wardstar.plans import inputs
from wardstar.plans.star import interpolate_dates
from wardstar.session import materialize, release_scratch, scratch_path
from wardstar.sources.paths import exists
from wardstar.streaming.vitals import parse_vitals


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_null_groups_are_kept(spark):
    df = spark.range(90).select(F.col("id").alias("encounter_id"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("y"))
    s = stratified_split(df, "y", 0.2, 42)
    assert {(r.y, r.split): r["count"] for r in s.groupBy("y", "split").count().collect()} == {
        (y, t): n for y in (None, 1, 2) for t, n in (("test", 6), ("train", 24))}
    assert balanced_weights(df, "y").where("weight = 1.0").count() == 90
    n = global_row_number(df, ["encounter_id"], partition_cols=["y"], total_col="n").where("y is null")
    assert sorted(r.row_num for r in n.collect()) == list(range(1, 31)) and n.first().n == 30


def test_auc_of_billions_of_rows(spark):
    n = 3_000_000_000
    c = spark.createDataFrame([(0.1, 0, n, 0), (0.5, n, n, n), (0.9, n, 0, 2 * n)],
                              "score double, pos long, neg long, neg_below long")
    r = mx.auc_of_counts(c).first()
    assert (r.n_pos, r.n_neg) == (2 * n, 2 * n) and r.roc_auc == 0.875


def test_rounding_of_large_counts(spark):
    rows = [(33792950972247, 56360003655621), (10 ** 13 - 1, 10 ** 13), (10 ** 17, 3 * 10 ** 17), (1, 0), (5, 1000)]
    got = spark.createDataFrame(rows, "a long, n long").select(
        exact_pct_2dp(F.col("a"), F.col("n")).alias("p"), exact_mean_2dp(F.col("a"), F.col("n")).alias("m")).collect()
    for (a, n), r in zip(rows, got):
        want = [None, None] if not n else [((2 * k * a + n) // (2 * n)) / 100 for k in (10000, 100)]
        assert [r.p, r.m] == want


def test_unchanged_rows_without_a_key(spark):
    df = spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string")
    h = None
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        h = scd2_merge(h, df, "k", ["v"], day)
    assert h.count() == 2


def test_time_offsets(spark):
    texts = ["2024-01-01T10:00:00+07:00", "2024-01-01T10:00:00Z", "2024-01-01T10:00:00", "2024-01-01 10:00:00-0130",
             "2024-01-01", "bad", None]
    df = spark.createDataFrame([(f'{{"encounter_id": {i}, "timestamp": "{t}"}}' if t else "{}",)
                                for i, t in enumerate(texts)], "value string")
    for zone in ("UTC", "Asia/Tokyo"):
        old = spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = [str(r.event_time) for r in parse_vitals(df).collect()]
        finally:
            spark.conf.set("spark.sql.session.timeZone", old)
        assert got == ["2024-01-01 03:00:00", "2024-01-01 10:00:00", "2024-01-01 10:00:00", "2024-01-01 11:30:00",
                       "2024-01-01 00:00:00", "None", "None"]


def test_wide_rows_are_not_shuffled_for_dates(spark):
    wide = inputs.encounter_raw(spark, SF_SMALL)
    raw = materialize(wide, "wide")
    assert "Exchange" not in _plan(interpolate_dates(raw, "encounter_id"))
    empty = interpolate_dates(raw.limit(0), "encounter_id")
    assert empty.count() == 0 and "admission_date" in empty.columns


def test_texts_are_cut_once(spark):
    path = scratch_path(spark, "docs")
    spark.createDataFrame([(1, "a b c"), (2, ""), (3, None)], "doc_id long, text string").write.parquet(path)
    out = chunk_documents(spark.read.parquet(path), size=2, overlap=1)
    assert len(re.findall(r"split\(", _plan(out))) <= 1
    assert sorted((r.doc_id, r.chunk_id, r.text) for r in out.collect()) == [(1, 0, "a b"), (1, 1, "b c")]


def test_check_suite_scans(spark):
    from wardstar.operators import quality as qa
    suite = qa.star_tests(inputs.encounter_star(spark, SF_SMALL))
    plan = suite._jdf.queryExecution().optimizedPlan().toString()
    # one read per key test, two per relationship, one for all row tests
    assert len(re.findall("Relation", plan)) == 5 + 2 * 3 + 1


def test_curve_reads_its_counts_once(spark):
    df = materialize(spark.range(100).selectExpr("id % 2 AS label", "id / 7.0 AS score"), "scores")
    plan = mx.pr_curve(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" not in plan and len(re.findall("Relation", plan)) == 2


def test_release_removes_the_folder(spark, monkeypatch, tmp_dir):
    import wardstar.session as ws
    monkeypatch.setattr(ws, "_scratch_root", lambda s: f"{tmp_dir}/root")
    path = materialize(spark.range(3), "temporary").inputFiles()[0]
    assert exists(spark, path)
    release_scratch(spark)
    assert not exists(spark, path)
