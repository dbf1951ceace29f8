from pyspark.sql import functions as F

from conftest import SF_SMALL
from wardstar.plans import inputs
from wardstar.plans.marts import star_features
from wardstar.plans.model import ForestParams, ReadmissionModel, high_risk, train_readmission


def test_model_mechanics_small_forest(spark, tmp_dir):
    s = inputs.encounter_star(spark, SF_SMALL)
    feats = star_features(s["fact_admission"], s["dim_patient"], s["dim_department"],
                          s["dim_diagnosis"])
    model, data, ev = train_readmission(feats, ForestParams(num_trees=5, max_depth=3, folds=3))
    preds = model.score(data)
    n = feats.count()
    assert preds.count() == n
    st = preds.agg(F.min("predicted_readmit_probability").alias("lo"),
                   F.max("predicted_readmit_probability").alias("hi"),
                   F.avg("predicted_readmit_probability").alias("m"),
                   F.avg("readmitted_30d").alias("base")).first()
    assert 0.0 <= st.lo <= st.hi <= 1.0
    assert abs(st.m - st.base) < 0.1  # sigmoid calibration pulls the mean to the base rate
    flags = preds.filter(F.col("predicted_readmit_flag") !=
                         (F.col("predicted_readmit_probability") >= model.threshold).cast("int"))
    assert flags.count() == 0
    top = model.feature_importance(spark, 10).collect()
    assert len(top) == 10 and top[0].importance >= top[-1].importance
    assert high_risk(preds, 5).count() == 5
    assert ev["roc_auc"].first().n_pos > 0
    model.save(spark, f"{tmp_dir}/model")
    again = ReadmissionModel.load(spark, f"{tmp_dir}/model")
    assert (again.threshold, again.params, again.feature_names) == (model.threshold, model.params, model.feature_names)
    assert again.score(data).exceptAll(preds).isEmpty()
    assert again.feature_importance(spark, 10).collect() == top


def test_threshold_out_of_fold(spark):
    s = inputs.encounter_star(spark, SF_SMALL)
    feats = star_features(s["fact_admission"], s["dim_patient"], s["dim_department"],
                          s["dim_diagnosis"])
    # publishing first leaves nothing in the session that a fit cannot serialise
    from wardstar.sources.sinks import publish_all
    got = publish_all({"t": spark.range(5)}, lambda name, d: d.write.format("noop").mode("overwrite").save())
    assert got == {"t": 5}
    p = ForestParams(num_trees=5, max_depth=3, folds=3, max_fit_rows=900)
    model, data, ev = train_readmission(feats, p)
    assert 0.0 < model.threshold < 1.0
    # evaluation stays on the untouched test split
    n_test = data.filter(F.col("split") == "test").count()
    r = ev["roc_auc"].first()
    assert r.n_pos + r.n_neg == n_test
    # calibration in the large on rows the sigmoids were not fitted on
    m = ev["mean_probability"].first()
    assert abs(m.mean_probability - m.base_rate) < 0.1


def test_evaluation_all_rows_and_present(spark):
    from wardstar.operators import quality as qa
    s = inputs.encounter_star(spark, SF_SMALL)
    feats = star_features(s["fact_admission"], s["dim_patient"], s["dim_department"],
                          s["dim_diagnosis"])
    model, data, ev = train_readmission(feats, ForestParams(num_trees=3, max_depth=2, folds=2))
    al = ev["all_rows"].first()
    assert al.n_predictions == feats.count()
    assert 0.0 <= al.mean_probability_all <= 1.0
    present = qa.check_row_floor(model.score(data), "predictions", 1).first()
    assert present.passed is True


def test_forest_scores_by_arrays_are_those_of_the_forest(spark):
    from pyspark.ml.feature import VectorAssembler
    from wardstar.plans.model import _positive, build_features, build_forest, forest_score
    n = lambda i: F.pmod(F.xxhash64("id", F.lit(i)), F.lit(40)).cast("int")
    rows = spark.range(3000).select(n(1).alias("a"), n(2).alias("b"), F.concat(F.lit("c"), n(3) % 5).alias("c"),
                                    F.concat(F.lit("d"), n(4) % 2).alias("d"),
                                    ((n(1) + n(3) % 5 * 9 + n(5)) > 50).cast("int").alias("readmitted_30d"))
    vectors = build_features(["a", "b"], ["c", "d"]).fit(rows).transform(rows).withColumn("weight", F.lit(1.0))
    forest = build_forest(params=ForestParams(num_trees=7, max_depth=6)).fit(vectors)
    score = forest_score(spark, forest)
    both = forest.transform(vectors).select(_positive("probability").alias("p"), score(F.col("features")).alias("q"))
    got = both.agg(F.count_if(F.col("p") != F.col("q")).alias("differ"), F.count_distinct("p").alias("values")).first()
    assert got.differ == 0 and got.values > 50
    # not a number goes right, in the arrays as in the trees
    odd = VectorAssembler(inputCols=["nan", *[f"z{i}" for i in range(forest.numFeatures - 1)]], outputCol="features",
                          handleInvalid="keep").transform(
        spark.range(1).select(F.lit(float("nan")).alias("nan"), *[F.lit(0.0).alias(f"z{i}") for i in range(forest.numFeatures - 1)]))
    r = forest.transform(odd).select(_positive("probability").alias("p"), score(F.col("features")).alias("q")).first()
    assert r.p == r.q


def test_a_forest_scores_arrow_arrays_of_any_number_of_rows(spark):
    from pyspark.util import PythonEvalType
    from wardstar.plans.model import SCORE_ROWS, _positive, build_features, build_forest, forest_score
    rows = spark.range(2 * SCORE_ROWS + 5).select(
        F.pmod(F.xxhash64("id"), F.lit(40)).alias("a"), F.concat(F.lit("c"), F.pmod(F.xxhash64("id"), F.lit(7))).alias("c"),
        F.pmod(F.hash("id"), F.lit(2)).alias("readmitted_30d")).coalesce(1)
    vectors = build_features(["a"], ["c"]).fit(rows).transform(rows).withColumn("weight", F.lit(1.0))
    forest = build_forest(params=ForestParams(num_trees=5, max_depth=4)).fit(vectors)
    both = forest.transform(vectors).select(
        _positive("probability").alias("p"), forest_score(spark, forest)(F.col("features")).alias("q"))
    # columns reach it as arrays, without an object for each row
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert f"], {PythonEvalType.SQL_SCALAR_ARROW_UDF}" in plan
    assert both.count() == 2 * SCORE_ROWS + 5 and both.where("p <> q OR q IS NULL").isEmpty()
    assert both.limit(0).count() == 0 and both.where("p < 0").isEmpty()


def test_rows_are_scored_once_for_evaluation_and_predictions(spark):
    s = inputs.encounter_star(spark, SF_SMALL)
    feats = star_features(s["fact_admission"], s["dim_patient"], s["dim_department"], s["dim_diagnosis"])
    model, data, ev = train_readmission(feats, ForestParams(num_trees=3, max_depth=2, folds=2))
    assert ev["predictions"].exceptAll(model.score(data)).isEmpty() and ev["predictions"].count() == data.count()
    for name in ("predictions", "class_report", "confusion", "all_rows"):
        plan = ev[name]._jdf.queryExecution().executedPlan().toString()
        assert "UDF" not in plan and "Python" not in plan, name


def test_as_many_fits_at_once_as_the_executors_can_keep(spark, monkeypatch):
    from wardstar.plans import model as m
    from wardstar.session import storage_memory
    memory = storage_memory(spark)
    assert memory > 0
    p = ForestParams()
    row = 4 * (57 + 4 * p.num_trees) + 128
    assert [m.fits_at_once(f * 1000 * row, 1000, 57, p) for f in (0.5, 1, 2.9, 6, 60)] == [1, 1, 2, 6, 6]
    assert m.fits_at_once(1e9, 0, 57, p) == p.parallelism
    assert m.build_forest().getCheckpointInterval() > p.max_depth + 1
    # a training whose rows fill the memory fits one forest after another
    seen = []
    monkeypatch.setattr(m, "storage_memory", lambda spark: 1)
    monkeypatch.setattr(m, "run_all", lambda spark, tasks, n: seen.append(n) or [t() for t in tasks])
    s = inputs.encounter_star(spark, SF_SMALL)
    feats = star_features(s["fact_admission"], s["dim_patient"], s["dim_department"], s["dim_diagnosis"])
    model, data, ev = m.train_readmission(feats, ForestParams(num_trees=2, max_depth=2, folds=2))
    assert seen == [1] and ev["predictions"].count() == data.count()


def test_forests_are_saved_and_loaded_side_by_side(spark, tmp_dir, monkeypatch):
    from pyspark.ml import PipelineModel
    from wardstar.plans import model as m
    rows = spark.range(400).select(F.pmod(F.xxhash64("id"), F.lit(40)).cast("double").alias("a"), F.col("id").alias("encounter_id"),
                                   F.pmod(F.hash("id"), F.lit(2)).alias("readmitted_30d"), F.lit(1.0).alias("weight"))
    prep = m.VectorAssembler(inputCols=["a"], outputCol="features")
    forests = [m.build_forest(params=ForestParams(num_trees=2, max_depth=2, seed=s)).fit(prep.transform(rows)) for s in (1, 2, 3)]
    cal = m.CalibratedForest(PipelineModel([prep]), forests[1:], [(3.0, -1.0), (2.0, -1.0)])
    was = ReadmissionModel(PipelineModel([prep, forests[0]]), cal, 0.5, ForestParams(num_trees=2), {0: "a"})
    seen, run_all = [], m.run_all
    monkeypatch.setattr(m, "run_all", lambda spark, tasks, *n: seen.append(len(tasks)) or run_all(spark, tasks, *n))
    was.save(spark, f"{tmp_dir}/model")
    again = ReadmissionModel.load(spark, f"{tmp_dir}/model")
    assert seen == [4, 4]  # two pipelines and two forests
    assert again.score(rows).exceptAll(was.score(rows)).isEmpty() and seen == [4, 4, 2, 2]
    assert [f.totalNumNodes for f in again.calibrated.forests] == [f.totalNumNodes for f in forests[1:]]
