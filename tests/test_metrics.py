import itertools

from wardstar.operators import metrics as mx


def _auc_brute(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def test_auc_with_ties(spark):
    rows = [(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.5), (0, 0.1), (1, 0.7), (0, 0.7), (0, 0.3),
            (1, 0.3), (1, 0.95)]
    df = spark.createDataFrame(rows, "label int, score double")
    got = mx.roc_auc(df).first()
    assert abs(got.roc_auc - _auc_brute(rows)) < 1e-15
    assert (got.n_pos, got.n_neg) == (5, 5)


def test_one_class_only(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.4)], "label int, score double")
    assert mx.roc_auc(df).first().roc_auc is None
    curve = mx.pr_curve(df).orderBy("threshold").collect()
    assert [c.recall for c in curve] == [1.0, 0.5]


def test_best_threshold_first_max_on_tie(spark):
    # thresholds 0.2 and 0.8 give the same F1; the lower one wins
    rows = [(1, 0.8), (0, 0.5), (1, 0.2), (0, 0.1)]
    df = spark.createDataFrame(rows, "label int, score double")
    curve = {r.threshold: r.f1 for r in mx.pr_curve(df).collect()}
    best = mx.best_threshold(mx.pr_curve(df)).first()
    top = max(curve.values())
    assert best.threshold == min(t for t, f in curve.items() if f == top)


def test_class_report_matches_hand_count(spark):
    rows = [(1, 1), (1, 0), (0, 0), (0, 0), (0, 1)]
    df = spark.createDataFrame(rows, "label int, prediction int")
    rep = {r.label: r for r in mx.class_report(df).collect()}
    assert rep["1"].precision == 0.5 and rep["1"].recall == 0.5 and rep["1"].support == 2
    assert abs(rep["0"].precision - 2 / 3) < 1e-15 and abs(rep["0"].recall - 2 / 3) < 1e-15
    assert rep["accuracy"].f1_score == 0.6 and rep["accuracy"].support == 5


def test_class_report_class_never_actual(spark):
    # class 1 is predicted but never occurs: support 0, recall 0, precision 0
    rows = [(0, 0), (0, 1), (0, 0)]
    df = spark.createDataFrame(rows, "label int, prediction int")
    rep = {r.label: r for r in mx.class_report(df).collect()}
    assert rep["1"].support == 0 and rep["1"].precision == 0.0 and rep["1"].recall == 0.0
    assert rep["0"].support == 3 and rep["0"].precision == 1.0
    assert abs(rep["0"].recall - 2 / 3) < 1e-15
    assert abs(rep["accuracy"].f1_score - 2 / 3) < 1e-15
    assert rep["macro avg"].support == 3


def test_rows_without_a_label_or_a_score_are_left_out(spark):
    nan = float("nan")
    known = [(1, 0.9), (0, 0.5), (1, 0.5), (0, 0.1)]
    gaps = known + [(1, None), (0, None), (None, 0.7), (None, None), (1, nan), (0, nan)]
    a, b = (spark.createDataFrame(r, "label int, score double") for r in (known, gaps))
    assert mx.roc_auc(a).first() == mx.roc_auc(b).first()
    assert sorted(mx.pr_curve(a).collect()) == sorted(mx.pr_curve(b).collect())
    assert mx.best_threshold(mx.pr_curve(b)).first() == mx.best_threshold(mx.pr_curve(a)).first()
    none = spark.createDataFrame([(1, None), (None, 0.5)], "label int, score double")
    assert mx.pr_curve(none).count() == 0 and mx.best_threshold(mx.pr_curve(none)).first() is None
    assert mx.roc_auc(none).first().roc_auc is None
