"""Binary classification metrics as distributed aggregations.

Everything reduces to counts: the confusion matrix is a group-by, the
report is arithmetic on it, and the ROC-AUC and the precision-recall curve
come from per-score positive / negative counts and their running totals
(``prefix_sums``), never from sorting all rows in one task.

A row whose score is NULL or NaN, or whose label is NULL, says nothing about a
threshold: curves and ROC-AUC leave it out, so that without other rows the
curve is empty and there is no best threshold. The confusion matrix shows NULL
as a value of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rownum import prefix_sums

# Fixed value: added to precision + recall when computing F1 along the curve.
F1_EPS = 1e-9


def confusion(df: DataFrame, y: str = "label", yhat: str = "prediction") -> DataFrame:
    """(y, yhat, n) for every observed pair."""
    return df.groupBy(F.col(y).alias("actual"), F.col(yhat).alias("predicted")) \
        .agg(F.count(F.lit(1)).alias("n"))


def class_report(df: DataFrame, y: str = "label", yhat: str = "prediction") -> DataFrame:
    """Per class precision, recall, F1 and support, then accuracy, macro and
    weighted means (rows ``accuracy``, ``macro avg``, ``weighted avg``).

    An undefined ratio (no predictions or no rows of a class) is 0.
    """
    cm = confusion(df, y, yhat)
    # each cell counts once for its actual class (support, tp) and once for
    # its predicted class (pred): one group-by over the cells, no joins
    zero = F.lit(0).cast("long")
    sides = F.explode(F.array(
        F.struct(F.col("actual").alias("c"), F.col("n").alias("support"), zero.alias("pred"),
                 F.when(F.col("actual") == F.col("predicted"), F.col("n"))
                 .otherwise(zero).alias("tp")),
        F.struct(F.col("predicted").alias("c"), zero.alias("support"), F.col("n").alias("pred"),
                 zero.alias("tp"))))
    per = cm.select(sides.alias("_s")).select("_s.*").groupBy("c").agg(
        *[F.sum(k).alias(k) for k in ("support", "pred", "tp")])

    def ratio(a, b):
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    per = per.withColumns({"precision": ratio("tp", "pred"), "recall": ratio("tp", "support")})
    pr = F.col("precision") + F.col("recall")
    per = per.withColumn("f1_score", F.when(pr > 0, F.lit(2.0) * F.col("precision")
                                           * F.col("recall") / pr).otherwise(F.lit(0.0)))
    rows = per.select(F.col("c").cast("string").alias("label"), "precision", "recall",
                      "f1_score", F.col("support").cast("long").alias("support"))
    tot = per.agg(
        F.sum("support").cast("long").alias("n"), F.sum("tp").alias("tp"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1_score").alias("mf"),
        F.sum(F.col("precision") * F.col("support")).alias("wp"),
        F.sum(F.col("recall") * F.col("support")).alias("wr"),
        F.sum(F.col("f1_score") * F.col("support")).alias("wf"))
    null = F.lit(None).cast("double")
    acc = tot.select(F.lit("accuracy").alias("label"), null.alias("precision"),
                     null.alias("recall"), (F.col("tp") / F.col("n")).alias("f1_score"),
                     F.col("n").alias("support"))
    macro = tot.select(F.lit("macro avg").alias("label"), F.col("mp").alias("precision"),
                       F.col("mr").alias("recall"), F.col("mf").alias("f1_score"),
                       F.col("n").alias("support"))
    weighted = tot.select(F.lit("weighted avg").alias("label"),
                          (F.col("wp") / F.col("n")).alias("precision"),
                          (F.col("wr") / F.col("n")).alias("recall"),
                          (F.col("wf") / F.col("n")).alias("f1_score"),
                          F.col("n").alias("support"))
    return rows.unionByName(acc).unionByName(macro).unionByName(weighted)


def score_counts(df: DataFrame, y: str = "label", score: str = "score") -> DataFrame:
    """(score, pos, neg) per distinct score; partial aggregation map-side. Rows
    without a label or a score that is a number are left out."""
    value = F.col(score).cast("double")
    known = df.where(value.isNotNull() & ~F.isnan(value) & F.col(y).isNotNull())
    return known.groupBy(value.alias("score")).agg(
        F.sum(F.col(y).cast("long")).alias("pos"),
        F.sum((F.lit(1) - F.col(y)).cast("long")).alias("neg"))


def _cumulated(df: DataFrame, y: str, score: str) -> DataFrame:
    """Per score: pos, neg, and positives / negatives with a strictly lower score."""
    c = prefix_sums(score_counts(df, y, score), ["score"], ["pos", "neg"], total_suffix="_total")
    return c.withColumns({"pos_below": F.col("pos_cum") - F.col("pos"),
                          "neg_below": F.col("neg_cum") - F.col("neg")})


def roc_auc(df: DataFrame, y: str = "label", score: str = "score") -> DataFrame:
    """Exact ROC-AUC with ties counted half (the Mann-Whitney form).

    2 * sum(pos * neg_below) + sum(pos * neg) is an integer, so the result is
    one division, independent of summation order. Pairs are counted in
    decimals: billions of rows of either class have more pairs than a bigint.
    """
    return auc_of_counts(_cumulated(df, y, score))


def auc_of_counts(c: DataFrame) -> DataFrame:
    """The ROC-AUC of (pos, neg, neg_below) per score."""
    whole = "decimal(18,0)"
    pos, neg, below = (F.col(x).cast(whole) for x in ("pos", "neg", "neg_below"))
    agg = c.agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"),
                F.sum((pos * below * F.lit(2).cast("decimal(1,0)") + pos * neg).cast("decimal(38,0)"))
                .alias("num2"))
    den = F.col("n_pos").cast("double") * F.col("n_neg").cast("double") * 2
    return agg.select(F.when(den > 0, F.col("num2").cast("double") / den).alias("roc_auc"),
                      F.col("n_pos").cast("long").alias("n_pos"),
                      F.col("n_neg").cast("long").alias("n_neg"))


def pr_curve(df: DataFrame, y: str = "label", score: str = "score") -> DataFrame:
    """One point per distinct score t: predictions are ``score >= t``.

    (threshold, tp, fp, precision, recall, f1) with f1 = 2pr / (p + r + 1e-9).
    """
    c = _cumulated(df, y, score)
    # class totals come with the running totals, from the same small table
    n_pos, n_neg = F.col("pos_total"), F.col("neg_total")
    tp = (n_pos - F.col("pos_below")).cast("long")
    fp = (n_neg - F.col("neg_below")).cast("long")
    out = c.select(F.col("score").alias("threshold"), tp.alias("tp"), fp.alias("fp"),
                   n_pos.alias("_P"))
    prec = F.when((F.col("tp") + F.col("fp")) > 0, F.col("tp") / (F.col("tp") + F.col("fp"))) \
        .otherwise(F.lit(0.0))
    rec = F.when(F.col("_P") > 0, F.col("tp") / F.col("_P")).otherwise(F.lit(1.0))
    out = out.withColumns({"precision": prec, "recall": rec})
    f1 = F.lit(2.0) * F.col("precision") * F.col("recall") / (
        F.col("precision") + F.col("recall") + F.lit(F1_EPS))
    return out.withColumn("f1", f1).drop("_P")


def best_threshold(curve: DataFrame) -> DataFrame:
    """The threshold of maximum F1; the lowest threshold wins a tie (first maximum
    along ascending thresholds). A top-1 over the curve, reduced per partition."""
    return curve.orderBy(F.desc("f1"), F.asc("threshold")).limit(1)
