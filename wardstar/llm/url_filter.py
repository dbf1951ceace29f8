"""URL filter: rules first, then logistic regression on hashed character
n-grams of host and path. DataFrame operations and ``pyspark.ml`` only.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; path: then up to ``?``, ``#`` or the end. A rule is a host and a
path, such as ``com/fr/``. It fits its host and all subdomains, if the url's
path starts with the rule's; the longest fitting rule decides. Urls without a
rule get the classifier's verdict.

The classifier is trained from a small labelled table (url, label), label 1
meaning block. Its size is bounded by ``max_fit_rows``, taken in the order of a
hash, so the fit does not grow with the urls; every url is scored.

Defined cases: a null url, or one without ``://``, has an empty host and path,
no rule, and is judged by the classifier like any other; without a usable
labelled row, or with one label only, the verdict is that label's, else allow;
equal urls get equal verdicts; a url of any length is read whole; of equally
long rules that fit the first given counts; a probability equal to
the threshold blocks; an empty table gives no rows. Columns that clash with a
made one are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, others, quoted

MADE = ["host", "path", "rule", "verdict", "block_probability"]
NGRAMS = (3, 4)
NUM_FEATURES = 1 << 16


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null url and one without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


@dataclass(frozen=True)
class Rule:
    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0].lower()

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def apply_rules(df: DataFrame, rules: list[Rule], url_col: str = "url") -> DataFrame:
    """Append host, path, rule and rule_verdict (null where no rule fits).
    ``rules`` is a short list; of equally long rules the first wins."""
    host, path = host_and_path(F.col(quoted(url_col)).cast("string"))
    out = df.select(*[F.col(quoted(c)) for c in others(df, [*MADE, "rule_verdict"])],
                    host.alias("host"), path.alias("path"))
    ordered = sorted(rules, key=lambda r: -len(r.text))

    def first(value):
        cases = [F.when(r.fits(F.col("host"), F.col("path")), F.lit(value(r))) for r in ordered]
        return F.coalesce(*cases, F.lit(None).cast("string"))
    return out.withColumn("rule", first(lambda r: r.text)) \
        .withColumn("rule_verdict", first(lambda r: r.verdict))


def _grams(text: Column, mark: str) -> Column:
    """Character n-grams of ``^text$``, marked with the part they are from. The
    text is cut into characters once, so that a long one takes linear time."""
    t = F.concat(F.lit("^"), text, F.lit("$"))

    def all_of(chars: Column) -> Column:
        def of(n: int) -> Column:
            at = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(chars) - (n - 1)))
            return F.transform(at, lambda i: F.concat(F.lit(mark), F.array_join(F.slice(chars, i, F.lit(n)), "")))
        return F.concat(*[of(n) for n in NGRAMS])
    return F.get(F.transform(F.array(F.split(t, "")), all_of), 0)


def _features(df: DataFrame) -> DataFrame:
    grams = df.withColumn("_grams", F.concat(_grams(F.col("host"), "h:"), _grams(F.col("path"), "p:")))
    return HashingTF(numFeatures=NUM_FEATURES, binary=True, inputCol="_grams",
                     outputCol="_features").transform(grams)


class UrlClassifier:
    def __init__(self, model, only: float | None = None):
        self.model, self.only = model, only

    def block_probability(self, df: DataFrame) -> DataFrame:
        """Append ``block_probability`` to a frame with host and path."""
        if self.model is None:
            return df.withColumn("block_probability", F.lit(self.only))
        scored = self.model.transform(_features(df))
        return scored.withColumn("block_probability", vector_to_array("_probability")[1]) \
            .drop("_grams", "_features", "_raw", "_probability", "_prediction")


def fit(labelled: DataFrame, url_col: str = "url", label_col: str = "label",
        max_fit_rows: int = 4_096, reg: float = 0.001) -> UrlClassifier:
    """Train on at most ``max_fit_rows`` distinct labelled urls (label 0 or 1)."""
    from wardstar.session import materialize
    url = F.col(quoted(url_col)).cast("string")
    rows = labelled.where(F.col(quoted(label_col)).isin(0, 1) & url.isNotNull()) \
        .groupBy(url.alias("u")).agg(F.max(quoted(label_col)).cast("double").alias("label")) \
        .orderBy(F.xxhash64("u"), "u").limit(max_fit_rows)
    host, path = host_and_path(F.col("u"))
    rows = materialize(rows.select(host.alias("host"), path.alias("path"), "label"), "url-fit")
    seen = sorted(r.label for r in rows.select("label").distinct().collect())
    if len(seen) < 2:
        return UrlClassifier(None, only=seen[0] if seen else 0.0)
    lr = LogisticRegression(featuresCol="_features", labelCol="label", regParam=reg, maxIter=30,
                            rawPredictionCol="_raw", probabilityCol="_probability",
                            predictionCol="_prediction")
    return UrlClassifier(lr.fit(_features(rows).select("_features", "label").coalesce(4)))


def judge_urls(df: DataFrame, rules: list[Rule], classifier: UrlClassifier, url_col: str = "url",
               threshold: float = 0.5) -> DataFrame:
    """Input columns with host, path, rule, verdict and block_probability."""
    ruled = apply_rules(df, rules, url_col)
    p = F.col("block_probability")
    return classifier.block_probability(ruled).withColumn(
        "verdict", F.coalesce("rule_verdict", F.when(p >= threshold, "block").otherwise("allow"))) \
        .drop("rule_verdict")
