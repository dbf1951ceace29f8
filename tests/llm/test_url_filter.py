import re

import pytest
from pyspark.sql import functions as F

from wardstar.llm import url_filter as uf
from wardstar.llm.queries import URL_RULES

SCHEMA = "page_id int, url string"


def by_hand(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = (m.group(1), m.group(2)) if m else ("", "")
    host = re.sub("[A-Z]", lambda x: x.group().lower(), host)
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(r.text), default=None)


URLS = [None, "", "no scheme", "http://", "https://A.Example.ORG/es/x?y#z", "https://example.org/en/12", "https://x.org",
        "https://x.org?q=/", "http://x.org/#f", "https://org/", "https://myexample.org/es/1", "https://w.com/fr/",
        "https://w.com/de/1", "https://w.com/fr", "https://W.COM/FR/", "http://a://b.org/c", "http://é.Éx.org/ü",
        "https://user@w.com:80/de/", "http://x.net/" + "p" * 5000, "x://org/es/", "http://a.net/en/9"]


def test_rules_equal_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), SCHEMA)
    got = {r.page_id: r for r in uf.apply_rules(df, URL_RULES).collect()}
    for i, url in enumerate(URLS):
        host, path, rule = by_hand(url)
        r = got[i]
        assert (r.host, r.path) == (host, path), url
        assert (r.rule, r.rule_verdict) == ((rule.text, rule.verdict) if rule else (None, None)), url


def labelled(spark, n=600):
    words = ["casino", "poker", "bets"], ["news", "science", "library"]
    rows = [(f"https://{words[i % 2][i % 3]}{i % 37}.net/{words[i % 2][i // 3 % 3]}/{i}", int(i % 2 == 0))
            for i in range(n)]
    return spark.createDataFrame(rows, "url string, label int")


def test_held_out_accuracy_and_bound(spark):
    df = labelled(spark).withColumn("h", F.crc32(F.col("url").cast("binary")) % 5)
    model = uf.fit(df.where("h > 0"), max_fit_rows=300)
    held = df.where("h = 0").withColumn("page_id", F.lit(1))
    out = uf.judge_urls(held, [], model).where("(label = 1) = (verdict = 'block')")
    assert out.count() >= 0.95 * held.count()


@pytest.mark.parametrize("labels", [[], [0], [1], [7, None]])
def test_without_two_labels(spark, labels):
    rows = spark.createDataFrame([(f"http://x.net/{i}", y) for i, y in enumerate(labels)], "url string, label int")
    out = uf.judge_urls(spark.createDataFrame([(1, "http://y.net/")], SCHEMA), URL_RULES, uf.fit(rows))
    assert [r.verdict for r in out.collect()] == ["block" if labels == [1] else "allow"]


def test_frames(spark):
    df = spark.createDataFrame([*enumerate(URLS), (0, None), (19, URLS[19])], SCHEMA).withColumns(
        {"HOST": F.lit("clash"), "verdict": F.lit(1), "other": F.lit(2), "rule_verdict": F.lit(3)})
    model = uf.fit(labelled(spark))
    out = uf.judge_urls(df, URL_RULES, model)
    assert sorted(out.columns) == sorted(["page_id", "url", "other", "host", "path", "rule", "verdict",
                                          "block_probability"])
    rows = out.collect()
    assert len(rows) == len(URLS) + 2
    for r in rows:
        rule = by_hand(r.url)[2]
        assert r.verdict == (rule.verdict if rule else "block" if r.block_probability >= 0.5 else "allow")
    assert uf.judge_urls(df.limit(0), URL_RULES, model).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_long_urls_are_read_whole_in_linear_time(spark):
    import time
    model = uf.fit(labelled(spark))
    long = "http://a.net/" + "é/x?" * 100_000
    df = spark.createDataFrame([(1, long), (2, "http://" + "h" * 300_000 + ".org/"), (3, "x" * 300_000)], SCHEMA)
    began = time.time()
    got = {r.page_id: r for r in uf.judge_urls(df, URL_RULES, model).collect()}
    assert time.time() - began < 60
    assert got[1].host == "a.net" and got[1].path == "/é/x" and got[2].rule == "org/" and got[3].host == ""


def test_grams_are_the_characters_of_the_marked_text(spark):
    texts = ["", "a", "ab", "äö🙂z", "abcdefg"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", uf._grams(F.col("t"), "p").alias("g")).collect():
        t = f"^{r.t}$"
        assert r.g == [f"p{t[i:i + n]}" for n in uf.NGRAMS for i in range(max(1, len(t) - n + 1))]
