import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from frames import docs, odd_docs
from wardstar.llm import decontaminate as dc

WORDS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def cut(text):
    return WORDS.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def by_hand(text, items, window):
    w, hit, found = cut(text), set(), set()
    for item_id, item in items:
        v = cut(item)
        n = min(window, len(v))
        for i in range(len(v) - n + 1 if v else 0):
            for p in range(len(w) - n + 1):
                if w[p:p + n] == v[i:i + n]:
                    hit.update(range(p, p + n))
                    found.add(item_id)
    names = sorted(str(x) for x in found if x is not None)
    return (len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit))


def made_up(seed, spark):
    """Few distinct words, so that windows overlap, repeat and nearly match."""
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "c", "é", "Zz9"])
    items = [(i, " ".join(word() for _ in range(rng.randint(0, 9)))) for i in range(12)]
    items += [(20, "only"), (21, "Two-words"), (22, None), (23, "..."), (None, "null id here now"), (20, "only"),
              (9, "b"), (24, "never seen words at all")]
    rows = [(i, " ".join(word() for _ in range(rng.randint(0, 60)))) for i in range(60)]
    rows += [(100, "so ONLY, this; two_WORDS"), (101, "null-id/here.now"), (100, rows[3][1]), (3, rows[3][1])]
    return docs(spark, rows).union(odd_docs(spark)), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("window,shingle,seed", [(5, 3, 1), (4, 1, 2), (2, 3, 3), (10, 2, 4)])
def test_equal_to_brute_force(spark, window, shingle, seed):
    df, items = made_up(seed, spark)
    df = df.withColumns({"N_HIT": F.lit("clash"), "other": F.lit(1)})
    rows = [(r.item_id, r.text) for r in items.collect()]
    out = dc.contamination(df, items, window, shingle)
    assert out.columns == ["doc_id", "text", "other", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    got = out.collect()
    assert len(got) == df.count()
    for r in got:
        if len(r.text or "") < 10_000:
            assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == by_hand(r.text, rows, window), r
    assert any(r.contaminated for r in got) and any(not r.contaminated for r in got)
    kept = sorted(map(str, dc.remove_contaminated(df, items, window, shingle).select("doc_id", "text").collect()))
    assert kept == sorted(map(str, out.where("not contaminated").select("doc_id", "text").collect()))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_tables(spark):
    df, items = made_up(1, spark)
    assert dc.contamination(df.limit(0), items).count() == 0
    out = dc.contamination(df, items.limit(0))
    assert out.where("contaminated or n_hit > 0").count() == 0 and out.count() == df.count()
    assert dc.remove_contaminated(df, items.limit(0)).count() == df.count()


def test_hot_passage_and_long_text(spark):
    passage = " ".join(f"p{i}" for i in range(12))
    rows = [(i, f"x{i} {passage} y") for i in range(200)] + [(500, "w " * 30_000 + passage)]
    items = spark.createDataFrame([(1, passage), (2, "w " * 12)], "item_id long, text string")
    got = {r.doc_id: r for r in dc.contamination(docs(spark, rows), items).collect()}
    assert all(got[i].n_hit == 12 and got[i].n_items == 1 for i in range(200))
    assert got[500].n_hit == 30_012 and got[500].n_items == 2
