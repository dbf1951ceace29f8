import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardstar.llm import hard_negatives as hn

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("label", T.IntegerType())])


def brute(rows, every, k_pos=5, k_neg=10):
    data = []
    for at, (vid, v, label) in enumerate(rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        data.append((at, vid, label, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    key = lambda x: (-x[0], x[1] is None, x[1] or 0)
    for at, vid, label, v in data:
        if vid is None or vid % every:
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), i, other) for p, i, other, w in data if p != at and len(w) == len(v)]
        for p, pid, _ in sorted([x for x in scored if x[2] == label], key=key)[:k_pos]:
            fit = sorted([x for x in scored if x[2] != label and 30 * p <= 100 * x[0] <= 90 * p], key=key)[:k_neg]
            out += [(vid, pid, i + 1, nid, p, n) for i, (n, nid, _) in enumerate(fit)]
    return out


def check(spark, rows, every=10, **options):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"place": F.lit("x"), "dim": F.lit(0)}).repartition(4)
    got = hn.mine_hard_negatives(df, F.col("vec_id") % every == 0, **options).collect()
    order = lambda r: tuple((x is None, x or 0) for x in r)
    want = brute(rows, every)
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)
    return want


def vectors(rng, n, dim, spread):
    """Half of them near a few directions."""
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(4)]
    return [[(x + rng.gauss(0, spread)) / 3 for x in rng.choice(centres)] if rng.random() < 0.5 else
            [rng.gauss(0, 1) / 3 for _ in range(dim)] for _ in range(n)]


@pytest.mark.parametrize("spread", [0.02, 0.7])
def test_equals_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(hn, "LEAST_BLOCK", 100)
    monkeypatch.setattr(hn, "GREATEST_BLOCK", 100)
    monkeypatch.setattr(hn, "ANCHOR_BLOCK", 7)
    rng = random.Random(5)
    rows = [(i, v, rng.randint(0, 3)) for i, v in enumerate(vectors(rng, 600, 8, spread))]
    assert len(check(spark, rows)) > 500


def test_ties_repeated_rows_and_null_ids(spark):
    rng = random.Random(6)
    rows = [(i, [float(rng.randint(-1, 1)) for _ in range(3)], rng.randint(0, 2)) for i in range(120)]
    rows += rows[:30] + [(None, [1.0, 1.0, 0.0], 1), (None, [1.0, 0.0, 1.0], 2), (40, [1.0, 1.0, 1.0], 0)]
    assert check(spark, rows)


def test_rows_that_take_no_part(spark):
    ok = [(i, [0.5 + i / 100, 0.25], i % 2) for i in range(25)]
    nan, inf = float("nan"), float("inf")
    bad = [(30, None, 1), (31, [1.0, None], 1), (32, [nan, 1.0], 0), (33, [1.0, -inf], 0), (34, [1.0, 1.0], None)]
    assert check(spark, ok + bad + [(50, [1.0, 2.0, 3.0], 1), (51, [1.0, 1.0, 1.0], 0), (60, [], 1), (61, [], 1), (62, [], 0)])


def test_negative_scores_and_large_components(spark):
    check(spark, [(i, [-1.0 if i % 10 else 1.0, 0.5], i % 3) for i in range(40)])
    assert check(spark, [(i, [5e5 * (1 + i % 2) + 3.0 * (i % 7), 1e5 - i], i % 3) for i in range(40)])  # beyond a float's whole numbers


def test_too_few_rows_and_empty_table(spark):
    assert check(spark, [(0, [1.0], 1), (1, [1.0], 1)]) == []
    assert check(spark, [(0, [1.0], 1), (1, [0.5], 2)]) == []
    assert check(spark, []) == []


def test_spanning_tree_is_least():
    rng = np.random.default_rng(1)
    x = rng.integers(-50, 50, (30, 4))
    order, parents, edges = hn.spanning_tree(x)
    assert sorted(order) == list(range(30)) and parents[0] == -1 and (parents[1:] < np.arange(1, 30)).all()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    inside, total = {0}, 0.0
    while len(inside) < 30:
        cost, new = min((d[i, j], j) for i in inside for j in range(30) if j not in inside)
        inside.add(new)
        total += cost
    assert edges.sum() == pytest.approx(total)


def test_bounds_skip_candidates_of_close_anchors():
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 60, (10, 16))
    group = rng.integers(0, 10, 2000)
    x = np.floor(centres[group] + rng.normal(0, 2, (2000, 16))).astype(np.int64)
    anchors = np.arange(0, 2000, 20)
    order, parents, edges = hn.spanning_tree(x[anchors])
    picked = anchors[order]
    tree = {"vectors": x[picked], "places": picked, "ids": picked, "labels": group[picked],
            "parents": parents, "edges": edges}
    rows = {"vectors": x, "places": np.arange(2000), "ids": np.arange(2000), "labels": group}
    wanted, stats = [[hn.Best(5)] for _ in picked], {}
    hn.scan_pair(tree, rows, wanted, True, stats)
    for i, a in enumerate(picked):
        score = x @ x[a]
        others = [j for j in np.lexsort((np.arange(2000), -score)) if j != a and group[j] == group[a]]
        assert [v for _, v, _ in wanted[i][0].rows()] == others[:5]
    assert stats["scored"] < 0.35 * stats["pairs"]
