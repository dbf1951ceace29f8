import random

import pytest
from pyspark.sql import functions as F

from wardstar.operators import knn_index as ki
from wardstar.operators.knn import knn

SCHEMA = "vec_id long, embedding array<double>"


def clustered(rng, n, dims, groups=12, spread=0.03):
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(groups)]
    return [[x + rng.gauss(0, spread) for x in rng.choice(centres)] for _ in range(n)]


def corpus(spark, kind):
    rng = random.Random(kind)
    if kind == "random":
        vs = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(700)]
    elif kind == "clustered":
        vs = clustered(rng, 900, 8)
    else:  # ties, zeros and one vector that half of the rows share
        vs = [[float(rng.randint(-1, 1)) for _ in range(3)] for _ in range(300)] + [[1.0, 2.0, 0.0]] * 300
    return spark.createDataFrame(list(enumerate(vs)), SCHEMA)


def rows(df):
    return sorted((r.qid, r.rank, r.vec_id, r.distance) for r in df.collect())


@pytest.mark.parametrize("metric", ["l2", "cosine"])
@pytest.mark.parametrize("kind", ["random", "clustered", "ties"])
def test_equals_the_full_search(spark, metric, kind):
    df = corpus(spark, kind)
    index = ki.build_index(df, metric, block_rows=50, pivots=16)
    asked = df.where("vec_id % 7 = 0").select(F.col("vec_id").alias("qid"), "embedding")
    got = rows(ki.search(index, asked, k=4, query_rows=10))
    want = rows(knn(df, asked, k=4, metric=metric))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert all(abs(g[3] - w[3]) < 1e-12 for g, w in zip(got, want))
    if kind != "random":
        assert [g[2] for g in got if g[3] > 1e-9] == [w[2] for w in want if w[3] > 1e-9]
    if metric == "l2":
        assert got == want


def test_text_ids_few_rows_and_empty_sides(spark):
    df = spark.createDataFrame([("b", [0.0, 1.0]), ("a", [0.0, 1.0]), ("c", [2.0, 2.0])], "vec_id string, embedding array<double>")
    asked = spark.createDataFrame([(1, [0.0, 1.0]), (None, [2.0, 2.0])], "qid long, embedding array<double>")
    index = ki.build_index(df)
    got = {(r.qid, r.rank): r.vec_id for r in ki.search(index, asked, k=5).collect()}
    assert got == {(1, 1): "a", (1, 2): "b", (1, 3): "c", (None, 1): "c", (None, 2): "a", (None, 3): "b"}
    assert ki.search(index, asked.limit(0), k=2).count() == 0
    assert ki.search(ki.build_index(df.limit(0)), asked, k=2).count() == 0


def test_vectors_that_are_left_out(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [1.0, None]), (4, [nan, 0.0]), (5, [0.0, 2.0])], SCHEMA)
    asked = df.select(F.col("vec_id").alias("qid"), "embedding")
    for found in (ki.search(ki.build_index(df), asked, k=9), knn(df, asked, k=9)):
        assert {(r.qid, r.vec_id) for r in found.collect()} == {(1, 1), (1, 5), (5, 1), (5, 5)}
    with pytest.raises(Exception, match="lengths|entries"):
        ki.build_index(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], SCHEMA))


def test_bounds_skip_most_blocks_of_clustered_vectors(spark):
    df = corpus(spark, "clustered")
    index = ki.build_index(df, "l2", block_rows=30, pivots=64)
    asked = df.where("vec_id % 20 = 0").select(F.col("vec_id").alias("qid"), "embedding")
    q = asked.select("qid", F.col("embedding").alias("v")).withColumn("n", F.col("qid"))
    batches = ki._batches(index, q, 3, 4)
    home = batches.withColumn("cell", F.explode("home"))
    first = ki._top(ki._search(index, ki.pairs_of(index, home), 3), 3)
    bounded = ki._with_bounds(batches, first, 3)
    seen = ki.pairs_of(index, ki._cells_within(index, bounded)).count() + ki.pairs_of(index, home).count()
    assert seen < 0.5 * batches.count() * index.blocks.count()


def test_stored_blocks_are_never_repeated_before_the_join(spark):
    index = ki.build_index(corpus(spark, "clustered"), block_rows=100)
    asked = spark.createDataFrame([(0, [[0]])], "batch long, x array<array<int>>").withColumn("cell", F.lit(0))
    plan = ki.pairs_of(index, asked)._jdf.queryExecution().optimizedPlan()
    join = next(p for p in iter_plan(plan) if p.nodeName() == "Join")
    sides = [join.left(), join.right()]
    stored = next(s for s in sides if "vectors" in s.output().mkString(","))
    assert not any(p.nodeName() == "Generate" for p in iter_plan(stored))


def iter_plan(node):
    yield node
    children = node.children()
    for i in range(children.size()):
        yield from iter_plan(children.apply(i))


def test_batches_meet_blocks_without_a_broadcast(spark):
    from pyspark.sql import functions as F
    from wardstar.operators import knn_index as ki
    vec = F.transform(F.sequence(F.lit(1), F.lit(8)), lambda j: F.pmod(F.xxhash64("id", j), F.lit(1000)) / 1000.0)
    rows = spark.range(400).select(F.col("id").alias("vec_id"), vec.alias("embedding"))
    index = ki.build_index(rows, "l2", pivots=4, block_rows=50)
    q = rows.where("vec_id % 20 = 0").select(F.col("vec_id").alias("n"), F.col("embedding").alias("v"))
    batches = ki._batches(index, q, 3, 5)
    plan = ki.pairs_of(index, batches.withColumn("cell", F.explode("home")))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert ki.search(index, rows.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "qid"), 3).count() == 60
