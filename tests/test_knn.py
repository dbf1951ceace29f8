import numpy as np

from wardstar.operators.knn import knn


def test_knn_ties_zero_vector_and_large_k(spark):
    corpus = spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [-1.0, 0.0]), (4, [0.0, 0.0]), (5, [0.0, -1.0])],
        "vec_id long, embedding array<float>").repartition(3)
    queries = spark.createDataFrame([("a", [0.0, 0.0]), ("b", [2.0, 0.0])],
                                    "qid string, embedding array<double>")
    got = knn(corpus, queries, k=10, metric="l2").orderBy("qid", "rank").collect()
    a = [(r.vec_id, r.distance) for r in got if r.qid == "a"]
    assert a == [(4, 0.0), (1, 1.0), (2, 1.0), (3, 1.0), (5, 1.0)]  # ties by id, k > corpus
    b = [r.vec_id for r in got if r.qid == "b"]
    assert b[0] == 1
    cos = knn(corpus, queries, k=2, metric="cosine").orderBy("qid", "rank").collect()
    # zero query vector: every similarity is 0, so ids decide
    assert [r.vec_id for r in cos if r.qid == "a"] == [1, 2]


def test_knn_matches_brute_force(spark):
    rng = np.random.default_rng(7)
    pts = rng.normal(size=(300, 8)).astype(np.float32)
    q = rng.normal(size=(4, 8))
    corpus = spark.createDataFrame([(i, pts[i].tolist()) for i in range(300)],
                                   "vec_id long, embedding array<float>").repartition(5)
    queries = spark.createDataFrame([(j, q[j].tolist()) for j in range(4)],
                                    "qid int, embedding array<double>")
    got = knn(corpus, queries, k=5, query_rows=3, corpus_rows=70).orderBy("qid", "rank").collect()
    for j in range(4):
        d = ((pts.astype(np.float64) - q[j]) ** 2).sum(axis=1)
        want = list(np.lexsort((np.arange(300), d))[:5])
        assert [r.vec_id for r in got if r.qid == j] == want


def test_null_vectors_and_null_payload(spark):
    big = 2 ** 53 + 1
    corpus = spark.createDataFrame([(1, [1.0, 0.0], big), (2, None, 5), (3, [0.0, 1.0], None)],
                                   "vec_id long, embedding array<float>, n long")
    queries = spark.createDataFrame([("a", [1.0, 0.0]), ("b", None)], "qid string, embedding array<double>")
    got = knn(corpus, queries, k=5, payload_cols=["n"]).orderBy("rank").collect()
    assert [(r.qid, r.vec_id, r.n) for r in got] == [("a", 1, big), ("a", 3, None)]


def test_empty_sides(spark):
    corpus = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<float>")
    queries = spark.createDataFrame([("a", [1.0])], "qid string, embedding array<double>")
    assert knn(corpus, queries.limit(0)).count() == 0
    assert knn(corpus.limit(0), queries).count() == 0


def test_centroids_match_mean(spark):
    from wardstar.operators.knn import centroids
    rows = [("a", [1.0, 3.0]), ("a", [3.0, 5.0]), ("a", None), ("b", [0.5, 0.25])]
    df = spark.createDataFrame(rows, "g string, embedding array<float>")
    assert {r.g: r.embedding for r in centroids(df, "g").collect()} == {"a": [2.0, 4.0], "b": [0.5, 0.25]}


def test_registered_row_queries_grow_with_the_table(spark):
    import __spark_entry__ as se
    from conftest import SF_SMALL
    ids = {r.vec_id for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id").collect()}
    want = {i for i in ids if i % 20 == 0}
    for metric in ("l2", "cosine"):
        got = se.queries()[f"knn_rows_{metric}"](spark, SF_SMALL).collect()
        assert want and {r.qid for r in got} == want and len(got) == 3 * len(want)
        assert all(r.vec_id == r.qid for r in got if r["rank"] == 1 and metric == "l2")
