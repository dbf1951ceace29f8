from wardstar.operators.history import scd2_merge

COLS = "k int, a string, b string"


def test_scd2_cases(spark):
    v1 = spark.createDataFrame([(1, "x", "p"), (2, "x", "p"), (3, None, "p"), (4, None, "p"),
                                (5, "x", "p")], COLS)
    v2 = spark.createDataFrame([(1, "x", "p"),          # unchanged
                                (2, "y", "p"),          # changed
                                (3, "z", "p"),          # NULL -> value
                                (4, None, "p"),         # NULL = NULL
                                (6, "n", "p")], COLS)   # new key; 5 gone
    h1 = scd2_merge(None, v1, "k", ["a", "b"], "2024-01-01")
    h2 = scd2_merge(h1, v2, "k", ["a", "b"], "2024-02-01")
    rows = sorted((r.k, str(r.a), str(r.valid_from), str(r.valid_to)) for r in h2.collect())
    assert rows == [
        (1, "x", "2024-01-01", "None"),
        (2, "x", "2024-01-01", "2024-02-01"), (2, "y", "2024-02-01", "None"),
        (3, "None", "2024-01-01", "2024-02-01"), (3, "z", "2024-02-01", "None"),
        (4, "None", "2024-01-01", "None"),
        (5, "x", "2024-01-01", "None"),
        (6, "n", "2024-02-01", "None"),
    ]
    h3 = scd2_merge(h2, v2, "k", ["a", "b"], "2024-03-01")  # re-run, no change
    assert h3.exceptAll(h2).count() == 0 and h2.exceptAll(h3).count() == 0
