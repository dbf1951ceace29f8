from pyspark.sql import Window
from pyspark.sql import functions as F

from wardstar.operators.rownum import global_row_number, prefix_sums


def test_global_row_number_matches_window(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5003).alias("k"), "id")
    got = global_row_number(df, ["k"], num_partitions=7, total_col="n")
    want = df.withColumn("rn", F.row_number().over(Window.orderBy("k")))
    j = got.join(want, ["k", "id"])
    assert j.count() == 5000
    assert j.filter(F.col("row_num") != F.col("rn")).count() == 0
    assert got.select(F.min("n"), F.max("n")).first() == (5000, 5000)


def test_grouped_row_number_restarts_per_group(spark):
    df = spark.range(0, 3000).select((F.col("id") % 3).alias("g"),
                                     ((F.col("id") * 31) % 3001).alias("k"))
    got = global_row_number(df, ["k"], partition_cols=["g"], num_partitions=5, total_col="n")
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("k")))
    j = got.join(want, ["g", "k"])
    assert j.filter(F.col("row_num") != F.col("rn")).count() == 0
    assert {r.g: r.n for r in got.select("g", "n").distinct().collect()} == {0: 1000, 1: 1000,
                                                                            2: 1000}


def test_prefix_sums(spark):
    df = spark.range(1, 201).select(F.col("id").alias("s"), (F.col("id") % 3).alias("v"))
    got = prefix_sums(df, ["s"], ["v"], num_partitions=6)
    want = df.withColumn("w", F.sum("v").over(Window.orderBy("s")))
    j = got.join(want, ["s", "v"])
    assert j.count() == 200 and j.filter(F.col("v_cum") != F.col("w")).count() == 0
