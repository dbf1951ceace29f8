import pytest

from wardstar.sources.sinks import publish_all, publish_jdbc, to_json_messages

DERBY = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def _derby_available(spark):
    try:
        spark.sparkContext._jvm.java.lang.Class.forName(DERBY)
        return True
    except Exception:  # noqa: BLE001
        return False


def test_jdbc_truncate_keeps_dependent_view(spark):
    if not _derby_available(spark):
        pytest.skip("no embedded Derby driver")
    url = "jdbc:derby:memory:wardstar_t;create=true"
    props = {"driver": DERBY}
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    publish_jdbc(df, url, "DIM_T", props)
    jvm = spark.sparkContext._jvm
    conn = jvm.java.sql.DriverManager.getConnection(url)
    conn.createStatement().execute("CREATE VIEW V_T AS SELECT \"k\" FROM DIM_T")
    publish_jdbc(df.limit(1), url, "DIM_T", props)  # truncate + insert, view survives
    back = spark.read.jdbc(url, "V_T", properties=props)
    assert back.count() == 1
    conn.close()


def test_publish_all_counts_and_json(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    counts = publish_all({"t": df}, lambda name, d: d.write.mode("overwrite")
                         .parquet(f"{tmp_dir}/{name}"))
    assert counts == {"t": 2}
    msgs = [r.value for r in to_json_messages(df).orderBy("value").collect()]
    assert msgs == ['{"k":1,"v":"a"}', '{"k":2}']


def test_jdbc_partitioned_read(spark):
    if not _derby_available(spark):
        pytest.skip("no embedded Derby driver")
    from wardstar.sources.database import read_jdbc_table
    url = "jdbc:derby:memory:wardstar_r;create=true"
    props = {"driver": DERBY}
    df = spark.range(1, 101).selectExpr("CAST(id AS INT) AS k", "CAST(id * 2 AS INT) AS v")
    publish_jdbc(df, url, "FACT_R", props)
    back = read_jdbc_table(spark, url, "FACT_R", props, partition_column='"k"', num_partitions=4)
    assert back.rdd.getNumPartitions() == 4
    assert back.count() == 100
    assert back.agg({"v": "sum"}).first()[0] == 2 * 5050
    whole = read_jdbc_table(spark, url, "FACT_R", props)
    assert whole.count() == 100


def test_publish_json_to_text_and_write_table(spark, tmp_dir):
    from wardstar.sources.sinks import publish_json, write_table
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    publish_json(df, {"path": f"{tmp_dir}/topic"}, fmt="text")
    publish_json(df.limit(1), {"path": f"{tmp_dir}/topic"}, fmt="text")
    assert sorted(r.value for r in spark.read.text(f"{tmp_dir}/topic").collect()) == \
        ['{"k":1,"v":"a"}', '{"k":1,"v":"a"}', '{"k":2}']
    write_table(df, f"{tmp_dir}/table")
    write_table(df.where("k = 2"), f"{tmp_dir}/table")
    assert [r.k for r in spark.read.parquet(f"{tmp_dir}/table").collect()] == [2]


def test_replaced_tables_are_read_through_their_pointer(spark, tmp_dir):
    from pyspark.sql import functions as F

    from wardstar.sources.sinks import read_table, replace_star, replace_table
    from wardstar.sources.versions import VersionedTable
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    assert read_table(spark, f"{tmp_dir}/t") is None
    assert [replace_table(df, f"{tmp_dir}/t"), replace_table(df.where("k = 2"), f"{tmp_dir}/t")] == [1, 2]
    bad = df.withColumn("v", F.when(F.col("k") == 2, F.raise_error(F.lit("lost")).cast("string")))
    with pytest.raises(Exception, match="lost"):
        replace_table(bad, f"{tmp_dir}/t")
    assert [tuple(r) for r in read_table(spark, f"{tmp_dir}/t").collect()] == [(2, None)]

    def fact(rows):
        return spark.createDataFrame(rows, "encounter_id long, admission_year int, admission_month int")
    replace_star({"fact_admission": fact([(1, 2003, 1), (2, 2003, 2)]), "dim_x": df}, f"{tmp_dir}/star")
    replace_star({"fact_admission": fact([(2, 2003, 2), (3, 2004, 12)]), "dim_x": df.limit(1)}, f"{tmp_dir}/star")
    assert sorted(r.encounter_id for r in read_table(spark, f"{tmp_dir}/star/fact_admission").collect()) == [2, 3]
    assert set(VersionedTable(spark, f"{tmp_dir}/star/fact_admission").commit().parts) == {"2003-02", "2004-12"}
    assert read_table(spark, f"{tmp_dir}/star/dim_x").count() == 1
