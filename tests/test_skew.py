"""One patient holding a third of all encounters: results stay whole and right."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from wardstar.operators.keys import first_by
from wardstar.plans import inputs
from wardstar.plans.marts import mart_by_department
from wardstar.plans.star import clean_encounters, star_tables
from wardstar.sources.fixtures import encounters_from_tables


def test_hot_patient(spark):
    raw = encounters_from_tables(spark, SF_SMALL)
    hot = raw.withColumn("patient_nbr", F.when(F.col("encounter_id") % 3 == 0, F.lit(-1))
                         .otherwise(F.col("patient_nbr")))
    clean = clean_encounters(hot, inputs.lookup_blocks(spark, SF_SMALL), num_partitions=6)
    star = star_tables(clean, num_partitions=6)
    fact, pat = star["fact_admission"], star["dim_patient"]
    n = clean.count()
    assert fact.count() == n                          # no fan-out, no loss
    assert pat.filter("patient_nbr = -1").count() == 1
    first = clean.filter("patient_nbr = -1").orderBy("encounter_id").first()
    row = pat.filter("patient_nbr = -1").first()
    assert (row.race, row.gender, row.age) == (first.race, first.gender, first.age)
    hot_key = row.patient_key
    assert fact.filter(F.col("patient_key") == hot_key).count() == \
        clean.filter("patient_nbr = -1").count()
    m = mart_by_department(fact, star["dim_department"])
    assert m.agg(F.sum("n_encounters")).first()[0] == n


def test_first_by_is_the_earliest_row(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 2, "a"), (1, 9, "c"), (2, 1, "z")],
                               "k int, o int, v string")
    got = {r.k: r.v for r in first_by(df, "k", "o", ["v"]).collect()}
    assert got == {1: "a", 2: "z"}
