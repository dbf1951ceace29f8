import os

from pyspark.sql import functions as F

from wardstar.plans.marts import materialize_marts, register_views
from wardstar.plans.retrieval import upsert_chunks
from wardstar.sources import read_documents, read_encounters
from wardstar.sources.sinks import write_star


def test_read_encounters_header_csv(spark, tmp_dir):
    p = os.path.join(tmp_dir, "enc.csv")
    with open(p, "w") as f:
        f.write("encounter_id,patient_nbr,race,weight,time_in_hospital,extra_col\n"
                "1,10,?,?,3,a\n2,11,Caucasian,[50-75),x,b\n")
    df = read_encounters(spark, p)
    assert dict(df.dtypes)["encounter_id"] == "bigint" and dict(df.dtypes)["extra_col"] == "string"
    rows = df.orderBy("encounter_id").collect()
    assert rows[0].race == "?" and rows[0].time_in_hospital == 3
    assert rows[1].time_in_hospital is None  # malformed int -> NULL, row kept


def test_read_documents_and_upsert(spark, tmp_dir):
    d = os.path.join(tmp_dir, "docs")
    os.makedirs(d)
    for name, text in [("a.txt", "one two\nthree"), ("b.txt", "four")]:
        with open(os.path.join(d, name), "w") as f:
            f.write(text)
    docs = read_documents(spark, d)
    assert sorted(r.file_name for r in docs.collect()) == ["a.txt", "b.txt"]
    assert [r.text for r in docs.filter("file_name = 'a.txt'").collect()] == ["one two\nthree"]
    store = os.path.join(tmp_dir, "store")
    first = spark.createDataFrame([(1, 0, "x"), (1, 1, "y")], "doc_id long, chunk_id int, text string")
    assert upsert_chunks(spark, first, store) == 2
    more = spark.createDataFrame([(1, 1, "y"), (2, 0, "z")], "doc_id long, chunk_id int, text string")
    assert upsert_chunks(spark, more, store) == 1
    assert spark.read.parquet(store).count() == 3


def test_views_and_marts(spark, tmp_dir):
    fact = spark.createDataFrame(
        [(1, 1, 1, 1, 3, 1, 5, 2, 2024, 1), (2, 1, 2, 1, 4, 0, 6, 0, 2024, 1),
         (3, 2, 1, 2, 5, 1, 7, 1, 2024, 2)],
        "encounter_id long, patient_key long, department_key long, diagnosis_key long, "
        "los_days int, readmitted_30d int, num_medications int, prior_visits_total int, "
        "admission_year int, admission_month int")
    dep = spark.createDataFrame([("Cardiology", 1), ("Surgery", 2)],
                                "medical_specialty string, department_key long")
    dia = spark.createDataFrame([("Diabetes", "a", "b", "c", 1), ("Other", "a", "b", "c", 2)],
                                "diag_1_group string, admission_type_desc string, "
                                "discharge_disposition_desc string, admission_source_desc string, "
                                "diagnosis_key long")
    date = spark.range(1).select(F.lit(1).alias("date_key"))
    pat = spark.range(1).select(F.lit(1).alias("patient_key"))
    write_star({"fact_admission": fact, "dim_department": dep, "dim_diagnosis": dia,
                "dim_date": date, "dim_patient": pat}, tmp_dir)
    assert os.path.isdir(os.path.join(tmp_dir, "fact_admission", "admission_year=2024"))
    register_views(spark, tmp_dir)
    where = materialize_marts(spark, path=os.path.join(tmp_dir, "marts"))
    m = {r.medical_specialty: r for r in
         spark.read.parquet(where["mart_readmission_by_department"]).collect()}
    assert m["Cardiology"].n_encounters == 2 and m["Cardiology"].readmit_rate_pct == 100.0
    assert m["Surgery"].avg_los_days == 4.0 and m["Cardiology"].avg_medications == 6.0
