import os

from wardstar.sources.lookups import lookup, parse_stacked_lookups, read_stacked_lines

FILE_A = """row before any header,x
admission_type_id,description
1,Emergency
2,"Urgent, walk-in"
6,NULL
x9,not a code

,
admission_source_id,Description
1, Physician Referral
 7 , Emergency Room
,
"""
FILE_B = """discharge_disposition_id,description
19,"Expired at home. Medicaid only, hospice."
30,Other facility
"""


def test_stacked_parse(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "a.csv"), "w") as f:
        f.write(FILE_A)
    with open(os.path.join(tmp_dir, "b.csv"), "w") as f:
        f.write(FILE_B)
    blocks = parse_stacked_lookups(read_stacked_lines(spark, tmp_dir))
    rows = sorted(tuple(r)[:3] for r in blocks.collect())
    assert ("admission_type_id", "2", "Urgent, walk-in") in rows
    assert ("admission_type_id", "6", "NULL") in rows  # text, not a null
    assert ("admission_source_id", "1", "Physician Referral") in rows
    assert ("admission_source_id", "7", "Emergency Room") in rows
    assert ("discharge_disposition_id", "19", "Expired at home. Medicaid only, hospice.") in rows
    assert not any(r[0] is None for r in rows)
    assert not any(r[1] == "row before any header" for r in rows)
    t = {r[0]: r[1] for r in lookup(blocks, "admission_type_id").collect()}
    assert t == {1: "Emergency", 2: "Urgent, walk-in", 6: "NULL"}  # x9 dropped
    assert lookup(blocks, "admission_type_id").columns == ["admission_type_id",
                                                           "admission_type_desc"]


def _parse(spark, folder, files):
    for name, text in files.items():
        path = os.path.join(folder, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write(text)
    paths = sorted({os.path.join(folder, os.path.dirname(n)) for n in files})
    lines = read_stacked_lines(spark, paths[0])
    for p in paths[1:]:
        lines = lines.unionByName(read_stacked_lines(spark, p))
    return parse_stacked_lookups(lines)


def test_quotes_and_white_space(spark, tmp_dir):
    text = 't_id,description\n1,"He said ""go"" now, ok"\n2\t,\t x \t\n3,"q\\"\n \t , \t\n'
    rows = {r.id: r.description for r in _parse(spark, tmp_dir, {"a/m.csv": text}).collect()}
    assert rows == {"1": 'He said "go" now, ok', "2": "x", "3": "q\\"}


def test_equal_file_names_of_two_folders(spark, tmp_dir):
    blocks = _parse(spark, tmp_dir, {"a/m.csv": "t1,description\n1,one\n", "b/m.csv": "t2,description\n2,two\n"})
    assert {(r.block, r.id) for r in blocks.collect()} == {("t1", "1"), ("t2", "2")}


def test_repeated_ids_do_not_multiply_rows(spark, tmp_dir):
    from wardstar.plans.star import decode
    blocks = _parse(spark, tmp_dir, {"a/m.csv": "k,description\n7,first\n7,second\n7,first\n"})
    df = spark.createDataFrame([(7,), (7,), (8,), (None,)], "k int")
    got = sorted((r.k or 0, r.d) for r in decode(df, blocks, [("k", "d")]).collect())
    assert got == [(0, "Unknown"), (7, "first"), (7, "first"), (8, "Unknown")]
