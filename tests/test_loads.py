import os

import pytest
from pyspark.sql import functions as F

from wardstar.operators.history import scd2_merge
from wardstar.operators.registry import KeyRegistry
from wardstar.plans import loads
from wardstar.sources.versions import VersionedTable


def part():
    return F.concat(F.lit("p"), F.col("p").cast("string"))


def files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet")}


def rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((x is not None, x) for x in r))


# ------------------------------------------------------------ versions
def test_a_failed_write_leaves_the_old_version(spark, tmp_dir):
    t = VersionedTable(spark, f"{tmp_dir}/t")
    assert t.commit() is None and t.read() is None
    t.replace(spark.createDataFrame([(1, "a"), (2, "b")], "p int, x string"))
    bad = spark.range(100).select(F.col("id").cast("int").alias("p"), F.when(
        F.col("id") < 99, F.lit("z")).otherwise(F.raise_error(F.lit("lost")).cast("string")).alias("x"))
    with pytest.raises(Exception, match="lost"):
        t.replace(bad)
    assert rows(t.read()) == [(1, "a"), (2, "b")] and t.numbers() == [1]
    t.replace(spark.createDataFrame([(3, "c")], "p int, x string"))
    assert rows(t.read()) == [(3, "c")] and rows(t.read(number=1)) == [(1, "a"), (2, "b")]
    assert t.vacuum(keep=1) == 2  # version 1 and what the failed write left
    assert rows(t.read()) == [(3, "c")] and t.numbers() == [2]


def test_parts_that_are_not_written_keep_their_files(spark, tmp_dir):
    t = VersionedTable(spark, f"{tmp_dir}/t")
    t.put_parts(spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "p int, x string"), part())
    first = t.commit()
    t.put_parts(spark.createDataFrame([(2, "B"), (3, "c")], "p int, x string"), part())
    assert t.changed_parts(first.number) == {"p2", "p3"}
    assert t.commit().parts["p1"] == first.parts["p1"]
    assert rows(t.read()) == [(None, "n"), (1, "a"), (2, "B"), (3, "c")]
    assert rows(t.read(parts=["p3", "p9"])) == [(3, "c")]
    t.put_parts(spark.createDataFrame([], "p int, x string"), part(), drop=["p1"])
    assert rows(t.read()) == [(None, "n"), (2, "B"), (3, "c")]
    with pytest.raises(ValueError):
        t.put_parts(spark.createDataFrame([(9, 1)], "p int, x int"), part())


def test_of_two_writers_the_second_is_refused(spark, tmp_dir):
    t = VersionedTable(spark, f"{tmp_dir}/t")
    t.replace(spark.createDataFrame([(1, "a")], "p int, x string"))
    base = t.commit()
    t.append(spark.createDataFrame([(2, "b")], "p int, x string"))
    with pytest.raises(FileExistsError):
        t.put_parts(spark.createDataFrame([(3, "c")], "p int, x string"), part(), base=base)
    assert rows(t.read()) == [(1, "a"), (2, "b")]


# ------------------------------------------------------------ keys
def test_known_members_keep_their_keys(spark, tmp_dir):
    r = KeyRegistry(spark, f"{tmp_dir}/keys", "name", "key")
    one = spark.createDataFrame([("m",), ("b",), ("m",), (None,)], "name string")
    assert r.extend(one) == 3
    before = rows(r.read())
    assert before == [(None, 1, 1), ("b", 2, 1), ("m", 3, 1)]
    assert r.extend(spark.createDataFrame([("a",), ("c",), ("b",), (None,), ("c",)], "name string")) == 2
    assert rows(r.read()) == sorted([*before, ("a", 4, 2), ("c", 5, 2)], key=lambda x: (x[0] is not None, x))
    commits = r.table.numbers()
    assert r.extend(one) == 0 and r.table.numbers() == commits
    out = rows(r.attach(spark.createDataFrame([("c", 1), (None, 2), ("zz", 3)], "name string, v int")))
    assert out == [(None, 2, 1), ("c", 1, 5), ("zz", 3, None)]


def test_an_empty_first_load(spark, tmp_dir):
    r = KeyRegistry(spark, f"{tmp_dir}/keys", ["a", "b"], "key")
    assert r.extend(spark.createDataFrame([], "a int, b string")) == 0
    assert r.read().count() == 0
    assert r.extend(spark.createDataFrame([(1, "x")], "a int, b string")) == 1
    assert rows(r.read()) == [(1, "x", 1, 2)]


# ------------------------------------------------------------ facts, states
def batch(spark, data):
    return spark.createDataFrame(data, "id long, p int, k string, v long")


def test_loads_in_parts_equal_one_load(spark, tmp_dir):
    t = VersionedTable(spark, f"{tmp_dir}/f")
    loads.upsert_parts(t, batch(spark, [(1, 1, "a", 5), (2, 1, "b", 6), (3, 2, "a", 7), (4, 3, "a", 1)]), "id", part())
    before = files(tmp_dir)
    # a new row in a new part, one of part 2 again, one that moves from part 1 to 4
    done = loads.upsert_parts(t, batch(spark, [(5, 5, "c", 1), (3, 2, "a", 70), (2, 4, "b", 6), (5, 5, "d", 0)]), "id", part())
    assert rows(t.read()) == [(1, 1, "a", 5), (2, 4, "b", 6), (3, 2, "a", 70), (4, 3, "a", 1), (5, 5, "c", 1)]
    assert t.changed_parts(1) == {"p1", "p2", "p4", "p5"} and done.facts["watermark"] == 5
    assert done.parts["p3"] == t.commit(1).parts["p3"]
    assert {f: files(tmp_dir)[f] for f in before} == before
    loads.upsert_parts(t, batch(spark, [(9, 3, "z", 2)]), "id", part())
    assert t.changed_parts(2) == {"p3"}
    assert loads.upsert_parts(t, batch(spark, []), "id", part()).number == 3


def test_states_read_changed_parts_only(spark, tmp_dir):
    source, state = VersionedTable(spark, f"{tmp_dir}/f"), VersionedTable(spark, f"{tmp_dir}/s")
    sums = {"n": F.count(F.lit(1)), "v": F.sum("v")}
    whole = lambda: rows(source.read().groupBy("k").agg(*[c.alias(n) for n, c in sums.items()]))
    merged = lambda: rows(state.read().groupBy("k").agg(F.sum("n"), F.sum("v")))
    source.put_parts(batch(spark, [(i, i % 4, "ab"[i % 2], i) for i in range(50)]), part())
    assert loads.refresh_states(state, source, part(), ["k"], sums) == {"p0", "p1", "p2", "p3"}
    assert merged() == whole()
    source.put_parts(batch(spark, [(60, 2, "a", 8), (61, 7, "c", 9)]), part(), drop=["p1"])
    assert loads.refresh_states(state, source, part(), ["k"], sums) == {"p1", "p2", "p7"}
    assert merged() == whole()
    assert loads.refresh_states(state, source, part(), ["k"], sums) == set()


def test_a_key_in_two_loads_is_found_without_the_old_one(spark, tmp_dir):
    source, state = VersionedTable(spark, f"{tmp_dir}/f"), VersionedTable(spark, f"{tmp_dir}/s")
    source.put_parts(batch(spark, [(1, 1, "a", 0), (2, 1, "b", 0), (None, 1, "x", 0), (None, 1, "x", 0)]), part())
    loads.refresh_key_counts(state, source, part(), ["id"])
    assert loads.repeated_keys(state, ["id"]).count() == 0
    source.put_parts(batch(spark, [(2, 2, "b", 0), (3, 2, "c", 0), (3, 2, "c", 1)]), part())
    for f in files(f"{tmp_dir}/f"):
        if source.commit().parts["p1"][0] in f:
            os.truncate(f, 0)  # the old load cannot be read any more
    assert loads.refresh_key_counts(state, source, part(), ["id"]) == {"p2"}
    assert rows(loads.repeated_keys(state, ["id"])) == [(2, 2, 2), (3, 2, 1)]


# ------------------------------------------------------------ history
COLS = "k int, a string, b string"


def test_repeated_keys_do_not_multiply_history(spark):
    current = spark.createDataFrame([(1, "y", "p"), (1, "x", "q"), (1, "x", "p"), (2, None, "z"), (2, "a", "z")], COLS)
    h = scd2_merge(None, current, "k", ["a", "b"], "2024-01-01")
    for month in (2, 3):
        h = scd2_merge(h, current, "k", ["a", "b"], f"2024-0{month}-01")
    assert [tuple(r)[:3] for r in h.orderBy("k").collect()] == [(1, "x", "p"), (2, None, "z")]
    with pytest.raises(Exception, match="repeated key"):
        scd2_merge(None, current, "k", ["a", "b"], "2024-01-01", repeats="error").collect()
    alone = spark.createDataFrame([(1, "y", "p"), (None, "n", "p")], COLS)
    assert scd2_merge(None, alone, "k", ["a", "b"], "2024-01-01", repeats="error").count() == 2


def test_buckets_without_a_change_keep_their_files(spark, tmp_dir):
    path = f"{tmp_dir}/h"
    v1 = spark.createDataFrame([(i, "x", "p") for i in range(40)] + [(None, "n", "p")], COLS)
    v2 = spark.createDataFrame([(i, "y" if i == 7 else "x", "p") for i in range(2, 41)] + [(7, "z", "p"), (None, "n", "p")], COLS)
    plain, check = None, ["a", "b"]
    for at, v in (("2024-01-01", v1), ("2024-02-01", v2), ("2024-03-01", v2)):
        before = files(path)
        written = loads.snapshot_buckets(spark, path, v, "k", check, at, n_buckets=16)
        plain = scd2_merge(plain, v, "k", check, at)
        table = VersionedTable(spark, path)
        assert rows(table.read().select("k", "a", "b", F.col("valid_from").cast("string"), F.col("valid_to").cast("string"))) \
            == rows(plain.select("k", "a", "b", F.col("valid_from").cast("string"), F.col("valid_to").cast("string")))
        if before:
            assert {f: t for f, t in files(path).items() if f in before} == before
            assert len(written) <= 2
    assert written == set() and table.numbers() == [1, 2]
