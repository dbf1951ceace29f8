import random
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from frames import docs, odd_docs
from wardstar.llm import queries, sharding


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def key(doc_id, text):
    k1 = 42 if text is None else signed(xxhash.xxh64_intdigest(text.encode(), 42))
    return k1, sharding.LEAST if doc_id is None else doc_id


def n_bytes(text):
    return len((text or "").encode()) + 1


def check(rows, got, n_shards, tolerance):
    """Against a plain sort: one order over all shards, gapless slots, and every
    border within the tolerance or at the row border nearest to its share."""
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in got) == sorted(
        (i is None, i or 0, n_bytes(t), zlib.crc32((t or "").encode())) for i, t in rows)
    assert all(0 <= r.shard < n_shards for r in got)
    order = sorted(got, key=lambda r: (r.shard, r.slot))
    want = sorted(rows, key=lambda r: key(*r))
    assert [(r.doc_id, r.size) for r in order] == [(i, n_bytes(t)) for i, t in want]
    slots = {}
    for r in order:
        assert r.slot == slots.get(r.shard, 0)
        slots[r.shard] = r.slot + 1
    total = sum(r.size for r in got)
    borders, done = {0}, 0
    for r in order:
        done += r.size
        borders.add(done)
    for s in range(1, n_shards):
        at, share = sum(r.size for r in got if r.shard < s), total * s // n_shards
        assert abs(at - share) <= max(tolerance * total / n_shards, min(abs(b - share) for b in borders))


@pytest.mark.parametrize("n_shards,tolerance", [(16, 0.01), (3, 0.0), (1, 0.01), (40, 0.2)])
def test_borders_of_random_texts(spark, n_shards, tolerance):
    rng = random.Random(n_shards)
    rows = [(i, "".join(rng.choices("abé漢 ", k=rng.randint(0, 90)))) for i in range(900)]
    got = sharding.shard_by_bytes(docs(spark, rows).repartition(4), n_shards, tolerance).collect()
    check(rows, got, n_shards, tolerance)


def test_a_group_of_copies_is_cut_and_small_groups_are_not(spark):
    rng = random.Random(2)
    rows = [(i, f"text {i // 3} " * rng.randint(1, 9)) for i in range(1500)] + [(9_000 + i, "hot " * 30) for i in range(800)]
    got = sharding.shard_by_bytes(docs(spark, rows).repartition(5), 8, 0.05).collect()
    check(rows, got, 8, 0.05)
    text = dict(rows)
    shards = {}
    for r in got:
        shards.setdefault(text[r.doc_id], set()).add(r.shard)
    assert len(shards.pop("hot " * 30)) > 2
    assert all(len(s) == 1 for s in shards.values())


def test_equal_rows_are_spread_by_their_place(spark):
    rows = [(5, "same")] * 600 + [(None, None)] * 200 + [(None, "same")] * 3
    got = sharding.shard_by_bytes(docs(spark, rows).repartition(3), 4, 0.0).collect()
    check(rows, got, 4, 0.0)


def test_odd_texts_and_clashing_columns(spark):
    df = odd_docs(spark)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    wide = df.withColumns({"k1": F.lit("mine"), "Size": F.lit("old"), "row": F.lit(1)})
    got = sharding.shard_by_bytes(wide, 4, 0.01)
    assert got.columns == ["doc_id", "text", "k1", "row", "size", "text_crc32", "shard", "slot"]
    check(rows, got.collect(), 4, 0.01)
    assert {r.k1 for r in got.collect()} == {"mine"}
    check([(1, "x" * 3_000_000), (2, "y"), (3, None)],
          sharding.shard_by_bytes(docs(spark, [(1, "x" * 3_000_000), (2, "y"), (3, None)]), 4).collect(), 4, 0.01)


def test_text_ids_and_empty_table(spark):
    df = spark.createDataFrame([(f"d{i}", f"t{i % 4}") for i in range(50)], "doc_id string, text string")
    got = sharding.shard_by_bytes(df, 5).collect()
    assert sorted(r.doc_id for r in got) == sorted(f"d{i}" for i in range(50))
    assert {r.shard for r in got} == set(range(5))
    assert sharding.shard_by_bytes(docs(spark, []), 4).collect() == []
    with pytest.raises(ValueError):
        sharding.shard_by_bytes(df, 0)


def test_written_shards_are_read_back(spark, tmp_dir):
    rows = [(i, f"text {i} " * (i % 7)) for i in range(300)]
    sharded = sharding.shard_by_bytes(docs(spark, rows), 4)
    sharding.write_shards(sharded, f"{tmp_dir}/shards")
    back = spark.read.parquet(f"{tmp_dir}/shards")
    assert sorted((r.doc_id, r.text, r.shard, r.slot) for r in back.collect()) == sorted(
        (r.doc_id, r.text, r.shard, r.slot) for r in sharded.collect())


def test_shards_of_the_query_hold_whole_texts(spark, tmp_dir):
    """Sizes and checksums are read from shards that hold every text."""
    rng = random.Random(4)
    rows = [(i, "".join(rng.choices("abé漢 ", k=rng.randint(0, 300)))) for i in range(400)] + [(None, None), (7, ""), (7, "")]
    docs(spark, rows).repartition(3).write.parquet(f"{tmp_dir}/documents.parquet")
    out = queries.QUERIES["op12_sharding"](spark, tmp_dir)
    got = out.collect()
    assert out.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    check(rows, got, 16, 0.01)
    files = [f for f in out.inputFiles() if "/shard=" in f]
    stored = spark.read.option("basePath", files[0].split("/shard=")[0]).parquet(*files).select("shard", "row.*").collect()
    assert sorted((r.shard, r.doc_id is None, r.doc_id or 0, r.text or "") for r in stored) == sorted(
        (r.shard, r.doc_id is None, r.doc_id or 0, t or "") for r in got for t in [next(
            t for i, t in rows if i == r.doc_id and zlib.crc32((t or "").encode()) == r.text_crc32 and n_bytes(t) == r.size)])


def test_written_shards_of_an_empty_table(spark, tmp_dir):
    assert sharding.shard_by_bytes(docs(spark, []), 4, folder=f"{tmp_dir}/none").collect() == []
