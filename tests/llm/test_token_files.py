import glob
import random
import zlib

import numpy as np
import public_tokenizers as P
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from frames import docs, odd_docs
from wardstar.llm import token_files as tf

PATH = P.path("byte_bpe_50k.json")


def test_random_texts_equal_the_library():
    rng = random.Random(9)
    lib, own = Tokenizer.from_file(PATH), tf.encoder(PATH)
    for letters in (list("abcde hinorst' 12\n\t\x1c\x85é ß,.!漢🙂\0_²") + [" the", "  ", "<|endoftext|>"],
                    list("ab c\nd,.é1")):
        texts = ["".join(rng.choices(letters, k=rng.randint(0, 30))) for _ in range(6000)]
        for got, want, t in zip(own.encode(texts), lib.encode_batch(texts, add_special_tokens=False), texts):
            assert got.tolist() == want.ids, t


def check(spark, df, folder, rows):
    lib, start = Tokenizer.from_file(PATH), 0
    got = tf.read_token_files(spark, folder).orderBy("start").collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    assert [r.doc_id for r in got] == [i for i, _ in want]
    for r, (_, text) in zip(got, want):
        ids = lib.encode(text or "", add_special_tokens=False).ids + [0]
        assert (r.start, r.n_tokens, r.ids) == (start, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_write_and_read(spark, tmp_dir):
    df = odd_docs(spark).union(docs(spark, [(5, "again"), (5, "again"), (-3, "below")])).repartition(3)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    wide = df.withColumns({"id": F.lit("clash"), "part": F.lit(1)})
    folder = tf.write_token_files(wide, PATH, folder=f"file://{tmp_dir}/run")
    check(spark, df, folder, rows)
    assert not glob.glob(f"{tmp_dir}/run/*.tmp*")


def test_many_parts_have_prefix_sums(spark, tmp_dir):
    rows = [(i * 7 % 1000, f"text number {i} " * (i % 5)) for i in range(1000)]
    df = docs(spark, rows)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        folder = tf.write_token_files(df, PATH, folder=f"{tmp_dir}/many")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    parts = tf.read_manifest(spark, folder).orderBy("part").collect()
    assert len(parts) > 3
    assert [p.base for p in parts] == [sum(q.n_tokens for q in parts[:i]) for i in range(len(parts))]
    check(spark, df, folder, rows)


def test_a_hot_id_spreads_over_parts(spark, tmp_dir):
    rows = [(i, f"text {i}") for i in range(200)] + [(77, f"hot {i}") for i in range(200)] \
        + [(None, f"null {i}") for i in range(200)]
    df = docs(spark, rows)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        folder = tf.write_token_files(df, PATH, folder=f"{tmp_dir}/hot")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert max(p.n_docs for p in tf.read_manifest(spark, folder).collect()) < 150
    check(spark, df, folder, rows)


def test_empty_table(spark, tmp_dir):
    folder = tf.write_token_files(docs(spark, []), PATH, folder=f"{tmp_dir}/none")
    assert tf.read_token_files(spark, folder).count() == 0


def test_equal_rows_spread_over_parts(spark, tmp_dir):
    rows = [(7, "the same text " * 40)] * 900 + [(i, f"other {i}") for i in range(100)]
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    try:
        folder = tf.write_token_files(docs(spark, rows).repartition(5), PATH, folder=f"file://{tmp_dir}/run")
        sizes = [r.n_docs for r in tf.read_manifest(spark, folder).collect()]
        assert len(sizes) == 6 and max(sizes) < 400
        check(spark, None, folder, rows)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
