import hashlib
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardstar.llm import merkle

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("source", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("n_chars", T.LongType()),
                       T.StructField("text", T.StringType())])


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(nodes):
    """All levels of a tree, and the digests beside each of its nodes."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    paths = []
    for i in range(len(nodes)):
        path = []
        for level in levels[:-1]:
            lo = i // 8 * 8
            path.append(("".join(level[lo:i]), "".join(level[i + 1:lo + 8])))
            i //= 8
        paths.append(path)
    return levels[-1][0], paths


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r)
    order = sorted(by, key=lambda g: (g is not None, (g or "").encode()))
    parts = []
    for g in order:
        rs = sorted(by[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        parts.append((g, rs, *climb([leaf_of(r) for r in rs])))
    root, tops = climb([p[2] for p in parts])
    out = []
    for (g, rs, sub, paths), top in zip(parts, tops):
        for r, p in zip(rs, paths):
            path = p + top
            out.append((r[0], leaf_of(r), sub, root, h(*[a + b for a, b in path])))
    return out


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"grp": F.lit("x"), "witness": F.lit(3)}).repartition(5)
    m = merkle.build_manifest(df, merkle.leaf_digest(*[F.col(c) for c in FIELDS]), "lang", "doc_id",
                              carry=[F.col("doc_id"), F.col("grp"), F.col("witness")])
    got = merkle.audit(m, F.col("leaf")).select(
        "row.doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("witness")).alias("p"),
        "verified", "row.grp").collect()
    assert all(r.verified and r.grp == "x" for r in got)
    key = lambda r: (r[0] is None, r[0] or 0, *map(str, r[1:]))
    assert sorted([tuple(r)[:5] for r in got], key=key) == sorted(brute(rows), key=key)
    return m


def test_every_path_equals_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for lang, n in [("de", 1), ("en", 1300), ("fr", 8), ("é", 9), (None, 70), ("", 64), *((f"l{i}", 2) for i in range(9))]:
        for _ in range(n):
            rows.append((rng.choice([None, *range(2_000)]), rng.choice([None, "web", ""]), lang,
                         rng.choice([None, 5]), rng.choice([None, "", "A b", "漢字", "x" * 3])))
    rows += rows[:40] + [(7, "web", "en", 1, "long " * 200_000)]
    m = check(spark, rows)
    assert len(m.rounds) == 2


def test_lone_rows_and_empty_table(spark):
    rows = [(1, "s", "en", 3, "abc")]
    m = check(spark, rows)
    row = m.witnesses().first()
    assert row.leaf == row.subroot == row.root == m.root and row.witness == []
    empty = merkle.build_manifest(spark.createDataFrame([], SCHEMA), merkle.leaf_digest(F.col("text")),
                                  "lang", "doc_id")
    assert empty.root is None and empty.witnesses().count() == 0


def test_more_groups_than_a_block(spark):
    check(spark, [(i, None, f"g{i % 600}", i, "t") for i in range(650)])


def test_a_changed_text_or_digest_does_not_verify(spark):
    rows = [(i, "s", "en", 3, f"Text {i}") for i in range(700)]
    df = spark.createDataFrame(rows, SCHEMA)
    leaf = merkle.leaf_digest(*[F.col(c) for c in FIELDS])
    claim = F.when(F.col("doc_id") % 3 == 0, merkle.leaf_digest(
        *[F.col(c) for c in FIELDS[:4]], F.lower("text"))).otherwise(leaf)
    m = merkle.build_manifest(df, leaf, "lang", "doc_id", carry=[F.col("doc_id"), claim.alias("claim")])
    got = merkle.audit(m, F.col("row.claim")).select("row.doc_id", "verified").collect()
    assert len(got) == 700 and all(r.verified == (r.doc_id % 3 != 0) for r in got)


def test_fields_do_not_run_into_each_other(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "-"), ("-", None), (None, None), ("", "")],
                               "a string, b string")
    assert df.select(merkle.leaf_digest(F.col("a"), F.col("b")).alias("d")).distinct().count() == 6


def test_appends_extend_witnesses_as_siblings_complete():
    stream = merkle.AppendStream(2)
    nodes = [stream.append(h(str(i))) for i in range(3)]
    assert merkle.witness(nodes[0]) == [] and nodes[0].right == h("1") + h("2")
    nodes += [stream.append(h(str(i))) for i in range(3, 20)]
    root = stream.finish()
    want, paths = climb([h(str(i)) for i in range(20)])
    assert root == want
    assert [[(s["left"], s["right"]) for s in merkle.witness(n)] for n in nodes] == paths
