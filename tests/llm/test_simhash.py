import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from frames import ODD_TEXTS, docs, odd_docs
from wardstar.llm import simhash as sh

WORDS = re.compile("[^\x20\x09-\x0D]+")


def by_hand(text, k=3):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    w = WORDS.findall(low)
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(w[i:i + k]), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def classes(points, bits):
    """Smallest member of each point's class, by all pairs."""
    low = {p: p for p in points}
    changed = True
    while changed:
        changed = False
        for p in points:
            for q in points:
                if (p ^ q).bit_count() <= bits and low[q] < low[p]:
                    low[p], changed = low[q], True
    return low


@pytest.mark.parametrize("text", [t for t in ODD_TEXTS if len(t or "") < 10_000])
def test_fingerprint(text):
    assert sh.fingerprint(text) == by_hand(text)


def test_hash_equals_sparks(spark):
    got = spark.sql("select xxhash64('ab cd é') h").first().h
    assert got % (1 << 64) == xxhash.xxh64_intdigest("ab cd é", 42)


def cluster(rng, n, flips):
    centre = rng.getrandbits(64)
    out = set()
    while len(out) < n:
        x = centre
        for _ in range(rng.randint(0, flips)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return out


def points_of(seed):
    rng = random.Random(seed)
    pts = {rng.getrandbits(64) for _ in range(150)} | cluster(rng, 60, 4) | cluster(rng, 40, 9)
    return sorted(pts)


@pytest.mark.parametrize("bits", [0, 1, 2, 5])
def test_links_of_a_shard(monkeypatch, bits):
    monkeypatch.setattr(sh, "LEAF", 20)
    pts = points_of(bits)
    arr = np.array(pts, np.uint64)
    low = dict(enumerate(range(len(pts))))
    for i, j in sh.link(arr, bits):
        assert j < i
        low[i] = j
    want = classes(pts, bits)
    assert [pts[low[i]] for i in range(len(pts))] == [want[p] for p in pts]


@pytest.mark.parametrize("bits", [0, 2, 5])
def test_every_close_pair_meets_in_a_shard(bits):
    pts = points_of(7)
    arr = np.array(pts, np.uint64)
    tree = sh.fit_tree(arr[::3], bits, 5, 12)
    assert len(tree) > 5
    where = [set() for _ in pts]
    for shard, at in sh.route(arr, tree, bits):
        for i in at.tolist():
            where[i].add(shard)
    assert all(where)
    for i, p in enumerate(pts):
        for j in range(i):
            if (p ^ pts[j]).bit_count() <= bits:
                assert where[i] & where[j]


@pytest.mark.parametrize("block", [1 << 22, 7])
def test_links_on_spark_with_shards_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(sh, "SHARD_BLOCK", block)
    monkeypatch.setattr(sh, "SHARD_ROWS", 10)
    monkeypatch.setattr(sh, "LEAST_SAMPLE", 4)
    pts = points_of(11)
    signed = [p - (1 << 64) if p >> 63 else p for p in pts]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    roots = {r.node: r.root for r in sh.components(sh.fingerprint_links(df, 2)).collect()}
    want = classes(pts, 2)
    groups = {}
    for p, s in zip(pts, signed):
        groups.setdefault(want[p], set()).add(roots.get(s, s))
    assert all(len(g) == 1 for g in groups.values())
    assert len(set().union(*groups.values())) == len(groups)


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(5, 5), (150, 7)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.root for r in sh.components(df).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 150: 0, **{100 + i: 100 for i in range(1, 30)}}
    assert sh.components(df.limit(0)).count() == 0


def sample_docs(spark):
    rng = random.Random(4)
    base = [" ".join(f"w{rng.randrange(999)}" for _ in range(120)) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i, t in enumerate(base[:6]):
        words = t.split()
        words[50 + i] = "other"
        rows += [(100 + i, " ".join(words)), (200 + i, t.upper()), (50 + i, t)]
    rows += [(300, rows[0][1]), (300, rows[0][1]), (7, base[8])]
    return docs(spark, rows).union(odd_docs(spark).withColumn("doc_id", F.col("doc_id") + 1000))


def test_near_duplicates_equal_brute_force(spark):
    df = sample_docs(spark).withColumns({"fp": F.lit("clash"), "component_id": F.lit(0)})
    rows = df.collect()
    prints = [by_hand(r.text) if len(r.text or "") < 10_000 else sh.fingerprint(r.text) for r in rows]
    low = classes(sorted(set(prints)), 2)
    least = {}
    for r, p in zip(rows, prints):
        if r.doc_id is not None:
            least[low[p]] = min(r.doc_id, least.get(low[p], r.doc_id))
    want = sorted(((r.doc_id, p, least[low[p]]) for r, p in zip(rows, prints)), key=str)
    got = sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in sh.near_duplicates(df).collect()), key=str)
    assert got == want


def test_deduplicate_keeps_one_row_of_each_class(spark):
    df = sample_docs(spark).withColumns({"fp": F.lit("own"), "n": F.lit(1)})
    kept = sh.deduplicate(df)
    assert kept.columns == df.columns
    print_of = lambda r: sh.fingerprint(r.text)
    all_rows, rows = df.collect(), kept.collect()
    low = classes(sorted({print_of(r) for r in all_rows}), 2)
    members = {}
    for r in all_rows:
        members.setdefault(low[print_of(r)], []).append(r)
    assert sorted(low[print_of(r)] for r in rows) == sorted(members)
    for r in rows:
        ids = [m.doc_id for m in members[low[print_of(r)]] if m.doc_id is not None]
        assert r in members[low[print_of(r)]] and r.doc_id == min(ids)


def test_empty_table(spark):
    assert sh.near_duplicates(docs(spark, [])).count() == 0
    assert sh.deduplicate(docs(spark, [])).count() == 0


def test_ids_that_are_all_null(spark):
    df = docs(spark, [(None, "a b c d"), (None, "a b c d"), (None, "something else here")])
    assert [r.component_id for r in sh.near_duplicates(df).collect()] == [None] * 3
    assert sh.deduplicate(df).count() == 2
