"""SimHash near-duplicates by vantage-point partitioning.

1. Fingerprints. Texts are lower-cased (A-Z), cut into words
   ``[^\\x20\\x09-\\x0D]+`` and shingles of ``shingle_words`` words joined by a
   blank (fewer words: the whole sequence). A bit is 1 if it is set in over
   half of the shingles' 64-bit hashes (XXH64, seed 42).
2. Equal fingerprints become one row, however many copies a text has.
3. A vantage-point tree, fitted on a bounded sample of fingerprints, routes
   each fingerprint to its home shard. At a split with radius m around a
   vantage point, those at distance m+1 .. m+max_bits belong outside but are
   also copied inside: by the triangle inequality, two fingerprints within
   ``max_bits`` of each other that the split separates meet inside. So every
   close pair has a shard that holds both, and only shards that overlap a
   boundary see a copy.
4. Shards are searched on their own, by further vantage points and then bit
   counts in blocks. A shard gives the links that join its groups (at most one
   per fingerprint), never all pairs.
5. Components are found over those links by repeated minimum labels, as
   joins and aggregates, each round written to the shared checkpoint folder.

Defined cases: null and empty texts, and texts of white space, have
fingerprint zero and link like any other; rows with equal ids share one
component through their texts' fingerprints; a null id is never a component's
name unless all its documents have null ids; texts of any length are read whole;
a bit set in exactly half of the hashes is 0; an empty table gives no rows.
Columns that clash with ``fingerprint`` or ``component_id`` are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardstar.session import materialize

from .common import add_text_columns, quoted

# The tree is fitted on at most this many fingerprints, in hash order.
SAMPLE_ROWS = 50_000
# Fingerprints wanted in a shard, as long as it has this many of the sample.
SHARD_ROWS = 4096
LEAST_SAMPLE = 24
MAX_DEPTH = 24
# Larger shards are searched as a grid of blocks of this size.
SHARD_BLOCK = 1 << 22
# Within a task, sets up to this size are compared bit by bit.
LEAF = 1024
HASH_BLOCK = 1 << 15


# ------------------------------------------------------------ fingerprints
def fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    from xxhash import xxh64_intdigest
    words = (text or "").encode("utf-8").lower().split()  # bytes: A-Z only, six spaces
    if not words:
        return 0
    buf = b" ".join(words) + b" "
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    last = np.cumsum(sizes) - 1
    first = last + 1 - sizes
    k = min(shingle_words, len(words))
    first, last = first[:len(words) - k + 1], last[k - 1:]
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(first), HASH_BLOCK):
        at = zip(first[lo:lo + HASH_BLOCK].tolist(), last[lo:lo + HASH_BLOCK].tolist())
        h = np.array([xxh64_intdigest(buf[s:e], 42) for s, e in at], "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(first), bitorder="little").view("<u8")[0])


def add_fingerprints(df: DataFrame, text_col: str = "text", shingle_words: int = 3,
                     keep: list[str] | None = None) -> DataFrame:
    """Append ``fp``, the fingerprint as a signed long."""
    schema = T.StructType([T.StructField("fp", T.LongType(), False)])

    def make():
        return lambda texts: [pa.array(np.array(
            [fingerprint(t, shingle_words) for t in texts], np.uint64).view(np.int64))]
    return add_text_columns(df, text_col, schema, make, keep)


# ------------------------------------------------------------ the tree
def _distances(points: np.ndarray, to: int) -> np.ndarray:
    return np.bitwise_count(points ^ np.uint64(to)).astype(np.int16)


def _split(points: np.ndarray, max_bits: int, rng: np.random.Generator,
           tries: int = 8) -> tuple[int, int] | None:
    """A vantage point and radius with few points on the boundary: the larger
    side, copies included, is as small as possible. None if nothing is gained."""
    best, found = len(points) * 0.9, None
    sample = points if len(points) <= 4096 else rng.choice(points, 4096, replace=False)
    scale = len(points) / len(sample)
    for vp in rng.choice(sample, min(tries, len(sample)), replace=False).tolist():
        counts = np.bincount(_distances(sample, vp), minlength=65 + max_bits)
        inside = np.cumsum(counts)
        for m in range(65):
            ins, out = inside[min(m + max_bits, 64)], len(sample) - inside[m]
            cost = max(ins, out) * scale
            if out and cost < best:
                best, found = cost, (vp, m)
    return found


def fit_tree(points: np.ndarray, max_bits: int, leaf: int, max_depth: int) -> list[tuple]:
    """Nodes (vantage point, radius, inside child, outside child); a child
    below 0 is the shard ``-1 - child``. A tree without nodes has one shard."""
    rng = np.random.default_rng(0)
    nodes: list[list] = []
    shards = 0

    def grow(part: np.ndarray, depth: int) -> int:
        nonlocal shards
        cut = _split(part, max_bits, rng) if len(part) > leaf and depth < max_depth else None
        if cut is None:
            shards += 1
            return -shards
        vp, m = cut
        at = len(nodes)
        nodes.append([vp, m, 0, 0])
        d = _distances(part, vp)
        nodes[at][2] = grow(part[d <= m + max_bits], depth + 1)
        nodes[at][3] = grow(part[d > m], depth + 1)
        return at
    grow(points, 0)
    return [tuple(n) for n in nodes]


def route(points: np.ndarray, tree: list[tuple], max_bits: int):
    """Yield (shard, indices): the home shard of each point, and every shard
    whose boundary it overlaps."""
    todo = [(0 if tree else -1, np.arange(len(points)))]
    while todo:
        node, at = todo.pop()
        if not len(at):
            continue
        if node < 0:
            yield -1 - node, at
            continue
        vp, m, inside, outside = tree[node]
        d = _distances(points[at], vp)
        todo += [(inside, at[d <= m + max_bits]), (outside, at[d > m])]


# ------------------------------------------------------------ links of a shard
class _Groups:
    """Union of positions; only positions that were joined take memory."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, i: int) -> int:
        p = self.parent
        while (up := p.get(i, i)) != i:
            p[i] = p.get(up, up)
            i = up
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.parent[max(i, j)] = min(i, j)


def link(points: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Pairs (position, smaller position) that join the groups of points
    linked at ``max_bits`` or fewer differing bits; one per joined point."""
    groups = _Groups()
    seen = np.arange(len(points))  # a root that a position had at some time
    rng = np.random.default_rng(0)
    todo = [np.arange(len(points))]
    while todo:
        at = todo.pop()
        cut = _split(points[at], max_bits, rng, tries=3) if len(at) > LEAF else None
        if cut is not None:
            d = _distances(points[at], cut[0])
            todo += [at[d <= cut[1] + max_bits], at[d > cut[1]]]
            continue
        for lo in range(0, len(at), 256):
            rows, rest = at[lo:lo + 256], at[lo:]
            for c in range(0, len(rest), 4096):
                cols = rest[c:c + 4096]
                close = np.bitwise_count(points[rows][:, None] ^ points[cols][None, :]) <= max_bits
                for i in np.flatnonzero(close.sum(axis=1) > (c == 0)).tolist():
                    row = int(rows[i])
                    near = cols[close[i]]
                    # those already known to be in the row's group need no look
                    near = near[seen[near] != seen[row]]
                    for j in near.tolist():
                        groups.join(row, j)
                    seen[near] = seen[row] = groups.root(row)
    return [(i, groups.root(i)) for i in sorted(groups.parent)]


def fingerprint_links(prints: DataFrame, max_bits: int) -> DataFrame:
    """(a, b): links that connect the distinct fingerprints ``fp`` of
    ``prints`` into the groups of all links at ``max_bits`` bits."""
    spark = prints.sparkSession
    # crc32 orders the fingerprints by chance, equal at every run
    sample = [r.fp for r in prints.orderBy(F.crc32(F.hex("fp").cast("binary")), "fp")
              .limit(SAMPLE_ROWS).collect()]
    leaf = max(LEAST_SAMPLE, SHARD_ROWS * len(sample) // max(1, prints.count()))
    tree = fit_tree(np.array(sample, np.int64).view(np.uint64), max_bits, leaf, MAX_DEPTH)
    shared = spark.sparkContext.broadcast(tree)  # some nodes for every LEAST_SAMPLE sampled rows

    def deal(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy()
            for shard, at in route(fp.view(np.uint64), shared.value, max_bits):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), shard, np.int32)), pa.array(fp[at])],
                    names=["shard", "fp"])
    dealt = materialize(prints.mapInArrow(deal, "shard int, fp long"), "simhash-shards")

    # a shard beyond the block size becomes a grid of cells; two blocks meet in one
    sizes = dealt.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / F.lit(SHARD_BLOCK)).cast("int").alias("k"))
    block = F.pmod(F.xxhash64("fp"), F.col("k")).cast("int")
    cells = dealt.join(sizes, "shard").select(
        "shard", "fp", block.alias("i"), F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("j")) \
        .select("shard", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "fp")

    def search(_key, t):
        fp = np.unique(t.column("fp").to_numpy().view(np.uint64))
        pairs = np.array(link(fp, max_bits), np.int64).reshape(-1, 2)
        return pa.table({"a": fp[pairs[:, 0]].view(np.int64), "b": fp[pairs[:, 1]].view(np.int64)})
    return cells.groupBy("shard", "i", "j").applyInArrow(search, "a long, b long").distinct()


# ------------------------------------------------------------ components
def components(links: DataFrame) -> DataFrame:
    """(node, root): each linked node (of links a, b) and the smallest node
    that it reaches. Rounds of large star and small star, which keep the
    number of links; every round is written to the shared checkpoint folder.
    Done when the links are stars around their smallest node."""
    edges = materialize(links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links-0")
    n = 0
    while not _are_stars(edges):
        n += 1
        # large star: larger neighbours of a node go to the node's smallest neighbour
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u and v <> m") \
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: smaller neighbours of a node, and the node, go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")) \
            .select("e.*").where("u <> v").distinct()
        edges = materialize(small, f"links-{n}")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _are_stars(edges: DataFrame) -> bool:
    """Has every node one smaller neighbour, which has none itself?"""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e"))
    by_node = ends.groupBy("e.n").agg(F.sum("e.up").alias("up"), F.max("e.down").alias("down"))
    return by_node.where("up > 1 or up = 1 and down = 1").isEmpty()


def _labelled(df: DataFrame, max_bits: int, shingle_words: int, id_col: str,
              text_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows, groups): (id, text_hash, fp) per row of ``df``, written once, and
    (fp, root) per distinct fingerprint."""
    src = df.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).cast("string").alias("t"),
                    F.xxhash64(F.col(quoted(text_col)).cast("string")).alias("text_hash"))
    rows = materialize(add_fingerprints(src, "t", shingle_words, keep=["id", "text_hash"]),
                       "simhash-fingerprints")
    # one row per fingerprint: a group of copies is reduced before it is shuffled
    distinct = materialize(rows.select("fp").distinct(), "simhash-distinct")
    roots = components(fingerprint_links(distinct, max_bits))
    groups = distinct.join(roots, distinct.fp == roots.node, "left") \
        .select("fp", F.coalesce("root", "fp").alias("root"))
    return rows, materialize(groups, "simhash-groups")


def near_duplicates(df: DataFrame, max_bits: int = 2, shingle_words: int = 3,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: the id column, ``fp`` and ``component_id``
    (the smallest id of the documents reachable over links)."""
    rows, groups = _labelled(df, max_bits, shingle_words, id_col, text_col)
    least = rows.groupBy("fp").agg(F.min("id").alias("least_id")).join(groups, "fp")
    names = least.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = groups.join(names, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def deduplicate(df: DataFrame, max_bits: int = 2, shingle_words: int = 3,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns as they are, one per component: that of
    the smallest id (null last), of equal ids the smallest text hash, of equal
    rows any one."""
    rows, groups = _labelled(df, max_bits, shingle_words, id_col, text_col)
    keys = rows.groupBy("id", "text_hash", "fp").agg(F.count(F.lit(1)).alias("n")).join(groups, "fp")
    first = keys.groupBy("root").agg(F.min(F.struct(
        F.col("id").isNull().alias("no_id"), "id", "text_hash", "n")).alias("k")) \
        .select(F.col("k.id").alias("__id"), F.col("k.text_hash").alias("__hash"), "k.n")
    first = materialize(first, "simhash-first")
    text_hash = F.xxhash64(F.col(quoted(text_col)).cast("string"))
    kept = df.join(first, F.col(quoted(id_col)).eqNullSafe(F.col("__id")) & (text_hash == F.col("__hash")),
                   "left_semi")
    if first.where("n > 1").isEmpty():
        return kept
    # rows that occur more than once, id and text alike
    h = "__text_hash"
    return kept.withColumn(h, text_hash).dropDuplicates([id_col, h]).drop(h)


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
