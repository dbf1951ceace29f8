"""Hard negatives of labelled vectors by bounds along a spanning tree of anchors.

Every anchor gets its best rows of the same label (positives), and for each of
them the best rows of other labels whose score lies in a window below the
positive's. Scores are inner products of scaled whole numbers, so all results
are exact.

Anchors are the queries; they stand in blocks of ``ANCHOR_BLOCK``, neighbours in
label order together, and each block has a least spanning tree over the
distances of its anchors. A candidate's score at the tree's root is computed.
At a child it differs from that at its parent by the edge's length times the
candidate's norm at most, so the parent's score, or the bounds on it, give bounds
on the child's. Only candidates whose bounds overlap what is still wanted are
scored again: scores not below the worst of the best rows so far and, for
negatives, inside the windows of the anchor's positives.

All rows stand in blocks too, written once with their vectors as one array. A
job joins each block of candidates with all anchor blocks by its number: anchors,
the smaller side, are repeated per candidate block, candidates never. A pair of
blocks leaves at most k rows per anchor (and positive), which a window over the
anchor merges. Nothing is collected, and a task holds one pair of blocks and
the bounds of ``SLICE_ROWS`` candidates.

How much the bounds save depends on the vectors: near copies and clusters are
skipped, independent directions lie as far apart as their norms and are all
scored again.

Defined cases: rows with a null label or vector, or with a null, NaN or infinite
component take no part; an empty vector scores 0; vectors meet those of their own
length only; equal scores are ordered by id, null ids last, and then by place, so
that repeated rows are rows of their own and an anchor is never its own
positive, but an equal row may be; a null id is no anchor; an anchor without
positives, or a positive without negatives in its window, has no rows; an empty
table has none. A score beyond 64 bits fails the job. Only id, label and vector
are read, so that no other column can clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardstar.operators.rownum import global_row_number
from wardstar.session import materialize

from .common import bound_batches, quoted

ANCHOR_BLOCK = 1024
# Candidates per block: a 64th of the table within these limits.
LEAST_BLOCK, GREATEST_BLOCK = 2_048, 131_072
# Candidates whose bounds are held at a time.
SLICE_ROWS = 2_048
LARGE = 1 << 53


def _field(name, kind):
    return T.StructField(name, kind)


_LONGS, _BYTES = T.ArrayType(T.LongType()), T.BinaryType()
_BLOCK = T.StructType([
    _field("dim", T.IntegerType()), _field("block", T.LongType()), _field("places", _LONGS),
    _field("ids", _LONGS), _field("labels", _LONGS), _field("vectors", _BYTES)])
_TREE = T.StructType([
    _field("dim", T.IntegerType()), _field("anchors", T.LongType()), _field("a_places", _LONGS),
    _field("a_ids", _LONGS), _field("a_labels", _LONGS), _field("a_vectors", _BYTES),
    _field("parents", _LONGS), _field("edges", T.ArrayType(T.DoubleType()))])
_BEST = T.StructType([
    _field("anchor_place", T.LongType()), _field("anchor_id", T.LongType()), _field("dim", T.IntegerType()),
    _field("anchors", T.LongType()), _field("at", T.LongType()), _field("positive", T.IntegerType()),
    _field("positive_id", T.LongType()), _field("positive_score", T.LongType()),
    _field("place", T.LongType()), _field("id", T.LongType()), _field("score", T.LongType())])


def prepare(df: DataFrame, is_anchor: Column, id_col: str, label_col: str, vector_col: str,
            scale: int) -> DataFrame:
    """Rows that take part, as whole numbers, each with a place of its own;
    written once, because the places must not change."""
    v = F.col(quoted(vector_col))
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double"))
                       | (F.abs(x.cast("double")) == float("inf")))
    rows = df.where(F.col(quoted(label_col)).isNotNull() & v.isNotNull() & finite).select(
        F.col(quoted(id_col)).cast("long").alias("id"), F.col(quoted(label_col)).cast("long").alias("label"),
        F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("vector"),
        F.coalesce(is_anchor & F.col(quoted(id_col)).isNotNull(), F.lit(False)).alias("is_anchor"))
    return materialize(rows.withColumns({"place": F.monotonically_increasing_id(), "dim": F.size("vector")}),
                       "vectors")


# ------------------------------------------------------------ blocks and trees
def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy()
    return np.ascontiguousarray(flat.reshape(len(column), dim))


def _stored(m: np.ndarray) -> bytes:
    """As 32-bit numbers if they fit."""
    return (m.astype(np.int32) if _greatest(m) < 1 << 31 else m).tobytes()


def _pack(table: pa.Table) -> pa.Table:
    from pyspark.sql.pandas.types import to_arrow_schema
    t = table.combine_chunks()
    dim = t.column("dim")[0].as_py()
    vectors = _matrix(t.column("vector").chunk(0), dim)
    one = lambda name: [t.column(name).to_pylist()]
    return pa.Table.from_arrays(
        [pa.array([dim], pa.int32()), pa.array([t.column("block")[0].as_py()], pa.int64()),
         *[pa.array(one(c), pa.list_(pa.int64())) for c in ("place", "id", "label")],
         pa.array([_stored(vectors)], pa.binary())],
        schema=to_arrow_schema(_BLOCK))


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order, parents (places in that order, -1 for the root) and edge lengths
    of a least spanning tree, from the vector nearest to the middle."""
    x = vectors.astype(np.float64)
    n = len(x)
    squares = (x * x).sum(1)
    root = int(((x - x.mean(0)) ** 2).sum(1).argmin())
    far = np.full(n, np.inf)
    near = np.full(n, -1)
    order, place = [], np.full(n, -1)
    outside = np.ones(n, bool)
    at = root
    for step in range(n):
        order.append(at)
        place[at] = step
        outside[at] = False
        d = squares + squares[at] - 2 * (x @ x[at])
        closer = outside & (d < far)
        far[closer], near[closer] = d[closer], at
        at = int(np.where(outside, far, np.inf).argmin())
    order = np.array(order)
    parents = np.where(near[order] < 0, -1, place[near[order]])
    edges = np.zeros(n)
    inner = parents >= 0
    edges[inner] = np.sqrt(((x[order[inner]] - x[order[parents[inner]]]) ** 2).sum(1))
    return order, parents, edges


def _plant(table: pa.Table) -> pa.Table:
    from pyspark.sql.pandas.types import to_arrow_schema
    t = table.sort_by("at").combine_chunks()
    dim = t.column("dim")[0].as_py()
    vectors = _matrix(t.column("vector").chunk(0), dim)
    order, parents, edges = spanning_tree(vectors)
    t = t.take(pa.array(order))
    return pa.Table.from_arrays(
        [pa.array([dim], pa.int32()), pa.array([t.column("anchors")[0].as_py()], pa.int64()),
         *[pa.array([t.column(c).to_pylist()], pa.list_(pa.int64())) for c in ("place", "id", "label")],
         pa.array([_stored(vectors[order])], pa.binary()),
         pa.array([parents.tolist()], pa.list_(pa.int64())), pa.array([edges.tolist()], pa.list_(pa.float64()))],
        schema=to_arrow_schema(_TREE))


# ------------------------------------------------------------ a pair of blocks
def _numbers(anchors: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as floats where every product and sum is a whole number that a
    float holds exactly, else as integers (of any size if need be)."""
    dim = anchors.shape[1]
    top = dim * _greatest(anchors) * _greatest(rows)
    if top < LARGE:
        return anchors.astype(np.float64), rows.astype(np.float64)
    return (anchors, rows) if top < 1 << 62 else (anchors.astype(object), rows.astype(object))


def _greatest(m: np.ndarray) -> int:
    return max(int(m.max()), -int(m.min())) if m.size else 0


class Best:
    """The k best (score, id, place) of a window [low, high] of scores."""

    def __init__(self, k: int, low: int = -(1 << 63), high: int = (1 << 63) - 1):
        self.k, self.low, self.high = k, low, high
        self.score = self.id = self.place = None

    def add(self, score: np.ndarray, ids: np.ndarray, places: np.ndarray) -> None:
        at = np.flatnonzero((score >= self.low) & (score <= self.high))
        if not len(at):
            return
        score, ids, places = score[at], ids[at], places[at]
        if self.score is not None:
            score, ids, places = (np.concatenate(x) for x in (
                (self.score, score), (self.id, ids), (self.place, places)))
        if len(score) > self.k:
            if len(score) > 4 * self.k:  # rows below the k-th score can't stay
                worst = np.partition(score, len(score) - self.k)[len(score) - self.k]
                at = np.flatnonzero(score >= worst)
                score, ids, places = score[at], ids[at], places[at]
            at = np.lexsort((places, ids, -score))[:self.k]
            score, ids, places = score[at], ids[at], places[at]
            self.low = max(self.low, int(score[-1]))
        self.score, self.id, self.place = score, ids, places

    def rows(self):
        return [] if self.score is None else zip(self.score.tolist(), self.id.tolist(), self.place.tolist())


def _whole(scores: np.ndarray) -> np.ndarray:
    return scores.astype(np.int64) if scores.dtype == object else scores


# Orders after all ids; stands for a null id.
NO_ID = np.iinfo(np.int64).max


def scan_pair(tree: dict, rows: dict, wanted: list[list[Best]], same_label: bool,
              stats: dict | None = None) -> None:
    """Offer a block of rows to the wanted lists of every anchor of a tree."""
    a, c = _numbers(tree["vectors"], rows["vectors"])
    norms_a = np.sqrt((a.astype(np.float64) ** 2).sum(1))
    # lengthened, so that rounding never makes a bound too tight
    edges = tree["edges"] * (1 + 1e-9) + 1e-9 * norms_a
    for lo in range(0, len(c), SLICE_ROWS):
        part = c[lo:lo + SLICE_ROWS]
        ids, labels, places = (rows[k][lo:lo + SLICE_ROWS] for k in ("ids", "labels", "places"))
        norm = np.sqrt((part.astype(np.float64) ** 2).sum(1)) * (1 + 1e-9)
        low, high = np.empty((len(a), len(part))), np.empty((len(a), len(part)))
        for i, parent in enumerate(tree["parents"]):
            if parent < 0:
                score = _whole(part @ a[i])
                low[i] = high[i] = score
                may = np.ones(len(part), bool)
            else:
                score, reach = None, edges[i] * norm
                low[i], high[i] = low[parent] - reach, high[parent] + reach
                may = (high[i] >= min((w.low for w in wanted[i]), default=np.inf)) & (
                    low[i] <= max((w.high for w in wanted[i]), default=-np.inf))
            may &= labels == tree["labels"][i] if same_label else labels != tree["labels"][i]
            may &= places != tree["places"][i]
            at = np.flatnonzero(may)
            if stats is not None:
                stats["pairs"] = stats.get("pairs", 0) + len(part)
                stats["scored"] = stats.get("scored", 0) + (len(at) if score is None else len(part))
            if not len(at):
                continue
            if score is not None:
                found = score[at]
            else:
                found = _whole(part @ a[i])[at] if 2 * len(at) > len(part) else _whole(part[at] @ a[i])
                low[i, at] = high[i, at] = found
            for w in wanted[i]:
                w.add(found, ids[at], places[at])


def _unpack(places, ids, labels, vectors, dim) -> dict:
    n = len(ids)
    kind = np.int32 if len(vectors) == 4 * n * dim else np.int64
    matrix = np.frombuffer(vectors, kind).astype(np.int64) if dim else np.zeros(0, np.int64)
    return {"places": np.asarray(places, np.int64), "ids": ids.fill_null(NO_ID).to_numpy(zero_copy_only=False),
            "labels": np.asarray(labels, np.int64),
            "vectors": matrix.reshape(n, dim)}


def _search(pairs: DataFrame, k: int, same_label: bool) -> DataFrame:
    """Best rows of every pair of blocks. With a column ``windows`` (at, positive,
    id, score, low, high) each positive has its own list, else each anchor one."""
    bound_batches(pairs.sparkSession)
    has_windows = "windows" in pairs.columns
    names = [f.name for f in _BLOCK] + [f.name for f in _TREE if f.name != "dim"] + ["windows"] * has_windows

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        target = to_arrow_schema(_BEST)
        for batch in batches:
            for j in range(batch.num_rows):
                col = lambda name: batch.column(names.index(name))[j]
                dim = col("dim").as_py()
                rows = _unpack(*(col(n).values for n in ("places", "ids", "labels")), col("vectors").as_buffer(), dim)
                tree = _unpack(*(col(n).values for n in ("a_places", "a_ids", "a_labels")),
                               col("a_vectors").as_buffer(), dim)
                tree["parents"], tree["edges"] = col("parents").as_py(), np.asarray(col("edges").values)
                known: list[list[dict]] = [[] for _ in tree["ids"]]
                if has_windows:
                    for w in col("windows").as_py():
                        known[w["at"]].append(w)
                    wanted = [[Best(k, w["low"], w["high"]) for w in ws] for ws in known]
                else:
                    wanted = [[Best(k)] for _ in known]
                    known = [[{"positive": None, "id": None, "score": None}] for _ in known]
                scan_pair(tree, rows, wanted, same_label)
                number = col("anchors").as_py()
                found = [(int(tree["places"][i]), int(tree["ids"][i]), dim, number, i, w["positive"], w["id"], w["score"],
                          place, None if vid == NO_ID else vid, int(score))
                         for i, (ws, lists) in enumerate(zip(known, wanted))
                         for w, best in zip(ws, lists) for score, vid, place in best.rows()]
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, f.type) for x, f in zip(zip(*found), target)], schema=target)
    return pairs.select(*names).mapInArrow(run, _BEST)


def _first(best: DataFrame, k: int, *group: str) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), F.asc_nulls_last("id"), "place")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


# ------------------------------------------------------------ the operator
def mine_hard_negatives(df: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label",
                        vector_col: str = "embedding", n_positives: int = 5, n_negatives: int = 10,
                        low_percent: int = 30, high_percent: int = 90, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score:
    per anchor and positive the first ``n_negatives`` rows of other labels with
    low_percent * positive <= 100 * negative <= high_percent * positive. Ids and
    labels are whole numbers."""
    rows = prepare(df, is_anchor, id_col, label_col, vector_col, scale)
    n = rows.count()  # of a written table: its footers
    n_blocks = max(1, -(-n // min(max(n // 64, LEAST_BLOCK), GREATEST_BLOCK)))
    blocks = materialize(
        rows.select("dim", F.pmod(F.xxhash64("place"), F.lit(n_blocks)).alias("block"), "place", "id", "label", "vector")
        .groupBy("dim", "block").applyInArrow(_pack, _BLOCK), "vector-blocks")
    placed = global_row_number(rows.where("is_anchor"), ["label", "id", "place"], out="nth", partition_cols=["dim"])
    trees = materialize(
        placed.select("dim", F.floor((F.col("nth") - 1) / ANCHOR_BLOCK).cast("long").alias("anchors"),
                      F.col("nth").alias("at"), "place", "id", "label", "vector")
        .groupBy("dim", "anchors").applyInArrow(_plant, _TREE), "anchor-trees")

    def pairs(anchors: DataFrame) -> DataFrame:
        everywhere = anchors.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))
        return blocks.join(everywhere, ["dim", "block"])

    positives = materialize(_first(_search(pairs(trees), n_positives, True), n_positives, "anchor_place"), "positives")
    # low * score / 100 rounded up, high * score / 100 down, in whole numbers
    score, rest = F.col("score"), F.expr("pmod(score, 100)")
    hundreds = F.expr("(score - pmod(score, 100)) div 100")
    window = F.struct("at", F.col("rank").alias("positive"), "id", "score",
                      (hundreds * low_percent + F.ceil(rest * low_percent / 100)).alias("low"),
                      (hundreds * high_percent + F.floor(rest * high_percent / 100)).alias("high"))
    windows = positives.where(score.isNotNull()).groupBy("dim", "anchors").agg(F.collect_list(window).alias("windows"))
    found = _search(pairs(trees.join(materialize(windows, "windows"), ["dim", "anchors"])), n_negatives, False)
    return _first(found, n_negatives, "anchor_place", "positive").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
