"""Exact nearest neighbours by a stored pivot index and triangle bounds.

The index deals the vectors into cells around pivots (a bounded sample, chosen
by a hash) and stores each vector's distance to its pivot; a cell is stored as
packed blocks of bounded size, and of each cell the least and the greatest
distance. A search makes two passes over packed batches of queries that lie
near the same pivot:

1. every batch sees the cells nearest to it that hold k rows at least, which
   gives each query an upper bound on its k-th distance;
2. for a cell around p and a query q, no row is nearer than |d(q, p) - d(p, x)|
   allows, so a batch is sent on only to cells where one of its queries may
   find a row within its bound; inside a block the same test leaves a range of
   rows, which are sorted by their distance to the pivot.

Batches of queries, the smaller side, are repeated per block that they see; the
blocks are shuffled once, whole, and never repeated. Nothing that grows with
the data is collected: pivots and the cells' radii are bounded by ``pivots``.
How much is skipped depends on the vectors: clustered ones save most, random
directions in many dimensions lie about equally far apart and save nothing.

``l2`` is the squared Euclidean distance, ``cosine`` 1 - cosine similarity. The
latter is half the squared distance of the unit vectors, which are what the
bounds are about; vectors of zeros, at distance 1 from all, have a cell of
their own.

Defined cases: a NULL vector, or one with a NULL or NaN entry, is never a
neighbour and as a query gets no row; vectors of different lengths raise; ties
are broken by id; with fewer than k rows all are returned; an empty index or
set of queries gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, scratch_path
from .knn import METRICS, _best, _distances, usable
from .rownum import global_row_number

ZEROS = -1
SLACK = 1e-9


def _unit(x: np.ndarray, metric: str) -> np.ndarray:
    if metric == "l2":
        return x
    n = np.sqrt(np.einsum("ij,ij->i", x, x))
    return x / np.where(n > 0, n, 1.0)[:, None]


def _to_pivots(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances to all pivots; far from the rounding of the expanded square."""
    out = np.empty((len(x), len(pivots)))
    for j, p in enumerate(pivots):
        d = x - p
        out[:, j] = np.sqrt(np.einsum("ij,ij->i", d, d))
    return out


def _matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    if len(sizes) and np.any(sizes != dims):
        raise ValueError(f"every vector must have {dims} entries")
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), dims)


@dataclass
class PivotIndex:
    """``blocks``: cell, block, ids, vectors (packed doubles) and pivot
    distances, a row per block. ``cells``: cell, n, low, high and blocks of every
    cell, at most one per pivot and one for zeros."""
    blocks: DataFrame
    cells: list
    pivots: np.ndarray
    metric: str
    id_type: T.DataType

    @property
    def dims(self) -> int:
        return self.pivots.shape[1]


def build_index(corpus: DataFrame, metric: str = "l2", id_col: str = "vec_id", vec_col: str = "embedding",
                pivots: int = 256, block_rows: int = 4_096, path: str | None = None) -> PivotIndex:
    """Assign, pack and write the index. There is a pivot per ``block_rows``
    rows, ``pivots`` at most; a cell larger than a block is cut by hash, so a
    vector that a third of the rows share fills blocks like any other."""
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    spark = corpus.sparkSession
    rows = materialize(corpus.where(usable(vec_col)).select(
        F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v")), "index-vectors")
    n_pivots = max(1, min(pivots, -(-rows.count() // block_rows)))
    # a bounded sample by hash, equal vectors once
    sample = rows.select("v").orderBy(F.xxhash64("v"), "v").limit(4 * n_pivots).collect()
    distinct = list(dict.fromkeys(tuple(r.v) for r in sample))[:n_pivots]
    id_type = rows.schema["id"].dataType
    if not distinct:
        return PivotIndex(rows, [], np.zeros((0, 0)), metric, id_type)
    if len({len(v) for v in distinct}) > 1:
        raise ValueError("vectors of different lengths")
    points = _unit(np.array(distinct, np.float64).reshape(len(distinct), -1), metric)
    dims = points.shape[1]
    placed = T.StructType([T.StructField("id", id_type), T.StructField("v", T.ArrayType(T.DoubleType())),
                           T.StructField("cell", T.IntegerType()), T.StructField("d", T.DoubleType())])

    def assign(batches):
        for batch in batches:
            x = _matrix(batch.column(1), dims)
            d = _to_pivots(_unit(x, metric), points)
            cell = d.argmin(1).astype(np.int32)
            near = d[np.arange(len(x)), cell]
            if metric == "cosine":
                cell = np.where((x != 0).any(1), cell, np.int32(ZEROS)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell), pa.array(near)],
                                             names=placed.names)
    celled = materialize(rows.mapInArrow(assign, placed), "index-cells")
    cells = celled.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("low"),
                                       F.max("d").alias("high")).collect()  # pivots at most
    cells = [{**r.asDict(), "blocks": -(-r.n // block_rows)} for r in cells]
    n_blocks = F.create_map(*[x for c in cells for x in (F.lit(c["cell"]), F.lit(c["blocks"]))])
    packed = T.StructType([
        T.StructField("cell", T.IntegerType()), T.StructField("block", T.IntegerType()),
        T.StructField("ids", T.ArrayType(id_type)), T.StructField("vectors", T.BinaryType()),
        T.StructField("d", T.ArrayType(T.DoubleType()))])

    def pack(t: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema
        schema = to_arrow_schema(packed)
        t = t.sort_by("d").combine_chunks()
        x = _matrix(t.column("v").chunk(0), dims)
        return pa.Table.from_arrays([
            pa.array([t.column("cell")[0].as_py()], pa.int32()), pa.array([t.column("block")[0].as_py()], pa.int32()),
            pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), t.column("id").chunk(0)).cast(schema.field(2).type),
            pa.array([x.tobytes()], pa.binary()), pa.array([t.column("d").to_pylist()], pa.list_(pa.float64()))],
            schema=schema)
    path = path or scratch_path(spark, "pivot-index")
    celled.withColumn("block", F.pmod(F.xxhash64("id"), F.element_at(n_blocks, F.col("cell"))).cast("int")) \
        .groupBy("cell", "block").applyInArrow(pack, packed).write.mode("error").parquet(path)
    return PivotIndex(spark.read.parquet(path), cells, points, metric, id_type)


# ------------------------------------------------------------ queries
_BATCH = T.StructType([
    T.StructField("batch", T.LongType()), T.StructField("at", T.ArrayType(T.LongType())),
    T.StructField("queries", T.BinaryType()), T.StructField("bounds", T.ArrayType(T.DoubleType())),
    T.StructField("home", T.ArrayType(T.IntegerType()))])


def _batches(index: PivotIndex, queries: DataFrame, k: int, rows: int) -> DataFrame:
    """Queries packed in batches of neighbours, with the cells that each batch
    sees first: per query the nearest cells that hold k rows together."""
    dims, points, metric = index.dims, index.pivots, index.metric
    near = T.StructType([T.StructField("n", T.LongType()), T.StructField("v", T.ArrayType(T.DoubleType())),
                         T.StructField("cell", T.IntegerType())])

    def assign(batches):
        for batch in batches:
            d = _to_pivots(_unit(_matrix(batch.column(1), dims), metric), points)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(d.argmin(1).astype(np.int32))],
                                             names=near.names)
    celled = queries.select("n", "v").mapInArrow(assign, near)
    dealt = global_row_number(celled, ["cell", "n"], out="nth").withColumn(
        "batch", F.floor((F.col("nth") - 1) / rows).cast("long"))
    sizes = {c["cell"]: c["n"] for c in index.cells}
    high = {c["cell"]: c["high"] for c in index.cells}

    def pack(t: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema
        t = t.sort_by("n").combine_chunks()
        x = _matrix(t.column("v").chunk(0), dims)
        d = _to_pivots(_unit(x, metric), points)
        home = set()
        ranked = sorted(sizes)
        for i in range(len(x)):
            seen = 0
            # a row of the cell is as far as this at most
            for cell in sorted(ranked, key=lambda c: d[i, c] + high[c] if c >= 0 else 2.0):
                home.add(cell)
                seen += sizes[cell]
                if seen >= k:
                    break
        return pa.Table.from_arrays([
            pa.array([t.column("batch")[0].as_py()], pa.int64()), pa.array([t.column("n").to_pylist()], pa.list_(pa.int64())),
            pa.array([x.tobytes()], pa.binary()), pa.array([[float("inf")] * len(x)], pa.list_(pa.float64())),
            pa.array([sorted(home)], pa.list_(pa.int32()))], schema=to_arrow_schema(_BATCH))
    return materialize(dealt.groupBy("batch").applyInArrow(pack, _BATCH), "query-batches")


def _cells_within(index: PivotIndex, batches: DataFrame) -> DataFrame:
    """(batch columns, cell): the cells beyond home in which a query of the
    batch may find a row within its bound."""
    dims, points, metric, cells = index.dims, index.pivots, index.metric, index.cells
    out = T.StructType([*_BATCH, T.StructField("cell", T.IntegerType())])

    def run(source):
        for part in source:
            for j in range(part.num_rows):
                row = part.slice(j, 1)
                x = np.frombuffer(row.column(2)[0].as_buffer()).reshape(-1, dims)
                reach = _reach(np.asarray(row.column(3)[0].values), metric)
                home = set(row.column(4)[0].as_py())
                d = _to_pivots(_unit(x, metric), points)
                wanted = [c["cell"] for c in cells if c["cell"] not in home and np.any(_nearest(d, c, metric) <= reach)]
                if wanted:
                    take = row.take(pa.array([0] * len(wanted)))
                    yield pa.RecordBatch.from_arrays([*take.columns, pa.array(wanted, pa.int32())], names=out.names)
    return batches.mapInArrow(run, out)


def _reach(bounds: np.ndarray, metric: str) -> np.ndarray:
    """Distances as the triangle inequality has them, a little longer."""
    return np.sqrt(np.maximum(bounds, 0.0) * (2.0 if metric == "cosine" else 1.0)) * (1 + SLACK) + SLACK


def _nearest(d: np.ndarray, cell: dict, metric: str) -> np.ndarray:
    """Least distance that a row of a cell may have from each query."""
    if cell["cell"] == ZEROS:
        return np.full(len(d), np.sqrt(2.0))
    to = d[:, cell["cell"]]
    return np.maximum(0.0, np.maximum(to - cell["high"], cell["low"] - to)) * (1 - SLACK)


def _search(index: PivotIndex, pairs: DataFrame, k: int) -> DataFrame:
    """The k best rows per query from each pair of a batch and a block."""
    dims, points, metric = index.dims, index.pivots, index.metric
    out = T.StructType([T.StructField("n", T.LongType()), T.StructField("id", index.id_type),
                        T.StructField("distance", T.DoubleType())])
    names = ["cell", "ids", "vectors", "d", "at", "queries", "bounds"]

    def run(source):
        from pyspark.sql.pandas.types import to_arrow_schema
        schema = to_arrow_schema(out)
        for part in source:
            for j in range(part.num_rows):
                cell, ids, raw, near, at, asked, bounds = (part.column(i)[j] for i in range(len(names)))
                x = np.frombuffer(raw.as_buffer()).reshape(-1, dims)
                q = np.frombuffer(asked.as_buffer()).reshape(-1, dims)
                near, reach = np.asarray(near.values), _reach(np.asarray(bounds.values), metric)
                lo, hi = 0, len(x)
                keep = np.ones(len(q), bool)
                if cell.as_py() != ZEROS:
                    to = _to_pivots(_unit(q, metric), points[[cell.as_py()]])[:, 0]
                    low, high = to - reach, to + reach
                    first, last = np.searchsorted(near, low, "left"), np.searchsorted(near, high, "right")
                    keep = first < last
                    if not keep.any():
                        continue
                    lo, hi = int(first[keep].min()), int(last[keep].max())
                ranks = np.empty(hi - lo, np.int64)
                some = ids.values.slice(lo, hi - lo)
                ranks[pc.sort_indices(some).to_numpy()] = np.arange(hi - lo)
                dist = _distances(x[lo:hi], q[keep], metric)
                at_q, at_r = _best(dist, ranks, k)
                asked_at = np.asarray(at.values)[keep]
                yield pa.RecordBatch.from_arrays([pa.array(asked_at[at_q]), some.take(pa.array(at_r)).cast(schema.field(1).type),
                                                  pa.array(dist[at_q, at_r])], schema=schema)
    return pairs.select(*names).mapInArrow(run, out)


def pairs_of(index: PivotIndex, asked: DataFrame) -> DataFrame:
    """Batches with a cell, joined to the blocks of that cell. The batch rows
    are repeated per block; a block is one row of the stored index. Both sides
    are shuffled: a broadcast would send the repeated batches through the driver."""
    n = F.create_map(*[x for c in index.cells for x in (F.lit(c["cell"]), F.lit(c["blocks"]))])
    spread = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.element_at(n, F.col("cell")) - 1)))
    return index.blocks.join(spread.hint("merge"), ["cell", "block"])


def _with_bounds(batches: DataFrame, first: DataFrame, k: int) -> DataFrame:
    """The batches with each query's k-th distance so far; without k rows yet,
    no bound."""
    bound = first.groupBy("n").agg(F.max(F.when(F.col("rank") == k, F.col("distance"))).alias("bound"))
    told = batches.select("batch", F.posexplode("at").alias("i", "n")).join(bound, "n", "left").groupBy("batch").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", F.coalesce("bound", F.lit(float("inf"))).alias("b")))),
                    lambda x: x["b"]).alias("told"))
    return batches.join(told.hint("merge"), "batch").select("batch", "at", "queries", F.col("told").alias("bounds"), "home")


def search(index: PivotIndex, queries: DataFrame, k: int = 3, id_col: str = "vec_id", qid_col: str = "qid",
           qvec_col: str = "embedding", query_rows: int = 1_000) -> DataFrame:
    """Top ``k`` rows per query: (qid, id, rank, distance)."""
    q = queries.where(usable(qvec_col)).select(
        F.col(qid_col).alias("qid"), F.col(qvec_col).cast("array<double>").alias("v"))
    q = materialize(q.withColumn("n", F.monotonically_increasing_id()), "asked")
    spark = q.sparkSession
    if not index.cells:
        empty = T.StructType([T.StructField(qid_col, q.schema["qid"].dataType), T.StructField(id_col, index.id_type),
                              T.StructField("rank", T.IntegerType()), T.StructField("distance", T.DoubleType())])
        return spark.createDataFrame([], empty)
    batches = _batches(index, q, k, query_rows)
    home = batches.withColumn("cell", F.explode("home"))
    first = materialize(_top(_search(index, pairs_of(index, home), k), k), "nearest-first")
    bounded = _with_bounds(batches, first, k)
    rest = _search(index, pairs_of(index, _cells_within(index, bounded)), k)
    best = _top(first.drop("rank").unionByName(rest), k)
    return best.join(q.select("n", "qid").hint("merge"), "n").select(
        F.col("qid").alias(qid_col), F.col("id").alias(id_col), "rank", "distance")


def _top(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("n").orderBy("distance", "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)
