"""Exact k-nearest-neighbour search of a query set over a corpus.

A block nested loop in the plan: the corpus is dealt into blocks of about
``corpus_rows`` rows and the queries into blocks of about ``query_rows``; a
cell of the grid is one corpus block with one query block, so both sides of a
cell are bounded whatever the sizes of the tables. The block counts come from
the row counts; nothing is collected to the driver. In a cell, distances are
one numpy matrix and the best k rows of each query leave it, never all pairs;
a window over those candidates (corpus blocks x k per query) picks the global
top k. Ties are broken by corpus id.

A NULL vector, or one with a NULL or NaN entry, has no distance: such corpus rows
are never neighbours, such queries get no row. Vectors of different lengths raise. Payload columns stay
in Arrow from end to end, so no type is converted.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

METRICS = ("l2", "cosine")


def usable(vec_col: str) -> Column:
    """Whether a vector has a distance: it and its entries are neither NULL nor NaN."""
    v = F.col(vec_col)
    return v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")))


def _matrix(vectors, dims: int | None = None) -> np.ndarray:
    """(rows, dims) float64 from an Arrow list column without NULLs."""
    import pyarrow as pa
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    offsets = vectors.offsets.to_numpy()
    sizes = np.diff(offsets)
    dims = int(sizes[0]) if dims is None and len(sizes) else dims
    if len(sizes) and np.any(sizes != dims):
        raise ValueError(f"every vector must have {dims} entries")
    flat = vectors.values.slice(offsets[0], offsets[-1] - offsets[0])
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), dims or 0)


def _distances(x: np.ndarray, q: np.ndarray, metric: str) -> np.ndarray:
    """(queries, rows) distances, float64."""
    if metric == "l2":
        out = np.empty((q.shape[0], x.shape[0]))
        for j in range(q.shape[0]):
            d = x - q[j]
            out[j] = np.einsum("ij,ij->i", d, d)
        return out
    nx = np.sqrt(np.einsum("ij,ij->i", x, x))
    nq = np.sqrt(np.einsum("ij,ij->i", q, q))
    den = nq[:, None] * nx[None, :]
    with np.errstate(divide="ignore", invalid="ignore"):
        sim = np.where(den > 0, (q @ x.T) / den, 0.0)
    return 1.0 - sim


def _best(dist: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) positions of the k best rows of each query, ties by id."""
    if dist.shape[1] > k:
        # everything up to the k-th distance of its query, then the ties are cut
        q, r = np.nonzero(dist <= np.partition(dist, k - 1, axis=1)[:, k - 1:k])
    else:
        q, r = np.indices(dist.shape).reshape(2, -1)
    order = np.lexsort((ids[r], dist[q, r], q))
    q, r = q[order], r[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    return q[place < k], r[place < k]


def _blocks(df: DataFrame, rows: int) -> int:
    return max(1, -(-df.count() // rows))


def knn(corpus: DataFrame, queries: DataFrame, k: int = 3, metric: str = "l2",
        id_col: str = "vec_id", vec_col: str = "embedding", qid_col: str = "qid",
        qvec_col: str = "embedding", payload_cols: Sequence[str] = (),
        corpus_rows: int = 20_000, query_rows: int = 1_000) -> DataFrame:
    """Top ``k`` corpus rows per query: (qid, id, rank, distance, payload...).

    ``l2`` is the squared Euclidean distance; ``cosine`` is 1 - cosine
    similarity (0 similarity when either vector is all zeros).
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    q = materialize(queries.where(usable(qvec_col)).select(
        F.col(qid_col).alias("qid"), F.col(qvec_col).alias("qv")), "knn-queries")
    c = corpus.where(usable(vec_col)).select(
        F.col(id_col).alias("_id"), F.col(vec_col).alias("_v"), *payload_cols)
    n_c, n_q = _blocks(c, corpus_rows), _blocks(q, query_rows)
    # random by value, so that the blocks are even whatever the ids are
    c = c.withColumn("_c", F.pmod(F.xxhash64("_id"), F.lit(n_c)).cast("int")) \
        .withColumn("_q", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))))
    q = q.withColumn("_q", F.pmod(F.xxhash64("qid"), F.lit(n_q)).cast("int")) \
        .withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(n_c - 1))))
    out = T.StructType([T.StructField("qid", q.schema["qid"].dataType),
                        T.StructField("_id", c.schema["_id"].dataType),
                        T.StructField("distance", T.DoubleType())]
                       + [corpus.schema[p] for p in payload_cols])
    payload = list(payload_cols)

    def cell(queries_of, rows_of):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema
        schema = to_arrow_schema(out)
        if not queries_of.num_rows or not rows_of.num_rows:
            return schema.empty_table()
        qm = _matrix(queries_of.column("qv"))
        x = _matrix(rows_of.column("_v"), qm.shape[1])
        dist = _distances(x, qm, metric)
        # ids of any orderable type as their ranks
        ranks = np.empty(len(x), np.int64)
        import pyarrow.compute as pc
        ranks[pc.sort_indices(rows_of.column("_id")).to_numpy()] = np.arange(len(x))
        at_q, at_r = _best(dist, ranks, k)
        best = rows_of.take(pa.array(at_r))
        cols = [queries_of.column("qid").take(pa.array(at_q)), best.column("_id"),
                pa.array(dist[at_q, at_r]), *[best.column(p) for p in payload]]
        return pa.table(cols, names=schema.names).cast(schema)

    found = q.groupBy("_c", "_q").cogroup(c.groupBy("_c", "_q")).applyInArrow(cell, out)
    rank = F.row_number().over(Window.partitionBy("qid").orderBy("distance", "_id"))
    top = found.withColumn("rank", rank).filter(F.col("rank") <= k)
    return top.select(F.col("qid").alias(qid_col), F.col("_id").alias(id_col), "rank",
                      "distance", *payload)


def centroids(df: DataFrame, group_col: str, vec_col: str = "embedding",
              out: str = "embedding") -> DataFrame:
    """Element-wise mean vector per group, in double: one vector aggregate with
    partial sums, no row per entry. NULL vectors are left out."""
    v = df.where(F.col(vec_col).isNotNull()).select(
        group_col, array_to_vector(F.col(vec_col).cast("array<double>")).alias("_v"))
    return v.groupBy(group_col).agg(Summarizer.mean(F.col("_v")).alias("_m")) \
        .select(group_col, vector_to_array("_m").alias(out))
