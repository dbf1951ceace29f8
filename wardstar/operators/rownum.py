"""Global row numbers without a single-partition window.

``row_number() OVER (ORDER BY k)`` with no PARTITION BY makes Spark move every
row into one task. Here the rows are range-partitioned on the order key into
``n`` partitions and sorted inside each; ``monotonically_increasing_id`` then
encodes (partition, position in partition). A table of counts per partition
(and group) gives each partition its starting offset; Spark broadcasts it by
its written size. One range shuffle, no driver round trip.

The count branch and the numbering branch must see the same partitions. Two
evaluations of the same range shuffle need not agree: Catalyst prunes columns
per branch and AQE may plan the input join differently, so the sampled range
bounds, and with them the partitions, can differ. The ranged frame is
therefore written once as a Parquet table in the shared
``spark.checkpoint.dir`` (which also survives a lost executor), with the
partition id and the position stored as columns, and both branches read
that table.

Without an explicit partition count the range shuffle starts from
``spark.sql.shuffle.partitions`` and AQE coalesces it to its advisory
partition size from runtime statistics. That is safe here: coalescing merges
only adjacent ranges, and the partition id and position are taken after the
shuffle, as the rows are stored.

The order key should be a total order (add tie-breakers otherwise): rows
that tie may swap numbers between runs, though the numbers stay a permutation
of 1..N.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_LOW_BITS = (1 << 33) - 1


def _cols(cols) -> list:
    if isinstance(cols, (str, Column)):
        return [cols]
    return list(cols)


def _by_range(df: DataFrame, num_partitions: int | None, key: list) -> DataFrame:
    """Range shuffle on ``key``: a fixed partition count if given, else sized by AQE."""
    if num_partitions:
        return df.repartitionByRange(num_partitions, *key)
    return df.repartitionByRange(*key)


def global_row_number(df: DataFrame, order_cols: Sequence | str, out: str = "row_num",
                      partition_cols: Sequence | str = (), total_col: str | None = None,
                      num_partitions: int | None = None,
                      store: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Add ``out`` = 1-based row number in ``order_cols`` order.

    With ``partition_cols`` the numbering restarts per group (rows with a NULL
    group are one group): the offset table holds at most (partitions + groups)
    rows. ``total_col`` adds the row count of the
    whole frame (or of the group) to every row, from the same offset table.
    ``store`` writes the ranged rows, in their order, and returns them as read
    back; by default they go to a scratch table.
    """
    order = _cols(order_cols)
    groups = _cols(partition_cols)
    key = groups + order
    ranged = (_by_range(df, num_partitions, key)
              .sortWithinPartitions(*key)
              .withColumn("_ws_mid", F.monotonically_increasing_id()))
    ranged = ranged.withColumns({
        "_ws_pid": F.shiftrightunsigned("_ws_mid", 33),
        "_ws_pos": F.col("_ws_mid").bitwiseAND(F.lit(_LOW_BITS)),
    }).drop("_ws_mid")
    ranged = store(ranged) if store else materialize(ranged, "rownum")
    gnames = [g if isinstance(g, str) else None for g in groups]
    if any(g is None for g in gnames):
        raise ValueError("partition_cols must be column names")

    # a partition may hold the end of one group and the start of the next:
    # positions restart at the group's first position inside the partition
    counts = ranged.groupBy("_ws_pid", *gnames).agg(F.count(F.lit(1)).alias("_ws_cnt"),
                                                   F.min("_ws_pos").alias("_ws_first"))
    # one row per partition and group: a window over it is cheap
    before = Window.partitionBy(*gnames).orderBy("_ws_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_ws_off", F.coalesce(F.sum("_ws_cnt").over(before), F.lit(0)))
    if total_col:
        offsets = offsets.withColumn(total_col, F.sum("_ws_cnt").over(Window.partitionBy(*gnames)))
    # written, so that the join below is chosen by the table's real size
    offsets = materialize(offsets.drop("_ws_cnt").withColumnsRenamed(
        {"_ws_pid": "_ws_opid", **{g: f"_ws_g{i}" for i, g in enumerate(gnames)}}), "offsets")

    # a NULL group is a group: NULL keys match
    same = F.col("_ws_pid") == F.col("_ws_opid")
    for i, g in enumerate(gnames):
        same = same & F.col(g).eqNullSafe(F.col(f"_ws_g{i}"))
    joined = ranged.join(offsets, same, "inner")
    return (joined.withColumn(out, F.col("_ws_off") + F.col("_ws_pos") - F.col("_ws_first")
                              + F.lit(1))
            .drop("_ws_pid", "_ws_opid", "_ws_pos", "_ws_off", "_ws_first",
                  *[f"_ws_g{i}" for i in range(len(gnames))]))


def prefix_sums(df: DataFrame, order_cols: Sequence | str, sum_cols: Sequence[str],
                suffix: str = "_cum", num_partitions: int | None = None,
                total_suffix: str | None = None) -> DataFrame:
    """Running totals of ``sum_cols`` in ``order_cols`` order (inclusive).

    Same offset scheme as ``global_row_number``: range partitions, a written
    table of totals (one row per partition), and a running sum inside each
    partition. ``total_suffix`` adds the overall totals from that table.
    """
    order = _cols(order_cols)
    ranged = _by_range(df, num_partitions, order).withColumn("_ws_pid", F.spark_partition_id())
    ranged = materialize(ranged, "prefix")
    totals = ranged.groupBy("_ws_pid").agg(*[F.sum(c).alias(f"_ws_t_{c}") for c in sum_cols])
    before = Window.orderBy("_ws_pid").rowsBetween(Window.unboundedPreceding, -1)
    extra = [F.sum(f"_ws_t_{c}").over(Window.partitionBy()).alias(f"{c}{total_suffix}")
             for c in sum_cols] if total_suffix else []
    offsets = materialize(totals.select("_ws_pid", *[
        F.coalesce(F.sum(f"_ws_t_{c}").over(before), F.lit(0)).alias(f"_ws_o_{c}")
        for c in sum_cols], *extra), "offsets")
    upto = Window.partitionBy("_ws_pid").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = ranged.withColumns({f"_ws_l_{c}": F.sum(c).over(upto) for c in sum_cols})
    out = local.join(offsets, "_ws_pid")
    out = out.withColumns({f"{c}{suffix}": F.col(f"_ws_o_{c}") + F.col(f"_ws_l_{c}")
                           for c in sum_cols})
    return out.drop("_ws_pid", *[f"_ws_l_{c}" for c in sum_cols],
                    *[f"_ws_o_{c}" for c in sum_cols])
