"""Stable surrogate keys and deterministic de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rownum import global_row_number


def with_surrogate_key(dim: DataFrame, natural_cols: Sequence[str] | str, key: str,
                       num_partitions: int | None = None) -> DataFrame:
    """Dense 1-based key in natural-key order.

    Same input gives the same keys on every run and every recompute, unlike
    ``monotonically_increasing_id``, whose values depend on partitioning. The
    natural key must be unique in ``dim`` for keys to be stable.
    """
    cols = [natural_cols] if isinstance(natural_cols, str) else list(natural_cols)
    return global_row_number(dim, cols, out=key, num_partitions=num_partitions)


def first_by(df: DataFrame, key: Sequence[str] | str, order: str,
             value_cols: Sequence[str]) -> DataFrame:
    """One row per ``key``: the values of the row with the smallest ``order``.

    ``min_by`` is a regular aggregate, so it combines map-side: a key holding
    a third of the rows is reduced per partition before the shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    picked = F.min_by(F.struct(*[F.col(c) for c in value_cols]), F.col(order)).alias("_ws_pick")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col(f"_ws_pick.{c}").alias(c)
                                                         for c in value_cols])
