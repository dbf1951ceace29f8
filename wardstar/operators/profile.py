"""Exploratory profile: missing tokens, value frequencies, shape and types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def profile_missing(df: DataFrame, token: str = "?", top: int = 15) -> DataFrame:
    """Columns holding ``token``, most first (name breaks ties), first ``top``.

    One pass: a ``count_if`` per string column in a single aggregate, then
    the one-row result is unpivoted.
    """
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, n_missing long")
    counts = df.agg(*[F.count_if(F.col(c) == token).cast("long").alias(c) for c in cols])
    long = counts.unpivot([], cols, "column_name", "n_missing")
    return (long.filter(F.col("n_missing") > 0)
            .orderBy(F.desc("n_missing"), F.asc("column_name")).limit(top))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc(col)))


def profile_schema(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type, n_rows, n_cols): shape and types."""
    fields = [F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column_name"),
                       F.lit(f.dataType.simpleString()).alias("data_type"))
              for i, f in enumerate(df.schema.fields)]
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.inline(F.array(*fields)), "n_rows", F.lit(len(df.columns)).alias("n_cols"))


def preview(df: DataFrame, key: str, n: int = 10, cols=None) -> DataFrame:
    """First ``n`` rows in ``key`` order (top-n per partition, then merged)."""
    out = df.select(*cols) if cols else df
    return out.orderBy(key).limit(n)
