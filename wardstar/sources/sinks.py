"""Sinks: Parquet star, JDBC publish, JSON messages, plain tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .versions import VersionedTable

# Fact partition columns.
FACT_PARTITIONS = ["admission_year", "admission_month"]


def write_star(tables: dict[str, DataFrame], out_dir: str) -> None:
    """Overwrite each table under ``out_dir``; the fact by year and month.

    The fact is clustered on its partition columns with a ``rebalance`` hint:
    each task then writes into few (year, month) folders, and AQE splits a
    month that is too large for one task into several (a plain hash
    repartition would put a whole month into one task).
    """
    for name, df in tables.items():
        if name == "fact_admission":
            w = df.hint("rebalance", *FACT_PARTITIONS)
            w.write.mode("overwrite").partitionBy(*FACT_PARTITIONS).parquet(f"{out_dir}/{name}")
        else:
            df.write.mode("overwrite").parquet(f"{out_dir}/{name}")


def publish_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
                 batchsize: int = 10000, num_partitions: int | None = None) -> None:
    """Overwrite a database table by TRUNCATE, keeping the table and its views.

    A plain overwrite drops and recreates the table, which fails (or cascades)
    when views depend on it. ``numPartitions`` caps concurrent connections.
    """
    props = dict(properties or {})
    w = df.write.mode("overwrite").option("truncate", "true").option("batchsize", batchsize)
    if num_partitions:
        w = w.option("numPartitions", num_partitions)
    w.jdbc(url=url, table=table, properties=props)


def publish_all(tables: dict[str, DataFrame], sink) -> dict[str, int]:
    """Publish each table with ``sink(name, df)``; returns rows per table.

    Curated tables are Parquet: their count is a sum over file footers, not a
    second scan. (An ``Observation`` would count during the write, but leaves
    an object in the session that later model fits cannot serialise.)
    """
    counts = {}
    for name, df in tables.items():
        sink(name, df)
        counts[name] = df.count()
    return counts


def to_json_messages(df: DataFrame, key_col: str | None = None) -> DataFrame:
    """Rows as JSON text in ``value`` (and optional ``key``), the Kafka layout."""
    cols = [F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value")]
    if key_col:
        cols.insert(0, F.col(key_col).cast("string").alias("key"))
    return df.select(*cols)


def publish_json(df: DataFrame, options: dict, fmt: str = "kafka",
                 key_col: str | None = None) -> None:
    """Send rows as JSON messages: ``format('kafka')`` with the caller's options
    (``kafka.bootstrap.servers``, ``topic``), or ``text`` with a ``path``."""
    msgs = to_json_messages(df, key_col)
    if fmt == "text":
        msgs.select("value").write.mode("append").text(options["path"])
    else:
        msgs.write.format(fmt).options(**options).save()


def replace_table(df: DataFrame, path: str) -> int:
    """Replace a table as a whole: readers see the old rows until all new ones
    are written, and go on seeing them if that fails. Returns the version."""
    return VersionedTable(df.sparkSession, path).replace(df).number


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest version of a table of ``replace_table`` or ``replace_star``."""
    return VersionedTable(spark, path).read()


def replace_star(tables: dict[str, DataFrame], out_dir: str) -> None:
    """Each table under ``out_dir`` as a new version; the fact by months, so
    that later loads can put single months. Dimensions come first: a reader that
    opens the fact first finds all of its keys."""
    for name in sorted(tables, key=lambda n: n == "fact_admission"):
        table, df = VersionedTable(next(iter(tables.values())).sparkSession, f"{out_dir.rstrip('/')}/{name}"), tables[name]
        if name != "fact_admission":
            table.replace(df)
            continue
        base = table.commit()
        table.put_parts(df, F.format_string("%04d-%02d", *FACT_PARTITIONS), drop=base.parts if base else ())


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Replace-table sink (no index column)."""
    df.write.mode(mode).parquet(path)
