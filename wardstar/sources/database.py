"""Database scan: a table read in parallel ranges of a numeric column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc_table(spark: SparkSession, url: str, table: str, properties: dict | None = None,
                    partition_column: str | None = None, num_partitions: int = 8,
                    lower: int | None = None, upper: int | None = None,
                    fetchsize: int = 10000) -> DataFrame:
    """Read ``table`` over ``num_partitions`` connections.

    Each task reads one stride of ``partition_column`` (a numeric, ideally
    indexed column), so no single connection or task holds the whole table.
    Missing bounds are asked of the database with one ``min``/``max``
    aggregate (one row comes back). Without a partition column the read is a
    single query.
    """
    props = dict(properties or {})
    props.setdefault("fetchsize", str(fetchsize))
    if not partition_column:
        return spark.read.jdbc(url, table, properties=props)
    if lower is None or upper is None:
        bounds = spark.read.jdbc(
            url, f"(SELECT MIN({partition_column}) AS lo, MAX({partition_column}) AS hi "
                 f"FROM {table}) b", properties=props).first()
        if bounds is None or bounds[0] is None:
            return spark.read.jdbc(url, table, properties=props)
        lower = int(bounds[0]) if lower is None else lower
        upper = int(bounds[1]) if upper is None else upper
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower,
                           upperBound=upper + 1, numPartitions=max(1, num_partitions),
                           properties=props)
