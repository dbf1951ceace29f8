"""Document sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """A folder of text files -> (file_name, text), one row per whole file."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("text"))
