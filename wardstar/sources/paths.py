"""Folders of any file system that Spark reads."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def exists(spark: SparkSession, path: str) -> bool:
    """Is there a file or folder? Any other problem raises."""
    fs, p = _fs(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if it does not exist."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole or not at all; raises if there is one."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fs, p = _fs(spark, path)
    temp = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}.tmp")
    stream = fs.create(temp, False)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        # unlike FileSystem.rename, this one refuses to replace a file
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), conf).rename(temp, p, options)
    except Exception as e:
        fs.delete(temp, False)
        raise FileExistsError(f"{path} is there already, or cannot be written") from e
