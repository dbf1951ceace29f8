"""Session helpers: one place for the settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target

# Settings the library assumes. AQE re-plans joins and partition counts from
# runtime sizes (broadcast only when the measured side is small, split skewed
# partitions); UTC keeps date arithmetic independent of the host.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # local mode runs executors inside the driver JVM
    "spark.driver.memory": "8g",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(app: str = "wardstar", master: str | None = None,
                shuffle_partitions: int | None = None,
                conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a shared file system or
    object store). Only when it is unset, as in local tests, a private folder
    is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            # executors on other machines cannot read a folder local to the driver
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
        d = tempfile.mkdtemp(prefix="wardstar-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/wardstar-scratch/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below this application's part of the shared
    checkpoint folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def release_scratch(spark: SparkSession) -> None:
    """Remove what this application has materialised so far. Frames that read
    it cannot be evaluated again; call it when a run's results are written."""
    from .sources.paths import remove
    remove(spark, _scratch_root(spark))


def storage_memory(spark: SparkSession) -> int:
    """Bytes that the executors can use to keep rows; in local mode the driver is
    the executor."""
    sc = spark.sparkContext
    status = sc._jsc.sc().getExecutorMemoryStatus()
    sizes = status.valuesIterator()
    total = 0
    while sizes.hasNext():
        total += sizes.next()._1()
    if status.size() > 1:  # the driver keeps none of a cluster's rows
        driver = sc._jvm.org.apache.spark.SparkEnv.get().blockManager()
        total -= status.apply(driver.blockManagerId().hostPort())._1()
    return total


def run_all(spark: SparkSession, tasks: Sequence[Callable], parallelism: int = 4) -> list:
    """Run independent actions, up to ``parallelism`` at once; results in order.
    Each submits its own Spark jobs, and the scheduler fills executor slots that
    one leaves idle with tasks of another."""
    if parallelism <= 1 or len(tasks) <= 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=min(parallelism, len(tasks))) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(t)) for t in tasks]
        return [f.result() for f in futures]


def materialize(df, name: str, compression: str | None = None):
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read
    it back: a lineage cut that survives lost executors, stores columns
    compressed and lets later reads prune columns and push filters."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path, compression=compression)
    return spark.read.parquet(path)


__all__ = ["get_session", "checkpoint_dir", "scratch_path", "materialize", "release_scratch", "run_all",
           "storage_memory", "DEFAULT_CONF"]
