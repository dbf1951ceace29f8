"""Compaction of a stream's output, beside the running stream.

A sink of ``write_both_once`` has a folder per micro-batch: with a 5 s trigger
17,000 a day. Compaction rewrites the batches that the stream has committed since
the last compaction into a few large files, as one more part of a
:class:`VersionedTable`, whose commit says through which batch it reaches. The
stream only ever writes batches that it has not committed, so the two never
write the same folder, and a batch that is replayed after a failure was not
compacted before. Readers take the compacted part and the folders of later
batches, so they see every row once, before, during and after a compaction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.paths import children, remove
from ..sources.versions import VersionedTable

_PREFIX = "batch_id="


def _compacted(spark: SparkSession, sink: str) -> VersionedTable:
    return VersionedTable(spark, f"{sink.rstrip('/')}/_compacted")


def _through(table: VersionedTable) -> int:
    at = table.commit()
    return at.facts["through"] if at else -1


def _batches(spark: SparkSession, sink: str) -> list[int]:
    return sorted(int(n[len(_PREFIX):]) for n in children(spark, sink.rstrip("/")) if n.startswith(_PREFIX))


def committed_batch(spark: SparkSession, checkpoint: str) -> int:
    """The last batch that a stream has committed; -1 if there is none."""
    names = children(spark, f"{checkpoint.rstrip('/')}/commits")
    return max((int(n) for n in names if n.isdigit()), default=-1)


def _folders(spark: SparkSession, sink: str, batches: list[int]) -> DataFrame:
    paths = [f"{sink.rstrip('/')}/{_PREFIX}{b}" for b in batches]
    return spark.read.option("basePath", sink).parquet(*paths)


def compact(spark: SparkSession, sink: str, checkpoint: str, at_least: int = 2) -> int:
    """Rewrite the committed batches that are not compacted yet, if there are
    ``at_least`` so many; returns how many were. Files are as large as AQE's
    advisory partition size."""
    table = _compacted(spark, sink)
    after, upto = _through(table), committed_batch(spark, checkpoint)
    new = [b for b in _batches(spark, sink) if after < b <= upto]
    if len(new) < at_least:
        return 0
    rows = _folders(spark, sink, new).withColumn("batch_id", F.col("batch_id").cast("long"))
    table.append(rows.hint("rebalance"), facts={"through": upto})
    return len(new)


def read_sink(spark: SparkSession, sink: str) -> DataFrame | None:
    """Every row of the sink once, with its ``batch_id``."""
    table = _compacted(spark, sink)
    done = table.read()
    later = [b for b in _batches(spark, sink) if b > _through(table)]
    if not later:
        return done
    rest = _folders(spark, sink, later).withColumn("batch_id", F.col("batch_id").cast("long"))
    return rest if done is None else done.unionByName(rest)


def remove_compacted(spark: SparkSession, sink: str) -> int:
    """Remove folders of compacted batches. Readers that listed them before the
    last compaction must be done; returns folders removed."""
    through = _through(_compacted(spark, sink))
    old = [b for b in _batches(spark, sink) if b <= through]
    for b in old:
        remove(spark, f"{sink.rstrip('/')}/{_PREFIX}{b}")
    return len(old)
