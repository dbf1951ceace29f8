"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

# Whitespace of the word pattern [^\x20\x09-\x0D]+; bytes.split() without an
# argument splits on exactly these six bytes.
ASCII_SPACE = " \t\n\x0b\x0c\r"

# Rows handled at a time inside a task: an Arrow batch is cut so that a run of
# long texts does not multiply the working set.
SLICE_BYTES = 2 << 20
BATCH_BYTES = 8 << 20
DEFAULT_BATCH_BYTES = "67108864b"  # Spark's own, as a session prints it


def ascii_lower(col: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(col, UPPER, LOWER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def others(df: DataFrame, taken: Sequence[str]) -> list[str]:
    """Columns of ``df`` that an operator passes through: all whose name does
    not clash (ignoring case, as Spark does) with a column it makes."""
    made = {c.lower() for c in taken}
    return [c for c in df.columns if c.lower() not in made]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def slices(texts: list, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of about ``limit`` characters, at least one row each."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text) if text else 0
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_BYTES``, so that memory does not depend
    on how long the texts are. A bound that the session has set is left."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == DEFAULT_BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def add_text_columns(df: DataFrame, text_col: str, schema: T.StructType,
                     make: Callable[[], Callable[[list], list[list]]],
                     keep: Sequence[str] | None = None) -> DataFrame:
    """Append columns computed from one text column by Arrow batches.

    ``make()`` runs once per task and returns a function from a list of texts
    (None allowed) to one list of values per field of ``schema``. Columns of
    ``df`` that clash with a made one are replaced; ``keep`` narrows what is
    passed through (Catalyst cannot prune columns below a Python operator).
    """
    bound_batches(df.sparkSession)
    names = [f.name for f in schema]
    passed = [c for c in (df.columns if keep is None else keep)
              if c.lower() not in {n.lower() for n in names}]
    src = df.select(*[F.col(quoted(c)) for c in passed])
    if text_col in passed and isinstance(src.schema[text_col].dataType, T.StringType):
        at = passed.index(text_col)  # sent to the task once
    else:
        at = len(passed)
        src = df.select(*[F.col(quoted(c)) for c in passed],
                        F.col(quoted(text_col)).cast("string").alias("__text"))
    out = T.StructType([src.schema[c] for c in passed] + list(schema))
    n = len(passed)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        target = to_arrow_schema(out)
        fn = make()
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for lo, hi in slices(texts):
                cols = fn(texts[lo:hi])
                arrays = [batch.column(i).slice(lo, hi - lo) for i in range(n)]
                arrays = [a if a.type == target.field(i).type else a.cast(target.field(i).type)
                          for i, a in enumerate(arrays)]
                arrays += [v if isinstance(v, pa.Array) else pa.array(v, target.field(n + i).type)
                           for i, v in enumerate(cols)]
                yield pa.RecordBatch.from_arrays(arrays, schema=target)
    return src.mapInArrow(run, out)
