"""Vital-sign stream: JSON messages -> typed rows -> all-rows and alert sinks.

``parse_vitals`` is a plain DataFrame transformation, so the same code runs on
a batch of messages and on a stream. The stream is stateless (map + filter):
no watermark or state store is needed, and each micro-batch scales with the
number of source partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.vitals import alert_flag, alert_reason

# The message and alert layouts.
VITALS_SCHEMA = T.StructType([
    T.StructField("encounter_id", T.LongType()),
    T.StructField("patient_nbr", T.LongType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("heart_rate", T.IntegerType()),
    T.StructField("blood_pressure_sys", T.IntegerType()),
    T.StructField("spo2", T.IntegerType()),
])
ALERT_COLS = ["event_time", "encounter_id", "patient_nbr", "heart_rate", "spo2", "alert_reason"]
_CORRUPT = "_corrupt_record"


def read_vitals_stream(spark: SparkSession, source: str = "kafka", options: dict | None = None,
                       path: str | None = None) -> DataFrame:
    """Raw messages as a stream with one string column ``value``.

    ``kafka``: the caller passes ``kafka.bootstrap.servers`` and ``subscribe``;
    reading starts at the earliest offsets unless told otherwise. ``text``: a
    folder of JSON-lines files (one message per line).
    """
    opts = dict(options or {})
    if source == "kafka":
        opts.setdefault("startingOffsets", "earliest")
        raw = spark.readStream.format("kafka").options(**opts).load()
        return raw.select(F.col("value").cast("string").alias("value"))
    reader = spark.readStream.options(**opts)
    return reader.text(path).select("value")


def parse_vitals(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Parse JSON with the fixed schema; add event_time, alert_flag, alert_reason.

    Extra fields are ignored. A message that is not JSON or does not fit the
    schema keeps its row with NULL fields and ``is_malformed`` = true. Bad
    timestamp text gives a NULL ``event_time`` rather than failing the query.
    """
    schema = T.StructType(VITALS_SCHEMA.fields + [T.StructField(_CORRUPT, T.StringType())])
    parsed = raw.select(F.from_json(F.col(value_col), schema,
                                    {"columnNameOfCorruptRecord": _CORRUPT}).alias("d"))
    flat = parsed.select(*[F.col(f"d.{f.name}").alias(f.name) for f in VITALS_SCHEMA.fields],
                         F.col(f"d.{_CORRUPT}").isNotNull().alias("is_malformed"))
    return flat.withColumns({
        "event_time": event_time("timestamp"),
        "alert_flag": alert_flag("heart_rate", "spo2"),
        "alert_reason": alert_reason("heart_rate", "spo2"),
    })


def event_time(text: str) -> Column:
    """Time text as UTC wall-clock time. Text with an offset (``+07:00``, ``Z``)
    is an instant and is moved to UTC; text without one is taken as UTC."""
    c = F.col(text)
    instant = F.convert_timezone(F.current_timezone(), F.lit("UTC"),
                                 c.try_cast("timestamp").cast("timestamp_ntz"))
    has_offset = c.rlike(r"[0-9](Z|[+-][0-9]{1,2}(:?[0-9]{2})?|\s*(UTC|GMT)([+-]\S+)?)\s*$") & \
        c.rlike(r"[T ][0-9]{1,2}:")
    return F.when(has_offset, instant).otherwise(c.try_cast("timestamp_ntz"))


def alerts(parsed: DataFrame) -> DataFrame:
    """Alert rows only; a NULL flag (missing reading, no other breach) is dropped."""
    return parsed.filter(F.col("alert_flag")).select(*ALERT_COLS)


def write_vitals(parsed: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                 query_name: str | None = None) -> StreamingQuery:
    """All rows to Parquet, append mode, exactly once through the checkpoint."""
    w = (parsed.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(**(trigger or {"processingTime": "5 seconds"})))
    if query_name:
        w = w.queryName(query_name)
    return w.start()


def write_alerts(parsed: DataFrame, checkpoint: str, path: str | None = None,
                 sink: str = "parquet", trigger: dict | None = None) -> StreamingQuery:
    """Alert rows to Parquet (default) or the console, with their own checkpoint,
    so a restart does not repeat alerts already written."""
    w = (alerts(parsed).writeStream.outputMode("append")
         .option("checkpointLocation", checkpoint)
         .trigger(**(trigger or {"processingTime": "5 seconds"})))
    if sink == "console":
        w = w.format("console").option("truncate", "false")
    else:
        w = w.format(sink).option("path", path)
    return w.start()


def run_vitals(spark: SparkSession, raw_stream: DataFrame, out_path: str, alerts_path: str,
               checkpoint_root: str, trigger: dict | None = None,
               wait: bool = False) -> list[StreamingQuery]:
    """Start both sinks off one parsed stream. With ``wait`` (e.g. an
    ``availableNow`` trigger) block until both finish."""
    parsed = parse_vitals(raw_stream)
    qs = [write_vitals(parsed, out_path, f"{checkpoint_root}/all", trigger),
          write_alerts(parsed, f"{checkpoint_root}/alerts", alerts_path, trigger=trigger)]
    if wait:
        for q in qs:
            q.awaitTermination()
            if q.exception() is not None:
                raise RuntimeError(str(q.exception()))
    return qs


def write_both_once(parsed: DataFrame, out_path: str, alerts_path: str, checkpoint: str,
                    trigger: dict | None = None) -> StreamingQuery:
    """Both sinks from one query, so the source is read once per micro-batch.

    Two queries over one parsed stream each read the source for themselves
    (a topic read twice). Here ``foreachBatch`` writes every row and then the
    alert rows of the same cached micro-batch. Each batch goes to its own
    ``batch_id=N`` folder with overwrite, so a batch replayed after a failure
    replaces its earlier output instead of duplicating it.
    """
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            batch.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
            alerts(batch).write.mode("overwrite").parquet(f"{alerts_path}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return (parsed.writeStream.foreachBatch(write_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "5 seconds"})).start())


def run_vitals_single_read(spark: SparkSession, raw_stream: DataFrame, out_path: str,
                           alerts_path: str, checkpoint_root: str, trigger: dict | None = None,
                           wait: bool = False) -> StreamingQuery:
    """``run_vitals`` with one query for both sinks (see ``write_both_once``)."""
    q = write_both_once(parse_vitals(raw_stream), out_path, alerts_path,
                        f"{checkpoint_root}/both", trigger)
    if wait:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return q


def await_any(spark: SparkSession, timeout: float | None = None) -> bool:
    return spark.streams.awaitAnyTermination(timeout) if timeout else \
        spark.streams.awaitAnyTermination()
