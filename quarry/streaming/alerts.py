"""T1 as a Structured Streaming job: watermarked tumbling windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quarry.operators.monitor import latency_alerts


ALERT_SCHEMA = "window_start timestamp, window_end timestamp, n bigint, avg_value double, alert boolean"


def alert_stream(events: DataFrame, ts_col: str = "ts", value_col: str = "value", width: str = "1 minute",
                 threshold: float = 500.0, watermark: str = "10 minutes") -> DataFrame:
    """Streaming form of ``latency_alerts``.  Event time must be a TIMESTAMP
    (a ``timestamp_ntz`` column is rejected as event time), so it is cast
    first; windows are then kept in state until the watermark passes."""
    ts = F.col(ts_col).cast(T.TimestampType()) if isinstance(events.schema[ts_col].dataType,
                                                             T.TimestampNTZType) else F.col(ts_col)
    timed = events.withColumn(ts_col, ts).withWatermark(ts_col, watermark)
    return latency_alerts(timed, ts_col, value_col, width, threshold)


def start_alert_stream(spark: SparkSession, source_dir: str, schema: T.StructType, sink_dir: str,
                       checkpoint_dir: str, width: str = "1 minute", threshold: float = 500.0,
                       watermark: str = "10 minutes", max_files_per_trigger: int | None = None,
                       available_now: bool = True) -> StreamingQuery:
    """Parquet files in ``source_dir`` -> alert windows appended to parquet.

    Append mode emits a window once the watermark has passed it, so output is
    final and the sink needs no rewrite; the checkpoint makes a restart after
    a lost driver or executor resume exactly where it stopped."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    alerts = alert_stream(reader.parquet(source_dir), width=width, threshold=threshold, watermark=watermark)
    writer = (alerts.writeStream.format("parquet").option("path", sink_dir)
              .option("checkpointLocation", checkpoint_dir).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def closed_and_open_windows(spark: SparkSession, source_dir: str, schema: T.StructType, sink_dir: str,
                            ts_col: str = "ts", value_col: str = "value", width: str = "1 minute",
                            threshold: float = 500.0) -> DataFrame:
    """Every window of a finished input: those the stream has emitted, and those
    still open when it ended.

    Append mode holds back the windows that the watermark has not passed.  They
    all start at or after the end of the last emitted one, so a batch over the
    events from there on (a pushed-down filter) gives them."""
    done = spark.read.schema(ALERT_SCHEMA).parquet(sink_dir)
    end = done.select(F.max("window_end")).first()[0]
    events = spark.read.schema(schema).parquet(source_dir)
    rest = events if end is None else events.filter(F.col(ts_col) >= F.lit(end).cast(schema[ts_col].dataType))
    rest = rest.withColumn(ts_col, F.col(ts_col).cast(T.TimestampType()))
    return done.unionByName(latency_alerts(rest, ts_col, value_col, width, threshold).select(*done.columns))
