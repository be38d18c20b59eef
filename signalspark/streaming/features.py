"""Streaming forms of the windowed feature operators.

The same operator functions run on streaming frames: ``velocity_counts`` and
``session_aggregates`` add the 10-minute watermark when their input is a stream
and emit closed windows in append mode. Open windows are held in state until
the watermark passes them (late signals beyond it are dropped from the stream
view and stay in the landed table for backfill).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from signalspark.operators.features import DISTINCT_FIELDS, SESSION_KEYS, TYPING, WATERMARK, velocity_counts
from signalspark.operators.sessions import SESSION_GAP, session_aggregates
from signalspark.schema import LANDED
from signalspark.sources.landing import LANDED_FILES


def read_landed_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New landed files as a stream (explicit schema, partition columns from the layout)."""
    r = spark.readStream.schema(LANDED_FILES)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path).select(*LANDED.fieldNames())


def start_append(df: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet",
                 available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    w = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start(sink_path)


def start_velocity(events: DataFrame, window: str, sink_path: str, checkpoint: str, **kw) -> StreamingQuery:
    """Closed tumbling-window counts appended to a Parquet sink (exactly-once file sink)."""
    return start_append(velocity_counts(events, window), sink_path, checkpoint, **kw)


def start_sessions(events: DataFrame, sink_path: str, checkpoint: str, **kw) -> StreamingQuery:
    """Closed gap sessions appended to a Parquet sink."""
    return start_append(session_aggregates(events), sink_path, checkpoint, **kw)


def session_features(events: DataFrame) -> DataFrame:
    """F4-F6 per gap session: distinct devices, typing cadence and mouse entropy of each closed session.

    A session's state holds its distinct values and moments, not its signals; it is dropped
    when the watermark passes the session's end. Elements are exploded first: all of a signal's
    rows carry its time, so the sessions are those of the signals. Also works in batch.
    """
    rows = events.withWatermark("ts", WATERMARK) if events.isStreaming else events
    rows = rows.select(*SESSION_KEYS, "ts", *[F.col(f"device.{f}").alias(c) for c, f in DISTINCT_FIELDS.items()],
                       F.explode_outer("behavioral").alias("b"))
    typed = F.when(F.col("b.kind") == "type", F.col("b.typing_cps"))
    found = rows.groupBy(*SESSION_KEYS, F.session_window("ts", SESSION_GAP).alias("w")).agg(
        F.min("ts").alias("session_start"), F.max("ts").alias("session_end"),
        *[F.size(F.collect_set(c)).cast("long").alias(c) for c in DISTINCT_FIELDS],
        *[how(typed).alias(name) for name, how in TYPING.items()],
        F.avg("b.mouse_entropy").alias("mouse_entropy_avg"))
    return found.drop("w")


def start_session_features(events: DataFrame, sink_path: str, checkpoint: str, **kw) -> StreamingQuery:
    """Features of closed gap sessions appended to a Parquet sink."""
    return start_append(session_features(events), sink_path, checkpoint, **kw)


def run_to_end(query: StreamingQuery, timeout_s: float) -> None:
    """Wait for an ``availableNow`` query to drain its source; fail loudly if it does not."""
    if not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"streaming query {query.name or query.id} did not finish in {timeout_s} s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
