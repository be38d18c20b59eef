"""Streaming emit (A5 stream form): new feature-table files -> JSON payloads.

The checkpoint replaces the cursor file: each file of the feature table is
emitted once, including rows that arrive late with an older ``window_end``
(which the cursor form never emits). A rewritten partition (upsert) is
emitted again as its new version, or only its changed rows with ``changed_only``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from signalspark.operators.emit import emit_changed, payload_struct, to_payload_json
from signalspark.schema import FEATURE_KEYS, FEATURES


def read_features_stream(spark: SparkSession, table: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New files of the feature table; files that an upsert has replaced meanwhile are passed over,
    their rows are in newer ones."""
    r = spark.readStream.schema(FEATURES).option("ignoreMissingFiles", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(table)


def start_emit(spark: SparkSession, table: str, sink_path: str, checkpoint: str,
               available_now: bool = True, processing_time: str = "2 seconds", changed_only: bool = False) -> StreamingQuery:
    """Payloads of new files; with ``changed_only`` just of rows that differ from what was emitted.

    The ledger of emitted rows lies beside the sink's payloads (``_emitted``), keyed by
    micro-batch, so it belongs to one checkpoint.
    """
    rows = read_features_stream(spark, table)
    if changed_only:
        def sink(batch: DataFrame, epoch: int) -> None:
            # of several versions of a key in one micro-batch the newest file's counts
            newest = batch.groupBy(*FEATURE_KEYS).agg(F.max_by(F.struct(*FEATURES.fieldNames()), "_written").alias("r"))
            emit_changed(batch.sparkSession, newest.select("r.*"), f"{sink_path}/_emitted", sink_path, epoch)

        written = rows.select("*", F.col("_metadata.file_modification_time").alias("_written"))
        w = written.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    else:
        payloads = to_payload_json(payload_struct(rows)).select("value")
        w = payloads.writeStream.format("text").option("path", sink_path).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()
