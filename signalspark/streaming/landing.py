"""Streaming landing (S2-S7): raw entries -> classified -> landed + quarantine.

Any streaming frame with the RAW columns works as the source (file source over
JSON lines here; a Kafka frame projected to the same columns drops in). Each
micro-batch is classified once, persisted, written to both sinks keyed by the
epoch id (idempotent on retry), and committed by the checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from signalspark.operators.ingest import classify, landing_columns, split_classified
from signalspark.sources.landing import land_batch, stream_batch_id, write_landed, write_quarantine


def start_landing(raw_stream: DataFrame, landed_path: str, bad_path: str, checkpoint: str,
                  strict: bool = True, start_from=None, available_now: bool = True,
                  processing_time: str | None = None, dedup: bool = False,
                  quota: tuple[float, float] | None = None, wire_compat: bool = False) -> StreamingQuery:
    """Start the landing query; ``start_from`` drops entries that arrived earlier (S3).

    With ``dedup`` or ``quota`` (requests per second, burst) every micro-batch lands through the
    replay guard and the tenants' token buckets (:mod:`signalspark.sources.guarded`). Their state is
    the table's own ledger, so it survives restarts, is shared with batch landing, and an entry
    that arrives days late is judged like any other.
    """
    src = raw_stream
    if start_from is not None:
        src = src.filter(F.col("ingest_ts") >= F.lit(start_from).cast("timestamp"))

    def guarded(batch: DataFrame, batch_id: int) -> None:
        land_batch(batch, landed_path, bad_path, stream_batch_id(checkpoint, batch_id), strict, dedup, quota, wire_compat)

    def plain(classified: DataFrame, batch_id: int) -> None:
        rows = classified.persist()
        try:
            good, bad = split_classified(rows, strict=strict)
            write_landed(good, landed_path, stream_batch_id(checkpoint, batch_id))
            write_quarantine(bad, bad_path, stream_batch_id(checkpoint, batch_id))
        finally:
            rows.unpersist()

    if dedup or quota:
        w = src.writeStream.foreachBatch(guarded)
    else:  # the rules are analysed once, with the query, not in every micro-batch
        w = landing_columns(classify(src, wire_compat), strict).writeStream.foreachBatch(plain)
    w = w.option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def start_outcome_counts(raw_stream: DataFrame, sink_path: str, checkpoint: str,
                         available_now: bool = True, processing_time: str = "2 seconds") -> StreamingQuery:
    """V16 on a stream: running entries per (tenant, outcome), before the replay guard.

    A complete-mode aggregate (state = one row per tenant and outcome); every
    micro-batch overwrites the sink with the current totals.
    """
    from signalspark.operators.ingest import outcome_counts

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(sink_path)

    w = outcome_counts(classify(raw_stream)).writeStream.outputMode("complete").foreachBatch(sink) \
        .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()
