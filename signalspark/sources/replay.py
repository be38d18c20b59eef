"""Quarantined entries through the rules again; what passes now lands, once.

``replay_quarantine`` takes every batch folder of the quarantine, classifies the kept raw
text (after an optional ``fix``) and lands it as one batch: recovered rows go to the landed
table, the others to a quarantine batch of the replay's own. Then the replayed folders go.

The replay's batch id is a digest of the folders it read, so a run that is lost before the
folders go is repeated under the same id and overwrites its own output. Before the first
folder goes, their names are recorded; a run lost while they go is finished by the next one
before it reads anything. Two runs therefore leave what one leaves. One replay at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalspark.schema import STREAM_PREFIX
from signalspark.sources import files
from signalspark.sources.landing import QUARANTINE_FILES, TS_FORMAT, land_batch

PENDING = "_replayed"  # hidden from readers of the quarantine


def _finish(spark: SparkSession, bad: str) -> None:
    """Remove the folders of a replay whose rows have landed."""
    if not files.exists(spark, f"{bad}/{PENDING}/_SUCCESS"):
        files.delete(spark, f"{bad}/{PENDING}")
        return
    for r in spark.read.text(f"{bad}/{PENDING}").toLocalIterator():
        files.delete(spark, f"{bad}/{r.value}")
    files.delete(spark, f"{bad}/{PENDING}")


def replay_quarantine(spark: SparkSession, bad: str, landed: str, fix: Callable[[DataFrame], DataFrame] | None = None,
                      **rules) -> dict:
    """Replay all quarantined batches; ``fix`` may rewrite ``data`` first, ``rules`` are those of ``land_batch``.

    Returns the landing's summary. Rows that fail again keep their raw text and get their new reason.
    """
    bad = bad.rstrip("/")
    if files.exists(spark, f"{bad}/{PENDING}"):
        _finish(spark, bad)
    folders = [n for n in files.names(spark, bad) if n.startswith("batch_id=")]
    if not folders:
        return {"landed": landed, "quarantine": bad, "batch_id": None, "landed_rows": 0, "quarantined_rows": 0}
    batch_id = "replay-" + hashlib.sha256("\n".join(folders).encode()).hexdigest()[:16]
    rows = (spark.read.schema(QUARANTINE_FILES).option("timestampFormat", TS_FORMAT).option("basePath", bad)
            .json([f"{bad}/{n}" for n in folders]))
    raw = rows.select(F.concat(F.lit(STREAM_PREFIX), "tenant_id_hint").alias("stream"),
                      F.concat(F.lit("q-"), F.hex(F.xxhash64("tenant_id_hint", "raw", "ingest_ts"))).alias("entry_id"),
                      F.col("raw").alias("data"), "ingest_ts")
    out = land_batch(raw if fix is None else fix(raw), landed, bad, batch_id, **rules)
    gone = [n for n in folders if n != f"batch_id={batch_id}"]
    spark.createDataFrame([(n,) for n in gone], "value string").coalesce(1).write.mode("overwrite").text(f"{bad}/{PENDING}")
    _finish(spark, bad)
    return out
