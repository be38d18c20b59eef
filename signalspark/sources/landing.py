"""Landed signal table and quarantine.

Layout: ``{root}/tenant_id=../dt=../batch_id=../part-*.parquet`` and
``{bad}/batch_id=../part-*.json``. Writes use dynamic partition overwrite, so
re-running a batch (a retried micro-batch, a replayed day) replaces exactly the
partitions that batch wrote: landing is idempotent per ``batch_id``.

``batch_id`` is a string that must be unique per batch across every writer of
the table: stream batches use ``{run}-{epoch}`` with ``run`` derived from the
checkpoint folder (stable across restarts of one query, different between
queries), so a new stream never overwrites an older one's batch 0.

Small files are packed by ``compact_landed`` (:mod:`signalspark.sources.compaction`); read the
table with ``read_landed``, which knows what was packed and what was replaced.
"""

from __future__ import annotations

import hashlib
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from signalspark.schema import LANDED, QUARANTINE
from signalspark.session import work_dir
from signalspark.sources import files
from signalspark.sources.compaction import TARGET_BYTES, compact, refuse_compacted, vacuum, visible

TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"  # JSON sinks keep microseconds

LANDED_FILES = StructType(LANDED.fields + [StructField("batch_id", StringType())])
#: what names a raw entry; guarded batches keep it in their landed files
ENTRY = ["stream", "entry_id", "ingest_ts"]
ENTRY_FILES = StructType(LANDED_FILES.fields + [StructField("stream", StringType()), StructField("entry_id", StringType()),
                                                StructField("ingest_ts", TimestampType())])
FLIPS = "stream string, entry_id string, ingest_ts timestamp, accepted boolean, seq bigint"
#: rows of a row group of the classified copy: a reader holds that many raw texts at most, however long a text is
COPY_ROWS = 512
QUARANTINE_FILES = StructType(QUARANTINE.fields + [StructField("batch_id", StringType())])


def stream_batch_id(checkpoint: str, epoch: int) -> str:
    """Batch id of a micro-batch: stable for one query, distinct between queries."""
    run = hashlib.sha1(checkpoint.rstrip("/").encode()).hexdigest()[:10]
    return f"{run}-{epoch:012d}"


def write_landed(good: DataFrame, path: str, batch_id: str) -> None:
    """Append good rows as Parquet partitioned by tenant_id, dt (idempotent per batch)."""
    refuse_compacted(good.sparkSession, path, str(batch_id))
    (good.withColumn("batch_id", F.lit(str(batch_id)))
         # few files per partition, but AQE splits a hot (tenant, dt) across tasks
         .hint("rebalance", "tenant_id", "dt")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("tenant_id", "dt", "batch_id").parquet(path))


def write_quarantine(bad: DataFrame, path: str, batch_id: str) -> None:
    """Quarantined rows as JSON lines with the raw text kept (idempotent per batch)."""
    (bad.withColumn("batch_id", F.lit(str(batch_id)))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("timestampFormat", TS_FORMAT)
        .partitionBy("batch_id").json(path))


def guard_path(landed: str) -> str:
    """The guard's ledger of a landed table (see :mod:`signalspark.sources.guarded`)."""
    return f"{landed.rstrip('/')}/_guard"


def duplicates_path(landed: str) -> str:
    return f"{landed.rstrip('/')}/_duplicates"


def commits(spark: SparkSession, landed: str) -> list[tuple[int, str]]:
    """Committed (sequence number, batch id) of guarded batches, oldest first."""
    split = (n.partition("-") for n in files.names(spark, f"{guard_path(landed)}/commits"))
    return [(int(seq), batch) for seq, _, batch in split]


def ledger(spark: SparkSession, landed: str, name: str, schema: str, last: int) -> DataFrame:
    """Rows of one of the ledger's tables up to sequence number ``last``."""
    path = f"{guard_path(landed)}/{name}"
    if not files.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).filter(F.col("seq") <= last)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """The landed table with its explicit schema (no type inference on partitions).

    Where late entries have changed the replay guard's earlier decisions, those are applied:
    entries refused since are left out, repeats accepted since are read from their folder.
    """
    rows = visible(spark, path, LANDED_FILES)
    if files.exists(spark, f"{guard_path(path)}/flips"):
        done = commits(spark, path)
        flips = ledger(spark, path, "flips", FLIPS, done[-1][0] if done else 0)
        now = flips.groupBy(*ENTRY).agg(F.max_by("accepted", "seq").alias("accepted"))
        rows = visible(spark, path, ENTRY_FILES).join(now.filter(~F.col("accepted")), ENTRY, "left_anti")
        again = visible(spark, duplicates_path(path), ENTRY_FILES)
        rows = rows.unionByName(again.join(now.filter(F.col("accepted")), ENTRY, "left_semi"))
    return rows.select(*LANDED.fieldNames())


def compact_landed(spark: SparkSession, landed: str, target_bytes: int = TARGET_BYTES,
                   keep: timedelta | None = None) -> list[dict]:
    """Pack the small files of the table and of the guard's repeats; with ``keep``, delete what was replaced before."""
    out = []
    for root in (landed, duplicates_path(landed)):
        out.append(compact(spark, root, target_bytes, landed))
        if keep is not None:
            out[-1]["deleted"] = vacuum(spark, root, keep)
    return out


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(QUARANTINE_FILES).option("timestampFormat", TS_FORMAT).json(path)


def land_batch(raw: DataFrame, landed_path: str, bad_path: str, batch_id: str,
               strict: bool = True, dedup: bool = False, quota: tuple[float, float] | None = None,
               wire_compat: bool = False) -> dict:
    """Classify a raw frame once, write that copy to the shared checkpoint folder, then both sinks from it.

    ``dedup`` and ``quota`` (requests per second, burst) land through the replay guard and
    the token bucket, both of which continue over all batches of the table.
    """
    if dedup or quota:
        from signalspark.sources.guarded import land_guarded
        return land_guarded(raw, landed_path, bad_path, batch_id, strict, quota, wire_compat)
    from signalspark.operators.ingest import classify, landing_columns, lands, split_classified
    spark, judged = raw.sparkSession, landing_columns(classify(raw, wire_compat), strict)
    copy = work_dir(spark, "landing-classified")
    try:
        # not persisted: a cached partition that went to disk is read back whole, raw texts and all
        judged.write.option("parquet.block.row.count.limit", COPY_ROWS).parquet(copy)
        c = spark.read.schema(judged.schema).parquet(copy)
        good, bad = split_classified(c, strict=strict)
        write_landed(good, landed_path, batch_id)
        write_quarantine(bad, bad_path, batch_id)
        # counted from the copy: an observation of a frame that turns out empty has no value
        rows, every = c.agg(F.count_if(lands(strict)[0]), F.count(F.lit(1))).first()
    finally:
        files.delete(spark, copy)
    return {"landed": landed_path, "quarantine": bad_path, "batch_id": batch_id, "landed_rows": rows,
            "quarantined_rows": every - rows}
