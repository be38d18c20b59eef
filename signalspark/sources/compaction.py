"""Compaction of a landed table's small files (S5), and removal of what it replaced.

Every micro-batch writes a folder a tenant and day, so a busy stream leaves thousands of
small files in each. ``compact`` packs the small units of a (tenant, day), landed folders and
earlier small bins alike, into bins of about ``target_bytes`` and writes every bin as one file::

    {root}/_compacted/tenant_id=../dt=../bin=../part-*.parquet   rows, with their batch_id
    {root}/_compaction/state/seq=../    live bins, and replaced units that still lie on disk
    {root}/_compaction/batches/seq=../  ids of the batches that were compacted
    {root}/_compaction/commits/{seq}    written last; a state without it does not count

Nothing is moved or deleted: a commit makes the new bins visible and hides the units they
replace in one step, and a reader that planned before it still finds its files. ``vacuum``
deletes hidden units some time later, together with bins that a lost run left behind. A run
that is lost before its commit changes nothing and is simply run again; one lost while it
deletes is finished by the next vacuum.

A batch that was compacted is not landed again under its id (``write_landed`` raises). The
newest epoch of every stream query, the only one that a restart repeats, is therefore never
compacted, nor is a guarded batch without its commit. Rows without a tenant or day stay
where they are. One compaction of a table at a time; landing may go on beside it.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from signalspark.session import checkpoint_table
from signalspark.sources import files

TARGET_BYTES = 128 << 20
AT = ["tenant_id", "dt"]
UNIT = [*AT, "kind", "unit"]
#: kind: ``batch`` (a landed folder) or ``bin``; ``replaced`` is null while a bin is live
STATE = "tenant_id string, dt date, kind string, unit string, replaced timestamp"
#: ids of stream batches: the query's run, then its epoch
EPOCH = "^[0-9a-f]{10}-[0-9]{12}$"


def _log(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/_compaction/{name}"


def bins_path(root: str) -> str:
    return f"{root.rstrip('/')}/_compacted"


def last(spark: SparkSession, root: str) -> int:
    """Sequence number of the newest commit; 0 before the first."""
    done = files.names(spark, _log(root, "commits"))
    return int(done[-1]) if done else 0


def state(spark: SparkSession, root: str, seq: int) -> DataFrame:
    if not seq:
        return spark.createDataFrame([], STATE)
    return spark.read.schema(STATE).parquet(f"{_log(root, 'state')}/seq={seq}")


def _with_bin(schema: StructType) -> StructType:
    return StructType(schema.fields + [StructField("bin", StringType())])


def _hidden(spark: SparkSession, root: str, seq: int) -> DataFrame:
    return state(spark, root, seq).filter((F.col("kind") == "batch") & F.col("replaced").isNotNull()).select(
        *AT, F.col("unit").alias("batch_id"))


def _live(spark: SparkSession, root: str, seq: int) -> DataFrame:
    return state(spark, root, seq).filter((F.col("kind") == "bin") & F.col("replaced").isNull()).select(
        *AT, F.col("unit").alias("bin"))


def visible(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """Rows of a landed table as of its newest commit; filters on tenant and day still prune folders."""
    rows, seq = spark.read.schema(schema).parquet(root), last(spark, root)
    if not seq:
        return rows
    loose = rows.join(_hidden(spark, root, seq), [*AT, "batch_id"], "left_anti")
    if not files.exists(spark, bins_path(root)):
        return loose.select(*schema.fieldNames())
    packed = (spark.read.schema(_with_bin(schema)).parquet(bins_path(root))
              .join(_live(spark, root, seq), [*AT, "bin"], "left_semi"))
    return loose.select(*schema.fieldNames()).unionByName(packed.select(*schema.fieldNames()))


def refuse_compacted(spark: SparkSession, root: str, batch_id: str) -> None:
    """Raise if rows of this batch lie in bins: landing it again would repeat them."""
    seq = last(spark, root)
    if not seq:
        return
    known = spark.read.schema("batch_id string, seq bigint").parquet(_log(root, "batches"))
    if not known.filter((F.col("seq") <= seq) & (F.col("batch_id") == batch_id)).isEmpty():
        raise ValueError(f"batch {batch_id!r} of {root} was compacted; land its rows under a new batch id")


def _units(rows: DataFrame, kind: str, unit: str) -> DataFrame:
    """(tenant, day, kind, unit, bytes, files) of the units that hold rows; reads footers only."""
    each = rows.select(*AT, F.col(unit).alias("unit"), F.col("_metadata.file_path").alias("path"),
                       F.col("_metadata.file_size").alias("size"),
                       F.col("_metadata.file_modification_time").alias("written"))
    each = each.groupBy(*AT, "unit", "path").agg(F.max("size").alias("size"), F.max("written").alias("written"))
    return (each.filter("tenant_id IS NOT NULL AND dt IS NOT NULL")
            .groupBy(*AT, F.lit(kind).alias("kind"), "unit")
            .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("files"), F.max("written").alias("written")))


def _settled(spark: SparkSession, landed: str, units: DataFrame) -> DataFrame:
    """Landed folders that no retry will write again."""
    from signalspark.sources.guarded import COMMITS
    from signalspark.sources.landing import commits, guard_path
    streamed = units.filter(F.col("unit").rlike(EPOCH))
    newest = streamed.groupBy(F.substring("unit", 1, 10).alias("run")).agg(F.max("unit").alias("unit"))
    units = units.join(newest.select("unit"), "unit", "left_anti")
    if files.exists(spark, guard_path(landed)):
        done = commits(spark, landed)
        known = F.col("unit").isin([batch for _, batch in done])
        if len(done) >= COMMITS:  # older commit files are gone; folders older than the oldest one left were committed
            oldest = files.modified(spark, f"{guard_path(landed)}/commits/{done[0][0]:012d}-{done[0][1]}")
            known = known | (F.col("written") < F.timestamp_millis(F.lit(oldest)))
        units = units.filter(known)
    return units


def packed(units: DataFrame, target_bytes: int) -> DataFrame:
    """``units`` that are smaller than half the target, with the number ``n`` of their bin in the (tenant, day).

    Units are laid end to end and cut every ``target_bytes``, so a bin holds at most one and a
    half times that. A bin that would only copy one file is left out.
    """
    before = Window.partitionBy(*AT).orderBy("kind", "unit").rowsBetween(Window.unboundedPreceding, -1)
    laid = units.filter(F.col("bytes") < target_bytes / 2).withColumn(
        "n", F.floor(F.coalesce(F.sum("bytes").over(before), F.lit(0)) / target_bytes).cast("long"))
    worth = laid.groupBy(*AT, "n").agg(F.sum("files").alias("in_bin")).filter("in_bin > 1").drop("in_bin")
    return laid.join(worth, [*AT, "n"])


def _commit(spark: SparkSession, root: str, seq: int, rows: DataFrame) -> None:
    rows.select("tenant_id", "dt", "kind", "unit", "replaced").write.mode("overwrite").option(
        "partitionOverwriteMode", "static").parquet(f"{_log(root, 'state')}/seq={seq}")
    files.put(spark, f"{_log(root, 'commits')}/{seq:012d}")


def compact(spark: SparkSession, root: str, target_bytes: int = TARGET_BYTES, landed: str | None = None) -> dict:
    """Pack the small files of ``root`` (a landed table, or its folder of repeats with ``landed`` naming the table)."""
    from signalspark.sources.landing import ENTRY_FILES as SCHEMA
    seq = last(spark, root)
    result = {"root": root, "seq": seq, "files_before": 0, "files_after": 0, "bytes": 0}
    if not files.exists(spark, root):
        return result
    loose = spark.read.schema(SCHEMA).parquet(root)
    todo = _settled(spark, landed or root, _units(loose, "batch", "batch_id").join(
        _hidden(spark, root, seq).withColumnRenamed("batch_id", "unit"), [*AT, "unit"], "left_anti"))
    rows = loose.select(*SCHEMA.fieldNames(), F.lit("batch").alias("kind"), F.col("batch_id").alias("unit"))
    if files.exists(spark, bins_path(root)):
        old = spark.read.schema(_with_bin(SCHEMA)).parquet(bins_path(root))
        live = _live(spark, root, seq).withColumnRenamed("bin", "unit")
        todo = todo.unionByName(_units(old, "bin", "bin").join(live, [*AT, "unit"], "left_semi"))
        rows = rows.unionByName(old.select(*SCHEMA.fieldNames(), F.lit("bin").alias("kind"), F.col("bin").alias("unit")))
    chosen = checkpoint_table(packed(todo, target_bytes), "compaction")
    total = chosen.agg(F.sum("files"), F.sum("bytes"), F.countDistinct(*AT, "n")).first()
    if not total[2]:
        return result
    seq, run = seq + 1, uuid.uuid4().hex[:8]
    named = F.concat(F.lit(f"{seq:012d}-{run}-"), F.col("n").cast("string"))
    binned = chosen.select(*UNIT, named.alias("bin"))
    (rows.join(binned, UNIT).drop("kind", "unit").repartition(*AT, "bin")  # a bin is one task's work and one file
     .write.mode("append").partitionBy(*AT, "bin").parquet(bins_path(root)))

    gone = binned.select(*UNIT).withColumn("now", F.lit(datetime.now(timezone.utc)))
    before = state(spark, root, seq - 1).join(gone.drop("now"), UNIT, "left_anti")
    made = binned.select(*AT, F.lit("bin").alias("kind"), F.col("bin").alias("unit"),
                         F.lit(None).cast("timestamp").alias("replaced")).distinct()
    batches = chosen.filter("kind = 'batch'").select(F.col("unit").alias("batch_id")).distinct()
    batches.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{_log(root, 'batches')}/seq={seq}")
    _commit(spark, root, seq, before.unionByName(made).unionByName(gone.withColumnRenamed("now", "replaced")))
    return {"root": root, "seq": seq, "files_before": total[0], "files_after": total[2], "bytes": total[1]}


def vacuum(spark: SparkSession, root: str, keep: timedelta = timedelta(days=1)) -> int:
    """Delete units replaced longer than ``keep`` ago and bins of lost runs; returns how many.

    ``keep`` must be longer than any reader works from one plan. Not while a compaction runs.
    """
    seq = last(spark, root)
    if not seq:
        return 0
    known, limit = state(spark, root, seq), datetime.now(timezone.utc) - keep
    old = known.filter(F.col("replaced") <= F.lit(limit)).select(*UNIT)
    if files.exists(spark, bins_path(root)):
        from signalspark.sources.landing import ENTRY_FILES as SCHEMA
        on_disk = (spark.read.schema(_with_bin(SCHEMA)).parquet(bins_path(root))
                   .select(*AT, F.lit("bin").alias("kind"), F.col("bin").alias("unit")).distinct())
        old = old.unionByName(on_disk.join(known.select(*UNIT), UNIT, "left_anti"))
    old, n = checkpoint_table(old, "vacuum"), 0
    for r in old.toLocalIterator():  # one small name at a time
        top, name = (root.rstrip("/"), "batch_id") if r.kind == "batch" else (bins_path(root), "bin")
        files.delete(spark, f"{top}/tenant_id={files.escaped(spark, r.tenant_id)}/dt={r.dt}/{name}={files.escaped(spark, r.unit)}")
        n += 1
    if n:
        _commit(spark, root, seq + 1, known.join(old, UNIT, "left_anti"))
    for done in files.names(spark, _log(root, "commits"))[:-1]:  # states that no reader starts from any more
        files.delete(spark, f"{_log(root, 'commits')}/{done}")
        files.delete(spark, f"{_log(root, 'state')}/seq={int(done)}")
    return n
