"""Operator 8, sharding: a two-pass external shuffle into shards of equal row counts.

Pass 1 scatters the records uniformly into memory-sized buckets by a seeded
hash. Pass 2 Fisher-Yates shuffles each bucket in memory (Spark's ``shuffle``
array function is the inside-out Fisher-Yates) and lays the buckets end to end.
A record's place in that order decides its shard: shard ``s`` of ``k`` takes
places ``ceil(s*n/k)`` up to ``ceil((s+1)*n/k)``, so row counts are at most one
apart (law ``rows``) and slots are gapless from 0. Copies are records like any
other and are scattered apart.

DataFrame functions only. Only two scalars reach the driver.

A record's place follows from the rows and the seed alone: not from their order, nor from
the session's number of shuffle partitions or how the input is split.

Edge cases: null keys and texts are hashed like values; rows that repeat are
each kept and placed, in one bucket if key and text are equal; an empty table gives no rows; an input column named like
an added one (``shard``, ``slot``) is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from signalspark.llm.common import record, text_of, unpacked

SEED = 20_240_817
BUCKET_BYTES = 16 << 20
#: per-record bytes besides the text, for sizing
RECORD_BYTES = 16


def record_size(text: str) -> Column:
    """UTF-8 bytes of the text plus the fixed record part."""
    return (F.octet_length(text_of(text)) + RECORD_BYTES).cast("long")


def _offsets(counts: DataFrame) -> DataFrame:
    """Rows before each bucket, as two-level prefix sums so no task sees every bucket."""
    block = F.floor(F.col("_b") / 1024)
    within = Window.partitionBy("_block").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_block", block)
    inner = counts.withColumn("_in", F.coalesce(F.sum("_n").over(within), F.lit(0)))
    totals = counts.groupBy("_block").agg(F.sum("_n").alias("_bn"))
    outer = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_block", F.coalesce(F.sum("_bn").over(outer), F.lit(0)).alias("_out"))
    return inner.join(totals, "_block").select("_b", (F.col("_in") + F.col("_out")).alias("_base"))


def _tie(df: DataFrame) -> Column:
    """Orders rows that share key and text by their other columns (those that Spark can hash)."""
    hashable = [F.col(f"`{f.name}`") for f in df.schema.fields
                if not any(kind in f.dataType.simpleString() for kind in ("map<", "variant"))]
    return F.xxhash64(*hashable)


def _by_hash(a: Column, b: Column) -> Column:
    before = (a["_h"] < b["_h"]) | ((a["_h"] == b["_h"]) & (a["_t"] < b["_t"]))
    return F.when(before, -1).when((a["_h"] == b["_h"]) & (a["_t"] == b["_t"]), 0).otherwise(1)


def external_shuffle(df: DataFrame, key: str = "doc_id", text: str = "text", n_shards: int = 40,
                     seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All columns of ``df`` plus ``shard`` (int) and ``slot`` (long); whole records are moved.

    The bucket count follows the total bytes, so a bucket stays near
    ``bucket_bytes`` at any input size.
    """
    n, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(record_size(text)), F.lit(0))).first()
    buckets = max(1, -(-size // bucket_bytes))
    mixed = F.xxhash64(F.lit(seed), F.col(key), F.col(text))
    scattered = df.select(F.pmod(mixed, F.lit(buckets)).alias("_b"), mixed.alias("_h"), _tie(df).alias("_t"), record(df))
    base = _offsets(scattered.groupBy("_b").agg(F.count(F.lit(1)).alias("_n")))
    # one draw of a permutation depends on the task's number and the buckets before it there. Both follow from
    # the bucket count alone: that many tasks by the bucket's hash, in each the buckets in order, rows sorted
    bucket = (scattered.repartition(buckets, "_b").groupBy("_b")
              .agg(F.array_sort(F.collect_list(F.struct("_h", "_t", "_rec")), _by_hash).alias("_rows"))
              .sortWithinPartitions("_b").select("_b", F.shuffle("_rows", seed).alias("_rows")).join(base, "_b"))
    placed = (bucket.select("_base", F.posexplode("_rows").alias("_pos", "_row"))
              .select((F.col("_base") + F.col("_pos")).alias("_at"), F.col("_row._rec").alias("_rec")))
    shard = F.expr(f"(_at * {n_shards}) div {max(n, 1)}")
    placed = (placed.withColumn("shard", shard.cast("int"))
              .withColumn("slot", F.col("_at") - F.expr(f"(shard * {n}L + {n_shards - 1}) div {n_shards}")))
    return unpacked(placed, df.schema, ["shard", "slot"])


def write_shards(shuffled: DataFrame, path: str) -> None:
    """One folder per shard, files sorted by slot; a shard may span several tasks' files."""
    (shuffled.sortWithinPartitions("shard", "slot").write.mode("overwrite")
     .partitionBy("shard").parquet(path))
