"""Replay guard. The first ``(tenant, event_id)`` wins for 24 h.

The guard is a set-if-absent with a TTL that duplicates do not refresh: an
entry is accepted iff it arrives at least ``ttl`` after the last *accepted*
entry of its key (0 h, 20 h, 30 h -> accept, drop, accept). That is a fold, not
a ``lag`` test.

Batch form, exact and skew-safe: arrival time is cut into ``ttl``-wide buckets.
Two accepted entries of a key are at least ``ttl`` apart, so each bucket holds
at most one accepted entry per key, and only a key accepted in the bucket just
before can block anything in the current one. Where a key has no entry in the
bucket before, its first entry is accepted without more ado; so a key's buckets
fall into runs of neighbours, and all runs of all keys are folded side by side:
round ``r`` decides the ``r``-th bucket of every run that is that long. Rounds
follow the longest run of one key, not the days of the input, and read only the
entries of runs that have more than one bucket (written once, by round, under
``spark.checkpoint.dir``). Every step is a ``min`` with map-side combine or a join
with one row a key and bucket, so a key with millions of copies is never
gathered in one task. Entries without a time or key are not accepted.

Stream form: ``dropDuplicatesWithinWatermark`` with a ``ttl`` watermark. It is
close to, not equal to, the fold (it may also drop a repeat that arrives after
``ttl`` while the first copy's state is still held).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalspark.functions.windows import interval_micros
from signalspark.session import checkpoint_table, work_dir
from signalspark.schema import REPLAY_TTL_HOURS

TTL = f"{REPLAY_TTL_HOURS} hours"


def replay_guard(entries: DataFrame, keys: Sequence[str] = ("tenant_id", "event_id"),
                 time_col: str = "ingest_ts", tie_col: str = "entry_id", ttl: str = TTL,
                 flag: str = "first_seen") -> DataFrame:
    """Add boolean ``flag``: true for entries the guard accepts.

    ``(time_col, tie_col)`` must identify an entry within its key.
    """
    keys = list(keys)
    ttl_us = interval_micros(ttl)
    spark = entries.sparkSession
    order = F.struct(F.col(time_col).alias("t"), F.col(tie_col).alias("i"))
    us = F.unix_micros(time_col)
    tagged = entries.withColumn("_o", order).withColumn(
        "_bkt", ((us - F.pmod(us, F.lit(ttl_us))) / F.lit(ttl_us)).cast("bigint"))
    tagged = checkpoint_table(tagged, "replay-guard")  # the rounds and the final join read the same copy
    e = tagged.select(*keys, "_o", "_bkt").filter(F.col("_bkt").isNotNull())
    by_key = Window.partitionBy(*keys).orderBy("_bkt")  # one row a bucket, however many copies
    first = e.groupBy(*keys, "_bkt").agg(F.min("_o").alias("_o")).withColumn("_run", F.col("_bkt") - F.row_number().over(by_key))
    in_run = Window.partitionBy(*keys, "_run").orderBy("_bkt")
    first = checkpoint_table(first.withColumn("_round", F.row_number().over(in_run) - 1).drop("_run"), "replay-guard-first")
    accepted = last = first.filter("_round = 0").select(*keys, "_o", "_bkt")
    rounds = first.agg(F.max("_round")).first()[0] or 0
    if rounds:
        path = work_dir(spark, "replay-guard-runs")
        later = first.filter("_round > 0").select(*keys, "_bkt", "_round")
        runs = e.join(later, [*keys, "_bkt"])
        runs.write.partitionBy("_round").parquet(path)
        runs = spark.read.schema(runs.schema).parquet(path)
    for r in range(1, rounds + 1):
        before = last.select(*keys, (F.col("_bkt") + 1).alias("_bkt"), (F.col("_o.t") + F.expr(f"INTERVAL {ttl}")).alias("_until"))
        cur = runs.filter(F.col("_round") == r).drop("_round").join(before, [*keys, "_bkt"], "left")
        cur = cur.filter(F.col("_until").isNull() | (F.col("_o.t") >= F.col("_until")))
        last = checkpoint_table(cur.groupBy(*keys, "_bkt").agg(F.min("_o").alias("_o")).select(*keys, "_o", "_bkt"), "replay-guard-round")
        accepted = accepted.unionByName(last)
    hit = accepted.select(*keys, "_o", F.lit(True).alias(flag))
    out = tagged.join(hit, keys + ["_o"], "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
    return out.drop("_o", "_bkt")


def replay_guard_stream(entries: DataFrame, keys: Sequence[str] = ("tenant_id", "event_id"),
                        time_col: str = "ingest_ts", ttl: str = TTL) -> DataFrame:
    """Stream form: drop repeats of a key while its first copy is within the watermark."""
    return entries.withWatermark(time_col, ttl).dropDuplicatesWithinWatermark(list(keys))


NARROW = ["stream", "entry_id", "ingest_ts", "tenant_id_hint", "outcome", "reason"]


def apply_guard(classified: DataFrame) -> DataFrame:
    """Narrow outcome frame with validation-accepted repeats turned into ``duplicate``.

    Columns: stream, entry_id, ingest_ts, tenant_id_hint, outcome, reason.
    Only entries that passed every other rule take part, as at the edge. The
    classified frame is projected to its narrow columns and written once under
    ``spark.checkpoint.dir``, so each payload is parsed once although the
    guard and the final join both read it.
    """
    spark = classified.sparkSession
    path = work_dir(spark, "outcomes")
    classified.select(*NARROW, F.col("sig.tenant_id").alias("tenant_id"),
                      F.col("sig.event_id").alias("event_id")).write.parquet(path)
    narrow = spark.read.parquet(path)
    ok = narrow.filter(F.col("outcome") == "accepted").select(
        "stream", "entry_id", "ingest_ts", "tenant_id", "event_id")
    flags = replay_guard(ok).filter(~F.col("first_seen")).select("stream", "entry_id", "first_seen")
    out = narrow.join(flags, ["stream", "entry_id"], "left")
    dup = F.col("first_seen").isNotNull()
    return out.select("stream", "entry_id", "ingest_ts", "tenant_id_hint",
                      F.when(dup, "duplicate").otherwise(F.col("outcome")).alias("outcome"),
                      F.when(dup, "duplicate").otherwise(F.col("reason")).alias("reason"))
