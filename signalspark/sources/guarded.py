"""Landing behind the edge's guards (V14, V15, V16, V18), exact over all batches.

``land_guarded`` lands one batch (a nightly one or a micro-batch): the tenant's token
bucket decides first, then the payload rules, then the replay guard. The guard's ledger
lies inside the landed table, hidden from readers by its underscore::

    {landed}/_guard/decisions/seq=../day=../   every valid entry and whether it is accepted
    {landed}/_guard/outcomes/seq=../           entries per (tenant, outcome), as changes
    {landed}/_guard/flips/seq=../              landed entries whose decision changed later
    {landed}/_guard/quota/seq=../              the tenants' buckets after the batch
    {landed}/_guard/commits/{seq}-{batch_id}   written last; a sequence number without it does not count
    {landed}/_duplicates/tenant_id=../dt=../batch_id=../   repeats, with their payload

Nothing is dropped for being late. A late entry may be the first of its key and turn an
entry that landed hours ago into a repeat, and one refused then into a first. Each batch
therefore folds, for the keys that it holds, its own entries and all later ones of the
ledger again, starting from the last accepted entry before them (decisions before a key's
earliest new entry cannot change). Changed decisions go to ``flips``; ``read_landed``
applies them, so the table always equals the fold over everything that has arrived, in
any order and in any batches. The ledger is partitioned by arrival day and a batch reads
it from the day before its earliest entry on.

The token bucket is the edge's: it decides at arrival and never again. Requests of a
tenant older than its last second count at that second.

A batch that was committed is not landed again, so retried micro-batches and repeated
jobs change nothing. One job at a time may land into a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalspark.functions.windows import interval_micros
from signalspark.operators.dedup import TTL, replay_guard
from signalspark.operators.ingest import classify, landing_columns, split_classified, tenant_hint
from signalspark.operators.quota import BUCKET, admit
from signalspark.session import checkpoint_table
from signalspark.sources import files
from signalspark.sources.landing import ENTRY, commits, duplicates_path, guard_path, ledger, write_landed, write_quarantine

KEY = ["tenant_id", "event_id"]
DECISIONS = ("tenant_id string, event_id string, stream string, entry_id string, ingest_ts timestamp, "
             "accepted boolean, seq bigint, day date")
OUTCOMES = "tenant_id string, outcome string, n bigint, seq bigint"
#: commit files kept; a retry only ever repeats one of the newest batches
COMMITS = 1000


def _commit(spark: SparkSession, landed: str, seq: int, batch_id: str, before: list[tuple[int, str]]) -> None:
    root = f"{guard_path(landed)}/commits"
    files.put(spark, f"{root}/{seq:012d}-{batch_id}")
    for old, batch in before[:-COMMITS]:
        files.delete(spark, f"{root}/{old:012d}-{batch}")


def _write(df: DataFrame, landed: str, name: str, seq: int, by: str | None = None) -> None:
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if by:
        w = w.partitionBy(by)
    w.parquet(f"{guard_path(landed)}/{name}/seq={seq}")


def _order() -> F.Column:
    return F.struct("ingest_ts", "entry_id", "stream")


def decide(new: DataFrame, known: DataFrame, ttl: str = TTL) -> DataFrame:
    """Decisions that the entries ``new`` make or change, given the decisions ``known``.

    Columns of ``known`` without ``seq``: the entry, ``accepted`` and ``day``, with ``was``: the
    decision it replaces, null for a new entry.
    """
    columns = [*KEY, *ENTRY]
    low = new.groupBy(*KEY).agg(F.min(_order()).alias("low"))
    latest = known.groupBy(*columns, "day").agg(F.max_by("accepted", "seq").alias("was"))
    near = latest.join(low, KEY).filter(
        F.unix_micros("ingest_ts") > F.unix_micros("low.ingest_ts") - F.lit(interval_micros(ttl)))
    # before the earliest new entry only the accepted one matters: it is the fold's first entry
    again = near.filter(F.col("was") | (_order() > F.col("low"))).select(*columns, "day", "was")
    fresh = new.select(*columns, F.to_date("ingest_ts").alias("day"), F.lit(None).cast("boolean").alias("was"))
    rows = fresh.unionByName(again).withColumn("tie", F.struct("entry_id", "stream"))
    folded = replay_guard(rows, KEY, tie_col="tie", ttl=ttl, flag="accepted").drop("tie")
    return folded.filter(F.col("was").isNull() | (F.col("was") != F.col("accepted")))


def land_guarded(raw: DataFrame, landed: str, bad: str, batch_id: str, strict: bool = True,
                 quota: tuple[float, float] | None = None, wire_compat: bool = False, ttl: str = TTL) -> dict:
    """Land one batch of raw entries; ``quota`` is (requests per second, burst) of every tenant."""
    spark = raw.sparkSession
    before = commits(spark, landed)
    last = before[-1][0] if before else 0
    if any(batch == batch_id for _, batch in before):
        return {"landed": landed, "quarantine": bad, "batch_id": batch_id, "landed_rows": 0, "quarantined_rows": 0}
    seq = last + 1

    admitted = None
    if quota is not None:
        raw = checkpoint_table(raw, "landing-raw")  # the bucket and the rules read it
        buckets = ledger(spark, landed, "quota", BUCKET + ", seq bigint", last).filter(F.col("seq") == last)
        raw, buckets = admit(raw.withColumn("_tenant", tenant_hint("stream")), *quota, tenant_col="_tenant", initial=buckets)
        raw, admitted = raw.drop("_tenant"), F.col("admitted")
        _write(buckets, landed, "quota", seq)
    judged = classify(raw, wire_compat, admitted)
    if strict:  # else what lands is the body as sent, and the guard needs the signal beside it
        judged = landing_columns(judged, strict, tuple(ENTRY))
    entries = checkpoint_table(judged, "landing-classified")

    ok = entries.filter(F.col("outcome") == "accepted").select(
        F.col("sig.tenant_id").alias("tenant_id"), F.col("sig.event_id").alias("event_id"), *ENTRY)
    earliest = ok.agg(F.min("ingest_ts")).first()[0]
    known = ledger(spark, landed, "decisions", DECISIONS, last)
    if earliest is not None:
        known = known.filter(F.col("day") >= F.date_sub(F.to_date(F.lit(earliest)), 1 + interval_micros(ttl) // 86_400_000_001))
    decided = checkpoint_table(decide(ok, known, ttl), "landing-decided")
    _write(decided.select(*KEY, *ENTRY, "accepted", "day"), landed, "decisions", seq, by="day")
    flips = decided.filter(F.col("was").isNotNull())
    if not flips.isEmpty():
        _write(flips.select(*ENTRY, "accepted"), landed, "flips", seq)

    repeats = decided.filter(F.col("was").isNull() & ~F.col("accepted")).select(*ENTRY)
    good, refused = split_classified(entries, strict, keep=tuple(ENTRY))
    write_landed(good.join(repeats, ENTRY, "left_anti"), landed, batch_id)
    write_landed(good.join(repeats, ENTRY, "left_semi"), duplicates_path(landed), batch_id)
    write_quarantine(refused, bad, batch_id)

    def changes(rows: DataFrame, outcome, n) -> DataFrame:
        return rows.select("tenant_id", outcome.alias("outcome"), n.alias("n"))

    decision = F.when(F.col("accepted"), "accepted").otherwise("duplicate")
    counted = changes(entries.filter(F.col("outcome") != "accepted").withColumn("tenant_id", F.col("tenant_id_hint")),
                      F.col("outcome"), F.lit(1))
    counted = counted.unionByName(changes(decided, decision, F.lit(1)))
    counted = counted.unionByName(changes(flips, F.when(F.col("was"), "accepted").otherwise("duplicate"), F.lit(-1)))
    _write(counted.groupBy("tenant_id", "outcome").agg(F.sum("n").cast("long").alias("n")), landed, "outcomes", seq)
    _commit(spark, landed, seq, batch_id, before)
    return {"landed": landed, "quarantine": bad, "batch_id": batch_id, "seq": seq,
            "landed_rows": good.count() - repeats.count(), "quarantined_rows": refused.count()}


def _last(spark: SparkSession, landed: str) -> int:
    done = commits(spark, landed)
    return done[-1][0] if done else 0


def landed_decisions(spark: SparkSession, landed: str) -> DataFrame:
    """V14 over everything landed so far: every valid, admitted entry and whether the guard accepts it."""
    known = ledger(spark, landed, "decisions", DECISIONS, _last(spark, landed))
    return known.groupBy(*KEY, *ENTRY).agg(F.max_by("accepted", "seq").alias("first_seen"))


def landed_outcomes(spark: SparkSession, landed: str) -> DataFrame:
    """V16 over everything landed so far: entries per (tenant, outcome), guard and quota included."""
    counts = ledger(spark, landed, "outcomes", OUTCOMES, _last(spark, landed))
    return counts.groupBy("tenant_id", "outcome").agg(F.sum("n").alias("n")).filter(F.col("n") > 0)
