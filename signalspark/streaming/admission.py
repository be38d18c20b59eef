"""S2 + S3: stream landing that takes at most so many entries of every stream a tick.

A micro-batch holds whatever the source delivers, and one noisy tenant may fill it. Here a
tick admits up to ``per_stream`` entries of each stream, in order of arrival (the tick that
first saw an entry, then ``ingest_ts``, then ``entry_id``); the rest waits for later ticks.
A stream takes part from the first tick that sees it. State, beside the query's checkpoint::

    {root}/segments/arrived={tick}/   the micro-batch's entries with their rank in (stream, tick)
    {root}/plans/tick={tick}/         for every (stream, arrived) with entries left: n, done so far, take now
    {root}/sources/{tick}-{source}    written when the tick's plan is whole
    {root}/commits/{tick}-{source}    written after the tick has landed; names the micro-batch that it took in

Entries are written once, ranked once and never copied again: a tick reads only the segments
that its plan takes from, and a segment goes when no plan needs it. A tick lands as a batch
of its own. A plan without a commit is landed again, under the same batch id and with the
same rows, before anything else happens, and a micro-batch whose commit exists is not taken
in twice: a restart loses and repeats nothing.

``available_now`` runs go on with ticks until nothing waits; with a processing time, a
heartbeat keeps the ticks coming while the source is quiet.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from signalspark.schema import RAW_ENVELOPE
from signalspark.sources import files
from signalspark.sources.landing import land_batch, stream_batch_id

PER_STREAM = 5000
SEGMENT = "stream string, entry_id string, data string, ingest_ts timestamp, rank bigint, arrived bigint"
PLAN = "stream string, arrived bigint, n bigint, done bigint, take bigint"
COMMITS = 1000


def admission_root(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-admission"


def _commits(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """(tick, micro-batch) of committed ticks, oldest first."""
    split = (name.partition("-") for name in files.names(spark, f"{root}/commits"))
    return [(int(tick), source) for tick, _, source in split]


def _plan(spark: SparkSession, root: str, tick: int) -> DataFrame:
    if tick < 1:
        return spark.createDataFrame([], PLAN)
    return spark.read.schema(PLAN).parquet(f"{root}/plans/tick={tick}")


def _overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def ranked(entries: DataFrame) -> DataFrame:
    """``entries`` with their rank (from 1) in their stream; a stream is ranked minute by minute, not in one task."""
    entries = entries.withColumn("_minute", F.date_trunc("minute", "ingest_ts"))
    before = Window.partitionBy("stream").orderBy("_minute").rowsBetween(Window.unboundedPreceding, -1)
    offsets = entries.groupBy("stream", "_minute").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("stream").alias("_s"), F.col("_minute").alias("_m"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("stream", "_minute").orderBy("ingest_ts", "entry_id", "data"))
    same = F.col("stream").eqNullSafe(F.col("_s")) & F.col("_minute").eqNullSafe(F.col("_m"))
    return entries.withColumn("_within", within).join(offsets, same).withColumn(
        "rank", (F.col("_before") + F.col("_within")).cast("long")).drop("_minute", "_s", "_m", "_before", "_within")


def planned(waiting: DataFrame, per_stream: int) -> DataFrame:
    """The next tick's plan from (stream, arrived, n, done): the oldest entries of every stream up to the bound."""
    before = Window.partitionBy("stream").orderBy("arrived").rowsBetween(Window.unboundedPreceding, -1)
    room = F.lit(per_stream) - F.coalesce(F.sum(F.col("n") - F.col("done")).over(before), F.lit(0))
    take = F.greatest(F.least(F.col("n") - F.col("done"), room), F.lit(0)).cast("long")
    return waiting.select("stream", "arrived", "n", "done", take.alias("take"))


def admitted(spark: SparkSession, root: str, tick: int) -> DataFrame:
    """The entries that a tick's plan takes."""
    plan = _plan(spark, root, tick).filter("take > 0")
    ends = plan.agg(F.min("arrived"), F.max("arrived")).first()
    rows = spark.read.schema(SEGMENT).parquet(f"{root}/segments").filter(F.col("arrived").between(ends[0] or 0, ends[1] or 0))
    taken = rows.alias("e").join(plan.alias("p"), F.col("e.stream").eqNullSafe(F.col("p.stream"))
                                 & (F.col("e.arrived") == F.col("p.arrived")))
    taken = taken.filter((F.col("rank") > F.col("done")) & (F.col("rank") <= F.col("done") + F.col("take")))
    return taken.select(*[F.col(f"e.{c}").alias(c) for c in RAW_ENVELOPE.fieldNames()])


def _land(spark: SparkSession, root: str, tick: int, source: str, landing: dict) -> None:
    """Land a planned tick, commit it, and remove what no later tick or retry reads."""
    batch_id = stream_batch_id(root, tick)
    land_batch(admitted(spark, root, tick), landing["landed"], landing["bad"], batch_id, **landing["rules"])
    files.put(spark, f"{root}/commits/{tick:012d}-{source}")
    for old, name in _commits(spark, root)[:-COMMITS]:
        files.delete(spark, f"{root}/commits/{old:012d}-{name}")
    left = waiting(spark, root, tick).agg(F.min("arrived")).first()[0]
    for name in files.names(spark, f"{root}/segments"):
        if name.startswith("arrived=") and int(name[8:]) < (tick + 1 if left is None else left):
            files.delete(spark, f"{root}/segments/{name}")
    for name in files.names(spark, f"{root}/plans"):
        if int(name.partition("=")[2]) < tick:
            files.delete(spark, f"{root}/plans/{name}")


def waiting(spark: SparkSession, root: str, tick: int) -> DataFrame:
    """(stream, arrived, n, done) of entries that wait after ``tick``."""
    after = F.col("done") + F.col("take")
    return _plan(spark, root, tick).filter(after < F.col("n")).select("stream", "arrived", "n", after.alias("done"))


def _source_of(spark: SparkSession, root: str, tick: int) -> str | None:
    """The micro-batch that a complete plan without a commit took in, if there is one."""
    names = [n for n in files.names(spark, f"{root}/sources") if n.startswith(f"{tick:012d}-")]
    return names[0].partition("-")[2] if names else None


def tick(spark: SparkSession, root: str, per_stream: int, landing: dict, batch: DataFrame | None = None,
         source: str = "drain") -> bool:
    """One tick: take in ``batch`` (None: nothing new), plan, land. False if there was nothing to do."""
    done = _commits(spark, root)
    last = done[-1][0] if done else 0
    lost = _source_of(spark, root, last + 1)
    if lost is not None:  # planned, perhaps landed in part
        _land(spark, root, last + 1, lost, landing)
        return tick(spark, root, per_stream, landing, batch, source)
    if batch is not None and any(name == source for _, name in done):
        return False
    now, state = last + 1, waiting(spark, root, last)
    if batch is not None:
        _overwrite(ranked(batch.select(*RAW_ENVELOPE.fieldNames())), f"{root}/segments/arrived={now}")
        new = spark.read.schema("stream string").parquet(f"{root}/segments/arrived={now}").groupBy("stream").agg(
            F.count(F.lit(1)).alias("n"))
        state = state.unionByName(new.select("stream", F.lit(now).cast("long").alias("arrived"), "n", F.lit(0).cast("long").alias("done")))
    _overwrite(planned(state, per_stream), f"{root}/plans/tick={now}")
    if batch is None and _plan(spark, root, now).isEmpty():
        return False
    for old in files.names(spark, f"{root}/sources"):
        files.delete(spark, f"{root}/sources/{old}")
    files.put(spark, f"{root}/sources/{now:012d}-{source}")  # from here on the plan stands
    _land(spark, root, now, source, landing)
    return True


def start_bounded_landing(raw_stream: DataFrame, landed: str, bad: str, checkpoint: str, per_stream: int = PER_STREAM,
                          start: Mapping[str, datetime] | None = None, available_now: bool = True,
                          processing_time: str = "2 seconds", **rules) -> StreamingQuery:
    """Start landing with a bound a stream and tick; ``rules`` are those of ``land_batch``.

    ``start`` maps streams to the arrival time from which they are read (S3); others are read from
    their first entry. An ``available_now`` query leaves what waits to ``finish_landing``.
    """
    spark, root = raw_stream.sparkSession, admission_root(checkpoint)
    landing = {"landed": landed, "bad": bad, "rules": rules}
    src = raw_stream.select(*RAW_ENVELOPE.fieldNames())
    if start:
        begins = spark.createDataFrame(list(start.items()), "stream string, _begin timestamp")
        src = src.join(begins, "stream", "left").filter(
            F.col("_begin").isNull() | (F.col("ingest_ts") >= F.col("_begin"))).select(*RAW_ENVELOPE.fieldNames())
    if not available_now:
        beat = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
        none = beat.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in RAW_ENVELOPE.fields])
        src = src.unionByName(none.filter(F.rand() < 0))

    def one(batch: DataFrame, epoch: int) -> None:
        tick(spark, root, per_stream, landing, batch, f"epoch{epoch}")

    w = src.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def finish_landing(spark: SparkSession, landed: str, bad: str, checkpoint: str, per_stream: int = PER_STREAM, **rules) -> int:
    """Ticks until nothing waits (after an ``available_now`` query has ended); returns how many."""
    n = 0
    while tick(spark, admission_root(checkpoint), per_stream, {"landed": landed, "bad": bad, "rules": rules}):
        n += 1
    return n
