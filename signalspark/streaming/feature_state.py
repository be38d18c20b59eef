"""F8 and F9 on a stream, equal to the batch operators for any order of arrival.

A prior-session distance and a session's features can change long after a window would
have closed: a late signal moves a session's first position, and with it the distance of the
tenant's next session. So nothing is closed by a watermark here. Each micro-batch adds its
mergeable parts to tables under one state folder (``{state}/{name}/epoch=N``) and works out only
what it changes:

* ``cells``, ``rollups``: counts per (session, minute, device values) and sums per session; parts add up.
* ``starts``: first position of a session, by the day it lies in. A later epoch's row replaces an
  earlier one of the same day; ``gone`` marks a start that moved to another day.
* ``hours``: last position of each (tenant, hour), or NULL once the hour is empty; the latest epoch counts.
* ``distances``: F8 rows that are new or differ; the latest epoch counts.

A changed start touches its old and its new hour and the tenant's next hour that holds a session.
Only the days of those hours are read for the ``lag``, which runs per (tenant, hour), so neither a hot
tenant nor its history meets in one task. Earlier starts of a batch's sessions are looked up by key in
a scan of the narrow ``starts`` columns, without a shuffle where the batch is small.

A retried micro-batch reads only older epochs and overwrites its own, so it repeats itself
exactly. The state belongs to one checkpoint. NULL tenants and sessions are keys like others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from signalspark.functions.geo import haversine_km
from signalspark.operators.features import SESSION_KEYS
from signalspark.plans.feature_set import cells, merge_components, session_sums, with_mouse_mean
from signalspark.session import checkpoint_table
from signalspark.sources import files
from signalspark.sources.feature_store import write_features

_KEYS = "tenant_id string, session_id string"
_POINT = "struct<session_start: timestamp, event_id: string, lat: double, lon: double>"
SCHEMAS = {
    "cells": f"{_KEYS}, minute timestamp, distinct_fingerprints string, distinct_ips string, distinct_os string, "
             "n bigint, last_ts timestamp",
    "rollups": f"{_KEYS}, last_ts timestamp, ms double, mn bigint, tn bigint, ts double, tss double, typing_end timestamp",
    "starts": f"{_KEYS}, first {_POINT}, gone boolean, dt date",
    "hours": f"tenant_id string, hour timestamp, last {_POINT}",
    "distances": f"{_KEYS}, window_end timestamp, geo_distance_km_prior double",
}


def _read(spark: SparkSession, state: str, name: str, upto: int) -> DataFrame:
    """Rows of a state table by epochs up to ``upto``, with their ``epoch``."""
    schema = f"{SCHEMAS[name]}, epoch bigint"
    if not files.exists(spark, f"{state}/{name}"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{state}/{name}").filter(F.col("epoch") <= upto)


def _write(rows: DataFrame, state: str, name: str, epoch: int, *by: str) -> None:
    """This epoch's rows, in place of those that an earlier try left."""
    w = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (w.partitionBy(*by) if by else w).parquet(f"{state}/{name}/epoch={epoch}")


def _of(rows: DataFrame, keyed: DataFrame, keys: list[str], how: str = "left_semi") -> DataFrame:
    """``rows`` whose keys are in ``keyed`` (distinct keys); NULL equals NULL. A ``left`` join adds its other columns."""
    renamed = keyed.select(*[F.col(c).alias(f"_k_{c}") for c in keys], *[c for c in keyed.columns if c not in keys])
    joined = rows.join(renamed, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys], how)
    return joined if how == "left_semi" else joined.drop(*[f"_k_{c}" for c in keys])


def _hour(point: str) -> Column:
    return F.date_trunc("hour", F.col(point)["session_start"])


def first_positions(events: DataFrame) -> DataFrame:
    """(session, ``first``): earliest signal with a position; ties by event id."""
    at = F.struct(F.col("ts").alias("session_start"), "event_id", F.col("device.geo_lat").alias("lat"),
                  F.col("device.geo_lon").alias("lon"))
    return events.filter("device.geo_lat IS NOT NULL AND device.geo_lon IS NOT NULL").groupBy(*SESSION_KEYS).agg(F.min(at).alias("first"))


def _current_starts(spark: SparkSession, state: str, upto: int, hours: DataFrame) -> DataFrame:
    """(session, first, hour) of all sessions that start in one of ``hours`` (tenant_id, hour, ...), with its other columns."""
    days = [r[0] for r in hours.select(F.to_date("hour")).distinct().collect()]  # a list of days, not of data
    rows = _read(spark, state, "starts", upto).filter(F.col("dt").isin(days) if days else F.lit(False))
    latest = rows.groupBy(*SESSION_KEYS, "dt").agg(F.max_by(F.struct("first", "gone"), "epoch").alias("r"))
    alive = latest.filter(~F.col("r.gone")).select(*SESSION_KEYS, F.col("r.first").alias("first"), _hour("r.first").alias("hour"))
    return _of(alive, hours.withColumn("_in", F.lit(True)), ["tenant_id", "hour"], "left").filter("_in").drop("_in")


def read_distances(spark: SparkSession, state: str, upto: int = 2**62, of: DataFrame | None = None) -> DataFrame:
    """F8 rows as of now: the latest of each session, or of the sessions in ``of``."""
    rows = _read(spark, state, "distances", upto)
    rows = rows if of is None else _of(rows, of, SESSION_KEYS)
    row = F.struct("window_end", "geo_distance_km_prior")
    return rows.groupBy(*SESSION_KEYS).agg(F.max_by(row, "epoch").alias("r")).select(*SESSION_KEYS, "r.*")


def merge_distances(batch: DataFrame, state: str, epoch: int) -> DataFrame:
    """Take a micro-batch into the state; returns the F8 rows that it adds or changes."""
    spark = batch.sparkSession
    part = checkpoint_table(first_positions(batch), "stream-first-positions")
    known = _of(_read(spark, state, "starts", epoch - 1), part.select(*SESSION_KEYS), SESSION_KEYS)
    known = known.groupBy(*SESSION_KEYS).agg(F.min("first").alias("old"))  # a start only ever moves back
    changed = _of(part, known, SESSION_KEYS, "left").filter("old IS NULL OR first < old")
    changed = checkpoint_table(changed, "stream-changed-starts")
    day, old_day = F.to_date("first.session_start"), F.to_date("old.session_start")
    moved = changed.filter(old_day != day)
    _write(changed.select(*SESSION_KEYS, "first", F.lit(False).alias("gone"), day.alias("dt")).unionByName(
        moved.select(*SESSION_KEYS, F.col("old").alias("first"), F.lit(True).alias("gone"), old_day.alias("dt"))),
        state, "starts", epoch, "dt")

    affected = changed.select("tenant_id", F.explode(F.array(_hour("first"), _hour("old"))).alias("hour"))
    affected = checkpoint_table(affected.filter("hour IS NOT NULL").distinct(), "stream-affected-hours")
    order = F.struct("first.session_start", "session_id")
    last = _current_starts(spark, state, epoch, affected).groupBy("tenant_id", "hour").agg(F.max_by("first", order).alias("last"))
    _write(_of(affected, last, ["tenant_id", "hour"], "left"), state, "hours", epoch)

    # an hour's first session follows the last one of the tenant's nearest earlier hour that holds any
    newest = (_read(spark, state, "hours", epoch).groupBy("tenant_id", "hour")
              .agg(F.max_by(F.struct("last"), "epoch")["last"].alias("last"), (F.max("epoch") == epoch).alias("affected"))
              .filter("last IS NOT NULL OR affected"))
    along = Window.partitionBy("tenant_id").orderBy("hour")
    carried = F.last("last", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1))
    touched = newest.select("tenant_id", "hour", carried.alias("carried"),
                            (F.col("affected") | F.coalesce(F.lag("affected").over(along), F.lit(False))).alias("touched"))
    touched = checkpoint_table(touched.filter("touched").drop("touched"), "stream-touched-hours")
    within = Window.partitionBy("tenant_id", "hour").orderBy("first.session_start", "session_id")
    rows = _current_starts(spark, state, epoch, touched).withColumn(
        "prior", F.coalesce(F.lag("first").over(within), F.col("carried")))
    rows = rows.select(*SESSION_KEYS, F.col("first.session_start").alias("window_end"),
                       haversine_km("prior.lat", "prior.lon", "first.lat", "first.lon").alias("geo_distance_km_prior"))
    rows = checkpoint_table(rows, "stream-distances")
    before = read_distances(spark, state, epoch - 1, rows.select(*SESSION_KEYS)).toDF(*SESSION_KEYS, "_end", "_km")
    new = _of(rows, before, SESSION_KEYS, "left").filter(
        ~(F.col("window_end").eqNullSafe(F.col("_end")) & F.col("geo_distance_km_prior").eqNullSafe(F.col("_km"))))
    _write(new.drop("_end", "_km"), state, "distances", epoch)
    return spark.read.schema(SCHEMAS["distances"]).parquet(f"{state}/distances/epoch={epoch}")


def _merged_rollups(parts: DataFrame) -> DataFrame:
    """Session roll-up from sums of several epochs: variance from count, sum and sum of squares around 0."""
    sums = parts.groupBy(*SESSION_KEYS).agg(F.max("last_ts").alias("last_ts"), F.max("typing_end").alias("typing_end"),
                                            *[F.sum(c).alias(c) for c in ("ms", "mn", "tn", "ts", "tss")])
    spread = F.greatest(F.col("tss") - F.col("ts") * F.col("ts") / F.col("tn"), F.lit(0.0))
    return with_mouse_mean(sums.withColumn("typing_cps_mean", F.when(F.col("tn") > 0, F.col("ts") / F.col("tn")))
                           .withColumn("typing_cps_variance", F.when(F.col("tn") > 1, spread / (F.col("tn") - 1)))
                           .drop("tn", "ts", "tss"))


def merge_features(batch: DataFrame, state: str, table: str, epoch: int) -> None:
    """Take a micro-batch into the state and upsert all rows of the sessions it changes.

    These are the sessions of the batch and those whose prior session has changed. Their old rows
    go, as a batch run over all signals would not give them.
    """
    spark = batch.sparkSession
    moved = merge_distances(batch, state, epoch)
    cps = F.col("t.cps")
    _write(cells(batch), state, "cells", epoch)
    _write(session_sums(batch, F.count(cps).alias("tn"), F.sum(cps).alias("ts"), F.sum(cps * cps).alias("tss")),
           state, "rollups", epoch)
    sessions = _read(spark, state, "rollups", epoch).filter(F.col("epoch") == epoch).select(*SESSION_KEYS)
    sessions = checkpoint_table(sessions.union(moved.select(*SESSION_KEYS)).distinct(), "stream-touched-sessions")
    counted = checkpoint_table(_of(_read(spark, state, "cells", epoch), sessions, SESSION_KEYS).drop("epoch"), "stream-cells")
    rollups = _merged_rollups(_of(_read(spark, state, "rollups", epoch), sessions, SESSION_KEYS))
    rows = merge_components(counted, rollups, read_distances(spark, state, epoch, sessions))
    since = counted.agg(F.min(F.to_date("minute"))).first()[0]
    if since is not None:  # an empty batch changes nothing
        write_features(rows, table, fmt="parquet", replace=(sessions.toDF("_t", "_s"), since, None))


def _start(events: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], available_now: bool,
           processing_time: str) -> StreamingQuery:
    w = events.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)).start()


def _once(batch: DataFrame) -> DataFrame:
    """The micro-batch written once: its source is read by several jobs."""
    return checkpoint_table(batch.select("event_id", *SESSION_KEYS, "ts", "device", "behavioral"), "stream-signals")


def start_distances(events: DataFrame, state: str, checkpoint: str, available_now: bool = True,
                    processing_time: str = "10 seconds") -> StreamingQuery:
    """F8 on a stream; :func:`read_distances` gives the rows."""
    return _start(events, checkpoint, lambda batch, epoch: merge_distances(_once(batch), state, epoch) and None,
                  available_now, processing_time)


def start_features(events: DataFrame, state: str, table: str, checkpoint: str, available_now: bool = True,
                   processing_time: str = "1 minute") -> StreamingQuery:
    """F9 on a stream, into the feature table; rows of the table are complete after every micro-batch."""
    return _start(events, checkpoint, lambda batch, epoch: merge_features(_once(batch), state, table, epoch),
                  available_now, processing_time)
