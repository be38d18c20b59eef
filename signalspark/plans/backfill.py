"""F11 + F12: backfill / replay of a date range into the feature table.

A slice by ``dt`` cuts sessions at its edges and leaves prior-session distances
empty, so the input range is taken from the data, not from a number of days:

1. sessions with a signal in the slice (or the day before it, whose last window may
   end at the slice's first midnight) are found on the key columns of those partitions;
2. the partitions that hold any signal of these sessions, before or after the slice,
   are read, and all signals of these sessions with them;
3. prior-session distances use the first positions of every session of the tenant up to
   the slice's end, whatever its age (a narrow scan of keys, time and position).

Rows whose ``window_end`` falls in the slice are then exactly those of a run over
everything. ``dt`` and ``tenant_id`` filters are partition filters. ``run_backfill`` also
drops rows of these sessions in the slice that an earlier, shorter input had produced.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation

from signalspark.plans.feature_set import build_feature_set
from signalspark.session import checkpoint_table, ensure_utc
from signalspark.sources.feature_store import write_features
from signalspark.sources.landing import read_landed


def _date(d) -> dt.date | None:
    if d is None or isinstance(d, dt.date):
        return d
    return dt.date.fromisoformat(str(d))


def slice_landed(landed: DataFrame, start=None, end=None, tenant: str | None = None) -> DataFrame:
    """inclusive ``dt`` range and optional tenant."""
    start, end = _date(start), _date(end)
    out = landed
    if start is not None:
        out = out.filter(F.col("dt") >= F.lit(start))
    if end is not None:
        out = out.filter(F.col("dt") <= F.lit(end))
    if tenant is not None:
        out = out.filter(F.col("tenant_id") == tenant)
    return out


def _same_session(other: str) -> Column:
    """Join condition to ``other``'s ``_t`` and ``_s``; NULL keys are sessions too."""
    return F.col("tenant_id").eqNullSafe(F.col(f"{other}._t")) & F.col("session_id").eqNullSafe(F.col(f"{other}._s"))


def touched_sessions(landed: DataFrame, start=None, end=None, tenant: str | None = None) -> DataFrame:
    """(_t, _s): sessions whose features may have a window end in the slice."""
    start = _date(start)
    day_before = None if start is None else start - dt.timedelta(days=1)
    return (slice_landed(landed, day_before, end, tenant)
            .select(F.col("tenant_id").alias("_t"), F.col("session_id").alias("_s")).distinct())


def backfill_features(landed: DataFrame, start=None, end=None, tenant: str | None = None) -> DataFrame:
    """Feature rows of the slice, equal to those of a run over the whole landed table."""
    start, end = _date(start), _date(end)
    whole = slice_landed(landed, tenant=tenant)
    if start is None and end is None:
        return build_feature_set(whole)
    touched = checkpoint_table(touched_sessions(landed, start, end, tenant), "touched-sessions").alias("touched")
    days = (whole.select("tenant_id", "session_id", "dt").join(touched, _same_session("touched"), "left_semi")
            .agg(F.min("dt"), F.max("dt")).first())
    signals = slice_landed(whole, *days).join(touched, _same_session("touched"), "left_semi")
    feats = build_feature_set(signals, geo_events=slice_landed(whole, end=end))
    d = F.to_date("window_end")
    if start is not None:
        feats = feats.filter(d >= F.lit(start))
    if end is not None:
        feats = feats.filter(d <= F.lit(end))
    return feats


def run_backfill(spark: SparkSession, raw_path: str, table: str, start=None, end=None,
                 tenant: str | None = None, fmt: str | None = None) -> int:
    """slice -> features -> upsert; the row count comes from the same run (observe)."""
    ensure_utc(spark)
    landed = read_landed(spark, raw_path)
    feats = backfill_features(landed, start, end, tenant)
    obs = Observation("backfill")
    write_features(feats.observe(obs, F.count(F.lit(1)).alias("rows")), table, fmt=fmt,
                   replace=(touched_sessions(landed, start, end, tenant), _date(start), _date(end)))
    return int(obs.get.get("rows", 0))
