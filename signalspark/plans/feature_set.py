"""the feature set, one row per (tenant, session, window_end).

Each component keeps its own ``window_end`` (window ends for velocity, last
signal for cardinality and mouse, last typing signal for typing, first geo
signal for geo), exactly as the original six full outer joins produced it.

Plan here: three narrow scans of the input (each reads only the leaves it needs), no joins
on the big side. Their results are written once and at the same time, as none needs another:

1. ``cells``: one hash aggregate at (session, minute, fingerprint, IP, OS). All three
   velocity levels are sums of its counts (1m divides 5m divides 1h, windows are epoch
   aligned), and distinct counts look at its rows instead of the signals.
2. ``session_rollup``: one aggregate per session gives mouse and typing. Typing speeds
   come from an ``explode_outer`` of only the ``type`` elements; per-signal mouse sums
   are taken on the first exploded row of each signal so nothing is counted twice.
3. The geo start on signals with a position only, then a bucketed, skew-safe ``lag``.

All component rows are unioned and merged by one ``groupBy`` on the keys. No component is
joined by session, so a session with a NULL key keeps all its features.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalspark.functions.windows import WINDOWS, window_end
from signalspark.operators.features import (
    DISTINCT_FIELDS,
    SESSION_KEYS,
    TYPING,
    _mouse_parts,
    geo_distance_vs_prior,
    typed_speeds,
)
from signalspark.schema import FEATURE_VALUE_COLUMNS
from signalspark.session import checkpoint_table, together

KEYS = ["tenant_id", "session_id", "window_end"]
FEATURE_WINDOW = "session"


def cells(events: DataFrame) -> DataFrame:
    """(session, minute start, fingerprint, IP, OS) -> signal count and last signal."""
    device = [F.col(f"device.{field}").alias(name) for name, field in DISTINCT_FIELDS.items()]
    return (events.select(*SESSION_KEYS, "ts", *device)
            .groupBy(*SESSION_KEYS, F.date_trunc("minute", "ts").alias("minute"), *DISTINCT_FIELDS)
            .agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_ts")))


def velocity_rows(counted: DataFrame) -> DataFrame:
    """All three velocity levels as rows (keys, events_1m, events_5m, events_1h) from cells; counts of a key add up."""
    levels = F.array(*[
        F.struct(F.lit(lbl).alias("lvl"), window_end("minute", w).alias("window_end"))
        for lbl, w in WINDOWS.items()
    ])
    x = counted.select(*SESSION_KEYS, "n", F.explode(levels).alias("l"))
    return x.select(*SESSION_KEYS, F.col("l.window_end").alias("window_end"),
                    *[F.when(F.col("l.lvl") == lbl, F.col("n")).alias(f"events_{lbl}") for lbl in WINDOWS])


def cardinality_rows(counted: DataFrame, exact: bool) -> DataFrame:
    """F4 from cells."""
    how = F.count_distinct if exact else F.approx_count_distinct
    return counted.groupBy(*SESSION_KEYS).agg(F.max("last_ts").alias("window_end"), *[how(c).alias(c) for c in DISTINCT_FIELDS])


def session_sums(events: DataFrame, *typing: Column) -> DataFrame:
    """Per session: last signal, mouse sum ``ms`` and count ``mn``, last typing signal, ``typing`` aggregates of ``t.cps``."""
    mouse_sum, mouse_n = _mouse_parts(events)
    rows = events.select(*SESSION_KEYS, "ts", mouse_sum.alias("ms"), mouse_n.alias("mn"),
                         F.transform(typed_speeds(events), lambda c: F.struct(c.alias("cps"))).alias("typed")) \
        .select(*SESSION_KEYS, "ts", "ms", "mn", F.posexplode_outer("typed").alias("pos", "t"))
    once = F.coalesce(F.col("pos"), F.lit(0)) == 0
    return rows.groupBy(*SESSION_KEYS).agg(
        F.max("ts").alias("last_ts"), F.sum(F.when(once, F.col("ms"))).alias("ms"),
        F.sum(F.when(once, F.col("mn"))).alias("mn"), *typing,
        F.max(F.when(F.col("t").isNotNull(), F.col("ts"))).alias("typing_end"))


def with_mouse_mean(sums: DataFrame) -> DataFrame:
    return sums.withColumn("mouse_entropy_avg", F.when(F.col("mn") > 0, F.col("ms") / F.col("mn"))).drop("ms", "mn")


def session_rollup(events: DataFrame) -> DataFrame:
    """One row per session with its last signal, mouse mean and typing features."""
    return with_mouse_mean(session_sums(events, *[how("t.cps").alias(name) for name, how in TYPING.items()]))


def _pad(df: DataFrame) -> DataFrame:
    have = set(df.columns)
    types = {"events_1m": "bigint", "events_5m": "bigint", "events_1h": "bigint",
             "distinct_fingerprints": "bigint", "distinct_ips": "bigint", "distinct_os": "bigint"}
    return df.select(*KEYS, *[F.col(c) if c in have else F.lit(None).cast(types.get(c, "double")).alias(c)
                              for c in FEATURE_VALUE_COLUMNS])


def build_feature_set(events: DataFrame, exact: bool = True, geo_bucket: str = "hour",
                      materialize: bool = True, geo_events: DataFrame | None = None) -> DataFrame:
    """F9 (union form). Same rows and values as full outer joins of the components.

    ``geo_events`` are the signals whose sessions count as prior ones (``events`` by default).

    ``materialize`` writes cells, session roll-up and geo starts once under the shared checkpoint
    folder, all at the same time; cells and roll-up feed two components each.
    """
    geo_events = events if geo_events is None else geo_events
    pieces = [lambda: cells(events), lambda: session_rollup(events)]
    if materialize and not events.isStreaming:
        names = ("signal-cells", "session-rollup")
        counted, sessions, geo = together(
            events.sparkSession, *[lambda n=n, p=p: checkpoint_table(p(), n) for n, p in zip(names, pieces)],
            lambda: geo_distance_vs_prior(geo_events, geo_bucket))
    else:
        (counted, sessions), geo = [p() for p in pieces], geo_distance_vs_prior(geo_events, geo_bucket)
    return merge_components(counted, sessions, geo, exact)


def merge_components(counted: DataFrame, sessions: DataFrame, geo: DataFrame, exact: bool = True) -> DataFrame:
    """F9 rows from cells (a cell may come in several rows), session roll-up and prior-session distances."""
    mouse = sessions.select(*SESSION_KEYS, F.col("last_ts").alias("window_end"), "mouse_entropy_avg")
    typing = sessions.filter(F.col("typing_end").isNotNull()).select(
        *SESSION_KEYS, F.col("typing_end").alias("window_end"), *TYPING)
    parts = [velocity_rows(counted), cardinality_rows(counted, exact), mouse, typing, geo]
    rows = reduce(DataFrame.unionByName, [_pad(p) for p in parts])
    merged = rows.groupBy(*KEYS).agg(*[
        (F.sum(c) if c.startswith("events_") else F.max(c)).alias(c) for c in FEATURE_VALUE_COLUMNS])
    return merged.select(*KEYS, F.lit(FEATURE_WINDOW).alias("feature_window"), *FEATURE_VALUE_COLUMNS)
