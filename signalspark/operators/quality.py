"""Data-quality and operations operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalspark.schema import (  # noqa: F401  (re-exported for the SQL oracle)
    BEHAVIORAL_KINDS,
    HISTOGRAM_BOUNDS,
    MAX_ID_LEN,
    MAX_TARGET_ELEM_LEN,
    SCHEMA_VERSION,
    SIGNAL,
    STREAM_MAX_LEN,
)

# --- fixed values: operational alert thresholds ---
ERROR_RATE_ALERT = 0.005
DUPLICATE_RATIO_ALERT = 0.05
OPS_WINDOW = "5 minutes"
IPV4 = r"^((25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])$"
# --- end of fixed values ---


def fixed_histogram(df: DataFrame, value: Column | str, bounds: Sequence[float] = HISTOGRAM_BOUNDS,
                    by: Sequence[str] = ("tenant_id",)) -> DataFrame:
    """Cumulative counts ``v <= le`` per bound plus ``+Inf`` (``le`` NULL), ``sum``, ``count``.

    One aggregate with one conditional sum per bound (partial aggregation
    before the shuffle), then unpivoted to one row per bound.
    """
    v = F.col(value) if isinstance(value, str) else value
    x = df.select(*by, v.alias("_v")).filter(F.col("_v").isNotNull())
    aggs = [F.sum(F.when(F.col("_v") <= F.lit(float(b)), 1).otherwise(0)).alias(f"_b{i}")
            for i, b in enumerate(bounds)]
    wide = x.groupBy(*by).agg(*aggs, F.count(F.lit(1)).alias("_n"), F.sum("_v").alias("_s"))
    rows = F.array(*[F.struct(F.lit(float(b)).alias("le"), F.col(f"_b{i}").alias("cum_count"))
                     for i, b in enumerate(bounds)],
                   F.struct(F.lit(None).cast("double").alias("le"), F.col("_n").alias("cum_count")))
    return wide.select(*by, F.inline(rows), F.col("_s").alias("sum"))


def _len_bad(c: Column, lo: int, hi: int) -> Column:
    return c.isNotNull() & ((F.length(c) < lo) | (F.length(c) > hi))


def contract_violations(signals: DataFrame, sig: str | None = None) -> Column:
    """``array<string>`` of published-contract violations of one signal.

    Violations are reported, not dropped: minor versions may add enum values
    that consumers must tolerate.
    """
    s = (lambda f: F.col(f"{sig}.{f}")) if sig else F.col
    d = lambda f: s("device")[f]
    kinds = F.array(*[F.lit(k) for k in BEHAVIORAL_KINDS])
    beh = s("behavioral")
    checks = [
        (s("event_id").isNull(), "event_id_required"),
        (_len_bad(s("event_id"), 1, MAX_ID_LEN), "event_id_length"),
        (s("session_id").isNull(), "session_id_required"),
        (_len_bad(s("session_id"), 1, MAX_ID_LEN), "session_id_length"),
        (s("ts").isNull(), "ts_required"),
        (s("device").isNull(), "device_required"),
        (d("battery").isNotNull() & ((d("battery") < 0) | (d("battery") > 1)), "battery_range"),
        (d("geo_lat").isNotNull() & (F.abs(d("geo_lat")) > 90), "geo_lat_range"),
        (d("geo_lon").isNotNull() & (F.abs(d("geo_lon")) > 180), "geo_lon_range"),
        (d("ip").isNotNull() & ~d("ip").rlike(IPV4), "ip_format"),
        (F.exists(beh, lambda b: b["kind"].isNull()), "kind_required"),
        (F.exists(beh, lambda b: b["kind"].isNotNull() & ~F.array_contains(kinds, b["kind"])), "kind_enum"),
        (F.exists(beh, lambda b: b["dwell_ms"] < 0), "dwell_ms_negative"),
        (F.exists(beh, lambda b: b["typing_cps"] < 0), "typing_cps_negative"),
        (F.exists(beh, lambda b: b["mouse_entropy"] < 0), "mouse_entropy_negative"),
        (F.exists(beh, lambda b: F.length(b["target_elem"]) > MAX_TARGET_ELEM_LEN), "target_elem_length"),
    ]
    arr = F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for c, name in checks])
    return F.filter(arr, lambda x: x.isNotNull())


def ops_rates(classified: DataFrame, window: str = OPS_WINDOW, time_col: str = "ingest_ts") -> DataFrame:
    """Per tenant and tumbling window: volume, rejected and duplicate shares, alert flags.

    ``rejected`` counts every outcome other than accepted and duplicate.
    """
    o = F.col("outcome")
    agg = classified.groupBy(F.col("tenant_id_hint").alias("tenant_id"),
                             F.window(time_col, window).alias("w")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(~o.isin("accepted", "duplicate"), 1).otherwise(0)).alias("rejected"),
        F.sum(F.when(o == "duplicate", 1).otherwise(0)).alias("duplicates"))
    return agg.select(
        "tenant_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        "n", "rejected", "duplicates",
        (F.col("rejected") / F.col("n")).alias("reject_rate"),
        (F.col("duplicates") / F.col("n")).alias("duplicate_ratio"),
        ((F.col("rejected") / F.col("n")) > ERROR_RATE_ALERT).alias("reject_alert"),
        ((F.col("duplicates") / F.col("n")) > DUPLICATE_RATIO_ALERT).alias("duplicate_alert"))


def version_share(df: DataFrame, version_col: str = "schema_version", by: Sequence[str] = ()) -> DataFrame:
    """Traffic per schema version and its share (cut over when the old one is < 1 %).

    The share divides by a total over a tiny aggregated frame (one row per
    version), so the unpartitioned window holds only that.
    """
    v = F.coalesce(F.col(version_col), F.lit(SCHEMA_VERSION)) if version_col in df.columns \
        else F.lit(SCHEMA_VERSION)
    counts = df.groupBy(*by, v.alias("schema_version")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(*by)) if by else F.sum("n").over(Window.partitionBy())
    return counts.withColumn("share", F.col("n") / total)


def unified_versions(*frames: DataFrame, schema=SIGNAL) -> DataFrame:
    """Union frames of different schema versions by name, project to one schema."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.select(*[F.col(x.name).cast(x.dataType).alias(x.name) if x.name in out.columns
                        else F.lit(None).cast(x.dataType).alias(x.name) for x in schema.fields])


def retain_last_n(df: DataFrame, n: int = STREAM_MAX_LEN, by: Sequence[str] = ("stream",),
                  order: Sequence[str] = ("ingest_ts", "entry_id"), slice_unit: str = "minute") -> DataFrame:
    """Keep the newest ``n`` entries per stream (exact; the original trim is approximate).

    ``order`` starts with the time. Entries are counted per (stream, time slice) with
    map-side combine; slices are kept whole from the newest on, and only the one slice
    that the limit cuts is ranked. No stream meets in one task, whatever ``n`` is.
    """
    cols, at = list(by), F.date_trunc(slice_unit, order[0]).alias("_slice")
    counts = df.groupBy(*cols, at).agg(F.count(F.lit(1)).alias("_n"))
    newest = Window.partitionBy(*cols).orderBy(F.col("_slice").desc())
    before = F.coalesce(F.sum("_n").over(newest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    kept = counts.withColumn("_before", before).filter(F.col("_before") < n).select(
        *[F.col(c).alias(f"_k_{c}") for c in cols], F.col("_slice").alias("_k_slice"), "_before",
        (F.col("_before") + F.col("_n") <= n).alias("_whole"))
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in cols] + [F.col("_slice").eqNullSafe(F.col("_k_slice"))]
    rows = df.withColumn("_slice", at).join(kept, same)
    rank = F.row_number().over(Window.partitionBy(*cols, "_slice").orderBy(*[F.col(c).desc() for c in order]))
    cut = rows.filter(~F.col("_whole")).withColumn("_rn", rank).filter(F.col("_rn") <= F.lit(n) - F.col("_before"))
    return rows.filter("_whole").select(df.columns).unionByName(cut.select(df.columns))
