"""Feature operators (set v1), each ``DataFrame -> DataFrame`` over SIGNAL rows.

Inputs carry ``event_id, tenant_id, session_id, ts, device, behavioral``.
Outputs are keyed by ``(tenant_id, session_id, window_end)``. All work is
built-in expressions and declarative aggregates: partial (map-side) aggregation
before every shuffle, no Python in the row path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalspark.functions.geo import haversine_km
from signalspark.functions.windows import window_end, window_label
from signalspark.operators.ordered import bucketed_lag

WATERMARK = "10 minutes"
SESSION_KEYS = ["tenant_id", "session_id"]


def _watermarked(events: DataFrame, delay: str = WATERMARK) -> DataFrame:
    # a watermark only means something on a stream; on a batch it is a no-op
    return events.withWatermark("ts", delay) if events.isStreaming else events


def explode_behavioral(events: DataFrame) -> DataFrame:
    """one row per behavioral element; NULL or empty array -> one row, ``b`` NULL."""
    return events.withColumn("b", F.explode_outer("behavioral")).drop("behavioral")


def velocity_counts(events: DataFrame, window: str) -> DataFrame:
    """signals per (tenant, session, tumbling window); ``window_end`` = window end.

    In batch the window is plain arithmetic on the time; a stream groups by the window
    struct, which carries the watermark that closes its state.
    """
    label = f"events_{window_label(window)}"
    if not events.isStreaming:
        return events.groupBy(*SESSION_KEYS, window_end("ts", window).alias("window_end")).agg(
            F.count("*").alias(label))
    counted = _watermarked(events).groupBy(*SESSION_KEYS, F.window("ts", window).alias("span")).count()
    return counted.select(*SESSION_KEYS, counted["span.end"].alias("window_end"), counted["count"].alias(label))


#: distinct-count column -> device field
DISTINCT_FIELDS = {"distinct_fingerprints": "fingerprint", "distinct_ips": "ip", "distinct_os": "os"}


def device_ip_fp_cardinality(events: DataFrame, exact: bool = True) -> DataFrame:
    """distinct fingerprints, IPs and OS strings per session; ``window_end`` is its last signal.

    ``exact=True`` (default) counts exactly; ``exact=False`` uses HyperLogLog++,
    which is visibly wrong on tiny sets.
    """
    values = events.select(*SESSION_KEYS, "ts", *[F.col(f"device.{f}").alias(c) for c, f in DISTINCT_FIELDS.items()])
    how = F.count_distinct if exact else F.approx_count_distinct
    counted = values.groupBy(*SESSION_KEYS).agg(F.max("ts").alias("window_end"), *[how(c).alias(c) for c in DISTINCT_FIELDS])
    return counted.select(*SESSION_KEYS, *DISTINCT_FIELDS, "window_end")


def typed_speeds(events: DataFrame) -> Column:
    """The ``typing_cps`` of a signal's ``type`` elements; reads only these two leaves."""
    elements = F.arrays_zip(F.col("behavioral.kind").alias("kind"), F.col("behavioral.typing_cps").alias("cps"))
    return F.transform(F.filter(elements, lambda e: e["kind"] == "type"), lambda e: e["cps"])


#: typing feature -> aggregate over the speeds
TYPING = {"typing_cps_variance": F.var_samp, "typing_cps_mean": F.avg}


def typing_cadence_variance(events: DataFrame) -> DataFrame:
    """sample variance and mean of ``typing_cps`` over ``type`` elements.

    ``window_end`` = last signal carrying a type element; sessions without one
    are absent.
    """
    speeds = events.select(*SESSION_KEYS, F.col("ts").alias("window_end"), F.explode(typed_speeds(events)).alias("cps"))
    features = [how("cps").alias(name) for name, how in TYPING.items()]
    return speeds.groupBy(*SESSION_KEYS).agg(*features, F.max("window_end").alias("window_end"))


def _mouse_parts(events: DataFrame):
    ent = F.col("behavioral.mouse_entropy")
    s = F.aggregate(ent, F.lit(0.0), lambda acc, x: acc + F.coalesce(x, F.lit(0.0)))
    n = F.size(F.filter(ent, lambda x: x.isNotNull()))
    return F.coalesce(s, F.lit(0.0)), F.when(F.col("behavioral").isNotNull(), n).otherwise(F.lit(0))


def mouse_entropy_avg(events: DataFrame) -> DataFrame:
    """mean ``mouse_entropy`` over all elements of the session (NULLs ignored).

    Summed per signal inside the array first, so no explode is needed; a
    session without any value gets a row with NULL.
    """
    s, n = _mouse_parts(events)
    agg = events.select(*SESSION_KEYS, "ts", s.alias("_s"), n.alias("_n")).groupBy(*SESSION_KEYS).agg(
        F.sum("_s").alias("_s"), F.sum("_n").alias("_n"), F.max("ts").alias("window_end"))
    return agg.select(*SESSION_KEYS, F.when(F.col("_n") > 0, F.col("_s") / F.col("_n"))
                      .alias("mouse_entropy_avg"), "window_end")


def session_geo_starts(events: DataFrame) -> DataFrame:
    """Per session with geo: first geo time and the lat/lon of that signal."""
    geo = events.filter(F.col("device.geo_lat").isNotNull() & F.col("device.geo_lon").isNotNull())
    return geo.groupBy(*SESSION_KEYS).agg(
        F.min("ts").alias("session_start"),
        F.min_by(F.struct(F.col("device.geo_lat").alias("lat"), F.col("device.geo_lon").alias("lon")),
                 F.struct("ts", "event_id")).alias("_pt"),
    ).select(*SESSION_KEYS, "session_start", F.col("_pt.lat").alias("lat"), F.col("_pt.lon").alias("lon"))


def distance_to_prior(sessions: DataFrame, bucket: str = "hour", materialize: bool = False) -> DataFrame:
    """F8 second half: km from each session's first geo to the tenant's previous session.

    Previous = by ``(session_start, session_id)`` within the tenant, computed
    with :func:`bucketed_lag` so a large tenant never lands in one task.
    """
    prior = bucketed_lag(sessions, ["tenant_id"], ["session_start", "session_id"], ["lat", "lon"],
                         bucket=F.date_trunc(bucket, "session_start"), materialize=materialize)
    km = haversine_km("prior_lat", "prior_lon", "lat", "lon")
    return prior.withColumnRenamed("session_start", "window_end").withColumn("geo_distance_km_prior", km).drop(
        "lat", "lon", "prior_lat", "prior_lon")


def geo_distance_vs_prior(events: DataFrame, bucket: str = "hour") -> DataFrame:
    """F8: distance (km) from this session's first geo point to the prior session's."""
    return distance_to_prior(session_geo_starts(events), bucket, materialize=not events.isStreaming)
