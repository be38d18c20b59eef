"""Registered queries (Spark) and their independent DuckDB oracle SQL.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame computed from the
given tables. Computed doubles are rounded to 6 places on both sides so the
order of floating additions cannot change a hash.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalspark.functions.geo import haversine_sql
from signalspark.functions.windows import WINDOWS, window_end_sql
from signalspark.operators import alerts as al
from signalspark.operators import dedup as dd
from signalspark.operators import emit as em
from signalspark.operators import features as fx
from signalspark.operators import ingest as ing
from signalspark.operators import quality as ql
from signalspark.operators import quota as qa
from signalspark.operators import sessions as sx
from signalspark.operators import versions as vs
from signalspark.plans import backfill as bf
from signalspark.plans import feature_set as fs
from signalspark.schema import LANDED
from signalspark.session import checkpoint_table, ensure_utc, work_dir
from signalspark.sources import feature_store as store
from signalspark.sources import guarded as gd
from signalspark.sources import landing as land
from signalspark.sources.events import BASE_US, load_signals, with_signals
from signalspark.sources.raw import TS_FORMAT as RAW_TS_FORMAT
from signalspark.sources.raw import entries_sql, load_raw, raw_from_records, raw_partitions, read_raw_files, write_raw_files
from signalspark.sources.replay import replay_quarantine
from signalspark.streaming import feature_state as fstate
from signalspark.streaming import features as sf
from signalspark.streaming.admission import finish_landing, start_bounded_landing
from signalspark.streaming.emit import start_emit
from signalspark.streaming.guard import quota_stateful, replay_guard_stateful
from signalspark.streaming.landing import start_landing, start_outcome_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run
    return deco


def round6(c) -> "F.Column":
    """Round half away from zero at 6 places via a 12-place decimal.

    Going through the decimal first makes the result independent of the last
    bits of the double, which differ with the order of floating additions.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.try_cast("decimal(38,12)"), 6).cast("double")


def r6(expr: str) -> str:
    """DuckDB text for :func:`round6`."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,12)), 6) AS DOUBLE)"


def round_doubles(df: DataFrame) -> DataFrame:
    return df.select(*[round6(c).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_signals(spark, sf_dir)


# ---------------------------------------------------------------- features --

def _velocity_sql(label: str) -> str:
    return with_signals(f"""
SELECT tenant_id, session_id, {window_end_sql('ts', WINDOWS[label])} AS window_end, count(*) AS events_{label}
FROM sig GROUP BY 1, 2, 3""")


for _lbl in WINDOWS:
    def _make(lbl):
        @query(f"velocity_{lbl}", _velocity_sql(lbl))
        def _q(spark, sf_dir):
            """signals per session and tumbling window."""
            return fx.velocity_counts(signals(spark, sf_dir), WINDOWS[lbl])
    _make(_lbl)


@query("explode_behavioral", with_signals("""
SELECT s.event_id, s.tenant_id, s.session_id, s.ts, b.kind, b.dwell_ms, b.typing_cps, b.mouse_entropy,
       CAST(NULL AS VARCHAR) AS target_elem
FROM sig s LEFT JOIN beh b ON s.event_id = b.event_id"""))
def q_explode(spark, sf_dir):
    """one row per behavioral element (explode_outer), element fields flattened."""
    x = fx.explode_behavioral(signals(spark, sf_dir))
    return x.select("event_id", "tenant_id", "session_id", "ts", "b.kind", "b.dwell_ms", "b.typing_cps",
                    "b.mouse_entropy", "b.target_elem")


_CARD_SQL = """
SELECT tenant_id, session_id, count(DISTINCT fingerprint) AS distinct_fingerprints,
       count(DISTINCT ip) AS distinct_ips, count(DISTINCT os) AS distinct_os, max(ts) AS window_end
FROM sig GROUP BY 1, 2"""


@query("cardinality_exact", with_signals(_CARD_SQL))
def q_card(spark, sf_dir):
    """exact distinct fingerprint / ip / os per session."""
    return fx.device_ip_fp_cardinality(signals(spark, sf_dir), exact=True)


@query("cardinality_approx")
def q_card_approx(spark, sf_dir):
    """F4 with HyperLogLog++ (the original job's estimator); rows-only check."""
    return fx.device_ip_fp_cardinality(signals(spark, sf_dir), exact=False)


_TYPING_SQL = f"""
SELECT tenant_id, session_id, {r6('var_samp(typing_cps)')} AS typing_cps_variance,
       {r6('avg(typing_cps)')} AS typing_cps_mean, max(ts) AS window_end
FROM beh WHERE kind = 'type' GROUP BY 1, 2"""


@query("typing_cadence", with_signals(_TYPING_SQL))
def q_typing(spark, sf_dir):
    """typing-cadence variance and mean per session."""
    return round_doubles(fx.typing_cadence_variance(signals(spark, sf_dir)))


_MOUSE_SQL = f"""
SELECT s.tenant_id, s.session_id, {r6('avg(b.mouse_entropy)')} AS mouse_entropy_avg, max(s.ts) AS window_end
FROM sig s LEFT JOIN beh b ON s.event_id = b.event_id GROUP BY 1, 2"""


@query("mouse_entropy", with_signals(_MOUSE_SQL))
def q_mouse(spark, sf_dir):
    """mean mouse entropy per session."""
    return round_doubles(fx.mouse_entropy_avg(signals(spark, sf_dir)))


_GEO_CTES = f"""
, gs AS (
  SELECT tenant_id, session_id, min(ts) AS session_start, arg_min(geo_lat, ts) AS lat, arg_min(geo_lon, ts) AS lon
  FROM sig WHERE geo_lat IS NOT NULL AND geo_lon IS NOT NULL GROUP BY 1, 2
), gp AS (
  SELECT *, lag(lat) OVER w AS prior_lat, lag(lon) OVER w AS prior_lon
  FROM gs WINDOW w AS (PARTITION BY tenant_id ORDER BY session_start, session_id)
), geo AS (
  SELECT tenant_id, session_id, session_start AS window_end, lat, lon, prior_lat, prior_lon,
         {r6(haversine_sql('prior_lat', 'prior_lon', 'lat', 'lon'))} AS geo_distance_km_prior
  FROM gp
)"""


@query("geo_distance", with_signals(_GEO_CTES + """
SELECT tenant_id, session_id, window_end, geo_distance_km_prior FROM geo"""))
def q_geo(spark, sf_dir):
    """F7 + F8: km from each session's first geo point to the tenant's prior session."""
    return round_doubles(fx.geo_distance_vs_prior(signals(spark, sf_dir)))


@query("haversine_prior", with_signals(_GEO_CTES + """
SELECT tenant_id, session_id, window_end AS session_start, lat, lon, prior_lat, prior_lon, geo_distance_km_prior
FROM geo"""))
def q_haversine_prior(spark, sf_dir):
    """F7 inputs and output: first geo point, prior session's point, great-circle km."""
    from signalspark.functions.geo import haversine_km
    from signalspark.operators.ordered import bucketed_lag
    s = fx.session_geo_starts(signals(spark, sf_dir))
    p = bucketed_lag(s, ["tenant_id"], ["session_start", "session_id"], ["lat", "lon"],
                     bucket=F.date_trunc("hour", "session_start"), materialize=True)
    return round_doubles(p.select("tenant_id", "session_id", "session_start", "lat", "lon", "prior_lat",
                                  "prior_lon", haversine_km("prior_lat", "prior_lon", "lat", "lon")
                                  .alias("geo_distance_km_prior")))


def feature_set_ctes(sig: str = "sig", beh: str = "beh", p: str = "") -> str:
    """DuckDB CTEs ending in ``{p}fs``: the feature set as six full outer joins over ``sig``/``beh``."""
    vel = "".join(f"""
, {p}v{lbl} AS (SELECT tenant_id, session_id, {window_end_sql('ts', WINDOWS[lbl])} AS window_end,
                  count(*) AS events_{lbl} FROM {sig} GROUP BY 1, 2, 3)""" for lbl in WINDOWS)
    return vel + f"""
, {p}card AS (
  SELECT tenant_id, session_id, count(DISTINCT fingerprint) AS distinct_fingerprints,
         count(DISTINCT ip) AS distinct_ips, count(DISTINCT os) AS distinct_os, max(ts) AS window_end
  FROM {sig} GROUP BY 1, 2
), {p}typ AS (
  SELECT tenant_id, session_id, {r6('var_samp(typing_cps)')} AS typing_cps_variance,
         {r6('avg(typing_cps)')} AS typing_cps_mean, max(ts) AS window_end
  FROM {beh} WHERE kind = 'type' GROUP BY 1, 2
), {p}mou AS (
  SELECT s.tenant_id, s.session_id, {r6('avg(b.mouse_entropy)')} AS mouse_entropy_avg, max(s.ts) AS window_end
  FROM {sig} s LEFT JOIN {beh} b ON s.event_id = b.event_id GROUP BY 1, 2
), {p}gs AS (
  SELECT tenant_id, session_id, min(ts) AS session_start, arg_min(geo_lat, ts) AS lat, arg_min(geo_lon, ts) AS lon
  FROM {sig} WHERE geo_lat IS NOT NULL AND geo_lon IS NOT NULL GROUP BY 1, 2
), {p}gp AS (
  SELECT *, lag(lat) OVER w AS prior_lat, lag(lon) OVER w AS prior_lon
  FROM {p}gs WINDOW w AS (PARTITION BY tenant_id ORDER BY session_start, session_id)
), {p}g AS (
  SELECT tenant_id, session_id, session_start AS window_end,
         {r6(haversine_sql('prior_lat', 'prior_lon', 'lat', 'lon'))} AS geo_distance_km_prior
  FROM {p}gp
), {p}fs AS (
  SELECT tenant_id, session_id, window_end, 'session' AS feature_window,
         events_1m, events_5m, events_1h, distinct_fingerprints, distinct_ips, distinct_os,
         typing_cps_variance, typing_cps_mean, mouse_entropy_avg, geo_distance_km_prior
  FROM {p}v1m
  FULL OUTER JOIN {p}v5m USING (tenant_id, session_id, window_end)
  FULL OUTER JOIN {p}v1h USING (tenant_id, session_id, window_end)
  FULL OUTER JOIN {p}card USING (tenant_id, session_id, window_end)
  FULL OUTER JOIN {p}typ USING (tenant_id, session_id, window_end)
  FULL OUTER JOIN {p}mou USING (tenant_id, session_id, window_end)
  FULL OUTER JOIN {p}g USING (tenant_id, session_id, window_end)
)"""


def _feature_set_sql() -> str:
    return with_signals(feature_set_ctes() + " SELECT * FROM fs")


@query("feature_set", _feature_set_sql())
def q_feature_set(spark, sf_dir):
    """all components merged per (tenant, session, window_end)."""
    return round_doubles(fs.build_feature_set(signals(spark, sf_dir)))


# ------------------------------------------------------------------ ingest --



def _ingest_sql(body: str) -> str:
    return with_signals(entries_sql() + body, recursive=True)


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dd.apply_guard(ing.classify(load_raw(spark, sf_dir)))


@query("session_aggregates", with_signals("""
, o AS (
  SELECT tenant_id, session_id, ts, fingerprint,
         CASE WHEN ts - lag(ts) OVER w > INTERVAL 10 MINUTE OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS brk
  FROM sig WINDOW w AS (PARTITION BY tenant_id, session_id ORDER BY ts)
), g AS (
  SELECT *, sum(brk) OVER (PARTITION BY tenant_id, session_id ORDER BY ts
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM o
)
SELECT tenant_id, session_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS event_count,
       count(DISTINCT fingerprint) AS distinct_fingerprints
FROM g GROUP BY tenant_id, session_id, grp"""))
def q_sessions(spark, sf_dir):
    """gap sessions (10 minutes), count, bounds, distinct fingerprints."""
    return sx.session_aggregates(signals(spark, sf_dir))


_GOOD_COLS = ["event_id", "tenant_id", "session_id", "ts", "dt", "os", "ip", "fingerprint", "battery",
              "geo_lat", "geo_lon", "n_behavioral"]


@query("parse_good", _ingest_sql("""
SELECT event_id, tenant_id, session_id, eff_ts AS ts, CAST(eff_ts AS DATE) AS dt,
       json_extract_string(obj, '$.device.os') AS os, json_extract_string(obj, '$.device.ip') AS ip,
       json_extract_string(obj, '$.device.fingerprint') AS fingerprint,
       CAST(json_extract_string(obj, '$.device.battery') AS DOUBLE) AS battery,
       CAST(json_extract_string(obj, '$.device.geo_lat') AS DOUBLE) AS geo_lat,
       CAST(json_extract_string(obj, '$.device.geo_lon') AS DOUBLE) AS geo_lon,
       CASE WHEN json_type(obj, '$.behavioral') = 'ARRAY'
            THEN CAST(json_array_length(obj, '$.behavioral') AS INTEGER) END AS n_behavioral
FROM ent WHERE v_outcome = 'accepted'"""))
def q_parse_good(spark, sf_dir):
    """V1-V13 + V2: rows that pass every edge rule, as landed (SIGNAL + dt)."""
    good, _ = ing.parse_and_split(load_raw(spark, sf_dir))
    return good.select("event_id", "tenant_id", "session_id", "ts", "dt", "device.os", "device.ip",
                       "device.fingerprint", "device.battery", "device.geo_lat", "device.geo_lon",
                       F.size("behavioral").alias("n_behavioral"))


@query("parse_bad", _ingest_sql("""
SELECT tenant_id AS tenant_id_hint, v_reason AS reason, ingest_ts FROM ent WHERE v_outcome <> 'accepted'"""))
def q_parse_bad(spark, sf_dir):
    """V2 + V5: quarantined rows with the reason (raw text and quarantine time not compared)."""
    _, bad = ing.parse_and_split(load_raw(spark, sf_dir))
    return bad.select("tenant_id_hint", "reason", "ingest_ts")


@query("validate_errors", _ingest_sql("""
SELECT stream, entry_id, v_reason AS reason FROM ent WHERE v_outcome = 'invalid_signal'"""))
def q_validate_errors(spark, sf_dir):
    """V6 + V7: required fields and clock skew, in the edge's precedence."""
    c = ing.classify(load_raw(spark, sf_dir))
    return c.filter(F.col("outcome") == "invalid_signal").select("stream", "entry_id", "reason")


@query("unknown_fields", _ingest_sql("""
SELECT stream, entry_id FROM ent WHERE v_reason = 'unknown_field'"""))
def q_unknown_fields(spark, sf_dir):
    """Payloads with a key outside the contract at any level."""
    c = ing.classify(load_raw(spark, sf_dir))
    return c.filter(F.col("reason") == "unknown_field").select("stream", "entry_id")


@query("outcomes", _ingest_sql("""
SELECT stream, entry_id, outcome FROM outc"""))
def q_outcomes(spark, sf_dir):
    """One outcome per raw entry, replay guard included."""
    return classified(spark, sf_dir).select("stream", "entry_id", "outcome")


@query("outcome_counts", _ingest_sql("""
SELECT tenant_id, outcome, count(*) AS n FROM outc GROUP BY 1, 2"""))
def q_outcome_counts(spark, sf_dir):
    """Entries per (tenant, outcome)."""
    return ing.outcome_counts(classified(spark, sf_dir))


@query("replay_guard", _ingest_sql("""
SELECT gr.tenant_id, gr.event_id, gr.entry_id, ge.ingest_ts, gr.first_seen
FROM gr JOIN ge ON gr.entry_id = ge.entry_id AND gr.tenant_id = ge.tenant_id"""))
def q_replay_guard(spark, sf_dir):
    """First (tenant, event_id) wins for 24 h; TTL not refreshed by duplicates."""
    c = ing.classify(load_raw(spark, sf_dir)).filter(F.col("outcome") == "accepted")
    e = c.select(F.col("sig.tenant_id").alias("tenant_id"), F.col("sig.event_id").alias("event_id"),
                 "entry_id", "ingest_ts")
    return dd.replay_guard(e)


QUOTA_RPS, QUOTA_BURST = 0.02, 3.0


@query("quota_admission", _ingest_sql(f"""
, ps AS (
  SELECT tenant_id, CAST(floor(epoch_us(ingest_ts) / 1000000) AS BIGINT) AS sec, count(*) AS n
  FROM ent GROUP BY 1, 2
), po AS (
  SELECT *, row_number() OVER (PARTITION BY tenant_id ORDER BY sec) AS rn FROM ps
), qr AS (
  SELECT tenant_id, rn, sec, n, CAST(least(n, floor({QUOTA_BURST}::DOUBLE)) AS BIGINT) AS admitted,
         {QUOTA_BURST}::DOUBLE - least(n, floor({QUOTA_BURST}::DOUBLE)) AS tokens
  FROM po WHERE rn = 1
  UNION ALL
  SELECT po.tenant_id, po.rn, po.sec, po.n,
         CAST(least(po.n, floor(least({QUOTA_BURST}::DOUBLE, qr.tokens + (po.sec - qr.sec) * {QUOTA_RPS}::DOUBLE)))
              AS BIGINT),
         least({QUOTA_BURST}::DOUBLE, qr.tokens + (po.sec - qr.sec) * {QUOTA_RPS}::DOUBLE)
           - least(po.n, floor(least({QUOTA_BURST}::DOUBLE, qr.tokens + (po.sec - qr.sec) * {QUOTA_RPS}::DOUBLE)))
  FROM qr JOIN po ON po.tenant_id = qr.tenant_id AND po.rn = qr.rn + 1
)
SELECT tenant_id, sec, n, admitted FROM qr"""))
def q_quota(spark, sf_dir):
    """Token bucket per tenant at 1 s grain (rate 0.02/s, capacity 3, so it binds)."""
    raw = load_raw(spark, sf_dir).withColumn("tenant_id", ing.tenant_hint("stream"))
    return qa.per_second_admission(raw, QUOTA_RPS, QUOTA_BURST)


_QUOTA_CTES = """
, ps AS (
  SELECT tenant_id, CAST(floor(epoch_us(ingest_ts) / 1000000) AS BIGINT) AS sec, count(*) AS n
  FROM ent GROUP BY 1, 2
), po AS (
  SELECT *, row_number() OVER (PARTITION BY tenant_id ORDER BY sec) AS rn FROM ps
), qr AS (
  SELECT tenant_id, rn, sec, n, CAST(least(n, floor(%(burst)s::DOUBLE)) AS BIGINT) AS admitted,
         %(burst)s::DOUBLE - least(n, floor(%(burst)s::DOUBLE)) AS tokens
  FROM po WHERE rn = 1
  UNION ALL
  SELECT po.tenant_id, po.rn, po.sec, po.n,
         CAST(least(po.n, floor(least(%(burst)s::DOUBLE, qr.tokens + (po.sec - qr.sec) * %(rps)s::DOUBLE)))
              AS BIGINT),
         least(%(burst)s::DOUBLE, qr.tokens + (po.sec - qr.sec) * %(rps)s::DOUBLE)
           - least(po.n, floor(least(%(burst)s::DOUBLE, qr.tokens + (po.sec - qr.sec) * %(rps)s::DOUBLE)))
  FROM qr JOIN po ON po.tenant_id = qr.tenant_id AND po.rn = qr.rn + 1
)
"""


@query("quota_requests", _ingest_sql(_QUOTA_CTES % {"burst": QUOTA_BURST, "rps": QUOTA_RPS} + """
, rq AS (
  SELECT entry_id, tenant_id, ingest_ts, CAST(floor(epoch_us(ingest_ts) / 1000000) AS BIGINT) AS sec,
         row_number() OVER (PARTITION BY tenant_id, CAST(floor(epoch_us(ingest_ts) / 1000000) AS BIGINT)
                            ORDER BY ingest_ts, entry_id) AS rk
  FROM ent
)
SELECT rq.tenant_id, rq.entry_id, rq.rk <= qr.admitted AS admitted
FROM rq JOIN qr ON rq.tenant_id = qr.tenant_id AND rq.sec = qr.sec"""))
def q_quota_requests(spark, sf_dir):
    """V18 per request: the first ``admitted`` requests of each tenant-second pass, the rest are
    rate limited (the rank is cut at the bucket capacity before the shuffle)."""
    raw = load_raw(spark, sf_dir).withColumn("tenant_id", ing.tenant_hint("stream"))
    return qa.quota_admission(raw, QUOTA_RPS, QUOTA_BURST).select("tenant_id", "entry_id", "admitted")


# ------------------------------------------------- landing, store and emit --


STREAM_TIMEOUT_S = 600


def _raw_files(spark: SparkSession, sf_dir: str, path: str, files: int, rows: DataFrame | None = None) -> int:
    """Write the fixture (or some ``rows`` of it) as ``files`` times as many raw files as the number returned."""
    share = max(1, raw_partitions(spark, sf_dir) // files)
    write_raw_files(load_raw(spark, sf_dir) if rows is None else rows, path, files, share)
    return share


def _landed(spark: SparkSession, sf_dir: str) -> str:
    """Land the raw fixture once (batch path) and return the landed table path."""
    root = work_dir(spark, "landed")
    land.land_batch(load_raw(spark, sf_dir), f"{root}/landed", f"{root}/bad", batch_id="fixture")
    return root


_LANDED_COUNTS_SQL = _ingest_sql("""
SELECT tenant_id, CAST(eff_ts AS DATE) AS dt, count(*) AS n FROM ent WHERE v_outcome = 'accepted' GROUP BY 1, 2""")


@query("landed_counts_by_partition", _LANDED_COUNTS_SQL)
def q_landed_counts(spark, sf_dir):
    """S5 + S1: land good rows partitioned by tenant_id/dt, read back with the explicit schema."""
    root = _landed(spark, sf_dir)
    return land.read_landed(spark, f"{root}/landed").groupBy("tenant_id", "dt").agg(F.count(F.lit(1)).alias("n"))


@query("quarantine_replay", _ingest_sql("""
SELECT tenant_id AS tenant_id_hint, v_reason AS reason, v_outcome AS outcome, count(*) AS n
FROM ent WHERE v_outcome <> 'accepted' GROUP BY 1, 2, 3"""))
def q_quarantine_replay(spark, sf_dir):
    """S6 + V23: read the JSON quarantine back and classify the kept raw text again."""
    root = _landed(spark, sf_dir)
    bad = land.read_quarantine(spark, f"{root}/bad")
    again = ing.classify(bad.select(
        F.concat(F.lit("di:signals:"), "tenant_id_hint").alias("stream"), F.lit("q").alias("entry_id"),
        F.col("raw").alias("data"), "ingest_ts"))
    return again.groupBy("tenant_id_hint", F.col("reason").alias("reason"), "outcome") \
        .agg(F.count(F.lit(1)).alias("n")).select("tenant_id_hint", "reason", "outcome", "n")


@query("quarantine_replay_landed", _ingest_sql("""
SELECT 'landed' AS place, tenant_id, strftime(eff_ts, '%Y-%m-%d') AS what, count(*) AS n
FROM ent WHERE v_reason IN ('accepted', 'unknown_field') GROUP BY 2, 3
UNION ALL
SELECT 'quarantined', tenant_id, v_reason, count(*) FROM ent WHERE v_reason NOT IN ('accepted', 'unknown_field') GROUP BY 2, 3"""))
def q_quarantine_replay_landed(spark, sf_dir):
    """After a fix for the unknown key the quarantine is replayed, twice: recovered rows have landed once and
    left it, the others are still there."""
    root = _landed(spark, sf_dir)

    def fix(raw):
        return raw.withColumn("data", F.replace("data", F.lit(',"extra_field":1}'), F.lit("}")))

    for _ in range(2):
        replay_quarantine(spark, f"{root}/bad", f"{root}/landed", fix)
    landed = land.read_landed(spark, f"{root}/landed").select(
        F.lit("landed").alias("place"), "tenant_id", F.date_format("dt", "yyyy-MM-dd").alias("what"))
    left = land.read_quarantine(spark, f"{root}/bad").select(
        F.lit("quarantined").alias("place"), F.col("tenant_id_hint").alias("tenant_id"), F.col("reason").alias("what"))
    return landed.unionByName(left).groupBy("place", "tenant_id", "what").agg(F.count(F.lit(1)).alias("n"))


@query("stream_landing", _LANDED_COUNTS_SQL)
def q_stream_landing(spark, sf_dir):
    """File-source stream -> classify -> foreachBatch(landed, quarantine) with checkpoint."""
    root = work_dir(spark, "stream-landing")
    share = _raw_files(spark, sf_dir, f"{root}/raw", files=4)
    q = start_landing(read_raw_files(spark, f"{root}/raw", stream=True, max_files_per_trigger=2 * share),
                      f"{root}/landed", f"{root}/bad", f"{root}/_checkpoint")
    sf.run_to_end(q, STREAM_TIMEOUT_S)
    return land.read_landed(spark, f"{root}/landed").groupBy("tenant_id", "dt").agg(F.count(F.lit(1)).alias("n"))


@query("compacted_landing", _ingest_sql("""
SELECT tenant_id, CAST(eff_ts AS DATE) AS dt, event_id, eff_ts AS ts, count(*) AS n FROM ent WHERE v_outcome = 'accepted'
GROUP BY 1, 2, 3, 4"""))
def q_compacted_landing(spark, sf_dir):
    """Rows that a reader finds after many micro-batches, a compaction, the removal of what it replaced, more batches
    and a second compaction."""
    root, raw = work_dir(spark, "compacted"), load_raw(spark, sf_dir)
    arrived = F.xxhash64("entry_id") % 4 == 0
    for part, rows in (("first", raw.filter(~arrived)), ("second", raw.filter(arrived))):
        share = _raw_files(spark, sf_dir, f"{root}/raw-{part}", files=3, rows=rows)
        src = read_raw_files(spark, f"{root}/raw-{part}", stream=True, max_files_per_trigger=share)
        sf.run_to_end(start_landing(src, f"{root}/landed", f"{root}/bad", f"{root}/_checkpoint-{part}"), STREAM_TIMEOUT_S)
        land.compact_landed(spark, f"{root}/landed", keep=timedelta())
    return land.read_landed(spark, f"{root}/landed").groupBy("tenant_id", "dt", "event_id", "ts").agg(F.count(F.lit(1)).alias("n"))


@query("stream_bounded_landing", _ingest_sql("""
, bound AS (
  SELECT CAST(floor(max(c) / 4) AS BIGINT) + 1 AS most FROM (SELECT count(*) AS c FROM ent GROUP BY stream)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY stream ORDER BY ingest_ts, entry_id) AS rn FROM ent
)
SELECT tenant_id, CAST((rn - 1) // most AS BIGINT) + 1 AS tick, count(*) AS n
FROM placed, bound WHERE v_outcome = 'accepted' GROUP BY 1, 2"""))
def q_stream_bounded_landing(spark, sf_dir):
    """Rows landed by tick where a tick takes a quarter of the longest stream's entries, and no more, from every stream."""
    root = work_dir(spark, "stream-bounded")
    _raw_files(spark, sf_dir, f"{root}/raw", files=4)
    raw = read_raw_files(spark, f"{root}/raw")
    most = raw.groupBy("stream").count().agg(F.max("count")).first()[0] // 4 + 1
    paths = (f"{root}/landed", f"{root}/bad", f"{root}/_checkpoint")
    sf.run_to_end(start_bounded_landing(read_raw_files(spark, f"{root}/raw", stream=True), *paths, most), STREAM_TIMEOUT_S)
    finish_landing(spark, *paths, most)
    landed = spark.read.schema(land.LANDED_FILES).parquet(paths[0])
    return landed.groupBy("tenant_id", F.substring("batch_id", 12, 12).cast("long").alias("tick")).agg(F.count(F.lit(1)).alias("n"))


LANDING_START = "2024-01-01 06:00:00"


@query("stream_landing_from", _ingest_sql(f"""
SELECT tenant_id, CAST(eff_ts AS DATE) AS dt, count(*) AS n FROM ent
WHERE v_outcome = 'accepted' AND ingest_ts >= TIMESTAMP '{LANDING_START}' GROUP BY 1, 2"""))
def q_stream_landing_from(spark, sf_dir):
    """S3: stream landing from a start position; entries that arrived before it do not land."""
    root = work_dir(spark, "stream-landing-from")
    share = _raw_files(spark, sf_dir, f"{root}/raw", files=4)
    q = start_landing(read_raw_files(spark, f"{root}/raw", stream=True, max_files_per_trigger=2 * share), f"{root}/landed",
                      f"{root}/bad", f"{root}/_checkpoint", start_from=LANDING_START)
    sf.run_to_end(q, STREAM_TIMEOUT_S)
    return land.read_landed(spark, f"{root}/landed").groupBy("tenant_id", "dt").agg(F.count(F.lit(1)).alias("n"))


BROKEN_MOD = 19  # records of the fixture whose value starts with a byte that is no UTF-8


@query("record_reasons", _ingest_sql(f"""
SELECT stream, entry_id, CASE WHEN eid % {BROKEN_MOD} = 0 AND v_reason <> 'payload_too_large' THEN 'not_an_object'
                              ELSE v_reason END AS reason FROM ent"""))
def q_record_reasons(spark, sf_dir):
    """Entries as records of bytes (topic, partition, offset, value, timestamp), some of them no UTF-8, decoded
    with replacement and judged by the edge's rules."""
    number, copy = F.split_part("entry_id", F.lit("-"), F.lit(1)), F.split_part("entry_id", F.lit("-"), F.lit(2))
    value = F.encode("data", "UTF-8")
    records = load_raw(spark, sf_dir).select(
        F.col("stream").alias("topic"), number.cast("int").alias("partition"), copy.cast("long").alias("offset"),
        F.when(number.cast("long") % BROKEN_MOD == 0, F.concat(F.unhex(F.lit("FF")), value)).otherwise(value).alias("value"),
        F.col("ingest_ts").alias("timestamp"))
    return ing.classify(raw_from_records(records)).select("stream", "entry_id", "reason")


@query("wire_landed", _ingest_sql("""
SELECT event_id, tenant_id, eff_ts AS ts, coalesce(json_extract_string(obj, '$.device.os'), '') AS os,
       nullif(CAST(json_extract_string(obj, '$.device.battery') AS DOUBLE), 0) AS battery,
       nullif(CAST(json_extract_string(obj, '$.device.geo_lat') AS DOUBLE), 0) AS geo_lat,
       nullif(CAST(json_extract_string(obj, '$.device.geo_lon') AS DOUBLE), 0) AS geo_lon,
       nullif(CAST(json_extract_string(obj, '$.behavioral[0].dwell_ms') AS BIGINT), 0) AS dwell_ms,
       nullif(CAST(json_extract_string(obj, '$.behavioral[0].mouse_entropy') AS DOUBLE), 0) AS mouse_entropy
FROM ent WHERE v_outcome = 'accepted'"""))
def q_wire_landed(spark, sf_dir):
    """Landing with the wire's rule that zeros and empty optional texts are left out, read back."""
    root = work_dir(spark, "wire-landed")
    land.land_batch(load_raw(spark, sf_dir), f"{root}/landed", f"{root}/bad", batch_id="wire", wire_compat=True)
    first = F.get("behavioral", F.lit(0))
    return land.read_landed(spark, f"{root}/landed").select(
        "event_id", "tenant_id", "ts", "device.os", "device.battery", "device.geo_lat", "device.geo_lon",
        first["dwell_ms"].alias("dwell_ms"), first["mouse_entropy"].alias("mouse_entropy"))


def _signals_files(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """Signals written as landed files, then read back as a stream."""
    land.write_landed(signals(spark, sf_dir).withColumn("dt", F.to_date("ts")), f"{root}/landed", "signals")
    return sf.read_landed_stream(spark, f"{root}/landed")


@query("stream_velocity", with_signals(f"""
SELECT tenant_id, session_id, {window_end_sql('ts', '5 minutes')} AS window_end, count(*) AS events_5m
FROM sig GROUP BY 1, 2, 3
HAVING {window_end_sql('ts', '5 minutes')} <= (SELECT max(ts) FROM sig) - INTERVAL 10 MINUTE"""))
def q_stream_velocity(spark, sf_dir):
    """F2 on a stream: 5-minute counts, 10-minute watermark, closed windows appended."""
    root = work_dir(spark, "stream-velocity")
    q = sf.start_velocity(_signals_files(spark, sf_dir, root), WINDOWS["5m"], f"{root}/out", f"{root}/_ck")
    sf.run_to_end(q, STREAM_TIMEOUT_S)
    return spark.read.parquet(f"{root}/out")


@query("stream_sessions", with_signals("""
, o AS (
  SELECT tenant_id, session_id, ts, fingerprint,
         CASE WHEN ts - lag(ts) OVER w > INTERVAL 10 MINUTE OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS brk
  FROM sig WINDOW w AS (PARTITION BY tenant_id, session_id ORDER BY ts)
), g AS (
  SELECT *, sum(brk) OVER (PARTITION BY tenant_id, session_id ORDER BY ts
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM o
), a AS (
  SELECT tenant_id, session_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS event_count,
         count(DISTINCT fingerprint) AS distinct_fingerprints
  FROM g GROUP BY tenant_id, session_id, grp
)
SELECT * FROM a WHERE session_end + INTERVAL 10 MINUTE <= (SELECT max(ts) FROM sig) - INTERVAL 10 MINUTE"""))
def q_stream_sessions(spark, sf_dir):
    """F10 on a stream: session_window, 10-minute watermark, closed sessions appended."""
    root = work_dir(spark, "stream-sessions")
    q = sf.start_sessions(_signals_files(spark, sf_dir, root), f"{root}/out", f"{root}/_ck")
    sf.run_to_end(q, STREAM_TIMEOUT_S)
    return spark.read.parquet(f"{root}/out")


def _shuffled_signals(spark: SparkSession, sf_dir: str, root: str, batches: int = 3) -> DataFrame:
    """Signals in files that hold times of the whole day, so every micro-batch after the first one is late."""
    mixed = signals(spark, sf_dir).withColumn("dt", F.to_date("ts"))
    for i in range(batches):
        share = mixed.filter(F.pmod(F.xxhash64("event_id"), F.lit(batches)) == i)
        land.write_landed(share.coalesce(1), f"{root}/landed/share={i}", "signals")
    paths = f"{root}/landed/share=*/*/*/*"
    files_of = len(spark.read.schema(land.LANDED_FILES).parquet(paths).inputFiles())
    r = spark.readStream.schema(land.LANDED_FILES).option("maxFilesPerTrigger", max(1, -(-files_of // batches)))
    return r.option("basePath", f"{root}/landed").parquet(f"{root}/landed/share=*").select(*LANDED.fieldNames())


@query("stream_geo_distance", with_signals(_GEO_CTES + """
SELECT tenant_id, session_id, window_end, geo_distance_km_prior FROM geo"""))
def q_stream_geo(spark, sf_dir):
    """F8 on a stream: three micro-batches whose signals come in no order of time, then the rows as of the last one."""
    root = work_dir(spark, "stream-geo")
    sf.run_to_end(fstate.start_distances(_shuffled_signals(spark, sf_dir, root), f"{root}/state", f"{root}/_ck"), STREAM_TIMEOUT_S)
    return round_doubles(fstate.read_distances(spark, f"{root}/state"))


@query("stream_feature_set", _feature_set_sql())
def q_stream_feature_set(spark, sf_dir):
    """F9 on a stream: three micro-batches whose signals come in no order of time, upserted into the feature table."""
    root = work_dir(spark, "stream-features")
    events = _shuffled_signals(spark, sf_dir, root)
    sf.run_to_end(fstate.start_features(events, f"{root}/state", f"{root}/table", f"{root}/_ck"), STREAM_TIMEOUT_S)
    return round_doubles(store.read_features(spark, f"{root}/table").drop("dt"))


@query("stream_session_features", with_signals(f"""
, o AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER w > INTERVAL 10 MINUTE OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS brk
  FROM sig WINDOW w AS (PARTITION BY tenant_id, session_id ORDER BY ts)
), g AS (
  SELECT *, sum(brk) OVER (PARTITION BY tenant_id, session_id ORDER BY ts
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM o
), d AS (
  SELECT tenant_id, session_id, grp, min(ts) AS session_start, max(ts) AS session_end,
         count(DISTINCT fingerprint) AS distinct_fingerprints, count(DISTINCT ip) AS distinct_ips,
         count(DISTINCT os) AS distinct_os
  FROM g GROUP BY ALL
), e AS (
  SELECT g.tenant_id, g.session_id, grp, {r6("var_samp(CASE WHEN kind = 'type' THEN typing_cps END)")} AS typing_cps_variance,
         {r6("avg(CASE WHEN kind = 'type' THEN typing_cps END)")} AS typing_cps_mean, {r6("avg(mouse_entropy)")} AS mouse_entropy_avg
  FROM g LEFT JOIN beh b ON b.event_id = g.event_id GROUP BY ALL
)
SELECT d.tenant_id, d.session_id, session_start, session_end, distinct_fingerprints, distinct_ips, distinct_os,
       typing_cps_variance, typing_cps_mean, mouse_entropy_avg
FROM d JOIN e ON d.tenant_id = e.tenant_id AND d.session_id = e.session_id AND d.grp = e.grp
WHERE session_end + INTERVAL 10 MINUTE <= (SELECT max(ts) FROM sig) - INTERVAL 10 MINUTE"""))
def q_stream_session_features(spark, sf_dir):
    """F4-F6 on a stream: distinct devices, typing and mouse features of closed gap sessions."""
    root = work_dir(spark, "stream-session-features")
    q = sf.start_session_features(_signals_files(spark, sf_dir, root), f"{root}/out", f"{root}/_ck")
    sf.run_to_end(q, STREAM_TIMEOUT_S)
    return round_doubles(spark.read.parquet(f"{root}/out"))


@query("stream_outcome_counts", _ingest_sql("""
SELECT tenant_id, v_outcome AS outcome, count(*) AS n FROM ent GROUP BY 1, 2"""))
def q_stream_outcome_counts(spark, sf_dir):
    """V16 on a stream: complete-mode counters per (tenant, outcome), snapshot per micro-batch."""
    root = work_dir(spark, "stream-outcomes")
    share = _raw_files(spark, sf_dir, f"{root}/raw", files=4)
    q = start_outcome_counts(read_raw_files(spark, f"{root}/raw", stream=True, max_files_per_trigger=2 * share),
                             f"{root}/out", f"{root}/_ck")
    sf.run_to_end(q, STREAM_TIMEOUT_S)
    return spark.read.parquet(f"{root}/out")


@query("stream_replay_guard", _ingest_sql("""
SELECT gr.tenant_id, gr.event_id, gr.entry_id, ge.ingest_ts, gr.first_seen
FROM gr JOIN ge ON gr.entry_id = ge.entry_id AND gr.tenant_id = ge.tenant_id"""))
def q_stream_replay_guard(spark, sf_dir):
    """V14 on a stream, exact: the fold as applyInPandasWithState (one timestamp of state per key,
    event-time timeout after the TTL)."""
    root = work_dir(spark, "stream-guard")
    _raw_files(spark, sf_dir, f"{root}/raw", files=4)
    c = ing.classify(read_raw_files(spark, f"{root}/raw", stream=True)).filter(F.col("outcome") == "accepted")
    e = c.select(F.col("sig.tenant_id").alias("tenant_id"), F.col("sig.event_id").alias("event_id"),
                 "entry_id", "ingest_ts")
    q = sf.start_append(replay_guard_stateful(e), f"{root}/out", f"{root}/_ck")
    sf.run_to_end(q, STREAM_TIMEOUT_S)
    return spark.read.parquet(f"{root}/out")


@query("stream_quota", _ingest_sql(_QUOTA_CTES % {"burst": QUOTA_BURST, "rps": QUOTA_RPS} + """
SELECT tenant_id, sec, n, admitted FROM qr"""))
def q_stream_quota(spark, sf_dir):
    """V18 on a stream: the token bucket as a stateful fold per tenant (applyInPandasWithState)."""
    root = work_dir(spark, "stream-quota")
    _raw_files(spark, sf_dir, f"{root}/raw", files=4)
    raw = read_raw_files(spark, f"{root}/raw", stream=True).withColumn("tenant_id", ing.tenant_hint("stream"))
    q = sf.start_append(quota_stateful(raw, QUOTA_RPS, QUOTA_BURST), f"{root}/out", f"{root}/_ck")
    sf.run_to_end(q, STREAM_TIMEOUT_S)
    out = spark.read.parquet(f"{root}/out")
    return out.groupBy("tenant_id", "sec").agg(F.sum("n").alias("n"), F.sum("admitted").alias("admitted"))


BATCHES = 4


def _arrive(spark: SparkSession, sf_dir: str, path: str, in_order: bool) -> int:
    """Raw entries as JSON files of ``BATCHES`` micro-batches, by arrival time or shuffled (up to 54 h late); returns the
    files of a micro-batch."""
    raw = checkpoint_table(load_raw(spark, sf_dir), "arriving")
    if in_order:
        # one second never spans two micro-batches, as a bucket judges a second at once
        cuts = raw.select(F.unix_seconds("ingest_ts").alias("s")).approxQuantile("s", [i / BATCHES for i in range(1, BATCHES)], 0.01)
        batch = sum((F.unix_seconds("ingest_ts") > c).cast("int") for c in cuts)
    else:
        batch = F.pmod(F.xxhash64("stream", "entry_id"), F.lit(BATCHES))
    share = max(1, raw_partitions(spark, sf_dir) // BATCHES // BATCHES)
    for i in range(BATCHES):
        (raw.filter(batch == i).repartition(BATCHES * share).write.mode("append").option("timestampFormat", RAW_TS_FORMAT)
         .option("compression", "gzip").json(path))
    return BATCHES * share


def _guarded_stream(spark: SparkSession, sf_dir: str, name: str, quota=None) -> str:
    """Stream landing behind the guards over several micro-batches; the landed table's path."""
    root = work_dir(spark, name)
    files = _arrive(spark, sf_dir, f"{root}/raw", in_order=quota is not None)
    q = start_landing(read_raw_files(spark, f"{root}/raw", stream=True, max_files_per_trigger=files),
                      f"{root}/landed", f"{root}/bad", f"{root}/_checkpoint", dedup=True, quota=quota)
    sf.run_to_end(q, STREAM_TIMEOUT_S)
    return f"{root}/landed"


@query("stream_dedup", _ingest_sql("""
SELECT gr.tenant_id, gr.event_id, ge.entry_id, ge.ingest_ts, gr.first_seen
FROM gr JOIN ge ON gr.entry_id = ge.entry_id AND gr.tenant_id = ge.tenant_id"""))
def q_stream_dedup(spark, sf_dir):
    """V14 inside stream landing: shuffled entries, many of them a day late, in several micro-batches;
    the guard's decisions equal the fold over all of them."""
    return gd.landed_decisions(spark, _guarded_stream(spark, sf_dir, "stream-dedup")).drop("stream")


@query("stream_landing_guarded", _ingest_sql("""
SELECT tenant_id, event_id, eff_ts AS ts, count(*) AS n FROM outc JOIN (SELECT entry_id, tenant_id, eff_ts FROM ent)
USING (entry_id, tenant_id, eff_ts) WHERE outcome = 'accepted' GROUP BY 1, 2, 3"""))
def q_stream_landing_guarded(spark, sf_dir):
    """V14 + S5 + S7: what a reader finds landed after shuffled micro-batches, later decisions applied."""
    landed = land.read_landed(spark, _guarded_stream(spark, sf_dir, "stream-guarded"))
    return landed.groupBy("tenant_id", "event_id", "ts").agg(F.count(F.lit(1)).alias("n"))


@query("landing_outcomes", _ingest_sql(_QUOTA_CTES % {"burst": QUOTA_BURST, "rps": QUOTA_RPS} + """
, rq AS (
  SELECT *, row_number() OVER (PARTITION BY tenant_id, sec ORDER BY ingest_ts, entry_id) AS rk
  FROM (SELECT *, CAST(floor(epoch_us(ingest_ts) / 1000000) AS BIGINT) AS sec FROM ent)
), ad AS (
  SELECT rq.tenant_id, rq.event_id, rq.entry_id, rq.ingest_ts, rq.v_outcome, rq.rk <= qr.admitted AS admitted
  FROM rq JOIN qr ON rq.tenant_id = qr.tenant_id AND rq.sec = qr.sec
), ga AS (
  SELECT *, row_number() OVER (PARTITION BY tenant_id, event_id ORDER BY ingest_ts, entry_id) AS rn
  FROM ad WHERE admitted AND v_outcome = 'accepted'
), fa AS (
  SELECT tenant_id, event_id, entry_id, rn, ingest_ts AS last_acc, TRUE AS first_seen FROM ga WHERE rn = 1
  UNION ALL
  SELECT ga.tenant_id, ga.event_id, ga.entry_id, ga.rn,
         CASE WHEN ga.ingest_ts >= fa.last_acc + INTERVAL 24 HOUR THEN ga.ingest_ts ELSE fa.last_acc END,
         ga.ingest_ts >= fa.last_acc + INTERVAL 24 HOUR
  FROM fa JOIN ga ON ga.tenant_id = fa.tenant_id AND ga.event_id = fa.event_id AND ga.rn = fa.rn + 1
)
SELECT tenant_id, outcome, count(*) AS n FROM (
  SELECT ad.tenant_id, CASE WHEN NOT admitted THEN 'rate_limited' WHEN first_seen = FALSE THEN 'duplicate'
                            ELSE v_outcome END AS outcome
  FROM ad LEFT JOIN fa ON fa.tenant_id = ad.tenant_id AND fa.entry_id = ad.entry_id)
GROUP BY 1, 2"""))
def q_landing_outcomes(spark, sf_dir):
    """V15 + V16 + V18 inside stream landing: bucket, rules and guard in the edge's order over several micro-batches."""
    landed = _guarded_stream(spark, sf_dir, "landing-outcomes", quota=(QUOTA_RPS, QUOTA_BURST))
    return gd.landed_outcomes(spark, landed)


#: the fixture's day stretched over five, and the slice replayed from it
STRETCH, SLICE = 5, ("2024-01-02", "2024-01-03")


def _stretched_sql(name: str) -> str:
    return (f"SELECT * REPLACE (make_timestamp({BASE_US} + (epoch_us(ts) - {BASE_US}) * {STRETCH}) AS ts) FROM {name}")


@query("backfill_slice", with_signals(
    f", sigm AS ({_stretched_sql('sig')}), behm AS ({_stretched_sql('beh')})"
    + feature_set_ctes("sigm", "behm", "m_")
    + f" SELECT * FROM m_fs WHERE CAST(window_end AS DATE) BETWEEN DATE '{SLICE[0]}' AND DATE '{SLICE[1]}'"))
def q_backfill_slice(spark, sf_dir):
    """replay of two of the five days of a landed table, every tenant; the oracle computes all
    days and cuts the slice from the result."""
    root = work_dir(spark, "backfill")
    us = F.unix_micros("ts") - F.lit(BASE_US)
    landed = signals(spark, sf_dir).withColumn("ts", F.timestamp_micros(F.lit(BASE_US) + us * STRETCH))
    land.write_landed(landed.withColumn("dt", F.to_date("ts")), f"{root}/signals", "signals")
    return round_doubles(bf.backfill_features(land.read_landed(spark, f"{root}/signals"), *SLICE))


#: an earlier, shorter input of the table that the backfill job mends
BACKFILL_CUT = "2024-01-02 12:00:00"


@query("backfill_job", with_signals(
    f", sigm AS ({_stretched_sql('sig')}), behm AS ({_stretched_sql('beh')})"
    f", sigq AS (SELECT * FROM sigm WHERE ts < TIMESTAMP '{BACKFILL_CUT}')"
    f", behq AS (SELECT * FROM behm WHERE ts < TIMESTAMP '{BACKFILL_CUT}')"
    + feature_set_ctes("sigm", "behm", "m_") + feature_set_ctes("sigq", "behq", "q_") + f"""
SELECT * FROM m_fs WHERE CAST(window_end AS DATE) BETWEEN DATE '{SLICE[0]}' AND DATE '{SLICE[1]}'
UNION ALL
SELECT * FROM q_fs WHERE CAST(window_end AS DATE) NOT BETWEEN DATE '{SLICE[0]}' AND DATE '{SLICE[1]}'"""))
def q_backfill_job(spark, sf_dir):
    """a table made from the first day and a half, then the job over two of five days of the whole landed table:
    the slice is that of a full run, stale rows in it are gone, rows outside it are as they were."""
    root = work_dir(spark, "backfill-job")
    us = F.unix_micros("ts") - F.lit(BASE_US)
    landed = signals(spark, sf_dir).withColumn("ts", F.timestamp_micros(F.lit(BASE_US) + us * STRETCH))
    land.write_landed(landed.withColumn("dt", F.to_date("ts")), f"{root}/signals", "signals")
    early = land.read_landed(spark, f"{root}/signals").filter(F.col("ts") < F.lit(BACKFILL_CUT).cast("timestamp"))
    store.write_features(fs.build_feature_set(early), f"{root}/table", fmt="parquet")
    bf.run_backfill(spark, f"{root}/signals", f"{root}/table", *SLICE, fmt="parquet")
    return round_doubles(store.read_features(spark, f"{root}/table").drop("dt"))


UPSERT_CUT = "2024-01-01 07:00:00"


@query("upsert_features", with_signals(
    f", sigp AS (SELECT * FROM sig WHERE ts < TIMESTAMP '{UPSERT_CUT}')"
    f", behp AS (SELECT * FROM beh WHERE ts < TIMESTAMP '{UPSERT_CUT}')"
    + feature_set_ctes() + feature_set_ctes("sigp", "behp", "p_") + """
SELECT *, CAST(window_end AS DATE) AS dt FROM fs
UNION ALL
SELECT *, CAST(window_end AS DATE) AS dt FROM p_fs
WHERE NOT EXISTS (SELECT 1 FROM fs WHERE fs.tenant_id = p_fs.tenant_id AND fs.session_id = p_fs.session_id
                  AND fs.window_end = p_fs.window_end AND fs.feature_window = p_fs.feature_window)"""))
def q_upsert(spark, sf_dir):
    """Upsert features of the first 7 hours, then of the whole day, into one table."""
    root = work_dir(spark, "features")
    sig = signals(spark, sf_dir)
    early = fs.build_feature_set(sig.filter(F.col("ts") < F.lit(UPSERT_CUT).cast("timestamp")))
    store.write_features(early, f"{root}/table", fmt="parquet")
    store.write_features(fs.build_feature_set(sig), f"{root}/table", fmt="parquet")
    return round_doubles(store.read_features(spark, f"{root}/table"))


@query("append_features", with_signals(
    f", sigp AS (SELECT * FROM sig WHERE ts < TIMESTAMP '{UPSERT_CUT}')"
    f", behp AS (SELECT * FROM beh WHERE ts < TIMESTAMP '{UPSERT_CUT}')"
    + feature_set_ctes() + feature_set_ctes("sigp", "behp", "p_") + """
SELECT *, CAST(window_end AS DATE) AS dt FROM fs UNION ALL SELECT *, CAST(window_end AS DATE) AS dt FROM p_fs"""))
def q_append(spark, sf_dir):
    """Features of the first 7 hours and of the whole day appended to one table; keys may repeat."""
    root = work_dir(spark, "append-features")
    sig = signals(spark, sf_dir)
    for part in (sig.filter(F.col("ts") < F.lit(UPSERT_CUT).cast("timestamp")), sig):
        store.write_features(fs.build_feature_set(part), f"{root}/table", fmt="parquet", mode="append")
    return round_doubles(store.read_features(spark, f"{root}/table"))


EMIT_SINCE, EMIT_LIMIT = "2024-01-01 06:00:00", 1000
_EMIT_CTES = feature_set_ctes() + f"""
, newer AS (SELECT * FROM fs WHERE window_end > TIMESTAMP '{EMIT_SINCE}')
, cut AS (SELECT max(window_end) AS c FROM (SELECT window_end FROM newer ORDER BY window_end LIMIT {EMIT_LIMIT}))
, emitted AS (SELECT * FROM newer WHERE window_end <= (SELECT c FROM cut))"""


def _stored_features(spark, sf_dir) -> DataFrame:
    """The feature set as the jobs see it: a stored table, computed once."""
    return checkpoint_table(fs.build_feature_set(signals(spark, sf_dir)), "features")


def _emitted(spark, sf_dir):
    return em.read_since(_stored_features(spark, sf_dir), EMIT_SINCE, EMIT_LIMIT)


@query("emit_since", with_signals(_EMIT_CTES + " SELECT * FROM emitted"))
def q_emit_since(spark, sf_dir):
    """A1 + A2: rows newer than the cursor, first 1000 by window_end, ties kept."""
    return round_doubles(_emitted(spark, sf_dir))


_PAYLOAD_SCHEMA = ("tenant_id string, session_id string, window_end timestamp, feature_window string, "
                   "features struct<events_1m:bigint, events_5m:bigint, events_1h:bigint, "
                   "distinct_fingerprints:bigint, distinct_ips:bigint, distinct_os:bigint, "
                   "typing_cps_variance:double, typing_cps_mean:double, mouse_entropy_avg:double, "
                   "geo_distance_km_prior:double>, schema_version string, emitted_at timestamp")
_PAYLOAD_COLS = """tenant_id, session_id, window_end, feature_window, '1.0.0' AS schema_version,
       events_1m, events_5m, events_1h, distinct_fingerprints, distinct_ips, distinct_os,
       typing_cps_variance, typing_cps_mean, mouse_entropy_avg, geo_distance_km_prior"""


def _payloads(spark: SparkSession, path: str) -> DataFrame:
    """Payload lines read back, field by field."""
    p = spark.read.text(path).select(
        F.from_json("value", _PAYLOAD_SCHEMA, {"timestampFormat": em.PAYLOAD_TS_FORMAT}).alias("p"))
    return round_doubles(p.select("p.tenant_id", "p.session_id", "p.window_end", "p.feature_window",
                                  "p.schema_version", "p.features.*"))


@query("decision_payload", with_signals(_EMIT_CTES + f" SELECT {_PAYLOAD_COLS} FROM newer"))
def q_decision_payload(spark, sf_dir):
    """A3 + S13: JSON payloads of all rows since the cursor, written as text, read back and compared field by field."""
    root = work_dir(spark, "payloads")
    newer = em.read_since(_stored_features(spark, sf_dir), EMIT_SINCE)
    em.to_payload_json(em.payload_struct(newer)).select("value").write.text(root)
    return _payloads(spark, root)


@query("emit_changed", with_signals(
    f", sigp AS (SELECT * FROM sig WHERE ts < TIMESTAMP '{UPSERT_CUT}')"
    f", behp AS (SELECT * FROM beh WHERE ts < TIMESTAMP '{UPSERT_CUT}')"
    + feature_set_ctes() + feature_set_ctes("sigp", "behp", "p_") + f"""
, twice AS (SELECT * FROM p_fs UNION ALL (SELECT * FROM fs EXCEPT SELECT * FROM p_fs))
SELECT {_PAYLOAD_COLS} FROM twice"""))
def q_emit_changed(spark, sf_dir):
    """A5 without repeats: payloads of a table that holds the first 7 hours, then of its upsert with the whole
    day, where rewritten partitions hold mostly rows that were emitted before."""
    root = work_dir(spark, "emit-changed")
    sig = signals(spark, sf_dir)
    for part in (sig.filter(F.col("ts") < F.lit(UPSERT_CUT).cast("timestamp")), sig):
        store.write_features(fs.build_feature_set(part), f"{root}/table", fmt="parquet")
        sf.run_to_end(start_emit(spark, f"{root}/table", f"{root}/out", f"{root}/_ck", changed_only=True), STREAM_TIMEOUT_S)
    return _payloads(spark, f"{root}/out")


@query("cursor_next", with_signals(_EMIT_CTES + f"""
SELECT greatest(max(window_end), TIMESTAMP '{EMIT_SINCE}') AS cursor FROM emitted"""))
def q_cursor_next(spark, sf_dir):
    """A4: next cursor = newest emitted window_end (never moves back)."""
    return em.next_cursor(_emitted(spark, sf_dir), EMIT_SINCE)


@query("stream_payloads", with_signals(feature_set_ctes() + f" SELECT {_PAYLOAD_COLS} FROM fs"))
def q_stream_payloads(spark, sf_dir):
    """A5 stream form: new feature-table files -> one JSON payload per row (checkpointed text sink)."""
    root = work_dir(spark, "stream-emit")
    store.write_features(fs.build_feature_set(signals(spark, sf_dir)), f"{root}/table", fmt="parquet")
    sf.run_to_end(start_emit(spark, f"{root}/table", f"{root}/out", f"{root}/_ck"), STREAM_TIMEOUT_S)
    return _payloads(spark, f"{root}/out")


@query("emit_ticks")
def q_emit_ticks(spark, sf_dir):
    """A5 + A6: ticks of 1000 from a committed cursor until nothing is left, all that are due in a pass; payloads read back."""
    root = work_dir(spark, "emit")
    store.write_features(fs.build_feature_set(signals(spark, sf_dir)), f"{root}/table", fmt="parquet")
    feats = store.read_features(spark, f"{root}/table")
    while em.emit_since(spark, feats, f"{root}/cursor", f"{root}/out", limit=EMIT_LIMIT, all_due=True) > 0:
        pass
    return spark.read.text(f"{root}/out")


@query("exported_rows", _feature_set_sql())
def q_exported_rows(spark, sf_dir):
    """Feature rows exported as JSON lines (nested ``features``), found recursively and read back;
    files without a .json / .jsonl name (here: a text file of junk lines) are ignored."""
    root = work_dir(spark, "export")
    feats = fs.build_feature_set(signals(spark, sf_dir))
    values = [c for c in feats.columns if c.startswith(("events_", "distinct_", "typing_", "mouse_", "geo_"))]
    exp = feats.select("tenant_id", "session_id", "window_end", "feature_window",
                       F.struct(*values).alias("features"))
    exp.write.option("timestampFormat", em.PAYLOAD_TS_FORMAT).json(f"{root}/a/b")
    spark.range(2).select(F.lit("{broken").alias("v")).write.text(f"{root}/junk")
    return round_doubles(em.flatten_exported(em.read_exported(spark, root)))


@query("exported_payloads", with_signals(feature_set_ctes() + f"""
SELECT tenant_id, session_id, window_end, feature_window, '1.0.0' AS schema_version, events_1m, events_1m * 3 AS burst,
       session_id AS context_session, events_5m AS pair_second, mouse_entropy_avg
FROM fs WHERE window_end > TIMESTAMP '{EMIT_SINCE}'"""))
def q_exported_payloads(spark, sf_dir):
    """S12 to S13 for features that the engine does not know: a number, an object and an array beside the usual
    ones are exported as JSON lines, read since the cursor and found unchanged in the payloads."""
    root = work_dir(spark, "exported-payloads")
    feats = fs.build_feature_set(signals(spark, sf_dir))
    free = F.struct("events_1m", (F.col("events_1m") * 3).alias("burst"), F.struct("session_id").alias("context"),
                    F.array("events_1m", "events_5m").alias("pair"), "mouse_entropy_avg")
    keys = ["tenant_id", "session_id", "window_end", "feature_window"]
    feats.select(*keys, free.alias("features")).write.option("timestampFormat", em.PAYLOAD_TS_FORMAT).json(f"{root}/in/a")
    rows = em.read_since(em.read_exported_any(spark, f"{root}/in"), EMIT_SINCE)
    em.to_payload_json(em.payload_struct(rows)).select("value").write.text(f"{root}/out")
    line = F.try_parse_json("value")

    def field(path, kind):
        return F.try_variant_get(line, path, kind)

    return round_doubles(spark.read.text(f"{root}/out").select(
        *[field(f"$.{c}", "timestamp" if c == "window_end" else "string").alias(c) for c in (*keys, "schema_version")],
        field("$.features.events_1m", "bigint").alias("events_1m"), field("$.features.burst", "bigint").alias("burst"),
        field("$.features.context.session_id", "string").alias("context_session"),
        field("$.features.pair[1]", "bigint").alias("pair_second"),
        field("$.features.mouse_entropy_avg", "double").alias("mouse_entropy_avg")))


# ----------------------------------------------------------------- quality --

@query("dwell_histogram", with_signals("""
, d AS (SELECT tenant_id, dwell_ms / 1000.0::DOUBLE AS v FROM beh WHERE dwell_ms IS NOT NULL)
, b AS (SELECT unnest([0.001, 0.002, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0]::DOUBLE[]) AS le)
SELECT d.tenant_id, b.le, count(*) FILTER (WHERE d.v <= b.le) AS cum_count, (SELECT """
    + r6("sum(v)") + """ FROM d d2 WHERE d2.tenant_id = d.tenant_id) AS sum
FROM d, b GROUP BY d.tenant_id, b.le
UNION ALL
SELECT tenant_id, NULL, count(*), """ + r6("sum(v)") + """ FROM d GROUP BY tenant_id"""))
def q_dwell_histogram(spark, sf_dir):
    """Fixed-boundary cumulative histogram of dwell time (seconds) per tenant."""
    x = fx.explode_behavioral(signals(spark, sf_dir)).select(
        "tenant_id", (F.col("b.dwell_ms") / F.lit(1000.0)).alias("v"))
    return round_doubles(ql.fixed_histogram(x, "v"))


def _contract_sql() -> str:
    kinds = ", ".join(f"'{k}'" for k in ql.BEHAVIORAL_KINDS)
    checks = {
        "event_id_required": "json_extract_string(obj, '$.event_id') IS NULL",
        "event_id_length": f"length(json_extract_string(obj, '$.event_id')) NOT BETWEEN 1 AND {ql.MAX_ID_LEN}",
        "session_id_required": "json_extract_string(obj, '$.session_id') IS NULL",
        "session_id_length": f"length(json_extract_string(obj, '$.session_id')) NOT BETWEEN 1 AND {ql.MAX_ID_LEN}",
        "ts_required": "json_extract_string(obj, '$.ts') IS NULL",
        "device_required": "coalesce(json_type(obj, '$.device'), 'NULL') = 'NULL'",
        "battery_range": "CAST(json_extract_string(obj, '$.device.battery') AS DOUBLE) NOT BETWEEN 0 AND 1",
        "geo_lat_range": "abs(CAST(json_extract_string(obj, '$.device.geo_lat') AS DOUBLE)) > 90",
        "geo_lon_range": "abs(CAST(json_extract_string(obj, '$.device.geo_lon') AS DOUBLE)) > 180",
        "ip_format": f"NOT regexp_full_match(json_extract_string(obj, '$.device.ip'), '{ql.IPV4[1:-1]}')",
        "kind_required": "list_bool_or(list_transform(b, lambda e: json_extract_string(e, '$.kind') IS NULL))",
        "kind_enum": f"list_bool_or(list_transform(b, lambda e: json_extract_string(e, '$.kind') NOT IN ({kinds})))",
        "dwell_ms_negative": "list_bool_or(list_transform(b, lambda e: CAST(json_extract_string(e, '$.dwell_ms') AS DOUBLE) < 0))",
        "typing_cps_negative":
            "list_bool_or(list_transform(b, lambda e: CAST(json_extract_string(e, '$.typing_cps') AS DOUBLE) < 0))",
        "mouse_entropy_negative":
            "list_bool_or(list_transform(b, lambda e: CAST(json_extract_string(e, '$.mouse_entropy') AS DOUBLE) < 0))",
        "target_elem_length": f"list_bool_or(list_transform(b, lambda e: length(json_extract_string(e, '$.target_elem'))"
                              f" > {ql.MAX_TARGET_ELEM_LEN}))",
    }
    union = "\nUNION ALL\n".join(f"SELECT stream, entry_id, '{name}' AS violation FROM wf WHERE coalesce({cond}, false)"
                                  for name, cond in checks.items())
    return _ingest_sql(f"""
, wf AS (
  SELECT stream, entry_id, obj, json_extract(obj, '$.behavioral[*]') AS b FROM ent
  WHERE v_outcome NOT IN ('payload_too_large', 'empty_body', 'invalid_json')
)
{union}""")


@query("contract_violations", _contract_sql())
def q_contract(spark, sf_dir):
    """Published-contract violations of every well-formed payload, one row per violation."""
    raw = load_raw(spark, sf_dir)
    c = ing.classify(raw).filter(~F.col("outcome").isin("payload_too_large", "empty_body", "invalid_json"))
    return c.select("stream", "entry_id", F.explode(ql.contract_violations(c, "body")).alias("violation"))


@query("ops_rates", _ingest_sql(f"""
SELECT tenant_id, time_bucket(INTERVAL 5 MINUTE, ingest_ts) AS window_start,
       time_bucket(INTERVAL 5 MINUTE, ingest_ts) + INTERVAL 5 MINUTE AS window_end,
       count(*) AS n, count(*) FILTER (WHERE outcome NOT IN ('accepted', 'duplicate')) AS rejected,
       count(*) FILTER (WHERE outcome = 'duplicate') AS duplicates,
       {r6("count(*) FILTER (WHERE outcome NOT IN ('accepted', 'duplicate')) / count(*)")} AS reject_rate,
       {r6("count(*) FILTER (WHERE outcome = 'duplicate') / count(*)")} AS duplicate_ratio,
       count(*) FILTER (WHERE outcome NOT IN ('accepted', 'duplicate')) / count(*) > 0.005 AS reject_alert,
       count(*) FILTER (WHERE outcome = 'duplicate') / count(*) > 0.05 AS duplicate_alert
FROM outc GROUP BY 1, 2, 3"""))
def q_ops_rates(spark, sf_dir):
    """Per tenant and 5 minutes: rejected and duplicate shares with alert flags."""
    c = classified(spark, sf_dir)
    return round_doubles(ql.ops_rates(c))


P99_LIMIT, P99_HOLD = 0.95, "10 minutes"
_P99_CTES = f"""
, lv AS (
  SELECT tenant_id, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end,
         CASE WHEN dwell_ms > 0 THEN CAST(ceil(ln(dwell_ms / 1000.0::DOUBLE) / {math.log(al.growth())!r}::DOUBLE) AS INTEGER)
              ELSE {al.LOWEST} END AS bin
  FROM beh WHERE dwell_ms IS NOT NULL
), lr AS (
  SELECT *, row_number() OVER (PARTITION BY tenant_id, window_end ORDER BY bin) AS r,
         count(*) OVER (PARTITION BY tenant_id, window_end) AS n FROM lv
), p99 AS (
  SELECT tenant_id, window_end, n,
         {r6(f"CASE WHEN bin = {al.LOWEST} THEN 0 ELSE {2 / (al.growth() + 1)!r}::DOUBLE * pow({al.growth()!r}::DOUBLE, bin) END")} AS p99
  FROM lr WHERE r = ceil(0.99::DOUBLE * n)
)"""


def _p99(spark, sf_dir) -> DataFrame:
    dwell = fx.explode_behavioral(signals(spark, sf_dir)).select("tenant_id", "ts", (F.col("b.dwell_ms") / F.lit(1000.0)).alias("v"))
    return round_doubles(al.window_quantile(al.minute_bins(dwell, "v"), 0.99, name="p99"))


@query("latency_p99", with_signals(_P99_CTES + " SELECT * FROM p99"))
def q_latency_p99(spark, sf_dir):
    """p99 (of dwell time, within 1 %) per tenant and 5 minutes, rolled up from minute sketches."""
    return _p99(spark, sf_dir)


@query("sustained_alerts", with_signals(_P99_CTES + f"""
, hot AS (
  SELECT *, CASE WHEN window_end - lag(window_end) OVER w = INTERVAL 5 MINUTE THEN 0 ELSE 1 END AS brk
  FROM p99 WHERE p99 > {P99_LIMIT} WINDOW w AS (PARTITION BY tenant_id ORDER BY window_end)
), g AS (
  SELECT *, sum(brk) OVER (PARTITION BY tenant_id ORDER BY window_end ROWS UNBOUNDED PRECEDING) AS grp FROM hot
)
SELECT tenant_id, min(window_end) - INTERVAL 5 MINUTE AS alert_start, max(window_end) AS alert_end, count(*) AS windows
FROM g GROUP BY tenant_id, grp HAVING count(*) * 5 >= 10"""))
def q_sustained_alerts(spark, sf_dir):
    """Stretches in which a tenant's p99 stays over its limit for 10 minutes or longer."""
    return al.sustained(_p99(spark, sf_dir), F.col("p99") > P99_LIMIT, "5 minutes", P99_HOLD)


@query("version_share", _ingest_sql("""
SELECT tenant_id, '1.0.0' AS schema_version, count(*) AS n, 1.0::DOUBLE AS share FROM ent GROUP BY 1"""))
def q_version_share(spark, sf_dir):
    """Traffic per schema version and tenant with its share (one version on the wire)."""
    c = ing.classify(load_raw(spark, sf_dir)).withColumn("tenant_id", F.col("tenant_id_hint"))
    return round_doubles(ql.version_share(c, by=["tenant_id"]))


#: fields of the second version that the dual-write fixture compares
VERSION_FIELDS = ["session_id", "os", "ip", "battery"]


@query("version_reconciliation", with_signals("""
, o AS (SELECT event_id, tenant_id, CAST(ts AS DATE) AS dt, session_id, os, ip, battery FROM sig WHERE eid % 13 <> 0),
n AS (SELECT event_id, tenant_id, CAST(ts AS DATE) AS dt, session_id, CASE WHEN eid % 11 = 0 THEN upper(os) || '!' ELSE os END AS os,
             CASE WHEN eid % 17 = 0 THEN NULL ELSE ip END AS ip, battery FROM sig WHERE eid % 5 <> 0),
j AS (
  SELECT coalesce(o.dt, n.dt) AS dt, coalesce(o.tenant_id, n.tenant_id) AS tenant_id,
         n.event_id IS NULL AS only_old, o.event_id IS NULL AS only_new,
         o.session_id IS DISTINCT FROM n.session_id OR o.os IS DISTINCT FROM n.os OR o.ip IS DISTINCT FROM n.ip
           OR o.battery IS DISTINCT FROM n.battery AS differs,
         o.os IS DISTINCT FROM n.os AS os_differs, o.ip IS DISTINCT FROM n.ip AS ip_differs
  FROM o FULL OUTER JOIN n ON o.tenant_id = n.tenant_id AND o.event_id = n.event_id
)
SELECT tenant_id, dt, count(*) AS events, count(*) FILTER (only_old) AS only_old, count(*) FILTER (only_new) AS only_new,
       count(*) FILTER (NOT only_old AND NOT only_new AND NOT differs) AS equal,
       count(*) FILTER (NOT only_old AND NOT only_new AND differs) AS differing,
       count(*) FILTER (NOT only_old AND NOT only_new AND os_differs) AS differing_os,
       count(*) FILTER (NOT only_old AND NOT only_new AND ip_differs) AS differing_ip,
       """ + r6("count(*) FILTER (only_old) / count(*)") + """ AS old_share, count(*) FILTER (only_old) / count(*) < 0.01 AS cut_over
FROM j GROUP BY 1, 2"""))
def q_version_reconciliation(spark, sf_dir):
    """V21 + V22: a dual-write window. Both versions of each event side by side, per tenant and day, with the
    share that only the old version has, which decides the cut-over."""
    eid = F.substring("event_id", 2, 40).cast("bigint")
    flat = signals(spark, sf_dir).select("event_id", "tenant_id", "ts", "session_id", "device.os", "device.ip", "device.battery")
    old = flat.filter(eid % 13 != 0)
    new = (flat.filter(eid % 5 != 0).withColumn("os", F.when(eid % 11 == 0, F.concat(F.upper("os"), F.lit("!"))).otherwise(F.col("os")))
           .withColumn("ip", F.when(eid % 17 != 0, F.col("ip"))))
    days = vs.daily_agreement(vs.reconcile(old, new, ["tenant_id", "event_id"], VERSION_FIELDS), VERSION_FIELDS)
    return round_doubles(days.drop("differing_session_id", "differing_battery"))


RETAIN_N = 1500  # above the limit up to which Spark itself bounds a rank


@query("retain_last_n", _ingest_sql(f"""
SELECT stream, entry_id, ingest_ts FROM (
  SELECT *, row_number() OVER (PARTITION BY stream ORDER BY ingest_ts DESC, entry_id DESC) AS rn FROM ent)
WHERE rn <= {RETAIN_N}"""))
def q_retain(spark, sf_dir):
    """Newest entries per tenant stream (exact trim)."""
    return ql.retain_last_n(load_raw(spark, sf_dir), RETAIN_N).select("stream", "entry_id", "ingest_ts")
