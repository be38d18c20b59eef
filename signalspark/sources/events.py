"""Signals derived from the driver's ``events`` table.

The test tables carry no device signals, so a deterministic mapping turns each
``events`` row into one SIGNAL row (see FIXTURES.md 3.1). Thirty days are
squeezed 48-fold so that one-minute windows and ten-minute gaps have content.
Everything is a projection: one narrow stage, no shuffle, and Catalyst prunes
the scan to the five columns used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from signalspark.schema import BEHAVIORAL

# --- fixed values of the events -> signals mapping ---
BASE_US = 1_704_067_200_000_000  # 2024-01-01T00:00:00Z in microseconds
SQUEEZE = 48
BLOCK_US = 10_800_000_000  # three hours: one session per user and block
TENANTS = 5
OS_NAMES = ["iOS", "Android", ""]
IP_PREFIX = "203.0.113."
FP_PREFIX = "fp_"
OS_VERSION = "17.4"
# --- end of fixed values ---


def _elem(kind: str, dwell_ms: Column | None = None, typing_cps: Column | None = None,
          mouse_entropy: Column | None = None) -> Column:
    def val(c, t):
        return (c if c is not None else F.lit(None)).cast(t)
    return F.struct(
        F.lit(kind).alias("kind"),
        val(dwell_ms, "bigint").alias("dwell_ms"),
        val(typing_cps, "double").alias("typing_cps"),
        val(mouse_entropy, "double").alias("mouse_entropy"),
        F.lit(None).cast("string").alias("target_elem"),
    )


def signals_from_events(events: DataFrame) -> DataFrame:
    """Map ``events(event_id, ts, user_id, event_type, value, props)`` to SIGNAL rows."""
    u = F.expr(f"div(unix_micros(cast(ts as timestamp)) - {BASE_US}, {SQUEEZE})")
    k = F.expr("try_cast(get_json_object(props, '$.k') as int)")
    eid, uid = F.col("event_id"), F.col("user_id")
    h = F.expr(f"div(_u, {BLOCK_US})")
    et = F.col("event_type")
    cps = F.col("value") / F.lit(50.0)
    arr_t = ArrayType(BEHAVIORAL)
    behavioral = (
        F.when(et == "click", F.array(_elem("click", dwell_ms=F.col("_k") * 10)))
        .when(et == "purchase", F.array(_elem("submit"), _elem("type", typing_cps=cps)))
        .when(et == "error", F.array(_elem("scroll", mouse_entropy=F.col("_k") / F.lit(100.0)),
                                     _elem("type", typing_cps=cps)))
        .when(et == "view", F.array().cast(arr_t))
        .otherwise(F.lit(None).cast(arr_t))
    )
    geo_null = (eid % 7) == 0
    device = F.struct(
        F.element_at(F.array(*[F.lit(x) for x in OS_NAMES]), (eid % 3 + 1).cast("int")).alias("os"),
        F.lit(OS_VERSION).alias("os_version"),
        F.concat(F.lit(IP_PREFIX), (F.col("_k") % 255).cast("string")).alias("ip"),
        F.concat(F.lit(FP_PREFIX), (F.col("_k") % 4).cast("string")).alias("fingerprint"),
        ((F.col("_k") % 101) / F.lit(100.0)).alias("battery"),
        F.when(~geo_null, ((uid * 37 + F.col("_h") * 11) % 181 - 90).cast("double")).alias("geo_lat"),
        F.when(~geo_null, ((uid * 53 + F.col("_h") * 17) % 361 - 180).cast("double")).alias("geo_lon"),
    )
    return (
        events.select("event_id", "user_id", "event_type", "value", u.alias("_u"), k.alias("_k"))
        .withColumn("_h", h)
        .select(
            F.concat(F.lit("e"), eid.cast("string")).alias("event_id"),
            F.concat(F.lit("t"), (uid % TENANTS).cast("string")).alias("tenant_id"),
            F.concat(F.lit("s"), uid.cast("string"), F.lit("_"), F.col("_h").cast("string")).alias("session_id"),
            F.timestamp_micros(F.lit(BASE_US) + F.col("_u")).alias("ts"),
            device.alias("device"),
            behavioral.alias("behavioral"),
        )
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_signals(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """SIGNAL frame for one scale-factor directory.

    ``partitions`` spreads the (small) event rows round-robin first; the raw
    fixture uses it so payload building and parsing are not limited to the
    one or two splits of a small test file.
    """
    events = read_table(spark, sf_dir, "events")
    if partitions:
        events = events.repartition(partitions)
    return signals_from_events(events)


# DuckDB text of the same mapping, used by the independent SQL oracle. It yields
# ``sig`` (one row per signal, device fields flattened) and ``beh`` (one row per
# behavioral element, with its array position).
SIGNALS_SQL = f"""
ev AS (
  SELECT event_id AS eid, user_id AS uid, event_type, value,
         (epoch_us(ts) - {BASE_US}) // {SQUEEZE} AS u,
         try_cast(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
), ev2 AS (
  SELECT *, u // {BLOCK_US} AS h FROM ev
), sig AS (
  SELECT 'e' || eid AS event_id,
         't' || (uid % {TENANTS}) AS tenant_id,
         's' || uid || '_' || h AS session_id,
         make_timestamp({BASE_US} + u) AS ts,
         CASE eid % 3 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' ELSE '' END AS os,
         '{IP_PREFIX}' || (k % 255) AS ip,
         '{FP_PREFIX}' || (k % 4) AS fingerprint,
         CASE WHEN eid % 7 = 0 THEN NULL ELSE CAST((uid * 37 + h * 11) % 181 - 90 AS DOUBLE) END AS geo_lat,
         CASE WHEN eid % 7 = 0 THEN NULL ELSE CAST((uid * 53 + h * 17) % 361 - 180 AS DOUBLE) END AS geo_lon,
         (k % 101) / 100.0::DOUBLE AS battery,
         CASE event_type WHEN 'click' THEN 1 WHEN 'purchase' THEN 2 WHEN 'error' THEN 2 WHEN 'view' THEN 0 END
           AS n_behavioral,
         event_type, eid, uid, k, value
  FROM ev2
), beh AS (
  SELECT event_id, tenant_id, session_id, ts, 0 AS pos, 'click' AS kind, CAST(k * 10 AS BIGINT) AS dwell_ms,
         CAST(NULL AS DOUBLE) AS typing_cps, CAST(NULL AS DOUBLE) AS mouse_entropy
    FROM sig WHERE event_type = 'click'
  UNION ALL
  SELECT event_id, tenant_id, session_id, ts, 0, 'submit', NULL, NULL, NULL FROM sig WHERE event_type = 'purchase'
  UNION ALL
  SELECT event_id, tenant_id, session_id, ts, 1, 'type', NULL, value / 50.0::DOUBLE, NULL FROM sig WHERE event_type = 'purchase'
  UNION ALL
  SELECT event_id, tenant_id, session_id, ts, 0, 'scroll', NULL, NULL, k / 100.0::DOUBLE FROM sig WHERE event_type = 'error'
  UNION ALL
  SELECT event_id, tenant_id, session_id, ts, 1, 'type', NULL, value / 50.0::DOUBLE, NULL FROM sig WHERE event_type = 'error'
)
"""


def with_signals(body: str, recursive: bool = False) -> str:
    """Prefix a DuckDB query with the signal CTEs.

    ``body`` continues the WITH list (``", x AS (...) SELECT ..."``) or is the
    final ``SELECT``.
    """
    head = "WITH RECURSIVE" if recursive else "WITH"
    return f"{head} {SIGNALS_SQL}{body if body.lstrip().startswith(',') else ' ' + body}"
