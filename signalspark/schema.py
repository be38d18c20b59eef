"""Schemas and fixed contract values: the single source of truth for every frame.

The signal contract is declared once here; readers always pass it explicitly so
partition inference or JSON sampling never changes a type.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- fixed values of the wire contract (must match the published contract) ---
SCHEMA_VERSION = "1.0.0"
VERSION_CUT_OVER = 0.01  # the old version may go when less of the traffic is only its own
BEHAVIORAL_KINDS = ["click", "type", "scroll", "focus", "blur", "submit"]
MAX_PAYLOAD_BYTES = 65536
MAX_CLOCK_SKEW = "5 minutes"
REPLAY_TTL_HOURS = 24
STREAM_PREFIX = "di:signals:"
STREAM_MAX_LEN = 1_000_000
MAX_ID_LEN = 128
MAX_TARGET_ELEM_LEN = 256
# outcome labels in precedence order (first match wins)
OUTCOMES = [
    "no_tenant",
    "rate_limited",
    "payload_too_large",
    "empty_body",
    "invalid_json",
    "invalid_signal",
    "publish_failed",
    "duplicate",
    "accepted",
]
# latency histogram upper bounds (seconds)
HISTOGRAM_BOUNDS = [0.001, 0.002, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0]
DEFAULT_QUOTA_RPS = 2000.0
DEFAULT_QUOTA_BURST = 4000.0
# --- end of fixed values ---

DEVICE = StructType(
    [
        StructField("os", StringType()),
        StructField("os_version", StringType()),
        StructField("ip", StringType()),
        StructField("fingerprint", StringType()),
        StructField("battery", DoubleType()),
        StructField("geo_lat", DoubleType()),
        StructField("geo_lon", DoubleType()),
    ]
)

BEHAVIORAL = StructType(
    [
        StructField("kind", StringType()),
        StructField("dwell_ms", LongType()),
        StructField("typing_cps", DoubleType()),
        StructField("mouse_entropy", DoubleType()),
        StructField("target_elem", StringType()),
    ]
)

SIGNAL = StructType(
    [
        StructField("event_id", StringType()),
        StructField("tenant_id", StringType()),
        StructField("session_id", StringType()),
        StructField("ts", TimestampType()),
        StructField("device", DEVICE),
        StructField("behavioral", ArrayType(BEHAVIORAL)),
    ]
)

# landed table = signal + partition date; tenant_id and dt are the Hive partitions
LANDED = StructType(SIGNAL.fields + [StructField("dt", DateType())])

# raw stream entry: stream name (di:signals:{tenant}), entry id (unique within the
# stream, breaks arrival ties), payload text, arrival time
RAW = StructType(
    [
        StructField("stream", StringType()),
        StructField("entry_id", StringType()),
        StructField("data", StringType()),
        StructField("ingest_ts", TimestampType()),
    ]
)
RAW_ENVELOPE = RAW

QUARANTINE = StructType(
    [
        StructField("tenant_id_hint", StringType()),
        StructField("raw", StringType()),
        StructField("reason", StringType()),
        StructField("ingest_ts", TimestampType()),
        StructField("quarantined_at", TimestampType()),
    ]
)

FEATURE_KEYS = ["tenant_id", "session_id", "window_end", "feature_window"]

FEATURE_VALUE_COLUMNS = [
    "events_1m",
    "events_5m",
    "events_1h",
    "distinct_fingerprints",
    "distinct_ips",
    "distinct_os",
    "typing_cps_variance",
    "typing_cps_mean",
    "mouse_entropy_avg",
    "geo_distance_km_prior",
]

FEATURES = StructType(
    [
        StructField("tenant_id", StringType()),
        StructField("session_id", StringType()),
        StructField("window_end", TimestampType()),
        StructField("feature_window", StringType()),
        StructField("events_1m", LongType()),
        StructField("events_5m", LongType()),
        StructField("events_1h", LongType()),
        StructField("distinct_fingerprints", LongType()),
        StructField("distinct_ips", LongType()),
        StructField("distinct_os", LongType()),
        StructField("typing_cps_variance", DoubleType()),
        StructField("typing_cps_mean", DoubleType()),
        StructField("mouse_entropy_avg", DoubleType()),
        StructField("geo_distance_km_prior", DoubleType()),
        StructField("dt", DateType()),
    ]
)

# exported feature row (JSON lines): keys + dynamic feature map
EXPORTED_FEATURE_ROW = StructType(
    [
        StructField("tenant_id", StringType()),
        StructField("session_id", StringType()),
        StructField("window_end", TimestampType()),
        StructField("feature_window", StringType()),
        StructField(
            "features",
            StructType([f for f in FEATURES.fields if f.name in FEATURE_VALUE_COLUMNS]),
        ),
    ]
)
