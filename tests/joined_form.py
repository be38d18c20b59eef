"""The feature set by outer joins, written from its definition: a yardstick for tests and the benchmark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalspark.functions.windows import WINDOWS
from signalspark.operators import features as fx
from signalspark.schema import FEATURE_VALUE_COLUMNS

KEYS = ["tenant_id", "session_id", "window_end"]


def joined_feature_set(events: DataFrame) -> DataFrame:
    """Every (session, window end) of any component, with each component's values."""
    components = {
        "cardinality": fx.device_ip_fp_cardinality, "typing": fx.typing_cadence_variance,
        "mouse": fx.mouse_entropy_avg, "geo": fx.geo_distance_vs_prior,
        **{label: (lambda e, w=w: fx.velocity_counts(e, w)) for label, w in WINDOWS.items()}}
    whole = None
    for name in sorted(components):
        part = components[name](events)
        whole = part if whole is None else whole.join(part, KEYS, "full")
    return whole.withColumn("feature_window", F.lit("session")).select(*KEYS, "feature_window", *FEATURE_VALUE_COLUMNS)
