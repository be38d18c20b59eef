"""Per-tenant token-bucket admission (rate ``rps``, capacity ``burst``).

The bucket starts full, refills ``rps`` tokens per second up to ``burst`` and
admits a request when at least one token is left. Requests in one ``grain``
(1 s) are treated as simultaneous: ``admit = min(n, floor(tokens))``.

Plan: a distributed pre-aggregation to ``(tenant, second, n)`` (map-side
combine, so a hot tenant costs one row per second, not per request), then the
bucket recurrence per ``(tenant, UTC day)`` in ``applyInPandas``. A group has
at most 86,400 rows whatever the traffic. The recurrence is not expressible
with built-in window functions (it is a clamped, floored scan), hence pandas.

Day boundaries: every day is first folded from a full bucket. A day's true start is the
end state of the tenant's previous day with traffic, refilled over the gap; days whose
start turns out lower are folded again, until no start changes. The first day of a chain
is right at once and each pass settles at least the next one, so the result is the exact
fold over all days; passes are as many as the longest chain of days that starts depleted.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalspark.schema import DEFAULT_QUOTA_BURST, DEFAULT_QUOTA_RPS
from signalspark.session import checkpoint_table

SECONDS_PER_DAY = 86_400

# the fold runs in Python workers; ship this module's code with the function so
# executors need no installed copy of the package
try:
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # older pickler: rely on --py-files
    pass


def _fold(secs: np.ndarray, counts: np.ndarray, rps: float, burst: float, tokens: float):
    """(admitted, tokens left) when ``tokens`` are there at the first second."""
    admitted = np.zeros(len(secs), dtype=np.int64)
    for i in range(len(secs)):
        if i:
            tokens = min(burst, tokens + float(secs[i] - secs[i - 1]) * rps)
        admitted[i] = min(int(counts[i]), int(math.floor(tokens)))
        tokens -= float(admitted[i])
    return admitted, tokens


def _fold_day(rps: float, burst: float):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("sec").reset_index(drop=True)
        admitted, left = _fold(pdf["sec"].to_numpy(), pdf["n"].to_numpy(), rps, burst, float(pdf["start"].iloc[0]))
        return pdf.assign(admitted=admitted, left=left)[["tenant_id", "day", "sec", "n", "start", "admitted", "left"]]
    return fn


BUCKET = "tenant_id string, tokens double, last_sec bigint"
_OUT = "tenant_id string, day bigint, sec bigint, n bigint, start double, admitted bigint, left double"


def _limits(rps: float, burst: float) -> tuple[float, float]:
    rps = float(rps) if rps > 0 else 1000.0
    return rps, float(burst) if burst > 0 else 2 * rps


def _seconds(requests: DataFrame, tenant_col: str, time_col: str, initial: DataFrame | None) -> DataFrame:
    """Requests with ``_sec``, the second at which the bucket sees them: never before its last one."""
    sec = F.unix_seconds(time_col)
    if initial is None:
        return requests.withColumn("_sec", sec)
    last = initial.select(F.col("tenant_id").alias(tenant_col), F.col("last_sec").alias("_last"))
    return requests.join(last, tenant_col, "left").withColumn("_sec", F.greatest(sec, "_last")).drop("_last")


def _folded(seconds: DataFrame, rps: float, burst: float, tenant_col: str, initial: DataFrame | None) -> DataFrame:
    """``tenant_id, day, sec, n, start, admitted, left``: the bucket over all tenant-seconds."""
    per_sec = seconds.filter(F.col(tenant_col).isNotNull()).groupBy(
        F.col(tenant_col).alias("tenant_id"), F.col("_sec").alias("sec")
    ).agg(F.count(F.lit(1)).alias("n")).withColumn("day", F.floor(F.col("sec") / SECONDS_PER_DAY))
    # every pass reads per-second rows (at most 86,400 a tenant-day): written once, lineage cut
    per_sec = checkpoint_table(per_sec, "quota-per-second")
    before = per_sec.sparkSession.createDataFrame([], BUCKET) if initial is None else initial.select("tenant_id", "tokens", "last_sec")

    def folded(days: DataFrame, name: str) -> DataFrame:
        rows = per_sec.join(days.select("tenant_id", "day", "start"), ["tenant_id", "day"])
        return checkpoint_table(rows.groupBy("tenant_id", "day").applyInPandas(_fold_day(rps, burst), _OUT), name)

    def by_day(rows: DataFrame) -> DataFrame:
        return rows.groupBy("tenant_id", "day").agg(
            F.min("sec").alias("first_sec"), F.max("sec").alias("last_sec"),
            F.max("start").alias("start"), F.max("left").alias("left"))

    result = folded(per_sec.select("tenant_id", "day").distinct().withColumn("start", F.lit(burst)), "quota-fold")
    while True:
        days = Window.partitionBy("tenant_id").orderBy("day")
        rows = by_day(result).join(before.select("tenant_id", "tokens", F.col("last_sec").alias("seen_sec")), "tenant_id", "left")
        idle = (F.col("first_sec") - F.coalesce(F.lag("last_sec").over(days), F.col("seen_sec"))).cast("double")
        true_start = F.least(F.lit(burst), F.coalesce(F.lag("left").over(days), F.col("tokens")) + idle * F.lit(rps))
        starts = rows.withColumn("true_start", F.coalesce(true_start, F.lit(burst)))
        wrong = checkpoint_table(starts.filter("true_start <> start").select(
            "tenant_id", "day", F.col("true_start").alias("start")), "quota-starts")
        if wrong.isEmpty():
            return result
        again = folded(wrong, "quota-refold")
        result = checkpoint_table(result.join(wrong, ["tenant_id", "day"], "left_anti").unionByName(again), "quota-fold")


def per_second_admission(requests: DataFrame, rps: float = DEFAULT_QUOTA_RPS,
                         burst: float = DEFAULT_QUOTA_BURST, tenant_col: str = "tenant_id",
                         time_col: str = "ingest_ts") -> DataFrame:
    """``(tenant_id, sec, n, admitted)``: requests and admissions per tenant-second."""
    rps, burst = _limits(rps, burst)
    seconds = requests.withColumn("_sec", F.unix_seconds(time_col))
    return _folded(seconds, rps, burst, tenant_col, None).select("tenant_id", "sec", "n", "admitted")


#: cells of a second in which the request rank is found
CELLS = 1000


def admit(requests: DataFrame, rps: float = DEFAULT_QUOTA_RPS, burst: float = DEFAULT_QUOTA_BURST,
          tenant_col: str = "tenant_id", time_col: str = "ingest_ts", order_col: str = "entry_id",
          initial: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(requests with admitted, buckets)``: one batch of a continuing fold.

    ``initial`` and the returned buckets hold ``tenant_id, tokens, last_sec``, one row per
    tenant ever seen; a missing tenant starts with a full bucket. A request older than its
    tenant's last second counts at that second, as it would on arrival.

    In each second the first ``admitted`` requests by (``time_col``, ``order_col``) pass.
    Only partly admitted seconds need a rank, and there only the millisecond in which the
    admitted ones run out: counts per millisecond (at most 1000 a second, pre-aggregated)
    decide all others, so a hot second is never sorted whole.
    """
    rps, burst = _limits(rps, burst)
    r = _seconds(requests, tenant_col, time_col, initial)
    folded = _folded(r, rps, burst, tenant_col, initial)
    seconds = folded.select(F.col("tenant_id").alias(tenant_col), F.col("sec").alias("_sec"),
                            F.col("n").alias("_n"), F.col("admitted").alias("_a"))
    r = r.withColumn("_cell", F.floor(F.unix_micros(time_col) * CELLS / 1_000_000)).join(
        seconds, [tenant_col, "_sec"], "left")
    key = [tenant_col, "_sec"]
    partial = (F.col("_a") > 0) & (F.col("_a") < F.col("_n"))
    upto = Window.partitionBy(*key).orderBy("_cell")
    cells = (r.filter(partial).groupBy(*key, "_cell", "_a").agg(F.count(F.lit(1)).alias("_m"))
             .withColumn("_rest", F.col("_a") - F.sum("_m").over(upto) + F.col("_m")))  # left when the cell begins
    cut = cells.filter((F.col("_rest") > 0) & (F.col("_rest") < F.col("_m"))).select(*key, "_cell", "_rest")
    cut = checkpoint_table(cut, "quota-cut")  # at most one cell of each second
    order = Window.partitionBy(*key).orderBy(time_col, order_col)
    last = (r.filter(partial).join(cut, [*key, "_cell"]).withColumn("_rn", F.row_number().over(order))
            .filter(F.col("_rn") <= F.col("_rest")).select(*key, order_col, F.lit(True).alias("_in")))
    whole = cells.filter(F.col("_rest") >= F.col("_m")).select(*key, "_cell", F.lit(True).alias("_full"))
    out = r.join(whole, [*key, "_cell"], "left").join(last, [*key, order_col], "left")
    flag = (F.when(F.col("_a").isNull() | (F.col("_a") >= F.col("_n")), F.lit(True))
            .when(F.col("_a") == 0, F.lit(False))
            .otherwise(F.col("_full").isNotNull() | F.col("_in").isNotNull()))
    flagged = out.withColumn("admitted", flag).drop("_sec", "_cell", "_n", "_a", "_full", "_in")
    buckets = folded.groupBy("tenant_id").agg(F.max_by("left", "sec").alias("tokens"), F.max("sec").alias("last_sec"))
    if initial is not None:
        buckets = buckets.unionByName(initial.select(*buckets.columns).join(buckets, "tenant_id", "left_anti"))
    return flagged, buckets


def quota_admission(requests: DataFrame, rps: float = DEFAULT_QUOTA_RPS, burst: float = DEFAULT_QUOTA_BURST,
                    tenant_col: str = "tenant_id", time_col: str = "ingest_ts",
                    order_col: str = "entry_id") -> DataFrame:
    """Flag each request ``admitted`` by the bucket (see :func:`admit`), all requests at once."""
    return admit(requests, rps, burst, tenant_col, time_col, order_col)[0]
