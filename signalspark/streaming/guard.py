"""Exact stateful folds on streams: V14 replay guard and V18 token bucket.

V14, the replay-guard fold as a stateful operator.

State per ``(tenant, event_id)`` is one timestamp, the last accepted arrival.
Each micro-batch's entries of a key are folded in arrival order: an entry is
accepted iff it arrives at least ``ttl`` after the last accepted one (repeats
do not refresh the TTL). A key's state goes once the watermark (arrival time
minus ``ttl``) passes ``last accepted + ttl``, so it stays bounded by one TTL
of keys. Most keys come once, so the fold is called for a group of keys (by hash, ``GROUPS``
of them) and keeps the group's keys in one state: a call per key costs about a millisecond. Arrival time is the stream's own clock, so entries come in order;
anything older than the watermark is dropped as late by Spark.

``dropDuplicatesWithinWatermark`` (in :mod:`signalspark.operators.dedup`) is
the cheaper, approximate alternative.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StringType, StructField, StructType

from signalspark.functions.windows import interval_micros
from signalspark.operators.dedup import TTL

# the fold runs in Python workers: ship this module with the function
try:
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(sys.modules[__name__])
except (ImportError, AttributeError, ValueError):
    pass

#: groups that the keys are dealt over; fixed for the life of a checkpoint
GROUPS = 1024
# the group's keys that still block repeats, and for each the epoch microseconds of its last
# accepted arrival (independent of any time zone)
STATE = StructType([StructField("keys", ArrayType(StringType())), StructField("last_accepted_us", ArrayType(LongType()))])


def _fold(ttl_us: int, time_col: str, tie_col: str, flag: str):
    def fn(group, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last = dict(zip(*state.get)) if state.exists else {}
        if not state.hasTimedOut:
            pdf = pd.concat(list(batches), ignore_index=True)
            pdf = pdf.sort_values([time_col, tie_col], kind="mergesort")
            # arrival times as epoch microseconds (the session zone is UTC)
            times = pdf[time_col].astype("datetime64[us]").astype("int64").tolist()
            flags = []
            for k, t in zip(pdf["_key"].tolist(), times):
                ok = t >= last.get(k, t - ttl_us) + ttl_us
                if ok:
                    last[k] = t
                flags.append(ok)
            pdf[flag] = flags
            yield pdf.drop(columns=["_group", "_key"])
        # what the watermark has passed blocks nothing any more
        passed_us = state.getCurrentWatermarkMs() * 1000
        last = {k: t for k, t in last.items() if t + ttl_us > passed_us}
        if not last:
            if state.exists:
                state.remove()
            return
        state.update((list(last), list(last.values())))
        state.setTimeoutTimestamp(max(last.values()) // 1000 + ttl_us // 1000 + 1)  # epoch millis

    return fn


def replay_guard_stateful(entries: DataFrame, keys: Sequence[str] = ("tenant_id", "event_id"),
                          time_col: str = "ingest_ts", tie_col: str = "entry_id", ttl: str = TTL,
                          flag: str = "first_seen", groups: int = GROUPS) -> DataFrame:
    """Entries with boolean ``flag``: true for the entries the guard accepts."""
    out = StructType(entries.schema.fields + [StructField(flag, BooleanType())])
    named = entries.withColumn("_key", F.to_json(F.struct(*keys))).withColumn(
        "_group", F.pmod(F.xxhash64("_key"), F.lit(groups)).cast("int"))
    return (named.withWatermark(time_col, ttl)
            .groupBy("_group")
            .applyInPandasWithState(_fold(interval_micros(ttl), time_col, tie_col, flag), out, STATE,
                                    "append", GroupStateTimeout.EventTimeTimeout))


# --- V18 on a stream: the token bucket as a stateful fold per tenant ---

QUOTA_STATE = StructType([StructField("tokens", DoubleType()), StructField("last_sec", LongType())])
QUOTA_OUT = StructType([StructField("tenant_id", StringType()), StructField("sec", LongType()),
                        StructField("n", LongType()), StructField("admitted", LongType())])


def _bucket(rps: float, burst: float, time_col: str, refill_s: int):
    def fn(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:  # idle long enough to be full again: same as no state
            state.remove()
            return
        pdf = pd.concat(list(batches), ignore_index=True)
        if pdf.empty:
            return
        secs = pdf[time_col].astype("datetime64[us]").astype("int64") // 1_000_000
        per_sec = secs.value_counts().sort_index()
        tokens, last = (float(state.get[0]), int(state.get[1])) if state.exists else (burst, None)
        admitted = []
        for s, n in zip(per_sec.index.tolist(), per_sec.tolist()):  # plain Python ints
            if last is not None and s > last:
                tokens = min(burst, tokens + (s - last) * rps)
            last = s if last is None or s > last else last
            a = min(int(n), int(math.floor(tokens)))
            tokens -= a
            admitted.append(a)
        state.update((float(tokens), int(last)))
        state.setTimeoutTimestamp((int(last) + refill_s) * 1000)
        yield pd.DataFrame({"tenant_id": key[0], "sec": per_sec.index.astype("int64"),
                            "n": per_sec.values.astype("int64"), "admitted": admitted})

    return fn


def quota_stateful(requests: DataFrame, rps: float, burst: float, tenant_col: str = "tenant_id",
                   time_col: str = "ingest_ts", delay: str = "1 minute") -> DataFrame:
    """Per (tenant, second, micro-batch): requests and admitted by the bucket, exactly as the
    continuous fold (no day boundaries). A second split over micro-batches yields several rows
    whose sums are that second's totals. State: tokens and last second per tenant, dropped once
    the bucket would be full again."""
    refill_s = int(math.ceil(burst / rps)) + 1
    src = requests.select(F.col(tenant_col).alias("tenant_id"), F.col(time_col).alias(time_col)) \
        .filter(F.col("tenant_id").isNotNull())
    return (src.withWatermark(time_col, delay).groupBy("tenant_id")
            .applyInPandasWithState(_bucket(rps, burst, time_col, refill_s), QUOTA_OUT, QUOTA_STATE,
                                    "append", GroupStateTimeout.EventTimeTimeout))
