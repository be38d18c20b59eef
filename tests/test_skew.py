"""Correctness when one key holds a third of all rows.

The skew-safe forms (time cells for gap sessions, bucketed lag, bucket-wise
replay guard, union feature set) must give exactly what the plain forms give.
Inputs are derived from the given ``events`` table.
"""

from datetime import timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from signalspark.operators import dedup as dd
from signalspark.operators import features as fx
from signalspark.operators import sessions as sx
from signalspark.operators.ordered import bucketed_lag
from signalspark.plans import feature_set as fs
from signalspark.sources.events import read_table, signals_from_events
from tests.joined_form import joined_feature_set

SF = "/root/testdata/sf0.01"


def _skewed_signals(spark):
    ev = read_table(spark, SF, "events")
    hot = (F.col("event_id") % 3) == 0
    # a third of the events become one user in the first 3-hour block: one hot session
    ev = ev.withColumn("user_id", F.when(hot, F.lit(0)).otherwise(F.col("user_id"))) \
           .withColumn("ts", F.when(hot, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
                                    + F.make_dt_interval(secs=F.col("event_id") * 7 % 432000 / 48))
                       .otherwise(F.col("ts")))
    return signals_from_events(ev)


def _same(a, b):
    r = lambda d: d.select([F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in d.dtypes])  # noqa
    a, b = r(a), r(b)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_hot_session_is_a_third(spark):
    sig = _skewed_signals(spark)
    top = sig.groupBy("tenant_id", "session_id").count().orderBy(F.desc("count")).first()
    assert top["count"] * 3 >= sig.count() - 3


def test_gap_sessions_under_skew(spark):
    sig = _skewed_signals(spark)
    assert _same(sx.session_aggregates(sig), sx.session_aggregates_window(sig))


def test_feature_set_under_skew(spark):
    sig = _skewed_signals(spark)
    assert _same(fs.build_feature_set(sig), joined_feature_set(sig))


def test_lag_under_hot_tenant(spark):
    s = fx.session_geo_starts(_skewed_signals(spark))
    plain = s.withColumn("prior_lat", F.lag("lat").over(Window.partitionBy("tenant_id")
                                                        .orderBy("session_start", "session_id")))
    b = bucketed_lag(s, ["tenant_id"], ["session_start", "session_id"], ["lat", "lon"],
                     F.date_trunc("minute", "session_start")).drop("prior_lon")
    assert _same(b, plain)


def test_replay_guard_hot_key_matches_fold(spark):
    ev = read_table(spark, SF, "events")
    # every third event re-sends the same event id: one key with a third of the rows
    base = ev.select(F.lit("t0").alias("tenant_id"),
                     F.when(F.col("event_id") % 3 == 0, F.lit("hot")).otherwise(
                         F.concat(F.lit("e"), F.col("event_id").cast("string"))).alias("event_id"),
                     F.col("event_id").cast("string").alias("entry_id"),
                     (F.col("ts").cast("timestamp") + F.make_dt_interval(
                         hours=(F.col("event_id") % 11) * 7)).alias("ingest_ts"))
    got = {r.entry_id: r.first_seen for r in dd.replay_guard(base).collect()}
    rows = sorted(base.filter(F.col("event_id") == "hot").collect(), key=lambda r: (r.ingest_ts, r.entry_id))
    last, want = None, {}
    for r in rows:  # brute-force fold on the hot key
        ok = last is None or r.ingest_ts >= last + timedelta(hours=24)
        want[r.entry_id] = ok
        last = r.ingest_ts if ok else last
    assert len(rows) * 3 >= base.count() - 3
    assert {k: got[k] for k in want} == want
    assert all(v for k, v in got.items() if k not in want)  # unique keys are always first


def test_replay_guard_runs_of_many_days(spark):
    """Keys with gaps and with entries on many days in a row: equal to the fold; rounds follow the longest run."""
    import random
    from datetime import datetime, timedelta

    from signalspark.operators.dedup import replay_guard
    rng, start, rows = random.Random(11), datetime(2027, 2, 1), []
    for k in range(40):
        at = rng.uniform(0, 100)
        for _ in range(rng.randrange(1, 14)):
            rows.append((f"t{k % 3}", f"e{k}", start + timedelta(hours=at), f"{len(rows)}"))
            at += rng.choice([0, rng.uniform(0, 30), 24, rng.uniform(23, 25), 400])
    rows += [("t0", "e0", None, "none"), ("t0", "far", start + timedelta(days=3000), "far")]
    last, want = {}, {"none": False}
    for tenant, event, at, entry in sorted((r for r in rows if r[2]), key=lambda r: (r[2], r[3])):
        key = (tenant, event)
        want[entry] = key not in last or at >= last[key] + timedelta(hours=24)
        if want[entry]:
            last[key] = at
    df = spark.createDataFrame(rows, "tenant_id string, event_id string, ingest_ts timestamp, entry_id string")
    assert {r.entry_id: r.first_seen for r in replay_guard(df).collect()} == want
    empty = replay_guard(df.limit(0))
    assert empty.count() == 0 and "first_seen" in empty.columns
