"""All due ticks in one pass hold the rows that ticks taken one by one hold."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from signalspark.operators import emit as em
from signalspark.operators import ticks
from signalspark.schema import FEATURES
from signalspark.session import work_dir
from signalspark.sources import files


def _features(spark, ends):
    rows = spark.createDataFrame([(i, e) for i, e in enumerate(ends)], "i int, at int")
    made = {"tenant_id": F.lit("t1"), "session_id": F.concat(F.lit("s"), "i"), "feature_window": F.lit("session"),
            "window_end": F.timestamp_seconds(F.lit(1_704_067_200) + F.col("at"))}
    made["dt"] = F.to_date(made["window_end"])
    return rows.select(*[made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in FEATURES.fields])


def _ticks(spark, out):
    got = spark.read.text(out).select("tick", F.get_json_object("value", "$.session_id").alias("s"))
    return sorted(sorted(r["s"]) for r in got.groupBy("tick").agg(F.collect_list("s").alias("s")).collect())


@pytest.mark.parametrize("limit", [1, 3, 7])
def test_pass_equals_single_ticks(spark, monkeypatch, limit):
    monkeypatch.setattr(ticks, "RANGE_TICKS", 1)  # many ranges
    feats = _features(spark, [(i * i * 7) % 23 for i in range(60)] + [5] * 9).cache()
    root = work_dir(spark, f"pass-{uuid.uuid4().hex[:6]}")
    while em.emit_since(spark, feats, f"{root}/c1", f"{root}/one", limit=limit):
        pass
    passes = []
    while n := em.emit_since(spark, feats, f"{root}/c2", f"{root}/all", limit=limit, all_due=True):
        passes.append(n)
    assert passes == [69]
    assert _ticks(spark, f"{root}/all") == _ticks(spark, f"{root}/one")
    assert em.load_cursor(spark, f"{root}/c1") == em.load_cursor(spark, f"{root}/c2")
    assert len(files.names(spark, f"{root}/c2")) == 1  # one commit, not one a tick


def test_pass_of_bounded_ticks(spark):
    feats = _features(spark, range(10))
    assert ticks.tick_cuts(feats, 4)[1] == 10
    cuts, n = ticks.tick_cuts(feats, 4, most=2)
    assert n == 8 and [c // 1_000_000 - 1_704_067_200 for c in cuts] == [3, 7]
    assert ticks.tick_cuts(feats.limit(0), 4) == ([], 0)
    newer = em.read_since(feats, dt.datetime(2024, 1, 1, 0, 0, 7))
    assert ticks.tick_cuts(newer, 4)[1] == 2
