"""Quantile sketches, sustained alerts and quarantine replay."""

import math
import os
import random
import tempfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from signalspark.operators import alerts as al
from signalspark.sources import landing as land
from signalspark.sources import replay

T = datetime(2027, 6, 1, 10)


@pytest.mark.parametrize("q", [0.5, 0.99, 1.0])
def test_quantile_is_within_its_error_and_merges(spark, q):
    rng = random.Random(5)
    rows = [("t", T + timedelta(seconds=rng.randrange(300)), rng.lognormvariate(0, 2)) for _ in range(3000)]
    rows += [("t", T, 0.0), ("t", T, -3.0), ("t", T, None), ("t", T, float("nan")), (None, T, 5.0), ("u", None, 1.0)]
    df = spark.createDataFrame(rows, "tenant_id string, ts timestamp, v double")
    parts = [al.minute_bins(df.filter(F.pmod(F.hash("v"), F.lit(3)) == i), "v") for i in range(3)]
    merged = parts[0].unionByName(parts[1]).unionByName(parts[2])
    got = {r.tenant_id: r for r in al.window_quantile(merged, q).collect()}
    values = sorted(v for t, _, v in rows if t == "t" and v is not None and not math.isnan(v))
    exact = values[math.ceil(q * len(values)) - 1]
    assert set(got) == {"t", None} and got["t"].n == len(values)
    assert abs(got["t"].p - exact) <= al.ERROR * exact * 1.0001
    assert al.window_quantile(al.minute_bins(df.filter("false"), "v"), q).count() == 0


def test_sustained_stretches(spark):
    at = lambda i: T + timedelta(minutes=5 * i)
    hot = {"a": [1, 2, 3, 7, 10, 11], "b": [1], None: [4, 5]}
    rows = [(t, at(i), 1.0 if i in h else 0.0) for t, h in hot.items() for i in range(14) if (t, i) != ("a", 9)]
    df = spark.createDataFrame(rows, "tenant_id string, window_end timestamp, p double")
    got = sorted(((r.tenant_id or "", r.alert_start, r.alert_end, r.windows) for r in
                  al.sustained(df, F.col("p") > 0.5, "5 minutes", "10 minutes").collect()))
    assert got == [("", at(3), at(5), 2), ("a", at(0), at(3), 3), ("a", at(9), at(11), 2)]


def test_replay_lands_once_and_survives_a_loss(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="replay-")
    good = '{"event_id":"e%d","session_id":"s","ts":"2027-06-01T10:00:00Z"%s}'
    rows = [("di:signals:t", f"{i}-0", good % (i, ',"extra":1' if i % 2 else ""), T) for i in range(10)]
    rows += [("di:signals:t", "x-0", "{", T), ("di:signals:t", "y-0", None, T)]
    raw = spark.createDataFrame(rows, "stream string, entry_id string, data string, ingest_ts timestamp")
    args = (f"{root}/bad", f"{root}/landed")
    land.land_batch(raw.filter("entry_id < '5'"), args[1], args[0], "b1")
    land.land_batch(raw.filter("entry_id >= '5'"), args[1], args[0], "b2")
    assert land.read_landed(spark, args[1]).count() == 5
    fix = lambda df: df.withColumn("data", F.replace("data", F.lit(',"extra":1'), F.lit("")))
    with monkeypatch.context() as m:  # lost before the replayed folders go
        m.setattr(replay, "_finish", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            replay.replay_quarantine(spark, *args, fix)
    for _ in range(2):
        replay.replay_quarantine(spark, *args, fix)
        assert sorted(r.event_id for r in land.read_landed(spark, args[1]).collect()) == [f"e{i}" for i in range(10)]
        assert sorted(r.reason for r in land.read_quarantine(spark, args[0]).collect()) == ["empty_body", "not_an_object"]
    assert [n for n in os.listdir(args[0]) if n.startswith("_")] in ([], ["_SUCCESS"])
    assert replay.replay_quarantine(spark, f"{root}/none", args[1])["batch_id"] is None
