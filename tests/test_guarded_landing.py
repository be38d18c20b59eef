"""Landing behind the replay guard and the token bucket: exact over batches, in any order."""

import json
import random
import tempfile
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from signalspark.operators import quota as qa
from signalspark.sources import guarded as gd
from signalspark.sources import landing as land

START = datetime(2027, 3, 1, 8)


def entries(n=120, keys=25, hours=110, seed=1):
    """(stream, entry_id, data, ingest_ts): repeats of few events over several days."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        k = rng.randrange(keys)
        body = {"event_id": f"ev{k}", "session_id": f"se{i}", "ts": "2027-03-01T08:00:00Z"}
        at = START + timedelta(hours=rng.choice([rng.uniform(0, hours), 24 * rng.randrange(4)]))
        rows.append((f"di:signals:shop{k % 3}", f"{i}-0", json.dumps(body), at))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "stream string, entry_id string, data string, ingest_ts timestamp")


def fold(rows):
    """entry_id -> accepted, by the fold over all entries in arrival order."""
    last, out = {}, {}
    for stream, entry, data, at in sorted(rows, key=lambda r: (r[3], r[1])):
        key = (stream, json.loads(data)["event_id"])
        out[entry] = key not in last or at >= last[key] + timedelta(hours=24)
        if out[entry]:
            last[key] = at
    return out


def landed_sessions(spark, path):
    return sorted(r.session_id for r in land.read_landed(spark, path).collect())


def accepted_sessions(rows):
    ok = fold(rows)
    return sorted(json.loads(r[2])["session_id"] for r in rows if ok[r[1]])


def test_shuffled_batches_equal_the_fold_over_all(spark):
    root = tempfile.mkdtemp(prefix="guard-")
    rows = entries()
    random.Random(2).shuffle(rows)  # most entries come days late
    for i in range(4):
        land.land_batch(frame(spark, rows[i::4]), f"{root}/landed", f"{root}/bad", f"b{i}", dedup=True)
        seen = [r for j in range(i + 1) for r in rows[j::4]]
        assert landed_sessions(spark, f"{root}/landed") == accepted_sessions(seen)
    got = {r.entry_id: r.first_seen for r in gd.landed_decisions(spark, f"{root}/landed").collect()}
    assert got == fold(rows)
    counts = {(r.tenant_id, r.outcome): r.n for r in gd.landed_outcomes(spark, f"{root}/landed").collect()}
    want = Counter((s.split(":")[-1], "accepted" if got[e] else "duplicate") for s, e, _, _ in rows)
    assert counts == dict(want)


def test_a_lost_batch_is_repeated_and_a_committed_one_is_not(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="guard-")
    rows = entries(40, 8, 60, seed=3)
    first, second = rows[::2], rows[1::2]
    args = (f"{root}/landed", f"{root}/bad")
    land.land_batch(frame(spark, first), *args, "one", dedup=True)
    with monkeypatch.context() as m:
        m.setattr(gd, "_commit", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            land.land_batch(frame(spark, second), *args, "two", dedup=True)
    land.land_batch(frame(spark, second), *args, "two", dedup=True)
    assert land.land_batch(frame(spark, second), *args, "two", dedup=True)["landed_rows"] == 0
    assert landed_sessions(spark, args[0]) == accepted_sessions(rows)
    assert [b for _, b in land.commits(spark, args[0])] == ["one", "two"]


def test_guard_keeps_invalid_and_empty_batches(spark):
    root = tempfile.mkdtemp(prefix="guard-")
    args = (f"{root}/landed", f"{root}/bad")
    land.land_batch(frame(spark, []), *args, "none", dedup=True)
    bad = [("di:signals:shop0", "1-0", "{", START), ("di:signals:shop0", "2-0", None, None), (None, "3-0", "{}", START)]
    land.land_batch(frame(spark, bad), *args, "bad", dedup=True, quota=(1.0, 1.0))
    assert land.read_quarantine(spark, args[1]).count() == 3
    land.land_batch(frame(spark, entries(6, 6)), *args, "good", dedup=True)
    assert len(landed_sessions(spark, args[0])) == 6


def bucket(rows, rps, burst):
    """entry -> admitted: the bucket over seconds in order, requests of a second by time and id."""
    tokens, last, out = {}, {}, {}
    seconds = {}
    for tenant, entry, at in rows:
        seconds.setdefault((tenant, int(at.timestamp())), []).append((at, entry))
    for (tenant, sec), requests in sorted(seconds.items(), key=lambda x: x[0][1]):
        have = min(burst, tokens[tenant] + (sec - last[tenant]) * rps) if tenant in tokens else burst
        for i, (_, entry) in enumerate(sorted(requests)):
            out[entry] = i < int(have)
        tokens[tenant], last[tenant] = have - min(len(requests), int(have)), sec
    return out


def test_bucket_continues_over_batches(spark):
    rng = random.Random(4)
    rows = sorted(((f"t{rng.randrange(2)}", f"{i:04d}", START + timedelta(seconds=rng.choice([0, 5, 40]) + rng.randrange(12),
                                                                         microseconds=rng.randrange(900_000)))
                   for i in range(160)), key=lambda r: r[2])
    want, got, state = bucket(rows, 0.5, 6.0), {}, None
    cuts = [0, 50, 90, 160]
    whole = lambda i: next(j for j in range(i, 161) if j in (0, 160) or int(rows[j][2].timestamp()) != int(rows[j - 1][2].timestamp()))
    for a, b in zip(cuts, cuts[1:]):
        part = spark.createDataFrame(rows[whole(a):whole(b)], "tenant_id string, entry_id string, ingest_ts timestamp")
        flagged, buckets = qa.admit(part, 0.5, 6.0, initial=state)
        got |= {r.entry_id: r.admitted for r in flagged.collect()}
        state = spark.createDataFrame(buckets.collect(), qa.BUCKET)
    assert got == want and not all(want.values())


def test_a_late_request_counts_at_the_last_second(spark):
    state = spark.createDataFrame([("t", 1.0, int(START.timestamp()) + 100)], qa.BUCKET)
    late = spark.createDataFrame([("t", "a", START), ("t", "b", START), ("u", "c", START)],
                                 "tenant_id string, entry_id string, ingest_ts timestamp")
    flagged, buckets = qa.admit(late, 1.0, 5.0, initial=state)
    assert {r.entry_id: r.admitted for r in flagged.collect()} == {"a": True, "b": False, "c": True}
    assert {r.tenant_id: (r.tokens, r.last_sec - int(START.timestamp())) for r in buckets.collect()} == {"t": (0.0, 100), "u": (4.0, 0)}


def test_one_hot_second_needs_no_whole_sort(spark):
    rows = [("t", f"{i:05d}", START + timedelta(microseconds=(i * 37) % 1_000_000)) for i in range(5000)]
    df = spark.createDataFrame(rows, "tenant_id string, entry_id string, ingest_ts timestamp")
    got = {r.entry_id for r in qa.quota_admission(df, rps=1.0, burst=1234.0).filter("admitted").collect()}
    assert got == {e for _, e, _ in sorted(rows, key=lambda r: (r[2], r[1]))[:1234]}
    assert qa.quota_admission(df.withColumn("tenant_id", F.lit(None).cast("string")), 1, 1).filter("admitted").count() == 5000
