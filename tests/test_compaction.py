"""Compaction of landed files: same rows, few files, readers and lost runs undisturbed."""

import json
import random
import tempfile
from collections import Counter
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from signalspark.sources import compaction as cp
from signalspark.sources import files
from signalspark.sources import landing as land
from signalspark.sources import raw as rw
from signalspark.streaming.landing import start_landing

START = datetime(2027, 5, 3, 6)
NOW = timedelta(seconds=-5)  # everything replaced so far is old enough


def entries(n=80, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        body = {"event_id": f"ev{rng.randrange(60)}", "session_id": f"se{i}", "ts": "2027-05-03T06:00:00Z"}
        rows.append((f"di:signals:shop/{i % 2}", f"{i}-0", json.dumps(body), START + timedelta(minutes=rng.randrange(2000))))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "stream string, entry_id string, data string, ingest_ts timestamp")


def sessions(spark, path):
    return Counter(r.session_id for r in land.read_landed(spark, path).collect())


def landed_files(path):
    return sum("tenant_id=" in str(p) for p in Path(path).rglob("*.parquet"))


def test_rows_stay_files_go(spark):
    root = tempfile.mkdtemp(prefix="compact-")
    rows, path = entries(), f"{root}/landed"
    for i in range(4):
        land.land_batch(frame(spark, rows[20 * i:20 * i + 20]), path, f"{root}/bad", f"b{i}")
    want, planned = sessions(spark, path), land.read_landed(spark, path)
    out = cp.compact(spark, path)
    assert out["files_before"] == 8 and out["files_after"] == 2
    assert sessions(spark, path) == want and sum(want.values()) == 80
    assert Counter(r.session_id for r in planned.collect()) == want  # a reader that planned before
    assert land.read_landed(spark, path).filter("tenant_id = 'shop/1'").count() == 40
    assert cp.vacuum(spark, path) == 0  # too fresh
    assert cp.vacuum(spark, path, NOW) == 8 and landed_files(path) == 2
    assert sessions(spark, path) == want and cp.vacuum(spark, path, NOW) == 0
    assert cp.compact(spark, path)["files_after"] == 0  # nothing left to pack
    # new batches join the small bins of before
    land.land_batch(frame(spark, entries(20, 4)), path, f"{root}/bad", "late")
    want = sessions(spark, path)
    assert cp.compact(spark, path)["files_after"] == 2 and sessions(spark, path) == want
    cp.vacuum(spark, path, NOW)
    assert landed_files(path) == 2 and sessions(spark, path) == want
    with pytest.raises(ValueError, match="compacted"):
        land.land_batch(frame(spark, rows[:20]), path, f"{root}/bad", "b0")
    assert sessions(spark, path) == want


def test_a_lost_run_changes_nothing(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="compact-lost-")
    rows, path = entries(30), f"{root}/landed"
    for i in range(3):
        land.land_batch(frame(spark, rows[10 * i:10 * i + 10]), path, f"{root}/bad", f"b{i}")
    want = sessions(spark, path)

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(cp, "_commit", lost)
        with pytest.raises(RuntimeError, match="lost"):
            cp.compact(spark, path)
    assert sessions(spark, path) == want
    land.land_batch(frame(spark, rows[:10]), path, f"{root}/bad", "b0")  # still landed anew under its id
    assert sessions(spark, path) == want
    cp.compact(spark, path)
    assert sessions(spark, path) == want
    assert cp.vacuum(spark, path, timedelta(days=1)) == 2  # the lost run's bins
    assert sessions(spark, path) == want


def test_bins_keep_to_the_target(spark):
    rng = random.Random(5)
    rows = [("t", START.date(), "batch", f"u{i:03d}", rng.randrange(1, 120), 1, START) for i in range(300)]
    units = spark.createDataFrame(rows, "tenant_id string, dt date, kind string, unit string, bytes long, files long, written timestamp")
    got = cp.packed(units, 100).groupBy("n").agg(F.sum("bytes").alias("b"), F.sum("files").alias("f")).collect()
    small = [r[4] for r in rows if r[4] < 50]
    assert max(r.b for r in got) < 150 and min(r.f for r in got) > 1
    assert sum(r.b for r in got) >= sum(small) - 50 and len(got) <= sum(small) / 100 + 1


def test_newest_epoch_and_uncommitted_batches_wait(spark):
    root = tempfile.mkdtemp(prefix="compact-stream-")
    path, rows = f"{root}/landed", entries(60)
    rw.write_raw_files(frame(spark, rows), f"{root}/raw", files=5)
    src = rw.read_raw_files(spark, f"{root}/raw", stream=True, max_files_per_trigger=1)
    start_landing(src, path, f"{root}/bad", f"{root}/_ckpt").awaitTermination()
    newest = land.stream_batch_id(f"{root}/_ckpt", 4)
    want = sessions(spark, path)
    cp.compact(spark, path)
    cp.vacuum(spark, path, NOW)
    assert sessions(spark, path) == want
    left = {n for t in files.names(spark, path) if t.startswith("tenant") for d in files.names(spark, f"{path}/{t}")
            for n in files.names(spark, f"{path}/{t}/{d}")}
    assert left == {f"batch_id={newest}"}


def test_guarded_table_keeps_its_decisions(spark):
    root = tempfile.mkdtemp(prefix="compact-guard-")
    path, rows = f"{root}/landed", entries(90, 7)
    random.Random(8).shuffle(rows)
    for i in range(3):
        land.land_batch(frame(spark, rows[i::4]), path, f"{root}/bad", f"g{i}", dedup=True)
    want = sessions(spark, path)
    cp_out = land.compact_landed(spark, path, keep=NOW)
    assert [o["files_after"] for o in cp_out] == [2, 2]
    assert sessions(spark, path) == want
    land.land_batch(frame(spark, rows[3::4]), path, f"{root}/bad", "g3", dedup=True)  # flips rows that lie in bins
    whole = tempfile.mkdtemp(prefix="compact-whole-")
    land.land_batch(frame(spark, rows), f"{whole}/landed", f"{whole}/bad", "all", dedup=True)
    assert sessions(spark, path) == sessions(spark, f"{whole}/landed")
