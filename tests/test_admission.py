"""Stream landing with a bound of entries a stream and tick: fair, in order, nothing lost or repeated."""

import json
import random
import tempfile
import time
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from signalspark.sources import files
from signalspark.sources import landing as land
from signalspark.sources import raw as rw
from signalspark.streaming import admission as ad

START = datetime(2027, 6, 1, 9)


def entries(streams, seed=1, base=0):
    """Entries of (stream, number) pairs, every one with a session of its own."""
    rng, rows = random.Random(seed), []
    for stream, n in streams:
        for i in range(n):
            body = {"event_id": f"ev{base}-{stream}-{i}", "session_id": f"se{base}-{stream}-{i:04d}", "ts": "2027-06-01T09:00:00Z"}
            rows.append((f"di:signals:{stream}", f"{base}-{i:04d}", json.dumps(body), START + timedelta(seconds=rng.randrange(400))))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "stream string, entry_id string, data string, ingest_ts timestamp")


def by_tick(spark, landed):
    """tick -> stream -> sessions landed."""
    out = defaultdict(lambda: defaultdict(list))
    for r in spark.read.schema(land.LANDED_FILES).parquet(landed).collect():
        out[int(r.batch_id[-12:])][r.tenant_id].append(r.session_id)
    return out


def test_ranks_and_plans(spark):
    rows = entries([("a", 60), ("b", 7)]) + [(None, "n1", "x", None), (None, "n2", "x", START), ("di:signals:b", "q", "x", None)]
    got = ad.ranked(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    order = defaultdict(list)
    for r in sorted(got, key=lambda r: r["rank"]):
        order[r.stream].append((r.ingest_ts or datetime.min, r.entry_id))
    assert all(o == sorted(o) for o in order.values())
    assert all(sorted(r["rank"] for r in got if r.stream == s) == list(range(1, len(o) + 1)) for s, o in order.items())
    left = [("a", 1, 10, 4), ("a", 2, 3, 0), ("a", 5, 9, 0), ("b", 5, 2, 0), ("c", 3, 50, 0)]
    plan = ad.planned(spark.createDataFrame(left, "stream string, arrived long, n long, done long"), 8).collect()
    assert {(r.stream, r.arrived): r.take for r in plan} == {
        ("a", 1): 6, ("a", 2): 2, ("a", 5): 0, ("b", 5): 2, ("c", 3): 8}


def test_bounded_fair_and_complete(spark):
    root = tempfile.mkdtemp(prefix="admit-")
    landed, bad, ckpt = f"{root}/landed", f"{root}/bad", f"{root}/_ckpt"
    first, second = entries([("noisy", 25), ("calm", 4)]), entries([("noisy", 6), ("new", 3)], 2, base=1)
    rw.write_raw_files(frame(spark, first), f"{root}/raw/one", files=1)
    src = lambda: rw.read_raw_files(spark, f"{root}/raw/*", stream=True, max_files_per_trigger=1)
    ad.start_bounded_landing(src(), landed, bad, ckpt, 10).awaitTermination()
    ticks = by_tick(spark, landed)
    assert {t: Counter({s: len(v) for s, v in per.items()}) for t, per in ticks.items()} == {1: Counter(noisy=10, calm=4)}
    # a restart finds a new stream; old entries come first
    rw.write_raw_files(frame(spark, second), f"{root}/raw/two", files=1)
    ad.start_bounded_landing(src(), landed, bad, ckpt, 10).awaitTermination()
    assert ad.finish_landing(spark, landed, bad, ckpt, 10) == 2
    assert ad.finish_landing(spark, landed, bad, ckpt, 10) == 0
    ticks = by_tick(spark, landed)
    counts = [{s: len(v) for s, v in sorted(ticks[t].items())} for t in sorted(ticks)]
    assert counts == [{"calm": 4, "noisy": 10}, {"new": 3, "noisy": 10}, {"noisy": 10}, {"noisy": 1}]
    arrival = [json.loads(r[2])["session_id"] for part in (first, second)
               for r in sorted((r for r in part if r[0].endswith("noisy")), key=lambda r: (r[3], r[1]))]
    assert [sorted(ticks[t]["noisy"]) for t in sorted(ticks)] == [sorted(arrival[i:i + 10]) for i in range(0, 31, 10)]
    assert not [n for n in files.names(spark, f"{ad.admission_root(ckpt)}/segments") if n.startswith("arrived=")]


@pytest.mark.parametrize("lost_at", ["land", "commit"])
def test_lost_ticks_are_finished_once(spark, monkeypatch, lost_at):
    root = tempfile.mkdtemp(prefix="admit-lost-")
    adm, landing = f"{root}/adm", {"landed": f"{root}/landed", "bad": f"{root}/bad", "rules": {}}
    rows = entries([("a", 9), ("b", 2)])

    def lost(*args, **_):
        if lost_at == "commit" and "/commits/" not in args[1]:
            return put(*args)
        raise RuntimeError("lost")

    put = files.put
    with monkeypatch.context() as m:
        m.setattr(*((ad, "land_batch") if lost_at == "land" else (files, "put")), lost)
        with pytest.raises(RuntimeError, match="lost"):
            ad.tick(spark, adm, 4, landing, frame(spark, rows), "epoch0")
    assert ad.tick(spark, adm, 4, landing, frame(spark, rows), "epoch0") is False  # finished, and not taken in again
    while ad.tick(spark, adm, 4, landing):
        pass
    want = Counter(json.loads(r[2])["session_id"] for r in rows)
    assert Counter(r.session_id for r in land.read_landed(spark, f"{root}/landed").collect()) == want
    assert [len(v) for _, per in sorted(by_tick(spark, f"{root}/landed").items()) for _, v in sorted(per.items())] == [4, 2, 4, 1]


def test_start_positions(spark):
    root = tempfile.mkdtemp(prefix="admit-from-")
    rows = entries([("a", 12), ("b", 5)])
    rw.write_raw_files(frame(spark, rows), f"{root}/raw", files=1)
    begin = START + timedelta(seconds=200)
    ad.start_bounded_landing(rw.read_raw_files(spark, f"{root}/raw", stream=True), f"{root}/landed", f"{root}/bad",
                             f"{root}/_ckpt", start={"di:signals:a": begin}).awaitTermination()
    want = {json.loads(r[2])["session_id"] for r in rows if r[0].endswith("b") or r[3] >= begin}
    assert {r.session_id for r in land.read_landed(spark, f"{root}/landed").collect()} == want


def test_ticks_go_on_while_the_source_is_quiet(spark):
    root = tempfile.mkdtemp(prefix="admit-beat-")
    rows = entries([("a", 7)])
    rw.write_raw_files(frame(spark, rows), f"{root}/raw", files=1)
    q = ad.start_bounded_landing(rw.read_raw_files(spark, f"{root}/raw", stream=True), f"{root}/landed", f"{root}/bad",
                                 f"{root}/_ckpt", 3, available_now=False, processing_time="1 second")
    try:
        until = time.time() + 90
        while time.time() < until and q.isActive and len(files.names(spark, f"{ad.admission_root(f'{root}/_ckpt')}/commits")) < 3:
            time.sleep(0.5)
    finally:
        q.stop()
    assert q.exception() is None
    assert [len(per["a"]) for _, per in sorted(by_tick(spark, f"{root}/landed").items())] == [3, 3, 1]
