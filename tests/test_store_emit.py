"""Feature store upsert, landing (batch = stream), backfill and emit."""

import json
import os
import tempfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from signalspark.operators import emit as em
from signalspark.plans import backfill as bf
from signalspark.plans import feature_set as fs
from signalspark.schema import FEATURES
from signalspark.sources import feature_store as store
from signalspark.sources import landing as land
from signalspark.sources.events import load_signals
from signalspark.sources.raw import load_raw, read_raw_files, write_raw_files
from signalspark.streaming.landing import start_landing

SF = "/root/testdata/sf0.001"


def _tmp():
    return tempfile.mkdtemp(prefix="signalspark-t-")


def _feature_rows(spark, rows):
    full = [r + (None,) * (len(FEATURES.fields) - len(r)) for r in rows]
    return spark.createDataFrame(full, FEATURES).drop("dt")


def test_upsert_is_idempotent_and_partition_local(spark):
    path = f"{_tmp()}/table"
    t0 = datetime(2026, 5, 1, 10, 0)
    a = _feature_rows(spark, [("t1", "s1", t0, "session", 1), ("t1", "s2", t0 + timedelta(days=1), "session", 2)])
    store.upsert_features(a, path)
    b = _feature_rows(spark, [("t1", "s1", t0, "session", 10), ("t2", "s9", t0, "session", 5)])
    store.upsert_features(b, path)
    store.upsert_features(b, path)  # same again: no change
    got = {(r.tenant_id, r.session_id): r.events_1m for r in store.read_features(spark, path).collect()}
    assert got == {("t1", "s1"): 10, ("t1", "s2"): 2, ("t2", "s9"): 5}
    # the untouched partition (t1, day 2) kept its original files
    assert os.path.isdir(f"{path}/tenant_id=t1/dt=2026-05-02")


def test_append_mode_duplicates(spark):
    path = f"{_tmp()}/table"
    a = _feature_rows(spark, [("t1", "s1", datetime(2026, 5, 1), "session", 1)])
    store.write_features(a, path, fmt="parquet", mode="append")
    store.write_features(a, path, fmt="parquet", mode="append")
    assert store.read_features(spark, path).count() == 2


def test_unknown_format_rejected(spark):
    import pytest
    with pytest.raises(ValueError):
        store.write_features(_feature_rows(spark, []), _tmp(), fmt="orc")


def test_stream_landing_equals_batch_landing(spark):
    root = _tmp()
    raw = load_raw(spark, SF)
    land.land_batch(raw, f"{root}/b/landed", f"{root}/b/bad", batch_id="b7")
    out = land.land_batch(raw, f"{root}/b/landed", f"{root}/b/bad", batch_id="b7")  # retried: no duplicates
    assert out["landed_rows"] == land.read_landed(spark, f"{root}/b/landed").count()
    assert out["quarantined_rows"] == land.read_quarantine(spark, f"{root}/b/bad").count() > 0
    write_raw_files(raw, f"{root}/raw", files=3)
    q = start_landing(read_raw_files(spark, f"{root}/raw", stream=True, max_files_per_trigger=1),
                      f"{root}/s/landed", f"{root}/s/bad", f"{root}/s/_ck")
    q.awaitTermination(300)
    bl, sl = land.read_landed(spark, f"{root}/b/landed"), land.read_landed(spark, f"{root}/s/landed")
    assert bl.count() > 0
    assert bl.exceptAll(sl).count() == 0 and sl.exceptAll(bl).count() == 0
    bq = land.read_quarantine(spark, f"{root}/b/bad").select("raw", "reason")
    sq = land.read_quarantine(spark, f"{root}/s/bad").select("raw", "reason")
    assert bq.count() > 0 and bq.exceptAll(sq).count() == 0 and sq.exceptAll(bq).count() == 0


def test_backfill_lookback_keeps_prior_session(spark):
    root = _tmp()
    sig = load_signals(spark, SF).withColumn("ts", F.col("ts") + F.expr("INTERVAL 12 HOURS"))
    land.write_landed(sig.withColumn("dt", F.to_date("ts")), f"{root}/landed", "b0")
    landed = land.read_landed(spark, f"{root}/landed")
    days = sorted(r.dt for r in landed.select("dt").distinct().collect())
    assert len(days) == 2
    full = fs.build_feature_set(landed).filter(F.to_date("window_end") == days[1])
    sliced = bf.backfill_features(landed, days[1], days[1])
    r = lambda d: d.select([F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in d.dtypes])  # noqa
    assert r(sliced).exceptAll(r(full)).count() == 0 and r(full).exceptAll(r(sliced)).count() == 0
    n = bf.run_backfill(spark, f"{root}/landed", f"{root}/table", days[1], days[1], fmt="parquet")
    assert n == full.count() == store.read_features(spark, f"{root}/table").count()


def _landed(spark, root, rows):
    from signalspark.schema import SIGNAL
    device = lambda ip, lat: (None, None, ip, "A", None, lat, 0.0 if lat is not None else None)
    df = spark.createDataFrame([(e, "bank", s, datetime.fromisoformat(t), device(ip, lat), None)
                                for e, s, t, ip, lat in rows], SIGNAL)
    land.write_landed(df.withColumn("dt", F.to_date("ts")), f"{root}/landed", "b0")
    return land.read_landed(spark, f"{root}/landed")


def test_backfill_reads_what_the_slice_needs(spark):
    """A prior session four days back, a session of several days and one that runs past the slice."""
    landed = _landed(spark, _tmp(), [
        ("a", "old", "2027-01-01T10:00:00", "1", 10.0), ("b", "u", "2027-01-05T10:00:00", "1", 50.0),
        ("c", "long", "2027-01-03T23:00:00", "1", None), ("d", "long", "2027-01-05T11:00:00", "2", None),
        ("e", "past", "2027-01-05T23:50:00", "1", None), ("f", "past", "2027-01-06T00:20:00", "2", None),
        ("g", "edge", "2027-01-04T23:59:30", "1", None)])
    full = fs.build_feature_set(landed)
    for start, end in (("2027-01-05", "2027-01-05"), ("2027-01-04", None), (None, "2027-01-05"), ("2027-01-06", "2027-01-09")):
        want = full
        if start:
            want = want.filter(F.to_date("window_end") >= F.lit(start).cast("date"))
        if end:
            want = want.filter(F.to_date("window_end") <= F.lit(end).cast("date"))
        got = bf.backfill_features(landed, start, end)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    one = {r.session_id: r for r in bf.backfill_features(landed, "2027-01-05", "2027-01-05").collect()
           if r.distinct_ips is not None}
    assert one["u"].geo_distance_km_prior > 4000 and one["long"].distinct_ips == 2 and "past" not in one


def test_backfill_drops_rows_of_a_shorter_input(spark):
    root = _tmp()
    rows = [("e", "past", "2027-01-05T23:50:00", "1", None), ("u", "other", "2027-01-05T08:00:00", "1", None)]
    _landed(spark, f"{root}/early", rows)
    _landed(spark, f"{root}/late", rows + [("f", "past", "2027-01-06T00:20:00", "2", None)])
    days = ("2027-01-05", "2027-01-06")
    bf.run_backfill(spark, f"{root}/early/landed", f"{root}/table", *days, fmt="parquet")
    bf.run_backfill(spark, f"{root}/late/landed", f"{root}/table", *days, fmt="parquet")
    table = store.read_features(spark, f"{root}/table").drop("dt")
    want = fs.build_feature_set(land.read_landed(spark, f"{root}/late/landed")).select(table.columns)
    assert sorted(map(str, table.collect())) == sorted(map(str, want.collect()))
    assert not [f for f in os.listdir(root) if f.startswith("_staging")]


def test_replace_empties_a_partition(spark, monkeypatch):
    """All rows of the first day are stale; a run lost before they go is finished by the recovery."""
    root, day = _tmp(), datetime(2027, 1, 5, 23, 50)
    early = _feature_rows(spark, [("t 1/x", "past", day, "session", 1)])
    late = _feature_rows(spark, [("t 1/x", "past", day + timedelta(hours=1), "session", 2)])
    replace = (spark.createDataFrame([("t 1/x", "past")], "_t string, _s string"), day.date(), None)
    left = lambda t: [r.events_1m for r in store.read_features(spark, f"{root}/{t}").collect()]
    for table in ("table", "lost"):
        store.upsert_features(early, f"{root}/{table}")
    store.upsert_features(late, f"{root}/table", replace=replace)
    assert left("table") == [2]
    with monkeypatch.context() as m:
        m.setattr(store, "_drop_emptied", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.upsert_features(late, f"{root}/lost", replace=replace)
    assert sorted(left("lost")) == [1, 2] and store.recover_upsert(spark, f"{root}/lost")
    assert left("lost") == [2]


def test_emit_tick(spark):
    root = _tmp()
    t1 = datetime(2026, 5, 1, 12, 0)
    feats = _feature_rows(spark, [("t1", "s1", t1, "session", 3), ("t1", "s2", t1 + timedelta(minutes=1), "session"),
                                  ("t1", "s0", t1 - timedelta(hours=2), "session", 1)])
    em.save_cursor(spark, f"{root}/cursor", t1 - timedelta(hours=1))
    n = em.emit_since(spark, feats, f"{root}/cursor", f"{root}/out", limit=1000)
    assert n == 2
    assert em.load_cursor(spark, f"{root}/cursor") == t1 + timedelta(minutes=1)
    payloads = [json.loads(r.value) for r in spark.read.text(f"{root}/out").collect()]
    assert {p["session_id"] for p in payloads} == {"s1", "s2"}
    p = next(p for p in payloads if p["session_id"] == "s2")
    assert p["schema_version"] == "1.0.0" and p["feature_window"] == "session"
    assert set(p["features"]) >= {"events_1m", "geo_distance_km_prior"} and p["features"]["events_1m"] is None
    assert em.emit_since(spark, feats, f"{root}/cursor", f"{root}/out2", limit=1000) == 0  # nothing new


def test_emit_limit_keeps_ties(spark):
    t1 = datetime(2026, 5, 1, 12, 0)
    feats = _feature_rows(spark, [("t1", f"s{i}", t1, "session") for i in range(3)] +
                          [("t1", "s9", t1 + timedelta(minutes=1), "session")])
    assert em.read_since(feats, t1 - timedelta(hours=1), limit=2).count() == 3
    assert em.read_since(feats, t1 - timedelta(hours=1), limit=2, with_ties=False).count() == 2


def test_cli_land_backfill_emit(spark):
    from signalspark import jobs
    root = _tmp()
    write_raw_files(load_raw(spark, SF), f"{root}/raw", files=2)
    jobs.main(["land", "--raw", f"{root}/raw", "--landed", f"{root}/landed", "--bad", f"{root}/bad", "--dedup"])
    landed = land.read_landed(spark, f"{root}/landed")
    assert landed.count() > 0
    # repeats within 24 h are dropped; the copy re-sent after 30 h (id % 97 = 10) is accepted again
    twice = {r.event_id for r in landed.groupBy("event_id").count().filter("count > 1").collect()}
    assert twice and all(int(e[1:]) % 97 == 10 for e in twice)
    assert landed.groupBy("event_id").count().agg(F.max("count")).first()[0] == 2
    jobs.main(["backfill", "--raw", f"{root}/landed", "--table", f"{root}/table", "--format", "parquet"])
    n = store.read_features(spark, f"{root}/table").count()
    assert n == fs.build_feature_set(landed).count()
    jobs.main(["emit", "--table", f"{root}/table", "--cursor", f"{root}/cursor", "--sink", f"{root}/out",
               "--limit", "0"])
    assert spark.read.text(f"{root}/out").count() == n


def test_export_reader_skips_blank_and_broken_lines(spark):
    root = _tmp()
    os.makedirs(f"{root}/x/y")
    good = {"tenant_id": "t1", "session_id": "s1", "window_end": "2026-05-01T12:00:00.000000Z",
            "feature_window": "session", "features": {"events_1m": 3}}
    with open(f"{root}/x/y/part.jsonl", "w") as f:
        f.write(json.dumps(good) + "\n\n{broken\n")
    with open(f"{root}/x/ignored.txt", "w") as f:
        f.write(json.dumps(good) + "\n")
    rows = em.flatten_exported(em.read_exported(spark, root)).collect()
    assert len(rows) == 1 and rows[0].events_1m == 3 and rows[0].window_end == datetime(2026, 5, 1, 12, 0)


def test_landing_start_from_drops_older_entries(spark):
    root = _tmp()
    raw = load_raw(spark, SF)
    cut = raw.agg(F.expr("percentile_approx(ingest_ts, 0.5)")).first()[0]
    write_raw_files(raw, f"{root}/raw", files=2)
    q = start_landing(read_raw_files(spark, f"{root}/raw", stream=True), f"{root}/landed", f"{root}/bad",
                      f"{root}/_ck", start_from=cut)
    q.awaitTermination(300)
    expected, _ = __import__("signalspark.operators.ingest", fromlist=["x"]).parse_and_split(
        raw.filter(F.col("ingest_ts") >= F.lit(cut)))
    got = land.read_landed(spark, f"{root}/landed")
    assert got.count() == expected.count() > 0


def test_stream_emit_writes_one_payload_per_row(spark):
    from signalspark.streaming.emit import start_emit
    root = _tmp()
    feats = _feature_rows(spark, [("t1", "s1", datetime(2026, 5, 1, 12), "session", 3),
                                  ("t2", "s2", datetime(2026, 5, 2, 12), "session", 4)])
    store.upsert_features(feats, f"{root}/table")
    q = start_emit(spark, f"{root}/table", f"{root}/out", f"{root}/_ck")
    q.awaitTermination(300)
    payloads = [json.loads(r.value) for r in spark.read.text(f"{root}/out").collect()]
    assert sorted(p["features"]["events_1m"] for p in payloads) == [3, 4]


def test_stream_landing_with_replay_guard(spark):
    root = _tmp()
    write_raw_files(load_raw(spark, SF), f"{root}/raw", files=2)
    q = start_landing(read_raw_files(spark, f"{root}/raw", stream=True), f"{root}/landed", f"{root}/bad",
                      f"{root}/_ck", dedup=True)
    q.awaitTermination(300)
    landed = land.read_landed(spark, f"{root}/landed")
    assert landed.count() > 0
    # as in batch: only the copies re-sent after 30 h (id % 97 = 10) are accepted again
    twice = {r.event_id for r in landed.groupBy("tenant_id", "event_id").count().filter("count > 1").collect()}
    assert twice and all(int(e[1:]) % 97 == 10 for e in twice)
    assert land.read_quarantine(spark, f"{root}/bad").count() > 0


def test_two_streams_do_not_overwrite_each_other(spark):
    root = _tmp()
    raw = load_raw(spark, SF)
    write_raw_files(raw, f"{root}/raw", files=1)
    for ck in ("a", "b"):  # two queries, both start at epoch 0
        q = start_landing(read_raw_files(spark, f"{root}/raw", stream=True), f"{root}/landed", f"{root}/bad",
                          f"{root}/_ck_{ck}")
        q.awaitTermination(300)
    once, _ = __import__("signalspark.operators.ingest", fromlist=["x"]).parse_and_split(raw)
    assert land.read_landed(spark, f"{root}/landed").count() == 2 * once.count()


def test_upsert_recovers_lost_overwrite(spark):
    path = f"{_tmp()}/table"
    t0 = datetime(2026, 5, 1, 10, 0)
    store.upsert_features(_feature_rows(spark, [("t1", "s1", t0, "session", 1)]), path)
    # simulate a run that staged its merge but died before the overwrite
    stage = f"{_tmp()}/stage"
    merged = _feature_rows(spark, [("t1", "s1", t0, "session", 5)]).withColumn("dt", F.to_date("window_end"))
    merged.write.partitionBy("tenant_id", "dt").parquet(stage)
    store._set_pending(spark, path, stage)
    assert store.recover_upsert(spark, path)
    assert [r.events_1m for r in store.read_features(spark, path).collect()] == [5]
    assert not store.recover_upsert(spark, path)


def test_backfill_tenant_slice_prunes_and_matches(spark):
    root = _tmp()
    sig = load_signals(spark, SF)
    land.write_landed(sig.withColumn("dt", F.to_date("ts")), f"{root}/landed", "b0")
    landed = land.read_landed(spark, f"{root}/landed")
    d = landed.agg(F.min("dt")).first()[0]
    sliced = bf.backfill_features(landed, d, d, tenant="t1")
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tenant_id" in plan or "(tenant_id" in plan
    full = fs.build_feature_set(landed).filter(F.col("tenant_id") == "t1")
    r = lambda x: x.select([F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in x.dtypes])  # noqa
    assert r(sliced).exceptAll(r(full)).count() == 0 and r(full).exceptAll(r(sliced)).count() == 0


def test_partition_values_stay_strings(spark):
    root = _tmp()
    sig = load_signals(spark, SF).limit(5).withColumn("tenant_id", F.lit("007"))
    land.write_landed(sig.withColumn("dt", F.to_date("ts")), f"{root}/landed", "b0")
    got = land.read_landed(spark, f"{root}/landed")
    assert dict(got.dtypes)["tenant_id"] == "string"
    assert {r.tenant_id for r in got.select("tenant_id").distinct().collect()} == {"007"}


def test_typing_scan_reads_only_used_leaves(spark):
    from signalspark.operators import features as fx
    root = _tmp()
    land.write_landed(load_signals(spark, SF).withColumn("dt", F.to_date("ts")), f"{root}/landed", "b0")
    plan = fx.typing_cadence_variance(land.read_landed(spark, f"{root}/landed"))._jdf.queryExecution() \
        .executedPlan().toString()
    schema = plan[plan.index("ReadSchema: "):].split("\n")[0]
    assert "typing_cps" in schema and "kind" in schema
    assert "mouse_entropy" not in schema and "dwell_ms" not in schema and "fingerprint" not in schema


def test_stream_holds_back_open_windows(spark):
    from signalspark.streaming import features as sfm
    root = _tmp()
    sig = load_signals(spark, SF)
    land.write_landed(sig.withColumn("dt", F.to_date("ts")), f"{root}/landed", "b0")
    q = sfm.start_velocity(sfm.read_landed_stream(spark, f"{root}/landed"), "5 minutes", f"{root}/out", f"{root}/_ck")
    sfm.run_to_end(q, 300)
    streamed = spark.read.parquet(f"{root}/out")
    from signalspark.operators import features as fx
    batch = fx.velocity_counts(sig, "5 minutes")
    max_ts = sig.agg(F.max("ts")).first()[0]
    closed = batch.filter(F.col("window_end") <= F.lit(max_ts - timedelta(minutes=10)))
    assert streamed.count() == closed.count() < batch.count()
    assert streamed.exceptAll(closed).count() == 0


def test_stateful_stream_guard_carries_state_across_batches(spark):
    from signalspark.streaming.features import run_to_end, start_append
    from signalspark.streaming.guard import replay_guard_stateful
    root = _tmp()
    schema = "tenant_id string, event_id string, entry_id string, ingest_ts timestamp"
    t0 = datetime(2026, 5, 1, 0, 0)
    for i, h in enumerate((0, 20, 30)):  # one micro-batch run per arrival
        spark.createDataFrame([("t1", "e1", f"{h}", t0 + timedelta(hours=h)), ("t1", f"x{i}", "u", t0)], schema) \
            .write.mode("append").parquet(f"{root}/in")
        src = spark.readStream.schema(schema).parquet(f"{root}/in")
        run_to_end(start_append(replay_guard_stateful(src), f"{root}/out", f"{root}/_ck"), 300)
    got = {r.entry_id: r.first_seen for r in spark.read.parquet(f"{root}/out").filter("event_id = 'e1'").collect()}
    assert got == {"0": True, "20": False, "30": True}  # 20 h blocked by 0 h; 30 h accepted (no refresh)


def test_stateful_stream_quota_across_batches(spark):
    from signalspark.streaming.features import run_to_end, start_append
    from signalspark.streaming.guard import quota_stateful
    root = _tmp()
    schema = "tenant_id string, ingest_ts timestamp"
    t0 = datetime(2026, 5, 1, 0, 0)
    for rows in ([("t", t0)] * 4, [("t", t0 + timedelta(seconds=1))] * 2):  # rate 1/s, capacity 3
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{root}/in")
        src = spark.readStream.schema(schema).parquet(f"{root}/in")
        run_to_end(start_append(quota_stateful(src, rps=1, burst=3), f"{root}/out", f"{root}/_ck"), 300)
    got = sorted((r.sec, r.n, r.admitted) for r in spark.read.parquet(f"{root}/out").collect())
    s0 = int(t0.replace(tzinfo=__import__("datetime").timezone.utc).timestamp())
    assert got == [(s0, 4, 3), (s0 + 1, 2, 1)]


def test_read_since_nothing_newer(spark):
    feats = _feature_rows(spark, [("t1", "s1", datetime(2026, 5, 1, 12), "session", 1)])
    assert em.read_since(feats, datetime(2026, 5, 2), limit=10).count() == 0
    assert em.next_cursor(em.read_since(feats, datetime(2026, 5, 2), limit=10), datetime(2026, 5, 2)) \
        .first()["cursor"] == datetime(2026, 5, 2)  # never moves back


def test_emit_only_what_changed(spark, monkeypatch):
    root, t = _tmp(), datetime(2027, 4, 2, 9)
    rows = [("shop", f"s{i}", t + timedelta(hours=i), "session", i) for i in range(30)]
    store.upsert_features(_feature_rows(spark, rows), f"{root}/table")
    tick = lambda **kw: em.emit_changed(spark, store.read_features(spark, f"{root}/table"), f"{root}/out/_emitted",
                                        f"{root}/out", **kw)
    assert tick() == 30 and tick() == 0
    changed = [(*r[:4], r[4] + 100) for r in rows[5:8]] + [("shop", "new", t, "session", 1)] + rows[10:12]
    store.upsert_features(_feature_rows(spark, changed), f"{root}/table")
    assert tick() == 4 and tick() == 0
    said = [json.loads(r.value) for r in spark.read.text(f"{root}/out").collect()]
    assert len(said) == 34
    assert {p["session_id"] for p in said if p["features"]["events_1m"] and p["features"]["events_1m"] >= 100} == {"s5", "s6", "s7"}
    last = em._ledger_ticks(spark, f"{root}/out/_emitted")[-1]
    store.upsert_features(_feature_rows(spark, [(*rows[0][:4], 7)]), f"{root}/table")
    monkeypatch.setattr(em, "LEDGER_FOLDERS", 1)  # the tick also merges the ledger
    assert tick(tick=last + 1) == 1 and tick(tick=last + 1) == 1  # a repeated tick overwrites its own
    assert len(em._ledger_ticks(spark, f"{root}/out/_emitted")) == 2 and tick() == 0


def test_changed_digest_ignores_last_bits_and_matches_null_keys(spark):
    root = _tmp()
    rows = _feature_rows(spark, [(None, "s", datetime(2027, 4, 2), "session", 1), ("t", None, None, "session", None)])
    rows = rows.withColumn("typing_cps_mean", F.lit(0.1 + 0.2))
    assert em.emit_changed(spark, rows, f"{root}/l", f"{root}/o") == 2
    assert em.emit_changed(spark, rows.withColumn("typing_cps_mean", F.lit(0.3)), f"{root}/l", f"{root}/o") == 0
    assert em.emit_changed(spark, rows.withColumn("typing_cps_mean", F.lit(0.31)), f"{root}/l", f"{root}/o") == 2


def test_cursor_keeps_two_states(spark):
    root = _tmp()
    for h in range(5):
        em.save_cursor(spark, root, datetime(2027, 1, 1, h))
    assert len(os.listdir(root)) == 2 and em.load_cursor(spark, root) == datetime(2027, 1, 1, 4)


@pytest.mark.parametrize("kw", [{"mode": "append"}, {"replace": (None, None, None)}])
def test_formats_refuse_what_they_do_not_support(spark, kw):
    rows = _feature_rows(spark, [("t", "s", datetime(2027, 4, 2), "session", 1)])
    with pytest.raises(ValueError, match="plain upsert"):
        store.write_features(rows, "t", fmt="delta", **kw)
