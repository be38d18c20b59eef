"""Feature operators on literal rows and equivalences."""

import math
import statistics
from datetime import datetime, timezone

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from signalspark.functions.geo import haversine_km
from signalspark.functions.windows import window_label
from signalspark.operators import features as fx
from signalspark.operators import sessions as sx
from signalspark.operators.ordered import bucketed_lag
from signalspark.plans import feature_set as fs
from signalspark.schema import SIGNAL
from signalspark.sources.events import load_signals
from tests.joined_form import joined_feature_set

SF = "/root/testdata/sf0.01"


def _ts(s):
    return datetime.fromisoformat(s).replace(tzinfo=timezone.utc)


def _dev(**kw):
    base = dict(os=None, os_version=None, ip=None, fingerprint=None, battery=None, geo_lat=None, geo_lon=None)
    base.update(kw)
    return Row(**base)


def _beh(kind, **kw):
    base = dict(kind=kind, dwell_ms=None, typing_cps=None, mouse_entropy=None, target_elem=None)
    base.update(kw)
    return Row(**base)


def _events(spark, rows):
    return spark.createDataFrame(
        [(e, t, s, _ts(ts), d, b) for e, t, s, ts, d, b in rows], SIGNAL)


@pytest.mark.parametrize("exact", [True, False])
def test_cardinality_per_session(spark, exact):
    seen = [("u", "A", "10.0.0.1", "linux"), ("u", "A", "10.0.0.9", None), ("u", "B", "10.0.0.9", "linux"),
            ("u", None, "10.0.0.4", "linux"), ("v", "A", None, None)]
    ev = _events(spark, [(f"c{i}", "bank", session, f"2027-01-0{i + 1}T00:00:00", _dev(fingerprint=fp, ip=ip, os=os), [])
                         for i, (session, fp, ip, os) in enumerate(seen)])
    got = {r.session_id: r for r in fx.device_ip_fp_cardinality(ev, exact).collect()}
    for session in "uv":
        rows = [x for x in seen if x[0] == session]
        for column, at in (("distinct_fingerprints", 1), ("distinct_ips", 2), ("distinct_os", 3)):
            assert got[session][column] == len({x[at] for x in rows} - {None})
    assert [got[s].window_end.day for s in "uv"] == [4, 5]


def test_typing_statistics_use_type_elements_only(spark):
    speeds = [3.5, 8.25, 1.0, 4.75]
    ev = _events(spark, [
        ("k0", "bank", "u", "2027-02-01T08:00:00", None, [_beh("type", typing_cps=x) for x in speeds[:3]]),
        ("k1", "bank", "u", "2027-02-01T09:00:00", None, [_beh("scroll", typing_cps=99.0), _beh("type", typing_cps=speeds[3])]),
        ("k2", "bank", "u", "2027-02-01T10:00:00", None, [_beh("hover", typing_cps=50.0)]),
        ("k3", "bank", "w", "2027-02-01T10:00:00", None, [_beh("hover")])])
    (r,) = fx.typing_cadence_variance(ev).collect()
    assert r.typing_cps_mean == pytest.approx(statistics.mean(speeds))
    assert r.typing_cps_variance == pytest.approx(statistics.variance(speeds))
    assert r.window_end.hour == 9


def test_typing_single_value_has_null_variance(spark):
    ev = _events(spark, [("e1", "t1", "s1", "2026-05-01T12:00:00", None, [_beh("type", typing_cps=4.0)])])
    r = fx.typing_cadence_variance(ev).first()
    assert r.typing_cps_variance is None and r.typing_cps_mean == 4.0


@pytest.mark.parametrize("tenant", ["bank", None])
def test_distance_to_the_previous_session(spark, tenant):
    """Three sessions a quarter of a great circle apart; a NULL tenant is a tenant of its own."""
    points = [(0.0, 0.0), (0.0, 90.0), (90.0, 0.0)]
    ev = _events(spark, [(f"g{i}", tenant, f"u{i}", f"2027-03-01T{i * 9:02d}:30:00", _dev(geo_lat=lat, geo_lon=lon), [])
                         for i, (lat, lon) in enumerate(points)])
    km = [r.geo_distance_km_prior for r in fx.geo_distance_vs_prior(ev).orderBy("session_id").collect()]
    quarter = 6371.0 * math.pi / 2
    assert km[0] is None and km[1:] == pytest.approx([quarter, quarter])


def test_null_session_keeps_every_feature(spark):
    ev = _events(spark, [("n0", "bank", None, "2027-03-01T00:00:00", _dev(fingerprint="A", geo_lat=1.0, geo_lon=1.0),
                          [_beh("type", typing_cps=2.0, mouse_entropy=0.5)])])
    rows = fs.build_feature_set(ev).collect()
    values = {c: max((r[c] for r in rows if r[c] is not None), default=None) for c in
              ("distinct_fingerprints", "mouse_entropy_avg", "typing_cps_mean", "events_1m")}
    assert values == {"distinct_fingerprints": 1, "mouse_entropy_avg": 0.5, "typing_cps_mean": 2.0, "events_1m": 1}


def test_window_labels():
    assert [window_label(w) for w in ("1 minute", "5 minutes", "60 minutes", "1 hour", "90 seconds", "2 days")] == [
        "1m", "5m", "1h", "1h", "90s", "2d"]
    with pytest.raises(KeyError):
        window_label("1 month")


def test_haversine_null_guard_and_clamp(spark):
    df = spark.createDataFrame([(None, 0.0, 1.0, 1.0), (0.0, 0.0, 0.0, 180.0), (10.0, 10.0, 10.0, 10.0)],
                               "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_km("a", "b", "c", "d")).collect()]
    assert got[0] is None  # least(1, NULL) must not turn "no prior" into a distance
    assert got[1] == pytest.approx(3.141592653589793 * 6371.0)
    assert got[2] == 0.0


def test_explode_outer_keeps_empty_and_null(spark):
    ev = _events(spark, [
        ("e1", "t1", "s1", "2026-05-01T12:00:00", None, []),
        ("e2", "t1", "s1", "2026-05-01T12:00:01", None, None),
        ("e3", "t1", "s1", "2026-05-01T12:00:02", None, [_beh("click"), _beh("scroll")]),
    ])
    assert fx.explode_behavioral(ev).count() == 4


def test_mouse_all_null_session_has_row(spark):
    ev = _events(spark, [("e1", "t1", "s1", "2026-05-01T12:00:00", None, [_beh("click")])])
    r = fx.mouse_entropy_avg(ev).first()
    assert r.mouse_entropy_avg is None


def test_session_gap_is_inclusive(spark):
    ev = _events(spark, [
        ("e1", "t1", "s1", "2026-05-01T12:00:00", _dev(fingerprint="a"), []),
        ("e2", "t1", "s1", "2026-05-01T12:10:00", _dev(fingerprint="b"), []),  # exactly 10 min: same
        ("e3", "t1", "s1", "2026-05-01T12:20:00.000001", _dev(fingerprint="b"), []),  # 10 min + 1 us: new
    ])
    for impl in (sx.session_aggregates, sx.session_aggregates_window):
        rows = sorted(impl(ev).collect(), key=lambda r: r.session_start)
        assert [r.event_count for r in rows] == [2, 1]
        assert [r.distinct_fingerprints for r in rows] == [2, 1]


def test_cells_equal_session_window(spark):
    sig = load_signals(spark, SF)
    b = sx.session_aggregates_window(sig)
    assert b.count() == 4880
    a = sx.session_aggregates(sig)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    a = sx.session_aggregates(sig, materialize=False)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_velocity_rollup_equals_direct(spark):
    sig = load_signals(spark, SF)
    rows = fs.velocity_rows(fs.cells(sig))
    for lbl, w in (("5m", "5 minutes"), ("1h", "1 hour")):
        c = f"events_{lbl}"
        rolled = rows.filter(F.col(c).isNotNull()).groupBy("tenant_id", "session_id", "window_end") \
            .agg(F.sum(c).alias(c))
        direct = fx.velocity_counts(sig, w)
        assert rolled.exceptAll(direct).count() == 0 and direct.exceptAll(rolled).count() == 0


def test_union_form_equals_outer_joins(spark):
    sig = load_signals(spark, SF)
    r = lambda d: d.select([F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in d.dtypes])  # noqa
    u, j = r(fs.build_feature_set(sig)), r(joined_feature_set(sig))
    assert u.count() == 19599
    assert u.exceptAll(j).count() == 0 and j.exceptAll(u).count() == 0


def test_bucketed_lag_equals_plain_lag(spark):
    from pyspark.sql import Window
    s = fx.session_geo_starts(load_signals(spark, SF))
    plain = s.withColumn("prior_lat", F.lag("lat").over(
        Window.partitionBy("tenant_id").orderBy("session_start", "session_id")))
    for unit in ("minute", "hour", "day"):
        b = bucketed_lag(s, ["tenant_id"], ["session_start", "session_id"], ["lat", "lon"],
                         bucket=F.date_trunc(unit, "session_start")).drop("prior_lon")
        assert b.exceptAll(plain).count() == 0 and plain.exceptAll(b).count() == 0
