"""F8 and F9 on a stream against their batch forms after every micro-batch."""

import datetime as dt
import tempfile

import pytest

from signalspark.operators.features import geo_distance_vs_prior
from signalspark.plans.feature_set import build_feature_set
from signalspark.queries import round_doubles
from signalspark.schema import SIGNAL
from signalspark.sources.feature_store import read_features
from signalspark.streaming import feature_state as fstate

DAY = dt.datetime(2030, 3, 4)
#: the table keys by SQL equality; rows with a NULL key are compared as distances only
KEYED = "tenant_id IS NOT NULL AND session_id IS NOT NULL"


def _sig(n, tenant, session, minutes, lat=None, typed=(), fp="f"):
    device = {"os": "x", "os_version": "1", "ip": f"i{n % 3}", "fingerprint": fp, "battery": None, "geo_lat": lat,
              "geo_lon": None if lat is None else 10.0}
    behavioral = [{"kind": "type", "dwell_ms": None, "typing_cps": c, "mouse_entropy": 0.5, "target_elem": None} for c in typed]
    return (f"e{n}", tenant, session, DAY + dt.timedelta(minutes=minutes), device, behavioral)


# the second batch moves starts within an hour, over hours and over midnight, empties hours and fills a gap
BATCHES = [
    [_sig(1, "a", "s1", 30, 1.0, (1.0, 2.0)), _sig(2, "a", "s2", 95, 2.0, (3.0,)), _sig(3, "a", "s3", 60 * 9, 3.0),
     _sig(4, "b", "s1", 40, 50.0, (2.0,)), _sig(5, None, "s9", 10, 7.0), _sig(6, None, None, 70, 8.0), _sig(7, "a", "s6", 5)],
    [_sig(11, "a", "s2", 20, 4.0, (5.0, 1.0), "g"), _sig(12, "a", "s3", -30, 5.0), _sig(13, "a", "s4", 60 * 5, 6.0, (9.0,)),
     _sig(14, "b", "s2", 41, 51.0), _sig(15, None, None, 5, 9.0)],
    [],
    [_sig(21, "a", "s1", 200, 9.0, (4.0,)), _sig(22, "b", "s1", 41, 52.0, (7.0,)), _sig(23, "a", "s6", 60 * 26, -3.0)],
]


@pytest.fixture(scope="module")
def runs(spark):
    """(distances, table, all signals so far) after each micro-batch; the second one runs twice."""
    root = tempfile.mkdtemp(prefix="feature-state-")
    seen, done = [], []
    for epoch, batch in enumerate(BATCHES):
        seen = seen + batch
        rows = spark.createDataFrame(batch, SIGNAL)
        for _ in range(2 if epoch == 1 else 1):  # a retried micro-batch
            fstate.merge_features(rows, f"{root}/state", f"{root}/table", epoch)
        table = read_features(spark, f"{root}/table").drop("dt").filter(KEYED)
        done.append((_rows(fstate.read_distances(spark, f"{root}/state", epoch)), _rows(table), seen))
    return done


def _rows(df):
    return sorted((tuple(r) for r in round_doubles(df.select(sorted(df.columns))).collect()), key=repr)


@pytest.mark.parametrize("epoch", range(len(BATCHES)))
def test_stream_equals_batch_after_every_micro_batch(spark, runs, epoch):
    distances, table, seen = runs[epoch]
    events = spark.createDataFrame(seen, SIGNAL)
    assert distances == _rows(geo_distance_vs_prior(events))
    assert table == _rows(build_feature_set(events).filter(KEYED))
