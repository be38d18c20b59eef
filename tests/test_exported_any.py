"""Exported rows whose features have any name and shape."""

import json

import pytest

from signalspark.operators import emit as em

AT = "2031-05-06T07:08:09.5Z"


def _lines(tmp_path, *lines):
    folder = tmp_path / "deep" / "er"
    folder.mkdir(parents=True)
    (folder / "rows.jsonl").write_text("\n".join(lines) + "\n")
    (tmp_path / "rows.txt").write_text('{"tenant_id":"other","window_end":"%s"}\n' % AT)
    return str(tmp_path)


def test_unknown_features_reach_the_payload(spark, tmp_path):
    features = {"score": 0.125, "tags": ["a", None, {"b": 1}], "none": None, "big": 12345678901234567890, "text": "é\n"}
    root = _lines(tmp_path, json.dumps({"tenant_id": "t", "session_id": "s", "window_end": AT, "feature_window": "w",
                                        "features": features, "more": 1}))
    rows = em.read_exported_any(spark, root)
    got = em.to_payload_json(em.payload_struct(rows, "2031-01-01")).collect()
    assert [r.key for r in got] == ["t:s"]
    payload = json.loads(got[0].value)
    assert payload["features"] == features
    assert payload["window_end"].startswith("2031-05-06T07:08:09.5")


def test_lines_that_are_no_rows_are_skipped(spark, tmp_path):
    good = '{"tenant_id":"t%d","window_end":"' + AT + '"%s}'
    bad = ["", "{", "[1]", "7", '"x"', "null", good % (0, ',"features":[1]'), good % (0, ',"features":"x"'), good % (0, ',"session_id":5'),
           '{"tenant_id":1,"window_end":"%s"}' % AT, '{"tenant_id":"t0","window_end":7}', '{"tenant_id":"t0","window_end":"2031-05-06"}',
           '{"tenant_id":"t0"}', '{"tenant_id":"t0","window_end":null}']
    root = _lines(tmp_path, *bad, good % (1, ""), good % (2, ',"features":null,"session_id":null'), good % (3, ',"features":{}'),
                  good % (3, ',"features":{}'))
    assert sorted(r.tenant_id for r in em.read_exported_any(spark, root).collect()) == ["t1", "t2", "t3", "t3"]


def test_a_line_over_the_limit_fails_the_read(spark, tmp_path):
    root = _lines(tmp_path, '{"tenant_id":"t","window_end":"%s","features":{"x":"%s"}}' % (AT, "y" * 300))
    assert em.read_exported_any(spark, root).count() == 1
    with pytest.raises(Exception, match="bytes in exported rows"):
        em.read_exported_any(spark, root, max_line_bytes=200).collect()
