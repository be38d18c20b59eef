"""Landing: what a task holds does not follow the input, and each payload is judged without needless work."""

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from signalspark.operators import ingest as ing
from signalspark.schema import MAX_PAYLOAD_BYTES, RAW_ENVELOPE
from signalspark.session import work_dir
from signalspark.sources import files, raw as rw
from signalspark.sources import landing as land

SF = "/root/testdata/sf0.01"


def test_partitions_follow_the_events(spark, monkeypatch):
    assert rw.raw_partitions(spark, SF) == spark.sparkContext.defaultParallelism
    few = rw.load_raw(spark, SF)
    monkeypatch.setattr(rw, "PARTITION_EVENTS", 500)
    assert rw.raw_partitions(spark, SF) == 20  # 10,000 events
    many = rw.load_raw(spark, SF)
    sizes = many.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert sizes <= 700 and many.exceptAll(few).isEmpty() and few.exceptAll(many).isEmpty()


def test_raw_files_in_shares_hold_the_same_rows(spark):
    root, raw = work_dir(spark, "shares"), rw.load_raw(spark, SF)
    rw.write_raw_files(raw, f"{root}/raw", files=2, share=3)
    assert len([n for n in files.names(spark, f"{root}/raw") if n.startswith("part-")]) == 6
    back = rw.read_raw_files(spark, f"{root}/raw").select(*raw.columns)
    assert back.exceptAll(raw).isEmpty() and raw.exceptAll(back).isEmpty()


def test_landing_keeps_one_form_of_a_row(spark):
    c = ing.classify(rw.load_raw(spark, SF))
    for strict in (True, False):
        slim = ing.landing_columns(c, strict)
        ok, kept = ing.lands(strict)
        assert slim.filter(F.col("data").isNotNull() == F.col(kept).isNotNull()).isEmpty()
        for a, b in zip(ing.split_classified(slim, strict), ing.split_classified(c, strict)):
            a, b = a.drop("quarantined_at"), b.drop("quarantined_at")
            assert a.columns == b.columns and a.count() == b.count() and a.exceptAll(b).isEmpty()


def test_landed_and_quarantined_are_counted(spark):
    root, raw = work_dir(spark, "counted"), rw.load_raw(spark, SF)
    out = land.land_batch(raw, f"{root}/landed", f"{root}/bad", "b")
    assert out["landed_rows"] == land.read_landed(spark, f"{root}/landed").count()
    assert out["landed_rows"] + out["quarantined_rows"] == raw.count()


def test_landing_keeps_its_classified_rows_on_disk(spark, monkeypatch):
    """A cached partition that went to disk comes back whole; the copy is read a few rows at a time, then removed."""
    root, raw, seen, write = work_dir(spark, "copied"), rw.load_raw(spark, SF).coalesce(2), {}, land.write_quarantine

    def spy(bad, path, batch_id):
        seen["plan"], seen["files"] = bad._jdf.queryExecution().executedPlan().toString(), bad.inputFiles()
        groups = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in seen["files"]]
        seen["rows"] = [m.row_group(i).num_rows for m in groups for i in range(m.num_row_groups)]
        write(bad, path, batch_id)

    monkeypatch.setattr(land, "write_quarantine", spy)
    out = land.land_batch(raw, f"{root}/landed", f"{root}/bad", "b")
    assert "InMemoryTableScan" not in seen["plan"]
    assert max(seen["rows"]) <= land.COPY_ROWS < sum(seen["rows"]) == out["landed_rows"] + out["quarantined_rows"] == raw.count()
    assert not any(files.exists(spark, f) for f in seen["files"])


def test_reasons_of_blank_oversized_and_odd_keys(spark):
    body = '"event_id":"e","session_id":"s","tenant_id":"t"'
    odd = {" \n": "empty_body", " " * (MAX_PAYLOAD_BYTES + 1): "payload_too_large", " null ": "missing_event_id",
           "{%s}" % body: "accepted", '{%s,"device":{"os":"a","os_version" : "b"}}' % body: "accepted",
           '{%s,"device":{"os":"a","x":"b"}}' % body: "unknown_field", '{%s,"device":{"kind":"a"}}' % body: "unknown_field",
           '{%s,"device":{"\\u006fs":"a"}}' % body: "accepted", '{%s,"device":{"\\u0078":"a"}}' % body: "unknown_field",
           '{%s,"device":{"os":"\\"x\\":"}}' % body: "accepted", '{%s,"device":{"OS":"a"}}' % body: "accepted",
           '{%s,"behavioral":[{"kind":"a"},{"os":"a"}]}' % body: "unknown_field",
           '{%s,"behavioral":[{"kind":"a","target_elem":"b"},{}]}' % body: "accepted"}
    rows = spark.createDataFrame([("di:signals:t", str(i), d) for i, d in enumerate(odd)], "stream string, entry_id string, data string")
    raw = rows.withColumn("ingest_ts", F.lit("2024-01-01 00:00:00").cast("timestamp")).select(*RAW_ENVELOPE.fieldNames())
    got = {r["entry_id"]: r["reason"] for r in ing.classify(raw).select("entry_id", "reason").collect()}
    assert [got[str(i)] for i in range(len(odd))] == list(odd.values())
