"""The streamed replay guard folds many keys in one call and keeps one state for them."""

from pyspark.sql import functions as F

from signalspark.operators.dedup import replay_guard
from signalspark.session import work_dir
from signalspark.streaming.features import run_to_end, start_append
from signalspark.streaming.guard import replay_guard_stateful


def test_groups_of_keys_over_micro_batches(spark):
    root, groups = work_dir(spark, "guard-groups"), 4
    ids = spark.range(120)
    hours = F.explode(F.array(*[F.lit(h) for h in (0, 20, 30, 50, 54)]))
    rows = ids.select("id", hours.alias("h")).filter("h = 0 OR id % 3 = 0").select(
        F.lit("t1").alias("tenant_id"), F.concat(F.lit("e"), "id").alias("event_id"),
        F.concat_ws("-", "id", "h").alias("entry_id"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("h") * 3600 + F.col("id")).alias("ingest_ts"), "h")
    for h in (0, 20, 30, 50, 54):  # a micro-batch each
        rows.filter(F.col("h") == h).drop("h").coalesce(1).write.mode("append").parquet(f"{root}/in")
    rows = rows.drop("h")
    src = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    q = start_append(replay_guard_stateful(src, groups=groups), f"{root}/out", f"{root}/_ck")
    run_to_end(q, 300)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["numInputRows"]]
    assert len(held) == 5 and max(held) <= groups  # not a state and a call for every key
    got = {(r.entry_id, r.first_seen) for r in spark.read.parquet(f"{root}/out").collect()}
    want = {(r.entry_id, r.first_seen) for r in replay_guard(rows).collect()}
    assert got == want and ("0-20", False) in got and ("0-30", True) in got and ("0-54", True) in got
