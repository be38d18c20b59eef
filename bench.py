"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (timed runs per query after one warm-up, best kept; default 3).
``feature_set_outer_joins`` is the six-outer-join form of F9, the comparison
plan facts instead.
Each query is executed in full through the ``noop`` sink (no collect).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from signalspark import queries as Q  # noqa: E402
from signalspark.session import build_session  # noqa: E402
from tests.joined_form import joined_feature_set  # noqa: E402

HEADLINE = ["feature_set", "session_aggregates", "upsert_features", "stream_landing"]
OTHERS = ["landed_counts_by_partition", "velocity_1m", "cardinality_exact", "geo_distance", "outcomes",
          "replay_guard", "quota_admission", "emit_since", "retain_last_n"]


def _run(spark, fn, sf_dir) -> float:
    t = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def plan_report(spark, sf_dir: str) -> str:
    """Markdown table of executed-plan facts per registered query."""
    lines = ["| query | exchanges | file scans | python nodes | pushed filters |", "| --- | --- | --- | --- | --- |"]
    for name, fn in sorted(Q.QUERIES.items()):
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        py = sum(plan.count(k) for k in ("ArrowEvalPython", "BatchEvalPython", "FlatMapGroupsInPandas",
                                         "MapInPandas"))
        pushed = "yes" if "PushedFilters: [" in plan and "PushedFilters: []" not in plan else "no"
        lines.append(f"| {name} | {plan.count('Exchange ') + plan.count('Exchange(')} | "
                     f"{plan.count('FileScan')} | {py} | {pushed} |")
    return "\n".join(lines)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    scratch = tempfile.mkdtemp(prefix="signalspark-bench-")
    spark = build_session(f"local[{cpus}]", app="signalspark-bench", shuffle_partitions=int(cpus) * 2,
                          conf={"spark.checkpoint.dir": f"{scratch}/ckpt", "spark.driver.memory": "8g",
                                "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024)})
    spark.sparkContext.setLogLevel("ERROR")
    if "--plans" in sys.argv:
        print(plan_report(spark, sf_dir))
        spark.stop()
        return

    def outer_join_form(spark, d):
        return joined_feature_set(Q.signals(spark, d))

    fns = {"feature_set": Q.QUERIES["feature_set"], "feature_set_outer_joins": outer_join_form}
    fns.update({name: Q.QUERIES[name] for name in HEADLINE[1:] + OTHERS})
    times = {}
    for name, fn in fns.items():
        _run(spark, fn, sf_dir)  # warm-up: JIT, file listing, Python workers
        times[name] = round(min(_run(spark, fn, sf_dir) for _ in range(repeat)), 3)

    n_raw = Q.load_raw(spark, sf_dir).count()
    n_events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    out = {
        "metric": "headline_total_sec",
        "value": round(sum(times[q] for q in HEADLINE), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "stream_landing_rows_per_sec": round(n_raw / times["stream_landing"], 1),
        "batch_landing_rows_per_sec": round(n_raw / times["landed_counts_by_partition"], 1),
        "feature_set_speedup_vs_outer_joins": round(times["feature_set_outer_joins"] / times["feature_set"], 2),
        "events": n_events,
        "cpus": int(cpus),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
