"""Command-line jobs: landing (batch or stream), replay, compaction, backfill, emit.

    python -m signalspark.jobs land     --raw PATH --landed PATH --bad PATH [--stream --checkpoint PATH]
    python -m signalspark.jobs replay   --bad PATH --landed PATH [--dedup]
    python -m signalspark.jobs compact  --landed PATH [--target-mb 128] [--vacuum-hours 24]
    python -m signalspark.jobs backfill --raw LANDED --table PATH [--start D --end D --tenant T --format parquet]
    python -m signalspark.jobs emit     --table PATH --cursor PATH --sink PATH [--limit 1000 | --stream --checkpoint P]

Paths must be on storage every executor sees. ``spark.checkpoint.dir`` must
name a shared folder when the job runs on a cluster.
"""

from __future__ import annotations

import argparse
import json
import logging

from pyspark.sql import functions as F

from signalspark.session import build_session, checkpoint_root

log = logging.getLogger("signalspark")


def _args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="signalspark.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    a = sub.add_parser("land")
    a.add_argument("--raw", required=True, help="JSON-lines raw entries (stream, entry_id, data, ingest_ts)")
    a.add_argument("--landed", required=True)
    a.add_argument("--bad", required=True)
    a.add_argument("--batch-id", required=False, default=None,
                   help="unique id of this batch (default: name of the raw folder)")
    a.add_argument("--dedup", action="store_true", help="replay guard over all batches of the landed table")
    a.add_argument("--rps", type=float, default=None, help="requests a second of each tenant; the rest is quarantined")
    a.add_argument("--burst", type=float, default=None, help="capacity of each tenant's bucket (default: twice --rps)")
    a.add_argument("--wire-compat", action="store_true", help="zero values as on the wire (omitted)")
    a.add_argument("--start-from", default=None, help="stream: leave out entries that arrived before this time")
    a.add_argument("--lenient", action="store_true", help="original landing rule (event_id present)")
    a.add_argument("--stream", action="store_true")
    a.add_argument("--checkpoint")
    a.add_argument("--per-stream", type=int, default=None, help="stream: entries a tick takes from one stream at most")
    a.add_argument("--max-files-per-trigger", type=int, default=None)
    r = sub.add_parser("replay")
    r.add_argument("--bad", required=True, help="quarantine whose entries go through the rules again")
    r.add_argument("--landed", required=True)
    r.add_argument("--dedup", action="store_true")
    c = sub.add_parser("compact")
    c.add_argument("--landed", required=True)
    c.add_argument("--target-mb", type=int, default=128)
    c.add_argument("--vacuum-hours", type=float, default=None, help="delete files that were replaced that long ago")
    b = sub.add_parser("backfill")
    b.add_argument("--raw", required=True, help="landed table")
    b.add_argument("--table", required=True)
    b.add_argument("--start")
    b.add_argument("--end")
    b.add_argument("--tenant")
    b.add_argument("--format", default=None, help="parquet | delta | iceberg")
    e = sub.add_parser("emit")
    e.add_argument("--table", required=True)
    e.add_argument("--sink", required=True)
    e.add_argument("--cursor")
    e.add_argument("--limit", type=int, default=1000)
    e.add_argument("--changed", action="store_true", help="only rows that differ from what was emitted (no cursor)")
    e.add_argument("--stream", action="store_true")
    e.add_argument("--checkpoint")
    return p.parse_args(argv)


def main(argv=None) -> None:
    logging.basicConfig(level=logging.INFO, format="%(message)s")
    args = _args(argv)
    spark = build_session(app=f"signalspark-{args.job}")
    checkpoint_root(spark)
    if args.job == "land":
        from signalspark.sources.landing import land_batch
        from signalspark.sources.raw import read_raw_files
        rules = {"strict": not args.lenient, "dedup": args.dedup, "wire_compat": args.wire_compat,
                 "quota": (args.rps, args.burst or 2 * args.rps) if args.rps else None}
        if args.stream:
            from signalspark.streaming.landing import start_landing
            raw = read_raw_files(spark, args.raw, stream=True, max_files_per_trigger=args.max_files_per_trigger)
            if args.per_stream:
                from signalspark.streaming.admission import start_bounded_landing
                if args.start_from:
                    raw = raw.filter(F.col("ingest_ts") >= F.lit(args.start_from).cast("timestamp"))
                q = start_bounded_landing(raw, args.landed, args.bad, args.checkpoint, args.per_stream,
                                          available_now=False, **rules)
            else:
                q = start_landing(raw, args.landed, args.bad, args.checkpoint, start_from=args.start_from,
                                  available_now=False, processing_time="2 seconds", **rules)
            q.awaitTermination()
        else:
            bid = args.batch_id or args.raw.rstrip("/").split("/")[-1]
            out = land_batch(read_raw_files(spark, args.raw), args.landed, args.bad, bid, **rules)
            log.info(json.dumps({"event": "landed", **out}))
    elif args.job == "replay":
        from signalspark.sources.replay import replay_quarantine
        out = replay_quarantine(spark, args.bad, args.landed, dedup=args.dedup)
        log.info(json.dumps({"event": "replayed", **out}))
    elif args.job == "compact":
        from datetime import timedelta

        from signalspark.sources.landing import compact_landed
        keep = None if args.vacuum_hours is None else timedelta(hours=args.vacuum_hours)
        for out in compact_landed(spark, args.landed, args.target_mb << 20, keep):
            log.info(json.dumps({"event": "compacted", **out}))
    elif args.job == "backfill":
        from signalspark.plans.backfill import run_backfill
        n = run_backfill(spark, args.raw, args.table, args.start, args.end, args.tenant, args.format)
        log.info(json.dumps({"event": "backfill_complete", "table": args.table, "rows": n}))
    elif args.job == "emit":
        if args.stream:
            from signalspark.streaming.emit import start_emit
            start_emit(spark, args.table, args.sink, args.checkpoint, available_now=False,
                       changed_only=args.changed).awaitTermination()
        elif args.changed:
            from signalspark.operators.emit import emit_changed
            from signalspark.sources.feature_store import read_features
            n = emit_changed(spark, read_features(spark, args.table), f"{args.sink}/_emitted", args.sink)
            log.info(json.dumps({"event": "emitted", "rows": n}))
        else:
            from signalspark.operators.emit import emit_since
            from signalspark.sources.feature_store import read_features
            n = emit_since(spark, read_features(spark, args.table), args.cursor, args.sink, args.limit)
            log.info(json.dumps({"event": "emitted", "rows": n}))


if __name__ == "__main__":
    main()
