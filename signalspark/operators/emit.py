"""Incremental emit of feature rows as decision payloads.

Batch form: ``emit_since`` reads rows newer than a cursor, takes the first
``limit`` by ``window_end`` (keeping ties with the last one, so no row is
skipped for good), writes one JSON payload per row and then commits a new
cursor. Stream form: a file-source stream over the feature table with a
checkpoint (see :mod:`signalspark.streaming.emit`).
"""

from __future__ import annotations

import datetime as dt
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from signalspark.schema import EXPORTED_FEATURE_ROW, FEATURE_KEYS, FEATURE_VALUE_COLUMNS, SCHEMA_VERSION
from signalspark.operators.ticks import tick_cuts
from signalspark.session import checkpoint_table
from signalspark.sources import files

PAYLOAD_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
CURSOR = StructType([StructField("cursor", TimestampType())])


def read_since(features: DataFrame, since, limit: int = 0, with_ties: bool = True) -> DataFrame:
    """A1 + A2: rows with ``window_end > since``; first ``limit`` by ``window_end`` (<= 0: all).

    The cut is one scalar found with a distributed top-k (``orderBy().limit()``
    keeps at most ``limit`` rows per partition before merging); the rows are
    then a plain range filter that reaches the Parquet scan. Rows tied with
    the last one are kept when ``with_ties``. On a table partitioned by ``dt`` both ends
    are partition filters too.
    """
    since = F.lit(since).cast("timestamp")
    newer = features.filter(F.col("window_end") > since)
    by_day = "dt" in features.columns
    if by_day:
        newer = newer.filter(F.col("dt") >= F.to_date(since))
    if limit is None or limit <= 0:
        return newer
    if not with_ties:
        return newer.orderBy("window_end", "tenant_id", "session_id").limit(limit)
    cut = newer.select("window_end").orderBy("window_end").limit(limit).agg(F.max("window_end")).first()[0]
    if cut is None:
        return newer.limit(0)
    upto = newer.filter(F.col("window_end") <= F.lit(cut))
    return upto.filter(F.col("dt") <= F.to_date(F.lit(cut))) if by_day else upto


def payload_struct(features: DataFrame, emitted_at=None, keep: tuple[str, ...] = ()) -> DataFrame:
    """A3: keys, ``features``, ``schema_version``, ``emitted_at``; a ``features`` column (S12) is passed on as it is.
    Columns to ``keep`` follow."""
    at = F.current_timestamp() if emitted_at is None else F.lit(emitted_at).cast("timestamp")
    feats = F.col("features") if "features" in features.columns else F.struct(*[F.col(c) for c in FEATURE_VALUE_COLUMNS])
    return features.select("tenant_id", "session_id", "window_end", "feature_window",
                           feats.alias("features"), F.lit(SCHEMA_VERSION).alias("schema_version"),
                           at.alias("emitted_at"), *keep)


def to_payload_json(payloads: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON text per payload; NULL features are written as ``null``, not dropped. Columns to ``keep`` stay beside it."""
    opts = {"ignoreNullFields": "false", "timestampFormat": PAYLOAD_TS_FORMAT}
    return payloads.select(
        F.concat_ws(":", "tenant_id", "session_id").alias("key"),
        F.to_json(F.struct(*[c for c in payloads.columns if c not in keep]), opts).alias("value"), *keep)


def next_cursor(emitted: DataFrame, since) -> DataFrame:
    """A4: the new cursor = max emitted ``window_end``, never before ``since``."""
    return emitted.agg(F.greatest(F.max("window_end"), F.lit(since).cast("timestamp")).alias("cursor"))


def load_cursor(spark: SparkSession, cursor_path: str, default=None):
    """Latest committed cursor (A6); ``default`` when none was committed yet."""
    for state in reversed(files.names(spark, cursor_path)[-2:]):  # the newest may be incomplete
        row = spark.read.schema(CURSOR).parquet(f"{cursor_path}/{state}").first()
        if row:
            return row["cursor"]
    return default


def save_cursor(spark: SparkSession, cursor_path: str, cursor) -> None:
    """A new state folder per commit; readers take the newest, all but two go."""
    v = f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:6]}"
    spark.createDataFrame([(cursor,)], CURSOR).write.parquet(f"{cursor_path}/v={v}")
    for old in files.names(spark, cursor_path)[:-2]:
        files.delete(spark, f"{cursor_path}/{old}")


#: features equal to so many places have not changed: recomputed sums differ in their last bits
DIGEST_PLACES = 6
#: ledger folders after which a tick merges them
LEDGER_FOLDERS = 50
LEDGER_SCHEMA = "tenant_id string, session_id string, window_end timestamp, feature_window string, digest string, " \
                "seq bigint, dt date"


def row_digest(features: DataFrame) -> Column:
    """What a payload says about its key: a digest of the feature values."""
    kinds = dict(features.dtypes)
    values = [F.round(F.col(c).try_cast("decimal(38,12)"), DIGEST_PLACES) if kinds[c] == "double" else F.col(c)
              for c in FEATURE_VALUE_COLUMNS]
    return F.sha2(F.to_json(F.struct(*[v.alias(c) for c, v in zip(FEATURE_VALUE_COLUMNS, values)]),
                            {"ignoreNullFields": "false"}), 256)


def _emitted_digests(spark: SparkSession, ledger: str, before: int) -> DataFrame:
    """Latest digest of every emitted key, by the ticks before ``before``."""
    known = spark.createDataFrame([], LEDGER_SCHEMA)
    if files.exists(spark, ledger):
        known = spark.read.schema(LEDGER_SCHEMA).parquet(ledger).filter(F.col("seq") < before)
    return known.groupBy(*FEATURE_KEYS, "dt").agg(F.max_by("digest", "seq").alias("known"))


def _ledger_ticks(spark: SparkSession, ledger: str) -> list[int]:
    return sorted(int(n[4:]) for n in files.names(spark, ledger) if n.startswith("seq="))


def compact_ledger(spark: SparkSession, ledger: str) -> None:
    """Merge all folders but the newest, which a repeated tick may still overwrite.

    The merged rows are added to the second newest, then older folders go. A run lost on
    the way leaves rows that say the same twice, which changes nothing.
    """
    ticks = _ledger_ticks(spark, ledger)
    if len(ticks) < 3:
        return
    merged = checkpoint_table(_emitted_digests(spark, ledger, ticks[-1]).withColumnRenamed("known", "digest"), "emit-ledger")
    merged.write.mode("append").partitionBy("dt").parquet(f"{ledger}/seq={ticks[-2]}")
    for old in ticks[:-2]:
        files.delete(spark, f"{ledger}/seq={old}")


def emit_changed(spark: SparkSession, features: DataFrame, ledger: str, sink_path: str, tick: int | None = None) -> int:
    """A5 without repeats: a payload for every row that is new or says something else than its last payload.

    ``features`` are rows to look at: a whole table, or those of new files, which after an
    upsert also hold every untouched row of the rewritten partitions. The ledger keeps one digest
    for each emitted key, in folders by tick and ``dt``; the join reads only the dates at hand.
    Payloads are written first, then the ledger, both under the tick's number, so a repeated tick
    (a retried micro-batch, a lost run) overwrites its own: every change is emitted at least once
    and, without a failure, exactly once. NULL keys equal each other here. One job at a time.
    """
    tick = (_ledger_ticks(spark, ledger) or [-1])[-1] + 1 if tick is None else tick
    rows = features.withColumn("dt", F.to_date("window_end")).withColumn("digest", row_digest(features))
    known = _emitted_digests(spark, ledger, tick).toDF(*[f"k_{c}" for c in (*FEATURE_KEYS, "dt")], "known")
    same = [F.col(c).eqNullSafe(F.col(f"k_{c}")) for c in (*FEATURE_KEYS, "dt")]
    changed = rows.join(known, same, "left").filter(F.col("known").isNull() | (F.col("known") != F.col("digest")))
    changed = checkpoint_table(changed.select(*features.columns, *([] if "dt" in features.columns else ["dt"]), "digest"),
                               "emit-changed")
    n = changed.count()
    if n:
        to_payload_json(payload_struct(changed)).select("value").write.mode("overwrite").text(f"{sink_path}/tick={tick}")
        (changed.select(*FEATURE_KEYS, "dt", "digest").write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy("dt").parquet(f"{ledger}/seq={tick}"))
        if len(_ledger_ticks(spark, ledger)) > LEDGER_FOLDERS:
            compact_ledger(spark, ledger)
    return n


#: rows that a task of a pass writes
PASS_TASK_ROWS = 250_000


def _emit_pass(spark: SparkSession, newer: DataFrame, cursor_path: str, sink_path: str, limit: int) -> int:
    """All due ticks side by side: payloads in a folder a tick, then the cursor of the last."""
    cuts, n = tick_cuts(newer, limit)
    if not cuts:
        return 0
    bounds, run = spark.sparkContext.broadcast(np.array(cuts, dtype="int64")), uuid.uuid4().hex[:12]

    def number(us: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds.value, us.to_numpy()))

    last = F.timestamp_micros(F.lit(cuts[-1]))
    upto = newer.filter(F.col("window_end") <= last)
    if "dt" in newer.columns:
        upto = upto.filter(F.col("dt") <= F.to_date(last))
    at = F.pandas_udf(number, "bigint")(F.unix_micros("window_end"))
    rows = upto.withColumn("tick", F.format_string(f"{run}-%08d", at))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n // PASS_TASK_ROWS)
    # a tick's rows lie together; one with very many ties is split
    rows = rows.repartitionByRange(min(tasks, max(1, n // limit)), "tick", "tenant_id", "session_id", "feature_window")
    payloads = to_payload_json(payload_struct(rows, keep=("tick",)), keep=("tick",))
    payloads.select("value", "tick").write.mode("append").partitionBy("tick").text(sink_path)
    save_cursor(spark, cursor_path, spark.range(1).select(last).first()[0])
    return n


def emit_since(spark: SparkSession, features: DataFrame, cursor_path: str, sink_path: str,
               limit: int = 1000, start=dt.datetime(1970, 1, 1), all_due: bool = False) -> int:
    """A5: one tick. Emit, then commit the cursor only if something was emitted.

    A failed tick leaves the cursor where it was, so rows are emitted at least
    once. A missing cursor starts from ``start`` (the beginning), not "now".
    With ``all_due`` the ticks that are due (up to ``ticks.PASS_TICKS``) are emitted in one pass, with the
    rows that each would have had alone, and the cursor is committed after the last.
    """
    since = load_cursor(spark, cursor_path, start)
    if all_due and limit is not None and limit > 0:
        return _emit_pass(spark, read_since(features, since), cursor_path, sink_path, limit)
    rows = read_since(features, since, limit).persist()
    try:
        n = rows.count()
        if n == 0:
            return 0
        tick = uuid.uuid4().hex[:12]
        to_payload_json(payload_struct(rows)).select("value").write.text(f"{sink_path}/tick={tick}")
        save_cursor(spark, cursor_path, next_cursor(rows, since).first()["cursor"])
        return n
    finally:
        rows.unpersist()


def read_exported(spark: SparkSession, root: str) -> DataFrame:
    """Exported feature rows (JSON lines, ``*.json`` / ``*.jsonl`` anywhere under
    ``root``); blank and unparsable lines are skipped."""
    return (spark.read.schema(EXPORTED_FEATURE_ROW)
            .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{json,jsonl}")
            .option("mode", "DROPMALFORMED").option("timestampFormat", PAYLOAD_TS_FORMAT)
            .json(root).filter(F.col("window_end").isNotNull()))


MAX_LINE_BYTES = 4 * 1024 * 1024
#: RFC 3339, as a decoder of times takes it
_TIME = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d([.]\d+)?(Z|[+-]\d\d:\d\d)$"


def read_exported_any(spark: SparkSession, root: str, max_line_bytes: int = MAX_LINE_BYTES) -> DataFrame:
    """S12 for features of any name and shape: ``features`` is a VARIANT that reaches the payload unchanged.

    Lines of ``*.json`` / ``*.jsonl`` files anywhere under ``root``. A line is skipped when it is blank, no JSON, no
    object, or has a key text that is no text, a time that is none or ``features`` that are no object (NULL and absent
    ones are allowed; a row without ``window_end`` is after no cursor and left out). A key that comes twice in an
    object makes the line unreadable. A line over ``max_line_bytes`` fails the read: passing over it
    would lose its row for good.
    """
    lines = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{json,jsonl}").text(root))
    too_long = F.raise_error(F.concat(F.lit("line of "), F.octet_length("value").cast("string"), F.lit(" bytes in exported rows")))
    lines = lines.filter(F.when(F.octet_length("value") > max_line_bytes, too_long.cast("boolean")).otherwise(F.lit(True)))
    names = ["tenant_id", "session_id", "window_end", "feature_window", "features"]
    parsed = lines.select(F.try_parse_json("value").alias("v")).filter(F.schema_of_variant("v").startswith("OBJECT"))
    parts = parsed.select(*[F.try_variant_get("v", f"$.{c}", "variant").alias(c) for c in names])
    kinds = {c: F.coalesce(F.schema_of_variant(c), F.lit("VOID")) for c in names}
    right = [kinds[c].isin("STRING", "VOID") for c in names[:4]]
    right.append((kinds["features"] == "VOID") | kinds["features"].startswith("OBJECT"))
    for ok in right:
        parts = parts.filter(ok)
    rows = parts.select(*[F.try_variant_get(c, "$", "string").alias(c) for c in names[:4]], "features")
    at = F.when(F.col("window_end").rlike(_TIME), F.col("window_end").try_cast("timestamp"))
    return rows.withColumn("window_end", at).filter("window_end IS NOT NULL")


def flatten_exported(exported: DataFrame) -> DataFrame:
    """Exported rows back to flat feature columns."""
    return exported.select("tenant_id", "session_id", "window_end", "feature_window", "features.*")
