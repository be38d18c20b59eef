"""Feature table (S8-S11): create, append, and upsert on the four key columns.

The table is Parquet partitioned by ``tenant_id, dt`` with ``dt =
to_date(window_end)``. The key holds ``window_end``, so a key never moves
between partitions and the upsert is partition-local:

1. read only the partitions the incoming rows touch (partition pruning via a
   semi join on ``(tenant_id, dt)``),
2. write the incoming rows to a staging folder next to the table, then append
   the existing rows whose key is not incoming (``left_anti``); the staging
   copy cuts the lineage to the files about to be replaced,
4. overwrite just those partitions from the staging copy (dynamic overwrite).

Other partitions are never touched; running the same upsert twice gives the
same table. Before step 4 the staging folder is recorded in a marker inside the
table; a run lost during the overwrite is completed by the next upsert (or
``recover_upsert``) from that complete staging copy. NULL keys never match, as with SQL ``=``; strict landing keeps
them out. Delta or Iceberg ``MERGE`` is used when requested and available.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from signalspark.schema import FEATURE_KEYS, FEATURES

PARTITIONS = ["tenant_id", "dt"]
FORMATS = ("parquet", "delta", "iceberg")


def _conform(features: DataFrame) -> DataFrame:
    """Add ``dt`` and project to the FEATURES column order and types."""
    f = features.withColumn("dt", F.to_date("window_end"))
    return f.select(*[F.col(x.name).cast(x.dataType).alias(x.name) for x in FEATURES.fields])


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema(FEATURES).parquet(path)
        return True
    except AnalysisException:
        return False


def create_table(spark: SparkSession, path: str) -> None:
    """An empty partitioned table with the FEATURES schema, if missing."""
    if not _exists(spark, path):
        spark.createDataFrame([], FEATURES).write.partitionBy(*PARTITIONS).parquet(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FEATURES).parquet(path)


def append_features(features: DataFrame, path: str) -> None:
    """Plain append (not idempotent)."""
    _conform(features).hint("rebalance", *PARTITIONS).write.mode("append").partitionBy(*PARTITIONS).parquet(path)


MARKER = "_pending_upsert"  # leading underscore: ignored by Parquet readers


def _pending(spark: SparkSession, path: str) -> str | None:
    try:
        rows = spark.read.text(f"{path}/{MARKER}").collect()
    except AnalysisException:
        return None
    return rows[0][0] if rows else None


def _set_pending(spark: SparkSession, path: str, stage: str | None) -> None:
    rows = [(stage,)] if stage else []
    spark.createDataFrame(rows, "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{MARKER}")


def _overwrite_from(spark: SparkSession, stage: str, path: str) -> None:
    (read_features(spark, stage).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS).parquet(path))


def recover_upsert(spark: SparkSession, path: str) -> bool:
    """Finish an upsert whose final overwrite did not complete (driver lost mid-commit).

    The staging copy holds the complete merged partitions, so replaying the
    overwrite from it is idempotent. Returns True if something was replayed.
    """
    stage = _pending(spark, path)
    if not stage:
        return False
    _overwrite_from(spark, stage, path)
    _drop_emptied(spark, stage)
    _set_pending(spark, path, None)
    _delete(spark, stage)
    return True


def _delete(spark: SparkSession, path: str) -> None:
    """Remove a folder through the table's own file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


EMPTIED = "_emptied"  # inside the staging folder: partition folders that lose all their rows


def _drop_emptied(spark: SparkSession, stage: str) -> None:
    """Remove the partitions recorded with the staging copy; a dynamic overwrite leaves them alone."""
    try:
        rows = spark.read.text(f"{stage}/{EMPTIED}").collect()
    except AnalysisException:  # nothing recorded
        return
    for r in rows:
        where = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(r[0]))
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _stale(rows: DataFrame, replace: tuple | None) -> DataFrame:
    """Rows of the replaced sessions within the replaced dates; ``replace`` is (sessions _t/_s, start, end)."""
    if replace is None:
        return rows.filter(F.lit(False))
    sessions, start, end = replace
    if start is not None:
        rows = rows.filter(F.col("dt") >= F.lit(start))
    if end is not None:
        rows = rows.filter(F.col("dt") <= F.lit(end))
    return rows.join(sessions, F.col("tenant_id").eqNullSafe(F.col("_t")) & F.col("session_id").eqNullSafe(F.col("_s")),
                     "left_semi")


def upsert_features(features: DataFrame, path: str, staging_root: str | None = None,
                    replace: tuple | None = None) -> None:
    """MERGE on (tenant_id, session_id, window_end, feature_window) into Parquet.

    With ``replace`` the rows of those sessions and dates that are not incoming go, and a
    partition that holds nothing else with them. The incoming rows are computed once, written straight into the staging
    folder; touched partitions and the keys to replace are read back from it.
    """
    spark = features.sparkSession
    create_table(spark, path)
    recover_upsert(spark, path)
    stage = f"{(staging_root or os.path.dirname(path.rstrip('/')))}/_staging-{uuid.uuid4().hex[:12]}"
    _conform(features).hint("rebalance", *PARTITIONS).write.partitionBy(*PARTITIONS).parquet(stage)
    incoming = read_features(spark, stage)  # file listing taken now, before the append below
    table = read_features(spark, path)
    gone = _stale(table, replace).select(*FEATURE_KEYS)
    touched = incoming.select(*PARTITIONS).union(_stale(table, replace).select(*PARTITIONS)).distinct()
    current = table.join(touched, PARTITIONS, "left_semi")
    kept = current.join(incoming.select(*FEATURE_KEYS).union(gone), FEATURE_KEYS, "left_anti")
    kept.hint("rebalance", *PARTITIONS).write.mode("append").partitionBy(*PARTITIONS).parquet(stage)
    if replace is not None:
        folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "")
        emptied = (_stale(table.withColumn("_folder", folder), replace)
                   .join(read_features(spark, stage).select(*PARTITIONS).distinct(), PARTITIONS, "left_anti")
                   .filter("tenant_id IS NOT NULL AND dt IS NOT NULL"))  # NULL keys never match: their rows stay
        emptied.select("_folder").distinct().coalesce(1).write.text(f"{stage}/{EMPTIED}")
    _set_pending(spark, path, stage)  # from here on a lost run is finished by recover_upsert
    _overwrite_from(spark, stage, path)
    if replace is not None:
        _drop_emptied(spark, stage)
    _set_pending(spark, path, None)
    _delete(spark, stage)


def _merge_sql(spark: SparkSession, features: DataFrame, table: str, fmt: str) -> None:
    cols = ", ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in FEATURES.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING {fmt.upper()} "
              f"PARTITIONED BY ({', '.join(PARTITIONS)})")
    view = f"_incoming_features_{uuid.uuid4().hex[:8]}"
    _conform(features).createOrReplaceTempView(view)
    on = " AND ".join(f"t.{k} = s.{k}" for k in FEATURE_KEYS)
    spark.sql(f"MERGE INTO {table} t USING {view} s ON {on} "
              "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *")


def write_features(features: DataFrame, table: str, fmt: str | None = None, mode: str = "upsert",
                   replace: tuple | None = None) -> None:
    """Dispatch on format. ``parquet`` supports ``upsert`` (with ``replace``) and ``append``; the others
    only a plain upsert, and refuse anything else instead of leaving wrong rows."""
    fmt = fmt or os.environ.get("FEATURE_STORE_FORMAT", "parquet")
    if fmt not in FORMATS:
        raise ValueError(f"unknown FEATURE_STORE_FORMAT: {fmt}")
    if fmt != "parquet" and (mode != "upsert" or replace is not None):
        raise ValueError(f"{fmt} tables support a plain upsert only")
    if fmt == "parquet":
        if mode == "upsert":
            upsert_features(features, table, replace=replace)
        else:
            append_features(features, table)
    else:
        _merge_sql(features.sparkSession, features, table, fmt)
