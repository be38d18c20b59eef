"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

UTC_CONF = {"spark.sql.session.timeZone": "UTC"}

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # partition values such as tenant_id=007 must stay strings
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # checkpoints cut lineage of shared sub-plans; drop them once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "signalspark",
                  shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Session with the settings every job relies on (UTC, AQE, string partitions)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """All event times are UTC instants; the session zone must agree."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    if spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled", None) != "false":
        spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (shared storage). Only a local-mode session
    without it (tests) gets a private folder, which is then registered as the
    checkpoint dir so later calls agree.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        cur = sc.getCheckpointDir()
        if cur:
            d = os.path.dirname(cur.rstrip("/"))
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="signalspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
        sc.setCheckpointDir(d)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for one job's tables."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/signalspark/{name}-{uuid.uuid4().hex[:12]}"


def checkpoint_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    Used where one sub-plan feeds several consumers (which Spark would
    otherwise recompute) and to cut lineage between rounds. Unlike an RDD
    checkpoint the copy is columnar and carries file statistics, so later
    plans prune columns and AQE sizes joins from real numbers.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, *work: Callable[[], DataFrame]) -> list[DataFrame]:
    """Results of independent pieces of work whose Spark jobs run at the same time.

    The tail of one job leaves executors idle that another one can use. The first call of
    ``checkpoint_root`` happens before the threads start.
    """
    checkpoint_root(spark)
    with ThreadPoolExecutor(len(work)) as pool:
        return [r.result() for r in [pool.submit(inheritable_thread_target(spark)(w)) for w in work]]
