"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ship(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers, once per context.

    Spark's own file distribution carries a zip of the sources; a job submitted with
    ``--py-files`` does not need it.
    """
    sc = spark.sparkContext
    if getattr(sc, "_signalspark_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="signalspark-src-")) / "signalspark-src.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    sc.addPyFile(str(path))
    sc._signalspark_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str | Column) -> Column:
    """The text, with null as the empty string."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def record(df: DataFrame, name: str = "_rec") -> Column:
    """All columns of ``df`` as one struct, so working columns cannot clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)


def unpacked(df: DataFrame, schema: T.StructType, added: list[str], name: str = "_rec") -> DataFrame:
    """The record's columns back, then ``added``; an input column of an added name gives way."""
    keep = [F.col(f"{name}.`{f.name}`").alias(f.name) for f in schema.fields if f.name not in added]
    return df.select(*keep, *added)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until it is no column of ``df``."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def utf8(col: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return [b"" if x is None else x for x in col.cast(pa.binary()).to_pylist()]


def hashed_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """``n`` rows of smallest hashed key (column ``_h``), all of them if fewer; ``df`` has one row per key.

    A threshold from the row count leaves about ``4 * n`` rows to sort, however many tasks there are.
    """
    cells = 1 << 40
    rows = df.count()
    cut = cells if rows <= 4 * n else cells * 4 * n // rows
    h = F.xxhash64(F.lit(seed), F.col(key))
    return df.withColumn("_h", h).filter(F.pmod(h, F.lit(cells)) < cut).orderBy(F.pmod("_h", F.lit(cells)), "_h").limit(n)
