"""The corpus pipeline: documents to packed sequences in five stages.

Each stage works on all rows that its predecessor kept, is written as Parquet under the
shared checkpoint folder and read again by the next. All but the last return the columns
of ``documents``. Edge cases are those of the operators; without any trusted positive
there is no quality model and the first stage keeps every document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalspark.llm import decontaminate, lines, near, packing, quality
from signalspark.llm.common import free_name, ship, table
from signalspark.llm.queries import vocabulary
from signalspark.session import checkpoint_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; a null text is scored as an empty one."""
    ship(spark)
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    if model is None:
        return docs
    column = free_name(docs, "quality")
    scored = quality.score(docs, model, column=column)
    return scored.filter(F.col(column) >= quality.THRESHOLD).select(docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that equal or resemble an earlier one; ``n_chars`` follows the text."""
    kept = lines.deduplicate_lines(docs)
    if "n_chars" not in docs.columns:
        return kept
    return kept.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), F.col("n_chars")))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates; documents without words are one class."""
    ship(spark)
    return near.deduplicate(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage, judged row by row; a null text holds none."""
    ship(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences, with their token ids; a null text is the end id alone."""
    ship(spark)
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"), end_id=1)


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_stage),
    ("decontamination", benchmark_stage),
    ("packing", packing_stage),
]

#: SQL cannot express the learned classifier, the sketches or the tokenizer
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: the packed pieces."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = checkpoint_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
