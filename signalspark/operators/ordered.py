"""Skew-safe "previous row" within a large partition.

``lag().over(partitionBy(tenant).orderBy(t))`` sends every row of a tenant to one
task. With one tenant holding a third of all rows that task is the job. Here the
window runs per (partition key, time bucket); the first row of each bucket takes
its predecessor from the last row of the nearest earlier non-empty bucket, found
on a table with one row per (key, bucket). The result is exactly the plain
``lag`` over the whole partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalspark.session import checkpoint_table


def bucketed_lag(df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence[str],
                 value_cols: Sequence[str], bucket: Column, prefix: str = "prior_",
                 materialize: bool = False) -> DataFrame:
    """Add ``prefix + c`` = value of ``c`` on the previous row by ``order_cols``.

    ``bucket`` must be monotone in the first order column (e.g. ``date_trunc``
    of the time) so that bucket order agrees with row order. The input is read
    twice (window, per-bucket last row); ``materialize`` writes it once first
    when it is an expensive plan rather than a stored table.
    """
    pcols = list(partition_cols)
    order = [F.col(c) for c in order_cols]
    vals = F.struct(*[F.col(c) for c in value_cols])
    keyed = df.withColumn("_bkt", bucket).withColumn("_vals", vals)
    if materialize:
        keyed = checkpoint_table(keyed, "lag-input")

    w_in = Window.partitionBy(*pcols, "_bkt").orderBy(*order)
    inner = keyed.withColumn("_prev", F.lag("_vals").over(w_in)) \
                 .withColumn("_first", F.row_number().over(w_in) == 1)

    # one row per (key, bucket): its last row; then the previous bucket's last row
    last = keyed.groupBy(*pcols, "_bkt").agg(F.max_by("_vals", F.struct(*order)).alias("_last"))
    carry = last.select(*pcols, "_bkt", F.lag("_last").over(
        Window.partitionBy(*pcols).orderBy("_bkt")).alias("_carry"))

    # a NULL key is a partition of its own, as in a window
    renamed = carry.toDF(*[f"_c_{c}" for c in pcols], "_c_bkt", "_carry")
    same = [F.col(c).eqNullSafe(F.col(f"_c_{c}")) for c in pcols] + [F.col("_bkt") == F.col("_c_bkt")]
    joined = inner.join(renamed, same, "left").drop(*[f"_c_{c}" for c in pcols], "_c_bkt")
    prev = F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_prev"))
    out = joined.withColumn("_p", prev)
    for c in value_cols:
        out = out.withColumn(prefix + c, F.col("_p").getField(c))
    return out.drop("_bkt", "_vals", "_prev", "_first", "_carry", "_p")
