"""Two schema versions of the same events during a dual-write window.

``reconcile`` puts the two versions of each event side by side without a join: both sides
are tagged rows of one union, and one aggregate per key keeps each side's values. Repeats of
a key within a side count once (the largest row), so a hot key is combined map-side.
``daily_agreement`` tells how far the new version has got and whether the old one may go.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalspark.schema import VERSION_CUT_OVER


def reconcile(old: DataFrame, new: DataFrame, keys: Sequence[str], fields: Sequence[str], time_col: str = "ts") -> DataFrame:
    """``keys, ts, status, differing`` of every event of either version.

    ``status`` is ``only_old``, ``only_new``, ``equal`` or ``differing``; ``differing`` names the fields
    that are not the same (null equals null). Rows whose keys are null are events of their null key.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        row = F.struct(F.col(time_col).alias("ts"), *[F.col(f).alias(f"f{i}") for i, f in enumerate(fields)])
        other = "new" if name == "old" else "old"
        typed = df.select(*keys, row.alias(name))
        return typed.withColumn(other, F.lit(None).cast(typed.schema[name].dataType)).select(*keys, "old", "new")

    both = side(old, "old").unionByName(side(new, "new")).groupBy(*keys).agg(F.max("old").alias("old"), F.max("new").alias("new"))
    names = [F.when(~F.col(f"old.f{i}").eqNullSafe(F.col(f"new.f{i}")), F.lit(f)) for i, f in enumerate(fields)]
    differing = F.array_compact(F.array(*names))
    status = (F.when(F.col("new").isNull(), "only_old").when(F.col("old").isNull(), "only_new")
              .when(F.size("differing") > 0, "differing").otherwise("equal"))
    return (both.select(*keys, F.coalesce("old.ts", "new.ts").alias("ts"), "old", "new", differing.alias("differing"))
            .withColumn("status", status)
            .select(*keys, "ts", "status", F.when(F.col("status") == "differing", F.col("differing"))
                    .otherwise(F.array().cast("array<string>")).alias("differing")))


def daily_agreement(events: DataFrame, fields: Sequence[str], by: Sequence[str] = ("tenant_id",)) -> DataFrame:
    """Per ``by`` and day: events by status, those that differ in each field, the share that only the
    old version has, and ``cut_over``: that share is below 1 %."""
    n = F.count(F.lit(1))
    counts = [F.count_if(F.col("status") == s).alias(s) for s in ("only_old", "only_new", "equal", "differing")]
    per_field = [F.count_if(F.array_contains("differing", f)).alias(f"differing_{f}") for f in fields]
    days = events.groupBy(*by, F.to_date("ts").alias("dt")).agg(n.alias("events"), *counts, *per_field)
    share = F.col("only_old") / F.col("events")
    return days.withColumn("old_share", share).withColumn("cut_over", share < F.lit(VERSION_CUT_OVER))
