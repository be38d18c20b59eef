"""Cuts of many emit ticks found at once.

A tick takes the first ``limit`` rows by ``window_end`` and those tied with the last one; the next tick goes
on after them. Where a tick ends thus depends on where the one before ended. The rows are counted by
``window_end`` and the counts cut into ranges of time. Each range is folded, beside the others, for all
``limit`` numbers of rows that the open tick may hold when the range begins; the driver then follows the
one that holds from range to range.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalspark.session import checkpoint_table

#: ticks of one pass; their cuts are kept by the driver and sent to the tasks
PASS_TICKS = 100_000
#: ranges, if each of them then holds the rows of so many ticks
RANGES, RANGE_TICKS = 200, 64


def _states(limit: int):
    """For each number of rows in the open tick (0 to ``limit - 1``): ticks that the range closes, rows open at its end."""
    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("us")
        ends = pdf["n"].cumsum().to_numpy()
        start, closed = -np.arange(limit, dtype="int64"), np.zeros(limit, dtype="int64")
        going = np.arange(limit)
        while len(going):
            at = np.searchsorted(ends, start[going] + limit)  # the time that fills the tick
            going, at = going[at < len(ends)], at[at < len(ends)]
            start[going] = ends[at]
            closed[going] += 1
        return pd.DataFrame({"lo": pdf["us"].iloc[:1].to_numpy(), "range": pdf["range"].iloc[:1].to_numpy(),
                             "closed": [closed.tolist()], "held": [(ends[-1] - start).tolist()]})
    return fold


def _cuts(limit: int):
    """The cuts within a range, given the rows ``held`` by the open tick when it begins."""
    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("us")
        us, ends = pdf["us"].to_numpy(), pdf["n"].cumsum().to_numpy()
        start, found = -int(pdf["held"].iloc[0]), []
        while (at := int(np.searchsorted(ends, start + limit))) < len(ends):
            found.append(us[at])
            start = ends[at]
        return pd.DataFrame({"us": np.array(found, dtype="int64")})
    return fold


def tick_cuts(rows: DataFrame, limit: int, most: int = PASS_TICKS) -> tuple[list[int], int]:
    """The last ``window_end`` (microseconds) of each of the first ``most`` ticks, and the rows in these ticks."""
    spark = rows.sparkSession
    counts = checkpoint_table(rows.groupBy(F.unix_micros("window_end").alias("us")).agg(F.count(F.lit(1)).alias("n")), "emit-counts")
    total, last = counts.agg(F.sum("n"), F.max("us")).first()
    if not total:
        return [], 0
    ranges = max(1, min(total // (RANGE_TICKS * limit), RANGES))
    counts = checkpoint_table(counts.repartitionByRange(ranges, "us").withColumn("range", F.spark_partition_id()), "emit-ranges")
    states = counts.groupBy("range").applyInPandas(_states(limit), "lo bigint, range int, closed array<int>, held array<int>")
    held, ticks, begun = 0, 0, []
    for r in sorted(states.collect(), key=lambda r: r["lo"]):  # ``limit`` states of at most RANGES ranges
        if ticks < most:
            begun.append((r["range"], held))
        ticks, held = ticks + r["closed"][held], r["held"][held]
    known = F.broadcast(spark.createDataFrame(begun, "range int, held bigint"))
    found = counts.join(known, "range").groupBy("range").applyInPandas(_cuts(limit), "us bigint")
    cuts = sorted(r["us"] for r in found.collect())  # fewer than ``most`` and those of one range
    if held and ticks < most:
        cuts.append(last)  # what is left is a tick of fewer rows
    cuts = cuts[:most]
    return cuts, counts.filter(F.col("us") <= cuts[-1]).agg(F.sum("n")).first()[0]
