"""V20, continued: quantiles that merge over time, and alerts that hold for a while.

A quantile sketch is a table of counts: value ``v`` falls in bin ``ceil(log(v) / log(g))``
with ``g = (1 + e) / (1 - e)``, and bin ``i`` stands for ``2 g^i / (g + 1)``, which is within the
relative error ``e`` of every value in it. Bins of any two minutes, tenants or batches merge by
adding counts, so minutes are counted once (map-side) and roll up to any window; a tenant and
window has some hundreds of bins whatever its traffic.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalspark.functions.windows import interval_micros, window_end

ERROR = 0.01
#: bin of values of zero and less, below all others
LOWEST = -(1 << 31)


def growth(error: float = ERROR) -> float:
    return (1 + error) / (1 - error)


def minute_bins(df: DataFrame, value: str, time_col: str = "ts", by: tuple[str, ...] = ("tenant_id",),
                error: float = ERROR) -> DataFrame:
    """``by, minute, bin, n``: the sketch of every minute; null values are left out."""
    v = F.col(value).cast("double")
    at = F.when(v > 0, F.ceil(F.log(v) / F.lit(math.log(growth(error))))).otherwise(F.lit(LOWEST))
    return (df.filter(v.isNotNull() & ~F.isnan(v) & F.col(time_col).isNotNull())
            .groupBy(*by, F.date_trunc("minute", time_col).alias("minute"), at.cast("int").alias("bin"))
            .agg(F.count(F.lit(1)).alias("n")))


def window_quantile(bins: DataFrame, q: float, window: str = "5 minutes", by: tuple[str, ...] = ("tenant_id",),
                    error: float = ERROR, name: str = "p") -> DataFrame:
    """``by, window_end, n, name``: the ``q``-quantile (the value of rank ``ceil(q n)``) of each window, within ``error``."""
    keys = [*by, "window_end"]
    merged = (bins.groupBy(*by, window_end("minute", window).alias("window_end"), "bin").agg(F.sum("n").alias("n")))
    upto = Window.partitionBy(*keys).orderBy("bin")
    ranked = merged.select(*keys, "bin", F.sum("n").over(upto).alias("upto"),
                           F.sum("n").over(Window.partitionBy(*keys)).alias("n"))
    g = growth(error)
    found = ranked.filter(F.col("upto") >= F.ceil(F.lit(q) * F.col("n"))).groupBy(*keys).agg(
        F.min("bin").alias("bin"), F.max("n").alias("n"))
    value = F.when(F.col("bin") == LOWEST, F.lit(0.0)).otherwise(F.lit(2 / (g + 1)) * F.pow(F.lit(g), F.col("bin").cast("double")))
    return found.select(*keys, "n", value.alias(name))


def sustained(windows: DataFrame, over: F.Column, window: str, hold: str, by: tuple[str, ...] = ("tenant_id",),
              end_col: str = "window_end") -> DataFrame:
    """Stretches of adjoining windows that are all ``over`` a limit and last ``hold`` or longer.

    One row a stretch: ``by, alert_start, alert_end, windows``. A missing window ends a stretch,
    as does one within the limit. Rows are windows, one per key and end.
    """
    width = interval_micros(window)
    end = F.unix_micros(end_col)
    hot = windows.filter(over).select(*by, end.alias("end"))
    in_time = Window.partitionBy(*by).orderBy("end")
    # ends of a stretch grow in step with their number, so their difference names the stretch
    named = hot.withColumn("stretch", F.col("end") - F.lit(width).cast("long") * F.row_number().over(in_time))
    found = named.groupBy(*by, "stretch").agg(F.min("end").alias("low"), F.max("end").alias("high"),
                                              F.count(F.lit(1)).alias("windows"))
    return found.filter(F.col("windows") * F.lit(width).cast("long") >= F.lit(interval_micros(hold))).select(
        *by, F.timestamp_micros(F.col("low") - F.lit(width).cast("long")).alias("alert_start"),
        F.timestamp_micros("high").alias("alert_end"), "windows")
