"""Tables behind quality plots."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlasloom.operators.quality import quantiles


def histogram(df: DataFrame, metric: str, auto_bins: int | None = None) -> DataFrame:
    """``bin, lower, upper, n`` of the finite values; no rows for a constant metric.

    Bins: one per distinct value up to ten; at most ten for a range under one;
    otherwise ``auto_bins``, or the larger of Sturges' and Freedman-Diaconis' number.
    """
    v = F.col(metric).cast("double")
    data = df.select(v.alias("v")).filter(v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    s = data.agg(
        F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    schema = "bin int, lower double, upper double, n bigint"
    if s["n"] == 0 or s["lo"] == s["hi"]:
        return df.sparkSession.createDataFrame([], schema)
    n_unique = data.distinct().limit(11).count()  # more than ten is all that matters
    lo, span = s["lo"], s["hi"] - s["lo"]
    if n_unique <= 10:
        bins = n_unique
    elif span < 1:
        bins = 10
    else:
        bins = auto_bins or _auto_bins(data, s["n"], span)
    width = span / bins
    slot = F.least(F.floor((F.col("v") - lo) / width), F.lit(bins - 1)).cast("int")
    return data.groupBy(slot.alias("bin")).agg(F.count(F.lit(1)).alias("n")).select(
        "bin", (F.lit(lo) + F.col("bin") * width).alias("lower"), (F.lit(lo) + (F.col("bin") + 1) * width).alias("upper"), "n")


def _auto_bins(data: DataFrame, n: int, span: float) -> int:
    q1, q3 = quantiles(data, {"q1": ("v", 0.25), "q3": ("v", 0.75)}).first()
    sturges = span / (math.log2(n) + 1)
    fd = 2.0 * (q3 - q1) / n ** (1 / 3)
    width = min(sturges, fd) if fd > 0 else sturges
    return max(1, math.ceil(span / width))


def distribution_by_category(df: DataFrame, metric: str, category: str, method: str = "auto") -> DataFrame:
    """Exact quartiles and size of a metric per category."""
    v = F.col(metric).cast("double")
    data = df.select(category, v.alias("v"))
    size = data.groupBy(category).agg(F.count("v").alias("n"), F.min("v").alias("minimum"), F.max("v").alias("maximum"))
    parts = quantiles(data, {"q1": ("v", 0.25), "median": ("v", 0.5), "q3": ("v", 0.75)}, category, method)
    return size.join(parts, size[category].eqNullSafe(parts[category])).select(
        size[category], "n", "minimum", "q1", "median", "q3", "maximum")


def contingency(df: DataFrame, rows: str, columns: str, values: Sequence[str] | None = None) -> DataFrame:
    return df.groupBy(rows).pivot(columns, list(values) if values else None).agg(F.count(F.lit(1))).na.fill(0)
