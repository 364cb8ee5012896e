"""Two-component mixtures of many groups at once, and splits of the groups that look bimodal.

Expectation and maximisation over sufficient statistics: each round is one aggregate over all groups' values, combined before its
shuffle, and gives a row of sums for each group. Groups that have converged keep their numbers and leave the next plan. Values are first
counted, so a round reads distinct values and a group of any size is spread over all tasks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlasloom.model import as_list, require_columns
from atlasloom.sizing import broadcast_limit, settle

ROUNDS, TOLERANCE, LEAST_VARIANCE = 100, 1e-3, 1e-6
#: Rounds of one plan; after so many the group table is settled.
UNROLLED = 8
#: Bytes that a row of the group table takes at most, but for its keys.
_STATE_BYTES = 256
_KEY = "_group"


def _value(column: str) -> Column:
    x = F.col(column).cast("double")
    return F.when(~F.isnan(x), x)


def _key(by: Sequence[str]) -> Column:
    """The grouping columns as one struct: null equals null in joins on it."""
    return F.struct(*[F.col(b) for b in by]) if by else F.struct(F.lit(0).alias("all"))


def _log_densities(z: Column) -> tuple[Column, Column]:
    """Logarithm of the weighted density of the two components."""
    def one(k: int) -> Column:
        m, v, w = F.col(f"m{k}"), F.col(f"v{k}"), F.col(f"w{k}")
        return F.log(w) - 0.5 * F.log(2 * math.pi * v) - (z - m) * (z - m) / (2 * v)
    return one(0), one(1)


def _log_sum(a: Column, b: Column) -> Column:
    return F.greatest(a, b) + F.log1p(F.exp(-F.abs(a - b)))


def _sums(share: Column) -> list[Column]:
    """Number, sum and sum of squares of both components, ``share`` being that of the second."""
    out = []
    for k, r in enumerate((1 - share, share)):
        r = F.col("c") * r
        out += [F.sum(r).alias(f"n{k}"), F.sum(r * F.col("z")).alias(f"s{k}"), F.sum(r * F.col("z") * F.col("z")).alias(f"q{k}")]
    return out


def _maximised() -> dict[str, Column]:
    out, tiny = {}, 10 * 2.220446049250313e-16
    total = F.col("n0") + F.col("n1")
    for k in (0, 1):
        n = F.col(f"n{k}") + tiny
        m = F.col(f"s{k}") / n
        out |= {f"m{k}": m, f"v{k}": F.greatest(F.col(f"q{k}") / n - m * m, F.lit(0.0)) + LEAST_VARIANCE,
                f"w{k}": F.greatest(n / total, F.lit(1e-300))}
    return out


def fit_groups(cells: DataFrame, column: str, by: str | Sequence[str] | None = None, rounds: int = ROUNDS,
               tol: float = TOLERANCE) -> DataFrame:
    """One row per group with values: grouping columns, ``n``, the two components and whether two fit better than one.

    Components start from the values below and above the group's mean and are improved until the mean log likelihood grows
    by less than ``tol``. ``mean_low, var_low, share_low`` and the same of ``high`` describe them, ``bic_1`` and
    ``bic_2`` the fits with one and two components; ``bimodal`` is false for groups of one value.
    """
    by = as_list(by)
    require_columns(cells, [column, *by], "cells")
    counted = cells.select(*by, _value(column).alias("x")).filter("x IS NOT NULL").groupBy(*by, "x").agg(
        F.count(F.lit(1)).cast("double").alias("c")).select(_key(by).alias(_KEY), "x", "c")
    counted = settle(counted)
    groups = settle(counted.groupBy(_KEY).agg(
        F.sum("c").alias("n"), F.count(F.lit(1)).alias("values"), (F.sum(F.col("c") * F.col("x")) / F.sum("c")).alias("center")))
    small = groups.count() * _STATE_BYTES <= broadcast_limit(cells.sparkSession)

    def beside(table: DataFrame) -> DataFrame:
        # its rows are as many as the groups, whose number has just been counted; else Spark splits what is skewed
        return F.broadcast(table) if small else table

    points = settle(counted.join(beside(groups.select(_KEY, "center")), _KEY).select(_KEY, (F.col("x") - F.col("center")).alias("z"), "c"))
    state = points.groupBy(_KEY).agg(*_sums((F.col("z") > 0).cast("double")))
    state = state.select(_KEY, *[c.alias(k) for k, c in _maximised().items()], F.lit(float("-inf")).alias("ll"), F.lit(False).alias("done"))

    def improved(live: DataFrame) -> DataFrame:
        kept = [c for c in live.columns if c != _KEY]
        a, b = _log_densities(F.col("z"))
        sums = points.join(beside(live), _KEY).groupBy(_KEY).agg(
            *_sums(1 / (1 + F.exp(a - b))), (F.sum(F.col("c") * _log_sum(a, b)) / F.sum("c")).alias("new"), *[F.first(c).alias(f"old_{c}") for c in kept])
        new = {**_maximised(), "ll": F.col("new"), "done": F.abs(F.col("new") - F.col("old_ll")) < tol}
        # a group that converged within the plan stays as it is
        return sums.select(_KEY, *[F.when(F.col("old_done"), F.col(f"old_{c}")).otherwise(new[c]).alias(c) for c in kept])

    finished, live = [], settle(state)
    for at in range(0, rounds, UNROLLED):
        for _ in range(min(UNROLLED, rounds - at)):
            live = improved(live)
        live = settle(live)
        finished.append(live.filter("done"))
        live = live.filter("NOT done")
        if live.isEmpty():
            break
    state = live
    for more in finished:
        state = state.unionByName(more)
    state = settle(state)
    a, b = _log_densities(F.col("z"))
    one = F.greatest(F.sum(F.col("c") * F.col("z") * F.col("z")) / F.sum("c"), F.lit(0.0))
    fit = points.join(beside(state), _KEY).groupBy(_KEY).agg(F.sum(F.col("c") * _log_sum(a, b)).alias("ll_2"), one.alias("spread"))
    out = groups.join(beside(fit), _KEY).join(beside(state), _KEY)
    v = F.col("spread") + LEAST_VARIANCE
    ll_1 = -0.5 * F.col("n") * F.log(2 * math.pi * v) - 0.5 * F.col("n") * F.col("spread") / v
    low = F.col("m0") <= F.col("m1")

    def side(name: str, first: Column) -> list[Column]:
        return [(F.when(first, F.col(f"{p}0")).otherwise(F.col(f"{p}1")) + (F.col("center") if p == "m" else F.lit(0.0))).alias(f"{long}_{name}")
                for p, long in (("m", "mean"), ("v", "var"), ("w", "share"))]

    bic_1, bic_2 = 2 * F.log("n") - 2 * ll_1, 5 * F.log("n") - 2 * F.col("ll_2")
    return settle(out.select(
        *[F.col(f"{_KEY}.{b}").alias(b) for b in by], F.col("n").cast("long").alias("n"), *side("low", low), *side("high", ~low),
        bic_1.alias("bic_1"), bic_2.alias("bic_2"), ((F.col("values") > 1) & (bic_2 < bic_1)).alias("bimodal")))


def split_groups_if_bimodal(cells: DataFrame, column: str, by: str | Sequence[str] | None = None) -> DataFrame:
    """``<column>_label`` and ``bimodal_split``, decided for each group by itself.

    In a bimodal group a cell is ``low_<column>`` or ``high_<column>`` by the larger weighted density, and cells without a value are
    left out, as they belong to neither; other groups keep all cells, in the split ``all`` and without labels.
    """
    by = as_list(by)
    fitted = fit_groups(cells, column, by)
    parts = [f"{p}_{s}" for p in ("mean", "var", "share") for s in ("low", "high")]
    fitted = fitted.select(_key(by).alias(_KEY), "bimodal", *[F.col(p).alias(f"_{p}") for p in parts])
    if fitted.count() * _STATE_BYTES <= broadcast_limit(cells.sparkSession):
        fitted = F.broadcast(fitted)
    x = _value(column)

    def density(s: str) -> Column:
        v = F.col(f"_var_{s}")
        return F.log(F.col(f"_share_{s}")) - 0.5 * F.log(v) - (x - F.col(f"_mean_{s}")) * (x - F.col(f"_mean_{s}")) / (2 * v)

    two = F.coalesce(F.col("bimodal"), F.lit(False))
    label = F.when(two & x.isNotNull(), F.when(density("low") >= density("high"), f"low_{column}").otherwise(f"high_{column}"))
    out = cells.withColumn(_KEY, _key(by)).join(fitted, _KEY, "left").filter(~two | x.isNotNull())
    return out.withColumn(f"{column}_label", label).withColumn("bimodal_split", F.coalesce(f"{column}_label", F.lit("all"))).select(
        *cells.columns, *[c for c in (f"{column}_label", "bimodal_split") if c not in cells.columns])
