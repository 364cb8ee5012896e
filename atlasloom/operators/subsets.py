"""Subsets of a wanted size, and first rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlasloom.operators.ranking import hash_rank
from atlasloom.sizing import broadcast_if_small, settle


def random_subset(cells: DataFrame, size: int, seed: int = 42, key: str = "cell_id") -> DataFrame:
    """``size`` rows (all, if there are fewer) first in seeded order; no row passes through one task."""
    if size < 1:
        raise ValueError("subset size must be positive")
    return hash_rank(cells, key, seed, "_rank", first=size).drop("_rank")


def stratified_subset(
    cells: DataFrame, size: int, strata: Sequence[str], seed: int = 42, key: str = "cell_id"
) -> DataFrame:
    """Rows in proportion to the joint distribution of ``strata``.

    Each stratum gives ``max(1, round(share * size))`` rows, halves to even; an
    overshoot is trimmed at random. Without one of the columns: a random subset.
    """
    if size < 1:
        raise ValueError("subset size must be positive")
    if any(s not in cells.columns for s in strata):
        return random_subset(cells, size, seed, key)
    strata = list(strata)
    total = cells.agg(F.count(F.lit(1))).scalar()
    quota = cells.groupBy(*strata).agg(F.count(F.lit(1)).alias("_n")).withColumn("_t", total)
    share = F.bround(F.col("_n") / F.col("_t") * F.least(F.col("_t"), F.lit(size))).cast("bigint")
    quota = quota.select(
        *[F.col(s).alias(f"_s_{s}") for s in strata], F.least(F.col("_n"), F.greatest(F.lit(1), share)).alias("_quota"))
    quota = broadcast_if_small(quota)
    cond = F.lit(True)
    for s in strata:
        cond = cond & cells[s].eqNullSafe(quota[f"_s_{s}"])
    wanted = cells.join(quota, cond).drop(*[f"_s_{s}" for s in strata])
    chosen = hash_rank(wanted, key, seed, "_rank", by=strata, first="_quota").drop("_rank", "_quota")
    if quota.agg(F.sum("_quota")).first()[0] <= size:
        return chosen
    return hash_rank(settle(chosen), key, f"{seed}:trim", "_rank", first=size).drop("_rank")


def first_rows(df: DataFrame, n: int, order: str = "ord") -> DataFrame:
    return df.orderBy(order).limit(n)


def example_rows(df: DataFrame, n: int, order: str, text: Sequence[str], width: int = 150) -> DataFrame:
    """First ``n`` rows with long texts cut and marked."""
    cut = {c: F.when(F.length(c) > width, F.concat(F.substring(c, 1, width), F.lit("..."))).otherwise(F.col(c)) for c in text}
    return first_rows(df, n, order).withColumns(cut)


def category_shares(original: DataFrame, subset: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Share of each category before and after, one row per (key, category)."""

    def shares(df: DataFrame, name: str) -> DataFrame:
        long = df.select(F.explode(F.array(*[
            F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("category")) for k in keys])).alias("e")).select("e.*")
        n = df.agg(F.count(F.lit(1)).cast("double")).scalar()
        return long.filter(F.col("category").isNotNull()).groupBy("key", "category").agg(
            F.count(F.lit(1)).alias("_c")).select("key", "category", (F.col("_c") / n).alias(name))

    both = shares(original, "original_share").join(shares(subset, "subset_share"), ["key", "category"], "left")
    return both.na.fill(0.0, ["subset_share"])
