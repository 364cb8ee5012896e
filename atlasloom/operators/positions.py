"""Gapless row numbers for tables of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atlasloom.sizing import settle

_PART_SHIFT = 33  # monotonically_increasing_id keeps the partition above bit 33, the row within it below


def number_rows(df: DataFrame, order: list[Column], name: str = "position") -> tuple[DataFrame, int]:
    """``df`` with its global position (from 0) in ``order``, and the number of rows.

    Rows are dealt by range bounds, so partitions hold equally many; rows equal in ``order`` are told apart by where
    they were read, so that no repeated value fills a partition. The only window runs over one row per partition.
    The numbered rows are settled before they are counted: positions stay as they are when an executor is lost.
    """
    keys = [*order, F.monotonically_increasing_id()]
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    tag = f"__{name}_tag"
    placed = settle(ranged.withColumn(tag, F.monotonically_increasing_id()))
    part = F.shiftright(F.col(tag), _PART_SHIFT)
    sizes = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    rows = int(sizes.agg(F.coalesce(F.sum("__rows"), F.lit(0))).first()[0])
    # one row per partition of the exchange: far below any broadcast limit
    joined = placed.withColumn("__part", part).join(F.broadcast(starts), "__part")
    within = F.col(tag).bitwiseAND(F.lit((1 << _PART_SHIFT) - 1))
    return joined.withColumn(name, F.col("__start") + within).drop("__part", "__start", tag), rows
