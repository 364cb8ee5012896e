"""Chunk numbers and split labels as columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlasloom.model import as_list, require_columns
from atlasloom.operators.ranking import hash_rank
from atlasloom.sizing import broadcast_if_small


def pack_batches(cells: DataFrame, chunk_size: int, batch: str = "batch", order: str = "ord") -> DataFrame:
    """Batch table ``batch, first, n, chunk_id``: batches in order of appearance, packed greedily.

    The cells are aggregated first; the fold itself runs over one row per batch,
    streamed in order with two numbers of state.
    """
    if chunk_size < 1:
        raise ValueError("chunk_size must be positive")
    require_columns(cells, [batch, order], "cells")
    batches = cells.groupBy(batch).agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))

    def fold(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chunk, held, started = 0, 0, False
        for part in parts:
            ids = []
            for n in part["n"]:
                if started and held + n > chunk_size:
                    chunk, held = chunk + 1, 0
                ids.append(chunk)
                held, started = held + n, True
            part["chunk_id"] = ids
            yield part

    schema = batches.withColumn("chunk_id", F.lit(0).cast("int")).schema
    return batches.repartition(1).sortWithinPartitions("first").mapInPandas(fold, schema)


def chunk_by_batch(cells: DataFrame, chunk_size: int, batch: str = "batch", order: str = "ord") -> DataFrame:
    """``chunk_id`` per cell; a batch is never cut."""
    packed = broadcast_if_small(pack_batches(cells, chunk_size, batch, order).select(F.col(batch).alias("_b"), "chunk_id"))
    return cells.join(packed, cells[batch].eqNullSafe(packed["_b"]), "left").drop("_b")


def chunk_at_random(cells: DataFrame, chunk_size: int, seed: int = 0, key: str = "cell_id") -> DataFrame:
    """``chunk_id`` per cell after a seeded shuffle, all chunks full but the last."""
    if chunk_size < 1:
        raise ValueError("chunk_size must be positive")
    ranked = hash_rank(cells, key, seed, "_rank")
    return ranked.withColumn("chunk_id", F.floor((F.col("_rank") - 1) / chunk_size).cast("int")).drop("_rank")


def assign_chunks(
    cells: DataFrame, chunk_size: int, batch: str | None = None, random: bool = False, seed: int = 0, order: str = "ord"
) -> DataFrame:
    """Batch-preserving when a batch column is named, random without one or when asked for."""
    if random or batch is None:
        return chunk_at_random(cells, chunk_size, seed)
    return chunk_by_batch(cells, chunk_size, batch, order)


def first_chunks(df: DataFrame, n_chunks: int | None) -> DataFrame:
    return df if n_chunks is None else df.filter(F.col("chunk_id") < n_chunks)


SplitFunction = Callable[[DataFrame], DataFrame]


def split_at_random(
    cells: DataFrame, train_frac: float = 0.9, seed: int = 42, by: str | Sequence[str] | None = "chunk_id",
    key: str = "cell_id",
) -> DataFrame:
    """``split`` = train for the first ``int(frac * n)`` cells of each chunk in seeded order, val for the rest."""
    if not 0 < train_frac < 1:
        raise ValueError("train_frac must lie between 0 and 1")
    by = as_list(by)
    ranked = hash_rank(cells, key, seed, "_rank", by)
    if by:
        sizes = broadcast_if_small(cells.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")))
        s = sizes.select(*[F.col(b).alias(f"_k_{b}") for b in by], "_n")
        cond = F.lit(True)
        for b in by:
            cond = cond & ranked[b].eqNullSafe(s[f"_k_{b}"])
        ranked = ranked.join(s, cond).drop(*[f"_k_{b}" for b in by])
    else:
        ranked = ranked.withColumn("_n", cells.agg(F.count(F.lit(1))).scalar())
    return ranked.withColumn(
        "split", F.when(F.col("_rank") <= F.floor(F.lit(train_frac) * F.col("_n")), "train").otherwise("val")
    ).drop("_rank", "_n")


def apply_split(cells: DataFrame, rule: Column | SplitFunction | None = None, **kw) -> DataFrame:
    """Any column expression, or any ``DataFrame -> DataFrame`` adding ``split``; random by default."""
    if rule is None:
        return split_at_random(cells, **kw)
    out = rule(cells) if callable(rule) and not isinstance(rule, Column) else cells.withColumn("split", rule)
    require_columns(out, ["split"], "split rule result")
    return out
