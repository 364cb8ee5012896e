"""Positions, ranks and neighbours without a single-task window.

A row number over a whole table (or over a group that may hold a third of it)
would sort everything in one task. Here rows are dealt by range bounds of
(group, order), which Spark takes from a sample so that partitions hold equally
many rows however values and groups are spread, and get their position in the
whole table (``positions.number_rows``). A rank in a group is the position less
that of the group's first row; only groups of several rows are looked up. When
only the first ranks are wanted, a histogram of the order's leading digits
tells per group what to leave out before rows are dealt.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from atlasloom.functions.ids import seeded_md5
from atlasloom.model import as_list
from atlasloom.operators.positions import number_rows
from atlasloom.sizing import broadcast_if_small

LEADS = 4096
ROWS_PER_BLOCK = 50_000


def _looked_up(df: DataFrame, table: DataFrame, by: list[str], how: str) -> DataFrame:
    """``df`` with the columns of ``table``, a row per group, nulls being a group too."""
    names = {b: f"__k_{i}" for i, b in enumerate(by)}
    small = broadcast_if_small(table.select(*[F.col(f"`{b}`").alias(n) for b, n in names.items()], *[c for c in table.columns if c not in names]))
    if not by:
        return df.join(small, how=how)
    cond = F.lit(True)
    for b, n in names.items():
        cond = cond & df[f"`{b}`"].eqNullSafe(small[n])
    return df.join(small, cond, how).drop(*names.values())


def _placed(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """``df`` with ``__pos``, its position from 0 in the order of (group, order)."""
    numbered, _ = number_rows(df, [F.col(f"`{c}`").asc_nulls_first() for c in [*by, *order]], "__pos")
    return numbered


def _numbered(df: DataFrame, by: list[str], order: list[str], out: str) -> DataFrame:
    """Positions from 0 within ``by``."""
    placed = _placed(df, by, order)
    if not by:
        return placed.withColumn(out, F.col("__pos")).drop("__pos")
    starts = placed.groupBy(*by).agg(F.min("__pos").alias("__start"), F.count(F.lit(1)).alias("__n"))
    found = _looked_up(placed, starts.filter("__n > 1").drop("__n"), by, "left")
    return found.withColumn(out, F.col("__pos") - F.coalesce("__start", "__pos")).drop("__pos", "__start")


def row_index(df: DataFrame, order: str, out: str = "sample_index", by: str | Sequence[str] | None = None) -> DataFrame:
    """``0..n-1`` in the order of a unique column, per group."""
    return _numbered(df, as_list(by), [order], out)


def _first_leads(df: DataFrame, by: list[str], first: int | str) -> DataFrame:
    """Rows up to the lead (of ``LEADS`` equally likely ones) in which a group's number of wanted rows is reached."""
    limit = F.lit(first) if isinstance(first, int) else F.max(first)
    sizes = df.groupBy(*by, "__lead").agg(F.count(F.lit(1)).alias("__n"), limit.cast("bigint").alias("__first"))
    # one row per (group, lead): at most LEADS rows per group, whatever the table's size
    before = W.partitionBy(*by).orderBy("__lead").rowsBetween(W.unboundedPreceding, -1)
    ahead = sizes.withColumn("__ahead", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    last = ahead.filter("__ahead < __first").groupBy(*by).agg(F.max("__lead").alias("__last"))
    return _looked_up(df, last, by, "inner").filter("__lead <= __last").drop("__last")


def hash_rank(
    df: DataFrame, key: str, seed: int | str, out: str = "rank", by: str | Sequence[str] | None = None, first: int | str | None = None,
) -> DataFrame:
    """Rank from 1 in the seeded random order of ``key``, per group; ``first`` keeps only ranks up to it (or up to that column)."""
    by = as_list(by)
    work = df.withColumn("__hash", seeded_md5(seed, key))
    if first is not None:
        lead = F.conv(F.substring("__hash", 1, 3), 16, 10).cast("int")
        work = _first_leads(work.withColumn("__lead", lead), by, first).drop("__lead")
    ranked = _numbered(work, by, ["__hash", key], out).withColumn(out, F.col(out) + 1).drop("__hash")
    if first is None:
        return ranked
    return ranked.filter(F.col(out) <= (F.col(first) if isinstance(first, str) else F.lit(first)))


def next_in_group(df: DataFrame, value: str, group: str, order: str, out: str, block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Value of the next row of the same group, the last row taking the first one's.

    Rows in the order of (group, order) are cut into blocks of equal size, so a hot group is spread over many tasks;
    only the first row of each block, and each group's first value, cross the borders.
    """
    placed = _placed(df, [group], [order])
    mine = F.struct(F.col(group).alias("g"), F.col(value).alias("v"))
    work = placed.withColumn("__block", F.floor(F.col("__pos") / block))
    heads = work.filter(F.col("__pos") % block == 0).select((F.col("__block") - 1).alias("__block"), mine.alias("__head"))
    firsts = placed.groupBy(group).agg(F.min_by(F.struct(F.col(value).alias("v")), "__pos").alias("__first"))
    inside = work.withColumn("__next", F.lead(mine).over(W.partitionBy("__block").orderBy("__pos")))
    near = _looked_up(_looked_up(inside, heads, ["__block"], "left"), firsts, [group], "left")
    following = F.coalesce("__next", "__head")
    same = following.isNotNull() & following["g"].eqNullSafe(F.col(group))
    return near.withColumn(out, F.when(same, following["v"]).otherwise(F.col("__first.v"))).drop(
        "__pos", "__block", "__next", "__head", "__first")


def first_per_key(df: DataFrame, key: str | Sequence[str], *order: Column | str) -> DataFrame:
    """First row per key in an explicit order.

    Spark prunes to one row per key and task before the shuffle, so a hot key
    sends one row per task.
    """
    rn = F.row_number().over(W.partitionBy(*as_list(key)).orderBy(*order))
    return df.withColumn("_rn", rn).filter(F.col("_rn") == 1).drop("_rn")


def one_per_id(df: DataFrame, id_col: str, row_key: str, seed: int | str = 42) -> DataFrame:
    """One random row per id, rows without an id dropped."""
    return first_per_key(df.filter(F.col(id_col).isNotNull()), id_col, seeded_md5(seed, row_key), F.col(row_key))


def ranked_by_score(df: DataFrame, score: str, out: str) -> DataFrame:
    """Descending minimum rank of a gene-sized table's score; a null score has no rank."""
    rank = F.rank().over(W.orderBy(F.col(score).desc_nulls_last()))
    return df.withColumn(out, F.when(F.col(score).isNotNull(), rank.cast("bigint")))


def suffix_repeats(df: DataFrame, column: str, order: str, out: str | None = None) -> DataFrame:
    """Make a column unique: the first keeps its value, repeats become ``value_1, value_2, ...``.

    Numbered by ``row_index``, so an id carried by very many rows is not one task's work.
    """
    text = F.col(column).cast("string")
    numbered = row_index(df, order, "_nth", by=column)
    return numbered.withColumn(
        out or column, F.when(F.col("_nth") > 0, F.concat(text, F.lit("_"), F.col("_nth").cast("string"))).otherwise(text)
    ).drop("_nth")
