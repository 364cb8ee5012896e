"""Records checked against their sources, one row per failure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlasloom.operators.filters import positive_pairs
from atlasloom.operators.ranking import row_index

#: Blocks of ids whose digests are compared before any vector moves; also the most rows of the list that is broadcast.
BLOCKS = 1 << 14


def vectors_close(a: Column, b: Column, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    """Every ``a = b`` (infinities too) or ``|a - b| <= atol + rtol * |b|``, for arrays of equal length."""
    return F.forall(F.zip_with(a, b, lambda x, y: (x == y) | (F.abs(x - y) <= F.lit(atol) + F.lit(rtol) * F.abs(y))), lambda ok: ok)


def record_failures(
    records: DataFrame, cells: DataFrame, caption: str = "caption", order: str | None = None, split: str = "split"
) -> DataFrame:
    """``sample_idx, reason``: id in one place only, caption different, place in the order different.

    ``records(sample_idx, positive or caption [, order])``; negative pairs are left out first.
    """
    rec = positive_pairs(records)
    text = "positive" if "positive" in rec.columns else "caption"
    keep = ["sample_idx", F.col(text).alias("_rc"), *([F.col(order).cast("bigint").alias("_ro")] if order else [])]
    r = rec.select(*keep)
    c = cells.select(F.col("cell_id").alias("sample_idx"), F.col(caption).alias("_cc"), F.col("ord").cast("bigint").alias("ord"))
    if order:
        r = row_index(r, "_ro", "_rp")
        c = row_index(c, "ord", "_cp")
    j = r.withColumn("_r", F.lit(1)).join(c.withColumn("_c", F.lit(1)), "sample_idx", "full")
    checks = [
        F.when(F.col("_c").isNull(), F.lit("id not in source")),
        F.when(F.col("_r").isNull(), F.lit("id not in records")),
        F.when(F.col("_c").isNotNull() & F.col("_r").isNotNull() & ~F.col("_rc").eqNullSafe(F.col("_cc")), F.lit("caption differs")),
    ]
    if order:
        checks.append(F.when(F.col("_rp") != F.col("_cp"), F.lit("order differs")))
    return j.select("sample_idx", F.explode(F.array_compact(F.array(*checks))).alias("reason"))


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.col("cell_id").cast("string"), F.col("key")), F.lit(blocks))


def block_digests(vectors: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """``block, n, n_null, d0, d1`` of ``vectors(cell_id, key, vector)``: rows, rows without a vector, and two sums of row hashes.

    Sums do not depend on order or partitioning and are combined in every task, so that a few numbers a block are all that is shuffled.
    """
    row = [F.col("cell_id").cast("string"), F.col("key"), F.col("vector").cast("array<double>")]
    sums = [F.sum(F.xxhash64(F.lit(seed), *row).cast("decimal(20,0)")).alias(f"d{seed}") for seed in (0, 1)]
    return vectors.groupBy(_block(blocks).alias("block")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("vector").isNull()).alias("n_null"), *sums)


def differing_blocks(stored: DataFrame, expected: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """``block`` of the blocks that are not the same on both sides or hold rows without a vector: at most ``blocks`` rows."""
    names = ["n", "n_null", "d0", "d1"]
    s = block_digests(stored, blocks).select("block", *[F.col(c).alias(f"s_{c}") for c in names])
    e = block_digests(expected, blocks).select("block", *[F.col(c).alias(f"e_{c}") for c in names])
    same = F.col("s_n_null") == 0
    for c in names:
        same &= F.col(f"s_{c}").eqNullSafe(F.col(f"e_{c}"))
    return s.join(e, "block", "full").filter(~F.coalesce(same, F.lit(False))).select("block")


def embedding_failures(stored: DataFrame, expected: DataFrame, rtol: float = 1e-5, atol: float = 1e-8, blocks: int = BLOCKS) -> DataFrame:
    """``cell_id, key, reason``: missing, of another length, or not close. Within a key, ids are unique on each side.

    Digests of blocks of ids are compared first; vectors are shuffled only from blocks that differ, none when both sides agree.
    """
    differ = F.broadcast(differing_blocks(stored, expected, blocks))

    def side(vectors: DataFrame, name: str) -> DataFrame:
        rows = vectors.select("cell_id", "key", F.col("vector").alias(name), _block(blocks).alias("block"))
        return rows.join(differ, "block", "left_semi").drop("block")

    j = side(stored, "_s").join(side(expected, "_e"), ["cell_id", "key"], "full")
    reason = (
        F.when(F.col("_s").isNull(), "missing in source").when(F.col("_e").isNull(), "not expected")
        .when(F.size("_s") != F.size("_e"), "shape differs")
        .when(~vectors_close(F.col("_s"), F.col("_e"), rtol, atol), "values differ"))
    return j.select("cell_id", "key", reason.alias("reason")).filter(F.col("reason").isNotNull())


def one_source(records: DataFrame, link: str = "adata_link") -> DataFrame:
    """One row: number of files the rows point to, and whether it is one; all rows are looked at."""
    return records.agg(F.count_distinct(link).alias("n_links")).withColumn("single_source", F.col("n_links") == 1)
