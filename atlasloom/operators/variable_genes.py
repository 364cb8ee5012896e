"""Highly variable genes by binned, normalised dispersion (Satija et al. 2015).

One pass touches the entries: sums per (group, gene), combined map-side.
Everything after works on gene-sized tables, of which no group passes through
one task: bins are aggregated, and the first genes are sought per slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from atlasloom.operators.filters import gene_sums, variances_from_sums
from atlasloom.operators.quality import _with_group_row
from atlasloom.sizing import broadcast_if_small, settle

#: Parts of each group's genes whose first rows are sought apart.
SLICES = 64


def _slice() -> Column:
    return F.pmod(F.xxhash64("gene_id"), F.lit(SLICES))


def _first_of_slices(d: DataFrame, by: list[str], n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows of each group, from the first ``n`` of each of its slices (``_slice``)."""
    near = d.withColumn("_near", F.row_number().over(W.partitionBy(*by, "_slice").orderBy(*order))).filter(F.col("_near") <= n)
    whole = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))  # n rows of each slice at most
    return near.withColumn("_place", F.row_number().over(whole.orderBy(*order))).filter(F.col("_place") <= n)


def _binned_dispersion(moments: DataFrame, by: list[str], n_bins: int) -> DataFrame:
    """Normalised dispersion of gene moments, each group on its own."""
    mean = F.when(F.col("mean") == 0, F.lit(1e-12)).otherwise(F.col("mean"))
    ratio = F.col("variance") / mean
    d = moments.select(
        *by, "gene_id", F.log1p(mean).alias("means"), F.when(ratio > 0, F.log(ratio)).alias("dispersions")
    )
    lo, width = F.col("_lo"), (F.col("_hi") - F.col("_lo")) / F.lit(float(n_bins))
    d = _with_group_row(d, d.groupBy(*by).agg(F.min("means").alias("_lo"), F.max("means").alias("_hi")), by)
    d = d.withColumn(
        "mean_bin",
        F.when(F.col("_hi") == lo, F.lit(0)).otherwise(
            F.least(F.greatest(F.ceil((F.col("means") - lo) / width) - 1, F.lit(0)), F.lit(n_bins - 1))
        ).cast("int"),
    )
    bins = d.groupBy(*by, "mean_bin").agg(F.avg("dispersions").alias("_avg"), F.stddev_samp("dispersions").alias("_dev"))
    d = _with_group_row(d, bins, [*by, "mean_bin"])
    single = F.col("_dev").isNull() | F.isnan("_dev")
    centre = F.when(single, F.lit(0.0)).otherwise(F.col("_avg"))
    spread = F.when(single, F.col("_avg")).otherwise(F.col("_dev"))
    # genes that are alike differ by no more than the order of summation: no spread, and equal to nine places
    norm = F.when(F.abs(spread) > 1e-12, F.round((F.col("dispersions") - centre) / spread, 9))
    return d.select(*by, "gene_id", "means", "dispersions", "mean_bin", norm.alias("dispersions_norm"))


def _mark_top(d: DataFrame, by: list[str], n_top: int) -> DataFrame:
    """At or above the n-th largest normalised dispersion; ties at the cut-off all count."""
    d = settle(d)  # both the cut-off and the marks read it
    known = d.filter("dispersions_norm IS NOT NULL").withColumn("_slice", _slice())
    best = _first_of_slices(known, by, n_top, F.desc("dispersions_norm"))
    d = _with_group_row(d, best.groupBy(*by).agg(F.min("dispersions_norm").alias("_cut")), by)
    return d.withColumn(
        "highly_variable", F.coalesce(F.coalesce("dispersions_norm", F.lit(0.0)) >= F.col("_cut"), F.lit(False))
    ).drop("_cut")


def variable_genes(
    counts: DataFrame, cells: DataFrame, genes: DataFrame, n_top: int, batch: str | None = None, n_bins: int = 20,
    by: list[str] | None = None, sums: DataFrame | None = None,
) -> DataFrame:
    """Gene table with ``means, dispersions, dispersions_norm, highly_variable``.

    ``counts`` holds log-normalised values. ``by`` repeats the whole selection
    per group (columns carried by ``counts`` and ``cells``). With ``batch`` the
    genes of each batch are scored among themselves, then ordered by the number
    of batches selecting them and their mean score, a batch without the gene
    adding a score of zero; ``highly_variable_nbatches`` is added. ``sums`` is the
    result of ``gene_sums(..., linear=True)`` on the same keys, if already there.
    """
    by = list(by or [])
    keys = [*by, *([batch] if batch else [])]
    if sums is None:
        sums = settle(gene_sums(counts, keys, linear=True))
    moments = variances_from_sums(sums, cells, keys, 1, "ls", "lq")
    if batch is None:
        if not by:
            # genes without entries have mean and variance zero and belong to the bins
            moments = genes.select("gene_id").join(moments, "gene_id", "left").na.fill(0.0, ["mean", "variance"])
        marked = _mark_top(_binned_dispersion(moments, by, n_bins), by, n_top).drop("mean_bin")
        if by:
            return marked
        return genes.join(marked, "gene_id", "left")

    expressed = moments.filter("n_seen > 0")
    scored = _mark_top(_binned_dispersion(expressed, keys, n_bins), keys, n_top)
    batches = cells.groupBy(*by).agg(F.count_distinct(F.coalesce(F.col(batch).cast("string"), F.lit("\0"))).alias("_nb"))
    pooled = scored.groupBy(*by, "gene_id").agg(
        F.sum("means").alias("_m"), F.sum(F.coalesce("dispersions", F.lit(0.0))).alias("_d"),
        F.count_if(F.col("dispersions").isNull()).alias("_dnull"),
        F.sum("dispersions_norm").alias("_s"), F.count_if(F.col("dispersions_norm").isNull()).alias("_null"),
        F.count_if("highly_variable").alias("highly_variable_nbatches"),
    )
    if by:
        nb = broadcast_if_small(batches)
        cond = F.lit(True)
        for b in by:
            cond = cond & pooled[b].eqNullSafe(nb[b])
        pooled = pooled.join(nb, cond).select(*[pooled[b] for b in by], *[c for c in pooled.columns if c not in by], "_nb")
    else:
        pooled = genes.select("gene_id").join(pooled, "gene_id", "left").withColumn("_nb", batches.scalar())
    zero = F.lit(0.0)
    pooled = pooled.select(
        *by, "gene_id",
        (F.coalesce("_m", zero) / F.col("_nb")).alias("means"),
        F.when(F.col("_nb") > F.coalesce("_dnull", F.lit(0)),
               F.coalesce("_d", zero) / (F.col("_nb") - F.coalesce("_dnull", F.lit(0)))).alias("dispersions"),
        F.when(F.col("_nb") > F.coalesce("_null", F.lit(0)),
               F.coalesce("_s", zero) / (F.col("_nb") - F.coalesce("_null", F.lit(0)))).alias("dispersions_norm"),
        F.coalesce("highly_variable_nbatches", F.lit(0)).alias("highly_variable_nbatches"),
    )
    pooled = pooled.join(broadcast_if_small(genes.select("gene_id", "pos")), "gene_id")
    order = [F.desc("highly_variable_nbatches"), F.col("dispersions_norm").desc_nulls_last(), F.col("pos")]
    pooled = pooled.withColumn("_slice", _slice())
    pooled = settle(pooled.withColumn("_nth", F.row_number().over(W.partitionBy(*by, "_slice").orderBy(*order))))
    # the first genes are the first so many of each slice: rows equal in order are told apart by their place there
    wins = _first_of_slices(pooled, by, n_top, *order).groupBy(*by, "_slice").agg(F.count(F.lit(1)).alias("_wins"))
    pooled = _with_group_row(pooled, wins, [*by, "_slice"])
    pooled = pooled.withColumn("highly_variable", F.coalesce(F.col("_nth") <= F.col("_wins"), F.lit(False))).drop(
        "pos", "_slice", "_nth", "_wins")
    return pooled if by else genes.join(pooled, "gene_id", "left")


def exact_top_genes(scored: DataFrame, n_top: int) -> DataFrame:
    """Exactly ``n_top`` genes, largest normalised dispersion first, ties by position."""
    return scored.orderBy(F.col("dispersions_norm").desc_nulls_last(), "pos").limit(n_top)
