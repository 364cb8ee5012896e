"""Yes/no questions about a matrix, each one aggregate pass over the non-zero entries.

Implicit zeros count: denominators come from the cell and gene tables, never
from the number of stored entries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlasloom.functions.ids import is_gene_accession
from atlasloom.model import require_columns
from atlasloom.operators.ranking import hash_rank
from atlasloom.sizing import broadcast_if_small


def _cells_times_genes(cells: DataFrame, genes: DataFrame) -> Column:
    n_cells = cells.agg(F.count(F.lit(1)).cast("double")).scalar()
    n_genes = genes.agg(F.count(F.lit(1)).cast("double")).scalar()
    return n_cells * n_genes


def raw_count_check(
    counts: DataFrame, cells: DataFrame, genes: DataFrame, min_val: float = -1e-6, max_noninteger_fraction: float = 0.01,
) -> DataFrame:
    """One row: minimum, share of non-integer entries over the whole matrix, and the verdict."""
    off = F.abs(F.col("value") - F.rint("value")) > 1e-6
    stats = counts.agg(
        F.least(F.coalesce(F.min("value"), F.lit(0.0)), F.lit(0.0)).alias("min_value"),
        F.count_if(off).cast("double").alias("_off"),
    )
    return stats.select(
        "min_value", (F.col("_off") / _cells_times_genes(cells, genes)).alias("noninteger_fraction")
    ).withColumn(
        "is_raw_counts",
        (F.col("min_value") >= min_val) & (F.col("noninteger_fraction") <= max_noninteger_fraction),
    )


def log_check(counts: DataFrame, tol: float = 1e-3) -> DataFrame:
    """One row: looks log-transformed when nothing is below ``-tol`` and the maximum is under 100."""
    return counts.agg(
        F.least(F.coalesce(F.min("value"), F.lit(0.0)), F.lit(0.0)).alias("min_value"),
        F.greatest(F.coalesce(F.max("value"), F.lit(0.0)), F.lit(0.0)).alias("max_value"),
    ).withColumn("is_log", (F.col("min_value") >= -tol) & (F.col("max_value") < 100))


def normalised_check(counts: DataFrame, cells: DataFrame, var_threshold: float = 0.2) -> DataFrame:
    """One row: looks normalised when std/mean of the cell sums is under the threshold.

    Cells without entries enter through the cell count, so no join with the cell
    table is needed: mean and deviation come from the sum and the sum of squares.
    """
    n = cells.agg(F.count(F.lit(1)).cast("double")).scalar()
    sums = counts.groupBy("cell_id").agg(F.sum("value").alias("_s"))
    moments = sums.agg(
        F.coalesce(F.sum("_s"), F.lit(0.0)).alias("_t"), F.coalesce(F.sum(F.col("_s") * F.col("_s")), F.lit(0.0)).alias("_q")
    ).withColumn("_n", n)
    mean = F.col("_t") / F.col("_n")
    std = F.sqrt(F.greatest(F.col("_q") / F.col("_n") - mean * mean, F.lit(0.0)))
    return moments.select(mean.alias("mean_sum"), F.when(mean != 0, std / mean).alias("ratio")).withColumn(
        "is_normalised", F.coalesce(F.col("ratio") < var_threshold, F.lit(False))
    )


def scaled_check(
    counts: DataFrame, cells: DataFrame, genes: DataFrame, sample_genes: int | None = None, sample_cells: int | None = None,
    mean_tol: float = 0.2, std_tol: float = 0.2, fraction_thresh: float = 0.8, seed: int = 42,
) -> DataFrame:
    """One row: looks z-scaled when enough of the genes have mean near 0 and deviation near 1.

    All cells and genes are asked. A caller may ask for a sample instead, the first ids in seeded hash order.
    """
    some_cells, some_genes, entries = cells.select("cell_id"), genes.select("gene_id"), counts
    if sample_cells is not None:
        some_cells = hash_rank(some_cells, "cell_id", seed, first=sample_cells).select("cell_id")
        entries = entries.join(broadcast_if_small(some_cells), "cell_id", "left_semi")
    if sample_genes is not None:
        some_genes = hash_rank(some_genes, "gene_id", seed, first=sample_genes).select("gene_id")
        entries = entries.join(broadcast_if_small(some_genes), "gene_id", "left_semi")
    n = some_cells.agg(F.count(F.lit(1)).cast("double")).scalar()
    per_gene = entries.groupBy("gene_id").agg(
        F.sum("value").alias("_s"), F.sum(F.col("value") * F.col("value")).alias("_q"))
    # a gene without entries has mean 0 and deviation 0: it counts, as not scaled
    stats = some_genes.join(per_gene, "gene_id", "left").na.fill(0.0, ["_s", "_q"]).withColumn("_n", n)
    mean = F.col("_s") / F.col("_n")
    std = F.sqrt(F.greatest((F.col("_q") - F.col("_n") * mean * mean) / (F.col("_n") - 1), F.lit(0.0)))
    ok = (F.abs(mean) <= mean_tol) & (std >= 1 - std_tol) & (std <= 1 + std_tol)
    return stats.agg(F.avg(ok.cast("double")).alias("fraction_scaled")).withColumn(
        "is_scaled", F.col("fraction_scaled") >= fraction_thresh)


def gene_accession_check(genes: DataFrame, column: str) -> DataFrame:
    """One row: are all non-empty ids accessions, with the numbers of missing and invalid ones."""
    ident = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return genes.agg(
        F.count(F.lit(1)).alias("n_ids"),
        F.count_if(ident == "").alias("n_missing"),
        F.count_if((ident != "") & ~is_gene_accession(ident)).alias("n_invalid"),
    ).withColumn("all_valid", F.col("n_invalid") == 0)


def accession_check(
    cells: DataFrame, columns: dict[str, str], pct_tolerate: float = 0.2
) -> tuple[DataFrame, bool]:
    """Filter rows whose accession columns fit their patterns.

    Returns the rows kept and a verdict: False, with the rows unchanged, when a
    column is missing, holds no valid id, or holds more invalid ones than tolerated.
    """
    if any(c not in cells.columns for c in columns):
        return cells, False
    fits = {c: F.coalesce(F.col(c).cast("string").rlike(p), F.lit(False)) for c, p in columns.items()}
    row = cells.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(~ok).alias(f"bad_{i}") for i, ok in enumerate(fits.values())]
    ).first()
    allowed = int(row["n"] * pct_tolerate)
    bad = [row[f"bad_{i}"] for i in range(len(fits))]
    if any(b == row["n"] or b > allowed for b in bad):
        return cells, False
    kept = cells
    for ok, b in zip(fits.values(), bad):
        kept = kept.filter(ok) if b else kept
    return kept, True


# Accession formats.
EXPERIMENT_ACCESSION = r"^SRX\d+$"
SAMPLE_ACCESSION = r"^SRS\d+$"


def require_embedding_inputs(cells: DataFrame, genes: DataFrame) -> None:
    """The columns a rank-token model needs; ``n_counts`` must hold at least one number."""
    require_columns(genes, ["ensembl_id"], "genes")
    require_columns(cells, ["n_counts", "sample_index"], "cells")
    n = F.col("n_counts").cast("double")
    if cells.filter(n.isNotNull() & ~F.isnan(n)).isEmpty():
        raise ValueError("cells: n_counts has no value")


__all__ = [
    "raw_count_check", "log_check", "normalised_check", "scaled_check", "gene_accession_check", "accession_check",
    "require_embedding_inputs", "EXPERIMENT_ACCESSION", "SAMPLE_ACCESSION",
]
