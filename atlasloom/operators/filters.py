"""Which cells and genes stay."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from atlasloom.functions.ids import is_gene_accession
from atlasloom.functions.text import strip
from atlasloom.model import as_list
from atlasloom.sizing import broadcast_if_small

# Gene classes kept in a panel, and the ribosomal and mitochondrial RNA classes always left out.
PANEL_BIOTYPES = ("protein_coding", "lincRNA", "antisense", "processed_transcript")
EXCLUDED_BIOTYPES = ("rRNA", "rRNA_pseudogene", "Mt_rRNA", "Mt_tRNA")


def genes_in_enough_cells(counts: DataFrame, min_cells: int, by: str | Sequence[str] | None = None) -> DataFrame:
    """Gene ids (per group) seen in at least ``min_cells`` cells.

    The count combines map-side, so only (gene, partial count) rows are shuffled.
    """
    keys = [*as_list(by), "gene_id"]
    seen = counts.filter(F.col("value") > 0).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_cells"))
    return seen.filter(F.col("n_cells") >= min_cells)


def keep_frequent_genes(counts: DataFrame, min_cells: int, by: str | Sequence[str] | None = None) -> DataFrame:
    by = as_list(by)
    kept = broadcast_if_small(genes_in_enough_cells(counts, min_cells, by).select(*by, "gene_id"))
    if not by:
        return counts.join(kept, "gene_id", "left_semi")
    cond = counts["gene_id"] == kept["gene_id"]
    for b in by:
        cond = cond & counts[b].eqNullSafe(kept[b])
    return counts.join(kept, cond, "left_semi")


def keep_rich_cells(counts: DataFrame, min_genes: int) -> DataFrame:
    """Entries of cells with at least ``min_genes`` genes, by a window that reuses the cell partitioning."""
    n = F.count_if(F.col("value") > 0).over(W.partitionBy("cell_id"))
    return counts.withColumn("_n", n).filter(F.col("_n") >= min_genes).drop("_n")


def cells_with_entries(cells: DataFrame, counts: DataFrame, min_genes: int = 1) -> DataFrame:
    n = counts.filter(F.col("value") > 0).groupBy("cell_id").agg(F.count(F.lit(1)).alias("_n"))
    return cells.join(n.filter(F.col("_n") >= min_genes), "cell_id", "left_semi")


def require_cells(cells: DataFrame) -> None:
    if cells.isEmpty():
        raise ValueError("no cells left after filtering")


def _not_finite(v: Column) -> Column:
    return v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))


def genes_with_nonfinite(counts: DataFrame) -> DataFrame:
    return counts.filter(_not_finite(F.col("value"))).select("gene_id").distinct()


def drop_nonfinite_genes(counts: DataFrame) -> DataFrame:
    return counts.join(broadcast_if_small(genes_with_nonfinite(counts)), "gene_id", "left_anti")


def gene_sums(counts: DataFrame, by: str | Sequence[str] | None = None, linear: bool = False) -> DataFrame:
    """Everything gene statistics need, in one map-side combined pass over the entries.

    Per (group, gene): non-zero and non-finite entries, sum and sum of squares,
    and with ``linear`` the same of ``expm1(value)``. The result is gene-sized.
    """
    v = F.col("value").cast("double")
    aggs = [F.count_if(v != 0).alias("n_seen"), F.count_if(_not_finite(v)).alias("n_bad"),
            F.sum(v).alias("s"), F.sum(v * v).alias("q")]
    if linear:
        x = F.expm1(v)
        aggs += [F.sum(x).alias("ls"), F.sum(x * x).alias("lq")]
    return counts.groupBy(*as_list(by), "gene_id").agg(*aggs)


def variances_from_sums(
    sums: DataFrame, cells: DataFrame, by: str | Sequence[str] | None = None, ddof: int = 0, s: str = "s", q: str = "q"
) -> DataFrame:
    """Mean and variance per (group, gene) over all cells of the group, zeros included; null where ``ddof`` leaves no cell."""
    by = as_list(by)
    if by:
        sizes = broadcast_if_small(cells.groupBy(*by).agg(F.count(F.lit(1)).cast("double").alias("_n")))
        cond = F.lit(True)
        for b in by:
            cond = cond & sums[b].eqNullSafe(sizes[b])
        sums = sums.join(sizes, cond).select(*[sums[c] for c in sums.columns], "_n")
    else:
        sums = sums.withColumn("_n", cells.agg(F.count(F.lit(1)).cast("double")).scalar())
    mean = F.col(s) / F.col("_n")
    var = F.try_divide(F.greatest(F.col(q) - F.col("_n") * mean * mean, F.lit(0.0)), F.col("_n") - ddof)
    return sums.select(*by, "gene_id", "n_seen", F.col("_n").alias("n_cells"), mean.alias("mean"), var.alias("variance"))


def gene_variances(
    counts: DataFrame, cells: DataFrame, by: str | Sequence[str] | None = None, ddof: int = 0
) -> DataFrame:
    return variances_from_sums(gene_sums(counts, by), cells, by, ddof)


def constant_genes(counts: DataFrame, cells: DataFrame) -> DataFrame:
    """Genes whose value is the same in every cell.

    Equality is decided on the values (one value, present in all cells or only
    zero), not on a rounded difference of sums.
    """
    n = cells.agg(F.count(F.lit(1))).scalar()
    v = F.col("value")
    spread = counts.groupBy("gene_id").agg(F.min(v).alias("_lo"), F.max(v).alias("_hi"), F.count_if(v != 0).alias("_c"))
    same = (F.col("_lo") == F.col("_hi")) & ((F.col("_c") == n) | (F.col("_lo") == 0))
    return spread.filter(same).select("gene_id")


def varying_genes(genes: DataFrame, counts: DataFrame, cells: DataFrame) -> DataFrame:
    """Gene rows that vary: without entries a gene is constant zero and goes too."""
    present = counts.select("gene_id").distinct()
    moving = present.join(constant_genes(counts, cells), "gene_id", "left_anti")
    return genes.join(broadcast_if_small(moving), "gene_id", "left_semi")


def batches_with_enough_genes(
    counts: DataFrame, cells: DataFrame, batch: str, min_genes: int, var_threshold: float = 1e-6, sums: DataFrame | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Batches with at least ``min_genes`` genes of non-negligible variance, every batch (of every group) checked."""
    keys = [*by, *([] if batch in by else [batch])]
    var = variances_from_sums(gene_sums(counts, keys) if sums is None else sums, cells, keys)
    n = var.filter(F.col("variance") > var_threshold).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_variable"))
    return n.filter(F.col("n_variable") >= min_genes)


def keep_batches(df: DataFrame, batches: DataFrame, batch: str, by: Sequence[str] = ()) -> DataFrame:
    keys = [*by, *([] if batch in by else [batch])]
    small = broadcast_if_small(batches.select(*[F.col(k).alias(f"_{k}") for k in keys]))
    same = F.lit(True)
    for k in keys:
        same = same & df[k].eqNullSafe(small[f"_{k}"])
    return df.join(small, same, "left_semi")


def named_genes(genes: DataFrame, column: str) -> DataFrame:
    name = F.col(column).cast("string")
    return genes.filter(name.isNotNull() & ~name.isin("", "nan"))


def accession_genes(genes: DataFrame, column: str) -> DataFrame:
    return genes.filter(is_gene_accession(F.col(column)))


def described_terms(terms: DataFrame, description: str = "description") -> tuple[DataFrame, DataFrame]:
    """Rows with a non-blank description, and the rows dropped."""
    has = F.coalesce(strip(F.col(description)) != "", F.lit(False))
    return terms.filter(has), terms.filter(~has)


def panel_biotypes(genes: DataFrame, biotype: str, keep: Sequence[str] = PANEL_BIOTYPES) -> DataFrame:
    return genes.filter(F.col(biotype).isin(*keep) & ~F.col(biotype).isin(*EXCLUDED_BIOTYPES))


def approved_symbols(
    table: DataFrame, symbol: str = "symbol", status: str = "status", locus: str = "locus_type",
    locus_types: Sequence[str] | None = None, approved: str = "Approved",
) -> DataFrame:
    rows = table.filter(F.col(status) == approved)
    if locus_types:
        rows = rows.filter(F.col(locus).isin(*locus_types))
    return rows.filter(F.col(symbol).isNotNull()).select(symbol).distinct()


def where_all(df: DataFrame, condition: str | Column) -> DataFrame:
    """Row filter by a SQL condition; reaches the scan as pushed filters."""
    return df.where(condition)


def positive_pairs(records: DataFrame) -> DataFrame:
    return records.filter(F.col("label") == 1) if "label" in records.columns else records


def primary_rows(cells: DataFrame, flag: str = "is_primary_data") -> DataFrame:
    return cells.filter(F.col(flag).cast("boolean"))
