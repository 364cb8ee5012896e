"""Unions of datasets and gene-set algebra."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from atlasloom.operators.ranking import first_per_key
from atlasloom.sizing import broadcast_if_small


def _stack(parts: Sequence[DataFrame], tag: str, labels: Sequence | None = None, missing: bool = True) -> DataFrame:
    tagged = [p.withColumn(tag, F.lit(i if labels is None else labels[i])) for i, p in enumerate(parts)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=missing), tagged)


def pool_samples(sources: Sequence[DataFrame], sentence_counts: Sequence[int] | None = None) -> DataFrame:
    """Rows of several inputs in input order; a repeated index keeps its first place and its last content.

    Positions of an input follow on the largest of the one before, so any positions keep the order of the inputs.
    """
    if sentence_counts is not None and len(set(sentence_counts)) > 1:
        raise ValueError(f"all inputs need the same number of sentence columns, got {list(sentence_counts)}")
    if len(sources) == 1:
        return sources[0]
    ends = _stack([p.select(F.col("ord").cast("bigint").alias("ord")) for p in sources], "_src").groupBy("_src").agg(F.min("ord"), F.max("ord"))
    found = {r[0]: (r[1] or 0, r[2] or 0) for r in ends.collect()}  # one row per input
    starts, after = [], 0
    for i in range(len(sources)):
        low, high = found.get(i, (0, -1))
        starts.append(after - low)
        after += high - low + 1
    moved = [p.withColumn("ord", F.col("ord").cast("bigint") + F.lit(start).cast("bigint")) for p, start in zip(sources, starts, strict=True)]
    pooled = _stack(moved, "_src")
    place = F.min("ord").over(W.partitionBy("sample_idx"))
    return first_per_key(pooled.withColumn("_place", place), "sample_idx", F.desc("ord")).withColumn(
        "ord", F.col("_place")).drop("_place", "_src")


def concat_matrices(
    cells: Sequence[DataFrame], counts: Sequence[DataFrame], genes: Sequence[DataFrame] | None = None,
    label: str = "split", labels: Sequence | None = None, join: str = "outer",
) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Stack datasets; ``outer`` keeps all genes (absent ones are zeros), ``inner`` those common to all.

    Gene columns are merged with the last dataset that has a value winning.
    """
    all_cells = _stack(cells, label, labels)
    all_counts = reduce(lambda a, b: a.unionByName(b), [c.select("cell_id", "gene_id", "value") for c in counts])
    merged = None
    if genes is not None:
        merged = merge_gene_tables(genes)
        if join == "inner":
            common = broadcast_if_small(common_genes(genes))
            merged = merged.join(common, "gene_id", "left_semi")
            all_counts = all_counts.join(common, "gene_id", "left_semi")
    return all_cells, all_counts, merged


def merge_gene_tables(genes: Sequence[DataFrame]) -> DataFrame:
    """One row per gene, per column the value of the last table that has one; places by first appearance."""
    stacked = _stack(genes, "_src")
    columns = [c for c in stacked.columns if c not in ("gene_id", "pos", "_src")]
    rows = stacked.groupBy("gene_id").agg(
        F.min(F.struct("_src", "pos")).alias("_at"),
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_src"))).alias(c) for c in columns])
    place = F.row_number().over(W.orderBy("_at")) - 1  # gene-sized
    return rows.withColumn("pos", place.cast("bigint")).drop("_at")


def merge_group_genes(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per gene of a table with one per (group, gene): per column the value of the last group that has one."""
    last = F.struct(*by)
    columns = [c for c in rows.columns if c not in ("gene_id", *by)]
    return rows.groupBy("gene_id").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), last)).alias(c) for c in columns])


def require_same_genes(genes: Sequence[DataFrame]) -> None:
    n = len(genes)
    if not _stack([g.select("gene_id") for g in genes], "_src").groupBy("gene_id").agg(
        F.count_distinct("_src").alias("n")).filter(F.col("n") != n).isEmpty():
        raise ValueError("datasets do not have the same genes")


def concat_same_genes(cells: Sequence[DataFrame], counts: Sequence[DataFrame], genes: Sequence[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Stack datasets with identical genes; cells carry ``dataset_index``."""
    require_same_genes(genes)
    c, e, _ = concat_matrices(cells, counts, label="dataset_index")
    return c, e


def common_genes(datasets: Sequence[DataFrame], column: str = "gene_id") -> DataFrame:
    """Genes of every dataset."""
    return _stack([d.select(column) for d in datasets], "_src").groupBy(column).agg(
        F.count_distinct("_src").alias("_n")).filter(F.col("_n") == len(datasets)).select(column)


def compare_gene_lists(a: DataFrame, b: DataFrame, column: str = "gene_id") -> DataFrame:
    """Genes of both lists, of the first only and of the second only."""
    sides = a.select(column).withColumn("_a", F.lit(1)).withColumn("_b", F.lit(0)).unionByName(
        b.select(column).withColumn("_a", F.lit(0)).withColumn("_b", F.lit(1)))
    return sides.groupBy(column).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b")).select(
        column, F.when(F.col("_a") + F.col("_b") == 2, "both").when(F.col("_a") == 1, "first only").otherwise(
            "second only").alias("side"))


def both_sorted(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    return a.select(column).intersect(b.select(column)).orderBy(column)


def union_distinct(*parts: DataFrame) -> DataFrame:
    return reduce(lambda x, y: x.unionByName(y), parts).distinct()


def stable_genes(rankings: DataFrame, n_datasets: int, size: int, gene: str = "gene_id") -> DataFrame:
    """Genes for all datasets: those selected everywhere by mean rank, filled by (datasets, mean rank).

    ``rankings(dataset, gene, rank, highly_variable)``. If enough genes are
    selected everywhere, their mean rank runs over all datasets; a candidate's
    over the datasets that selected it, so the two coincide where it matters.
    """
    per_gene = rankings.filter("highly_variable").groupBy(gene).agg(
        F.count_distinct("dataset").alias("n_datasets"), F.avg("rank").alias("mean_rank"))
    everywhere = (F.col("n_datasets") == n_datasets)
    return per_gene.withColumn("in_all", everywhere).orderBy(
        F.desc("in_all"), F.desc("n_datasets"), F.col("mean_rank").asc_nulls_last(), gene).limit(size)


def selection_summary(selected: DataFrame, per_dataset: DataFrame, n_datasets: int, gene: str = "gene_id") -> DataFrame:
    """One row: datasets, genes selected everywhere, final size and origin of the final genes."""
    everywhere = per_dataset.filter("highly_variable").groupBy(gene).agg(
        F.count_distinct("dataset").alias("_n")).filter(F.col("_n") == n_datasets)
    return selected.agg(
        F.lit(n_datasets).cast("bigint").alias("total_datasets"),
        F.count(F.lit(1)).alias("final_gene_count"),
        F.count_if("in_all").alias("genes_from_intersection"),
        F.count_if(~F.col("in_all")).alias("genes_from_candidates"),
    ).withColumn("intersection_size", everywhere.agg(F.count(F.lit(1))).scalar())
