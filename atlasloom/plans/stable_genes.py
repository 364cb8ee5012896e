"""One stable set of variable genes over several datasets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlasloom.model import Atlas, scoped
from atlasloom.operators.edits import gene_id_from_column, relabel_genes
from atlasloom.operators.filters import batches_with_enough_genes, gene_sums, keep_batches, named_genes
from atlasloom.operators.normalise import log_normalise
from atlasloom.operators.ranking import ranked_by_score
from atlasloom.operators.setops import stable_genes
from atlasloom.operators.variable_genes import variable_genes
from atlasloom.sizing import settle


def dataset_ranking(atlas: Atlas, name: str, n_genes: int, gene_column: str | None = None, batch: str | None = None,
                    normalise: str = "force") -> DataFrame:
    """``dataset, gene_id, highly_variable, rank`` of one dataset, under its gene names."""
    genes, counts, cells = atlas.genes, atlas.counts, atlas.cells
    if gene_column is not None:
        genes = settle(gene_id_from_column(named_genes(genes, gene_column), gene_column))
        counts = relabel_genes(counts, genes)
    counts = log_normalise(counts, cells, normalise)
    batch = batch if batch in cells.columns else None
    sums = gene_sums(scoped(counts, cells, [batch]) if batch else counts, batch, linear=True)
    if batch is not None:
        sums = settle(sums)
        enough = batches_with_enough_genes(counts, cells, batch, n_genes, sums=sums)
        cells, sums = (keep_batches(df, enough, batch) for df in (cells, sums))
    scored = variable_genes(counts, cells, genes, n_genes, batch, sums=sums)
    return ranked_by_score(scored, "dispersions_norm", "rank").select(
        F.lit(name).alias("dataset"), "gene_id", "highly_variable", "rank")


def select_stable_genes(datasets: dict[str, Atlas], n_genes: int, final: int, **kw) -> tuple[DataFrame, DataFrame]:
    """The stable set, and the rankings it came from (gene-sized)."""
    parts: Sequence[DataFrame] = [dataset_ranking(a, n, n_genes, **kw) for n, a in datasets.items()]
    rankings = settle(reduce(lambda a, b: a.unionByName(b), parts))
    return stable_genes(rankings, len(datasets), final), rankings
