"""Principal components fitted over several datasets on one panel."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from atlasloom.model import Atlas
from atlasloom.operators.embeddings import fit_components
from atlasloom.operators.setops import common_genes
from atlasloom.sizing import broadcast_if_small


def fit_over_datasets(datasets: Sequence[Atlas], n_components: int, panel: DataFrame | None = None, **kw) -> tuple[DataFrame, DataFrame]:
    """Pool the datasets on the panel (or their common genes, sorted) and fit once.

    Cell ids are made distinct across datasets by the dataset's number.
    """
    if panel is None:
        common = common_genes([a.genes for a in datasets])
        panel = common.withColumn("pos", F.row_number().over(W.orderBy("gene_id")).cast("bigint"))
    panel = broadcast_if_small(panel.select("gene_id", "pos"))

    def tagged(df: DataFrame, i: int) -> DataFrame:
        return df.withColumn("cell_id", F.concat(F.lit(f"{i}:"), F.col("cell_id").cast("string")))

    cells = reduce(lambda a, b: a.unionByName(b), [tagged(a.cells.select("cell_id"), i) for i, a in enumerate(datasets)])
    counts = reduce(lambda a, b: a.unionByName(b), [
        tagged(a.counts.select("cell_id", "gene_id", "value"), i) for i, a in enumerate(datasets)])
    return fit_components(counts.join(panel.select("gene_id"), "gene_id", "left_semi"), cells, panel, n_components, **kw)
