"""The container handed between steps, and the checks on its columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "table") -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: columns not found: {missing}")


def as_list(value: str | Sequence[str] | None) -> list[str]:
    if value is None:
        return []
    return [value] if isinstance(value, str) else list(value)


@dataclass(frozen=True)
class Atlas:
    """Aligned tables of one dataset; ``layers`` has a ``layer`` column, ``embeddings`` a ``key`` column.

    ``genes`` has one row per gene; what groups of cells make of their genes, one row per (group, gene), is in ``group_genes``, and what
    became of each group, failed ones too, in ``group_status``. ``n_entries`` is about the number of ``counts``' rows, where it is known.
    """

    cells: DataFrame
    genes: DataFrame
    counts: DataFrame
    layers: DataFrame | None = None
    embeddings: DataFrame | None = None
    uns: DataFrame | None = None
    group_genes: DataFrame | None = None
    group_status: DataFrame | None = None
    n_entries: int | None = None

    def __post_init__(self) -> None:
        require_columns(self.cells, ["cell_id", "ord"], "cells")
        require_columns(self.genes, ["gene_id", "pos"], "genes")
        require_columns(self.counts, ["cell_id", "gene_id", "value"], "counts")

    def with_(self, **tables: DataFrame | None) -> Atlas:
        return replace(self, **tables)

    def aligned(self) -> Atlas:
        """Entries (and vectors) restricted to the cells and genes that are left."""
        counts = keep_genes(keep_cells(self.counts, self.cells), self.genes)
        layers = None if self.layers is None else keep_genes(keep_cells(self.layers, self.cells), self.genes)
        emb = None if self.embeddings is None else keep_cells(self.embeddings, self.cells)
        return self.with_(counts=counts, layers=layers, embeddings=emb)


def keep_cells(df: DataFrame, cells: DataFrame) -> DataFrame:
    return df.join(cells.select("cell_id"), "cell_id", "left_semi")


def keep_genes(df: DataFrame, genes: DataFrame) -> DataFrame:
    from atlasloom.sizing import broadcast_if_small

    return df.join(broadcast_if_small(genes.select("gene_id")), "gene_id", "left_semi")


def scoped(counts: DataFrame, cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """Entries carrying the grouping columns of their cell (a cell_id co-located join)."""
    by = [b for b in by if b not in counts.columns]
    return counts if not by else counts.join(cells.select("cell_id", *by), "cell_id")
