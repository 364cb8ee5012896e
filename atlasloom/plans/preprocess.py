"""Preprocessing as one lineage: raw counts, quality, filters, scaling, variable genes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlasloom.model import Atlas, as_list, keep_cells, scoped
from atlasloom.operators import edits, filters
from atlasloom.operators.group_mixtures import split_groups_if_bimodal
from atlasloom.operators.lookups import enrich_accessions, map_symbols
from atlasloom.operators.normalise import ensure_raw_counts, ensure_raw_counts_by, log_normalise
from atlasloom.operators.quality import passing_cells, quality_verdict
from atlasloom.operators.setops import merge_group_genes
from atlasloom.operators.variable_genes import variable_genes
from atlasloom.sizing import broadcast_if_small, settle, settle_by_key


#: Least values of whole-number parameters, and shares that lie between 0 and 1.
LEAST = {"min_cells": 1, "min_genes": 1, "n_top_genes": 1, "category_threshold": 1, "chunk_size": 1, "subset_size": 1}
SHARES = ("train_frac",)


@dataclass(frozen=True)
class Settings:
    """What a run of ``preprocess`` may be told."""

    min_cells: int = 10
    min_genes: int = 200
    n_top_genes: int = 1000
    batch: str | None = None
    categories: tuple[str, ...] = ()
    category_threshold: int = 1
    remove_rare: bool = True
    count_layer: str | None = None
    drop_layers: tuple[str, ...] = ()
    bimodal_column: str | None = None
    instrument: str | None = None
    description: str | None = None
    token_inputs: bool = False
    symbol: str = "gene_name"
    normalise: str = "force"
    families: dict[str, Column] | None = None
    mt: str = "mt"
    percent_top: tuple[int, ...] = (20,)

    def __post_init__(self) -> None:
        for name, least in LEAST.items():
            if getattr(self, name, least) < least:
                raise ValueError(f"{name} must be at least {least}")


def judged_requests(requests: DataFrame) -> DataFrame:
    """``requests`` with ``refused``: null where the value of ``parameter`` (``value``, a number) may be used, else why not.

    The checks that constructors make, for a table of runs to be planned.
    """
    least = F.create_map(*[F.lit(x) for pair in LEAST.items() for x in pair])[F.col("parameter")]
    value = F.col("value").cast("double")
    return requests.withColumn("refused", F.when(value.isNull() | F.isnan(value), "no value")
                               .when(F.col("parameter").isin(*SHARES), F.when((value <= 0) | (value >= 1), "not between 0 and 1"))
                               .when(least.isNull(), "unknown parameter").when(value != F.floor(value), "not a whole number")
                               .when(value < least, F.concat(F.lit("less than "), least.cast("string"))))


def general(atlas: Atlas, s: Settings, by: Sequence[str] = ()) -> Atlas:
    """Gene and cell filters, rare categories, scaling, variable genes.

    Cells are filtered on the genes that were kept, once. With ``by`` every
    statistic is per group, and the gene table becomes one row per (group, gene).

    The entries are read three times: for the gene filter, for the cells left,
    and for all gene statistics together (finiteness, variance per batch,
    dispersion). What follows from those is gene- or cell-sized.
    """
    by = list(by)
    counts = filters.keep_frequent_genes(scoped(atlas.counts, atlas.cells, by), s.min_cells, by)
    counts = filters.keep_rich_cells(counts, s.min_genes)
    cells = settle(filters.cells_with_entries(atlas.cells, counts))
    if s.categories:
        cells = edits.consolidate_categories(cells, s.categories, s.category_threshold, s.remove_rare, by)
        if s.remove_rare:
            cells = settle(cells)
            counts = keep_cells(counts, cells)
    filters.require_cells(cells)
    counts = log_normalise(counts, cells, s.normalise)
    batch = s.batch if s.batch in cells.columns else None
    keys = list(dict.fromkeys([*by, *([batch] if batch else [])]))
    sums = settle(filters.gene_sums(scoped(counts, cells, keys), keys, linear=True))
    # a gene that isn't finite in one group goes from that group alone
    bad = sums.filter("n_bad > 0").select(*by, "gene_id").distinct()
    if not bad.isEmpty():
        sums, counts = (_without_pairs(df, bad, [*by, "gene_id"]) for df in (sums, counts))
    genes = atlas.genes.join(broadcast_if_small(sums.select("gene_id").distinct()), "gene_id", "left_semi")
    if batch:
        enough = filters.batches_with_enough_genes(counts, cells, batch, s.n_top_genes, sums=sums, by=by)
        cells, sums = (filters.keep_batches(df, enough, batch, by) for df in (cells, sums))
        counts = keep_cells(counts, cells)
        filters.require_cells(cells)
    scored = variable_genes(counts, cells, genes, s.n_top_genes, batch, by=by, sums=sums)
    if by:
        scored = scored.join(broadcast_if_small(genes), "gene_id")
    return Atlas(cells, scored, counts.select("cell_id", "gene_id", "value", *by), atlas.layers, atlas.embeddings, atlas.uns)


def _without_pairs(df: DataFrame, listed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose keys, null equal to null, are not listed."""
    small = broadcast_if_small(listed.select(*[F.col(k).alias(f"_{k}") for k in keys]))
    same = F.lit(True)
    for k in keys:
        same = same & df[k].eqNullSafe(small[f"_{k}"])
    return df.join(small, same, "left_anti")


def token_inputs(atlas: Atlas, raw: DataFrame, lookup: DataFrame | None = None, symbol: str = "gene_name",
                 by: Sequence[str] = ()) -> Atlas:
    """``ensembl_id`` on genes; ``n_counts`` and ``sample_index`` on cells."""
    genes, cells = atlas.genes, atlas.cells
    if "ensembl_id" not in genes.columns:
        if lookup is None:
            raise ValueError("genes: no 'ensembl_id' and no lookup table")
        genes = map_symbols(genes, lookup, symbol)
    totals = raw.groupBy("cell_id").agg(F.sum("value").cast("double").alias("n_counts"))
    cells = cells.drop("n_counts", "sample_index").join(totals, "cell_id", "left").na.fill(0.0, ["n_counts"])
    return atlas.with_(cells=edits.add_sample_index(cells, by), genes=genes)


#: Why a group is left out.
NO_COUNTS, NO_GOOD_CELLS, NO_CELLS = "no raw counts", "no cells pass quality control", "no cells left after filtering"
DONE = "done"


class _Groups:
    """What becomes of the groups that a run treats each on its own: failed ones leave, with a reason, and the rest goes on."""

    def __init__(self, cells: DataFrame, by: Sequence[str]):
        self.by = list(by)
        self.reasons: list[DataFrame] = []
        self.sizes = settle(cells.groupBy(*self.by).agg(F.count(F.lit(1)).alias("n_cells"))) if self.by else None

    @property
    def any_failed(self) -> bool:
        return bool(self.reasons)

    def failed(self, df: DataFrame, groups: DataFrame, reason: str) -> DataFrame:
        """``df`` without the listed groups, which are noted."""
        groups = settle(groups.select(*self.by).distinct())
        if groups.isEmpty():
            return df
        self.reasons.append(groups.withColumn("status", F.lit(reason)))
        return _without_pairs(df, groups, self.by)

    def lost(self, before: DataFrame, after: DataFrame, parts: Sequence[str]) -> DataFrame:
        """Groups of which a part (``parts`` are finer columns) has no cells any more."""
        return _without_pairs(before.select(*parts).distinct(), after.select(*parts).distinct(), parts)

    def without_lost(self, before: DataFrame, after: DataFrame, parts: Sequence[str], reason: str) -> DataFrame:
        return self.failed(after, self.lost(before, after, parts), reason) if self.by else after

    def close(self, before: DataFrame, out: Atlas, parts: Sequence[str]) -> Atlas:
        """The result without groups that lost their last cells, and ``group_status``."""
        cells = settle(out.cells)
        out = out.with_(cells=cells)
        noted = len(self.reasons)
        cells = self.failed(cells, self.lost(before, cells, parts), NO_CELLS)
        if len(self.reasons) > noted:
            gone = self.reasons[-1].select(*self.by)
            out = out.with_(cells=cells, counts=_without_pairs(out.counts, gone, self.by), genes=_without_pairs(out.genes, gone, self.by))
        kept = out.cells.groupBy(*[F.col(b).alias(f"_{b}") for b in self.by]).agg(F.count(F.lit(1)).alias("n_kept"))
        same = F.lit(True)
        for b in self.by:
            same = same & self.sizes[b].eqNullSafe(kept[f"_{b}"])
        status = self.sizes.join(kept, same, "left").drop(*[f"_{b}" for b in self.by]).na.fill(0, ["n_kept"])
        if self.reasons:
            told = self.reasons[0]
            for more in self.reasons[1:]:
                told = told.unionByName(more)
            told = told.select(*[F.col(b).alias(f"_{b}") for b in self.by], "status")
            same = F.lit(True)
            for b in self.by:
                same = same & status[b].eqNullSafe(told[f"_{b}"])
            status = status.join(told, same, "left").drop(*[f"_{b}" for b in self.by]).na.fill(DONE, ["status"])
        else:
            status = status.withColumn("status", F.lit(DONE))
        filters.require_cells(out.cells)
        return out.with_(group_status=settle(status))


def preprocess(
    atlas: Atlas, settings: Settings | None = None, by: str | Sequence[str] | None = None,
    accession_lookup: DataFrame | None = None, accession_columns: Sequence[str] = (), symbol_lookup: DataFrame | None = None,
    skip_accessions: bool = False, continue_on_fail: bool = False,
) -> Atlas:
    """The whole chain. ``by`` names columns (chunk, split) whose groups are treated each on its own.

    Groups are one dataset again at the end: ``genes`` has one row per gene, with the values of the last group that has any, and
    ``group_genes`` keeps every group's own. A group that fails (no raw counts, or no cells left in one of its parts) is left out
    with all its cells and reported in ``group_status``; the others go on. Only when all fail is that an error.
    """
    s = settings or Settings()
    groups = as_list(by)
    # every later pass groups by cell: written once by cell, no pass shuffles the entries again
    atlas = atlas.with_(counts=settle_by_key(atlas.counts, "cell_id", rows=atlas.n_entries))
    status = _Groups(atlas.cells, groups)
    if groups:
        atlas, without = ensure_raw_counts_by(atlas, groups, s.count_layer)
        atlas = atlas.with_(cells=status.failed(atlas.cells, without, NO_COUNTS))
    else:
        atlas = ensure_raw_counts(atlas, s.count_layer)
    if s.drop_layers:
        atlas = atlas.with_(layers=edits.drop_layers(atlas.layers, s.drop_layers))
    atlas = atlas.with_(cells=edits.drop_null_columns(atlas.cells), genes=edits.drop_null_columns(atlas.genes))
    if s.bimodal_column and s.bimodal_column in atlas.cells.columns:
        cells = edits.add_log_column(atlas.cells, s.bimodal_column)
        # every group is tested by itself
        atlas = atlas.with_(cells=settle(split_groups_if_bimodal(cells, f"{s.bimodal_column}_log", groups)))
        groups = [*groups, "bimodal_split"]
    cells = atlas.cells
    if accession_columns:
        cells = enrich_accessions(cells, accession_lookup, accession_columns, skip=skip_accessions, continue_on_fail=continue_on_fail)
    raw = keep_cells(atlas.counts, cells) if accession_columns or status.any_failed else atlas.counts
    judged = quality_verdict(raw, cells, atlas.genes, percent_top=s.percent_top, families=s.families, mt=s.mt, by=groups,
                             symbol=s.symbol)
    judged = settle(judged) if status.by else judged
    cells = settle(passing_cells(judged))
    cells = status.without_lost(judged, cells, groups, NO_GOOD_CELLS)
    out = general(atlas.with_(cells=cells, counts=keep_cells(raw, cells)), s, groups)
    if status.by:
        out = status.close(cells, out, groups)
    if groups:
        own = settle(out.genes)
        out = out.with_(genes=merge_group_genes(own, groups), group_genes=own)
    if s.token_inputs:
        out = token_inputs(out, raw, symbol_lookup, s.symbol, groups)
    if s.instrument and s.description:
        out = out.with_(cells=edits.prepend_instrument(out.cells, s.instrument, s.description))
    return out


def cleanup_variable_genes(
    atlas: Atlas, n_top_genes: int = 2000, batch: str | None = None, min_genes: int = 200, min_cells: int = 3,
    families: dict[str, Column] | None = None, mt: str = "mt", symbol: str = "gene_name", percent_top: Sequence[int] = (20,),
) -> Atlas:
    """Quality filter, general steps without rare batches, then only the variable genes."""
    n = min(n_top_genes, atlas.genes.count())
    atlas = atlas.with_(counts=settle_by_key(atlas.counts, "cell_id", rows=atlas.n_entries))
    judged = quality_verdict(
        atlas.counts, atlas.cells, atlas.genes, percent_top=percent_top, families=families, mt=mt, symbol=symbol)
    cells = settle(passing_cells(judged))
    s = Settings(min_cells=min_cells, min_genes=min_genes, n_top_genes=n, batch=batch,
                 categories=(batch,) if batch else (), category_threshold=5)
    out = general(atlas.with_(cells=cells, counts=keep_cells(atlas.counts, cells)), s)
    genes = out.genes.filter("highly_variable")
    small = broadcast_if_small(genes.select("gene_id"))
    return out.with_(genes=genes, counts=out.counts.join(small, "gene_id", "left_semi"))
