"""Cells as ranked gene lists: sentences, tokens, and their semantic variants."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from atlasloom.functions.phrases import semantic_sentence
from atlasloom.model import require_columns
from atlasloom.operators.ranking import next_in_group
from atlasloom.sizing import broadcast_if_small, settle


def gene_slots(genes: DataFrame, name: str = "gene_name") -> DataFrame:
    """Genes numbered from 1 in position order, with the name to print (gene-sized)."""
    label = F.col(name) if name in genes.columns else F.col("gene_id")
    return genes.select(
        "gene_id", label.cast("string").alias("name"), F.row_number().over(W.orderBy("pos")).alias("slot"))


def with_top_genes(counts: DataFrame, cells: DataFrame, slots: DataFrame, length: int, out: str = "top_genes") -> DataFrame:
    """Cells with gene names by value descending, ties by slot; then unexpressed genes in slot order.

    Entries are non-negative. A cell's list is bounded by the gene number; it is
    ordered and cut inside the one aggregation by cell. The fill needs only the
    first ``length`` slots: at most as many of them are expressed as the
    sentence already holds. The aggregate is joined from the left, so a reader
    that does not use the names does not compute them.
    """
    small = broadcast_if_small(slots)
    entries = counts.filter(F.col("value") > 0).join(small, "gene_id")
    per_cell = entries.groupBy("cell_id").agg(F.slice(F.sort_array(F.collect_list(
        F.struct((-F.col("value")).alias("down"), "slot", "name"))), 1, length).alias("_top"))
    head = small.filter(F.col("slot") <= length).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("slot", "name"))), lambda s: s["name"])).scalar()
    no_names, no_slots = F.array().cast("array<string>"), F.array().cast("array<int>")
    named = F.coalesce(F.transform("_top", lambda s: s["name"]), no_names)
    taken = F.coalesce(F.transform("_top", lambda s: s["slot"]), no_slots)
    n_head = F.size("_head")
    free = F.array_except(F.when(n_head > 0, F.sequence(F.lit(1), n_head)).otherwise(no_slots), taken)
    fill = F.transform(F.slice(free, F.lit(1), F.lit(length) - F.size(named)), lambda i: F.element_at(F.col("_head"), i))
    joined = cells.join(per_cell, "cell_id", "left").withColumn("_head", head)
    return joined.withColumn(out, F.when(F.size(named) >= length, named).otherwise(F.concat(named, fill))).drop("_top", "_head")


def cell_sentences(
    counts: DataFrame, cells: DataFrame, genes: DataFrame, length: int, annotation: str | None = None,
    name: str = "gene_name", label_prob: float = 0.7, seed: int | str = 42, wordings: tuple[int, int] = (40, 20),
) -> DataFrame:
    """Cells with ``cell_sentence``, and with ``semantic_true`` and ``semantic_similar`` given an annotation.

    ``genes`` is the gene table with ``highly_variable``.
    """
    require_columns(genes, ["highly_variable"], "genes")
    if annotation is not None:
        require_columns(cells, [annotation], "cells")
    slots = gene_slots(genes.filter("highly_variable"), name)
    out = with_top_genes(counts, cells, slots, length).withColumn("cell_sentence", F.array_join("top_genes", " "))
    if annotation is None:
        return out.drop("top_genes")
    out = out.withColumn("semantic_true", semantic_sentence(
        F.col("top_genes"), F.col(annotation), F.col("cell_id"), label_prob, seed, *wordings)).drop("top_genes")
    # the sentences are wanted twice, for their own cell and for the one before it
    return next_in_group(settle(out), "semantic_true", annotation, "ord", "semantic_similar")


def sentences_of_lengths(
    counts: DataFrame, cells: DataFrame, genes: DataFrame, lengths: Sequence[int], annotation: str | None = None,
    name: str = "gene_name", label_prob: float = 0.7, seed: int | str = 42, wordings: tuple[int, int] = (40, 20),
) -> DataFrame:
    """Cells with ``by_length``: what ``cell_sentences`` gives, for each of several lengths (``cs_length``).

    Genes are ranked once, at the largest length: a shorter sentence is a prefix of the longer one's names, those that
    fill it up included, as they come in slot order. The next cell's sentences of all lengths travel together.
    """
    require_columns(genes, ["highly_variable"], "genes")
    slots = gene_slots(genes.filter("highly_variable"), name)
    out = with_top_genes(counts, cells, slots, max(lengths))
    cuts = [F.slice("top_genes", 1, n) for n in lengths]
    if annotation is None:
        parts = [F.struct(F.lit(n).alias("cs_length"), F.array_join(c, " ").alias("cell_sentence")) for n, c in zip(lengths, cuts, strict=True)]
        return out.withColumn("by_length", F.array(*parts)).drop("top_genes")
    require_columns(cells, [annotation], "cells")
    said = [semantic_sentence(c, F.col(annotation), F.col("cell_id"), label_prob, seed, *wordings) for c in cuts]
    out = out.withColumn("_plain", F.array(*[F.array_join(c, " ") for c in cuts])).withColumn("_said", F.array(*said)).drop("top_genes")
    out = next_in_group(settle(out), "_said", annotation, "ord", "_similar")
    parts = [F.struct(
        F.lit(n).alias("cs_length"), F.get("_plain", F.lit(i)).alias("cell_sentence"), F.get("_said", F.lit(i)).alias("semantic_true"),
        F.get("_similar", F.lit(i)).alias("semantic_similar")) for i, n in enumerate(lengths)]
    return out.withColumn("by_length", F.array(*parts)).drop("_plain", "_said", "_similar")


def rank_tokens(
    counts: DataFrame, vocabulary: DataFrame, totals: DataFrame | None = None, target: float = 1e4, max_length: int | None = None
) -> DataFrame:
    """``cell_id, tokens``: vocabulary genes by scaled expression over the gene's median, descending.

    ``vocabulary(gene_id, token, median)``. Values are scaled to the cell total,
    taken from ``totals(cell_id, n_counts)`` or from the entries themselves.
    """
    small = broadcast_if_small(vocabulary.select("gene_id", "token", "median"))
    entries = counts
    if totals is None:
        entries = entries.withColumn("n_counts", F.sum("value").over(W.partitionBy("cell_id")))
    else:
        entries = entries.join(totals.select("cell_id", "n_counts"), "cell_id")
    score = F.col("value") / F.col("n_counts") * target / F.col("median")
    ranked = entries.join(small, "gene_id").filter(F.col("value") > 0).groupBy("cell_id").agg(
        F.sort_array(F.collect_list(F.struct((-score).alias("down"), "token"))).alias("_r"))
    if max_length is not None:
        ranked = ranked.withColumn("_r", F.slice("_r", 1, max_length))
    return ranked.select("cell_id", F.transform("_r", lambda s: s["token"]).alias("tokens"))


def usable_sentence_keys(keys: list[str], annotation: str | None) -> list[str]:
    """Semantic columns exist only with an annotation."""
    return [k for k in keys if annotation is not None or not k.startswith("semantic_")]
