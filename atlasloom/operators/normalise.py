"""Count scaling, and the guarantee of a raw-count layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from atlasloom.model import Atlas
from atlasloom.operators.predicates import log_check, normalised_check, raw_count_check
from atlasloom.sizing import broadcast_if_small, partitions_for, settle_by_key


def scale_to_total(counts: DataFrame, target: float = 1e4) -> DataFrame:
    """Each cell scaled to ``target``; a cell summing to zero is left as it is."""
    total = F.sum("value").over(W.partitionBy("cell_id"))
    return counts.withColumn("_t", total).withColumn(
        "value", F.when(F.col("_t") == 0, F.col("value")).otherwise(F.col("value") * F.lit(target) / F.col("_t"))
    ).drop("_t")


def log_normalise(
    counts: DataFrame, cells: DataFrame | None = None, mode: str = "force", target: float = 1e4, var_threshold: float = 0.2
) -> DataFrame:
    """``force`` scales and takes ``log1p``; ``auto`` does each only when the data, as given, do not look like it."""
    if mode not in {"force", "auto"}:
        raise ValueError("mode must be 'force' or 'auto'")
    counts = counts.withColumn("value", F.col("value").cast("double"))
    scale = take_log = True
    if mode == "auto":
        if cells is None:
            raise ValueError("mode='auto' needs the cell table")
        scale = not normalised_check(counts, cells, var_threshold).first()["is_normalised"]
        take_log = not log_check(counts).first()["is_log"]
    if scale:
        counts = scale_to_total(counts, target)
    return counts.withColumn("value", F.log1p("value")) if take_log else counts


def _is_raw(entries: DataFrame, atlas: Atlas, genes: DataFrame | None = None) -> bool:
    genes = atlas.genes if genes is None else genes
    return bool(raw_count_check(entries, atlas.cells, genes).first()["is_raw_counts"])


def ensure_raw_counts(
    atlas: Atlas, layer: str | None = None, raise_on_missing: bool = True, raw_genes: DataFrame | None = None
) -> Atlas:
    """Raw counts as the main entries and as layer ``counts``, whole numbers.

    Looked for in order: layer ``raw``, the named layer, the main entries, an
    existing layer ``counts``. ``raw_genes`` is the gene table of layer ``raw``
    when it has more genes.
    """
    layers = atlas.layers
    names = set() if layers is None else {r[0] for r in layers.select("layer").distinct().collect()}

    def entries(name: str) -> DataFrame:
        return layers.filter(F.col("layer") == name).drop("layer")

    genes, chosen = atlas.genes, None
    if "raw" in names and _is_raw(entries("raw"), atlas, raw_genes):
        chosen = entries("raw")
        if raw_genes is not None:
            more = len(raw_genes.columns) > len(genes.columns) or raw_genes.count() > genes.count()
            genes = raw_genes if more else genes
    elif layer is not None and layer in names:
        chosen = entries(layer)
    elif _is_raw(atlas.counts, atlas):
        chosen = atlas.counts
    elif "counts" in names and _is_raw(entries("counts"), atlas):
        chosen = entries("counts")
    if chosen is None:
        if raise_on_missing:
            raise ValueError("no raw counts in layer 'raw', the named layer, the main entries or layer 'counts'")
        return atlas
    chosen = chosen.withColumn("value", F.col("value").cast("int"))
    as_layer = chosen.select(F.lit("counts").alias("layer"), "cell_id", "gene_id", F.col("value").cast("double").alias("value"))
    others = None if layers is None else layers.filter(F.col("layer") != "counts").select(
        "layer", "cell_id", "gene_id", F.col("value").cast("double").alias("value"))
    return atlas.with_(genes=genes, counts=chosen, layers=as_layer if others is None else others.unionByName(as_layer))


def ensure_raw_counts_by(
    atlas: Atlas, by: Sequence[str], layer: str | None = None, min_val: float = -1e-6, max_noninteger_fraction: float = 0.01
) -> tuple[Atlas, DataFrame]:
    """``ensure_raw_counts`` decided for each group of cells by itself; returns the atlas and the groups without raw counts.

    The order is the same: layer ``raw``, the named layer (taken as it is), the main entries, layer ``counts``. All candidates of
    all groups are judged in one aggregate, and each group's entries come from its own choice. Groups without one have no entries.
    """
    layers = atlas.layers
    names = set() if layers is None else {r[0] for r in layers.select("layer").distinct().collect()}
    order = [n for n in ("raw", layer, None, "counts") if n is None or n in names]
    candidates = [atlas.counts if n is None else layers.filter(F.col("layer") == n) for n in order]
    trusted = [i for i, n in enumerate(order) if n is not None and n == layer and n != "raw"]
    key, at = "__group", "__candidate"
    group = F.struct(*[F.col(b) for b in by]).alias(key)
    groups = atlas.cells.select("cell_id", group)
    # each candidate meets its cells by itself: a union has forgotten how its rows are partitioned
    entries = [c.select("cell_id", "gene_id", F.col("value").cast("double").alias("value")).join(groups, "cell_id").withColumn(at, F.lit(i))
               for i, c in enumerate(candidates)]
    tagged = entries[0]
    for more in entries[1:]:
        tagged = tagged.unionByName(more)
    off = F.abs(F.col("value") - F.rint("value")) > 1e-6
    stats = tagged.groupBy(key, at).agg(F.min("value").alias("low"), F.count_if(off).alias("off"))
    sizes = atlas.cells.groupBy(group).agg(F.count(F.lit(1)).cast("double").alias("n"))
    genes = atlas.genes.agg(F.count(F.lit(1)).cast("double")).scalar()
    # main entries that a group has none of are zeros; a layer that it has nothing of is not there
    grid = sizes.withColumn(at, F.explode(F.array(*[F.lit(i) for i in range(len(order))]))).join(stats, [key, at], "left")
    raw = (F.coalesce(F.least("low", F.lit(0.0)), F.lit(0.0)) >= min_val) & (F.coalesce("off", F.lit(0)) / (F.col("n") * genes) <= max_noninteger_fraction)
    there = F.col("low").isNotNull() | (F.col(at) == order.index(None))
    judged = broadcast_if_small(grid.groupBy(key).agg(F.min(F.when(there & (raw | F.col(at).isin(trusted)), F.col(at))).alias("__chosen")))
    chosen = tagged.join(judged, key).filter(F.col(at) == F.col("__chosen")).select("cell_id", "gene_id", F.col("value").cast("int").alias("value"))
    if len(candidates) > 1:
        # later passes group by cell: settled once more, none of them reads and shuffles all candidates again
        n = partitions_for(chosen.sparkSession, atlas.n_entries or 0)
        by_cell = chosen.repartition("cell_id") if n is None else chosen.repartition(n, "cell_id")
        chosen = settle_by_key(by_cell, "cell_id", rows=atlas.n_entries)
    as_layer = chosen.select(F.lit("counts").alias("layer"), "cell_id", "gene_id", F.col("value").cast("double").alias("value"))
    others = None if layers is None else layers.filter(F.col("layer") != "counts").select(
        "layer", "cell_id", "gene_id", F.col("value").cast("double").alias("value"))
    without = judged.filter("__chosen IS NULL").select(*[F.col(f"{key}.{b}").alias(b) for b in by])
    return atlas.with_(counts=chosen, layers=as_layer if others is None else others.unionByName(as_layer)), without
