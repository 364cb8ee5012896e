"""Column, layer and attribute edits; projections only, unless a row says otherwise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlasloom.model import as_list, require_columns
from atlasloom.operators.ranking import row_index, suffix_repeats
from atlasloom.sizing import broadcast_if_small


def drop_layers(layers: DataFrame, names: Sequence[str]) -> DataFrame:
    """Without the named layers; names not present do nothing. Prunes partitions when stored by layer."""
    return layers.filter(~F.col("layer").isin(*names)) if names else layers


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Without columns that hold no value at all; one pass."""
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(str(i)) for i, c in enumerate(df.columns)]).first()
    return df.select(*[F.col(f"`{c}`") for i, c in enumerate(df.columns) if row[i] > 0])


def drop_slash_columns(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in df.columns if "/" not in c])


def drop_slash_layers(layers: DataFrame) -> DataFrame:
    return layers.filter(~F.col("layer").contains("/"))


def remove_attributes(
    layers: DataFrame, uns: DataFrame, names: Sequence[str], column: str = "uns"
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Remove ``raw`` or entries ``uns/a/b`` (an entry takes its sub-entries along).

    ``uns`` maps paths to values. Names of any other kind are refused and returned.
    """
    refused = [n for n in names if n != "raw" and not n.startswith("uns/")]
    if "raw" in names:
        layers = layers.filter(F.col("layer") != "raw")
    paths = [n[len("uns/"):] for n in names if n.startswith("uns/")]
    if paths:
        def keep(k: Column, _v: Column) -> Column:
            gone = F.lit(False)
            for p in paths:
                gone = gone | (k == p) | k.startswith(p + "/")
            return ~gone

        uns = uns.withColumn(column, F.map_filter(column, keep))
    return layers, uns, refused


def clean_layers_and_keys(
    layers: DataFrame, embeddings: DataFrame, layer_names: Sequence[str] = (), keys: Sequence[str] = (), dry_run: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Remove layers and embedding keys; the third table says which of them existed."""
    report = layers.select(F.lit("layer").alias("kind"), F.col("layer").alias("name")).distinct().filter(
        F.col("name").isin(*layer_names)
    ).unionByName(embeddings.select(F.lit("key").alias("kind"), F.col("key").alias("name")).distinct().filter(
        F.col("name").isin(*keys)))
    if dry_run:
        return layers, embeddings, report
    return drop_layers(layers, layer_names), embeddings.filter(~F.col("key").isin(*keys)) if keys else embeddings, report


def copy_columns(df: DataFrame, old: Sequence[str], new: Sequence[str]) -> DataFrame:
    """Copies under new names; the old columns stay, absent ones are passed over."""
    if len(old) != len(new):
        raise ValueError("as many new names as old ones are needed")
    return df.withColumns({n: F.col(o) for o, n in zip(old, new) if o in df.columns})


def gene_id_from_column(genes: DataFrame, column: str) -> DataFrame:
    """The column becomes the gene id: nulls dropped, repeats suffixed, the old id kept as ``previous_index``."""
    require_columns(genes, [column], "genes")
    rows = suffix_repeats(genes.filter(F.col(column).isNotNull()), column, "pos", "_new")
    if "previous_index" not in genes.columns:
        rows = rows.withColumn("previous_index", F.col("gene_id"))
    return rows.withColumn("_old", F.col("gene_id")).withColumn("gene_id", F.col("_new")).drop("_new", column)


def relabel_genes(entries: DataFrame, relabelled: DataFrame) -> DataFrame:
    """Entries under the new gene ids; entries of dropped genes go."""
    ids = broadcast_if_small(relabelled.select(F.col("_old").alias("gene_id"), F.col("gene_id").alias("_new")))
    return entries.join(ids, "gene_id").withColumn("gene_id", F.col("_new")).drop("_new")


def unique_cell_ids(cells: DataFrame, column: str = "cell_id", order: str = "ord") -> DataFrame:
    return suffix_repeats(cells, column, order)


def keep_original_id(cells: DataFrame, column: str = "cell_id") -> DataFrame:
    return cells.withColumn("sample_id_og", F.col(column))


def add_sample_index(cells: DataFrame, by: str | Sequence[str] | None = None, order: str = "ord") -> DataFrame:
    return cells if "sample_index" in cells.columns else row_index(cells, order, "sample_index", by)


def add_column(cells: DataFrame, values: DataFrame, name: str, key: str = "cell_id") -> DataFrame:
    """One column from a keyed table: skipped if present; every cell needs exactly one value."""
    if name in cells.columns:
        return cells
    n, m, d = (
        cells.count(),
        *values.agg(F.count(F.lit(1)), F.count_distinct(key)).first(),
    )
    if not n == m == d:
        raise ValueError(f"column '{name}' has {m} values ({d} distinct ids) for {n} cells")
    return cells.join(values.select(key, name), key, "left")


def prepend_instrument(cells: DataFrame, instrument: str, description: str) -> DataFrame:
    require_columns(cells, [instrument, description], "cells")
    return cells.withColumn(description, F.concat(
        F.lit("This measurement was conducted with "), F.coalesce(F.col(instrument).cast("string"), F.lit("nan")),
        F.lit(". "), F.coalesce(F.col(description).cast("string"), F.lit("nan"))))


def fill_text_nulls(df: DataFrame, fallback: str = "unknown") -> DataFrame:
    """Nulls of non-numeric columns become the fallback."""
    text = [n for n, t in df.dtypes if t == "string"]
    return df.na.fill(fallback, text) if text else df


def add_log_column(cells: DataFrame, column: str) -> DataFrame:
    return cells.withColumn(f"{column}_log", F.log1p(F.col(column).cast("double")))


def consolidate_categories(
    cells: DataFrame, columns: str | Sequence[str], threshold: int, remove: bool = False,
    by: str | Sequence[str] | None = None,
) -> DataFrame:
    """Rare categories removed, or renamed ``remaining <column>``; columns one after another.

    A removal changes the later counts, so the columns stay a chain. Each link
    is a map-side combined count and a join with the small table of rare values.
    """
    by = as_list(by)
    for c in as_list(columns):
        if c not in cells.columns:
            continue
        rare = cells.filter(F.col(c).isNotNull()).groupBy(*by, c).agg(F.count(F.lit(1)).alias("_n")).filter(
            F.col("_n") < threshold)
        rare = broadcast_if_small(rare.select(*[F.col(b).alias(f"_k_{b}") for b in by], F.col(c).alias("_rare")))
        cond = cells[c] == rare["_rare"]
        for b in by:
            cond = cond & cells[b].eqNullSafe(rare[f"_k_{b}"])
        if remove:
            cells = cells.join(rare, cond, "left_anti")
        else:
            cells = cells.join(rare, cond, "left").withColumn(
                c, F.when(F.col("_rare").isNotNull(), F.lit(f"remaining {c}")).otherwise(F.col(c).cast("string"))
            ).drop("_rare", *[f"_k_{b}" for b in by])
    return cells


def set_uns(uns: DataFrame, values: Mapping[str, str], column: str = "uns") -> DataFrame:
    new = F.create_map(*[F.lit(x) for kv in values.items() for x in kv])
    return uns.withColumn(column, F.map_concat(F.map_filter(column, lambda k, _v: ~k.isin(*values)), new))
