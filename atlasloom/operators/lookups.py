"""Joins with lookup tables, and alignment by id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlasloom.functions.ids import is_gene_accession, strip_version
from atlasloom.model import as_list, require_columns
from atlasloom.operators.filters import accession_genes
from atlasloom.operators.predicates import EXPERIMENT_ACCESSION, SAMPLE_ACCESSION, accession_check
from atlasloom.operators.ranking import first_per_key, one_per_id
from atlasloom.sizing import broadcast_if_small


def enrich(
    cells: DataFrame, lookup: DataFrame, key: str, new_columns: str | Sequence[str], fallback: str = "unknown",
    order: Sequence[str | Column] = (), lookup_key: str | None = None,
) -> DataFrame:
    """Columns of the first lookup row per id; missing ids and missing columns give the fallback.

    Only the wanted ids of the lookup are kept before its first row per id is
    taken. The lookup is broadcast when it measures small; otherwise the join is
    by sort-merge and AQE splits a hot key.
    """
    new = as_list(new_columns)
    lookup_key = lookup_key or key
    have = [c for c in new if c in lookup.columns]
    ids = cells.select(F.col(key).alias("_id")).distinct()
    wanted = lookup.withColumnRenamed(lookup_key, "_id").join(ids, "_id", "left_semi")
    row = first_per_key(wanted, "_id", *(order or [F.col(c) for c in have]))
    row = broadcast_if_small(row.select("_id", *have))
    out = cells.drop(*[c for c in have if c in cells.columns])
    out = out.join(row, out[key] == row["_id"], "left").drop("_id")
    return out.withColumns({
        c: F.coalesce(F.col(c).cast("string"), F.lit(fallback)) if c in have else F.lit(fallback) for c in new})


def enrich_accessions(
    cells: DataFrame, lookup: DataFrame | None, new_columns: str | Sequence[str], sample_key: str = "accession",
    experiment_key: str = "experiment_accession", skip: bool = False, continue_on_fail: bool = False,
) -> DataFrame:
    """Enrichment guarded by the accession check.

    Cells whose ids do not pass come back unchanged. A missing or unfit lookup
    raises, or with ``continue_on_fail`` fills ``unknown_sra_unavailable``.
    """
    if skip:
        return cells
    kept, ok = accession_check(cells, {experiment_key: EXPERIMENT_ACCESSION, sample_key: SAMPLE_ACCESSION})
    if not ok:
        return cells
    try:
        if lookup is None:
            raise ValueError("no lookup table")
        require_columns(lookup, [experiment_key], "lookup")
        return enrich(kept, lookup, experiment_key, new_columns)
    except ValueError:
        if not continue_on_fail:
            raise
        return kept.withColumns({c: F.lit("unknown_sra_unavailable") for c in as_list(new_columns)})


def id_differences(wanted: DataFrame, found: DataFrame, key: str, found_key: str | None = None) -> DataFrame:
    """Ids wanted but not found, and found but not wanted."""
    w = wanted.select(F.col(key).alias("id")).distinct()
    f = found.select(F.col(found_key or key).alias("id")).distinct()
    return w.join(f, "id", "left_anti").withColumn("side", F.lit("missing")).unionByName(
        f.join(w, "id", "left_anti").withColumn("side", F.lit("extra")))


def map_symbols(
    genes: DataFrame, lookup: DataFrame, symbol: str, out: str = "ensembl_id", lookup_symbol: str = "gene_name",
    lookup_id: str = "ensembl_gene_id", order: str | None = None,
) -> DataFrame:
    """Gene id per symbol: accessions are taken as they are without version, else the first match, else ''."""
    pairs = lookup.select(F.col(lookup_symbol).alias("_sym"), F.col(lookup_id).alias("_gid"),
                          F.col(order or lookup_id).alias("_ord"))
    first = broadcast_if_small(first_per_key(pairs, "_sym", "_ord").select("_sym", "_gid"))
    text = F.col(symbol).cast("string")
    return genes.join(first, genes[symbol].cast("string") == first["_sym"], "left").withColumn(
        out, F.when(is_gene_accession(text), strip_version(text)).otherwise(F.coalesce(F.col("_gid").cast("string"), F.lit("")))
    ).drop("_sym", "_gid")


def ensure_accession_ids(
    genes: DataFrame, column: str = "ensembl_id", lookup: DataFrame | None = None, seed: int = 42, id_col: str = "gene_id",
    **lookup_columns: str,
) -> DataFrame:
    """Gene rows whose id is a clean accession, the former id as ``previous_index``.

    Source of the ids: the id itself if it has any accessions and at least as
    many as the column, else the column, else the lookup. Then versions are
    stripped, other ids dropped, and one gene kept per repeated id.
    """
    text = F.col(id_col).cast("string")
    n = genes.agg(
        F.count_if(is_gene_accession(text)).alias("own"),
        (F.count_if(is_gene_accession(F.col(column).cast("string"))) if column in genes.columns else F.lit(0)).alias("col"),
    ).first()
    if n["own"] > 0 and n["own"] >= n["col"]:
        source = genes.withColumn("_new", text)
    elif n["col"] > 0:
        source = genes.withColumn("_new", F.col(column).cast("string"))
    elif lookup is not None:
        source = map_symbols(genes, lookup, id_col, "_new", **lookup_columns)
    else:
        raise ValueError(f"neither '{id_col}' nor '{column}' holds accessions and no lookup is given")
    clean = accession_genes(source.withColumn("_new", strip_version("_new")), "_new")
    clean = one_per_id(clean, "_new", id_col, seed)
    return clean.withColumn("previous_index", F.col(id_col)).withColumn(id_col, F.col("_new")).drop("_new")


def map_with_default(df: DataFrame, lookup: DataFrame, key: str, value: str, default: str, out: str | None = None) -> DataFrame:
    """Value per key from a lookup with unique keys, nulls and misses replaced (dataset id to DOI, say)."""
    l = broadcast_if_small(lookup.select(F.col(key).alias("_k"), F.col(value).alias("_v")))
    return df.join(l, df[key] == l["_k"], "left").withColumn(
        out or value, F.coalesce(F.col("_v").cast("string"), F.lit(default))).drop("_k", "_v")


def file_references(files: DataFrame, links: DataFrame, split: str = "split", name: str = "name", path: str = "path") -> DataFrame:
    """Link per file: the first of four key forms that has one, else the file's own path."""
    forms = F.array(F.concat(F.col(name), F.lit(".zip")), F.col(name),
                    F.concat_ws("/", F.col(split), F.concat(F.col(name), F.lit(".zip"))), F.concat_ws("/", F.col(split), F.col(name)))
    tries = files.select(path, F.posexplode(forms).alias("_try", "_key"))
    found = tries.join(links.select(F.col("key").alias("_key"), "link"), "_key").groupBy(path).agg(
        F.min_by("link", "_try").alias("_link"))
    return files.join(found, path, "left").withColumn("adata_link", F.coalesce("_link", F.col(path))).drop("_link")


def align_vectors(cells: DataFrame, vectors: DataFrame, dim: int, key: str = "cell_id") -> DataFrame:
    """One vector per cell; a repeated or missing id gives zeros."""
    zeros = F.array_repeat(F.lit(0.0).cast("float"), dim)
    once = vectors.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.any_value("vector").alias("_v"))
    return cells.select(key).join(once, key, "left").select(
        key, F.when(F.col("_n") == 1, F.col("_v")).otherwise(zeros).alias("vector"))


def merge_embeddings(sources: Sequence[DataFrame]) -> DataFrame:
    """Embeddings of several sources onto the first; ids must agree, the first source wins a key."""
    base = sources[0].select("cell_id").distinct()
    for i, s in enumerate(sources[1:], 1):
        ids = s.select("cell_id").distinct()
        if not ids.join(base, "cell_id", "left_anti").unionAll(base.join(ids, "cell_id", "left_anti")).isEmpty():
            raise ValueError(f"cell ids of source {i} differ from the first")
    ranked = None
    for i, s in enumerate(sources):
        part = s.select("cell_id", "key", "vector").withColumn("_src", F.lit(i))
        ranked = part if ranked is None else ranked.unionByName(part)
    # a key belongs to the first source that has it; the key table is tiny
    owner = broadcast_if_small(ranked.groupBy("key").agg(F.min("_src").alias("_src")))
    return ranked.join(owner, ["key", "_src"], "left_semi").drop("_src")


def merge_gene_columns(base: DataFrame, other: DataFrame, key: str = "gene_id") -> DataFrame:
    """New gene columns of ``other``, if both tables hold the same genes in the same places."""
    new = [c for c in other.columns if c not in base.columns]
    paired = base.select(key, "pos").join(other.select(key, F.col("pos").alias("_pos")), key, "full")
    same = paired.filter(~F.col("pos").eqNullSafe(F.col("_pos"))).isEmpty() and base.count() == other.count()
    if not new or not same:
        return base
    return base.join(other.select(key, *new), key, "left")


def group_files(files: DataFrame, path: str = "path") -> DataFrame:
    """Prefix and split of files named ``<prefix>_<train|val>...``; others are left out."""
    name = F.element_at(F.split(F.col(path), "/"), -1)
    pattern = r"^(.*)_(train|val).*\.[A-Za-z0-9]+$"
    rows = files.select(path, name.alias("_name")).filter(F.col("_name").rlike(pattern))
    return rows.groupBy(
        F.regexp_extract("_name", pattern, 1).alias("prefix"), F.regexp_extract("_name", pattern, 2).alias("split")
    ).agg(F.count(F.lit(1)).alias("n_files"), F.min(path).alias("first_path"))


def on_panel(counts: DataFrame, panel: DataFrame, require: bool = True) -> DataFrame:
    """Entries of panel genes with their panel position ``slot``; absent genes stay implicit zeros."""
    small = broadcast_if_small(panel.select("gene_id", "slot"))
    out = counts.join(small, "gene_id")
    if require and out.isEmpty():
        raise ValueError("none of the panel genes is present")
    return out


def panel_genes(genes: DataFrame, panel: DataFrame, column: str = "gene_id") -> DataFrame:
    """Gene rows on the panel, with the panel order, nothing added."""
    small = broadcast_if_small(panel.select(F.col("gene_id").alias("_g"), "slot"))
    return genes.join(small, genes[column] == small["_g"]).drop("_g")


def missing_keys(present: DataFrame, units: DataFrame, keys: Sequence[str], unit: str = "chunk_id") -> DataFrame:
    """(unit, key) pairs required but not present; the required pairs come from exploding the key list."""
    need = units.select(unit).distinct().withColumn("key", F.explode(F.array(*[F.lit(k) for k in keys])))
    return need.join(present.select(unit, "key").distinct(), [unit, "key"], "left_anti")


def require_keys(present: DataFrame, units: DataFrame, keys: Sequence[str], unit: str = "chunk_id") -> None:
    gap = missing_keys(present, units, keys, unit).first()
    if gap is not None:
        raise ValueError(f"embedding key '{gap['key']}' missing for {unit} {gap[unit]}")
