"""Reading and writing the three tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasloom.model import Atlas, require_columns
from atlasloom.sizing import broadcast_if_small, partitions_for, settle


def entries(raw: DataFrame, unique: bool = False, rows: int | None = None) -> DataFrame:
    """Matrix entries with one row per (cell, gene), partitioned by cell.

    The one shuffle of the big table. Repeats are summed inside it, and every
    later step that groups by cell (metrics, scaling, ranks) reuses it. ``rows``
    is about their number: where a task's share of them would be too large, there are more partitions.
    """
    n = None if rows is None else partitions_for(raw.sparkSession, rows)
    by_cell = raw.repartition("cell_id") if n is None else raw.repartition(n, "cell_id")
    if unique:
        return by_cell
    return by_cell.groupBy("cell_id", "gene_id").agg(F.sum("value").alias("value"))


def read_atlas(spark: SparkSession, path: str, unique: bool = False) -> Atlas:
    """Load ``cells``, ``genes``, ``counts`` (and ``layers``, ``embeddings`` if given) below ``path``."""
    def maybe(name: str) -> DataFrame | None:
        try:
            return spark.read.parquet(f"{path}/{name}")
        except Exception as e:  # only an absent table is optional
            if "PATH_NOT_FOUND" in str(e):
                return None
            raise

    cells, genes, counts = (spark.read.parquet(f"{path}/{n}") for n in ("cells", "genes", "counts"))
    check_structure(cells, genes, counts)
    rows = counts.count()
    return Atlas(cells, genes, entries(counts, unique, rows), maybe("layers"), maybe("embeddings"), n_entries=rows)


def check_structure(cells: DataFrame, genes: DataFrame, counts: DataFrame) -> None:
    require_columns(cells, ["cell_id", "ord"], "cells")
    require_columns(genes, ["gene_id", "pos"], "genes")
    require_columns(counts, ["cell_id", "gene_id", "value"], "counts")
    for df, what in ((cells, "cells"), (genes, "genes")):
        if df.isEmpty():
            raise ValueError(f"{what}: no rows")


def write_atlas(atlas: Atlas, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the tables below ``path``; cells are laid out by chunk (and split), entries clustered by cell."""
    atlas.cells.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/cells")
    atlas.genes.write.mode("overwrite").parquet(f"{path}/genes")
    where = [c for c in partition_by if c in atlas.counts.columns]
    counts = atlas.counts
    if where != list(partition_by):
        counts = counts.join(atlas.cells.select("cell_id", *partition_by), "cell_id")
    counts.sortWithinPartitions(*partition_by, "cell_id").write.mode("overwrite").partitionBy(
        *partition_by).parquet(f"{path}/counts")
    if atlas.embeddings is not None:
        write_embeddings(atlas.embeddings, f"{path}/embeddings", replace=True)


def write_chunks(df: DataFrame, path: str) -> None:
    """Processed rows replaced per run, one folder per split and chunk."""
    require_columns(df, ["split", "chunk_id"], "chunks")
    df.write.mode("overwrite").partitionBy("split", "chunk_id").parquet(path)


def write_embeddings(embeddings: DataFrame, path: str, replace: bool = False) -> None:
    """Add vectors to those below ``path``; of a cell and key that are there already the new one counts. Nothing else is lost.

    Vectors lie in a folder for each key and ``chunk`` (a column of ``embeddings``; without it all are in chunk ``all``). The folders
    that get new vectors are written apart, together with the vectors of other cells in them, and switched when all of them are
    complete, so a run that breaks off leaves what was there. Other chunks are not read but for a look whether a cell
    has moved, which is refused. With ``replace`` the keys' chunks present in ``embeddings`` are replaced whole.
    """
    require_columns(embeddings, ["cell_id", "key", "vector"], "embeddings")
    chunk = F.col("chunk").cast("string") if "chunk" in embeddings.columns else F.lit("all")
    new = embeddings.select("cell_id", "key", chunk.alias("chunk"), "vector")
    old = None if replace else _embeddings(embeddings.sparkSession, path)
    if old is not None:
        # vectors are computed once, though they are needed for the look and for the result
        new = settle(new)
        ids = new.select("cell_id", "key", F.col("chunk").alias("_chunk"))
        if not old.select("cell_id", "key", "chunk").join(ids, ["cell_id", "key"]).filter("chunk <> _chunk").isEmpty():
            raise ValueError("embeddings: a cell is in another chunk than before")
        touched = broadcast_if_small(new.select("key", "chunk").distinct())
        kept = old.join(touched, ["key", "chunk"], "left_semi").join(ids, ["cell_id", "key"], "left_anti")
        new = kept.select(*new.columns).unionByName(new)
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("key", "chunk").parquet(path)


def _embeddings(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        spark.catalog.refreshByPath(path)
        found = spark.read.parquet(path)
    except Exception as e:  # nothing written yet
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise
    # folder names are read as numbers or dates where all look like them
    return found.withColumn("key", F.col("key").cast("string")).withColumn("chunk", F.col("chunk").cast("string"))


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    """``cell_id, key, chunk, vector`` of all that ``write_embeddings`` left below ``path``."""
    found = _embeddings(spark, path)
    if found is None:
        raise ValueError(f"no embeddings below {path}")
    return found.select("cell_id", "key", "chunk", "vector")


def save_vectors(embeddings: DataFrame, path: str) -> None:
    """One embedding matrix with its ids."""
    embeddings.select("cell_id", "vector").write.mode("overwrite").parquet(path)


def convert_tables(spark: SparkSession, sources: dict[str, str], target: str, source_format: str = "parquet") -> None:
    """Convert each named source to the target layout, leaving targets that exist."""
    for name, src in sorted(sources.items()):
        spark.read.format(source_format).load(src).write.mode("ignore").parquet(f"{target}/{name}")
