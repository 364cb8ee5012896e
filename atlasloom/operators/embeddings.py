"""Vectors per cell: fixed panels, variable genes, principal components, user methods."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from atlasloom.model import Atlas, require_columns
from atlasloom.operators.lookups import on_panel
from atlasloom.operators.normalise import log_normalise
from atlasloom.operators.predicates import scaled_check
from atlasloom.operators.variable_genes import exact_top_genes, variable_genes
from atlasloom.sizing import broadcast_if_small, settle


def panel_from(genes: DataFrame, order: str = "pos") -> DataFrame:
    """``gene_id, slot`` from 0 in the given order (gene-sized)."""
    return genes.select("gene_id", (F.row_number().over(W.orderBy(order)) - 1).alias("slot"))


def panel_vectors(counts: DataFrame, cells: DataFrame, panel: DataFrame, key: str) -> DataFrame:
    """Values of the panel genes as one float vector per cell, absent genes and empty cells as zeros.

    One aggregation by cell. A cell's entries, ordered by slot, are laid out with
    the zeros between them, so the work is the panel's length plus the entries.
    """
    dim = panel.count()
    zero = F.lit(0.0).cast("float")
    per_cell = on_panel(counts, panel).groupBy("cell_id").agg(F.sort_array(F.collect_list(
        F.struct("slot", F.col("value").cast("float").alias("v")))).alias("_e"))
    e = F.col("_e")

    def with_gap(x: Column, i: Column) -> Column:
        following = F.coalesce(F.get(e, i + 1)["slot"], F.lit(dim))
        return F.concat(F.array(x["v"]), F.array_repeat(zero, (following - x["slot"] - 1).cast("int")))

    filled = F.concat(F.array_repeat(zero, F.get(e, F.lit(0))["slot"].cast("int")), F.flatten(F.transform(e, with_gap)))
    return cells.select("cell_id").join(per_cell, "cell_id", "left").select(
        "cell_id", F.lit(key).alias("key"), F.when(e.isNull(), F.array_repeat(zero, dim)).otherwise(filled).alias("vector"))


def hvg_vectors(atlas: Atlas, n: int, batch: str | None = None, key: str = "X_hvg") -> DataFrame:
    """Values of exactly ``n`` highly variable genes; existing marks are used when there are enough."""
    marked = "highly_variable" in atlas.genes.columns and atlas.genes.filter("highly_variable").count() >= n
    if marked:
        scored, counts = atlas.genes.filter("highly_variable"), atlas.counts
        if scored.count() > n:
            require_columns(scored, ["dispersions_norm"], "genes")
            scored = exact_top_genes(scored, n)
    else:
        counts = log_normalise(atlas.counts, atlas.cells, mode="auto", var_threshold=1.0)
        all_scored = variable_genes(counts, atlas.cells, atlas.genes, n, batch).filter("highly_variable")
        scored = exact_top_genes(all_scored, n)
        if scored.count() < n:
            raise ValueError(f"fewer than {n} highly variable genes")
    return panel_vectors(counts, atlas.cells, panel_from(scored), key)


def apply_components(counts: DataFrame, cells: DataFrame, loadings: DataFrame, key: str = "X_pca") -> DataFrame:
    """Project onto principal components without densifying.

    ``loadings(gene_id, mean, scale, center, components ARRAY)``: scaling, centring
    and projection are affine, so a cell is a constant vector (all-zero cell) plus
    a sum over its non-zero entries.
    """
    small = broadcast_if_small(loadings.select(
        "gene_id", "mean", F.when(F.col("scale") == 0, 1.0).otherwise(F.col("scale")).alias("scale"), "center", "components"))
    k = int(small.agg(F.max(F.size("components"))).first()[0])
    # the all-zero cell: sum over genes of ((0 - mean)/scale - center) * w
    at_zero = small.agg(*[F.expr(f"sum((-mean / scale - center) * components[{j}]) AS c{j}") for j in range(k)])
    constant = at_zero.select(F.expr(f"array({', '.join(f'c{j}' for j in range(k))}) AS c")).scalar()
    part = counts.join(small, "gene_id").groupBy("cell_id").agg(*[
        F.expr(f"sum(value / scale * components[{j}]) AS s{j}") for j in range(k)])
    out = cells.select("cell_id").join(part, "cell_id", "left").withColumn("_c", constant)
    vector = ", ".join(f"CAST(coalesce(s{j}, 0.0D) + _c[{j}] AS FLOAT)" for j in range(k))
    return out.select("cell_id", F.lit(key).alias("key"), F.expr(f"array({vector})").alias("vector"))


def _sums_of_arrays(values: Column, factor: Column, k: int) -> Column:
    return F.array(*[F.sum(factor * F.get(values, F.lit(j))) for j in range(k)])


def _gram(df: DataFrame, left: str, right: str, k: int) -> np.ndarray:
    """The k x k matrix of sums of products of two array columns: one small matrix per task, added up by Spark."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        total = np.zeros((k, k))
        for f in frames:
            if len(f):
                total += np.stack(f[left]).T @ np.stack(f[right])
        yield pd.DataFrame({"place": np.arange(k * k), "value": total.ravel()})

    names = [F.col(c) for c in dict.fromkeys([left, right])]
    sums = df.select(*names).mapInPandas(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    out = np.zeros(k * k)
    for r in sums.collect():
        out[r["place"]] = r["value"]
    return out.reshape(k, k)


def _times(df: DataFrame, column: str, matrix: np.ndarray) -> DataFrame:
    """``df`` with its array column multiplied from the right by a small matrix."""
    terms = [" + ".join(f"{column}[{i}] * {float(v)!r}D" for i, v in enumerate(row)) for row in matrix.T]
    return df.withColumn(column, F.expr(f"array({', '.join(terms)})"))


def _whiten(gram: np.ndarray) -> np.ndarray:
    """A matrix that makes the columns behind ``gram`` orthonormal; directions of no length are left out."""
    values, vectors = np.linalg.eigh(gram)
    held = values > max(values.max(), 0.0) * 1e-14
    return vectors[:, held] / np.sqrt(values[held])


def fit_components(
    counts: DataFrame, cells: DataFrame, genes: DataFrame, n_components: int, scale: bool | None = None, seed: int = 42,
    tolerance: float = 1e-9, max_rounds: int = 60,
) -> tuple[DataFrame, DataFrame]:
    """Loadings for ``apply_components`` and one row of metadata, fitted on all cells and genes.

    Randomised subspace iteration on the non-zero entries: a genes x k table is carried to the cells and back, scaling and
    centring being added in closed form. Only k x k matrices and sums of length k reach the driver. Rounds end when the
    variances of the wanted components no longer change by more than ``tolerance`` of the largest. Each component's sign makes its
    largest loading positive. ``scale=None`` scales unless the values look scaled already.
    """
    panel = genes.select("gene_id").distinct()
    chosen = cells.select("cell_id").distinct()
    entries = settle(counts.select("cell_id", "gene_id", F.col("value").cast("double").alias("value")).join(
        panel, "gene_id", "left_semi").join(chosen, "cell_id", "left_semi"))
    dim, n = panel.count(), chosen.count()
    if scale is None:
        scale = not scaled_check(counts, cells, genes).first()["is_scaled"]
    k = max(1, min(n_components, min(n, dim) - 1))
    width = max(2 * k, k + 20)
    width = dim if dim <= 2 * width else width  # a panel hardly wider than the subspace is taken whole, in one round
    sums = entries.groupBy("gene_id").agg(F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("q"))
    mean = F.coalesce(F.col("s"), F.lit(0.0)) / n
    var = F.greatest(F.coalesce(F.col("q"), F.lit(0.0)) / n - mean * mean, F.lit(0.0))
    start = F.array(*[F.pmod(F.xxhash64(F.lit(seed), F.lit(j), F.col("gene_id").cast("string")), F.lit(2_000_003)) / 1_000_001.5 - 1
                      for j in range(width)])
    stats = panel.join(sums, "gene_id", "left").select("gene_id", mean.alias("m"), F.sqrt(var).alias("sd"), start.alias("w"))
    factor = F.when(F.col("sd") > 0, 1 / F.col("sd")).otherwise(1.0) if scale else F.lit(1.0)
    table = settle(stats.withColumn("f", factor))
    table = _times(table, "w", _whiten(_gram(table, "w", "w", width)))
    spread = float(table.agg(F.sum((F.col("sd") * F.col("f")) ** 2)).first()[0] or 0.0) * n / max(1, n - 1)
    before, values, turn = None, np.zeros(k), np.eye(width)
    for _ in range(max_rounds):
        table = settle(table)
        width = int(table.agg(F.max(F.size("w"))).first()[0])
        # a cell without entries stands at -sum(mean * factor * w); the others add their entries to it
        base = np.array(table.agg(_sums_of_arrays(F.col("w"), -F.col("m") * F.col("f"), width).alias("c")).first()[0])
        base_column = F.array(*[F.lit(float(x)) for x in base])
        joined = entries.join(broadcast_if_small(table.select("gene_id", "f", "w")), "gene_id")
        places = settle(joined.groupBy("cell_id").agg(_sums_of_arrays(F.col("w"), F.col("value") * F.col("f"), width).alias("p")).withColumn(
            "p", F.transform("p", lambda x, i: x + F.get(base_column, i))))
        held = places.agg(F.count(F.lit(1)).alias("n"), _sums_of_arrays(F.col("p"), F.lit(1.0), width).alias("t")).first()
        total = F.array(*[F.lit(float((t or 0.0) + (n - held["n"]) * b)) for t, b in zip(held["t"], base, strict=True)])
        back = entries.join(places, "cell_id").groupBy("gene_id").agg(_sums_of_arrays(F.col("p"), F.col("value"), width).alias("b"))
        zero = F.array(*[F.lit(0.0)] * width)
        moved = settle(table.join(back, "gene_id", "left").withColumn("b", F.zip_with(
            F.coalesce("b", zero), total, lambda x, t: F.col("f") * (x - F.col("m") * t))))
        found, turn = np.linalg.eigh(_gram(moved, "w", "b", width))
        values, turn = found[::-1][:k] / max(1, n - 1), turn[:, ::-1][:, :k]
        done = before is not None and np.abs(values - before).max() <= tolerance * max(values.max(), 1e-300)
        if width >= dim or done:
            break
        before = values
        table = _times(moved.select("gene_id", "m", "sd", "f", F.col("b").alias("w")), "w", _whiten(_gram(moved, "b", "b", width)))
    fitted = _times(table, "w", turn)
    largest = fitted.agg(*[F.max_by(F.get("w", F.lit(j)), F.struct(F.abs(F.get("w", F.lit(j))), "gene_id")).alias(f"c{j}") for j in range(len(values))]).first()
    fitted = _times(fitted, "w", np.diag([-1.0 if (x or 0.0) < 0 else 1.0 for x in largest]))
    zeros = F.lit(0.0)
    loadings = fitted.select(
        "gene_id", (F.col("m") if scale else zeros).alias("mean"), (F.col("sd") if scale else F.lit(1.0)).alias("scale"),
        (zeros if scale else F.col("m")).alias("center"), F.col("w").alias("components"))
    meta = {"n_components": len(values), "n_genes": dim, "n_cells": n, "scaled": bool(scale),
            "explained_variance_ratio": [float(v / spread) if spread else 0.0 for v in values]}
    return settle(loadings), counts.sparkSession.createDataFrame([(json.dumps(meta),)], "metadata string")


def save_components(loadings: DataFrame, metadata: DataFrame, path: str) -> None:
    loadings.write.mode("overwrite").parquet(f"{path}/loadings")
    metadata.write.mode("overwrite").text(f"{path}/metadata")


def load_components(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/loadings"), spark.read.text(f"{path}/metadata").withColumnRenamed("value", "metadata")


Method = Callable[..., DataFrame]
_METHODS: dict[str, Method] = {}


def register_method(name: str, method: Method) -> None:
    """Make ``method(atlas, key=..., **kw) -> embeddings`` available by name."""
    _METHODS[name] = method


def register_vector_function(name: str, fn: Callable[[Iterator[pd.DataFrame]], Iterable[pd.DataFrame]], columns: Sequence[str]) -> None:
    """A user model as a batch function over cell columns, giving ``cell_id`` and ``vector``; runs in Arrow batches."""
    def method(atlas: Atlas, key: str, **_kw) -> DataFrame:
        ids = dict(atlas.cells.dtypes)["cell_id"]
        out = atlas.cells.select("cell_id", *columns).mapInPandas(fn, f"cell_id {ids}, vector array<float>")
        return out.select("cell_id", F.lit(key).alias("key"), "vector")

    register_method(name, method)


def embed(atlas: Atlas, method: str, key: str | None = None, **kw) -> DataFrame:
    """``cell_id, key, vector`` by a registered method; the key defaults to ``X_<method>``."""
    if method not in _METHODS:
        raise ValueError(f"unknown embedding method '{method}'; known: {sorted(_METHODS)}")
    out = _METHODS[method](atlas, key=key or f"X_{method}", **kw)
    return out.select("cell_id", "key", F.col("vector").cast("array<float>").alias("vector"))


def embed_missing(atlas: Atlas, methods: dict[str, dict], overwrite: bool = False) -> DataFrame | None:
    """Vectors of each method for the cells that do not have its key yet; None when nothing is missing.

    A method is fitted on all cells as always; what is there already is not returned again.
    """
    out = None
    for name, kw in methods.items():
        missing = atlas.cells.select("cell_id")
        if atlas.embeddings is not None and not overwrite:
            missing = settle(missing.join(atlas.embeddings.filter(F.col("key") == f"X_{name}"), "cell_id", "left_anti"))
        if missing.isEmpty():
            continue
        part = embed(atlas, name, **kw).join(missing, "cell_id", "left_semi")
        out = part if out is None else out.unionByName(part)
    return out


def embedding_keys(embeddings: DataFrame) -> DataFrame:
    return embeddings.select("key").distinct()


register_method("hvg", lambda atlas, key, n=512, batch=None: hvg_vectors(atlas, n, batch, key))
register_method("gs", lambda atlas, key, panel: panel_vectors(atlas.counts, atlas.cells, panel, key))
register_method("gs10k", lambda atlas, key, panel: panel_vectors(atlas.counts, atlas.cells, panel, key))
register_method("pca", lambda atlas, key, loadings: apply_components(atlas.counts, atlas.cells, loadings, key))

