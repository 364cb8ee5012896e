"""Embeddings, mixtures and whole plans."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from atlasloom.model import Atlas
from atlasloom.operators import group_mixtures, lookups, mixtures, records, sentences, setops
from atlasloom.operators import embeddings as emb
from atlasloom.operators.normalise import log_normalise
from atlasloom.plans import components, preprocess, stable_genes
from atlasloom.sizing import settle_by_key
from atlasloom.sources import star_schema as star
from atlasloom.sources.matrix import read_embeddings, write_embeddings
from query_catalogue.records_and_subsets import HV, NEG, RANKED
from query_catalogue.registry import (
    CELLS, CELLS_INSTR, COUNTS, DENSE_CELLS, DENSE_COUNTS, DENSE_GENES, GENES, NORM, families, hvg_ctes, mixture_ctes, outlier_ctes,
    qc_ctes, query, rounded, scratch, with_ctes,
)
from query_catalogue.sources_and_lookups import by_status


def dense_atlas(spark, d) -> Atlas:
    return Atlas(star.dense_cells(spark, d), star.dense_genes(spark, d), star.dense_counts(spark, d))


def exploded(vectors, places=3):
    out = vectors.select("cell_id", F.posexplode("vector").alias("dim", "value"))
    return rounded(out.filter(F.abs("value") > F.lit(1e-9).cast("float")), places)


# --- embeddings -------------------------------------------------------------------

@query("E1_variable_gene_vectors", with_ctes("""SELECT cell_id, slot AS dim, round(CAST(CAST(value AS FLOAT) AS DOUBLE), 3) AS value FROM norm JOIN (
    SELECT gene_id, CAST(row_number() OVER (ORDER BY pos) - 1 AS INTEGER) AS slot FROM (SELECT gene_id, pos FROM scored JOIN genes USING (gene_id)
      WHERE highly_variable ORDER BY dispersions_norm DESC NULLS LAST, pos LIMIT 150)) USING (gene_id)""",
    CELLS, GENES, COUNTS, NORM, hvg_ctes(150)))
def hvg_vectors(spark, d):
    a = star_atlas(spark, d)
    return exploded(emb.embed(a.with_(counts=log_normalise(a.counts)), "hvg", n=150))


@query("E2_panel_vectors", with_ctes("""SELECT cell_id, slot AS dim, CAST(value AS DOUBLE) AS value FROM counts JOIN (
    SELECT gene_id, CAST(row_number() OVER (ORDER BY gene_id) - 1 AS INTEGER) AS slot FROM (SELECT gene_id FROM genes UNION ALL SELECT r_name FROM region)) USING (gene_id)""",
    DENSE_CELLS, DENSE_GENES, DENSE_COUNTS))
def panel_vectors(spark, d):
    """Regions are panel members no cell has; their places stay zero."""
    a = dense_atlas(spark, d)
    panel = a.genes.select("gene_id").unionByName(star.table(spark, d, "region").select(F.col("r_name").alias("gene_id")))
    return exploded(emb.embed(a, "gs", panel=emb.panel_from(panel, "gene_id")))


LOAD = """loadings AS (SELECT gene_id, label AS mean, 1 + pos / 10.0 AS scale, CAST(embedding[1] AS DOUBLE) AS center, CAST(embedding AS DOUBLE[]) AS w FROM genes JOIN embeddings ON vec_id = pos)"""


def loadings(spark, d):
    e = star.embeddings(spark, d)
    g = star.dense_genes(spark, d)
    return g.join(e, g["pos"] == e["cell_id"]).select(
        "gene_id", F.col("label").cast("double").alias("mean"), (1 + F.col("pos") / 10.0).alias("scale"),
        F.col("vector")[0].cast("double").alias("center"), F.col("vector").cast("array<double>").alias("components"))


@query("E3_applied_components", with_ctes("""SELECT cell_id, dim, round(CAST(CAST(sum(((coalesce(value, 0) - mean) / scale - center) * w[dim + 1]) AS FLOAT) AS DOUBLE), 2) AS value
  FROM cells CROSS JOIN loadings LEFT JOIN counts USING (cell_id, gene_id) CROSS JOIN (SELECT CAST(unnest(range(64)) AS INTEGER) AS dim) GROUP BY 1, 2""",
    DENSE_CELLS, DENSE_GENES, DENSE_COUNTS, LOAD))
def applied_components(spark, d):
    out = emb.embed(dense_atlas(spark, d), "pca", loadings=loadings(spark, d))
    return rounded(out.select("cell_id", F.posexplode("vector").alias("dim", "value")), 2)


FIT_STATS = """fit_stats AS (SELECT g.gene_id, coalesce(sum(value), 0) / n AS mean,
  sqrt(greatest(coalesce(sum(value * value), 0) / n - (coalesce(sum(value), 0) / n) * (coalesce(sum(value), 0) / n), 0)) AS sd
  FROM genes g LEFT JOIN norm USING (gene_id) CROSS JOIN (SELECT count(*) AS n FROM cells) GROUP BY g.gene_id, n)"""


def pca_ctes(scaled: bool, n: int) -> list[str]:
    """The first ``n`` components of all cells: each from its covariance matrix squared 30 times, which leaves one direction.

    ``c<i>`` holds a component's variance and its loadings in the order of ``gene_id``, the largest of them positive.
    """
    unit = "(f.sd * g.sd)" if scaled else "1.0"
    ctes = ["""crossed AS (SELECT a.gene_id AS i, b.gene_id AS j, sum(a.value * b.value) AS q FROM norm a JOIN norm b USING (cell_id) GROUP BY 1, 2)""",
            f"""covariance AS (SELECT f.gene_id AS i, g.gene_id AS j, (coalesce(q, 0) / n - f.mean * g.mean) / {unit} AS c
  FROM fit_stats f CROSS JOIN fit_stats g LEFT JOIN crossed x ON x.i = f.gene_id AND x.j = g.gene_id CROSS JOIN (SELECT count(*) AS n FROM cells))""",
            "m1 AS (SELECT list(r ORDER BY i) AS m FROM (SELECT i, list(c ORDER BY j) AS r FROM covariance GROUP BY i))"]
    for i in range(1, n + 1):
        ctes += [f"""p{i} AS (SELECT m, 0 AS t FROM m{i} UNION ALL
  SELECT list_transform(m, lambda r: list_transform(m, lambda s: list_dot_product(r, s) / k)), t + 1
  FROM (SELECT m, t, list_sum(list_transform(m, lambda u: list_dot_product(u, u))) AS k FROM p{i} WHERE t < 30))""",
                 f"u{i} AS (SELECT arg_max(r, list_dot_product(r, r)) AS r FROM (SELECT unnest(m) AS r FROM p{i} WHERE t = 30))",
                 f"""v{i} AS (SELECT list_transform(r, lambda x: x * CASE WHEN list_max(r) >= -list_min(r) THEN 1 ELSE -1 END / sqrt(list_dot_product(r, r))) AS v FROM u{i})""",
                 f"c{i} AS (SELECT list_sum(list_transform(m, lambda r, k: list_dot_product(r, v) * v[k])) AS variance, v FROM m{i} CROSS JOIN v{i})",
                 f"""m{i + 1} AS (SELECT list_transform(m, lambda r, a: list_transform(r, lambda x, b: x - variance * v[a] * v[b])) AS m FROM m{i} CROSS JOIN c{i})"""]
    return ctes


FITTED = with_ctes("""SELECT gene_id, round(mean, 4) AS mean, round(sd, 4) AS scale, CAST(5 AS INTEGER) AS k, round(c1.v[place], 4) AS first, round(c2.v[place], 4) AS second
  FROM (SELECT *, row_number() OVER (ORDER BY gene_id) AS place FROM fit_stats) CROSS JOIN c1 CROSS JOIN c2""",
    DENSE_CELLS, DENSE_GENES, DENSE_COUNTS, NORM, FIT_STATS, *pca_ctes(True, 2), recursive=True)


def fitted(load):
    w = F.col("components")
    return rounded(load.select("gene_id", "mean", "scale", F.size(w).alias("k"), w[0].alias("first"), w[1].alias("second")), 4)


@query("E4_fitted_components", FITTED)
def fitted_components(spark, d):
    a = dense_atlas(spark, d)
    return fitted(emb.fit_components(log_normalise(a.counts), a.cells, a.genes, 5)[0])


@query("E5_components_over_datasets", FITTED)
def components_over_datasets(spark, d):
    a = dense_atlas(spark, d)
    parts = []
    for segment in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"):
        c = a.cells.filter(F.col("batch") == segment)
        parts.append(Atlas(c, a.genes, log_normalise(a.counts.join(c.select("cell_id"), "cell_id", "left_semi"))))
    return fitted(components.fit_over_datasets(parts, 5)[0])


@query("E6_stored_components", with_ctes("SELECT gene_id, round(scale, 6) AS scale, CAST(len(w) AS INTEGER) AS k FROM loadings", DENSE_GENES, LOAD))
def stored_components(spark, d):
    path = scratch(spark)
    emb.save_components(loadings(spark, d), spark.createDataFrame([("{}",)], "metadata string"), path)
    back, _ = emb.load_components(spark, path)
    return rounded(back.select("gene_id", "scale", F.size("components").alias("k")))


@query("E7_inspection_components", with_ctes("""SELECT dim, n_cells, round(sqrt(variance), 3) AS spread FROM (
    SELECT CAST(0 AS INTEGER) AS dim, variance FROM c1 UNION ALL SELECT CAST(1 AS INTEGER), variance FROM c2) CROSS JOIN (SELECT count(*) AS n_cells FROM cells)""",
    DENSE_CELLS, DENSE_GENES, DENSE_COUNTS, NORM, FIT_STATS, *pca_ctes(False, 2), recursive=True))
def inspection(spark, d):
    """How far all cells spread along each component; it is largest along the first components and smaller along any others."""
    a = dense_atlas(spark, d)
    norm = log_normalise(a.counts)
    load, _ = emb.fit_components(norm, a.cells, a.genes, 2, scale=False)
    places = emb.apply_components(norm, a.cells, load).select(F.posexplode("vector").alias("dim", "value"))
    return rounded(places.groupBy("dim").agg(F.count("*").alias("n_cells"), F.stddev_pop(F.col("value").cast("double")).alias("spread")), 3)


def _halves(batches):
    for b in batches:
        yield pd.DataFrame({"cell_id": b["cell_id"], "vector": [[x / 2, y] for x, y in zip(b["price"], b["donor"])]})


@query("K11_user_method", with_ctes("SELECT cell_id, 'X_halves' AS key, round(CAST(CAST(price / 2 AS FLOAT) AS DOUBLE), 1) AS first, CAST(donor AS DOUBLE) AS second FROM cells", CELLS))
def user_method(spark, d):
    emb.register_vector_function("halves", _halves, ["price", "donor"])
    out = emb.embed(Atlas(star.cells(spark, d), star.genes(spark, d), star.counts(spark, d)), "halves")
    return rounded(out.select("cell_id", "key", F.col("vector")[0].alias("first"), F.col("vector")[1].alias("second")), 1)


@query("E8_embedding_by_name", with_ctes("SELECT 'X_gs' AS key, count(*) AS n, (SELECT sum(value) FROM counts) AS total FROM cells", DENSE_CELLS, DENSE_COUNTS))
def by_name(spark, d):
    a = dense_atlas(spark, d)
    out = emb.embed(a, "gs", panel=emb.panel_from(a.genes, "gene_id"))
    return out.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x)).alias("total"))


@query("E9_missing_methods", with_ctes("""SELECT 'X_pca' AS key, count(*) AS n, min(cell_id) AS first FROM cells
  UNION ALL SELECT 'X_gs', count(*), min(cell_id) FROM cells WHERE batch <> 'BUILDING'""", DENSE_CELLS))
def missing_methods(spark, d):
    a = dense_atlas(spark, d)
    panel = emb.panel_from(a.genes, "gene_id")
    # one batch has its panel vectors already
    done = a.cells.filter("batch = 'BUILDING'").select("cell_id")
    a = a.with_(embeddings=emb.embed(a, "gs", panel=panel).join(done, "cell_id", "left_semi"))
    out = emb.embed_missing(a, {"gs": {"panel": panel}, "pca": {"loadings": loadings(spark, d)}})
    return out.groupBy("key").agg(F.count("*").alias("n"), F.min("cell_id").alias("first"))


@query("E9_added_embeddings", with_ctes("""SELECT 'X_gs' AS key, batch AS chunk, cell_id, slot AS dim, CAST(value AS DOUBLE) AS value FROM counts JOIN cells USING (cell_id) JOIN (
    SELECT gene_id, CAST(row_number() OVER (ORDER BY gene_id) - 1 AS INTEGER) AS slot FROM genes) USING (gene_id) WHERE value <> 0""", DENSE_CELLS, DENSE_GENES, DENSE_COUNTS))
def added_embeddings(spark, d):
    """Three runs into one folder: every third cell, then what is missing but for one batch, then the rest; all cells are read back."""
    a, path = dense_atlas(spark, d), scratch(spark)
    panel = emb.panel_from(a.genes, "gene_id")
    chunk = a.cells.select("cell_id", F.col("batch").alias("chunk"))
    done = None
    for cells in (a.cells.filter("cell_id % 3 = 0"), a.cells.filter("batch <> 'BUILDING'"), a.cells):
        missing = emb.embed_missing(a.with_(cells=cells, embeddings=done), {"gs": {"panel": panel}})
        write_embeddings(missing.join(chunk, "cell_id"), path)
        done = read_embeddings(spark, path)
    out = done.select("key", "chunk", "cell_id", F.posexplode("vector").alias("dim", "value")).filter("value <> 0")
    return out.withColumn("value", F.col("value").cast("double"))


# --- mixtures ---------------------------------------------------------------------

URGENT = "o_orderpriority IN ('1-URGENT', '2-HIGH')"


def two_humps(spark, d):
    """A covariate with two well separated humps; a null now and then."""
    o = star.table(spark, d, "orders")
    high = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return o.select(F.col("o_orderkey").alias("cell_id"), F.col("o_orderkey").alias("ord"), F.when(
        F.col("o_orderstatus") != "P", F.col("o_totalprice") / 100000.0 + F.when(high, 40.0).otherwise(0.0)).alias("reads"))


LABELLED = f"lab AS (SELECT o_orderkey AS cell_id, CASE WHEN o_orderstatus <> 'P' THEN CASE WHEN {URGENT} THEN 'high_reads' ELSE 'low_reads' END END AS reads_label FROM orders)"


@query("E10_mixture_labels", with_ctes("SELECT cell_id, reads_label FROM lab", LABELLED))
def mixture_labels(spark, d):
    return mixtures.fit_labels(two_humps(spark, d), "reads").select("cell_id", "reads_label")


@query("E12_labels_if_bimodal", with_ctes("SELECT reads_label, count(*) AS n FROM lab GROUP BY 1", LABELLED))
def labels_if_bimodal(spark, d):
    out, ok = mixtures.label_if_bimodal(two_humps(spark, d), "reads")
    assert ok
    return out.groupBy("reads_label").agg(F.count("*").alias("n"))


@query("E13_bimodal_split", with_ctes("SELECT cell_id, reads_label AS bimodal_split FROM lab WHERE reads_label IS NOT NULL", LABELLED))
def bimodal_split(spark, d):
    return mixtures.split_if_bimodal(two_humps(spark, d), "reads").select("cell_id", "bimodal_split")


#: Chunk 1-URGENT has two humps, 5-LOW has one value, the others one hump (sums of remainders are nearly normal); a null now and then.
HUMPED = """humped AS (SELECT *, ord AS cell, CASE WHEN ord % 17 <> 0 THEN CASE WHEN chunk = '5-LOW' THEN 2.5 ELSE
  (ord * 7919 % 1000 + ord * 104729 % 997 + ord * 1299709 % 991 + donor * 15485863 % 983 + ord * 611953 % 977 + donor * 7368787 % 971) / 1000.0::DOUBLE
  + CASE WHEN chunk = '1-URGENT' AND donor % 3 = 0 THEN 6 ELSE 0 END END END AS reads FROM (SELECT *, annotation AS chunk FROM cells))"""


def humped(cells):
    ord_, donor = F.col("ord"), F.col("donor")
    hump = (ord_ * 7919 % 1000 + ord_ * 104729 % 997 + ord_ * 1299709 % 991 + donor * 15485863 % 983 + ord_ * 611953 % 977
            + donor * 7368787 % 971) / 1000.0 + F.when((F.col("annotation") == "1-URGENT") & (donor % 3 == 0), 6).otherwise(0)
    return cells.withColumn("chunk", F.col("annotation")).withColumn(
        "reads", F.when(ord_ % 17 != 0, F.when(F.col("chunk") == "5-LOW", F.lit(2.5)).otherwise(hump)))


ONE_AND_TWO = """pooled AS (SELECT 'two' AS name, CASE WHEN batch <> 'P' THEN price / 100000.0 + CASE WHEN annotation IN ('1-URGENT', '2-HIGH') THEN 40 ELSE 0 END END AS x FROM cells
  UNION ALL SELECT 'one', CASE WHEN chunk <> '1-URGENT' OR donor % 3 <> 0 THEN reads END FROM humped WHERE chunk <> '5-LOW')"""


@query("E11_bimodality", with_ctes("SELECT g AS name, bimodal FROM em_fit", CELLS, HUMPED, ONE_AND_TWO, *mixture_ctes("pooled", "x", "name"), recursive=True))
def bimodality(spark, d):
    """A covariate with two humps and one with one."""
    cells = humped(star_atlas(spark, d).cells).filter("chunk <> '5-LOW'").filter("chunk <> '1-URGENT' OR donor % 3 <> 0")
    verdicts = {"two": mixtures.is_bimodal(two_humps(spark, d), "reads"), "one": mixtures.is_bimodal(cells, "reads")}
    both = two_humps(spark, d).select(F.lit("two").alias("name"), "reads").unionByName(cells.select(F.lit("one").alias("name"), "reads"))
    told = F.create_map(*[F.lit(x) for pair in verdicts.items() for x in pair])
    return both.groupBy("name").agg(F.count("reads").alias("n")).select("name", told[F.col("name")].alias("bimodal"))


@query("E10_mixtures_by_chunk", with_ctes("""SELECT g AS chunk, n, bimodal, round(center + least(m0, m1), 4) AS mean_low, round(center + greatest(m0, m1), 4) AS mean_high,
  round(CASE WHEN m0 <= m1 THEN w0 ELSE w1 END, 4) AS share_low FROM em_fit WHERE g <> '5-LOW'""", CELLS, HUMPED, *mixture_ctes("humped", "reads", "chunk"), recursive=True))
def mixtures_by_chunk(spark, d):
    """All chunks in one plan; of the chunk with one value only the verdict means anything, which the split shows."""
    fit = group_mixtures.fit_groups(humped(star_atlas(spark, d).cells), "reads", "chunk").filter("chunk <> '5-LOW'")
    return rounded(fit.select("chunk", "n", "bimodal", "mean_low", "mean_high", "share_low"), 4)


@query("E13_bimodal_split_by_chunk", with_ctes("SELECT cell_id, chunk, bimodal_split FROM em_split", CELLS, HUMPED, *mixture_ctes("humped", "reads", "chunk"), recursive=True))
def bimodal_split_by_chunk(spark, d):
    out = group_mixtures.split_groups_if_bimodal(humped(star_atlas(spark, d).cells), "reads", "chunk")
    return out.select("cell_id", "chunk", "bimodal_split")


@query("A24_cluster_sizes", with_ctes("SELECT reads_label, count(*) AS n_cells FROM lab GROUP BY 1", LABELLED))
def cluster_sizes(spark, d):
    return mixtures.cluster_sizes(mixtures.fit_labels(two_humps(spark, d), "reads"), "reads_label")


def priced(spark, d):
    return star.cells_with_instrument(spark, d).withColumn("label", F.when(F.col("price") > 250000, "high").otherwise("low"))


@query("E14_label_regression", with_ctes("""SELECT 'instrument=' || instrument AS term, count(*) AS n, round(count(*) FILTER (NOT price > 250000), 1) * 1.0::DOUBLE AS expected_low FROM cells GROUP BY 1
  UNION ALL SELECT 'annotation=' || annotation, count(*), round(count(*) FILTER (NOT price > 250000), 1) * 1.0::DOUBLE FROM cells GROUP BY 1""", CELLS_INSTR))
def label_regression(spark, d):
    """A fitted regression expects as many cells of each label in every category as there are."""
    c = priced(spark, d)
    names = ["instrument", "annotation"]
    found = mixtures.label_regression(c, "label", names)
    start = found.filter("term = 'intercept'").select("coefficient").scalar()
    for name in names:
        part = found.select(F.col("term").alias(f"_{name}"), F.col("coefficient").alias(f"b_{name}"))
        c = c.withColumn(f"_{name}", F.concat(F.lit(f"{name}="), name)).join(part, f"_{name}", "left")
    z = sum((F.coalesce(f"b_{name}", F.lit(0.0)) for name in names), start)
    c = c.withColumn("p", 1 / (1 + F.exp(-z))).withColumn("term", F.explode(F.array(*[f"_{name}" for name in names])))
    return rounded(c.groupBy("term").agg(F.count("*").alias("n"), F.sum("p").alias("expected_low")), 1)


@query("E14_one_covariate", with_ctes("""SELECT CASE WHEN instrument = base THEN 'intercept' ELSE 'instrument=' || instrument END AS term,
    round(z - CASE WHEN instrument = base THEN 0 ELSE arg_min(z, instrument) OVER () END, 3) AS coefficient
  FROM (SELECT instrument, min(instrument) OVER () AS base, ln(low * 1.0 / (n - low)) AS z FROM (
    SELECT instrument, count(*) AS n, count(*) FILTER (NOT price > 250000) AS low FROM cells GROUP BY 1))""", CELLS_INSTR))
def one_covariate(spark, d):
    """With one covariate the coefficients are differences of log odds."""
    return rounded(mixtures.label_regression(priced(spark, d), "label", ["instrument"]), 3)


# --- plans ------------------------------------------------------------------------


def general_ctes(src: str, cells: str, n: int, min_cells: int, min_genes: int, by: list[str] | None = None, batch: str | None = None) -> str:
    by = by or []
    k = "".join(f"{b}, " for b in by)
    using = ", ".join([*by, "gene_id"])
    carry = "".join(f", c.{b}" for b in dict.fromkeys([*by, *([batch] if batch else [])]))
    return f"""g_src AS (SELECT e.cell_id, e.gene_id, e.value{carry} FROM {src} e JOIN {cells} c USING (cell_id)),
g_keep AS (SELECT {k}gene_id FROM g_src WHERE value > 0 GROUP BY {k}gene_id HAVING count(*) >= {min_cells}),
g_e AS (SELECT g_src.* FROM g_src JOIN g_keep USING ({using}) QUALIFY count(*) OVER (PARTITION BY cell_id) >= {min_genes}),
g_cells AS (SELECT * FROM {cells} WHERE cell_id IN (SELECT cell_id FROM g_e)),
g_genes AS (SELECT * FROM genes WHERE gene_id IN (SELECT gene_id FROM g_e)),
g_norm AS (SELECT * REPLACE (ln(1 + value * 10000.0 / sum(value) OVER (PARTITION BY cell_id)) AS value) FROM g_e),
""" + (hvg_ctes(n, src="g_norm", cells="g_cells", genes="g_genes", by=by) if not batch else f"""g_var AS (SELECT {batch}, gene_id, sum(value) AS s, sum(value * value) AS q FROM g_norm GROUP BY 1, 2),
g_enough AS (SELECT {batch} FROM g_var JOIN (SELECT {batch}, count(*) AS n FROM g_cells GROUP BY 1) USING ({batch})
  WHERE (q - n * (s / n) * (s / n)) / n > 1e-6 GROUP BY 1 HAVING count(*) >= {n}),
g_norm_b AS (SELECT * FROM g_norm WHERE {batch} IN (SELECT {batch} FROM g_enough)),
g_cells_b AS (SELECT * FROM g_cells WHERE {batch} IN (SELECT {batch} FROM g_enough)),
""" + hvg_ctes(n, src="g_norm_b", cells="g_cells_b", genes="g_genes", by=by, batch=batch))


def settings(**kw):
    return preprocess.Settings(**{"min_cells": 20, "min_genes": 3, "n_top_genes": 200, "families": families(), "percent_top": (3,), **kw})


def star_atlas(spark, d, instrument=False) -> Atlas:
    cells = star.cells_with_instrument(spark, d) if instrument else star.cells(spark, d)
    return Atlas(cells, star.genes(spark, d), star.counts(spark, d), n_entries=star.n_lines(spark, d))


GENE_OUT = "gene_id, round(dispersions_norm, 6) AS dispersions_norm, highly_variable"


@query("K2_general_genes", with_ctes(f"SELECT {GENE_OUT}, highly_variable_nbatches FROM scored", CELLS, GENES, COUNTS, general_ctes("counts", "cells", 100, 20, 3, batch="batch")))
def general_genes(spark, d):
    out = preprocess.general(star_atlas(spark, d), settings(batch="batch", n_top_genes=100))
    return rounded(out.genes.select("gene_id", "dispersions_norm", "highly_variable", "highly_variable_nbatches"))


@query("K2_general_entries", with_ctes("SELECT cell_id, gene_id, round(value, 6) AS value FROM g_norm", CELLS, GENES, COUNTS, general_ctes("counts", "cells", 200, 20, 3)))
def general_entries(spark, d):
    return rounded(preprocess.general(star_atlas(spark, d), settings()).counts.select("cell_id", "gene_id", "value"))


def over_what_is_left(ranked: str) -> str:
    return ranked.replace("FROM cells c", "FROM g_cells c").replace("JOIN norm n", "JOIN g_norm n")


def flagship_sql() -> str:
    """Negatives of sentences over what the general steps leave."""
    rows = """s AS (SELECT cell_id AS sample_idx, ord, cell_sentence AS cell_sentence_1, caption, batch, 'links/' || batch AS adata_link FROM g_cells JOIN sent USING (cell_id))"""
    return with_ctes("""SELECT sample_idx, cell_sentence_1, caption AS positive, neg1 AS negative_1_idx, neg2 AS negative_2_idx, adata_link
  FROM n2 WHERE coalesce(neg1, neg2) IS NOT NULL""", CELLS, GENES, COUNTS, general_ctes("counts", "cells", 200, 20, 3), HV, over_what_is_left(RANKED), rows, NEG)


@query("flagship_sentence_records", flagship_sql())
def sentence_records(spark, d, n_negatives=2):
    """From counts: every surviving cell with its sentence of top genes and negatives of its own batch."""
    atlas = star_atlas(spark, d)
    atlas = atlas.with_(counts=settle_by_key(atlas.counts, "cell_id", rows=atlas.n_entries))
    kept = preprocess.general(atlas, preprocess.Settings(min_cells=20, min_genes=3, n_top_genes=200))
    text = sentences.cell_sentences(kept.counts, kept.cells, kept.genes, length=5)
    rows = records.samples(text, ["cell_sentence"], F.concat(F.lit("links/"), "batch"), caption="caption", batch="batch")
    return records.build_records(rows, "multiplets", n_negatives)


@query("K12_ids_by_own_lookup", with_ctes("""SELECT 'ENSG' || min(p_partkey) AS gene_id, p_name AS previous_index FROM part WHERE p_size > 10 GROUP BY p_name""",
    GENES))
def ids_by_own_lookup(spark, d):
    """Any table with symbols and accessions serves as the lookup; genes it lacks are dropped."""
    key = F.when(F.col("p_size") > 10, F.col("p_name")).otherwise(F.concat(F.lit("absent "), "p_name"))
    own = star.table(spark, d, "part").select(key.alias("name"), F.concat(F.lit("ENSG"), "p_partkey").alias("accession"), F.col("p_partkey").alias("place"))
    g = star.genes(spark, d).select(F.col("gene_name").alias("gene_id")).distinct()
    out = lookups.ensure_accession_ids(g, lookup=own, lookup_symbol="name", lookup_id="accession", order="place")
    return out.select("gene_id", "previous_index")


#: One request for each line of an order.
REQUESTS = """requests AS (SELECT l_orderkey, l_linenumber, ['min_cells', 'min_genes', 'n_top_genes', 'category_threshold', 'chunk_size', 'subset_size', 'train_frac', 'other'][l_orderkey % 8 + 1] AS parameter,
  CASE WHEN l_orderkey % 8 = 6 THEN l_discount * 25 - 0.5 WHEN l_linenumber = 5 THEN NULL WHEN l_linenumber = 4 THEN l_quantity + 0.5 ELSE l_quantity % 7 - 2 END::DOUBLE AS value FROM lineitem)"""


@query("K13_refused_parameters", with_ctes("""SELECT parameter, refused, count(*) AS n, min(value) AS least, max(value) AS most FROM (SELECT *, CASE WHEN value IS NULL THEN 'no value'
    WHEN parameter = 'train_frac' THEN CASE WHEN value > 0 AND value < 1 THEN NULL ELSE 'not between 0 and 1' END WHEN parameter = 'other' THEN 'unknown parameter'
    WHEN value <> floor(value) THEN 'not a whole number' WHEN value < 1 THEN 'less than 1' END AS refused FROM requests) GROUP BY ALL""", REQUESTS))
def refused_parameters(spark, d):
    """Which of very many requested values the checks refuse, and why."""
    names, place = F.array(*[F.lit(n) for n in [*preprocess.LEAST, *preprocess.SHARES, "other"]]), F.col("l_orderkey") % 8
    whole = F.when(F.col("l_linenumber") != 5, F.when(F.col("l_linenumber") == 4, F.col("l_quantity") + 0.5).otherwise(F.col("l_quantity") % 7 - 2))
    requests = star.table(spark, d, "lineitem").select(
        names[place.cast("int")].alias("parameter"), F.when(place == 6, F.col("l_discount") * 25 - 0.5).otherwise(whole).cast("double").alias("value"))
    return preprocess.judged_requests(requests).groupBy("parameter", "refused").agg(
        F.count("*").alias("n"), F.min("value").alias("least"), F.max("value").alias("most"))


PASSED = "passed AS (SELECT * FROM cells WHERE cell_id IN (SELECT cell_id FROM judged WHERE NOT outlier AND NOT mt_outlier))"


@query("K1_preprocessed_cells", with_ctes("SELECT cell_id, 'This measurement was conducted with ' || instrument || '. ' || caption AS caption, count(*) AS n_genes FROM g_cells JOIN g_norm USING (cell_id) GROUP BY 1, 2",
    CELLS_INSTR, GENES, COUNTS, qc_ctes(), outlier_ctes(), PASSED, general_ctes("counts", "passed", 200, 20, 3)))
def preprocessed_cells(spark, d):
    out = preprocess.preprocess(star_atlas(spark, d, True), settings(instrument="instrument", description="caption"))
    n = out.counts.groupBy("cell_id").agg(F.count("*").alias("n_genes"))
    return out.cells.select("cell_id", "caption").join(n, "cell_id")


@query("K1_preprocessed_genes", with_ctes(f"SELECT {GENE_OUT} FROM scored", CELLS, GENES, COUNTS, qc_ctes(), outlier_ctes(), PASSED, general_ctes("counts", "passed", 200, 20, 3)))
def preprocessed_genes(spark, d):
    out = preprocess.preprocess(star_atlas(spark, d), settings())
    return rounded(out.genes.select("gene_id", "dispersions_norm", "highly_variable"))


CHUNKED = (CELLS.replace("o_totalprice AS price", "o_totalprice AS price, o_orderpriority AS chunk"), GENES, COUNTS,
           qc_ctes(carry="chunk"), outlier_ctes(by="chunk"), PASSED, general_ctes("counts", "passed", 100, 5, 2, by=["chunk"]))
MERGED = """merged AS (SELECT gene_id, arg_max(dispersions_norm, chunk) AS dispersions_norm, arg_max(highly_variable, chunk) AS highly_variable FROM scored GROUP BY 1)"""


def chunked(spark, d) -> Atlas:
    a = star_atlas(spark, d)
    a = a.with_(cells=a.cells.withColumn("chunk", F.col("annotation")))
    return preprocess.preprocess(a, settings(min_cells=5, min_genes=2, n_top_genes=100), by="chunk")


@query("K4_preprocessed_by_chunk", with_ctes(f"SELECT chunk, {GENE_OUT} FROM scored", *CHUNKED))
def by_chunk(spark, d):
    return rounded(chunked(spark, d).group_genes.select("chunk", "gene_id", "dispersions_norm", "highly_variable"))


@query("K4_merged_genes", with_ctes("SELECT gene_id, gene_name, round(dispersions_norm, 6) AS dispersions_norm, highly_variable FROM merged JOIN genes USING (gene_id)", *CHUNKED, MERGED))
def merged_by_chunk(spark, d):
    return rounded(chunked(spark, d).genes.select("gene_id", "gene_name", "dispersions_norm", "highly_variable"))


@query("K4_sentences_by_chunk", with_ctes("SELECT cell_id, cell_sentence FROM sent", *CHUNKED, MERGED, HV.replace("JOIN scored", "JOIN merged"), over_what_is_left(RANKED)))
def sentences_by_chunk(spark, d):
    """No sentence lists a gene twice, though each chunk has its own marks."""
    a = chunked(spark, d)
    return sentences.cell_sentences(a.counts, a.cells, a.genes, 5).select("cell_id", "cell_sentence")


def partly_broken(spark, d) -> Atlas:
    """One chunk has negative numbers, one has them as well but raw counts in a layer, one has no entries at all."""
    a = star_atlas(spark, d)
    cells = a.cells.withColumn("chunk", F.col("annotation"))
    tagged = a.counts.join(cells.select("cell_id", "chunk"), "cell_id")
    layer = tagged.filter("chunk = '2-HIGH'").select(F.lit("counts").alias("layer"), "cell_id", "gene_id", F.col("value").cast("double").alias("value"))
    broken = tagged.filter("chunk <> '4-NOT SPECIFIED'").withColumn("value", F.when(F.col("chunk").isin("2-HIGH", "3-MEDIUM"), -F.col("value")).otherwise(F.col("value")))
    return a.with_(cells=cells, counts=broken.drop("chunk"), layers=layer)


@query("K4_chunk_status", with_ctes("""SELECT chunk, count(*) AS n_cells, CASE WHEN chunk IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN 0 ELSE coalesce(any_value(kept), 0) END AS n_kept,
  CASE chunk WHEN '3-MEDIUM' THEN 'no raw counts' WHEN '4-NOT SPECIFIED' THEN 'no cells left after filtering' ELSE 'done' END AS status
  FROM cells LEFT JOIN (SELECT chunk, count(DISTINCT cell_id) AS kept FROM g_cells GROUP BY 1) USING (chunk) GROUP BY chunk""", *CHUNKED))
def chunk_status(spark, d):
    return preprocess.preprocess(partly_broken(spark, d), settings(min_cells=5, min_genes=2, n_top_genes=100), by="chunk").group_status


@query("K4_chunks_beside_failed", with_ctes(f"SELECT chunk, {GENE_OUT} FROM scored WHERE chunk NOT IN ('3-MEDIUM', '4-NOT SPECIFIED')", *CHUNKED))
def chunks_beside_failed(spark, d):
    """The other chunks come out as if they were alone, the one with its layer as if that were its matrix."""
    out = preprocess.preprocess(partly_broken(spark, d), settings(min_cells=5, min_genes=2, n_top_genes=100), by="chunk")
    return rounded(out.group_genes.select("chunk", "gene_id", "dispersions_norm", "highly_variable"))


SPLIT_CHUNKED = (CELLS, HUMPED.replace("AS reads FROM", "AS reads_raw FROM").replace("humped AS (", "humped AS (SELECT * EXCLUDE (reads_raw), ln(1 + reads_raw) AS reads_log FROM (") + ")",
                 *mixture_ctes("humped", "reads_log", "chunk"), GENES, COUNTS, qc_ctes(cells="em_split", carry="chunk, bimodal_split"),
                 outlier_ctes(by="chunk, bimodal_split"), PASSED.replace("FROM cells", "FROM em_split"), general_ctes("counts", "passed", 100, 5, 2, by=["chunk", "bimodal_split"]))


@query("K4_bimodal_chunks", with_ctes(f"SELECT chunk, bimodal_split, {GENE_OUT} FROM scored", *SPLIT_CHUNKED, recursive=True))
def bimodal_chunks(spark, d):
    """Each chunk is tested by itself: one is split in two, the others stay whole."""
    a = star_atlas(spark, d)
    a = a.with_(cells=humped(a.cells))
    out = preprocess.preprocess(a, settings(min_cells=5, min_genes=2, n_top_genes=100, bimodal_column="reads"), by="chunk")
    return rounded(out.group_genes.select("chunk", "bimodal_split", "gene_id", "dispersions_norm", "highly_variable"))


@query("K3_token_inputs", with_ctes("""SELECT cell_id, coalesce(t, 0) AS n_counts, row_number() OVER (ORDER BY ord) - 1 AS sample_index
  FROM cells LEFT JOIN (SELECT cell_id, sum(value) AS t FROM counts GROUP BY 1) USING (cell_id)""", CELLS, COUNTS))
def token_inputs(spark, d):
    a = star_atlas(spark, d)
    out = preprocess.token_inputs(a, a.counts, star.table(spark, d, "part").select(
        F.col("p_name").alias("gene_name"), F.concat(F.lit("ENSG"), "p_partkey").alias("ensembl_gene_id")))
    return out.cells.select("cell_id", "n_counts", "sample_index")


@query("K5_cleaned_variable_genes", with_ctes("SELECT cell_id, gene_id, round(value, 6) AS value FROM g_norm_b SEMI JOIN (SELECT gene_id FROM scored WHERE highly_variable) USING (gene_id)",
    CELLS, GENES, COUNTS, qc_ctes(), outlier_ctes(), PASSED, general_ctes("counts", "passed", 100, 5, 3, batch="batch")))
def cleaned(spark, d):
    out = preprocess.cleanup_variable_genes(star_atlas(spark, d), 100, "batch", 3, 5, families(), percent_top=(3,))
    return rounded(out.counts.select("cell_id", "gene_id", "value"))


NORM_B = "normb AS (SELECT n.*, c.batch FROM norm n JOIN cells c USING (cell_id))"
RANKS = """ranks AS (SELECT batch AS dataset, gene_id, highly_variable, CASE WHEN dispersions_norm IS NOT NULL THEN
  rank() OVER (PARTITION BY batch ORDER BY dispersions_norm DESC NULLS LAST) END AS rank FROM scored),
per AS (SELECT gene_id, count(DISTINCT dataset) AS n_datasets, avg(rank) AS mean_rank FROM ranks WHERE highly_variable GROUP BY 1),
stable AS (SELECT *, n_datasets = 3 AS in_all FROM per ORDER BY in_all DESC, n_datasets DESC, mean_rank NULLS LAST, gene_id LIMIT 300)"""


def stable(spark, d):
    return stable_genes.select_stable_genes(dict(zip("FOP", by_status(spark, d))), 400, 300)


@query("W3_dispersion_ranks", with_ctes("SELECT dataset, gene_id, highly_variable, rank FROM ranks", CELLS, COUNTS, NORM, NORM_B, hvg_ctes(400, src="normb", by=["batch"]), RANKS))
def ranks(spark, d):
    return stable(spark, d)[1]


@query("U8_stable_genes", with_ctes("SELECT gene_id, n_datasets, round(mean_rank, 6) AS mean_rank, in_all FROM stable", CELLS, COUNTS, NORM, NORM_B, hvg_ctes(400, src="normb", by=["batch"]), RANKS))
def stable_set(spark, d):
    return rounded(stable(spark, d)[0])


def by_name_ctes() -> list[str]:
    """Scores per dataset under its gene names, over the annotations of each dataset that have enough varying genes."""
    scores = hvg_ctes(400, src="k_norm", cells="k_cells", genes="k_genes", by=["batch"], batch="annotation")
    # a dataset's genes are its own: all of them have a place, also without any entry in the annotations left
    scores = scores.replace("JOIN k_genes USING (gene_id)", "JOIN k_genes USING (batch, gene_id)").replace(
        "FROM scored_p JOIN scored_nb USING (batch)", "FROM (SELECT batch, gene_id FROM k_genes) LEFT JOIN scored_p USING (batch, gene_id) LEFT JOIN scored_nb USING (batch)")
    return ["""k_names AS (SELECT batch, gene_id AS part, pos, CASE WHEN nth > 1 THEN gene_name || '_' || (nth - 1) ELSE gene_name END AS gene_id FROM (
    SELECT batch, g.*, row_number() OVER (PARTITION BY batch, gene_name ORDER BY pos) AS nth
    FROM (SELECT DISTINCT batch, gene_id FROM counts JOIN cells USING (cell_id)) JOIN genes g USING (gene_id)))""",
            "k_genes AS (SELECT batch, gene_id, pos FROM k_names)",
            "k_all AS (SELECT n.cell_id, k.gene_id, n.value, c.batch, c.annotation FROM norm n JOIN cells c USING (cell_id) JOIN k_names k ON k.batch = c.batch AND k.part = n.gene_id)",
            "k_var AS (SELECT batch, annotation, gene_id, sum(value) AS s, sum(value * value) AS q FROM k_all GROUP BY 1, 2, 3)",
            """k_enough AS (SELECT batch, annotation FROM k_var JOIN (SELECT batch, annotation, count(*) AS n FROM cells GROUP BY 1, 2) USING (batch, annotation)
  WHERE (q - n * (s / n) * (s / n)) / n > 1e-6 GROUP BY 1, 2 HAVING count(*) >= 400)""",
            "k_norm AS (SELECT * FROM k_all SEMI JOIN k_enough USING (batch, annotation))",
            "k_cells AS (SELECT * FROM cells SEMI JOIN k_enough USING (batch, annotation))", scores]


@query("K6_stable_genes_by_name", with_ctes("SELECT gene_id, n_datasets, round(mean_rank, 6) AS mean_rank, in_all FROM stable",
    CELLS, GENES, COUNTS, NORM, *by_name_ctes(), RANKS))
def stable_by_name(spark, d):
    """The same over gene names; names that repeat are told apart by suffixes."""
    parts = dict(zip("FOP", by_status(spark, d)))
    return rounded(stable_genes.select_stable_genes(parts, 400, 300, gene_column="gene_name", batch="annotation")[0])


@query("A23_selection_summary", with_ctes("""SELECT CAST(3 AS BIGINT) AS total_datasets, count(*) AS final_gene_count, count(*) FILTER (WHERE in_all) AS genes_from_intersection,
  count(*) FILTER (WHERE NOT in_all) AS genes_from_candidates, (SELECT count(*) FROM per WHERE n_datasets = 3) AS intersection_size FROM stable""",
    CELLS, COUNTS, NORM, NORM_B, hvg_ctes(400, src="normb", by=["batch"]), RANKS))
def selection_summary(spark, d):
    chosen, rankings = stable(spark, d)
    return setops.selection_summary(chosen, rankings, 3)
