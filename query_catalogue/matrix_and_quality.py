"""Matrix predicates, quality metrics, scaling, variable genes."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlasloom.model import Atlas, scoped
from atlasloom.operators import edits, filters, normalise, predicates, quality, reports, variable_genes
from atlasloom.sources import star_schema as star
from query_catalogue.registry import (
    CELLS, COUNTS, DENSE_CELLS, DENSE_COUNTS, DENSE_GENES, GENES, NORM, ORACLE, families, hvg_ctes, outlier_ctes, qc_ctes, query,
    rounded, with_ctes,
)

N_ALL = "((SELECT count(*) FROM cells) * (SELECT count(*) FROM genes))"


@query("S1_load_entries", "SELECT l_orderkey AS cell_id, l_partkey AS gene_id, sum(l_quantity) AS value FROM lineitem GROUP BY 1, 2")
def load_entries(spark, d):
    return star.counts(spark, d)


@query("F17_raw_count_check", with_ctes(f"""SELECT least(coalesce(min(value), 0), 0) AS min_value,
  round(count(*) FILTER (WHERE abs(value - round_even(value, 0)) > 1e-6) / {N_ALL}, 6) AS noninteger_fraction,
  least(coalesce(min(value), 0), 0) >= -1e-6 AND count(*) FILTER (WHERE abs(value - round_even(value, 0)) > 1e-6) / {N_ALL} <= 0.01
  AS is_raw_counts FROM counts""", CELLS, GENES, COUNTS))
def raw_count_check(spark, d):
    return rounded(predicates.raw_count_check(star.counts(spark, d), star.cells(spark, d), star.genes(spark, d)))


@query("F18_log_check", with_ctes("""SELECT round(least(min(value), 0), 6) AS min_value, round(greatest(max(value), 0), 6) AS max_value,
  least(min(value), 0) >= -0.001 AND greatest(max(value), 0) < 100 AS is_log FROM norm""", COUNTS, NORM))
def log_check(spark, d):
    return rounded(predicates.log_check(normalise.log_normalise(star.counts(spark, d))))


@query("F19_normalised_check", with_ctes("""SELECT round(avg(s), 6) AS mean_sum, round(stddev_pop(s) / avg(s), 6) AS ratio,
  coalesce(stddev_pop(s) / avg(s) < 0.2, false) AS is_normalised
  FROM (SELECT c.cell_id, coalesce(sum(value), 0) AS s FROM cells c LEFT JOIN counts USING (cell_id) GROUP BY 1)""", CELLS, COUNTS))
def normalised_check(spark, d):
    return rounded(predicates.normalised_check(star.counts(spark, d), star.cells(spark, d)))


@query("F20_scaled_check", with_ctes("""SELECT round(avg(CASE WHEN abs(m) <= 0.2 AND sd BETWEEN 0.8 AND 1.2 THEN 1.0 ELSE 0.0 END), 6) AS fraction_scaled,
  avg(CASE WHEN abs(m) <= 0.2 AND sd BETWEEN 0.8 AND 1.2 THEN 1.0 ELSE 0.0 END) >= 0.8 AS is_scaled
  FROM (SELECT g.gene_id, avg(coalesce(value, 0)) AS m, stddev_samp(coalesce(value, 0)) AS sd
    FROM genes g CROSS JOIN cells c LEFT JOIN scaled s ON s.gene_id = g.gene_id AND s.cell_id = c.cell_id GROUP BY 1)""",
    DENSE_CELLS, DENSE_GENES, DENSE_COUNTS,
    "scaled AS (SELECT cell_id, gene_id, (value - avg(value) OVER (PARTITION BY gene_id)) / stddev_samp(value) OVER (PARTITION BY gene_id) AS value FROM counts)"))
def scaled_check(spark, d):
    counts = star.dense_counts(spark, d)
    s = counts.groupBy("gene_id").agg(F.avg("value").alias("m"), F.stddev_samp("value").alias("sd"))
    scaled = counts.join(s, "gene_id").select("cell_id", "gene_id", ((F.col("value") - F.col("m")) / F.col("sd")).alias("value"))
    return rounded(predicates.scaled_check(scaled, star.dense_cells(spark, d), star.dense_genes(spark, d)))


@query("F1_frequent_genes", with_ctes("SELECT gene_id, count(*) AS n_cells FROM counts WHERE value > 0 GROUP BY 1 HAVING count(*) >= 25", COUNTS))
def frequent_genes(spark, d):
    return filters.genes_in_enough_cells(star.counts(spark, d), 25)


@query("F2_rich_cells", with_ctes("""SELECT cell_id, gene_id, value FROM counts
  JOIN (SELECT gene_id FROM counts WHERE value > 0 GROUP BY 1 HAVING count(*) >= 25) USING (gene_id)
  QUALIFY count(*) FILTER (WHERE value > 0) OVER (PARTITION BY cell_id) >= 3""", COUNTS))
def rich_cells(spark, d):
    kept = filters.keep_frequent_genes(star.counts(spark, d), 25)
    return filters.keep_rich_cells(kept, 3).select("cell_id", "gene_id", "value")


@query("F3_cells_left", with_ctes("SELECT batch, count(*) AS n FROM cells SEMI JOIN counts USING (cell_id) GROUP BY 1", CELLS, COUNTS))
def cells_left(spark, d):
    cells = filters.cells_with_entries(star.cells(spark, d), star.counts(spark, d))
    filters.require_cells(cells)
    return cells.groupBy("batch").agg(F.count("*").alias("n"))


@query("F4_finite_genes", with_ctes("""SELECT gene_id, count(*) AS n, sum(value) AS total FROM v
  WHERE gene_id NOT IN (SELECT gene_id FROM v WHERE value IS NULL) GROUP BY 1""",
    COUNTS, "v AS (SELECT cell_id, gene_id, CASE WHEN value < 95 THEN value END AS value FROM counts)"))
def finite_genes(spark, d):
    v = star.counts(spark, d).withColumn("value", F.when(F.col("value") < 95, F.col("value")).otherwise(F.lit(float("inf"))))
    return filters.drop_nonfinite_genes(v).groupBy("gene_id").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


@query("F5_varying_genes", with_ctes("""SELECT g.gene_id FROM genes g JOIN (SELECT g.gene_id, var_pop(coalesce(value, 0)) AS v
  FROM cells c CROSS JOIN genes g LEFT JOIN flat f ON f.cell_id = c.cell_id AND f.gene_id = g.gene_id GROUP BY 1) USING (gene_id) WHERE v > 0""",
    DENSE_CELLS, DENSE_GENES, DENSE_COUNTS,
    "flat AS (SELECT c.cell_id, g.gene_id, CASE WHEN g.pos < 6 THEN 1.0 ELSE coalesce(value, 0) END AS value FROM cells c CROSS JOIN genes g LEFT JOIN counts k ON k.cell_id = c.cell_id AND k.gene_id = g.gene_id)"))
def varying(spark, d):
    cells, genes = star.dense_cells(spark, d), star.dense_genes(spark, d)
    constant = genes.filter("pos < 6").select("gene_id")
    ones = cells.select("cell_id").withColumn("gene_id", F.explode(F.array(*[
        F.lit(f"Brand#{i}") for i in range(1, 6)]))).join(F.broadcast(constant), "gene_id", "left_semi").select(
        "cell_id", "gene_id", F.lit(1.0).alias("value"))
    rest = star.dense_counts(spark, d).join(F.broadcast(constant), "gene_id", "left_anti").select("cell_id", "gene_id", "value")
    return filters.varying_genes(genes, ones.unionByName(rest), cells).select("gene_id")


@query("F8_batches_with_enough_genes", with_ctes("""SELECT batch, count(*) AS n_variable FROM (
    SELECT batch, gene_id, (sum(value * value) - n * (sum(value) / n) * (sum(value) / n)) / n AS v
    FROM norm JOIN cells USING (cell_id) JOIN (SELECT batch, count(*) AS n FROM cells GROUP BY 1) USING (batch) GROUP BY batch, gene_id, n)
  WHERE v > 1e-6 GROUP BY 1 HAVING count(*) >= 200""", CELLS, COUNTS, NORM))
def enough_genes(spark, d):
    cells = star.cells(spark, d)
    norm = scoped(normalise.log_normalise(star.counts(spark, d)), cells, ["batch"])
    return filters.batches_with_enough_genes(norm, cells, "batch", 200)


QC_COLS = """n_genes_by_counts, total_counts, total_counts_mt, total_counts_ribo, total_counts_hb, round(pct_counts_mt, 6) AS pct_counts_mt,
  round(pct_counts_ribo, 6) AS pct_counts_ribo, round(pct_counts_hb, 6) AS pct_counts_hb"""
TOP = "round(pct_counts_in_top_3_genes, 6) AS pct_counts_in_top_3_genes"
LOGS = "round(log1p_n_genes_by_counts, 6) AS log1p_n_genes_by_counts, round(log1p_total_counts, 6) AS log1p_total_counts"


@query("A1_cell_metrics", with_ctes(f"SELECT cell_id, {QC_COLS}, {LOGS} FROM qc", CELLS, GENES, COUNTS, qc_ctes()))
def cell_metrics(spark, d):
    m = quality.cell_metrics(star.counts(spark, d), star.cells(spark, d), star.genes(spark, d), families(), percent_top=())
    return rounded(m.select(
        "cell_id", "n_genes_by_counts", "total_counts", *[f"total_counts_{f}" for f in families()],
        *[f"pct_counts_{f}" for f in families()], "log1p_n_genes_by_counts", "log1p_total_counts"))


@query("A2_top_share", with_ctes(f"SELECT cell_id, {TOP} FROM qc", CELLS, GENES, COUNTS, qc_ctes()))
def top_share(spark, d):
    m = quality.cell_metrics(star.counts(spark, d), star.cells(spark, d), star.genes(spark, d), {}, percent_top=(3,), log1p=False)
    return rounded(m.select("cell_id", "pct_counts_in_top_3_genes"))


@query("A3_gene_metrics", with_ctes("""SELECT gene_id, coalesce(n, 0) AS n_cells_by_counts, coalesce(t, 0) AS total_counts,
  round(coalesce(t, 0) / nc, 6) AS mean_counts, round((1 - coalesce(n, 0) / nc) * 100, 6) AS pct_dropout_by_counts
  FROM genes LEFT JOIN (SELECT gene_id, count(*) FILTER (WHERE value <> 0) AS n, sum(value) AS t FROM counts GROUP BY 1) USING (gene_id)
  CROSS JOIN (SELECT count(*) AS nc FROM cells)""", CELLS, GENES, COUNTS))
def gene_metrics(spark, d):
    m = quality.gene_metrics(star.counts(spark, d), star.cells(spark, d), star.genes(spark, d))
    return rounded(m.select("gene_id", "n_cells_by_counts", "total_counts", "mean_counts", "pct_dropout_by_counts"))


A4 = with_ctes("""SELECT cell_id, price < med - 1 * mad OR price > med + 1 * mad AS outlier_price FROM (
  SELECT *, median(abs(price - med)) OVER (PARTITION BY batch) AS mad FROM (SELECT *, median(price) OVER (PARTITION BY batch) AS med FROM cells))""", CELLS)


@query("A4_mad_outliers", A4)
def mad_outliers(spark, d):
    return quality.outlier_flags(star.cells(spark, d), {"price": 1}, by="batch").select("cell_id", "outlier_price")


@query("A4_mad_outliers_bracketed", A4)
def mad_outliers_bracketed(spark, d):
    """The same flags by the medians meant for very large tables."""
    return quality.outlier_flags(star.cells(spark, d), {"price": 1}, by="batch", method="bracket").select("cell_id", "outlier_price")


VERDICT = with_ctes("SELECT cell_id, outlier, mt_outlier FROM judged", CELLS, GENES, COUNTS, qc_ctes(), outlier_ctes())


@query("A5_quality_verdict", VERDICT)
def verdict(spark, d):
    return quality.quality_verdict(
        star.counts(spark, d), star.cells(spark, d), star.genes(spark, d), percent_top=(3,), families=families(),
    ).select("cell_id", "outlier", "mt_outlier")


@query("F6_passing_cells", with_ctes(
    "SELECT cell_id, total_counts FROM judged WHERE NOT outlier AND NOT mt_outlier", CELLS, GENES, COUNTS, qc_ctes(), outlier_ctes(by="batch")))
def passing(spark, d):
    judged = quality.quality_verdict(
        star.counts(spark, d), star.cells(spark, d), star.genes(spark, d), percent_top=(3,), families=families(), by="batch")
    return quality.passing_cells(judged).select("cell_id", "total_counts")


@query("A6_consolidated_categories", with_ctes("""SELECT cell_id, batch, annotation, CAST(site AS VARCHAR) AS site FROM c2""",
    """c0 AS (SELECT o_orderkey AS cell_id, o_orderstatus AS batch, o_orderpriority AS annotation, c_nationkey AS site, c_mktsegment AS instrument
       FROM orders JOIN customer ON o_custkey = c_custkey)""",
    "c1 AS (SELECT * FROM c0 QUALIFY count(*) OVER (PARTITION BY site) >= (SELECT count(*) / 25 FROM c0))",
    "c2 AS (SELECT * FROM c1 QUALIFY count(*) OVER (PARTITION BY annotation) >= (SELECT count(*) / 8 FROM c0))"))
def consolidated(spark, d):
    cells = star.cells_with_instrument(spark, d)
    n = cells.count()
    first = edits.consolidate_categories(cells, "site", -(-n // 25), remove=True)
    out = edits.consolidate_categories(first, ["annotation"], -(-n // 8), remove=True)
    return out.select("cell_id", "batch", "annotation", F.col("site").cast("string").alias("site"))


@query("A6_renamed_categories", with_ctes("""SELECT CASE WHEN count(*) OVER (PARTITION BY site) < (SELECT count(*) / 25 FROM cells) THEN 'remaining site'
  ELSE CAST(site AS VARCHAR) END AS site, cell_id FROM cells""",
    "cells AS (SELECT o_orderkey AS cell_id, c_nationkey AS site FROM orders JOIN customer ON o_custkey = c_custkey)"))
def renamed_categories(spark, d):
    cells = star.cells_with_instrument(spark, d)
    out = edits.consolidate_categories(cells, "site", -(-cells.count() // 25), remove=False)
    return out.select("cell_id", "site")


@query("X2_log_normalise", with_ctes("SELECT cell_id, gene_id, round(value, 6) AS value FROM norm", COUNTS, NORM))
def log_norm(spark, d):
    return rounded(normalise.log_normalise(star.counts(spark, d)).select("cell_id", "gene_id", "value"))


@query("X2_log_normalise_auto", with_ctes("""SELECT cell_id, gene_id, round(CASE WHEN (SELECT max(value) < 100 FROM counts) THEN s ELSE ln(1 + s) END, 6) AS value
  FROM (SELECT cell_id, gene_id, value * 10000.0 / sum(value) OVER (PARTITION BY cell_id) AS s FROM counts)""", COUNTS))
def log_norm_auto(spark, d):
    """Each step only if the data as given do not look like it; raw counts under 100 are scaled but not logged."""
    return rounded(normalise.log_normalise(star.counts(spark, d), star.cells(spark, d), mode="auto").select("cell_id", "gene_id", "value"))


@query("X3_raw_count_layer", with_ctes("""SELECT layer, cell_id, gene_id, value FROM (
    SELECT 'counts' AS layer, cell_id, gene_id, value FROM counts
    UNION ALL SELECT 'norm' AS layer, cell_id, gene_id, round(value, 6) FROM norm)""", DENSE_COUNTS, NORM))
def raw_layer(spark, d):
    raw = star.dense_counts(spark, d)
    norm = normalise.log_normalise(raw)
    layers = norm.select(F.lit("norm").alias("layer"), "cell_id", "gene_id", "value").unionByName(
        raw.select(F.lit("counts").alias("layer"), "cell_id", "gene_id", "value"))
    a = normalise.ensure_raw_counts(Atlas(star.dense_cells(spark, d), star.dense_genes(spark, d), norm, layers))
    return rounded(a.layers)


HVG_COLS = "gene_id, round(means, 6) AS means, round(dispersions_norm, 6) AS dispersions_norm, highly_variable"


@query("A10_variable_genes", with_ctes(f"SELECT {HVG_COLS}, round(dispersions, 6) AS dispersions FROM scored", CELLS, GENES, COUNTS, NORM, hvg_ctes(200)))
def hvg(spark, d):
    norm = normalise.log_normalise(star.counts(spark, d))
    out = variable_genes.variable_genes(norm, star.cells(spark, d), star.genes(spark, d), 200)
    return rounded(out.select("gene_id", "means", "dispersions_norm", "highly_variable", "dispersions"))


NORM_B = "normb AS (SELECT n.*, c.batch FROM norm n JOIN cells c USING (cell_id))"


@query("A11_variable_genes_by_batch", with_ctes(f"SELECT {HVG_COLS}, highly_variable_nbatches FROM scored",
    CELLS, GENES, COUNTS, NORM, NORM_B, hvg_ctes(200, src="normb", batch="batch")))
def hvg_batch(spark, d):
    cells = star.cells(spark, d)
    norm = scoped(normalise.log_normalise(star.counts(spark, d)), cells, ["batch"])
    out = variable_genes.variable_genes(norm, cells, star.genes(spark, d), 200, batch="batch")
    return rounded(out.select("gene_id", "means", "dispersions_norm", "highly_variable", "highly_variable_nbatches"))


@query("A12_exact_variable_genes", with_ctes(
    "SELECT gene_id, round(dispersions_norm, 6) AS dispersions_norm FROM scored JOIN genes USING (gene_id) ORDER BY scored.dispersions_norm DESC NULLS LAST, pos LIMIT 150",
    CELLS, GENES, COUNTS, NORM, hvg_ctes(200)))
def exact_hvg(spark, d):
    norm = normalise.log_normalise(star.counts(spark, d))
    out = variable_genes.variable_genes(norm, star.cells(spark, d), star.genes(spark, d), 200)
    return rounded(variable_genes.exact_top_genes(out, 150).select("gene_id", "dispersions_norm"))


@query("A18_histogram", with_ctes("""SELECT bin, round(lo + bin * w, 6) AS lower, round(lo + (bin + 1) * w, 6) AS upper, count(*) AS n FROM (
  SELECT CAST(least(floor((price - lo) / w), 29) AS INTEGER) AS bin, lo, w FROM cells CROSS JOIN
  (SELECT min(price) AS lo, (max(price) - min(price)) / 30 AS w FROM cells)) GROUP BY bin, lo, w""", CELLS))
def histogram(spark, d):
    return rounded(reports.histogram(star.cells(spark, d), "price", auto_bins=30))


@query("A19_distribution_by_category", with_ctes("""SELECT annotation, count(price) AS n, round(min(price), 6) AS minimum,
  round(quantile_cont(price, 0.25), 6) AS q1, round(quantile_cont(price, 0.5), 6) AS median, round(quantile_cont(price, 0.75), 6) AS q3,
  round(max(price), 6) AS maximum FROM cells GROUP BY 1""", CELLS))
def distribution(spark, d):
    return rounded(reports.distribution_by_category(star.cells(spark, d), "price", "annotation"))


@query("A19_distribution_bracketed", ORACLE["A19_distribution_by_category"])
def distribution_bracketed(spark, d):
    """The same rows by the quantiles meant for very large tables."""
    return rounded(reports.distribution_by_category(star.cells(spark, d), "price", "annotation", method="bracket"))


@query("A20_contingency", with_ctes("""SELECT annotation, count(*) FILTER (WHERE batch = 'F') AS F, count(*) FILTER (WHERE batch = 'O') AS O,
  count(*) FILTER (WHERE batch = 'P') AS P FROM cells GROUP BY 1""", CELLS))
def contingency(spark, d):
    return reports.contingency(star.cells(spark, d), "annotation", "batch", ["F", "O", "P"])
