"""Gene panels ranked by tissue expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlasloom.functions.ids import strip_version
from atlasloom.operators.filters import PANEL_BIOTYPES, panel_biotypes
from atlasloom.operators.ranking import first_per_key
from atlasloom.sizing import broadcast_if_small


def tissue_maxima(expression: DataFrame) -> DataFrame:
    """Largest value per (gene, tissue), long; absent pairs are zeros."""
    return expression.groupBy("Gene", "Tissue").agg(F.max("nTPM").alias("nTPM"))


def tissue_matrix(expression: DataFrame, tissues: Sequence[str] | None = None) -> DataFrame:
    """The same as a wide table with zeros filled in, for reading by people."""
    wide = expression.groupBy("Gene").pivot("Tissue", list(tissues) if tissues else None).agg(F.max("nTPM"))
    return wide.na.fill(0.0)


def expression_statistics(expression: DataFrame, detect_threshold: float = 1.0) -> DataFrame:
    """Per gene: tissues detected, mean, population variance and tau over all tissues, zeros included.

    One aggregation of the long table; the number of tissues comes from the whole table.
    """
    long = tissue_maxima(expression)
    n = expression.agg(F.count_distinct("Tissue").cast("double")).scalar()
    x = F.col("nTPM").cast("double")
    pos = F.greatest(x, F.lit(0.0))
    s = long.groupBy("Gene").agg(
        F.count_if(x >= detect_threshold).alias("_seen"), F.count(F.lit(1)).alias("_rows"), F.sum(x).alias("_s"),
        F.sum(x * x).alias("_q"), F.sum(pos).alias("_p"), F.max(pos).alias("_max")).withColumn("_n", n)
    mean = F.col("_s") / F.col("_n")
    silent = F.lit(0) if detect_threshold > 0 else (F.col("_n") - F.col("_rows")).cast("bigint")
    return s.select(
        "Gene", (F.col("_seen") + silent).cast("bigint").alias("detected_in"), mean.alias("mean_ntpm"),
        F.greatest(F.col("_q") / F.col("_n") - mean * mean, F.lit(0.0)).alias("var_ntpm"),
        F.when(F.col("_max") > 0, (F.col("_n") - F.col("_p") / F.col("_max")) / (F.col("_n") - 1)).otherwise(0.0).alias("tau"))


def zscores(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``z_<column>`` by mean and population deviation of the rows present."""
    stats = df.agg(*[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"d_{c}") for c in columns])
    out = df.withColumn("_z", stats.select(F.struct("*").alias("s")).scalar())
    return out.withColumns({
        f"z_{c}": (F.col(c) - F.col(f"_z.m_{c}")) / (F.col(f"_z.d_{c}") + 1e-9) for c in columns}).drop("_z")


def build_panel(
    annotation: DataFrame, expression: DataFrame, top_n: int, min_tissues: int = 5, detect_threshold: float = 1.0,
    alpha: float = 0.5, beta: float = 0.3, gamma: float = 0.2, keep_biotypes: Sequence[str] = PANEL_BIOTYPES,
    markers: DataFrame | None = None,
) -> DataFrame:
    """Top genes by ``alpha z(var) + beta z(tau) + gamma z(mean)`` after biotype and detection filters.

    ``markers(symbol)``, if given, come first, and symbols become unique.
    ``annotation(ensembl_gene_id, ensembl_gene_id_novers, gene_name, gene_type)``.
    """
    base = panel_biotypes(annotation, "gene_type", keep_biotypes)
    stats = expression_statistics(expression, detect_threshold)
    base = broadcast_if_small(base.select("ensembl_gene_id", "ensembl_gene_id_novers", "gene_name"))
    kept = stats.join(base, stats["Gene"] == base["ensembl_gene_id_novers"]).filter(F.col("detected_in") >= min_tissues)
    z = zscores(kept, ["var_ntpm", "tau", "mean_ntpm"])
    scored = z.withColumn(
        "score", alpha * F.col("z_var_ntpm") + beta * F.col("z_tau") + gamma * F.col("z_mean_ntpm"))
    columns = ["ensembl_gene_id", "gene_name", "mean_ntpm", "var_ntpm", "tau", "score"]
    scored = scored.select(*columns).dropna()
    if markers is None:
        return scored.orderBy(F.desc("score"), "ensembl_gene_id").limit(top_n)
    m = broadcast_if_small(markers.select(F.col("symbol").alias("_sym")).distinct())
    forced = scored.join(m, scored["gene_name"] == m["_sym"], "left").withColumn("_marker", F.col("_sym").isNotNull()).drop("_sym")
    # all rows of a symbol are markers or none are, so the best row per symbol is the first
    unique = first_per_key(forced, "gene_name", F.desc("score"), "ensembl_gene_id")
    return unique.orderBy(F.desc("_marker"), F.desc("score"), "ensembl_gene_id").limit(top_n).drop("_marker")


def panel_ids(panel: DataFrame, column: str = "ensembl_gene_id") -> DataFrame:
    """Distinct ids without version."""
    return panel.select(strip_version(F.col(column).cast("string")).alias("gene_id")).filter(
        F.col("gene_id").isNotNull()).distinct()
