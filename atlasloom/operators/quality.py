"""Per-cell and per-gene quality metrics, exact medians, and outlier flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from atlasloom.functions.genes import family_flags
from atlasloom.model import as_list
from atlasloom.sizing import broadcast_if_small, settle


def cell_metrics(
    counts: DataFrame, cells: DataFrame, genes: DataFrame, families: dict[str, Column] | None = None,
    percent_top: Sequence[int] = (20,), log1p: bool = True, symbol: str = "gene_name",
) -> DataFrame:
    """Cells with gene number, total, family totals and shares, and the share of the N largest genes.

    One shuffle on ``cell_id`` (none when the entries already are partitioned by
    it); a cell without entries gets zeros.
    """
    flags = family_flags(symbol) if families is None else families
    n_genes = genes.count() if percent_top else 0
    tops = [t if t <= n_genes else n_genes - 1 for t in percent_top]
    v = F.col("value").cast("double")
    entries = counts
    if flags:
        lookup = broadcast_if_small(genes.select("gene_id", *[e.alias(f"_f_{n}") for n, e in flags.items()]))
        entries = entries.join(lookup, "gene_id", "left")
    aggs = [F.count_if(v != 0).alias("n_genes_by_counts"), F.sum(v).alias("total_counts")]
    aggs += [F.sum(F.when(F.col(f"_f_{n}"), v).otherwise(0.0)).alias(f"total_counts_{n}") for n in flags]
    if tops:
        largest = F.row_number().over(W.partitionBy("cell_id").orderBy(F.desc("value")))
        entries = entries.withColumn("_r", largest)
        aggs += [F.sum(F.when(F.col("_r") <= t, v).otherwise(0.0)).alias(f"_top_{t}") for t in tops]
    per_cell = entries.groupBy("cell_id").agg(*aggs)
    m = cells.join(per_cell, "cell_id", "left").na.fill(0, [c for c in per_cell.columns if c != "cell_id"])
    share = {f"pct_counts_{n}": f"total_counts_{n}" for n in flags}
    share |= {f"pct_counts_in_top_{t}_genes": f"_top_{t}" for t in tops}
    total = F.col("total_counts")
    m = m.withColumns({k: F.when(total != 0, F.col(c) / total * 100.0).otherwise(0.0) for k, c in share.items()})
    if log1p:
        logged = ["n_genes_by_counts", "total_counts", *[f"total_counts_{n}" for n in flags]]
        m = m.withColumns({f"log1p_{c}": F.log1p(F.col(c).cast("double")) for c in logged})
    return m.drop(*[f"_top_{t}" for t in tops])


def gene_metrics(counts: DataFrame, cells: DataFrame, genes: DataFrame, log1p: bool = True) -> DataFrame:
    """Genes with cell number, mean, total and dropout share over all cells."""
    v = F.col("value").cast("double")
    n = cells.agg(F.count(F.lit(1)).cast("double")).scalar()
    per_gene = counts.groupBy("gene_id").agg(F.count_if(v != 0).alias("n_cells_by_counts"), F.sum(v).alias("total_counts"))
    m = genes.join(per_gene, "gene_id", "left").na.fill(0, ["n_cells_by_counts", "total_counts"])
    m = m.withColumn("_n", n).withColumns({
        "mean_counts": F.col("total_counts") / F.col("_n"),
        "pct_dropout_by_counts": (1.0 - F.col("n_cells_by_counts") / F.col("_n")) * 100.0,
    }).drop("_n")
    if log1p:
        m = m.withColumns({f"log1p_{c}": F.log1p(c) for c in ("mean_counts", "total_counts")})
    return m


def _percentile_quantiles(df: DataFrame, targets: dict[str, tuple[str, float]], by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(*[F.percentile(c, F.lit(q)).alias(name) for name, (c, q) in targets.items()])


def _bracketed_quantiles(
    df: DataFrame, targets: dict[str, tuple[str, float]], by: list[str], half_width: float = 0.001
) -> DataFrame:
    """Exact quantiles without buffering all values in one place.

    A sketch brackets each wanted place, ten times wider than its error bound;
    values under the bracket are only counted, all targets in one aggregate, and
    only rows inside a bracket (about a five-hundredth for each target) are taken
    apart, counted per distinct value and ordered. The wanted places are read off
    the running count. Should a bracket miss its place in spite of the bound, the
    job fails instead of returning a wrong number.
    """
    columns = list(dict.fromkeys(c for c, _ in targets.values()))

    def bracket(c: str, q: float) -> Column:
        # a small group is its own bracket: there a thousandth may be less than one place
        ends = F.percentile_approx(c, F.array(F.lit(max(q - half_width, 0.0)), F.lit(min(q + half_width, 1.0))), F.lit(10000))
        return F.when(F.count(c) <= 10_000, F.array(F.min(c), F.max(c))).otherwise(ends)

    box = df.groupBy(*by).agg(
        *[bracket(c, q).alias(f"_box_{n}") for n, (c, q) in targets.items()],
        *[F.count(c).alias(f"_n_{c}") for c in columns],
    )
    if by:
        box = broadcast_if_small(box)
        b = box.select(*[F.col(k).alias(f"_k_{k}") for k in by], *[c for c in box.columns if c not in by])
        cond = F.lit(True)
        for k in by:
            cond = cond & df[k].eqNullSafe(b[f"_k_{k}"])
        joined = df.join(b, cond)
    else:
        row = box.first()
        joined = df.select(*columns).withColumns({
            **{f"_box_{n}": F.array(*[F.lit(x) for x in (row[f"_box_{n}"] or [None, None])]) for n in targets},
            **{f"_n_{c}": F.lit(row[f"_n_{c}"]) for c in columns}})
    def ends(n: str) -> tuple[Column, Column]:
        return F.col(f"_box_{n}")[0].cast("double"), F.col(f"_box_{n}")[1].cast("double")

    def size(c: str) -> Column:
        return F.col(f"_n_{c}").cast("bigint")

    # below the brackets: one number per group and target
    under = joined.groupBy(*by).agg(
        *[F.count_if(F.col(c).cast("double") < ends(n)[0]).alias(f"_u_{n}") for n, (c, _) in targets.items()],
        *[F.first(f"_n_{c}", ignorenulls=True).alias(f"_n_{c}") for c in columns])
    under = under.select(*by, F.explode(F.array(*[
        F.struct(F.lit(n).alias("name"), F.lit(q).cast("double").alias("p"), size(c).alias("n"), F.lit(None).cast("double").alias("v"), F.col(f"_u_{n}").alias("c"))
        for n, (c, q) in targets.items()])).alias("e")).select(*by, "e.*").filter("n > 0")
    # within: only these rows are taken apart
    inside = {n: F.col(c).cast("double").between(*ends(n)) for n, (c, _) in targets.items()}
    some = F.lit(False)
    for hit in inside.values():
        some = some | F.coalesce(hit, F.lit(False))
    held = joined.filter(some).select(*by, F.explode(F.array(*[
        F.when(inside[n], F.struct(F.lit(n).alias("name"), F.lit(q).cast("double").alias("p"), size(c).alias("n"), F.col(c).cast("double").alias("v")))
        for n, (c, q) in targets.items()])).alias("e")).filter("e IS NOT NULL").select(*by, "e.*")
    held = held.groupBy(*by, "name", "p", "n", "v").agg(F.count(F.lit(1)).alias("c")).unionByName(under)
    w = W.partitionBy(*by, "name").orderBy(F.col("v").asc_nulls_first())
    run = held.withColumn("upto", F.sum("c").over(w)).withColumn("before", F.col("upto") - F.col("c"))
    place = (F.col("n") - 1) * F.col("p")  # between the value there and the next, by its fraction
    left = F.floor(place) + 1

    def at(k: Column) -> Column:
        return F.max(F.when((F.col("before") < k) & (k <= F.col("upto")), F.col("v")))

    found = run.groupBy(*by, "name").agg(
        at(left).alias("a"), at(F.least(left + 1, F.col("n"))).alias("b"), F.max(place - F.floor(place)).alias("f"))
    f = F.col("f")
    value = F.when((f == 0) | (F.col("a") == F.col("b")), F.col("a")).otherwise((1 - f) * F.col("a") + f * F.col("b"))
    found = found.withColumn("value", F.when(value.isNotNull(), value).otherwise(
        F.raise_error(F.lit("quantile outside its bracket"))))
    wide = found.groupBy(*by).pivot("name", list(targets)).agg(F.first("value"))
    if not by:
        return wide
    # a group of nulls alone has no place to look up, and no quantile
    groups = box.select(*[F.col(k).alias(f"_k_{k}") for k in by])
    same = F.lit(True)
    for k in by:
        same = same & wide[k].eqNullSafe(groups[f"_k_{k}"])
    return groups.join(wide, same, "left").select(*[F.col(f"_k_{k}").alias(k) for k in by], *targets)


def quantiles(
    df: DataFrame, targets: dict[str, tuple[str, float]], by: str | Sequence[str] | None = None, method: str = "auto"
) -> DataFrame:
    """Exact quantiles ``{name: (column, probability)}`` per group, interpolated between neighbours."""
    by = as_list(by)
    if method == "auto":
        method = "bracket"
    return (_percentile_quantiles if method == "percentile" else _bracketed_quantiles)(df, targets, by)


def medians(
    df: DataFrame, columns: Sequence[str], by: str | Sequence[str] | None = None, method: str = "auto"
) -> DataFrame:
    """Exact median of each column per group, as ``med_<column>``."""
    return quantiles(df, {f"med_{c}": (c, 0.5) for c in columns}, by, method)


def outlier_flags(
    df: DataFrame, nmads: dict[str, float], by: str | Sequence[str] | None = None, prefix: str = "outlier_",
    method: str = "auto",
) -> DataFrame:
    """Flag values outside ``median ± k * MAD`` (unscaled) per column, whole table or per group.

    ``df`` is read several times: hand in a settled table.
    """
    by, cols = as_list(by), list(nmads)
    df2 = _with_group_row(df, medians(df, cols, by, method), by)
    away = df2.select(*by, *[F.abs(F.col(c) - F.col(f"med_{c}")).alias(c) for c in cols])
    mads = medians(away, cols, by, method)
    mads = mads.select(*by, *[F.col(f"med_{c}").alias(f"mad_{c}") for c in cols])
    df2 = _with_group_row(df2, mads, by)
    out = df2.withColumns({
        f"{prefix}{c}": (F.col(c) < F.col(f"med_{c}") - k * F.col(f"mad_{c}"))
        | (F.col(c) > F.col(f"med_{c}") + k * F.col(f"mad_{c}"))
        for c, k in nmads.items()
    })
    return out.drop(*[f"med_{c}" for c in cols], *[f"mad_{c}" for c in cols])


def _with_group_row(df: DataFrame, stats: DataFrame, by: list[str]) -> DataFrame:
    """Attach a per-group (or one-row) statistics table."""
    new = [c for c in stats.columns if c not in by]
    if not by:
        # one row of numbers: as literals they cost nothing each time the flags are evaluated
        row = stats.first()
        return df.withColumns({c: F.lit(row[c]).cast("double") for c in new})
    s = broadcast_if_small(stats)
    s = s.select(*[F.col(k).alias(f"_k_{k}") for k in by], *new)
    cond = F.lit(True)
    for k in by:
        cond = cond & df[k].eqNullSafe(s[f"_k_{k}"])
    return df.join(s, cond, "left").drop(*[f"_k_{k}" for k in by])


def quality_verdict(
    counts: DataFrame, cells: DataFrame, genes: DataFrame, nmads_main: float = 5, nmads_mt: float = 3,
    pct_counts_mt_threshold: float = 8.0, percent_top: Sequence[int] = (20,), log1p: bool = True,
    families: dict[str, Column] | None = None, mt: str = "mt", by: str | Sequence[str] | None = None,
    symbol: str = "gene_name", method: str = "auto",
) -> DataFrame:
    """Cell metrics with ``outlier`` (totals, gene number, top share) and ``mt_outlier``."""
    m = settle(cell_metrics(counts, cells, genes, families, percent_top, log1p, symbol))
    main = ["log1p_total_counts", "log1p_n_genes_by_counts"] if log1p else ["total_counts", "n_genes_by_counts"]
    main += [c for c in m.columns if c.startswith("pct_counts_in_top_")][:1]
    share = f"pct_counts_{mt}"
    flagged = outlier_flags(m, {**{c: nmads_main for c in main}, share: nmads_mt}, by, "_o_", method)
    any_main = F.col(f"_o_{main[0]}")
    for c in main[1:]:
        any_main = any_main | F.col(f"_o_{c}")
    return flagged.withColumns({
        "outlier": any_main, "mt_outlier": F.col(f"_o_{share}") | (F.col(share) > pct_counts_mt_threshold),
    }).drop(*[f"_o_{c}" for c in [*main, share]])


def passing_cells(judged: DataFrame) -> DataFrame:
    return judged.filter(~F.col("outlier") & ~F.col("mt_outlier"))
