"""Where queries and their SQL are collected, and helpers they share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``; without SQL only its rows are counted."""
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles and floats to ``places`` digits: sums are added up in another order elsewhere."""
    return df.select(*[
        F.round(F.col(f"`{n}`").cast("double"), places).alias(n) if t in ("double", "float") else F.col(f"`{n}`")
        for n, t in df.dtypes])


def scratch(spark: SparkSession) -> str:
    """A new folder for written tables: in the shared checkpoint folder, or a temporary one in a local session."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/atlasloom-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    return tempfile.mkdtemp(prefix="atlasloom-")


# --- SQL building blocks -----------------------------------------------------

CELLS = """cells AS (SELECT o_orderkey AS cell_id, o_orderkey AS ord, o_orderstatus AS batch, o_orderpriority AS annotation,
  o_custkey AS donor, 'order of priority ' || o_orderpriority || ' status ' || o_orderstatus AS caption,
  o_totalprice AS price FROM orders)"""
CELLS_INSTR = """cells AS (SELECT o_orderkey AS cell_id, o_orderkey AS ord, o_orderstatus AS batch, o_orderpriority AS annotation,
  o_custkey AS donor, 'order of priority ' || o_orderpriority || ' status ' || o_orderstatus AS caption,
  o_totalprice AS price, c_mktsegment AS instrument, c_nationkey AS site
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey)"""
GENES = """genes AS (SELECT p_partkey AS gene_id, p_partkey AS pos, p_name AS gene_name, p_type AS biotype, p_brand AS family
  FROM part)"""
COUNTS = """counts AS (SELECT l_orderkey AS cell_id, l_partkey AS gene_id, sum(l_quantity) AS value FROM lineitem GROUP BY 1, 2)"""
NORM = """norm AS (SELECT cell_id, gene_id, ln(1 + value * 10000.0 / sum(value) OVER (PARTITION BY cell_id)) AS value FROM counts)"""
DENSE_CELLS = """cells AS (SELECT c_custkey AS cell_id, c_custkey AS ord, c_mktsegment AS batch, c_acctbal AS balance FROM customer)"""
DENSE_GENES = """genes AS (SELECT DISTINCT p_brand AS gene_id, CAST(split_part(p_brand, '#', 2) AS INTEGER) AS pos, p_brand AS gene_name
  FROM part)"""
DENSE_COUNTS = """counts AS (SELECT o_custkey AS cell_id, p_brand AS gene_id, sum(l_quantity) AS value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""
EXPRESSION = """expression AS (SELECT 'ENSG' || l_partkey AS gene, c_nationkey AS tissue, max(l_quantity) AS ntpm
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


def with_ctes(body: str, *ctes: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(ctes) + "\n" + body


def _comma(cols: list[str], tail: bool = True) -> str:
    return "".join(f"{c}, " for c in cols) if tail else ", ".join(cols)


def hvg_ctes(n: int, src: str = "norm", cells: str = "cells", genes: str = "genes", by: list[str] | None = None,
             batch: str | None = None, out: str = "scored", bins: int = 20) -> str:
    """Dispersion scores of log-normalised entries; ``src`` carries the grouping columns."""
    by = list(by or [])
    keys = by + ([batch] if batch else [])
    k = _comma(keys)
    part = f"PARTITION BY {', '.join(keys)}" if keys else ""
    part_bin = f"PARTITION BY {k}mean_bin"
    size = f"{out}_n AS (SELECT {k}count(*) AS n FROM {cells} {'GROUP BY ' + ', '.join(keys) if keys else ''})"
    sums = f"""{out}_s AS (SELECT {k}gene_id, sum(exp(value) - 1) AS s, sum((exp(value) - 1) * (exp(value) - 1)) AS q
  FROM {src} WHERE value <> 0 GROUP BY {k}gene_id)"""
    if keys:
        mom = f"""{out}_m AS (SELECT {k}gene_id, s / n AS mean, greatest(q - n * (s / n) * (s / n), 0) / (n - 1) AS var
  FROM {out}_s JOIN {out}_n USING ({', '.join(keys)}))"""
    else:
        mom = f"""{out}_m AS (SELECT g.gene_id, coalesce(s, 0) / n AS mean,
  greatest(coalesce(q, 0) - n * (coalesce(s, 0) / n) * (coalesce(s, 0) / n), 0) / (n - 1) AS var
  FROM {genes} g LEFT JOIN {out}_s USING (gene_id) CROSS JOIN {out}_n)"""
    disp = f"""{out}_d AS (SELECT {k}gene_id, ln(1 + CASE WHEN mean = 0 THEN 1e-12 ELSE mean END) AS means,
  CASE WHEN var > 0 THEN ln(var / CASE WHEN mean = 0 THEN 1e-12 ELSE mean END) END AS dispersions FROM {out}_m)"""
    rng = f"""{out}_r AS (SELECT *, min(means) OVER ({part}) AS lo, max(means) OVER ({part}) AS hi FROM {out}_d)"""
    binned = f"""{out}_b AS (SELECT *, CASE WHEN hi = lo THEN 0 ELSE
  least(greatest(ceil((means - lo) / ((hi - lo) / {bins}.0)) - 1, 0), {bins - 1}) END AS mean_bin FROM {out}_r)"""
    stat = f"""{out}_t AS (SELECT *, avg(dispersions) OVER ({part_bin}) AS a, stddev_samp(dispersions) OVER ({part_bin}) AS d FROM {out}_b)"""
    norm = f"""{out}_z AS (SELECT {k}gene_id, means, dispersions, CASE WHEN d IS NULL THEN
    CASE WHEN abs(a) > 1e-12 THEN round(dispersions / a, 9) END ELSE CASE WHEN d > 1e-12 THEN round((dispersions - a) / d, 9) END END AS dispersions_norm FROM {out}_t)"""
    rank = f"""{out}_k AS (SELECT *, row_number() OVER ({part} ORDER BY dispersions_norm DESC NULLS LAST) AS nth,
  count(dispersions_norm) OVER ({part}) AS known FROM {out}_z)"""
    cut = f"""{out}_c AS (SELECT *, max(CASE WHEN nth = least({n}, known) THEN dispersions_norm END) OVER ({part}) AS cut FROM {out}_k)"""
    name = f"{out}_f" if batch else out
    flag = f"""{name} AS (SELECT {k}gene_id, means, dispersions, dispersions_norm,
  coalesce(coalesce(dispersions_norm, 0) >= cut, false) AS highly_variable FROM {out}_c)"""
    parts = [size, sums, mom, disp, rng, binned, stat, norm, rank, cut, flag]
    if batch:
        kb = _comma(by)
        parts.append(f"{out}_nb AS (SELECT {kb}count(DISTINCT {batch}) AS nb FROM {cells} {'GROUP BY ' + ', '.join(by) if by else ''})")
        parts.append(f"""{out}_p AS (SELECT {kb}gene_id, sum(means) AS m, sum(dispersions_norm) AS s,
  count(*) FILTER (WHERE dispersions_norm IS NULL) AS nul, count(*) FILTER (WHERE highly_variable) AS nbatches
  FROM {name} GROUP BY {kb}gene_id)""")
        src_rows = (f"{out}_p JOIN {out}_nb USING ({', '.join(by)})" if by else
                    f"(SELECT gene_id FROM {genes}) LEFT JOIN {out}_p USING (gene_id) CROSS JOIN {out}_nb")
        parts.append(f"""{out}_q AS (SELECT {kb}gene_id, coalesce(m, 0) / nb AS means,
  CASE WHEN nb > coalesce(nul, 0) THEN coalesce(s, 0) / (nb - coalesce(nul, 0)) END AS dispersions_norm,
  coalesce(nbatches, 0) AS highly_variable_nbatches FROM {src_rows})""")
        pb = f"PARTITION BY {', '.join(by)}" if by else ""
        parts.append(f"""{out} AS (SELECT q.*, row_number() OVER ({pb} ORDER BY highly_variable_nbatches DESC,
  dispersions_norm DESC NULLS LAST, pos) <= {n} AS highly_variable FROM {out}_q q JOIN {genes} USING (gene_id))""")
    return ",\n".join(parts)


FAMILY_SQL = {"mt": "family = 'Brand#1'", "ribo": "starts_with(family, 'Brand#2')", "hb": "family = 'Brand#3'"}


def families() -> dict:
    """Gene families of the star schema: brands stand in for the symbol patterns."""
    return {"mt": F.col("family") == "Brand#1", "ribo": F.col("family").startswith("Brand#2"), "hb": F.col("family") == "Brand#3"}


def qc_ctes(src: str = "counts", cells: str = "cells", genes: str = "genes", out: str = "qc", carry: str = "batch") -> str:
    fam_sum = ", ".join(f"sum(CASE WHEN {p} THEN value ELSE 0 END) AS f_{f}" for f, p in FAMILY_SQL.items())
    fam_out = ", ".join(f"coalesce(f_{f}, 0) AS total_counts_{f}" for f in FAMILY_SQL)
    pct = ", ".join(f"coalesce(CASE WHEN t <> 0 THEN f_{f} / t * 100 END, 0) AS pct_counts_{f}" for f in FAMILY_SQL)
    return f"""{out}_e AS (SELECT e.*, g.family, row_number() OVER (PARTITION BY cell_id ORDER BY value DESC) AS r
  FROM {src} e JOIN {genes} g USING (gene_id)),
{out}_a AS (SELECT cell_id, count(*) FILTER (WHERE value <> 0) AS n, sum(value) AS t, sum(CASE WHEN r <= 3 THEN value ELSE 0 END) AS top,
  {fam_sum} FROM {out}_e GROUP BY cell_id),
{out} AS (SELECT c.cell_id, {carry}, coalesce(n, 0) AS n_genes_by_counts, coalesce(t, 0) AS total_counts, {fam_out}, {pct},
  coalesce(CASE WHEN t <> 0 THEN top / t * 100 END, 0) AS pct_counts_in_top_3_genes,
  ln(1 + coalesce(n, 0)) AS log1p_n_genes_by_counts, ln(1 + coalesce(t, 0)) AS log1p_total_counts
  FROM {cells} c LEFT JOIN {out}_a USING (cell_id))"""


def outlier_ctes(src: str = "qc", out: str = "judged", by: str | None = None) -> str:
    p = f"PARTITION BY {by}" if by else ""
    cols = {"log1p_total_counts": 5, "log1p_n_genes_by_counts": 5, "pct_counts_in_top_3_genes": 5, "pct_counts_mt": 3}
    med = ", ".join(f"median({c}) OVER ({p}) AS med_{c}" for c in cols)
    mad = ", ".join(f"median(abs({c} - med_{c})) OVER ({p}) AS mad_{c}" for c in cols)

    def out_of(c: str) -> str:
        return f"({c} < med_{c} - {cols[c]} * mad_{c} OR {c} > med_{c} + {cols[c]} * mad_{c})"

    main = " OR ".join(out_of(c) for c in list(cols)[:3])
    return f"""{out}_1 AS (SELECT *, {med} FROM {src}),
{out}_2 AS (SELECT *, {mad} FROM {out}_1),
{out} AS (SELECT *, ({main}) AS outlier, ({out_of('pct_counts_mt')} OR pct_counts_mt > 8) AS mt_outlier FROM {out}_2)"""


def mixture_ctes(src: str, x: str, by: str, out: str = "em") -> list[str]:
    """Two components per group of ``src`` by 100 rounds at most; ``<out>_fit`` has a row per group, ``<out>_split`` each row's split."""
    def dens(k: int, z: str = "z") -> str:
        return f"(ln(w{k}) - 0.5 * ln(2 * pi() * v{k}) - ({z} - m{k}) * ({z} - m{k}) / (2 * v{k}))"

    def sums(r: str) -> str:
        return ", ".join(f"sum({w}) AS n{k}, sum(({w}) * z) AS s{k}, sum(({w}) * z * z) AS q{k}" for k, w in ((0, f"1 - ({r})"), (1, r)))

    def best() -> str:
        return ", ".join(f"s{k} / (n{k} + 2.220446049250313e-15) AS m{k}, greatest(q{k} / (n{k} + 2.220446049250313e-15) - (s{k} / (n{k} + 2.220446049250313e-15)) ** 2, 0) + 1e-6 AS v{k}, "
                         f"greatest((n{k} + 2.220446049250313e-15) / (n0 + n1), 1e-300) AS w{k}" for k in (0, 1))
    logsum = f"(greatest({dens(0)}, {dens(1)}) + ln(1 + exp(-abs({dens(0)} - {dens(1)}))))"
    return [
        f"""{out}_g AS (SELECT {by} AS g, count({x}) AS n, count(DISTINCT {x}) AS kinds, avg({x}) AS center, var_pop({x}) AS spread
  FROM {src} WHERE {x} IS NOT NULL GROUP BY 1)""",
        f"{out}_z AS MATERIALIZED (SELECT g, {x} - center AS z FROM {src} JOIN {out}_g ON g = {by} WHERE {x} IS NOT NULL)",
        f"""{out}(t, g, m0, v0, w0, m1, v1, w1, ll, done) AS (
  SELECT 0, g, {best()}, -1e300, false FROM (SELECT g, {sums("CASE WHEN z > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END")} FROM {out}_z GROUP BY g)
  UNION ALL SELECT t + 1, g, {best()}, new, abs(new - old) < 1e-3 FROM (SELECT t, g, any_value(ll) AS old, avg({logsum}) AS new,
    {sums(f"1 / (1 + exp({dens(0)} - {dens(1)}))")} FROM {out} JOIN {out}_z USING (g) WHERE NOT done AND t < 100 GROUP BY t, g))""",
        f"{out}_end AS (SELECT * FROM {out} QUALIFY row_number() OVER (PARTITION BY g ORDER BY t DESC) = 1)",
        f"""{out}_fit AS (SELECT e.*, n, center, kinds > 1 AND 5 * ln(n) - 2 * ll2 < 2 * ln(n) + n * ln(2 * pi() * (spread + 1e-6)) + n * spread / (spread + 1e-6) AS bimodal
  FROM {out}_end e JOIN {out}_g USING (g) JOIN (SELECT g, sum({logsum}) AS ll2 FROM {out}_end JOIN {out}_z USING (g) GROUP BY g) USING (g))""",
        f"""{out}_split AS (SELECT c.*, CASE WHEN NOT coalesce(bimodal, false) THEN 'all' WHEN
    (CASE WHEN m0 <= m1 THEN {dens(0, f"({x} - center)")} ELSE {dens(1, f"({x} - center)")} END) >= (CASE WHEN m0 <= m1 THEN {dens(1, f"({x} - center)")} ELSE {dens(0, f"({x} - center)")} END)
    THEN 'low_{x}' ELSE 'high_{x}' END AS bimodal_split
  FROM {src} c LEFT JOIN {out}_fit ON g = {by} WHERE NOT coalesce(bimodal, false) OR {x} IS NOT NULL)"""]
