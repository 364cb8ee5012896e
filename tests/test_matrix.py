from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from atlasloom.functions.genes import family_flags
from atlasloom.model import Atlas, scoped
from atlasloom.operators import edits, embeddings, filters, normalise, predicates, quality, reports, variable_genes
from atlasloom.plans import preprocess


def atlas_of(spark, x, batch=None, extra=None):
    n, m = x.shape
    cells = [(i, i, str(batch[i]) if batch is not None else "b", *(e[i] for e in (extra or {}).values())) for i in range(n)]
    cols = ["cell_id", "ord", "batch", *(extra or {})]
    genes = [(j, j, f"gene{j}") for j in range(m)]
    counts = [(i, j, float(x[i, j])) for i in range(n) for j in range(m) if x[i, j] != 0]
    return Atlas(
        spark.createDataFrame(cells, cols), spark.createDataFrame(genes, "gene_id long, pos long, gene_name string"),
        spark.createDataFrame(counts, "cell_id long, gene_id long, value double"))


def poisson(n, m, seed=0, half=True):
    rng = np.random.default_rng(seed)
    x = rng.poisson(1, (n, m)).astype(float)
    if half:
        x[rng.random((n, m)) < 0.5] = 0
    return x


def test_raw_counts_chosen(spark):
    raw = np.array([[1, 0], [5, 0], [0, 10]], float)
    a = atlas_of(spark, raw)
    out = normalise.ensure_raw_counts(a)
    assert {r.layer for r in out.layers.select("layer").distinct().collect()} == {"counts"}
    half = a.with_(counts=a.counts.withColumn("value", F.col("value") + 0.5))
    with pytest.raises(ValueError):
        normalise.ensure_raw_counts(half)
    assert normalise.ensure_raw_counts(half, raise_on_missing=False) is half
    stored = half.with_(layers=a.counts.select(F.lit("soup").alias("layer"), "*"))
    got = normalise.ensure_raw_counts(stored, layer="soup")
    assert sorted(r.value for r in got.counts.collect()) == [1, 5, 10]


def test_predicates_count_implicit_zeros(spark):
    x = np.zeros((20, 20))
    x[0, 0] = 0.5  # one of 400 entries: a quarter of a percent
    a = atlas_of(spark, x)
    r = predicates.raw_count_check(a.counts, a.cells, a.genes).first()
    assert r.noninteger_fraction == pytest.approx(1 / 400) and r.is_raw_counts
    neg = a.counts.withColumn("value", F.lit(-1.0))
    assert not predicates.raw_count_check(neg, a.cells, a.genes).first().is_raw_counts
    sums = predicates.normalised_check(atlas_of(spark, np.full((5, 3), 2.0)).counts, atlas_of(spark, np.full((5, 3), 2.0)).cells).first()
    assert sums.is_normalised and sums.ratio == pytest.approx(0)


def test_general_filters(spark):
    x = poisson(50, 60)
    s = preprocess.Settings(min_cells=10, min_genes=5, n_top_genes=20)
    out = preprocess.general(atlas_of(spark, x), s)
    genes = {r.gene_id for r in out.counts.select("gene_id").distinct().collect()}
    want_genes = {j for j in range(60) if (x[:, j] > 0).sum() >= 10}
    want_cells = {i for i in range(50) if (x[i, sorted(want_genes)] > 0).sum() >= 5}
    assert genes == want_genes and {r.cell_id for r in out.cells.collect()} == want_cells
    assert out.genes.filter("highly_variable").count() >= 20
    with pytest.raises(ValueError):
        preprocess.general(atlas_of(spark, x), preprocess.Settings(min_cells=10, min_genes=1000))
    with pytest.raises(ValueError):
        preprocess.Settings(min_cells=0)


def seurat_scores(x, n_top, bins=20):
    """The published formula on a dense matrix of log values."""
    lin = np.expm1(x)
    mean, var = lin.mean(0), lin.var(0, ddof=1)
    mean = np.where(mean == 0, 1e-12, mean)
    with np.errstate(divide="ignore", invalid="ignore"):
        disp = np.where(var > 0, np.log(var / mean), np.nan)
    mean = np.log1p(mean)
    edges = np.linspace(mean.min(), mean.max(), bins + 1)
    edges[0] -= 0.001 * (mean.max() - mean.min())
    which = np.clip(np.searchsorted(edges, mean, side="left") - 1, 0, bins - 1)
    norm = np.full(len(mean), np.nan)
    for b in set(which):
        d = disp[which == b]
        ok = d[~np.isnan(d)]
        avg, dev = (ok.mean(), ok.std(ddof=1)) if len(ok) > 1 else (0.0, ok[0] if len(ok) else np.nan)
        norm[which == b] = (d - avg) / dev if dev > 1e-12 or len(ok) == 1 else np.nan  # equal values: no spread to divide by
    norm = np.round(norm, 9)
    cut = np.sort(norm[~np.isnan(norm)])[::-1][min(n_top, (~np.isnan(norm)).sum()) - 1]
    return norm, np.nan_to_num(norm) >= cut


def test_variable_genes_by_formula(spark):
    x = np.log1p(poisson(30, 100))
    a = atlas_of(spark, x)
    got = variable_genes.variable_genes(a.counts, a.cells, a.genes, 25).orderBy("pos").collect()
    norm, marks = seurat_scores(x, 25)
    assert np.allclose([np.nan if r.dispersions_norm is None else r.dispersions_norm for r in got], norm, equal_nan=True)
    assert [r.highly_variable for r in got] == list(marks)


def test_six_genes_by_hand(spark):
    x = np.log1p(np.array([[1, 0, 4, 2, 0, 10], [1, 3, 0, 2, 0, 0], [1, 0, 2, 8, 0, 0], [1, 1, 2, 0, 0, 0]], float))
    got = {r.gene_id: r for r in variable_genes.variable_genes(
        *(lambda a: (a.counts, a.cells, a.genes))(atlas_of(spark, x)), n_top=2).collect()}
    assert got[0].dispersions is None and got[4].dispersions is None  # constant; never seen
    assert got[5].dispersions == pytest.approx(np.log(25 / 2.5)) and got[5].means == pytest.approx(np.log1p(2.5))
    assert got[2].dispersions == pytest.approx(np.log((8 / 3) / 2))


def test_variable_genes_by_batch(spark):
    x, batch = np.log1p(poisson(40, 300, 3)), np.array(["a"] * 25 + ["b"] * 15)
    x[batch == "b", :5] = 0  # not seen in one batch: that batch adds a score of zero
    a = atlas_of(spark, x, batch)
    counts = a.counts.join(a.cells.select("cell_id", "batch"), "cell_id")
    got = variable_genes.variable_genes(counts, a.cells, a.genes, 20, batch="batch").orderBy("pos").collect()
    total, times = np.zeros((2, 300)), np.zeros(300, int)
    for k, b in enumerate("ab"):
        seen = (x[batch == b] > 0).any(0)
        norm, marks = seurat_scores(x[batch == b][:, seen], 20)
        total[k, seen], times[seen] = norm, times[seen] + marks
    mean = np.nanmean(total, axis=0)
    assert np.allclose([r.dispersions_norm for r in got], mean)
    assert [r.highly_variable_nbatches for r in got] == list(times)
    order = sorted(range(300), key=lambda j: (-times[j], -mean[j], j))[:20]
    assert {r.gene_id for r in got if r.highly_variable} == set(order)


def test_infinite_values_go_with_their_gene(spark):
    x = poisson(30, 40)
    a = atlas_of(spark, x)
    a = a.with_(counts=a.counts.withColumn("value", F.when((F.col("gene_id") == 3) & (F.col("cell_id") < 5), float("inf")).otherwise(F.col("value"))))
    assert 3 not in {r.gene_id for r in filters.drop_nonfinite_genes(a.counts).select("gene_id").distinct().collect()}


@pytest.mark.parametrize("n", [1, 2, 1000, 30_000])
def test_medians_agree(spark, n):
    rng = np.random.default_rng(n)
    rows = [("hot" if rng.random() < 0.6 else "cold", float(v), float(w)) for v, w in zip(rng.lognormal(0, 3, n), rng.integers(0, 3, n))]
    df = spark.createDataFrame([*rows, ("cold", 1.0, 1.0), ("hot", 2.0, 5.0)], "g string, v double, w double")
    for by in ([], ["g"]):
        a = sorted(quality.medians(df, ["v", "w"], by, "percentile").collect())
        assert a == sorted(quality.medians(df, ["v", "w"], by, "bracket").collect())
    assert quality.medians(df, ["v"]).first()[0] == pytest.approx(np.median([r[1] for r in [*rows, ("", 1.0), ("", 2.0)]]))


def test_cell_without_entries_has_zeros(spark):
    a = atlas_of(spark, np.array([[1.0, 3.0], [0, 0]]))
    m = {r.cell_id: r for r in quality.cell_metrics(a.counts, a.cells, a.genes, percent_top=(1,)).collect()}
    assert m[1].total_counts == 0 and m[1].pct_counts_in_top_1_genes == 0 and m[1].pct_counts_mt == 0
    assert m[0].pct_counts_in_top_1_genes == 75 and m[0].log1p_total_counts == pytest.approx(np.log(5))


def test_top_share_is_capped_at_one_less_than_the_genes(spark):
    a = atlas_of(spark, poisson(5, 4, half=False))
    assert "pct_counts_in_top_3_genes" in quality.cell_metrics(a.counts, a.cells, a.genes, percent_top=(20,)).columns


def test_families(spark):
    names = ["MT-CO1", "mt-nd1", "RPS6", "Rpl3", "HBA1", "HBP1", "hbb", "ACTB", None]
    df = spark.createDataFrame([(n,) for n in names], "s string")
    got = [(r.mt, r.ribo, r.hb) for r in df.select(*[e.alias(k) for k, e in family_flags("s").items()]).collect()]
    t, f = True, False
    assert got == [(t, f, f), (t, f, f), (f, t, f), (f, t, f), (f, f, t), (f, f, f), (f, f, t), (f, f, f), (f, f, f)]


def test_rare_categories(spark):
    names = ["common"] * 95 + [f"rare{i}" for i in range(5)]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "cell_id long, rare_category string")
    renamed = edits.consolidate_categories(df, "rare_category", 10)
    assert {(r.rare_category, r["count"]) for r in renamed.groupBy("rare_category").count().collect()} == {
        ("common", 95), ("remaining rare_category", 5)}
    assert edits.consolidate_categories(df, ["rare_category", "absent"], 10, remove=True).count() == 95


def test_scaling(spark):
    a = atlas_of(spark, np.array([[1.0, 3.0], [0, 0], [5, 5]]))
    got = {(r.cell_id, r.gene_id): r.value for r in normalise.log_normalise(a.counts).collect()}
    assert got[(0, 1)] == pytest.approx(np.log1p(7500)) and got[(2, 0)] == pytest.approx(np.log1p(5000))
    with pytest.raises(ValueError):
        normalise.log_normalise(a.counts, mode="maybe")


def test_panel_vectors_order_and_zeros(spark):
    a = atlas_of(spark, np.array([[1.0, 2.0, 3.0], [0, 0, 4.0]]))
    panel = spark.createDataFrame([(2, 0), (99, 1), (0, 2)], "gene_id long, slot int")
    got = {r.cell_id: r.vector for r in embeddings.panel_vectors(a.counts, a.cells, panel, "X_gs").collect()}
    assert got == {0: [3.0, 0.0, 1.0], 1: [4.0, 0.0, 0.0]}
    with pytest.raises(ValueError):
        embeddings.panel_vectors(a.counts, a.cells, panel.filter("gene_id = 99"), "X_gs")


@pytest.mark.parametrize("scale", [True, False])
def test_components_agree_with_numpy(spark, scale):
    x = np.log1p(poisson(60, 8, 5))
    x[:, 0] *= 4
    a = atlas_of(spark, x)
    load, _ = embeddings.fit_components(a.counts, a.cells, a.genes, 3, scale=scale)
    got = np.array([r.vector for r in embeddings.apply_components(a.counts, a.cells, load).orderBy("cell_id").collect()])
    y = (x - x.mean(0)) / (x.std(0) if scale else 1.0)
    u, s, vt = np.linalg.svd(y - y.mean(0), full_matrices=False)
    assert np.allclose(np.abs(got), np.abs(y @ vt[:3].T), atol=1e-4)


def test_hvg_embedding_uses_marks(spark):
    x = np.log1p(poisson(30, 50))
    a = atlas_of(spark, x)
    marked = a.with_(genes=variable_genes.variable_genes(a.counts, a.cells, a.genes, 20))
    out = embeddings.embed(marked, "hvg", n=15)
    assert out.count() == 30 and {len(r.vector) for r in out.collect()} == {15} and out.first().key == "X_hvg"
    with pytest.raises(ValueError):
        embeddings.embed(a, "unheard of")


def test_histogram_bins(spark):
    df = spark.createDataFrame([(float(i % 4),) for i in range(100)] + [(float("nan"),), (float("inf"),), (None,)], "v double")
    assert [(r.bin, r.n) for r in reports.histogram(df, "v").orderBy("bin").collect()] == [(0, 25), (1, 25), (2, 25), (3, 25)]
    assert reports.histogram(df.filter("v = 1"), "v").count() == 0


def test_preprocess_with_descriptions(spark):
    rng = np.random.default_rng(1)
    x = rng.poisson(2, (80, 30)).astype(float)
    a = atlas_of(spark, x, ["a", "b"] * 40, {"instrument": ["seq"] * 80, "description": ["a cell"] * 80, "empty": [None] * 79 + ["x"]})
    s = preprocess.Settings(min_cells=2, min_genes=2, n_top_genes=10, batch="batch", instrument="instrument", description="description", percent_top=(5,))
    out = preprocess.preprocess(a, s)
    assert out.cells.first().description == "This measurement was conducted with seq. a cell"
    assert "counts" in {r.layer for r in out.layers.select("layer").distinct().collect()}
    top = out.counts.agg(F.max("value"), F.min("value")).first()
    assert 0 <= top[1] and top[0] < 100


def test_results_do_not_depend_on_partitions(spark):
    x = poisson(50, 40, 9)
    a = atlas_of(spark, x)
    runs = []
    for n in (1, 7):
        b = a.with_(cells=a.cells.repartition(n), counts=a.counts.repartition(n), genes=a.genes.repartition(n))
        runs.append(sorted(map(tuple, preprocess.general(b, preprocess.Settings(min_cells=5, min_genes=3, n_top_genes=10)).genes.select(
            "gene_id", "highly_variable").collect())))
    assert runs[0] == runs[1]


def test_components_converge_below_full_width(spark):
    """A panel wider than the iterated subspace: components agree with a full decomposition."""
    rng = np.random.default_rng(5)
    x = np.maximum(0, rng.normal(size=(400, 4)) @ (rng.normal(size=(4, 120)) * np.array([8, 5, 3, 2])[:, None]) + rng.normal(size=(400, 120)) * 0.3)
    a = atlas_of(spark, x)
    load, meta = embeddings.fit_components(a.counts, a.cells, a.genes, 3, scale=False)
    w = np.array([r.components for r in load.join(a.genes, "gene_id").orderBy("pos").collect()])
    s, vt = np.linalg.svd(x - x.mean(0), full_matrices=False)[1:]
    assert np.allclose(w.T @ w, np.eye(3), atol=1e-8)
    assert np.allclose(np.abs(w.T @ vt[:3].T), np.eye(3), atol=1e-4)
    import json

    got = json.loads(meta.first()[0])["explained_variance_ratio"]
    assert np.allclose(got, (s**2 / (s**2).sum())[:3], atol=1e-6)


def test_a_gene_goes_only_where_it_is_not_finite(spark):
    from atlasloom.plans.preprocess import _without_pairs

    df = spark.createDataFrame([("a", 1, 1.0), ("b", 1, 2.0), (None, 1, 3.0), ("a", 2, 4.0)], "part string, gene_id long, value double")
    bad = spark.createDataFrame([("a", 1), (None, 1)], "part string, gene_id long")
    assert sorted(r.value for r in _without_pairs(df, bad, ["part", "gene_id"]).collect()) == [2.0, 4.0]


def test_quantiles_keep_groups_of_nulls(spark):
    from atlasloom.operators.quality import quantiles

    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None), (None, 5.0)], "g string, v double")
    got = {r.g: r.m for r in quantiles(df, {"m": ("v", 0.5)}, "g").collect()}
    assert got == {"a": 2.0, "b": None, None: 5.0}


def test_groups_merge_to_one_row_per_gene(spark):
    from atlasloom.operators.setops import merge_group_genes

    rows = spark.createDataFrame(
        [("a", "g1", 0, 1.0, True), ("b", "g1", 0, None, False), ("a", "g2", 1, None, True), (None, "g3", 2, 3.0, False)],
        "chunk string, gene_id string, pos long, score double, highly_variable boolean")
    got = {r["gene_id"]: (r["pos"], r["score"], r["highly_variable"]) for r in merge_group_genes(rows, ["chunk"]).collect()}
    assert got == {"g1": (0, 1.0, False), "g2": (1, None, True), "g3": (2, 3.0, False)}
    assert merge_group_genes(rows.filter("false"), ["chunk"]).isEmpty()


def test_no_group_of_genes_passes_through_one_task(spark, monkeypatch):
    """Cut-offs, marks and ties as by one window per batch, but no window holds a whole batch's genes."""
    monkeypatch.setattr(variable_genes, "SLICES", 3)
    cells = spark.createDataFrame([(i, i, "a" if i < 6 else "b") for i in range(12)], "cell_id int, ord int, batch string")
    genes = spark.createDataFrame([(g, g // 2, f"g{g}") for g in range(40)], "gene_id int, pos int, gene_name string")  # places repeat
    counts = spark.createDataFrame([(c, g, float((c * 7 + g % 10 * 5) % 11 + 1)) for c in range(12) for g in range(40) if (c + g) % 3],
                                   "cell_id int, gene_id int, value double")
    plans = []
    settle = variable_genes.settle
    monkeypatch.setattr(variable_genes, "settle", lambda df: plans.append(df._jdf.queryExecution().toString()) or settle(df))
    out = variable_genes.variable_genes(scoped(counts, cells, ["batch"]), cells, genes, 7, batch="batch")
    got = out.collect()
    assert len(got) == 40 and sum(r.highly_variable for r in got) == 7
    key = [(-r.highly_variable_nbatches, r.dispersions_norm is None, -(r.dispersions_norm or 0.0), r.pos, not r.highly_variable) for r in got]
    assert [k[-1] for k in sorted(key)] == [False] * 7 + [True] * 33
    assert len(plans) == 3 and all("windowspecdefinition" not in p or "_slice" in p for p in plans)
    one = variable_genes.variable_genes(counts, cells, genes, 5).collect()
    norms = sorted((r.dispersions_norm for r in one if r.dispersions_norm is not None), reverse=True)
    assert {r.gene_id for r in one if r.highly_variable} == {r.gene_id for r in one if (r.dispersions_norm or 0.0) >= norms[4]}
