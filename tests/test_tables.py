from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from atlasloom.functions import text
from atlasloom.functions.ids import stable_numeric_id, strip_version
from atlasloom.model import Atlas
from atlasloom.operators import chunks, edits, embeddings, lookups, mixtures, panel, predicates, ranking, sentences, setops, subsets, terms, verify
from atlasloom.sources import matrix, ontology, tables


def batches(spark, sizes):
    rows, i = [], 0
    for name, n in sizes:
        for _ in range(n):
            rows.append((i, i, name))
            i += 1
    return spark.createDataFrame(rows, "cell_id long, ord long, batch string").repartition(5)


def test_batches_stay_whole(spark):
    cells = batches(spark, [("A", 10), ("B", 12), ("C", 8)])
    out = chunks.chunk_by_batch(cells, 15)
    assert [r["count"] for r in out.groupBy("chunk_id").count().orderBy("chunk_id").collect()] == [10, 12, 8]
    assert out.groupBy("batch").agg(F.count_distinct("chunk_id").alias("n")).filter("n > 1").isEmpty()
    assert chunks.first_chunks(out, 1).count() == 10
    big = chunks.chunk_by_batch(batches(spark, [("A", 5), ("B", 40), ("C", 5), ("D", 5)]), 12)
    assert {r.batch: r.chunk_id for r in big.select("batch", "chunk_id").distinct().collect()} == {"A": 0, "B": 1, "C": 2, "D": 2}
    with pytest.raises(ValueError):
        chunks.chunk_by_batch(cells, 15, batch="absent")


@pytest.mark.parametrize("size", [7, 30, 100])
def test_random_chunks_hold_every_cell_once(spark, size):
    out = chunks.assign_chunks(batches(spark, [("A", 30)]), size, "batch", random=True)
    n = [r["count"] for r in out.groupBy("chunk_id").count().orderBy("chunk_id").collect()]
    assert sum(n) == 30 and out.select("cell_id").distinct().count() == 30 and all(k == size for k in n[:-1])


def test_positions_in_skewed_groups(spark):
    rng = np.random.default_rng(0)
    ords = [int(v) for v in np.unique(rng.lognormal(5, 4, 500).astype("int64"))]
    df = spark.createDataFrame([(o, "hot" if k % 3 else f"g{k}") for k, o in enumerate(ords)], "ord long, g string").repartition(6)
    got = {r.ord: r.sample_index for r in ranking.row_index(df, "ord").collect()}
    assert got == {o: i for i, o in enumerate(ords)}
    by = {(r.g, r.sample_index) for r in ranking.row_index(df, "ord", by="g").collect()}
    assert len(by) == len(ords)
    hot_places = sorted(i for g, i in by if g == "hot")
    assert hot_places == list(range(len(hot_places))) and all(i == 0 for g, i in by if g != "hot")
    for keys in ([], ["g"]):
        every = ranking.hash_rank(df, "ord", 7, by=keys).collect()
        for g in {r.g for r in every} if keys else {None}:
            own = [r.ord for r in sorted(every, key=lambda r: r.rank) if not keys or r.g == g]
            assert own == sorted(own, key=lambda o: (hashlib.md5(f"7:{o}".encode()).hexdigest(), o))
        assert sorted(ranking.hash_rank(df, "ord", 7, by=keys, first=40).collect()) == sorted(r for r in every if r.rank <= 40)
    nxt = {r.ord: r.nxt for r in ranking.next_in_group(df.withColumn("s", F.col("ord").cast("string")), "s", "g", "ord", "nxt", block=16).collect()}
    hot = [o for k, o in enumerate(ords) if k % 3]
    assert all(nxt[o] == str(hot[(i + 1) % len(hot)]) for i, o in enumerate(hot)) and nxt[ords[0]] == str(ords[0])


def test_positions_spread_evenly(spark):
    """One far position and a group of two fifths of the rows leave no task with more than twice the mean."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(20_000).select(
            F.when(F.col("id") == 19_999, F.lit(10**15)).otherwise(F.col("id")).alias("ord"),
            F.when(F.col("id") % 5 < 2, "hot").when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id").cast("string")).alias("g"))
        for out in (ranking.row_index(df, "ord"), ranking.row_index(df, "ord", by="g"), ranking.hash_rank(df, "ord", 1, "sample_index", "g")):
            sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == 20_000 and max(sizes) <= 2 * 20_000 / 4
            assert out.groupBy("g").agg(F.count_distinct("sample_index").alias("d"), F.count("*").alias("n")).filter("d <> n").isEmpty()
        nxt = ranking.next_in_group(df, "ord", "g", "ord", "nxt", block=500)
        assert nxt.groupBy("g").agg(F.sum("ord").alias("a"), F.sum("nxt").alias("b"), F.count_distinct("nxt").alias("d"), F.count("*").alias("n")).filter("a <> b OR d <> n").isEmpty()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_positions_of_nothing(spark):
    none = spark.createDataFrame([], "ord long, g string")
    assert ranking.row_index(none, "ord", by="g").isEmpty() and ranking.hash_rank(none, "ord", 1, by="g", first=3).isEmpty()
    assert ranking.next_in_group(none, "g", "g", "ord", "nxt").isEmpty()


def test_strata(spark):
    cells = batches(spark, [("A", 70), ("B", 29), ("C", 1)])
    got = {r.batch: r["count"] for r in subsets.stratified_subset(cells, 10, ["batch"]).groupBy("batch").count().collect()}
    assert sum(got.values()) == 10 and got["A"] in (6, 7)
    assert subsets.stratified_subset(cells, 10, ["absent"]).count() == 10
    assert subsets.random_subset(cells, 1000).count() == 100


def test_split_sizes(spark):
    out = chunks.split_at_random(batches(spark, [("A", 15), ("B", 9)]), 0.9, by="batch")
    got = {(r.batch, r.split): r["count"] for r in out.groupBy("batch", "split").count().collect()}
    assert got == {("A", "train"): 13, ("A", "val"): 2, ("B", "train"): 8, ("B", "val"): 1}
    with pytest.raises(ValueError):
        chunks.split_at_random(batches(spark, [("A", 2)]), 1.0)


def test_versions_and_numeric_ids(spark):

    ids = [f"ENSG00000{i}.{i % 4}" for i in range(10)]
    df = spark.createDataFrame([(i,) for i in ids], "g string")
    assert [r[0] for r in df.select(strip_version("g")).collect()] == [i.split(".")[0] for i in ids]
    assert [r[0] for r in df.select(stable_numeric_id("g")).collect()] == [
        int.from_bytes(hashlib.md5(i.encode()).digest()[:4], "big") for i in ids]


def test_accession_tolerance(spark):
    def check(values):
        df = spark.createDataFrame([(v,) for v in values], "x string")
        kept, ok = predicates.accession_check(df, {"x": predicates.EXPERIMENT_ACCESSION})
        return kept.count(), ok

    assert check(["SRX1", "SRX2", "SRX3", "INVALID", "SRX5"]) == (4, True)
    assert check(["SRX1", "SRX2", "SRX3", "INVALID", None]) == (5, False)
    assert check(["a", "b"]) == (2, False)
    assert predicates.accession_check(spark.range(1), {"x": "a"})[1] is False


def test_enrichment(spark):
    cells = spark.createDataFrame([(i, f"SRS{i}", f"SRX{i}") for i in range(1, 5)], "cell_id long, accession string, experiment_accession string")
    lookup = spark.createDataFrame([("SRX1", "a1"), ("SRX2", "a2"), ("SRX2", "z"), ("SRX9", "x")], "experiment_accession string, a string")
    out = {r.cell_id: (r.a, r.b) for r in lookups.enrich_accessions(cells, lookup, ["a", "b"]).collect()}
    assert out == {1: ("a1", "unknown"), 2: ("a2", "unknown"), 3: ("unknown", "unknown"), 4: ("unknown", "unknown")}
    with pytest.raises(ValueError):
        lookups.enrich_accessions(cells, None, ["a"])
    assert lookups.enrich_accessions(cells, None, ["a"], skip=True) is cells
    diff = {(r.id, r.side) for r in lookups.id_differences(cells, lookup, "experiment_accession").collect()}
    assert diff == {("SRX3", "missing"), ("SRX4", "missing"), ("SRX9", "extra")}


def test_sentences_fill_with_unexpressed_genes(spark):
    rng = np.random.default_rng(2)
    x = rng.poisson(0.6, (25, 12)).astype(float)
    x[3] = 0
    cells = spark.createDataFrame([(i, i, "ab"[i % 2]) for i in range(25)], "cell_id long, ord long, kind string")
    genes = spark.createDataFrame([(j, j, f"g{j}", j != 4) for j in range(12)], "gene_id long, pos long, gene_name string, highly_variable boolean")
    counts = spark.createDataFrame([(i, j, float(x[i, j])) for i in range(25) for j in range(12) if x[i, j]], "cell_id long, gene_id long, value double")
    cols = [j for j in range(12) if j != 4]
    for k in (1, 5, 11, 20):
        got = {r.cell_id: r.cell_sentence for r in sentences.cell_sentences(counts, cells, genes, k, "kind").collect()}
        for i in range(25):
            order = np.argsort(-x[i, cols], kind="stable")[:k]
            assert got[i] == " ".join(f"g{cols[j]}" for j in order)
    with pytest.raises(ValueError):
        sentences.cell_sentences(counts, cells, genes.drop("highly_variable"), 3)
    with pytest.raises(ValueError):
        sentences.cell_sentences(counts, cells, genes, 3, "absent")


def test_wordings():
    from atlasloom.functions.phrases import WITH_LABEL, WITHOUT_LABEL

    assert (len(WITH_LABEL), len(WITHOUT_LABEL)) == (40, 20)


def test_chosen_ids_and_texts(spark):
    df = spark.range(1)

    def one(c):
        return df.select(c.alias("x")).first().x

    hits = lambda *v: F.array(*[F.lit(x) for x in v])
    assert one(text.choose_gene_id(hits("ENSG1", "abc", "12"))) == "12"
    assert one(text.choose_gene_id(hits("ENSG1", "abc"))) == "abc"
    assert one(text.choose_gene_id(hits("ENSG1"))) is None
    assert one(text.clean_definition(F.lit("A  cell [PMID:1]\n of  [x] blood. "))) == "A cell of blood."
    assert one(text.strip_markup(F.lit(" <p>hello <b>you</b></p>\n"))) == "hello you"
    assert one(text.strip_markup(F.lit("<p></p>"))) is None
    abstract = "Short\nThis line is long enough to be kept\nThis one ends in a full stop and goes.\n  Another line that is long enough\nAuthor information\nA line after the stop that is long"
    assert one(text.abstract_definition(F.lit(abstract))) == "This line is long enough to be kept Another line that is long enough"
    assert one(text.clean_full_text(F.lit("a\n\n\nb  c.\nD"))) == "a b c. D"
    assert one(text.extract_section(F.lit("Abstract  some text\nmore\nMethods x"), "Abstract")) == "some text\nmore"
    assert one(text.whitespace_tokens(F.lit("  a b\n c "))) == 3


def test_anchor_pairs(spark):
    t = spark.createDataFrame([
        ("T cell", "a lymphocyte", "CL Ontology", "T-cell; ; T lymphocyte;a;b"), ("void", "  ", "CL Ontology", "x"), ("odd", "thing", "Mine", None)],
        "term string, description string, definition_source string, synonyms string")
    got = {(r.anchor, r.is_synonym, r.source_database) for r in terms.anchor_pairs(t).collect()}
    cl = "Cell Ontology (CL)"
    assert got == {("T cell", False, cl), ("T-cell", True, cl), ("T lymphocyte", True, cl), ("a", True, cl), ("odd", False, "Mine")}


def test_panel_scores(spark):
    rng = np.random.default_rng(4)
    x = rng.lognormal(1, 1, (30, 6)) * (rng.random((30, 6)) < 0.8)
    expr = spark.createDataFrame([(f"ENSG{g}", f"t{t}", float(x[g, t])) for g in range(30) for t in range(6) if x[g, t]], "Gene string, Tissue string, nTPM double")
    ann = spark.createDataFrame([(f"ENSG{g}.1", f"ENSG{g}", f"s{g // 2}", "protein_coding" if g % 5 else "rRNA") for g in range(30)],
                                "ensembl_gene_id string, ensembl_gene_id_novers string, gene_name string, gene_type string")
    keep = [g for g in range(30) if g % 5 and (x[g] >= 1).sum() >= 3]
    tau = [(1 - x[g] / x[g].max()).sum() / 5 for g in keep]
    z = lambda v: (np.array(v) - np.mean(v)) / (np.std(v) + 1e-9)
    score = 0.5 * z([x[g].var() for g in keep]) + 0.3 * z(tau) + 0.2 * z([x[g].mean() for g in keep])
    want = [keep[i] for i in np.argsort(-score)][:10]
    assert [r.ensembl_gene_id for r in panel.build_panel(ann, expr, 10, 3, 1.0).collect()] == [f"ENSG{g}.1" for g in want]
    marked = panel.build_panel(ann, expr, 10, 3, 1.0, markers=spark.createDataFrame([("s0",), ("s7",)], "symbol string"))
    names = [r.gene_name for r in marked.collect()]
    forced = {f"s{g // 2}" for g in keep} & {"s0", "s7"}
    assert len(set(names)) == len(names) and forced and set(names[:len(forced)]) == forced


def test_mixture(spark):
    rng = np.random.default_rng(0)
    v = np.concatenate([rng.normal(0, 1, 300), rng.normal(12, 1, 200)])
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(v)] + [(999, None)], "cell_id long, reads double")
    out, ok = mixtures.label_if_bimodal(df, "reads")
    assert ok and {(r.reads_label, r.n_cells) for r in mixtures.cluster_sizes(out, "reads_label").collect()} == {
        ("low_reads", 300), ("high_reads", 200), (None, 1)}
    flat = spark.createDataFrame([(i, float(x)) for i, x in enumerate(rng.normal(0, 1, 400))], "cell_id long, reads double")
    assert not mixtures.is_bimodal(flat, "reads")
    assert mixtures.label_if_bimodal(flat, "absent")[1] is False
    assert {r.bimodal_split for r in mixtures.split_if_bimodal(flat, "reads").collect()} == {"all"}


def test_vectors_aligned_and_verified(spark):
    cells = spark.createDataFrame([(1,), (2,), (3,)], "cell_id long")
    v = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 1.0]), (2, [5.0, 5.0])], "cell_id long, vector array<float>")
    got = {r.cell_id: r.vector for r in lookups.align_vectors(cells, v, 2).collect()}
    assert got == {1: [1.0, 2.0], 2: [0.0, 0.0], 3: [0.0, 0.0]}
    e = v.filter("cell_id = 1").withColumn("key", F.lit("X_a"))
    assert verify.embedding_failures(e, e).isEmpty()
    with pytest.raises(ValueError):
        lookups.merge_embeddings([e, e.withColumn("cell_id", F.lit(9).cast("long"))])
    with pytest.raises(ValueError):
        lookups.require_keys(e.withColumn("chunk_id", F.lit(0)), e.withColumn("chunk_id", F.lit(0)), ["X_a", "X_b"])


def test_ids_from_three_sources(spark):
    own = spark.createDataFrame([("ENSG1.2", 0), ("ENSG1.3", 1), ("other", 2)], "gene_id string, pos long")
    assert [r.gene_id for r in lookups.ensure_accession_ids(own).collect()] == ["ENSG1"]
    column = spark.createDataFrame([("a", 0, "ENSG5.1"), ("b", 1, None)], "gene_id string, pos long, ensembl_id string")
    assert [(r.gene_id, r.previous_index) for r in lookups.ensure_accession_ids(column).collect()] == [("ENSG5", "a")]
    with pytest.raises(ValueError):
        lookups.ensure_accession_ids(spark.createDataFrame([("a", 0)], "gene_id string, pos long"))


def test_gene_names_made_unique(spark):
    g = spark.createDataFrame([(0, 0, "x"), (1, 1, "x"), (2, 2, None), (3, 3, "x"), (4, 4, "y")], "gene_id long, pos long, gene_name string")
    out = edits.gene_id_from_column(g, "gene_name")
    assert {(r.gene_id, r.previous_index) for r in out.collect()} == {("x", 0), ("x_1", 1), ("x_2", 3), ("y", 4)}
    c = spark.createDataFrame([(1, 0, 1.0), (1, 2, 1.0), (1, 3, 2.0)], "cell_id long, gene_id long, value double")
    assert {(r.gene_id, r.value) for r in edits.relabel_genes(c, out).collect()} == {("x", 1.0), ("x_2", 2.0)}


def test_stable_genes(spark):
    rows = [("d1", "a", 1, True), ("d2", "a", 3, True), ("d1", "b", 2, True), ("d2", "c", 1, True), ("d1", "c", 9, False), ("d2", "b", 7, False)]
    r = spark.createDataFrame(rows, "dataset string, gene_id string, rank long, highly_variable boolean")
    assert [x.gene_id for x in setops.stable_genes(r, 2, 2).collect()] == ["a", "c"]
    s = setops.selection_summary(setops.stable_genes(r, 2, 2), r, 2).first()
    assert (s.final_gene_count, s.genes_from_intersection, s.genes_from_candidates, s.intersection_size) == (2, 1, 1, 1)


def test_added_column_must_fit(spark):
    cells = spark.createDataFrame([(1, 0), (2, 1)], "cell_id long, ord long")
    v = spark.createDataFrame([(1, "a"), (2, "b")], "cell_id long, x string")
    assert {(r.cell_id, r.x) for r in edits.add_column(cells, v, "x").collect()} == {(1, "a"), (2, "b")}
    with pytest.raises(ValueError):
        edits.add_column(cells, v.limit(1), "x")
    assert edits.add_column(cells, v, "ord") is cells


def test_one_key_is_replaced_alone(spark, tmp_path):
    e = spark.createDataFrame([(1, "X_a", [1.0]), (1, "X_b", [2.0])], "cell_id long, key string, vector array<float>")
    matrix.write_embeddings(e, str(tmp_path / "e"))
    matrix.write_embeddings(e.filter("key = 'X_b'").withColumn("vector", F.array(F.lit(9.0).cast("float"))), str(tmp_path / "e"))
    assert {(r.key, r.vector[0]) for r in spark.read.parquet(str(tmp_path / "e")).collect()} == {("X_a", 1.0), ("X_b", 9.0)}


def test_structure_is_checked(spark):
    ok = spark.createDataFrame([(1, 0)], "cell_id long, ord long")
    with pytest.raises(ValueError):
        Atlas(ok, ok, ok)
    genes = spark.createDataFrame([], "gene_id long, pos long")
    counts = spark.createDataFrame([], "cell_id long, gene_id long, value double")
    with pytest.raises(ValueError):
        matrix.check_structure(ok, genes, counts)
    with pytest.raises(ValueError):
        predicates.require_embedding_inputs(ok, genes)


def test_marker_and_expression_tables(spark, tmp_path):
    m = spark.createDataFrame([("A", "B, C;D"), (None, " E  F ")], "geneSymbol string, geneID string")
    assert {r.symbol for r in tables.marker_symbols(m).collect()} == set("ABCDEF")
    other = spark.createDataFrame([("x", "S1")], ["species", "Gene"])
    assert [r.symbol for r in tables.listed_symbols(other).collect()] == ["S1"]
    with pytest.raises(ValueError):
        tables.standard_expression(spark.createDataFrame([("a",)], ["gene"]))
    (tmp_path / "l.txt").write_text(" b \n\n\ta\n")
    assert [r.term for r in tables.read_list(spark, str(tmp_path / "l.txt")).orderBy("line").collect()] == ["b", "a"]


def test_ontology_graph(spark):
    doc = """{"graphs":[{"nodes":[{"id":"MONDO:1","lbl":"root","type":"CLASS"},{"id":"MONDO:2","lbl":"leaf","type":"CLASS",
      "meta":{"definition":{"val":"a leaf"},"synonyms":[{"val":"s"},{"val":""}],"xrefs":[{"val":"X:1"}]}},{"id":"GO:1","type":"CLASS"},
      {"id":"MONDO:3","type":"PROPERTY"}],"edges":[{"sub":"MONDO:2","pred":"is_a","obj":"MONDO:1"},{"sub":"MONDO:2","pred":"part_of","obj":"MONDO:9"}]}]}"""
    got = {r.term_id: r for r in ontology.graph_terms(spark.createDataFrame([(doc,)], "json string")).collect()}
    assert set(got) == {"MONDO:1", "MONDO:2"}
    assert (got["MONDO:2"].definition, got["MONDO:2"].synonyms, got["MONDO:2"].parents) == ("a leaf", ["s"], ["MONDO:1"])
    assert got["MONDO:1"].parents == [] and got["MONDO:1"].definition is None


def test_large_tables_are_not_broadcast(spark):
    from atlasloom.sizing import broadcast_if_small

    spark.conf.set("spark.atlasloom.broadcast.maxBytes", "10")
    try:
        small = broadcast_if_small(spark.range(100))
        plan = spark.range(10).join(small, "id")._jdf.queryExecution().analyzed().toString()
        assert "broadcast" not in plan.lower()
    finally:
        spark.conf.unset("spark.atlasloom.broadcast.maxBytes")


def test_kept_tables_are_released(spark):
    from atlasloom.sizing import broadcast_if_small, release

    release(spark)
    kept = broadcast_if_small(spark.range(100).selectExpr("id", "id * 2 AS twice"))
    joined = spark.range(10).join(kept, "id")
    assert joined.count() == 10 and kept.storageLevel.useMemory
    assert release(spark) == 1 and release(spark) == 0
    assert joined.count() == 10


def test_vectors_verified_by_blocks(spark):
    def table(rows, kind="double"):
        return spark.createDataFrame(rows, f"cell_id long, key string, vector array<{kind}>")

    far = float("inf")
    same = [(i, k, [float(i), 1.0 / (i + 1), far]) for i in range(300) for k in ("X_a", "X_b")]
    assert verify.differing_blocks(table(same), table(same), 64).isEmpty()
    changed = {(5, "X_a"): [5.0, 9.0, far], (6, "X_a"): [6.0, 1.0 / 7 + 1e-12, far], (7, "X_b"): [7.0], (8, "X_b"): None}
    stored = [(i, k, changed.get((i, k), v)) for i, k, v in same if (i, k) != (9, "X_a")] + [(900, "X_a", [1.0])]
    reasons = {(5, "X_a", "values differ"), (7, "X_b", "shape differs"), (8, "X_b", "missing in source"),
               (9, "X_a", "missing in source"), (900, "X_a", "not expected")}
    for blocks in (1, 16, 4096):
        assert {tuple(r) for r in verify.embedding_failures(table(stored), table(same), blocks=blocks).collect()} == reasons
    assert 0 < verify.differing_blocks(table(stored), table(same), 4096).count() <= 6
    # other number types of the same values
    narrow = table(same, "float").withColumn("cell_id", F.col("cell_id").cast("int"))
    assert verify.embedding_failures(narrow, table(same)).isEmpty()
    # a row without a vector is missing, also where both sides have none; empty tables agree
    assert verify.embedding_failures(table([(1, "X_a", None)]), table([(1, "X_a", None)])).first().reason == "missing in source"
    assert verify.embedding_failures(table([]), table([])).isEmpty()


def test_user_method(spark):
    import pandas as pd

    def fn(batches):
        for b in batches:
            yield pd.DataFrame({"cell_id": b.cell_id, "vector": [[float(x)] for x in b.ord]})

    embeddings.register_vector_function("places", fn, ["ord"])
    cells = spark.createDataFrame([(5, 0), (6, 1)], "cell_id long, ord long")
    genes = spark.createDataFrame([(0, 0)], "gene_id long, pos long")
    counts = spark.createDataFrame([(5, 0, 1.0)], "cell_id long, gene_id long, value double")
    a = Atlas(cells, genes, counts)
    assert {(r.cell_id, r.key, r.vector[0]) for r in embeddings.embed(a, "places").collect()} == {(5, "X_places", 0.0), (6, "X_places", 1.0)}
    done = a.with_(embeddings=embeddings.embed(a, "places"))
    assert embeddings.embed_missing(done, {"places": {}}) is None
    assert embeddings.embed_missing(done, {"places": {}}, overwrite=True).count() == 2


def test_group_mixtures(spark):
    """A hot group with two humps beside one hump, one value, nulls alone, and a null key; two humps where only pooling would hide or make them."""
    import random

    from atlasloom.operators import group_mixtures

    rng = random.Random(5)
    rows = [("two", rng.gauss(10 if i % 4 else 30, 1.0)) for i in range(4000)] + [("one", rng.gauss(30, 2.0)) for _ in range(900)]
    rows += [("flat", 4.0)] * 20 + [("none", None)] * 5 + [(None, rng.gauss(-5 if i % 2 else 5, 0.5)) for i in range(200)] + [("two", None), ("two", float("nan")), ("lone", 1.0)]
    cells = spark.createDataFrame([(i, g, x) for i, (g, x) in enumerate(rows)], "cell_id long, g string, x double")
    fit = {r.g: r for r in group_mixtures.fit_groups(cells, "x", "g").collect()}
    assert {g: r.bimodal for g, r in fit.items()} == {"two": True, "one": False, "flat": False, None: True, "lone": False}
    assert fit["two"].n == 4000 and abs(fit["two"].mean_low - 10) < 0.2 and abs(fit["two"].mean_high - 30) < 0.3 and abs(fit["two"].share_high - 0.25) < 0.01
    out = group_mixtures.split_groups_if_bimodal(cells, "x", "g")
    sizes = {(r.g, r.bimodal_split): r.n for r in out.groupBy("g", "bimodal_split").agg(F.count("*").alias("n")).collect()}
    assert sizes == {("two", "low_x"): 3000, ("two", "high_x"): 1000, ("one", "all"): 900, ("flat", "all"): 20, ("none", "all"): 5,
                     (None, "low_x"): 100, (None, "high_x"): 100, ("lone", "all"): 1}
    whole = group_mixtures.split_groups_if_bimodal(cells.filter("g = 'one'"), "x")
    assert {r.bimodal_split for r in whole.collect()} == {"all"}
    assert group_mixtures.split_groups_if_bimodal(cells.filter("1 = 0"), "x", "g").collect() == []


def test_raw_counts_by_group(spark):
    """Each group finds its own raw counts; a named layer is taken as it is; a group without any is told."""
    from atlasloom.operators.normalise import ensure_raw_counts_by

    cells = spark.createDataFrame([(i, i, "abcd"[i % 4]) for i in range(8)], "cell_id long, ord long, g string")
    genes = spark.createDataFrame([(1, 1), (2, 2)], "gene_id int, pos int")
    value = {"a": 2.0, "b": -1.0, "c": -1.0, "d": 1.5}
    counts = spark.createDataFrame([(i, 1, value["abcd"[i % 4]]) for i in range(8)], "cell_id long, gene_id int, value double")
    layers = spark.createDataFrame([("raw", i, 2, 7.0) for i in (1, 5)] + [("mine", i, 2, 3.7) for i in (3, 7)], "layer string, cell_id long, gene_id int, value double")
    out, without = ensure_raw_counts_by(Atlas(cells, genes, counts, layers), ["g"], "mine")
    assert sorted(tuple(r) for r in out.counts.collect()) == [(0, 1, 2), (1, 2, 7), (3, 2, 3), (4, 1, 2), (5, 2, 7), (7, 2, 3)]
    assert [r.g for r in without.collect()] == ["c"]
    assert out.layers.filter("layer = 'counts'").count() == 6


def test_embeddings_are_added(spark, tmp_path):
    """A second run adds, a repeated cell is replaced, other chunks' files stay as they are, a moved cell is refused."""
    path = str(tmp_path / "embeddings")

    def table(rows):
        return spark.createDataFrame(rows, "cell_id long, key string, chunk string, vector array<float>")

    def found():
        return {(r.cell_id, r.key): (r.chunk, r.vector) for r in matrix.read_embeddings(spark, path).collect()}

    matrix.write_embeddings(table([(1, "X_a", "0", [1.0]), (2, "X_a", "1", [2.0]), (1, "X_b", "0", [3.0])]), path)
    before = sorted(p.name for p in (tmp_path / "embeddings/key=X_a/chunk=1").iterdir())
    matrix.write_embeddings(table([(3, "X_a", "0", [4.0]), (1, "X_a", "0", [5.0])]), path)
    assert found() == {(1, "X_a"): ("0", [5.0]), (2, "X_a"): ("1", [2.0]), (3, "X_a"): ("0", [4.0]), (1, "X_b"): ("0", [3.0])}
    assert sorted(p.name for p in (tmp_path / "embeddings/key=X_a/chunk=1").iterdir()) == before
    with pytest.raises(ValueError, match="another chunk"):
        matrix.write_embeddings(table([(2, "X_a", "0", [9.0])]), path)
    matrix.write_embeddings(table([(7, "X_a", "0", [7.0])]), path, replace=True)
    assert found() == {(7, "X_a"): ("0", [7.0]), (2, "X_a"): ("1", [2.0]), (1, "X_b"): ("0", [3.0])}
    matrix.write_embeddings(table([]), path)
    assert len(found()) == 3


def test_sentences_of_several_lengths(spark):
    from atlasloom.operators.sentences import cell_sentences, sentences_of_lengths

    rng = np.random.default_rng(3)
    counts = spark.createDataFrame([(c, int(g), float(v)) for c in range(12) for g, v in enumerate(rng.poisson(0.6, 9)) if v and c != 4], "cell_id long, gene_id long, value double")
    cells = spark.createDataFrame([(c, c, "ab"[c % 2]) for c in range(12)], "cell_id long, ord long, kind string")
    genes = spark.createDataFrame([(g, g, f"gene {g}", g != 5) for g in range(9)], "gene_id long, pos long, gene_name string, highly_variable boolean")
    for annotation in (None, "kind"):
        names = ["cell_sentence", *(["semantic_true", "semantic_similar"] if annotation else [])]
        got = sentences_of_lengths(counts, cells, genes, [2, 7, 4], annotation).select("cell_id", F.inline("by_length"))
        for n in (2, 4, 7):
            alone = cell_sentences(counts, cells, genes, n, annotation).select("cell_id", *names)
            assert sorted(alone.collect()) == sorted(got.filter(F.col("cs_length") == n).select("cell_id", *names).collect())
