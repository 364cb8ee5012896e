"""Column and layer edits, identifier handling, row filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlasloom.functions.genes import family_flags
from atlasloom.functions.ids import stable_numeric_id, strip_version
from atlasloom.operators import edits, filters, predicates, ranking
from atlasloom.sources import star_schema as star
from query_catalogue.registry import CELLS, CELLS_INSTR, GENES, query, rounded, with_ctes

LAYERS = "layers AS (SELECT l_returnflag AS layer, l_orderkey AS cell_id, l_partkey AS gene_id, sum(l_quantity) AS value FROM lineitem GROUP BY 1, 2, 3)"


def layers(spark, d):
    l = star.table(spark, d, "lineitem")
    return l.groupBy(F.col("l_returnflag").alias("layer"), F.col("l_orderkey").alias("cell_id"), F.col("l_partkey").alias("gene_id")).agg(
        F.sum("l_quantity").alias("value"))


@query("P1_drop_layers", with_ctes("SELECT * FROM layers WHERE layer NOT IN ('R', 'absent')", LAYERS))
def drop_layers(spark, d):
    return edits.drop_layers(layers(spark, d), ["R", "absent"])


@query("P2_drop_null_columns", with_ctes("SELECT cell_id, batch, nullif(annotation, '5-LOW') AS part_null FROM cells", CELLS))
def drop_null_columns(spark, d):
    c = star.cells(spark, d).select(
        "cell_id", "batch", F.nullif("annotation", F.lit("5-LOW")).alias("part_null"), F.nullif("batch", F.col("batch")).alias("all_null"))
    return edits.drop_null_columns(c)


@query("P3_drop_slash_names", with_ctes("SELECT cell_id, batch FROM cells", CELLS))
def drop_slash(spark, d):
    return edits.drop_slash_columns(star.cells(spark, d).select("cell_id", "batch", F.col("annotation").alias("obs/annotation")))


@query("P3_drop_slash_layers", with_ctes("SELECT layer, count(*) AS n FROM layers WHERE layer <> 'N' GROUP BY 1", LAYERS))
def drop_slash_layers(spark, d):
    l = layers(spark, d).withColumn("layer", F.when(F.col("layer") == "N", F.lit("a/N")).otherwise(F.col("layer")))
    return edits.drop_slash_layers(l).groupBy("layer").agg(F.count("*").alias("n"))


@query("P4_remove_attributes", with_ctes("SELECT cell_id, k, v FROM (SELECT cell_id, 'a/c' AS k, annotation AS v FROM cells UNION ALL SELECT cell_id, 'x', caption FROM cells)", CELLS))
def remove_attributes(spark, d):
    uns = star.cells(spark, d).select("cell_id", F.create_map(
        F.lit("a/b"), "batch", F.lit("a/b/z"), "batch", F.lit("a/c"), "annotation", F.lit("x"), "caption").alias("uns"))
    _, kept, refused = edits.remove_attributes(layers(spark, d), uns, ["uns/a/b", "raw", "obs"])
    assert refused == ["obs"]
    return kept.select("cell_id", F.explode("uns").alias("k", "v"))


@query("P5_clean_report", "SELECT * FROM (SELECT 'layer' AS kind, l_returnflag AS name FROM lineitem WHERE l_returnflag = 'A' UNION SELECT 'key', 'X_' || label FROM embeddings WHERE label IN (1, 2))")
def clean_report(spark, d):
    emb = star.embeddings(spark, d).withColumn("key", F.concat(F.lit("X_"), "label"))
    return edits.clean_layers_and_keys(layers(spark, d), emb, ["A", "Q"], ["X_1", "X_2", "X_99"])[2]


@query("P5_cleaned_layers", with_ctes("SELECT layer, count(*) AS n, sum(value) AS total FROM layers WHERE layer <> 'A' GROUP BY 1", LAYERS))
def cleaned_layers(spark, d):
    emb = star.embeddings(spark, d)
    kept, _, _ = edits.clean_layers_and_keys(layers(spark, d), emb, ["A"], ["X_test"])
    return kept.groupBy("layer").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


@query("P6_copy_columns", with_ctes("SELECT cell_id, batch, annotation, batch AS sample, annotation AS cell_type FROM cells", CELLS))
def copy_columns(spark, d):
    c = star.cells(spark, d).select("cell_id", "batch", "annotation")
    return edits.copy_columns(c, ["batch", "annotation", "absent"], ["sample", "cell_type", "nothing"])


@query("P7_gene_id_from_column", with_ctes("""SELECT CASE WHEN rn > 1 THEN gene_name || '_' || (rn - 1) ELSE gene_name END AS gene_id, gene_id AS previous_index, pos
  FROM (SELECT *, row_number() OVER (PARTITION BY gene_name ORDER BY pos) AS rn FROM genes WHERE nullif(gene_name, 'red widget') IS NOT NULL)""", GENES))
def gene_id_from_column(spark, d):
    g = star.genes(spark, d).withColumn("gene_name", F.nullif("gene_name", F.lit("red widget")))
    return edits.gene_id_from_column(g, "gene_name").select("gene_id", "previous_index", "pos")


@query("P8_unique_cell_ids", with_ctes("SELECT CASE WHEN rn > 1 THEN donor || '_' || (rn - 1) ELSE CAST(donor AS VARCHAR) END AS donor, cell_id FROM (SELECT *, row_number() OVER (PARTITION BY donor ORDER BY ord) AS rn FROM cells)", CELLS))
def unique_ids(spark, d):
    return edits.unique_cell_ids(star.cells(spark, d), "donor").select("donor", "cell_id")


@query("P9_original_id", with_ctes("SELECT cell_id, cell_id AS sample_id_og FROM cells", CELLS))
def original_id(spark, d):
    return edits.keep_original_id(star.cells(spark, d)).select("cell_id", "sample_id_og")


@query("P10_sample_index", with_ctes("SELECT cell_id, batch, row_number() OVER (PARTITION BY batch ORDER BY ord) - 1 AS sample_index FROM cells", CELLS))
def sample_index(spark, d):
    return edits.add_sample_index(star.cells(spark, d), by="batch").select("cell_id", "batch", "sample_index")


@query("P10_global_index", with_ctes("SELECT cell_id, row_number() OVER (ORDER BY price) - 1 AS place FROM (SELECT * FROM cells QUALIFY count(*) OVER (PARTITION BY price) = 1)", CELLS))
def global_index(spark, d):
    """Position over the whole table in the order of a numeric column whose values are unique."""
    c = star.cells(spark, d)
    twice = c.groupBy("price").agg(F.count("*").alias("n")).filter("n > 1")
    return ranking.row_index(c.join(twice, "price", "left_anti"), "price", "place").select("cell_id", "place")


@query("P11_add_column", with_ctes("SELECT cell_id, value FROM cells JOIN (SELECT o_orderkey AS cell_id, o_totalprice * 2 AS value FROM orders) USING (cell_id)", CELLS))
def add_column(spark, d):
    o = star.table(spark, d, "orders").select(F.col("o_orderkey").alias("cell_id"), (F.col("o_totalprice") * 2).alias("value"))
    return edits.add_column(star.cells(spark, d), o, "value").select("cell_id", "value")


@query("P12_prepend_instrument", with_ctes("SELECT cell_id, 'This measurement was conducted with ' || instrument || '. ' || caption AS caption FROM cells", CELLS_INSTR))
def prepend(spark, d):
    return edits.prepend_instrument(star.cells_with_instrument(spark, d), "instrument", "caption").select("cell_id", "caption")


@query("P13_fill_text_nulls", with_ctes("SELECT cell_id, coalesce(nullif(batch, 'P'), 'unknown') AS batch, nullif(donor, 1) AS donor FROM cells", CELLS))
def fill_nulls(spark, d):
    c = star.cells(spark, d).select("cell_id", F.nullif("batch", F.lit("P")).alias("batch"), F.nullif("donor", F.lit(1)).alias("donor"))
    return edits.fill_text_nulls(c)


@query("P14_stable_numeric_id", "SELECT doc_id, CAST('0x' || substr(md5(text), 1, 8) AS BIGINT) AS stable_id FROM documents")
def stable_id(spark, d):
    return star.table(spark, d, "documents").select("doc_id", stable_numeric_id("text").alias("stable_id"))


@query("P15_log_column", with_ctes("SELECT cell_id, round(ln(1 + price), 6) AS price_log FROM cells", CELLS))
def log_column(spark, d):
    return rounded(edits.add_log_column(star.cells(spark, d), "price").select("cell_id", "price_log"))


@query("P16_strip_version", "SELECT p_partkey, split_part('ENSG' || p_partkey || CASE WHEN p_size < 20 THEN '.' || p_size || '.x' ELSE '' END, '.', 1) AS gene_id FROM part")
def versions(spark, d):
    p = star.table(spark, d, "part")
    raw = F.concat(F.lit("ENSG"), "p_partkey", F.when(F.col("p_size") < 20, F.concat(F.lit("."), "p_size", F.lit(".x"))).otherwise(""))
    return p.select("p_partkey", strip_version(raw).alias("gene_id"))


@query("A7_one_cell_per_sample", with_ctes("SELECT donor, cell_id FROM cells WHERE donor IS NOT NULL QUALIFY row_number() OVER (PARTITION BY donor ORDER BY md5('42:' || cell_id), cell_id) = 1", CELLS))
def one_per_sample(spark, d):
    return ranking.one_per_id(star.cells(spark, d), "donor", "cell_id").select("donor", "cell_id")


@query("A8_one_gene_per_id", with_ctes("SELECT gene_name, gene_id FROM genes QUALIFY row_number() OVER (PARTITION BY gene_name ORDER BY md5('42:' || gene_id), gene_id) = 1", GENES))
def one_gene(spark, d):
    return ranking.one_per_id(star.genes(spark, d), "gene_name", "gene_id").select("gene_name", "gene_id")


ACC = """acc AS (SELECT o_orderkey AS cell_id, CASE WHEN o_orderkey IS NULL THEN NULL WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'ERX' || o_orderkey
  ELSE 'SRX' || o_orderkey END AS experiment_accession, 'SRS' || o_custkey AS accession FROM orders)"""


def accessions(spark, d):
    o = star.table(spark, d, "orders")
    bad = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P")
    return o.select(
        F.col("o_orderkey").alias("cell_id"),
        F.concat(F.when(bad, "ERX").otherwise("SRX"), "o_orderkey").alias("experiment_accession"),
        F.concat(F.lit("SRS"), "o_custkey").alias("accession"))


@query("F7_valid_accessions", with_ctes("""SELECT cell_id, true AS verdict FROM acc WHERE regexp_full_match(experiment_accession, 'SRX[0-9]+')""", ACC))
def valid_accessions(spark, d):
    kept, ok = predicates.accession_check(accessions(spark, d), {
        "experiment_accession": predicates.EXPERIMENT_ACCESSION, "accession": predicates.SAMPLE_ACCESSION})
    return kept.select("cell_id", F.lit(ok).alias("verdict"))


@query("F9_named_genes", with_ctes("SELECT gene_id, nm FROM (SELECT gene_id, CASE WHEN family = 'Brand#1' THEN NULL WHEN family = 'Brand#2' THEN '' WHEN family = 'Brand#3' THEN 'nan' ELSE gene_name END AS nm FROM genes) WHERE nm IS NOT NULL AND nm NOT IN ('', 'nan')", GENES))
def named(spark, d):
    nm = F.when(F.col("family") == "Brand#1", None).when(F.col("family") == "Brand#2", "").when(F.col("family") == "Brand#3", "nan").otherwise(F.col("gene_name"))
    return filters.named_genes(star.genes(spark, d).withColumn("nm", nm), "nm").select("gene_id", "nm")


@query("F10_accession_genes", with_ctes("SELECT gene_id, acc FROM (SELECT gene_id, CASE WHEN biotype = 'PROMO' THEN gene_name WHEN biotype = 'SMALL' THEN '' ELSE 'ENSG' || gene_id END AS acc FROM genes) WHERE acc LIKE 'ENS%'", GENES))
def accession_genes(spark, d):
    acc = F.when(F.col("biotype") == "PROMO", F.col("gene_name")).when(F.col("biotype") == "SMALL", "").otherwise(F.concat(F.lit("ENSG"), "gene_id"))
    return filters.accession_genes(star.genes(spark, d).withColumn("acc", acc), "acc").select("gene_id", "acc")


@query("F12_panel_biotypes", with_ctes("SELECT gene_id, biotype FROM genes WHERE biotype IN ('ECONOMY', 'PROMO')", GENES))
def biotypes(spark, d):
    return filters.panel_biotypes(star.genes(spark, d), "biotype", ["ECONOMY", "PROMO"]).select("gene_id", "biotype")


@query("F13_approved_symbols", with_ctes("SELECT DISTINCT gene_name FROM genes WHERE biotype = 'ECONOMY' AND family IN ('Brand#1', 'Brand#2', 'Brand#3')", GENES))
def approved(spark, d):
    return filters.approved_symbols(star.genes(spark, d), "gene_name", "biotype", "family", ["Brand#1", "Brand#2", "Brand#3"], approved="ECONOMY")


@query("F14_row_filter", with_ctes("SELECT cell_id, batch, annotation FROM cells WHERE batch = 'F' AND annotation IN ('1-URGENT', '2-HIGH')", CELLS))
def row_filter(spark, d):
    return filters.where_all(star.cells(spark, d), "batch == 'F' and annotation in ('1-URGENT', '2-HIGH')").select("cell_id", "batch", "annotation")


@query("F15_positive_pairs", "SELECT doc_id, toxic FROM labels WHERE quality = 1")
def positives(spark, d):
    return filters.positive_pairs(star.table(spark, d, "labels").withColumnRenamed("quality", "label")).select("doc_id", "toxic")


@query("F16_primary_rows", with_ctes("SELECT cell_id FROM cells WHERE batch <> 'P'", CELLS))
def primary(spark, d):
    c = star.cells(spark, d).withColumn("is_primary_data", F.col("batch") != "P")
    return filters.primary_rows(c).select("cell_id")


@query("F21_gene_accession_check", with_ctes("""SELECT count(*) AS n_ids, count(*) FILTER (WHERE acc = '') AS n_missing,
  count(*) FILTER (WHERE acc <> '' AND acc NOT LIKE 'ENS%') AS n_invalid, count(*) FILTER (WHERE acc <> '' AND acc NOT LIKE 'ENS%') = 0 AS all_valid
  FROM (SELECT CASE WHEN biotype = 'SMALL' THEN '' WHEN family = 'Brand#1' THEN gene_name ELSE 'ENSG' || gene_id END AS acc FROM genes)""", GENES))
def gene_accessions(spark, d):
    acc = F.when(F.col("biotype") == "SMALL", "").when(F.col("family") == "Brand#1", F.col("gene_name")).otherwise(F.concat(F.lit("ENSG"), "gene_id"))
    return predicates.gene_accession_check(star.genes(spark, d).withColumn("acc", acc), "acc")


@query("F23_embedding_inputs", with_ctes("SELECT cell_id, donor AS n_counts, row_number() OVER (ORDER BY ord) - 1 AS sample_index FROM cells", CELLS))
def embedding_inputs(spark, d):
    cells = edits.add_sample_index(star.cells(spark, d)).withColumn("n_counts", F.col("donor"))
    genes = star.genes(spark, d).withColumn("ensembl_id", F.concat(F.lit("ENSG"), "gene_id"))
    predicates.require_embedding_inputs(cells, genes)
    return cells.select("cell_id", "n_counts", "sample_index")


@query("X1_family_flags", "SELECT p_partkey, regexp_matches(s, '^MT-') AS mt, regexp_matches(s, '^RP[SL]') AS ribo, regexp_matches(s, '^HB[^P]') AS hb FROM (SELECT p_partkey, upper(CASE p_type WHEN 'ECONOMY' THEN 'mt-' WHEN 'PROMO' THEN 'Rps' WHEN 'SMALL' THEN 'hb' ELSE '' END || p_name) AS s FROM part)")
def flags(spark, d):
    p = star.table(spark, d, "part")
    lead = F.when(F.col("p_type") == "ECONOMY", "mt-").when(F.col("p_type") == "PROMO", "Rps").when(F.col("p_type") == "SMALL", "hb").otherwise("")
    return p.select("p_partkey", *[e.alias(n) for n, e in family_flags(F.concat(lead, "p_name")).items()])
