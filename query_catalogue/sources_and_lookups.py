"""Reading, writing, lookups, unions, verification."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlasloom.model import Atlas
from atlasloom.operators import embeddings as emb
from atlasloom.operators import chunks, lookups, records, setops, verify
from atlasloom.sources import matrix, tables
from atlasloom.sources import star_schema as star
from query_catalogue.edits_and_filters import ACC, accessions
from query_catalogue.records_and_subsets import NEG, SAMPLES, sample_rows
from query_catalogue.registry import CELLS, COUNTS, GENES, query, rounded, scratch, with_ctes


@query("S5_write_chunks", with_ctes("""SELECT split, chunk_id, count(*) AS n, sum(donor) AS donors FROM (
  SELECT *, CASE WHEN donor < 300 THEN 'val' ELSE 'train' END AS split, CAST((row_number() OVER (ORDER BY md5('0:' || cell_id), cell_id) - 1) // 3000 AS INTEGER) AS chunk_id FROM cells)
  GROUP BY 1, 2""", CELLS))
def write_chunks(spark, d):
    c = chunks.chunk_at_random(star.cells(spark, d), 3000)
    c = chunks.apply_split(c, F.when(F.col("donor") < 300, "val").otherwise("train"))
    path = scratch(spark) + "/chunks"
    matrix.write_chunks(c, path)
    matrix.write_chunks(c, path)  # a second run replaces the first
    return spark.read.parquet(path).groupBy("split", "chunk_id").agg(F.count("*").alias("n"), F.sum("donor").alias("donors"))


@query("S6_replace_one_key", "SELECT key, count(*) AS n, round(sum(first), 4) AS total FROM (SELECT 'X_a' AS key, CAST(embedding[1] AS DOUBLE) AS first FROM embeddings UNION ALL SELECT 'X_b', -2 * CAST(embedding[1] AS DOUBLE) FROM embeddings) GROUP BY 1")
def replace_key(spark, d):
    e = star.embeddings(spark, d).drop("label")
    path = scratch(spark) + "/embeddings"
    both = e.withColumn("key", F.lit("X_a")).unionByName(e.withColumn("key", F.lit("X_b")))
    matrix.write_embeddings(both, path)
    newer = e.withColumn("key", F.lit("X_b")).withColumn("vector", F.transform("vector", lambda x: (x * F.lit(-2)).cast("float")))
    matrix.write_embeddings(newer, path)
    return rounded(spark.read.parquet(path).groupBy("key").agg(
        F.count("*").alias("n"), F.sum(F.col("vector")[0].cast("double")).alias("total")), 4)


@query("S7_missing_keys", "SELECT * FROM (SELECT unnest(['X_0', 'X_5', 'X_99', 'X_100']) AS key) WHERE key NOT IN (SELECT 'X_' || label FROM embeddings)")
def missing_keys(spark, d):
    e = star.embeddings(spark, d).withColumn("key", F.concat(F.lit("X_"), "label"))
    present = emb.embedding_keys(e).withColumn("chunk_id", F.lit(0))
    return lookups.missing_keys(present, e.withColumn("chunk_id", F.lit(0)), ["X_0", "X_5", "X_99", "X_100"]).select("key")


@query("F22_keys_per_chunk", "SELECT chunk_id, key FROM (SELECT DISTINCT vec_id % 7 AS chunk_id FROM embeddings) CROSS JOIN (SELECT unnest(['X_0', 'X_1', 'X_2']) AS key) WHERE (chunk_id, key) NOT IN (SELECT (vec_id % 7, 'X_' || label) FROM embeddings WHERE label < 3 AND embedding[1] > 0.1)")
def keys_per_chunk(spark, d):
    e = star.embeddings(spark, d).withColumn("chunk_id", F.col("cell_id") % 7).withColumn("key", F.concat(F.lit("X_"), "label"))
    present = e.filter((F.col("label") < 3) & (F.col("vector")[0] > F.lit(0.1).cast("float")))
    return lookups.missing_keys(present, e, ["X_0", "X_1", "X_2"])


@query("S8_saved_vectors", "SELECT vec_id AS cell_id, len(embedding) AS dim, round(list_sum(CAST(embedding AS DOUBLE[])), 4) AS total FROM embeddings")
def saved_vectors(spark, d):
    path = scratch(spark) + "/vectors"
    matrix.save_vectors(star.embeddings(spark, d), path)
    return rounded(spark.read.parquet(path).select("cell_id", F.size("vector").alias("dim"), F.aggregate(
        "vector", F.lit(0.0), lambda a, x: a + x).alias("total")), 4)


@query("S9_read_list", "SELECT p_name AS term, row_number() OVER (ORDER BY p_partkey) - 1 AS line FROM part")
def read_list(spark, d):
    path = scratch(spark) + "/list"
    parts = star.table(spark, d, "part").repartitionByRange(5, "p_partkey").sortWithinPartitions("p_partkey")
    parts.select(F.concat(F.lit("  "), "p_name", F.lit(" \n")).alias("v")).write.text(path)
    return tables.read_list(spark, path)


@query("S10_write_list", "SELECT DISTINCT c_mktsegment || c_nationkey AS term FROM customer")
def write_list(spark, d):
    path = scratch(spark) + "/terms"
    t = star.table(spark, d, "customer").select(F.concat("c_mktsegment", F.col("c_nationkey").cast("string")).alias("term"))
    tables.write_list(t, "term", path)
    return tables.read_list(spark, path).select("term")


@query("S16_saved_records", with_ctes("SELECT split, count(*) AS n, count(DISTINCT negative_1_idx) AS negatives FROM (SELECT CASE WHEN adata_link = 'links/P' THEN 'val' ELSE 'train' END AS split, neg1 AS negative_1_idx FROM n1) GROUP BY 1", CELLS, SAMPLES, NEG))
def saved_records(spark, d):
    r = records.build_records(sample_rows(spark, d), "multiplets", 1)
    r = r.withColumn("split", F.when(F.col("adata_link") == "links/P", "val").otherwise("train"))
    path = scratch(spark) + "/records"
    records.save_records(r, path)
    return spark.read.parquet(path).groupBy("split").agg(F.count("*").alias("n"), F.count_distinct("negative_1_idx").alias("negatives"))


@query("S18_converted_tables", "SELECT count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders")
def converted(spark, d):
    out = scratch(spark)
    for _ in range(2):  # the second call finds the target and leaves it
        matrix.convert_tables(spark, {"orders": f"{d}/orders.parquet", "part": f"{d}/part.parquet"}, out)
    return rounded(spark.read.parquet(f"{out}/orders").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total")), 2)


@query("K9_written_atlas", with_ctes("SELECT chunk_id, count(DISTINCT cell_id) AS cells, count(*) AS entries, sum(value) AS total FROM counts JOIN (SELECT cell_id, batch AS chunk_id FROM cells) USING (cell_id) GROUP BY 1", CELLS, COUNTS))
def written_atlas(spark, d):
    cells = star.cells(spark, d).withColumn("chunk_id", F.col("batch"))
    out = scratch(spark) + "/atlas"
    matrix.write_atlas(Atlas(cells, star.genes(spark, d), star.counts(spark, d)), out, ["chunk_id"])
    a = matrix.read_atlas(spark, out, unique=True)
    return a.counts.groupBy("chunk_id").agg(
        F.count_distinct("cell_id").alias("cells"), F.count("*").alias("entries"), F.sum("value").alias("total"))


# --- lookups --------------------------------------------------------------------


#: Customers in debt are in the lookup under a key that no order has.
GOOD = "good AS (SELECT *, CASE WHEN c_acctbal > 0 THEN c_custkey ELSE -1 - c_custkey END AS good_key FROM customer)"


def good_customers(spark, d):
    c = star.table(spark, d, "customer")
    return c.select(F.when(F.col("c_acctbal") > 0, F.col("c_custkey")).otherwise(-1 - F.col("c_custkey")).alias("donor"), F.col("c_mktsegment").alias("instrument"), F.col("c_nationkey").alias("site"))


@query("J1_enriched_cells", with_ctes("""SELECT cell_id, coalesce(c_mktsegment, 'unknown') AS instrument, coalesce(CAST(c_nationkey AS VARCHAR), 'unknown') AS site, 'unknown' AS layout
  FROM cells LEFT JOIN good ON donor = good_key""", CELLS, GOOD))
def enriched(spark, d):
    c = star.cells(spark, d).withColumn("site", F.lit("old"))
    return lookups.enrich(c, good_customers(spark, d), "donor", ["instrument", "site", "layout"]).select("cell_id", "instrument", "site", "layout")


@query("J1_first_lookup_row", with_ctes("""SELECT cell_id, coalesce(p, 'unknown') AS priority FROM cells LEFT JOIN (SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS p
  FROM orders GROUP BY 1) ON donor = o_custkey""", CELLS))
def first_lookup(spark, d):
    o = star.table(spark, d, "orders").select(
        F.col("o_custkey").alias("donor"), F.col("o_orderpriority").alias("priority"), "o_orderkey")
    return lookups.enrich(star.cells(spark, d), o, "donor", "priority", order=["o_orderkey"]).select("cell_id", "priority")


LIB = """lib AS (SELECT 'SRX' || l_orderkey AS experiment_accession, min(l_returnflag) AS library FROM lineitem GROUP BY 1)"""


def library(spark, d):
    l = star.table(spark, d, "lineitem")
    return l.groupBy(F.concat(F.lit("SRX"), "l_orderkey").alias("experiment_accession")).agg(F.min("l_returnflag").alias("library"))


@query("J2_enriched_accessions", with_ctes("""SELECT cell_id, coalesce(library, 'unknown') AS library FROM acc LEFT JOIN lib USING (experiment_accession)
  WHERE regexp_full_match(experiment_accession, 'SRX[0-9]+')""", ACC, LIB))
def enriched_accessions(spark, d):
    return lookups.enrich_accessions(accessions(spark, d), library(spark, d), ["library"]).select("cell_id", "library")


@query("J2_enrichment_fallback", with_ctes("SELECT cell_id, 'unknown_sra_unavailable' AS library FROM acc WHERE regexp_full_match(experiment_accession, 'SRX[0-9]+')", ACC))
def fallback(spark, d):
    return lookups.enrich_accessions(accessions(spark, d), None, ["library"], continue_on_fail=True).select("cell_id", "library")


@query("J3_id_differences", with_ctes("""SELECT id, side FROM (SELECT DISTINCT o_custkey AS id, 'missing' AS side FROM orders WHERE o_custkey NOT IN (SELECT good_key FROM good)
  UNION ALL SELECT good_key, 'extra' FROM good WHERE good_key NOT IN (SELECT o_custkey FROM orders))""", CELLS, GOOD))
def differences(spark, d):
    return lookups.id_differences(star.cells(spark, d), good_customers(spark, d), "donor")


#: Names of small parts are in the lookup as names that no gene has.
SYM = """sym AS (SELECT CASE WHEN p_size > 10 THEN p_name ELSE 'absent ' || p_name END AS gene_name, 'ENSG' || p_partkey AS ensembl_gene_id, p_partkey FROM part)"""


def symbol_table(spark, d):
    return star.table(spark, d, "part").select(
        F.when(F.col("p_size") > 10, F.col("p_name")).otherwise(F.concat(F.lit("absent "), "p_name")).alias("gene_name"), F.concat(F.lit("ENSG"), "p_partkey").alias("ensembl_gene_id"), "p_partkey")


@query("J4_mapped_symbols", with_ctes("""SELECT gene_id, CASE WHEN symbol LIKE 'ENS%' THEN split_part(symbol, '.', 1) ELSE coalesce(m, '') END AS ensembl_id
  FROM (SELECT gene_id, CASE WHEN biotype = 'PROMO' THEN 'ENSG' || gene_id || '.3' ELSE gene_name END AS symbol FROM genes)
  LEFT JOIN (SELECT gene_name, arg_min(ensembl_gene_id, p_partkey) AS m FROM sym GROUP BY 1) ON gene_name = symbol""", GENES, SYM))
def mapped_symbols(spark, d):
    g = star.genes(spark, d).withColumn("symbol", F.when(
        F.col("biotype") == "PROMO", F.concat(F.lit("ENSG"), "gene_id", F.lit(".3"))).otherwise(F.col("gene_name")))
    return lookups.map_symbols(g, symbol_table(spark, d), "symbol", order="p_partkey").select("gene_id", "ensembl_id")


@query("A9_accession_ids", with_ctes("""SELECT acc AS gene_id, gene_id AS previous_index FROM (SELECT gene_id, 'ENSG' || (gene_id // 2) AS acc FROM genes WHERE biotype <> 'SMALL')
  QUALIFY row_number() OVER (PARTITION BY acc ORDER BY md5('42:' || gene_id), gene_id) = 1""", GENES))
def accession_ids(spark, d):
    acc = F.when(F.col("biotype") == "SMALL", "none").otherwise(F.concat(F.lit("ENSG"), F.floor(F.col("gene_id") / 2), F.lit(".7")))
    return lookups.ensure_accession_ids(star.genes(spark, d).withColumn("ensembl_id", acc)).select("gene_id", "previous_index")


@query("A9_ids_from_lookup", with_ctes("""SELECT m AS gene_id, gene_name AS previous_index FROM (SELECT DISTINCT gene_name FROM genes)
  JOIN (SELECT gene_name, arg_min(ensembl_gene_id, p_partkey) AS m FROM sym GROUP BY 1) USING (gene_name)""", GENES, SYM))
def ids_from_lookup(spark, d):
    g = star.genes(spark, d).select(F.col("gene_name").alias("gene_id")).distinct()
    return lookups.ensure_accession_ids(g, lookup=symbol_table(spark, d), order="p_partkey").select("gene_id", "previous_index")


@query("J5_dataset_titles", "SELECT l_orderkey, l_linenumber, coalesce(nullif(s_name, ''), 'No DOI') AS doi FROM lineitem LEFT JOIN supplier ON l_suppkey = CASE WHEN s_acctbal > 0 THEN s_suppkey ELSE -1 - s_suppkey END")
def titles(spark, d):
    s = star.table(spark, d, "supplier").withColumn("s_suppkey", F.when(F.col("s_acctbal") > 0, F.col("s_suppkey")).otherwise(-1 - F.col("s_suppkey")))
    l = star.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return lookups.map_with_default(
        l.withColumnRenamed("l_suppkey", "s_suppkey"), s, "s_suppkey", "s_name", "No DOI", out="doi").select("l_orderkey", "l_linenumber", "doi")


FILES = """files AS (SELECT 'data/' || o_orderstatus || '/' || 'chunk_' || o_orderkey AS path, o_orderstatus AS split, 'chunk_' || o_orderkey AS name, o_orderpriority AS p, o_orderkey AS k FROM orders),
links AS (SELECT CASE p WHEN '1-URGENT' THEN name || '.zip' WHEN '2-HIGH' THEN name WHEN '3-MEDIUM' THEN split || '/' || name || '.zip' ELSE split || '/' || name END AS key, 'link ' || k AS link
  FROM files WHERE p <> '5-LOW')"""


@query("J6_file_references", with_ctes("SELECT path, CASE WHEN p = '5-LOW' THEN path ELSE 'link ' || k END AS adata_link FROM files", FILES))
def file_references(spark, d):
    o = star.table(spark, d, "orders")
    f = o.select(
        F.concat(F.lit("data/"), "o_orderstatus", F.lit("/chunk_"), "o_orderkey").alias("path"), F.col("o_orderstatus").alias("split"),
        F.concat(F.lit("chunk_"), "o_orderkey").alias("name"), F.col("o_orderpriority").alias("p"), F.col("o_orderkey").alias("k"))
    key = (F.when(F.col("p") == "1-URGENT", F.concat("name", F.lit(".zip"))).when(F.col("p") == "2-HIGH", F.col("name"))
           .when(F.col("p") == "3-MEDIUM", F.concat("split", F.lit("/"), "name", F.lit(".zip"))).otherwise(F.concat("split", F.lit("/"), "name")))
    links = f.filter("p <> '5-LOW'").select(key.alias("key"), F.concat(F.lit("link "), "k").alias("link"))
    return lookups.file_references(f.select("path", "split", "name"), links).select("path", "adata_link")


@query("J7_aligned_vectors", """SELECT c_custkey AS cell_id, round(coalesce(CASE WHEN n = 1 THEN CAST(v[1] AS DOUBLE) END, 0), 5) AS first, round(coalesce(CASE WHEN n = 1 THEN CAST(v[64] AS DOUBLE) END, 0), 5) AS last
  FROM customer LEFT JOIN (SELECT vec_id - label AS id, count(*) AS n, any_value(embedding) AS v FROM embeddings GROUP BY 1) ON id = c_custkey""")
def aligned(spark, d):
    e = star.embeddings(spark, d).withColumn("cell_id", F.col("cell_id") - F.col("label"))
    out = lookups.align_vectors(star.dense_cells(spark, d), e, 64)
    return rounded(out.select("cell_id", F.col("vector")[0].alias("first"), F.col("vector")[63].alias("last")), 5)


@query("J8_merged_embeddings", """SELECT vec_id AS cell_id, key, round(f * CAST(embedding[1] AS DOUBLE), 5) AS first FROM embeddings CROSS JOIN (VALUES ('X_a', 1), ('X_b', 1), ('X_c', 2)) k(key, f)""")
def merged_embeddings(spark, d):
    e = star.embeddings(spark, d).drop("label")

    def keyed(key, factor):
        return e.withColumn("key", F.lit(key)).withColumn("vector", F.transform("vector", lambda x: (x * F.lit(factor)).cast("float")))

    out = lookups.merge_embeddings([keyed("X_a", 1).unionByName(keyed("X_b", 1)), keyed("X_b", 2).unionByName(keyed("X_c", 2))])
    return rounded(out.select("cell_id", "key", F.col("vector")[0].alias("first")), 5)


@query("J9_merged_gene_columns", with_ctes("SELECT gene_id, gene_name, biotype, p_size AS size FROM genes JOIN part ON p_partkey = gene_id", GENES))
def merged_columns(spark, d):
    g = star.genes(spark, d).select("gene_id", "pos", "gene_name", "biotype")
    other = star.table(spark, d, "part").select(
        F.col("p_partkey").alias("gene_id"), F.col("p_partkey").alias("pos"), F.lit("x").alias("biotype"), F.col("p_size").alias("size"))
    return lookups.merge_gene_columns(g, other).select("gene_id", "gene_name", "biotype", "size")


@query("J10_file_groups", """SELECT prefix, split, count(*) AS n_files, min(path) AS first_path FROM (
  SELECT 'in/' || o_orderpriority || '_' || s || '_' || o_orderkey || '.h5ad' AS path, o_orderpriority AS prefix, s AS split
  FROM (SELECT *, CASE o_orderstatus WHEN 'F' THEN 'train' WHEN 'O' THEN 'val' ELSE 'other' END AS s FROM orders)) WHERE split <> 'other' GROUP BY 1, 2""")
def file_groups(spark, d):
    o = star.table(spark, d, "orders")
    s = F.when(F.col("o_orderstatus") == "F", "train").when(F.col("o_orderstatus") == "O", "val").otherwise("other")
    return lookups.group_files(o.select(F.concat(F.lit("in/"), "o_orderpriority", F.lit("_"), s, F.lit("_"), "o_orderkey", F.lit(".h5ad")).alias("path")))


@query("J11_panel_entries", with_ctes("SELECT cell_id, slot, value FROM counts JOIN panel USING (gene_id)", COUNTS,
    "panel AS (SELECT p_partkey AS gene_id, CAST(row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) - 1 AS INTEGER) AS slot FROM part WHERE p_brand IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4'))"))
def panel_entries(spark, d):
    p = star.genes(spark, d).filter(F.col("family").isin("Brand#1", "Brand#2", "Brand#3", "Brand#4")).withColumn("down", -F.col("weight") * 1e9 + F.col("gene_id"))
    return lookups.on_panel(star.counts(spark, d), emb.panel_from(p, "down")).select("cell_id", "slot", "value")


# --- unions -----------------------------------------------------------------------


def by_status(spark, d):
    cells, counts, genes = star.cells(spark, d), star.counts(spark, d), star.genes(spark, d)
    parts = []
    for s in ("F", "O", "P"):
        c = cells.filter(F.col("batch") == s)
        e = counts.join(c.select("cell_id"), "cell_id", "left_semi")
        g = genes.join(e.select("gene_id").distinct(), "gene_id", "left_semi")
        parts.append(Atlas(c, g, e))
    return parts


PRESENT = "present AS (SELECT DISTINCT batch, gene_id FROM counts JOIN cells USING (cell_id))"


@query("U2_outer_concatenation", with_ctes("SELECT c.batch AS split, count(*) AS n, sum(value) AS total, count(DISTINCT gene_id) AS genes FROM counts JOIN cells c USING (cell_id) GROUP BY 1", CELLS, COUNTS))
def outer_concat(spark, d):
    parts = by_status(spark, d)
    cells, counts, genes = setops.concat_matrices(
        [p.cells for p in parts], [p.counts for p in parts], [p.genes for p in parts], labels=["F", "O", "P"])
    return counts.join(genes.select("gene_id"), "gene_id").join(cells.select("cell_id", "split"), "cell_id").groupBy("split").agg(
        F.count("*").alias("n"), F.sum("value").alias("total"), F.count_distinct("gene_id").alias("genes"))


@query("U2_merged_gene_table", with_ctes("SELECT gene_id, gene_name, max(CASE batch WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END) AS last FROM present JOIN genes USING (gene_id) GROUP BY 1, 2", CELLS, COUNTS, GENES, PRESENT))
def merged_genes(spark, d):
    parts = [p.genes.select("gene_id", "pos", "gene_name").withColumn("last", F.lit(i)) for i, p in enumerate(by_status(spark, d))]
    return setops.merge_gene_tables(parts).select("gene_id", "gene_name", "last")


@query("U3_inner_concatenation", with_ctes("SELECT count(*) AS n, sum(value) AS total, count(DISTINCT gene_id) AS genes FROM counts SEMI JOIN (SELECT gene_id FROM present GROUP BY 1 HAVING count(*) = 3) USING (gene_id)", CELLS, COUNTS, PRESENT))
def inner_concat(spark, d):
    parts = by_status(spark, d)
    _, counts, _ = setops.concat_matrices(
        [p.cells for p in parts], [p.counts for p in parts], [p.genes for p in parts], labels=["F", "O", "P"], join="inner")
    return counts.agg(F.count("*").alias("n"), F.sum("value").alias("total"), F.count_distinct("gene_id").alias("genes"))


@query("U4_same_gene_concatenation", with_ctes("SELECT CASE batch WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS dataset_index, count(*) AS n FROM counts JOIN cells USING (cell_id) GROUP BY 1", CELLS, COUNTS))
def same_genes(spark, d):
    parts, genes = by_status(spark, d), star.genes(spark, d)
    cells, counts = setops.concat_same_genes([p.cells for p in parts], [p.counts for p in parts], [genes] * 3)
    return counts.join(cells.select("cell_id", "dataset_index"), "cell_id").groupBy("dataset_index").agg(F.count("*").alias("n"))


@query("U5_common_genes", with_ctes("SELECT gene_id FROM present GROUP BY 1 HAVING count(*) = 3", CELLS, COUNTS, PRESENT))
def common_genes(spark, d):
    return setops.common_genes([p.genes for p in by_status(spark, d)]).orderBy("gene_id")


@query("U6_compared_lists", "SELECT gene_name, CASE WHEN a AND b THEN 'both' WHEN a THEN 'first only' ELSE 'second only' END AS side FROM (SELECT p_name || p_size AS gene_name, bool_or(p_type = 'ECONOMY') AS a, bool_or(p_brand IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4')) AS b FROM part GROUP BY 1) WHERE a OR b")
def compared(spark, d):
    p = star.table(spark, d, "part").withColumn("gene_name", F.concat("p_name", "p_size"))
    return setops.compare_gene_lists(p.filter("p_type = 'ECONOMY'"), p.filter(F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3", "Brand#4")), "gene_name")


@query("U7_names_in_both", "SELECT p_name || p_size AS gene_name FROM part WHERE p_type = 'ECONOMY' INTERSECT SELECT p_name || p_size FROM part WHERE p_type = 'PROMO'")
def names_in_both(spark, d):
    p = star.table(spark, d, "part").withColumn("gene_name", F.concat("p_name", "p_size"))
    return setops.both_sorted(p.filter("p_type = 'ECONOMY'"), p.filter("p_type = 'PROMO'"), "gene_name")


# --- verification -----------------------------------------------------------------


@query("K7_record_failures", with_ctes("""SELECT sample_idx, 'id not in source' AS reason FROM r WHERE sample_idx NOT IN (SELECT cell_id FROM c)
  UNION ALL SELECT cell_id, 'id not in records' FROM c WHERE cell_id NOT IN (SELECT sample_idx FROM r)
  UNION ALL SELECT cell_id, 'caption differs' FROM c JOIN r ON sample_idx = cell_id WHERE positive <> caption""",
    CELLS, "c AS (SELECT cell_id, caption FROM cells WHERE batch <> 'P')",
    "r AS (SELECT cell_id AS sample_idx, CASE WHEN annotation = '5-LOW' THEN 'changed' ELSE caption END AS positive FROM cells WHERE batch <> 'F')"))
def failures(spark, d):
    cells = star.cells(spark, d)
    r = cells.filter("batch <> 'F'").select(F.col("cell_id").alias("sample_idx"), F.when(
        F.col("annotation") == "5-LOW", "changed").otherwise(F.col("caption")).alias("positive"))
    return verify.record_failures(r, cells.filter("batch <> 'P'"))


@query("K7_order_failures", with_ctes("""SELECT cell_id AS sample_idx, 'order differs' AS reason FROM (SELECT cell_id, row_number() OVER (ORDER BY ord) AS a,
  row_number() OVER (ORDER BY CASE WHEN batch = 'P' THEN ord ELSE ord + 10000000 END) AS b FROM cells) WHERE a <> b""", CELLS))
def order_failures(spark, d):
    cells = star.cells(spark, d)
    r = cells.select(F.col("cell_id").alias("sample_idx"), F.col("caption").alias("positive"), F.when(
        F.col("batch") == "P", F.col("ord")).otherwise(F.col("ord") + 10000000).alias("row"))
    return verify.record_failures(r, cells, order="row")


@query("K7_embedding_failures", "SELECT vec_id AS cell_id, 'X_test' AS key, CASE WHEN label = 1 THEN 'missing in source' WHEN label = 2 THEN 'shape differs' ELSE 'values differ' END AS reason FROM embeddings WHERE label IN (1, 2, 3)")
def embedding_failures(spark, d):
    e = star.embeddings(spark, d)
    v = F.when(F.col("label") == 2, F.slice("vector", 1, 63)).when(
        F.col("label") == 3, F.transform("vector", lambda x: (x + 1).cast("float"))).otherwise(
        F.transform("vector", lambda x: (x * F.lit(1.000001)).cast("float")))
    return verify.embedding_failures(e.filter("label <> 1").withColumn("vector", v), e)


@query("K8_one_source", with_ctes("SELECT count(DISTINCT adata_link) AS n_links, count(DISTINCT adata_link) = 1 AS single_source FROM s", CELLS, SAMPLES))
def one_source(spark, d):
    return verify.one_source(records.build_records(sample_rows(spark, d)))
