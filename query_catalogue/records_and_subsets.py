"""Chunks, splits, subsets, sentences and training records."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlasloom.functions.phrases import WITH_LABEL, WITHOUT_LABEL
from atlasloom.model import Atlas
from atlasloom.operators import chunks, quality, records, sentences, setops, subsets
from atlasloom.operators.embeddings import panel_from
from atlasloom.operators.lookups import panel_genes
from atlasloom.operators.normalise import log_normalise
from atlasloom.operators.variable_genes import variable_genes
from atlasloom.plans import dataset
from atlasloom.sizing import settle
from atlasloom.sources import star_schema as star
from query_catalogue.registry import CELLS, CELLS_INSTR, COUNTS, GENES, NORM, hvg_ctes, query, rounded, with_ctes

PACK = """b AS (SELECT site, min(ord) AS first, count(*) AS n FROM cells GROUP BY 1),
o AS (SELECT *, row_number() OVER (ORDER BY first) AS i FROM b),
f AS (SELECT i, site, n AS held, 0 AS chunk_id FROM o WHERE i = 1
  UNION ALL SELECT o.i, o.site, CASE WHEN f.held + o.n > 2000 THEN o.n ELSE f.held + o.n END,
    CASE WHEN f.held + o.n > 2000 THEN f.chunk_id + 1 ELSE f.chunk_id END FROM f JOIN o ON o.i = f.i + 1)"""


@query("S2_chunks_by_batch", with_ctes("SELECT cell_id, site, chunk_id FROM cells JOIN (SELECT site, chunk_id FROM f) USING (site)",
                                        CELLS_INSTR, PACK, recursive=True))
def chunks_by_batch(spark, d):
    return chunks.assign_chunks(star.cells_with_instrument(spark, d), 2000, "site").select("cell_id", "site", "chunk_id")


RANDOM_CHUNKS = "ch AS (SELECT *, CAST((row_number() OVER (ORDER BY md5('0:' || cell_id), cell_id) - 1) // 1000 AS INTEGER) AS chunk_id FROM cells)"


@query("S3_random_chunks", with_ctes("SELECT cell_id, chunk_id FROM ch", CELLS, RANDOM_CHUNKS))
def random_chunks(spark, d):
    return chunks.assign_chunks(star.cells(spark, d), 1000).select("cell_id", "chunk_id")


@query("S4_first_chunks", with_ctes("SELECT cell_id, chunk_id FROM ch WHERE chunk_id < 2", CELLS, RANDOM_CHUNKS))
def first_chunks(spark, d):
    return chunks.first_chunks(chunks.assign_chunks(star.cells(spark, d), 1000, "batch", random=True), 2).select("cell_id", "chunk_id")


@query("T3_random_subset", with_ctes("SELECT cell_id FROM cells ORDER BY md5('42:' || cell_id), cell_id LIMIT 4000", CELLS))
def random_subset(spark, d):
    return subsets.random_subset(star.cells(spark, d), 4000).select("cell_id")


STRATA = """q AS (SELECT batch, annotation, greatest(1, CAST(round_even(count(*) * 1.0 / (SELECT count(*) FROM cells) * 3000, 0) AS BIGINT)) AS quota FROM cells GROUP BY 1, 2),
chosen AS (SELECT c.* FROM (SELECT *, row_number() OVER (PARTITION BY batch, annotation ORDER BY md5('42:' || cell_id), cell_id) AS r FROM cells) c
  JOIN q USING (batch, annotation) WHERE r <= quota),
subset AS (SELECT * FROM chosen ORDER BY md5('42:trim:' || cell_id), cell_id LIMIT 3000)"""


@query("T4_stratified_subset", with_ctes("SELECT cell_id, batch, annotation FROM subset", CELLS, STRATA))
def stratified(spark, d):
    return subsets.stratified_subset(star.cells(spark, d), 3000, ["batch", "annotation"]).select("cell_id", "batch", "annotation")


@query("A17_category_shares", with_ctes("""SELECT key, category, round(o, 6) AS original_share, round(coalesce(s, 0), 6) AS subset_share FROM (
    SELECT 'batch' AS key, batch AS category, count(*) / (SELECT count(*) FROM cells) AS o FROM cells GROUP BY 2
    UNION ALL SELECT 'annotation', annotation, count(*) / (SELECT count(*) FROM cells) FROM cells GROUP BY 2) LEFT JOIN (
    SELECT 'batch' AS key, batch AS category, count(*) / (SELECT count(*) FROM subset) AS s FROM subset GROUP BY 2
    UNION ALL SELECT 'annotation', annotation, count(*) / (SELECT count(*) FROM subset) FROM subset GROUP BY 2) USING (key, category)""", CELLS, STRATA))
def shares(spark, d):
    cells = star.cells(spark, d)
    return rounded(subsets.category_shares(cells, subsets.stratified_subset(cells, 3000, ["batch", "annotation"]), ["batch", "annotation"]))


@query("T5_first_cells", with_ctes("SELECT cell_id, batch FROM cells ORDER BY ord LIMIT 500", CELLS))
def first_cells(spark, d):
    return subsets.first_rows(star.cells(spark, d), 500).select("cell_id", "batch")


@query("T6_summary_sample", with_ctes("""SELECT batch, count(*) AS n, round(avg(price), 6) AS mean_price FROM
  (SELECT * FROM cells ORDER BY md5('7:' || cell_id), cell_id LIMIT 5000) GROUP BY 1""", CELLS))
def summary_sample(spark, d):
    s = subsets.random_subset(star.cells(spark, d), 5000, seed=7)
    return rounded(s.groupBy("batch").agg(F.count("*").alias("n"), F.avg("price").alias("mean_price")))


SPLIT = """sp AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY batch ORDER BY md5('42:' || cell_id), cell_id)
  <= floor(0.8 * count(*) OVER (PARTITION BY batch)) THEN 'train' ELSE 'val' END AS split FROM cells)"""


@query("T7_train_val_split", with_ctes("SELECT cell_id, split FROM sp", CELLS, SPLIT))
def train_val(spark, d):
    return chunks.apply_split(star.cells(spark, d), train_frac=0.8, by="batch").select("cell_id", "split")


@query("K10_split_by_rule", with_ctes("SELECT split, count(*) AS n FROM (SELECT CASE WHEN donor < 300 THEN 'val' ELSE 'train' END AS split FROM cells) GROUP BY 1", CELLS))
def split_rule(spark, d):
    rule = F.when(F.col("donor") < 300, "val").otherwise("train")
    return chunks.apply_split(star.cells(spark, d), rule).groupBy("split").agg(F.count("*").alias("n"))


@query("T8_example_rows", "SELECT doc_id, CASE WHEN length(text) > 150 THEN substr(text, 1, 150) || '...' ELSE text END AS text FROM documents ORDER BY doc_id LIMIT 3")
def examples(spark, d):
    return subsets.example_rows(star.table(spark, d, "documents").select("doc_id", "text"), 3, "doc_id", ["text"])


# --- sentences ----------------------------------------------------------------

N_HVG, LENGTH = 200, 5
HV = "hv AS (SELECT g.gene_id, g.gene_name, row_number() OVER (ORDER BY g.pos) AS slot FROM genes g JOIN scored USING (gene_id) WHERE highly_variable)"
RANKED = f"""ranked AS (SELECT cell_id, gene_name, rn FROM (SELECT c.cell_id, h.gene_name,
    row_number() OVER (PARTITION BY c.cell_id ORDER BY coalesce(n.value, 0) DESC, h.slot) AS rn
    FROM cells c CROSS JOIN hv h LEFT JOIN norm n ON n.cell_id = c.cell_id AND n.gene_id = h.gene_id) WHERE rn <= {LENGTH}),
sent AS (SELECT cell_id, string_agg(gene_name, ' ' ORDER BY rn) AS cell_sentence, string_agg(gene_name, ', ' ORDER BY rn) AS listed FROM ranked GROUP BY 1)"""
SENTENCE_CTES = (CELLS, GENES, COUNTS, NORM, hvg_ctes(N_HVG), HV, RANKED)


def scored_atlas(spark, d, cells=None) -> Atlas:
    cells = star.cells(spark, d) if cells is None else cells
    norm = log_normalise(star.counts(spark, d))
    genes = variable_genes(norm, cells, star.genes(spark, d), N_HVG)
    return Atlas(cells, genes, norm)


@query("W1_cell_sentences", with_ctes("SELECT cell_id, cell_sentence FROM sent", *SENTENCE_CTES))
def cell_sentences(spark, d):
    a = scored_atlas(spark, d)
    return sentences.cell_sentences(a.counts, a.cells, a.genes, LENGTH).select("cell_id", "cell_sentence")


@query("X4_sentence_by_gene_id", with_ctes("SELECT cell_id, cell_sentence FROM sent",
    CELLS, "genes AS (SELECT p_partkey AS gene_id, p_partkey AS pos, CAST(p_partkey AS VARCHAR) AS gene_name FROM part)", COUNTS, NORM, hvg_ctes(N_HVG), HV, RANKED))
def sentences_by_id(spark, d):
    a = scored_atlas(spark, d)
    return sentences.cell_sentences(a.counts, a.cells, a.genes, LENGTH, name="absent").select("cell_id", "cell_sentence")


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _hex(seed: str, start: int) -> str:
    return f"CAST('0x' || substr(md5('{seed}:' || cell_id), {start}, 8) AS BIGINT)"


SEMANTIC = f"""words AS (SELECT [{', '.join(_lit(t) for t in WITH_LABEL)}] AS w, [{', '.join(_lit(t) for t in WITHOUT_LABEL)}] AS p,
  40 AS nw, 20 AS np),
sem AS (SELECT cell_id, ord, annotation, replace(replace(CASE WHEN {_hex('42:label', 1)} / 4294967296.0 < 0.7
    THEN w[1 + {_hex('42:with', 25)} % nw] ELSE p[1 + {_hex('42:without', 25)} % np] END,
    '{{label}}', annotation), '{{genes}}', listed) AS semantic_true FROM cells JOIN sent USING (cell_id) CROSS JOIN words)"""


@query("X5_semantic_sentences", with_ctes("SELECT cell_id, semantic_true FROM sem", *SENTENCE_CTES, SEMANTIC))
def semantic(spark, d):
    a = scored_atlas(spark, d)
    return sentences.cell_sentences(a.counts, a.cells, a.genes, LENGTH, "annotation").select("cell_id", "semantic_true")


@query("W2_similar_sentences", with_ctes("""SELECT cell_id, coalesce(lead(semantic_true) OVER (PARTITION BY annotation ORDER BY ord),
  first_value(semantic_true) OVER (PARTITION BY annotation ORDER BY ord)) AS semantic_similar FROM sem""", *SENTENCE_CTES, SEMANTIC))
def similar(spark, d):
    a = scored_atlas(spark, d)
    return sentences.cell_sentences(a.counts, a.cells, a.genes, LENGTH, "annotation").select("cell_id", "semantic_similar")


@query("W4_rank_tokens", with_ctes("""SELECT cell_id, string_agg(token, ' ' ORDER BY value / t * 10000.0 / med DESC, token) AS tokens
  FROM counts JOIN (SELECT cell_id, sum(value) AS t FROM counts GROUP BY 1) USING (cell_id)
  JOIN (SELECT gene_id, gene_id * 2 + 1 AS token, median(value) AS med FROM counts GROUP BY 1) USING (gene_id) GROUP BY 1""", COUNTS))
def rank_tokens(spark, d):
    counts = star.counts(spark, d)
    # no gene's values are gathered in one place
    medians = quality.medians(settle(counts.select("gene_id", "value")), ["value"], "gene_id")
    vocabulary = medians.select("gene_id", F.col("med_value").alias("median"), (F.col("gene_id") * 2 + 1).alias("token"))
    out = sentences.rank_tokens(counts, vocabulary)
    return out.select("cell_id", F.array_join(F.transform("tokens", lambda t: t.cast("string")), " ").alias("tokens"))


@query("D8_usable_sentence_keys", with_ctes("SELECT cell_id, cell_sentence FROM sent", *SENTENCE_CTES))
def usable_keys(spark, d):
    a = scored_atlas(spark, d)
    keys = sentences.usable_sentence_keys(["cell_sentence", "semantic_true", "semantic_similar"], None)
    return sentences.cell_sentences(a.counts, a.cells, a.genes, LENGTH).select("cell_id", *keys)


# --- records --------------------------------------------------------------------

SAMPLES = """s AS (SELECT cell_id AS sample_idx, ord, 'cell ' || cell_id AS cell_sentence_1, caption, donor AS batch, 'links/' || batch AS adata_link FROM cells)"""
NEG = """cap_all AS (SELECT caption, min(ord) AS first FROM s GROUP BY 1),
cap_batch AS (SELECT batch, caption, min(ord) AS first FROM s GROUP BY 1, 2),
n1 AS (SELECT s.*, coalesce(
    (SELECT min(first) FROM cap_batch b WHERE b.batch = s.batch AND b.caption <> s.caption),
    (SELECT min(first) FROM cap_all a WHERE a.caption <> s.caption)) AS neg1 FROM s),
pool AS (SELECT s.batch, s.sample_idx, s.ord, b.first FROM s JOIN cap_batch b USING (batch, caption)
    QUALIFY row_number() OVER (PARTITION BY s.batch ORDER BY b.first, s.ord) <= 3),
near2 AS (SELECT n1.sample_idx, arg_min(p.sample_idx, (p.first, p.ord)) AS neg2 FROM n1 JOIN pool p ON p.batch = n1.batch
    WHERE p.sample_idx <> n1.sample_idx AND (n1.neg1 IS NULL OR p.sample_idx <> n1.neg1) GROUP BY 1),
n2 AS (SELECT n1.*, coalesce(near2.neg2, (SELECT min(ord) FROM (SELECT ord FROM s ORDER BY ord LIMIT 3) t WHERE t.ord <> n1.sample_idx AND t.ord <> coalesce(n1.neg1, -1))) AS neg2
    FROM n1 LEFT JOIN near2 USING (sample_idx))"""


def sample_rows(spark, d, batch="donor"):
    c = star.cells(spark, d).withColumn("text", F.concat(F.lit("cell "), "cell_id"))
    return records.samples(c, ["text"], F.concat(F.lit("links/"), "batch"), "caption", batch)


@query("D1_single_records", with_ctes("SELECT sample_idx, cell_sentence_1, adata_link FROM s", CELLS, SAMPLES))
def single(spark, d):
    return records.build_records(sample_rows(spark, d))


@query("D2_pair_records", with_ctes("""SELECT sample_idx, cell_sentence_1, caption, 1.0 AS label, adata_link FROM n1 WHERE neg1 IS NOT NULL
  UNION ALL SELECT n1.sample_idx, n1.cell_sentence_1, o.caption, 0.0, n1.adata_link FROM n1 JOIN s o ON o.sample_idx = n1.neg1""", CELLS, SAMPLES, NEG))
def pairs(spark, d):
    return records.build_records(sample_rows(spark, d), "pairs")


@query("D3_multiplet_records", with_ctes("""SELECT sample_idx, cell_sentence_1, caption AS positive, neg1 AS negative_1_idx, neg2 AS negative_2_idx, adata_link
  FROM n2 WHERE coalesce(neg1, neg2) IS NOT NULL""", CELLS, SAMPLES, NEG))
def multiplets(spark, d):
    return records.build_records(sample_rows(spark, d), "multiplets", 2)


@query("D3_more_negatives", with_ctes("""SELECT n2.sample_idx, neg1 AS negative_1_idx, neg2 AS negative_2_idx, coalesce(near3, far3) AS negative_3_idx
  FROM n2 LEFT JOIN (SELECT n2.sample_idx, arg_min(p.sample_idx, (p.first, p.ord)) AS near3 FROM n2 JOIN poolc p ON p.batch = n2.batch
      WHERE p.caption <> n2.caption AND p.sample_idx NOT IN (n2.neg1, n2.neg2) GROUP BY 1) USING (sample_idx)
  LEFT JOIN (SELECT n2.sample_idx, arg_min(p.sample_idx, (p.first, p.ord)) AS far3 FROM n2 JOIN poola p ON true
      WHERE p.caption <> n2.caption AND p.sample_idx NOT IN (n2.neg1, n2.neg2) GROUP BY 1) USING (sample_idx)""", CELLS, SAMPLES, NEG,
    "poolc AS (SELECT s.batch, s.caption, s.sample_idx, s.ord, b.first FROM s JOIN cap_batch b USING (batch, caption))",
    "poola AS (SELECT s.caption, s.sample_idx, s.ord, a.first FROM s JOIN cap_all a USING (caption) QUALIFY row_number() OVER (PARTITION BY caption ORDER BY ord) <= 5)"))
def more_negatives(spark, d):
    out = records.build_records(sample_rows(spark, d), "multiplets", 3)
    return out.select("sample_idx", "negative_1_idx", "negative_2_idx", "negative_3_idx")


@query("D4_caption_negatives", with_ctes("SELECT sample_idx, neg1 AS negative FROM n1", CELLS, SAMPLES, NEG))
def caption_negatives(spark, d):
    return records.add_negatives(sample_rows(spark, d), 1).select("sample_idx", F.col("negative_1.sample_idx").alias("negative"))


@query("D5_sentence_negatives", with_ctes("SELECT sample_idx, neg2 AS negative FROM n2", CELLS, SAMPLES.replace("donor AS batch", "CAST(NULL AS BIGINT) AS batch"), NEG))
def sentence_negatives(spark, d):
    """Without batches every candidate comes from the whole table."""
    return records.add_negatives(sample_rows(spark, d, None), 2).select("sample_idx", F.col("negative_2.sample_idx").alias("negative"))


@query("J13_resolved_negatives", with_ctes("""SELECT n2.sample_idx, a.caption AS negative_1, b.cell_sentence_1 AS negative_2 FROM n2
  LEFT JOIN s a ON a.sample_idx = neg1 LEFT JOIN s b ON b.sample_idx = neg2 WHERE coalesce(neg1, neg2) IS NOT NULL""", CELLS, SAMPLES, NEG))
def resolved(spark, d):
    return records.build_records(sample_rows(spark, d), "multiplets", 2, resolve=True).select("sample_idx", "negative_1", "negative_2")


@query("D6_checked_request", with_ctes("SELECT count(*) AS n FROM s", CELLS, SAMPLES))
def checked(spark, d):
    refused = 0
    for bad in (("triples", 1, "caption"), ("pairs", 0, "caption"), ("pairs", 1, None)):
        try:
            records.check_request(*bad)
        except ValueError:
            refused += 1
    assert refused == 3
    records.check_request("multiplets", 2, "caption")
    return records.build_records(sample_rows(spark, d)).agg(F.count("*").alias("n"))


@query("U1_pooled_samples", with_ctes("""SELECT sample_idx, caption FROM (SELECT o_custkey AS sample_idx, o_orderpriority AS caption FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1) WHERE sample_idx NOT IN (SELECT c_custkey FROM customer)
  UNION ALL SELECT c_custkey, c_mktsegment FROM customer""", CELLS))
def pooled(spark, d):
    o = star.table(spark, d, "orders").select(
        F.col("o_custkey").alias("sample_idx"), F.col("o_orderkey").alias("ord"), F.col("o_orderpriority").alias("caption"))
    c = star.table(spark, d, "customer").select(
        F.col("c_custkey").alias("sample_idx"), F.col("c_custkey").alias("ord"), F.col("c_mktsegment").alias("caption"))
    return setops.pool_samples([o, c]).select("sample_idx", "caption")


D7_SAMPLES = """sp2 AS (SELECT *, CASE WHEN donor < 300 THEN 'val' ELSE 'train' END AS split FROM cells),
s0 AS (SELECT cell_id AS sample_idx, ord, cell_sentence AS cell_sentence_1, caption, split || '|' || batch AS batch, split, 'files/' || batch AS adata_link
  FROM sp2 JOIN sent USING (cell_id))"""
D7_NEG = """cap_batch AS (SELECT batch, caption, min(ord) AS first FROM s0 GROUP BY 1, 2),
n1 AS (SELECT s0.*, (SELECT min(first) FROM cap_batch b WHERE b.batch = s0.batch AND b.caption <> s0.caption) AS neg1 FROM s0)"""


def split_atlas(spark, d):
    a = scored_atlas(spark, d)
    rule = F.when(F.col("donor") < 300, "val").otherwise("train")
    return a.with_(cells=chunks.apply_split(a.cells, rule).withColumn("path", F.concat(F.lit("files/"), "batch")))


@query("D7_split_records", with_ctes("SELECT split, sample_idx, cell_sentence_1, caption AS positive, neg1 AS negative_1_idx, adata_link FROM n1",
                                      *SENTENCE_CTES, D7_SAMPLES, D7_NEG))
def split_records(spark, d):
    return dataset.build_split_records(split_atlas(spark, d), LENGTH, caption="caption", batch="batch", n_negatives=1)


@query("D10_record_variants", with_ctes("""SELECT cs_length, caption_key, sample_idx, cell_sentence_1, positive,
    (SELECT min(first) FROM firsts f WHERE f.caption_key = r.caption_key AND f.batch = r.batch AND f.positive <> r.positive) AS negative_1_idx FROM r""",
    *SENTENCE_CTES, D7_SAMPLES, """texts AS (SELECT 5 AS cs_length, cell_id, cell_sentence FROM sent
  UNION ALL SELECT 3, cell_id, string_agg(gene_name, ' ' ORDER BY rn) FROM ranked WHERE rn <= 3 GROUP BY cell_id)""",
    """r AS (SELECT cs_length, caption_key, cell_id AS sample_idx, ord, cell_sentence AS cell_sentence_1, split || '|' || batch AS batch,
  CASE WHEN caption_key = 'caption' THEN caption ELSE annotation END AS positive
  FROM sp2 JOIN texts USING (cell_id) CROSS JOIN (VALUES ('caption'), ('annotation')) k(caption_key))""",
    "firsts AS (SELECT caption_key, batch, positive, min(ord) AS first FROM r GROUP BY 1, 2, 3)"))
def record_variants(spark, d):
    out = dataset.build_variants(split_atlas(spark, d), [LENGTH, 3], ["caption", "annotation"], batch="batch", n_negatives=1)
    return out.select("cs_length", "caption_key", "sample_idx", "cell_sentence_1", "positive", "negative_1_idx")


@query("J12_panel_gene_rows", """SELECT p_partkey AS gene_id, p_name AS gene_name, CAST(row_number() OVER (ORDER BY p_partkey DESC) - 1 AS INTEGER) AS slot
  FROM part WHERE p_type IN ('ECONOMY', 'PROMO')""")
def panel_rows(spark, d):
    g = star.genes(spark, d)
    panel = panel_from(g.filter(F.col("biotype").isin("ECONOMY", "PROMO")).withColumn("down", -F.col("pos")), "down")
    return panel_genes(g, panel).select("gene_id", "gene_name", "slot")
