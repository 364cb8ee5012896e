"""Gene panels, annotation and marker sources, term tables and texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlasloom.functions import text
from atlasloom.operators import filters, panel, setops, terms
from atlasloom.operators.ranking import first_per_key
from atlasloom.sources import ontology, tables
from atlasloom.sources import star_schema as star
from query_catalogue.registry import EXPRESSION, query, rounded, scratch, with_ctes

KEEP = ("ECONOMY", "PROMO", "STANDARD")


def raw_expression(spark, d):
    l = star.table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    o = star.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = star.table(spark, d, "customer").select("c_custkey", "c_nationkey")
    j = l.join(o, l.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == F.col("c_custkey"))
    return j.select(F.concat(F.lit("ENSG"), "l_partkey").alias("Gene"), F.col("c_nationkey").alias("Tissue"), F.col("l_quantity").alias("nTPM"))


@query("S11_expression_table", with_ctes("""SELECT gene AS Gene, CAST(tissue AS VARCHAR) AS Tissue, ntpm AS nTPM FROM expression""", EXPRESSION))
def expression(spark, d):
    path = scratch(spark) + "/expression"
    e = panel.tissue_maxima(raw_expression(spark, d))
    e.select(F.concat("Gene", F.lit(".4")).alias("GENE"), F.col("Tissue").alias("tissue"), F.col("nTPM").alias("NTPM")).write.csv(path, sep="\t", header=True)
    return tables.read_expression(spark, path)


ATTR = """'gene_id "ENSG' || p_partkey || '.2"; gene_type "' || p_type || '";' || CASE WHEN p_size > 5 THEN ' gene_name "' || p_name || '";' ELSE '' END"""


def annotation_lines(spark, d):
    p = star.table(spark, d, "part")
    attr = F.concat(F.lit('gene_id "ENSG'), "p_partkey", F.lit('.2"; gene_type "'), "p_type", F.lit('";'), F.when(
        F.col("p_size") > 5, F.concat(F.lit(' gene_name "'), "p_name", F.lit('";'))).otherwise(""))
    return p.select(F.col("p_brand").alias("seqname"), F.lit("src").alias("source"), F.when(
        F.col("p_size") == 50, "exon").otherwise("gene").alias("feature"), F.lit("1").alias("start"), F.lit("2").alias("end"),
        F.lit(".").alias("score"), F.lit("+").alias("strand"), F.lit(".").alias("frame"), attr.alias("attribute"))


GTF = """gtf AS (SELECT p_brand AS seqname, p_type AS gene_type, p_name AS gene_name, 'ENSG' || p_partkey || '.2' AS ensembl_gene_id,
  'ENSG' || p_partkey AS ensembl_gene_id_novers FROM part WHERE p_size > 5 AND p_size <> 50)"""


@query("S12_gene_annotation", with_ctes("SELECT * FROM gtf", GTF))
def annotation(spark, d):
    path = scratch(spark) + "/annotation"
    annotation_lines(spark, d).write.csv(path, sep="\t", quote="")
    return tables.read_gene_annotation(spark, path)


@query("S13_marker_symbols", "SELECT DISTINCT symbol FROM (SELECT p_name AS symbol FROM part UNION ALL SELECT unnest(string_split(p_name || ' ' || p_type, ' ')) FROM part WHERE p_size > 3)")
def markers(spark, d):
    p = star.table(spark, d, "part")
    several = F.when(F.col("p_size") > 3, F.concat(F.translate("p_name", " ", ","), F.lit(" ; "), "p_type"))
    return tables.marker_symbols(p.select(F.col("p_name").alias("geneSymbol"), several.alias("geneID")))


@query("S13_listed_symbols", "SELECT DISTINCT p_name AS symbol FROM part")
def listed(spark, d):
    return tables.listed_symbols(star.table(spark, d, "part").select("p_partkey", F.col("p_name").alias("official gene symbol")))


@query("U9_marker_union", "SELECT p_name AS symbol FROM part WHERE p_brand = 'Brand#1' UNION SELECT p_type FROM part")
def marker_union(spark, d):
    p = star.table(spark, d, "part")
    return setops.union_distinct(
        tables.marker_symbols(p.filter("p_brand = 'Brand#1'").select(F.col("p_name").alias("geneSymbol"))),
        tables.listed_symbols(p.select(F.col("p_type").alias("gene"))))


@query("A13_tissue_maxima", with_ctes("SELECT gene AS Gene, tissue AS Tissue, ntpm AS nTPM FROM expression", EXPRESSION))
def maxima(spark, d):
    return panel.tissue_maxima(raw_expression(spark, d))


@query("A13_tissue_matrix", with_ctes("SELECT gene AS Gene, " + ", ".join(
    f"coalesce(max(ntpm) FILTER (WHERE tissue = {i}), 0) AS \"{i}\"" for i in range(25)) + " FROM expression GROUP BY 1", EXPRESSION))
def matrix(spark, d):
    return panel.tissue_matrix(raw_expression(spark, d), list(range(25)))


STATS = """st AS (SELECT gene, count(*) FILTER (WHERE x >= 20) AS detected_in, avg(x) AS mean_ntpm, var_pop(x) AS var_ntpm,
    CASE WHEN max(x) > 0 THEN sum(1 - x / mx) / (count(*) - 1) ELSE 0 END AS tau FROM (
  SELECT g.gene, coalesce(e.ntpm, 0) AS x, max(coalesce(e.ntpm, 0)) OVER (PARTITION BY g.gene) AS mx
  FROM (SELECT DISTINCT gene FROM expression) g CROSS JOIN (SELECT DISTINCT tissue FROM expression) t LEFT JOIN expression e ON e.gene = g.gene AND e.tissue = t.tissue) GROUP BY 1)"""


@query("A14_tau", with_ctes("SELECT gene AS Gene, round(tau, 9) AS tau FROM st", EXPRESSION, STATS))
def tau(spark, d):
    return rounded(panel.expression_statistics(raw_expression(spark, d), 20.0).select("Gene", "tau"), 9)


@query("A15_detection_statistics", with_ctes("SELECT gene AS Gene, detected_in, round(mean_ntpm, 6) AS mean_ntpm, round(var_ntpm, 6) AS var_ntpm FROM st WHERE detected_in >= 5", EXPRESSION, STATS))
def detection(spark, d):
    s = panel.expression_statistics(raw_expression(spark, d), 20.0).filter("detected_in >= 5")
    return rounded(s.select("Gene", "detected_in", "mean_ntpm", "var_ntpm"))


@query("A16_zscores", "SELECT o_orderkey, round((o_totalprice - (SELECT avg(o_totalprice) FROM orders)) / ((SELECT stddev_pop(o_totalprice) FROM orders) + 1e-9), 6) AS z_o_totalprice FROM orders")
def zscores(spark, d):
    return rounded(panel.zscores(star.table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice"]).select("o_orderkey", "z_o_totalprice"))


SCORED = """base AS (SELECT gtf.*, st.* FROM gtf JOIN st ON st.gene = ensembl_gene_id_novers WHERE detected_in >= 5 AND gene_type IN ('ECONOMY', 'PROMO', 'STANDARD')),
zs AS (SELECT *, 0.5 * (var_ntpm - avg(var_ntpm) OVER ()) / (stddev_pop(var_ntpm) OVER () + 1e-9) + 0.3 * (tau - avg(tau) OVER ()) / (stddev_pop(tau) OVER () + 1e-9)
  + 0.2 * (mean_ntpm - avg(mean_ntpm) OVER ()) / (stddev_pop(mean_ntpm) OVER () + 1e-9) AS score FROM base)"""


def gene_panel(spark, d, top_n, with_markers=False):
    marks = star.table(spark, d, "part").filter("p_brand = 'Brand#1'").select(F.col("p_name").alias("symbol")) if with_markers else None
    lines = tables.gene_annotation(annotation_lines(spark, d))
    return panel.build_panel(lines, raw_expression(spark, d), top_n, 5, 20.0, keep_biotypes=KEEP, markers=marks)


@query("T1_gene_panel", with_ctes("SELECT ensembl_gene_id, gene_name, round(score, 6) AS score FROM zs ORDER BY zs.score DESC, ensembl_gene_id LIMIT 300", EXPRESSION, STATS, GTF, SCORED))
def panel_query(spark, d):
    return rounded(gene_panel(spark, d, 300).select("ensembl_gene_id", "gene_name", "score"))


@query("T1_gene_panel_with_markers", with_ctes("""SELECT ensembl_gene_id, gene_name, round(score, 6) AS score FROM (SELECT *, gene_name IN (SELECT p_name FROM part WHERE p_brand = 'Brand#1') AS forced FROM zs
  QUALIFY row_number() OVER (PARTITION BY gene_name ORDER BY score DESC, ensembl_gene_id) = 1) u ORDER BY forced DESC, u.score DESC, ensembl_gene_id LIMIT 50""", EXPRESSION, STATS, GTF, SCORED))
def marked_panel(spark, d):
    return rounded(gene_panel(spark, d, 50, True).select("ensembl_gene_id", "gene_name", "score"))


@query("T2_panel_ids", with_ctes("SELECT DISTINCT ensembl_gene_id_novers AS gene_id FROM (SELECT * FROM zs ORDER BY score DESC, ensembl_gene_id LIMIT 300)", EXPRESSION, STATS, GTF, SCORED))
def panel_ids(spark, d):
    return panel.panel_ids(gene_panel(spark, d, 300))


@query("W5_first_per_key", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1")
def first_row(spark, d):
    return first_per_key(star.table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), "o_custkey", "o_orderkey")


# --- ontology documents -------------------------------------------------------------


@query("S14_ontology_graph", """SELECT term_id, label, definition, synonyms, xrefs, coalesce(parents, '') AS parents FROM (
  SELECT 'MONDO:' || l_orderkey || '-' || l_linenumber AS term_id, l_returnflag AS label, CASE WHEN l_linenumber = 1 THEN NULL ELSE 'line of ' || l_suppkey END AS definition,
    CASE WHEN l_linestatus = 'F' THEN '' ELSE 'part ' || l_partkey || '|s' END AS synonyms, 'S:' || l_suppkey AS xrefs,
    CASE WHEN l_linenumber > 1 THEN rtrim(repeat('MONDO:' || l_orderkey || '|', n), '|') END AS parents FROM lineitem
    JOIN (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2) USING (l_orderkey, l_linenumber) WHERE l_returnflag <> 'R')""")
def graph(spark, d):
    l = star.table(spark, d, "lineitem")
    ident = F.concat(F.lit("MONDO:"), "l_orderkey", F.lit("-"), "l_linenumber")

    def val(c):
        return F.struct(c.alias("val"))

    node = F.struct(
        ident.alias("id"), F.col("l_returnflag").alias("lbl"), F.when(F.col("l_returnflag") == "R", "PROPERTY").otherwise("CLASS").alias("type"),
        F.struct(F.when(F.col("l_linenumber") > 1, val(F.concat(F.lit("line of "), "l_suppkey"))).alias("definition"),
                 F.when(F.col("l_linestatus") != "F", F.array(val(F.concat(F.lit("part "), "l_partkey")), val(F.lit("")), val(F.lit("s")))).alias("synonyms"),
                 F.array(val(F.concat(F.lit("S:"), "l_suppkey"))).alias("xrefs")).alias("meta"))
    edge = F.struct(ident.alias("sub"), F.when(F.col("l_linenumber") > 1, "is_a").otherwise("other").alias("pred"),
                    F.concat(F.lit("MONDO:"), "l_orderkey").alias("obj"))
    docs = l.groupBy("l_orderkey").agg(F.collect_list(node).alias("nodes"), F.collect_list(edge).alias("edges"))
    docs = docs.select(F.to_json(F.struct(F.array(F.struct("nodes", "edges")).alias("graphs"))).alias("json"))
    out = ontology.graph_terms(docs)
    return out.select("term_id", "label", "definition", *[F.array_join(c, "|").alias(c) for c in ("synonyms", "xrefs", "parents")])


@query("S15_ontology_pages", """SELECT 'MONDO:' || l_partkey AS term_id, 'label ' || l_suppkey AS label, l_orderkey || '/' || l_linenumber AS definition
  FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber) = 1""")
def pages(spark, d):
    l = star.table(spark, d, "lineitem")
    term = F.struct(F.col("l_linenumber"), F.concat(F.lit("MONDO:"), "l_partkey").alias("obo_id"), F.concat(F.lit("label "), "l_suppkey").alias("label"),
                    F.array(F.concat("l_orderkey", F.lit("/"), "l_linenumber")).alias("description"))
    p = l.groupBy(F.col("l_orderkey").alias("page")).agg(F.sort_array(F.collect_list(term)).alias("terms"))
    p = p.select("page", F.to_json(F.struct(F.struct("terms").alias("_embedded"))).alias("json"))
    return ontology.page_terms(p).select("term_id", "label", "definition")


@query("S15_unique_labels", """SELECT DISTINCT label FROM (SELECT 'label ' || l_suppkey AS label FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber) = 1)""")
def labels(spark, d):
    return ontology.unique_labels(pages(spark, d))


# --- texts ----------------------------------------------------------------------------

WS = r"[\s\p{Z}\x0b\x85]"


def docs(spark, d):
    return star.table(spark, d, "documents")


@query("X6_clean_definitions", rf"SELECT doc_id, trim(regexp_replace(regexp_replace(replace(text, '. ', '. [PMID:' || doc_id || '] '), '\[[^\n]*?\]', '', 'g'), '{WS}+', ' ', 'g')) AS definition FROM documents")
def definitions(spark, d):
    t = F.replace(F.col("text"), F.lit(". "), F.concat(F.lit(". [PMID:"), "doc_id", F.lit("] ")))
    return docs(spark, d).select("doc_id", text.clean_definition(t).alias("definition"))


@query("X7_joined_synonyms", "SELECT p_partkey, CASE WHEN p_size > 25 THEN p_name ELSE p_type END AS definition, array_to_string(list_concat(string_split(p_name || ' x y', ' ')[1:3], CASE WHEN p_size > 10 THEN [p_type] ELSE [] END), '; ') AS synonyms FROM part")
def synonyms(spark, d):
    p = star.table(spark, d, "part")
    return p.select("p_partkey", text.first_definition(F.when(F.col("p_size") > 25, F.col("p_name")).otherwise(""), F.col("p_type")).alias("definition"),
                    text.joined_synonyms(F.split(F.concat("p_name", F.lit(" x y")), " "), F.when(F.col("p_size") > 10, F.array("p_type"))).alias("synonyms"))


@query("X8_abstract_definitions", rf"""SELECT doc_id, CASE WHEN n > 0 THEN CASE WHEN length(j) > 300 THEN substr(j, 1, 300) || '...' ELSE j END END AS definition FROM (
  SELECT d.doc_id, count(rk) AS n, string_agg(line, ' ' ORDER BY i) FILTER (WHERE rk <= 2) AS j FROM documents d LEFT JOIN (
    SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS rk FROM (
      SELECT *, coalesce(min(CASE WHEN stop THEN i END) OVER (PARTITION BY doc_id), 1000000000) AS stop_at FROM (
        SELECT doc_id, i, line, regexp_matches(lower(line), 'author|pmid:|doi:|©|copyright|affiliat') AS stop FROM (
          SELECT doc_id, i, regexp_replace(raw, '^{WS}+|{WS}+$', '', 'g') AS line FROM (
            SELECT doc_id, unnest(range(len(l))) AS i, unnest(l) AS raw FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)))))
    WHERE i < stop_at AND length(line) > 20 AND NOT ends_with(line, '.')) USING (doc_id) GROUP BY 1)""")
def abstracts(spark, d):
    return docs(spark, d).select("doc_id", text.abstract_definition(F.col("text")).alias("definition"))


@query("X9_stripped_markup", rf"SELECT page_id, nullif(substr(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '^{WS}+|{WS}+$', '', 'g'), 1, 500), '') AS text FROM pages")
def markup(spark, d):
    return star.table(spark, d, "pages").select("page_id", text.strip_markup(F.col("html")).alias("text"))


CLEAN = rf"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\n+', chr(10), 'g'), '{WS}{{2,}}', ' ', 'g'),
  '([\p{{L}}\p{{N}}\p{{M}}_])\n([\p{{L}}\p{{N}}\p{{M}}_])', '\1 \2', 'g'), '(\.|;|:)\n', '\1 ', 'g'), '^{WS}+|{WS}+$', '', 'g')"""


@query("X10_clean_full_text", f"SELECT doc_id, {CLEAN} AS text FROM documents")
def full_text(spark, d):
    return docs(spark, d).select("doc_id", text.clean_full_text(F.col("text")).alias("text"))


@query("X10_section", rf"SELECT doc_id, CASE WHEN regexp_matches(text, 'the\s*(.*?)\n[A-Z]', 's') THEN regexp_replace(regexp_extract(text, 'the\s*(.*?)\n[A-Z]', 1, 's'), '^{WS}+|{WS}+$', '', 'g') ELSE 'Error: the section not found.' END AS section FROM documents")
def section(spark, d):
    return docs(spark, d).select("doc_id", text.extract_section(F.col("text"), "the").alias("section"))


@query("X11_chosen_gene_ids", "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN CAST(p_partkey AS VARCHAR) WHEN p_size % 3 = 1 THEN p_name END AS gene_id FROM part")
def chosen(spark, d):
    p = star.table(spark, d, "part")
    ens, r = F.concat(F.lit("ENSG"), "p_partkey"), F.col("p_size") % 3
    hits = F.when(r == 0, F.array(ens, F.col("p_name"), F.col("p_partkey").cast("string"))).when(r == 1, F.array(ens, F.col("p_name"))).otherwise(F.array(ens))
    return p.select("p_partkey", text.choose_gene_id(hits).alias("gene_id"))


TYPES = "CASE o_orderpriority WHEN '1-URGENT' THEN 'diseases' WHEN '2-HIGH' THEN 'genes' WHEN '3-MEDIUM' THEN 'cell_types' WHEN '4-NOT SPECIFIED' THEN 'tissues' ELSE 'something' END"
KINDS = """cand AS (SELECT o_custkey AS term, """ + TYPES + """ AS term_type, (['ontology', 'dictionary', 'gene', 'books', 'placeholder'])[1 + o_orderkey % 5] AS kind,
  (['MONDO', 'HP', 'CL', 'UBERON', 'FMA', 'GO', 'PR'])[1 + o_orderkey % 7] AS ontology, CASE WHEN o_orderstatus = 'P' THEN '' ELSE 'text ' || o_orderkey END AS description,
  'source ' || o_orderkey AS definition_source FROM orders),
rk AS (SELECT *, CASE kind WHEN 'ontology' THEN CASE term_type WHEN 'diseases' THEN CASE ontology WHEN 'MONDO' THEN 0 WHEN 'HP' THEN 1 END
    WHEN 'genes' THEN CASE ontology WHEN 'GO' THEN 0 WHEN 'PR' THEN 1 END WHEN 'cell_types' THEN CASE ontology WHEN 'CL' THEN 0 END
    WHEN 'tissues' THEN CASE ontology WHEN 'UBERON' THEN 0 WHEN 'FMA' THEN 1 END ELSE CASE ontology WHEN 'CL' THEN 0 WHEN 'MONDO' THEN 1 WHEN 'UBERON' THEN 2 END END
  WHEN 'dictionary' THEN 100 WHEN 'gene' THEN CASE WHEN term_type = 'genes' THEN 200 END WHEN 'books' THEN 300 ELSE 900 END AS r FROM cand)"""


@query("X12_resolved_terms", with_ctes("SELECT term, term_type, description, definition_source FROM rk WHERE r IS NOT NULL AND description <> '' QUALIFY row_number() OVER (PARTITION BY term, term_type ORDER BY r, description) = 1", KINDS))
def resolved_terms(spark, d):
    o = star.table(spark, d, "orders")
    pr = F.col("o_orderpriority")
    kinds, onts = ["ontology", "dictionary", "gene", "books", "placeholder"], ["MONDO", "HP", "CL", "UBERON", "FMA", "GO", "PR"]
    c = o.select(
        F.col("o_custkey").alias("term"),
        F.when(pr == "1-URGENT", "diseases").when(pr == "2-HIGH", "genes").when(pr == "3-MEDIUM", "cell_types").when(
            pr == "4-NOT SPECIFIED", "tissues").otherwise("something").alias("term_type"),
        F.get(F.array(*map(F.lit, kinds)), (F.col("o_orderkey") % 5).cast("int")).alias("kind"),
        F.get(F.array(*map(F.lit, onts)), (F.col("o_orderkey") % 7).cast("int")).alias("ontology"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.concat(F.lit("text "), "o_orderkey")).alias("description"),
        F.concat(F.lit("source "), "o_orderkey").alias("definition_source"))
    return terms.resolve_terms(c)


CITE = "cites AS (SELECT * FROM (VALUES " + ", ".join(f"('{s}', '{t}', '{l}', '{c}')" for s, t, l, c in terms.CITATIONS) + ") v(src, title, link, citation))"
TERMS = """terms AS (SELECT p_partkey, p_name || ' ' || p_partkey AS term, CASE WHEN p_size < 5 THEN NULL WHEN p_size < 8 THEN '  ' ELSE 'definition of ' || p_name END AS description,
  CASE WHEN p_type = 'ECONOMY' THEN 'CL Ontology' WHEN p_type = 'PROMO' THEN 'GO Ontology' ELSE p_type END AS definition_source,
  replace(p_name, ' ', ' ; ;') || CASE WHEN p_size > 30 THEN '; a; b' ELSE '' END AS synonyms FROM part)"""
PAIRS = """described AS (SELECT *, coalesce(title, definition_source) AS source_database, coalesce(link, 'https://www.ebi.ac.uk/ols/') AS source_link
  FROM terms LEFT JOIN cites ON src = definition_source WHERE description IS NOT NULL AND trim(description) <> ''),
parts AS (SELECT p_partkey, unnest(string_split(synonyms, ';')) AS s, unnest(range(len(string_split(synonyms, ';')))) AS i FROM described),
syn AS (SELECT p_partkey, trim(s) AS s FROM parts WHERE trim(s) <> '' QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY i) <= 3),
pairs AS (SELECT term AS anchor, description AS positive, source_database, source_link, false AS is_synonym FROM described
  UNION ALL SELECT s, description, source_database, source_link, true FROM described JOIN syn USING (p_partkey))"""


def term_rows(spark, d):
    p = star.table(spark, d, "part")
    return p.select(
        F.concat("p_name", F.lit(" "), "p_partkey").alias("term"),
        F.when(F.col("p_size") < 5, None).when(F.col("p_size") < 8, "  ").otherwise(F.concat(F.lit("definition of "), "p_name")).alias("description"),
        F.when(F.col("p_type") == "ECONOMY", "CL Ontology").when(F.col("p_type") == "PROMO", "GO Ontology").otherwise(F.col("p_type")).alias("definition_source"),
        F.concat(F.replace(F.col("p_name"), F.lit(" "), F.lit(" ; ;")), F.when(F.col("p_size") > 30, "; a; b").otherwise("")).alias("synonyms"),
        F.col("p_type").alias("term_type"))


@query("X13_citations", with_ctes("SELECT term, coalesce(title, definition_source) AS source_database, coalesce(link, 'https://www.ebi.ac.uk/ols/') AS source_link, coalesce(citation, 'Source: ' || definition_source || '. Retrieved from EBI Ontology Lookup Service.') AS source_citation FROM terms LEFT JOIN cites ON src = definition_source", TERMS, CITE))
def citations(spark, d):
    return terms.with_citation(term_rows(spark, d)).select("term", "source_database", "source_link", "source_citation")


@query("F11_described_terms", with_ctes("SELECT term, trim(coalesce(description, '')) <> '' AS kept FROM terms", TERMS))
def described(spark, d):
    kept, dropped = filters.described_terms(term_rows(spark, d))
    return kept.select("term", F.lit(True).alias("kept")).unionByName(dropped.select("term", F.lit(False).alias("kept")))


@query("D9_anchor_pairs", with_ctes("SELECT * FROM pairs", TERMS, CITE, PAIRS))
def anchor_pairs(spark, d):
    return terms.anchor_pairs(term_rows(spark, d))


@query("A21_pair_statistics", with_ctes("SELECT count(*) AS total_pairs, count(*) FILTER (WHERE NOT is_synonym) AS main_terms, count(*) FILTER (WHERE is_synonym) AS synonym_pairs, count(DISTINCT source_database) AS n_sources FROM pairs", TERMS, CITE, PAIRS))
def pair_statistics(spark, d):
    return terms.pair_statistics(terms.anchor_pairs(term_rows(spark, d)))


@query("A22_token_lengths", rf"SELECT lang, max(n) AS max_tokens, round(avg(n), 6) AS mean_tokens FROM (SELECT lang, CASE WHEN t = '' THEN 0 ELSE len(regexp_split_to_array(t, '{WS}+')) END AS n FROM (SELECT lang, regexp_replace(text, '^{WS}+|{WS}+$', '', 'g') AS t FROM documents)) GROUP BY 1")
def token_lengths(spark, d):
    return rounded(terms.token_lengths(docs(spark, d), text.whitespace_tokens(F.col("text")), "lang"))


@query("S17_term_tables", with_ctes("SELECT p_type AS term_type, count(*) AS n, count(DISTINCT term) AS terms FROM terms JOIN part USING (p_partkey) GROUP BY 1", TERMS))
def term_tables(spark, d):
    path = scratch(spark) + "/terms"
    terms.save_term_tables(term_rows(spark, d), path)
    return spark.read.csv(path, header=True, escape='"').groupBy("term_type").agg(F.count("*").alias("n"), F.count_distinct("term").alias("terms"))
