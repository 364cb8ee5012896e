"""Term tables: definitions from several sources, and anchor-positive pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlasloom.functions.text import strip
from atlasloom.operators.filters import described_terms

# Ontologies asked per kind of term, in order; the last entry is for any other kind.
ONTOLOGY_ORDER = {
    "cell_types": ("cl",),
    "diseases": ("mondo", "hp", "doid"),
    "tissues": ("uberon", "fma"),
    "organisms": ("ncbitaxon",),
    "genes": ("go", "pr"),
    "other": ("cl", "mondo", "uberon"),
}

# Source name, title, link.
CITATIONS = (
    ("CL Ontology", "Cell Ontology (CL)", "https://www.ebi.ac.uk/ols/ontologies/cl",
     "Diehl, A.D., et al. (2016). The Cell Ontology 2016: enhanced content, modularization, and ontology interoperability. Journal of Biomedical Semantics, 7(1), 44."),
    ("MONDO Ontology", "Mondo Disease Ontology (MONDO)", "https://www.ebi.ac.uk/ols/ontologies/mondo",
     "Vasilevsky, N.A., et al. (2022). Mondo: Unifying diseases for the world, by the world. medRxiv."),
    ("HP Ontology", "Human Phenotype Ontology (HPO)", "https://www.ebi.ac.uk/ols/ontologies/hp",
     "Köhler, S., et al. (2021). The Human Phenotype Ontology in 2021. Nucleic Acids Research, 49(D1), D1207-D1217."),
    ("UBERON Ontology", "Uberon Anatomy Ontology", "https://www.ebi.ac.uk/ols/ontologies/uberon",
     "Mungall, C.J., et al. (2012). Uberon, an integrative multi-species anatomy ontology. Genome Biology, 13(1), R5."),
    ("GO Ontology", "Gene Ontology (GO)", "https://www.ebi.ac.uk/ols/ontologies/go",
     "The Gene Ontology Consortium (2021). The Gene Ontology resource: enriching a GOld mine. Nucleic Acids Research, 49(D1), D325-D334."),
    ("NCBITAXON Ontology", "NCBI Taxonomy", "https://www.ebi.ac.uk/ols/ontologies/ncbitaxon",
     "Schoch, C.L., et al. (2020). NCBI Taxonomy: a comprehensive update on curation, resources and tools. Database, 2020, baaa062."),
    ("DOID Ontology", "Disease Ontology (DOID)", "https://www.ebi.ac.uk/ols/ontologies/doid",
     "Schriml, L.M., et al. (2019). Human Disease Ontology 2018 update: classification, content and workflow expansion. Nucleic Acids Research, 47(D1), D955-D962."),
    ("FMA Ontology", "Foundational Model of Anatomy (FMA)", "https://www.ebi.ac.uk/ols/ontologies/fma",
     "Rosse, C. & Mejino Jr, J.L. (2003). A reference ontology for biomedical informatics: the Foundational Model of Anatomy. Journal of Biomedical Informatics, 36(6), 478-500."),
    ("PR Ontology", "Protein Ontology (PRO)", "https://www.ebi.ac.uk/ols/ontologies/pr",
     "Natale, D.A., et al. (2011). Protein Ontology: a controlled structured network of protein entities. Nucleic Acids Research, 39(suppl_1), D464-D467."),
)
DEFAULT_LINK = "https://www.ebi.ac.uk/ols/"
DEFAULT_CITATION = "Source: {}. Retrieved from EBI Ontology Lookup Service."

# Order in which the kinds of sources are believed; a placeholder only if nothing else is there.
SOURCE_RANK = {"ontology": 0, "dictionary": 1, "gene": 2, "books": 3, "placeholder": 9}


def source_rank(term_type: Column, kind: Column, ontology: Column) -> Column:
    """Sortable precedence of a candidate; null when the source is not asked for that kind of term."""
    place = F.lit(None).cast("int")
    for t, names in reversed(ONTOLOGY_ORDER.items()):
        here = F.lit(None).cast("int")
        for i, n in enumerate(names):
            here = F.when(F.lower(ontology) == n, F.lit(i)).otherwise(here)
        known = F.lit(True) if t == "other" else term_type == t
        place = F.when(known, here).otherwise(place)
    rank = F.lit(None).cast("int")
    for k, r in SOURCE_RANK.items():
        rank = F.when(kind == k, F.lit(r * 100)).otherwise(rank)
    rank = F.when((kind == "gene") & (term_type != "genes"), F.lit(None)).otherwise(rank)
    return F.when(kind == "ontology", rank + place).otherwise(rank)


def resolve_terms(candidates: DataFrame) -> DataFrame:
    """One definition per (term, term_type): the non-empty candidate of best precedence.

    ``candidates(term, term_type, kind, ontology, description, definition_source)``.
    """
    c = candidates.withColumn("_rank", source_rank(F.col("term_type"), F.col("kind"), F.col("ontology")))
    c = c.filter(F.col("_rank").isNotNull() & F.coalesce(F.col("description") != "", F.lit(False)))
    row = F.struct("description", "definition_source")
    return c.groupBy("term", "term_type").agg(F.min_by(row, F.struct("_rank", "description")).alias("_r")).select(
        "term", "term_type", "_r.*")


def with_citation(df: DataFrame, source: str = "definition_source") -> DataFrame:
    """Title, link and citation text of the source; an unknown source is its own title."""
    known = df.sparkSession.createDataFrame(CITATIONS, "_src string, _title string, _link string, _text string")
    before, after = DEFAULT_CITATION.split("{}")
    return df.join(F.broadcast(known), df[source] == known["_src"], "left").withColumns({
        "source_database": F.coalesce("_title", F.col(source)),
        "source_link": F.coalesce("_link", F.lit(DEFAULT_LINK)),
        "source_citation": F.coalesce("_text", F.concat(F.lit(before), F.col(source), F.lit(after)))}).drop("_src", "_title", "_link", "_text")


def anchor_pairs(terms: DataFrame) -> DataFrame:
    """A pair per synonym (at most three) and one for the term itself; terms without definition give none."""
    described, _ = described_terms(terms)
    cited = with_citation(described)
    parts = F.transform(F.split(F.coalesce("synonyms", F.lit("")), ";"), strip)
    syn = F.slice(F.filter(parts, lambda s: s != ""), 1, 3)
    rows = F.concat(
        F.transform(syn, lambda s: F.struct(s.alias("anchor"), F.lit(True).alias("is_synonym"))),
        F.array(F.struct(F.col("term").alias("anchor"), F.lit(False).alias("is_synonym"))))
    return cited.select(F.inline(rows), F.col("description").alias("positive"), "source_database", "source_link")


def pair_statistics(pairs: DataFrame) -> DataFrame:
    return pairs.agg(
        F.count(F.lit(1)).alias("total_pairs"), F.count_if(~F.col("is_synonym")).alias("main_terms"),
        F.count_if("is_synonym").alias("synonym_pairs"), F.count_distinct("source_database").alias("n_sources"))


def token_lengths(terms: DataFrame, tokens: Column, by: str | None = None) -> DataFrame:
    t = terms.withColumn("_n", tokens)
    return t.groupBy(*([by] if by else [])).agg(F.max("_n").alias("max_tokens"), F.avg("_n").alias("mean_tokens"))


def save_term_tables(terms: DataFrame, path: str) -> None:
    """Descriptions as CSV, one folder per kind of term."""
    terms.write.mode("overwrite").partitionBy("term_type").option("header", True).option("escape", '"').csv(path)


