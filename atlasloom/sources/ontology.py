"""Ontology documents as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlasloom.operators.ranking import first_per_key

GRAPH_SCHEMA = (
    "struct<graphs:array<struct<"
    "nodes:array<struct<id:string,lbl:string,type:string,meta:struct<definition:struct<val:string>,"
    "synonyms:array<struct<val:string>>,xrefs:array<struct<val:string>>>>>,"
    "edges:array<struct<sub:string,pred:string,obj:string>>>>>"
)
PAGE_SCHEMA = (
    "struct<_embedded:struct<terms:array<struct<obo_id:string,label:string,description:array<string>,"
    "synonyms:array<string>,annotation:struct<hasDbXref:array<string>>>>>>"
)
# Edge names that mean "is a".
PARENT_EDGES = ("rdfs:subClassOf", "is_a")


def graph_terms(documents: DataFrame, column: str = "json", prefix: str = "MONDO:") -> DataFrame:
    """Classes of graph documents with definition, synonyms, cross references and parents."""
    graph = documents.select(F.from_json(column, GRAPH_SCHEMA)["graphs"][0].alias("g"))
    nodes = graph.select(F.explode("g.nodes").alias("n")).filter(
        (F.col("n.type") == "CLASS") & F.col("n.id").startswith(prefix))
    edges = graph.select(F.explode("g.edges").alias("e")).select("e.*").filter(
        F.col("pred").isin(*PARENT_EDGES) & (F.col("sub") != "") & (F.col("obj") != ""))
    parents = edges.groupBy(F.col("sub").alias("term_id")).agg(F.sort_array(F.collect_list("obj")).alias("_p"))
    none = F.array().cast("array<string>")

    def values(path: str):
        vals = F.transform(F.col(path), lambda s: s["val"])
        return F.coalesce(F.filter(vals, lambda v: v.isNotNull() & (v != "")), none)

    rows = nodes.select(
        F.col("n.id").alias("term_id"), F.col("n.lbl").alias("label"), F.col("n.meta.definition.val").alias("definition"),
        values("n.meta.synonyms").alias("synonyms"), values("n.meta.xrefs").alias("xrefs"))
    return rows.join(parents, "term_id", "left").withColumn("parents", F.coalesce("_p", none)).drop("_p")


def page_terms(pages: DataFrame, column: str = "json", order: str = "page") -> DataFrame:
    """Terms of stored result pages, the first of each id in page order."""
    p = pages.select(F.col(order).alias("_page"), F.from_json(column, PAGE_SCHEMA).alias("d"))
    t = p.select("_page", F.posexplode("d._embedded.terms").alias("_at", "t"))
    none = F.array().cast("array<string>")
    rows = t.select(
        "_page", "_at", F.col("t.obo_id").alias("term_id"), F.col("t.label").alias("label"),
        F.get("t.description", F.lit(0)).alias("definition"), F.coalesce("t.synonyms", none).alias("synonyms"),
        F.coalesce("t.annotation.hasDbXref", none).alias("xrefs"))
    return first_per_key(rows, "term_id", "_page", "_at").drop("_page", "_at")


def unique_labels(terms: DataFrame, column: str = "label") -> DataFrame:
    return terms.select(column).distinct()
