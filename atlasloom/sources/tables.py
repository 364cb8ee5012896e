"""Text sources: lists, expression tables, gene annotation, marker tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasloom.functions.ids import strip_version
from atlasloom.functions.text import split_symbols, strip
from atlasloom.model import require_columns
from atlasloom.operators.positions import number_rows


def read_list(spark: SparkSession, path: str, name: str = "term") -> DataFrame:
    """One id per line, trimmed, blanks out; ``line`` counts from 0 along the files in the order of their names."""
    rows = spark.read.text(path).select(
        strip(F.col("value")).alias(name), F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"))
    # rows of one piece of a file keep their order by ``number_rows``' own tie-break, the order in which they are read
    numbered, _ = number_rows(rows.filter(F.col(name) != ""), [F.col("__file"), F.col("__block")], "line")
    return numbered.select(name, "line")


def sorted_list(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).cast("string").alias(column)).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def write_list(df: DataFrame, column: str, path: str) -> None:
    """Sorted and distinct, one per line (range-partitioned files, in order)."""
    sorted_list(df, column).write.mode("overwrite").text(path)


def standard_expression(raw: DataFrame) -> DataFrame:
    """``Gene, Tissue, nTPM`` whatever the case of the header; versions stripped."""
    want = {"gene": "Gene", "tissue": "Tissue", "ntpm": "nTPM"}
    df = raw.select(*[F.col(f"`{c}`").alias(want.get(c.lower(), c)) for c in raw.columns])
    require_columns(df, want.values(), "expression table")
    return df.select(strip_version(F.col("Gene").cast("string")).alias("Gene"), "Tissue", F.col("nTPM").cast("double").alias("nTPM"))


def read_expression(spark: SparkSession, path: str) -> DataFrame:
    return standard_expression(spark.read.csv(path, sep="\t", header=True))


def gtf_attribute(attributes: Column, key: str) -> Column:
    found = F.regexp_extract(attributes, rf'{key} "([^"]+)"', 1)
    return F.when(found != "", found)


def gene_annotation(lines: DataFrame) -> DataFrame:
    """Gene features of annotation lines with type, name and id; rows missing any are dropped.

    ``lines(seqname, feature, attribute)``.
    """
    ident = gtf_attribute(F.col("attribute"), "gene_id")
    return lines.filter(F.col("feature") == "gene").select(
        "seqname", gtf_attribute(F.col("attribute"), "gene_type").alias("gene_type"),
        gtf_attribute(F.col("attribute"), "gene_name").alias("gene_name"),
        ident.alias("ensembl_gene_id"), strip_version(ident).alias("ensembl_gene_id_novers")).dropna()


def read_gene_annotation(spark: SparkSession, path: str) -> DataFrame:
    schema = ("seqname string, source string, feature string, start string, end string, score string, strand string, "
              "frame string, attribute string")
    return gene_annotation(spark.read.csv(path, sep="\t", comment="#", schema=schema, quote=""))


def marker_symbols(table: DataFrame) -> DataFrame:
    """Distinct symbols of a marker table: ``geneSymbol`` as it is, ``geneID`` split into symbols."""
    none = F.array().cast("array<string>")
    whole = F.array(F.col("geneSymbol").cast("string")) if "geneSymbol" in table.columns else none
    several = split_symbols(F.col("geneID").cast("string")) if "geneID" in table.columns else none
    both = F.concat(F.coalesce(whole, none), F.coalesce(several, none))
    return table.select(F.explode(both).alias("symbol")).filter(F.col("symbol").isNotNull()).distinct()


def symbol_column(table: DataFrame) -> str:
    """The column with symbols: named like one, else ``gene`` or ``symbol``, else the first."""
    names = [c for c in table.columns if "gene" in c.lower() and "symbol" in c.lower()]
    names = names or [c for c in table.columns if c.lower() in {"gene", "symbol"}]
    return (names or table.columns)[0]


def listed_symbols(table: DataFrame) -> DataFrame:
    c = symbol_column(table)
    return table.select(F.col(f"`{c}`").cast("string").alias("symbol")).filter(F.col("symbol").isNotNull()).distinct()


def read_markers(spark: SparkSession, path: str, listed: bool = False) -> DataFrame:
    raw = spark.read.csv(path, sep="\t", header=True)
    return listed_symbols(raw) if listed else marker_symbols(raw)
