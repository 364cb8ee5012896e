"""Wording of semantic sentences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from atlasloom.functions.ids import hash_bucket, hash_fraction

# Sentence wordings with a label, {genes} and {label} to be filled in.
WITH_LABEL = (
    "A cell that expresses the following genes: {genes} is likely a {label} cell.",
    "This cell shows high expression of {genes}, suggesting it is a {label}.",
    "Based on the expression of {genes}, this appears to be a {label} cell.",
    "The genes {genes} are expressed in this cell, which is classified as a {label}.",
    "{label} cells typically express genes such as: {genes}.",
    "The combination of {genes} is characteristic for {label} cells.",
    "This transcriptomic profile — with genes like {genes} — resembles that of a {label}.",
    "A typical {label} cell expresses the genes: {genes}.",
    "A {label} signature includes: {genes}.",
    "The expression pattern of {genes} strongly indicates a {label} cell.",
    "{genes} are commonly found in {label} cells.",
    "Gene expression matches that of {label} cells, including: {genes}.",
    "Cells expressing {genes} often belong to the {label} lineage.",
    "The gene markers {genes} suggest this cell is a {label}.",
    "These expression features — {genes} — are typical of a {label} identity.",
    "Observed genes ({genes}) are indicative of {label} cell function.",
    "With genes like {genes} active, this cell is identified as a {label}.",
    "Expressing {genes}, this cell is consistent with {label} identity.",
    "The cell’s transcriptome points to a {label} lineage, with key genes like {genes}.",
    "This cell likely originates from the {label} family, based on expression of {genes}.",
    "{label} cells are known to express: {genes}.",
    "The expression of {genes} aligns with a {label} identity.",
    "The transcriptome suggests a {label} type, with expression of {genes}.",
    "Given {genes}, this cell can be classified as a {label}.",
    "This profile resembles {label} cells, based on genes like {genes}.",
    "The pattern {genes} is indicative of {label} differentiation.",
    "Expression of {genes} suggests {label} lineage commitment.",
    "Typical {label} markers such as {genes} are present in this cell.",
    "This cell fits the molecular signature of {label}, expressing {genes}.",
    "The transcriptomic signal ({genes}) matches a {label} phenotype.",
    "The active genes {genes} align with a {label} signature.",
    "Presence of {genes} supports classification as {label}.",
    "{genes} expression pattern defines this as a {label} cell.",
    "Consistent with {label} function, genes like {genes} are expressed.",
    "This expression fingerprint ({genes}) marks a {label} cell.",
    "{genes} expression places this cell in the {label} category.",
    "According to gene expression ({genes}), this is a {label}.",
    "A transcriptome with {genes} points toward {label} identity.",
    "{genes} reflect the unique expression profile of {label} cells.",
    "Genes like {genes} are hallmarks of {label} cells.",
)

# Sentence wordings without a label.
WITHOUT_LABEL = (
    "A cell that expresses: {genes}.",
    "This cell expresses the genes: {genes}.",
    "Highly expressed genes: {genes}.",
    "Expression profile includes: {genes}.",
    "{genes} are the top expressed genes in this cell.",
    "Transcriptomic features: {genes}.",
    "Detected gene expression: {genes}.",
    "This cell shows significant expression of: {genes}.",
    "Key genes active in this cell: {genes}.",
    "The expression pattern includes: {genes}.",
    "Observed top genes: {genes}.",
    "The cell displays expression of: {genes}.",
    "Gene ranking includes: {genes}.",
    "High-ranking genes: {genes}.",
    "Based on transcriptomics, {genes} are key features.",
    "Top genes from expression profile: {genes}.",
    "Leading genes expressed: {genes}.",
    "This cell is characterized by expression of: {genes}.",
    "{genes} define the expression landscape of this cell.",
    "The active transcriptional program includes: {genes}.",
)

def semantic_sentence(
    genes: Column, label: Column, key: Column, label_prob: float = 0.7, seed: int | str = 42,
    n_with: int = len(WITH_LABEL), n_without: int = len(WITHOUT_LABEL),
) -> Column:
    """A wording chosen by the seeded hash of ``key``; ``genes`` is the gene-name array.

    The first ``n_with`` wordings with a label and ``n_without`` without are in use, whatever the size of the table.
    """
    labelled = F.array(*[F.lit(t) for t in WITH_LABEL[:n_with]])
    plain = F.array(*[F.lit(t) for t in WITHOUT_LABEL[:n_without]])
    use_label = F.coalesce(label != "", F.lit(False)) & (hash_fraction(f"{seed}:label", key) < label_prob)
    wording = F.when(use_label, F.get(labelled, hash_bucket(f"{seed}:with", key, n_with))).otherwise(
        F.get(plain, hash_bucket(f"{seed}:without", key, n_without)))
    return F.replace(F.replace(wording, F.lit("{label}"), F.coalesce(label, F.lit(""))), F.lit("{genes}"), F.array_join(genes, ", "))
