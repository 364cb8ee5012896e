"""From preprocessed cells to training records, per split, and for several settings at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlasloom.model import Atlas, require_columns
from atlasloom.operators.edits import keep_original_id
from atlasloom.operators.lookups import file_references
from atlasloom.operators.records import build_records, check_request, samples
from atlasloom.operators.sentences import cell_sentences, sentences_of_lengths, usable_sentence_keys


def build_split_records(
    atlas: Atlas, length: int, sentence_keys: Sequence[str] = ("cell_sentence",), caption: str | None = None,
    batch: str | None = None, annotation: str | None = None, fmt: str = "multiplets", n_negatives: int = 2,
    resolve: bool = False, files: DataFrame | None = None, links: DataFrame | None = None, file_key: str = "path",
    split: str = "split",
) -> DataFrame:
    """Records with ``split`` in every key: negatives never cross splits.

    ``files(path, split, name)`` and ``links(key, link)`` give each row its
    ``adata_link`` through the cell column ``file_key``; without them the
    column itself is the link.
    """
    check_request(fmt, n_negatives, caption)
    require_columns(atlas.cells, [split], "cells")
    keys = usable_sentence_keys(list(sentence_keys), annotation)
    cells = keep_original_id(atlas.cells)
    with_text = cell_sentences(atlas.counts, cells, atlas.genes, length, annotation)
    with_text = _linked(with_text, files, links, file_key)
    data = samples(with_text, keys, F.col("adata_link"), caption, batch, keep=[split])
    return build_records(data, fmt, n_negatives, resolve, scope=[split])


def _linked(with_text: DataFrame, files: DataFrame | None, links: DataFrame | None, file_key: str) -> DataFrame:
    """Cells with ``adata_link``."""
    if files is not None and links is not None:
        refs = file_references(files, links).select("path", "adata_link")
        with_text = with_text.join(refs, with_text[file_key] == refs["path"], "left").drop("path")
        return with_text
    return with_text.withColumn("adata_link", F.col(file_key) if file_key in with_text.columns else F.lit(""))


def build_variants(
    atlas: Atlas, lengths: Sequence[int], captions: Sequence[str], sentence_keys: Sequence[str] = ("cell_sentence",),
    batch: str | None = None, annotation: str | None = None, fmt: str = "multiplets", n_negatives: int = 2,
    resolve: bool = False, files: DataFrame | None = None, links: DataFrame | None = None, file_key: str = "path",
    split: str = "split",
) -> DataFrame:
    """Records for every (sentence length, caption) combination, marked by ``cs_length`` and ``caption_key``.

    One plan whatever their number: genes are ranked once at the largest length, a cell's variants are rows taken from
    its own lists, and negatives are chosen within ``split`` and variant in one go.
    """
    if not lengths or not captions:
        raise ValueError("at least one length and one caption are needed")
    for c in captions:
        check_request(fmt, n_negatives, c)
    require_columns(atlas.cells, [split, *captions], "cells")
    keys = usable_sentence_keys(list(sentence_keys), annotation)
    cells = keep_original_id(atlas.cells)
    with_text = sentences_of_lengths(atlas.counts, cells, atlas.genes, sorted(set(lengths)), annotation)
    with_text = _linked(with_text, files, links, file_key)
    texts = F.array(*[F.struct(F.lit(c).alias("caption_key"), F.col(c).cast("string").alias("_caption")) for c in dict.fromkeys(captions)])
    each = with_text.select("*", F.inline("by_length")).select("*", F.inline(texts)).drop("by_length")
    scope = [split, "cs_length", "caption_key"]
    data = samples(each, keys, F.col("adata_link"), "_caption", batch, keep=scope)
    return build_records(data, fmt, n_negatives, resolve, scope=scope)
