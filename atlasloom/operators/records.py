"""Training records: single, pairs, multiplets.

A negative is the first fitting row of a list. No anchor is ever compared with
its group: per batch only the few rows any anchor could need are kept (the first
``m`` of each caption, then the first ``2m`` of the batch, ``m = negatives + 1``).
Removing one caption from that list leaves either ``m`` rows or everything there
is, so the short list gives the same answer as the whole batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from atlasloom.model import require_columns
from atlasloom.operators.setops import pool_samples
from atlasloom.sizing import broadcast_if_small, settle

FORMATS = ("single", "pairs", "multiplets")


def check_request(fmt: str, n_negatives: int, caption: str | None) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}")
    if n_negatives < 1:
        raise ValueError("at least one negative per sample is needed")
    if fmt != "single" and caption is None:
        raise ValueError(f"format '{fmt}' needs a caption column")


def samples(
    cells: DataFrame, sentence_keys: Sequence[str], adata_link: str | Column, caption: str | None = None,
    batch: str | None = None, index: str = "cell_id", keep: Sequence[str] = (),
) -> DataFrame:
    """The columns a record needs, under fixed names, and those of ``keep`` (a split, say)."""
    require_columns(cells, sentence_keys, "sentence_keys")
    require_columns(cells, [c for c in (caption, batch) if c], "cells")
    link = F.lit(adata_link) if isinstance(adata_link, str) else adata_link
    return cells.select(
        F.col(index).alias("sample_idx"), F.col("ord").cast("bigint").alias("ord"),
        *[F.col(k).alias(f"cell_sentence_{i}") for i, k in enumerate(sentence_keys, 1)],
        (F.col(caption) if caption else F.lit(None).cast("string")).alias("caption"),
        (F.col(batch).cast("string") if batch else F.lit(None).cast("string")).alias("batch"),
        link.alias("adata_link"), *keep,
    )


def _pools(rows: DataFrame, m: int, scope: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Short candidate lists: per (scope, batch), per scope by caption, per scope by row order.

    Row-number limits are pruned in every task before the shuffle, so a batch or
    caption holding a third of all rows still sends at most ``m`` rows per task.
    """
    slim = rows.select(*scope, "batch", "caption", "ord", "sample_idx")
    captioned = slim.filter(F.col("caption").isNotNull())
    per_caption = W.partitionBy(*scope, "batch", "caption")
    firsts = captioned.withColumn("_r", F.row_number().over(per_caption.orderBy("ord"))).filter(F.col("_r") <= m)
    firsts = settle(firsts.withColumn("first", F.min("ord").over(per_caption)).drop("_r"))

    def listed(df: DataFrame, keys: list[str], limit: int, name: str) -> DataFrame:
        r = F.row_number().over(W.partitionBy(*keys).orderBy("first", "ord"))
        top = df.withColumn("_r", r).filter(F.col("_r") <= limit)
        return top.groupBy(*keys).agg(F.sort_array(F.collect_list(
            F.struct("first", "ord", "sample_idx", "caption"))).alias(name))

    one = F.lit(0).alias("_all")
    by_batch = listed(firsts.filter(F.col("batch").isNotNull()), [*scope, "batch"], 2 * m, "near")
    over_all = W.partitionBy(*scope, "caption")
    anywhere = firsts.withColumn("first", F.min("ord").over(over_all))
    anywhere = anywhere.withColumn("_r", F.row_number().over(over_all.orderBy("ord"))).filter(F.col("_r") <= m).drop("_r")
    by_caption = listed(anywhere.select("*", one), [*scope, "_all"], 2 * m, "far")
    by_order = listed(slim.withColumn("first", F.lit(0)).select("*", one), [*scope, "_all"], m, "any")
    return by_batch, by_caption.drop("_all"), by_order.drop("_all")


def _attach(df: DataFrame, pool: DataFrame, keys: list[str]) -> DataFrame:
    """Candidate list per row: by a join on the pool's keys, or the one list there is as a literal."""
    name, ids = pool.columns[-1], dict(df.dtypes)["sample_idx"]
    kind = f"array<struct<first:bigint,ord:bigint,sample_idx:{ids},caption:string>>"
    if not keys:
        row = pool.first()  # at most 2m entries
        entries = [F.struct(
            F.lit(e["first"]).cast("bigint").alias("first"), F.lit(e["ord"]).cast("bigint").alias("ord"),
            F.lit(e["sample_idx"]).cast(ids).alias("sample_idx"), F.lit(e["caption"]).cast("string").alias("caption"),
        ) for e in (row[0] if row else [])]
        return df.withColumn(name, F.array(*entries).cast(kind))
    small = broadcast_if_small(pool)
    small = small.select(*[F.col(k).alias(f"_k_{k}") for k in keys], name)
    cond = F.lit(True)
    for k in keys:
        cond = cond & df[k].eqNullSafe(small[f"_k_{k}"])
    joined = df.join(small, cond, "left").drop(*[f"_k_{k}" for k in keys])
    return joined.withColumn(name, F.coalesce(F.col(name).cast(kind), F.array().cast(kind)))


def add_negatives(
    rows: DataFrame, n_negatives: int, scope: Sequence[str] = (), repeat_captions: str = "next", required: bool = False
) -> DataFrame:
    """``negative_<i>`` structs (sample_idx, caption), null where none exists.

    Odd ``i``: another caption; even ``i``: any other sample. Rows of the same
    batch come first, then rows anywhere. ``repeat_captions="next"`` gives the
    third, fifth, ... negative the next unused row; ``"first"`` always looks at
    the same row, so those stay empty. ``required`` drops anchors without any.
    """
    if repeat_captions not in {"next", "first"}:
        raise ValueError("repeat_captions must be 'next' or 'first'")
    scope, m = list(scope), n_negatives + 1
    near, far, anyrow = _pools(rows, m, scope)
    out = _attach(_attach(_attach(rows, near, [*scope, "batch"]), far, scope), anyrow, scope)

    def other(x: Column) -> Column:
        return ~x["caption"].eqNullSafe(F.col("caption"))

    def another(x: Column) -> Column:
        return x["sample_idx"] != F.col("sample_idx")

    if required:
        # asked of the lists, which stops at the first hit, not of the negatives, which would be computed twice
        some = F.exists("near", other) | F.exists("far", other)
        if n_negatives > 1:
            some = some | F.exists("near", another) | F.exists("any", another)
        out = out.filter(some)
    out = out.withColumn("_used", F.array("sample_idx"))
    for i in range(1, n_negatives + 1):
        def unused(x: Column) -> Column:
            return ~F.array_contains(F.col("_used"), x["sample_idx"])

        if i % 2 == 1:
            if repeat_captions == "next":
                def fits(x: Column) -> Column:
                    return other(x) & unused(x)
            else:
                def fits(x: Column) -> Column:
                    return other(x) & another(x)
            pick = F.coalesce(F.get(F.filter("near", fits), F.lit(0)), F.get(F.filter("far", fits), F.lit(0)))
            if repeat_captions == "first":
                pick = F.when(~F.array_contains(F.col("_used"), pick["sample_idx"]), pick)
        else:
            pick = F.coalesce(F.get(F.filter("near", unused), F.lit(0)), F.get(F.filter("any", unused), F.lit(0)))
        out = out.withColumn(f"negative_{i}", pick)
        out = out.withColumn("_used", F.when(F.col(f"negative_{i}").isNull(), F.col("_used")).otherwise(
            F.array_append("_used", F.col(f"negative_{i}")["sample_idx"])))
    return out.drop("near", "far", "any", "_used")


def build_records(
    rows: DataFrame | Sequence[DataFrame], fmt: str = "single", n_negatives: int = 1, resolve: bool = False,
    scope: Sequence[str] = (), repeat_captions: str = "next",
) -> DataFrame:
    """Records of one format from the output of ``samples`` (one table or several to pool)."""
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}")
    parts = [rows] if isinstance(rows, DataFrame) else list(rows)
    if not parts:
        raise ValueError("no data present")
    sentences = [c for c in parts[0].columns if c.startswith("cell_sentence_")]
    if len(parts) > 1:
        data = pool_samples(parts, [len([c for c in p.columns if c.startswith("cell_sentence_")]) for p in parts])
    else:
        data = parts[0]
    if data.isEmpty():
        raise ValueError("no data present")
    head = [*scope, "sample_idx", *sentences]
    if fmt == "single":
        return data.select(*head, "adata_link")
    out = add_negatives(data, 1 if fmt == "pairs" else n_negatives, scope, repeat_captions, required=True)
    if fmt == "pairs":
        both = F.array(
            F.struct(F.col("caption"), F.lit(1.0).alias("label")),
            F.struct(F.col("negative_1.caption").alias("caption"), F.lit(0.0).alias("label")))
        return out.select(*head, F.inline(both), "adata_link")
    names = [f"negative_{i}" for i in range(1, n_negatives + 1)]
    resolved = []
    if resolve and len(sentences) == 1:
        out, resolved = _resolve(out, data, names, list(scope))
    return out.select(
        *head, F.col("caption").alias("positive"), *[F.col(f"{n}.sample_idx").alias(f"{n}_idx") for n in names],
        *[c for _, c in resolved], "adata_link")


def _resolve(out: DataFrame, data: DataFrame, names: list[str], scope: list[str]) -> tuple[DataFrame, list]:
    """Captions come with the negative; sentences by a join with the few rows ever used as a negative."""
    resolved = []
    even = [n for i, n in enumerate(names, 1) if i % 2 == 0]
    if even:
        used = out.select(*scope, F.explode(F.array(*[F.col(f"{n}.sample_idx") for n in even])).alias("sample_idx")).distinct()
        texts = data.join(used, [*scope, "sample_idx"], "left_semi").select(*scope, "sample_idx", "cell_sentence_1")
        texts = broadcast_if_small(texts)
        for n in even:
            t = texts.select(*[F.col(s).alias(f"_s_{s}") for s in scope], F.col("sample_idx").alias("_i"),
                             F.col("cell_sentence_1").alias(f"_text_{n}"))
            cond = F.col(f"{n}.sample_idx") == t["_i"]
            for s in scope:
                cond = cond & out[s].eqNullSafe(t[f"_s_{s}"])
            out = out.join(t, cond, "left").drop("_i", *[f"_s_{s}" for s in scope])
    for i, n in enumerate(names, 1):
        resolved.append((n, (F.col(f"{n}.caption") if i % 2 else F.col(f"_text_{n}")).alias(n)))
    return out, resolved


def save_records(records: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Records per split."""
    require_columns(records, ["split"], "records")
    records.write.mode("overwrite").partitionBy("split").format(fmt).save(path)
