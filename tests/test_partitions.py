"""How many tasks share the entries, and groups that leave nothing to divide by."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlasloom import sizing
from atlasloom.model import Atlas
from atlasloom.operators import filters, normalise
from atlasloom.sources.matrix import entries


def test_partitions_grow_with_the_entries(spark, monkeypatch):
    monkeypatch.setattr(sizing, "ROWS_PER_PARTITION", 10)
    raw = spark.range(100).select((F.col("id") % 30).alias("cell_id"), (F.col("id") % 2).alias("gene_id"), F.lit(1).alias("value"))
    e = entries(raw, rows=100)
    assert e.rdd.getNumPartitions() == 10
    assert e.agg(F.sum("value"), F.count("*")).first()[:] == (100, 30)
    assert entries(raw, rows=10).rdd.getNumPartitions() <= 4
    kept = sizing.settle_by_key(e, "cell_id", rows=100)
    per_cell = kept.groupBy("cell_id").agg(F.sum("value").alias("n"))
    # a bucket is a task, and no rows move
    assert per_cell.rdd.getNumPartitions() == 10
    assert "Exchange" not in per_cell._jdf.queryExecution().toString()


def test_variance_of_one_cell_is_unknown(spark):
    cells = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "cell_id int, batch string")
    counts = spark.createDataFrame([(1, 7, 2.0, "a"), (2, 7, 1.0, "b"), (3, 7, 3.0, "b")], "cell_id int, gene_id int, value double, batch string")
    got = {r["batch"]: r["variance"] for r in filters.gene_variances(counts, cells, "batch", ddof=1).collect()}
    assert got == {"a": None, "b": 2.0}


def test_chosen_entries_stay_by_cell(spark):
    cells = spark.createDataFrame([(1, 0, "a"), (2, 1, "b"), (3, 2, None)], "cell_id int, ord int, chunk string")
    genes = spark.createDataFrame([(7, 0)], "gene_id int, pos int")
    counts = spark.createDataFrame([(1, 7, 1.0), (2, 7, -2.0), (3, 7, 4.0)], "cell_id int, gene_id int, value double")
    layer = spark.createDataFrame([("counts", 2, 7, 5.0)], "layer string, cell_id int, gene_id int, value double")
    out, without = normalise.ensure_raw_counts_by(Atlas(cells, genes, counts, layer), ["chunk"])
    assert sorted(map(tuple, out.counts.collect())) == [(1, 7, 1), (2, 7, 5), (3, 7, 4)]
    assert without.isEmpty()
    assert "Exchange" not in out.counts.groupBy("cell_id").count()._jdf.queryExecution().toString()
