"""The cell-by-gene model laid over an order/line/part star schema.

An order is a cell, a part is a gene, and the summed quantity of a part in an
order is a count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasloom.sizing import partitions_for
from atlasloom.sources.matrix import entries


def table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}.parquet")


def cells(spark: SparkSession, path: str) -> DataFrame:
    o = table(spark, path, "orders")
    return o.select(
        F.col("o_orderkey").alias("cell_id"), F.col("o_orderkey").alias("ord"), F.col("o_orderstatus").alias("batch"),
        F.col("o_orderpriority").alias("annotation"), F.col("o_custkey").alias("donor"),
        F.concat(F.lit("order of priority "), "o_orderpriority", F.lit(" status "), "o_orderstatus").alias("caption"),
        F.col("o_totalprice").alias("price"),
    )


def cells_with_instrument(spark: SparkSession, path: str) -> DataFrame:
    c = table(spark, path, "customer").select(
        F.col("c_custkey").alias("donor"), F.col("c_mktsegment").alias("instrument"), F.col("c_nationkey").alias("site"))
    return cells(spark, path).join(c, "donor", "left")


def genes(spark: SparkSession, path: str) -> DataFrame:
    p = table(spark, path, "part")
    return p.select(
        F.col("p_partkey").alias("gene_id"), F.col("p_partkey").alias("pos"), F.col("p_name").alias("gene_name"),
        F.col("p_type").alias("biotype"), F.col("p_brand").alias("family"), F.col("p_retailprice").alias("weight"),
    )


def n_lines(spark: SparkSession, path: str) -> int:
    """As many entries at most; a Parquet table has the number in its footers."""
    return table(spark, path, "lineitem").count()


def counts(spark: SparkSession, path: str) -> DataFrame:
    l = table(spark, path, "lineitem")
    return entries(l.select(
        F.col("l_orderkey").alias("cell_id"), F.col("l_partkey").alias("gene_id"), F.col("l_quantity").alias("value")),
        rows=n_lines(spark, path))


def dense_cells(spark: SparkSession, path: str) -> DataFrame:
    """Customers as cells: few genes (brands), most of them present in a cell."""
    c = table(spark, path, "customer")
    return c.select(
        F.col("c_custkey").alias("cell_id"), F.col("c_custkey").alias("ord"), F.col("c_mktsegment").alias("batch"),
        F.col("c_acctbal").alias("balance"))


def dense_genes(spark: SparkSession, path: str) -> DataFrame:
    p = table(spark, path, "part").select(F.col("p_brand").alias("gene_id")).distinct()
    number = F.substring_index("gene_id", "#", -1).cast("int")
    return p.select("gene_id", number.alias("pos"), F.col("gene_id").alias("gene_name"))


def dense_counts(spark: SparkSession, path: str) -> DataFrame:
    l = table(spark, path, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    rows = n_lines(spark, path)
    n = partitions_for(spark, rows)
    if n is not None:
        l = l.repartition(n, "l_orderkey")
    o = table(spark, path, "orders").select("o_orderkey", "o_custkey")
    p = table(spark, path, "part").select("p_partkey", "p_brand")
    j = l.join(o, l.l_orderkey == o.o_orderkey).join(p, l.l_partkey == p.p_partkey)
    return entries(j.select(
        F.col("o_custkey").alias("cell_id"), F.col("p_brand").alias("gene_id"), F.col("l_quantity").alias("value")), rows=rows)


def embeddings(spark: SparkSession, path: str, key: str = "X_test") -> DataFrame:
    e = table(spark, path, "embeddings")
    return e.select(
        F.col("vec_id").alias("cell_id"), F.lit(key).alias("key"), F.col("embedding").alias("vector"), "label")
