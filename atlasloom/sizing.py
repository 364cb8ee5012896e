"""What may be broadcast, into how many partitions rows go, and how lineage is cut.

Nothing in the library broadcasts by belief. A small derived table is first
computed once, kept, and measured; only when the measured bytes fit does it get
the hint. Otherwise it is returned without one and Spark joins it by
sort-merge, with adaptive skew splitting.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_BROADCAST_BYTES = 128 * 1024 * 1024
#: Entries that one task sorts and groups at most, if they are spread evenly.
ROWS_PER_PARTITION = 500_000
_LIMIT_KEY = "spark.atlasloom.broadcast.maxBytes"
#: Tables that ``broadcast_if_small`` keeps until ``release``.
_KEPT: list[DataFrame] = []


def broadcast_limit(spark: SparkSession) -> int:
    return int(spark.conf.get(_LIMIT_KEY, str(MAX_BROADCAST_BYTES)))


def measured_bytes(df: DataFrame) -> int:
    """Approximate bytes of a table: JSON text length plus a fixed row overhead."""
    row = df.agg(
        F.coalesce(F.sum(F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))) + F.lit(32)), F.lit(0))
    ).first()
    return int(row[0])


def broadcast_if_small(df: DataFrame, keep: bool = True) -> DataFrame:
    """Broadcast ``df`` when its measured size is within the limit, else leave it to AQE.

    ``keep`` stores the (small, derived) result so that measuring it and using it
    is one computation; a lost executor only costs a recomputation from lineage.
    """
    if keep:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        _KEPT.append(df)
    return F.broadcast(df) if measured_bytes(df) <= broadcast_limit(df.sparkSession) else df


def partitions_for(spark: SparkSession, rows: int) -> int | None:
    """Partitions for a shuffle of so many rows, when they are more than the session's, else none.

    A task's share then stays the same however many rows there are.
    """
    wanted = -(-rows // ROWS_PER_PARTITION)
    return wanted if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def release(spark: SparkSession) -> int:
    """Let go of the tables that ``broadcast_if_small`` has kept in this session, and say how many there were.

    For the places where a result is written: a plan not yet run computes such a table again from its lineage.
    """
    mine = [df for df in _KEPT if df.sparkSession is spark]
    _KEPT[:] = [df for df in _KEPT if df.sparkSession is not spark]
    for df in mine:
        df.unpersist()
    return len(mine)


def shared_folder(spark: SparkSession) -> str | None:
    """The folder named in ``spark.checkpoint.dir``; a temporary one for a local session without it, else none."""
    folder, sc = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext
    if folder:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(folder)
        return folder.rstrip("/")
    if sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local"):
        return None
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="atlasloom-checkpoint-"))
    return sc.getCheckpointDir().rstrip("/")


def settle(df: DataFrame) -> DataFrame:
    """Compute a table once so that several later passes do not repeat its lineage.

    A reliable checkpoint where there is a shared folder; otherwise blocks are
    kept together with their lineage.
    """
    if shared_folder(df.sparkSession) is None:
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    return df.checkpoint(eager=True)


def settle_by_key(df: DataFrame, key: str, buckets: int | None = None, rows: int | None = None) -> DataFrame:
    """Like ``settle``, but later grouping and joining by ``key`` needs no shuffle.

    Written once as a table bucketed by ``key`` in the shared folder: a
    checkpoint would forget how its rows are partitioned. Rows that come
    partitioned by ``key`` are written without another shuffle, one file per bucket.
    A bucket is one task's share later on, so their number follows ``rows``, where the caller knows them.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    if folder is None:
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    n = buckets or partitions_for(spark, rows or 0) or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"atlasloom_{uuid.uuid4().hex}"
    df.write.bucketBy(n, key).sortBy(key).option("path", f"{folder}/{name}").format("parquet").saveAsTable(name)
    return spark.table(name)
