"""From raw documents to encoded training text: filters in order of cost, then byte-level BPE.

Every stage takes ``(spark, docs, sf_dir)``; its rows are written as Parquet and read again as the next one's ``docs``. All
but the last return the columns of ``documents``. As its input lies written, a stage first lets go of what earlier ones kept in memory.
Stages hand rows to Python in batches of a few MB, a setting of the session that stays.

Null texts count as empty. Of equal texts the smallest ``doc_id`` stays, so all empty ones come out as one row; an empty table
passes through every stage as an empty one, and further columns, whatever they are called, go along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from atlasloom.llm import byte_pairs, decontamination, exact_copies, near_copies, toxicity
from atlasloom.llm.common import small_batches, written
from atlasloom.llm.queries import MULTILINGUAL_BPE, PATTERN, table
from atlasloom.sizing import release


def _fresh(spark: SparkSession) -> None:
    release(spark)
    small_batches(spark)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows not predicted toxic; weights are learned from the labelled rows among ``docs``."""
    _fresh(spark)
    return toxicity.drop_toxic(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal but for runs of white space."""
    _fresh(spark)
    return exact_copies.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies: five words a shingle, similarity of at least 0.8, linked directly or through others."""
    _fresh(spark)
    return near_copies.drop_near_copies(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in which no window of a benchmark item occurs."""
    _fresh(spark)
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, number and digest of the ids, and the digest of the bytes that the ids decode to.

    The ids are written before they are decoded: in one job both would run at once, in two Python workers a core, which then stay.
    """
    _fresh(spark)
    ids = written(byte_pairs.encode(docs, MULTILINGUAL_BPE, PATTERN), "ids")
    return byte_pairs.digest(ids, MULTILINGUAL_BPE, PATTERN)


STAGES = [
    ("toxicity", without_toxic),
    ("exact_copies", without_copies),
    ("near_copies", without_near_copies),
    ("decontamination", without_benchmark),
    ("byte_pairs", encoded),
]

#: Stages learn weights, draw random arrivals and encode by a vocabulary file, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
