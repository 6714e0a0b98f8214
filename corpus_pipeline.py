"""A corpus pipeline: language, exact copies, near copies, benchmark passages, tokens.

Each stage gets the documents that the one before has kept, as a table written in between, and
returns the documents it keeps with the columns of ``documents``; the last one returns their tokens.

Null, empty and blank texts have no letters, so the first stage refuses them. Of equal rows, texts and near copies
one row stays: for equal texts the longest and then the one with the smallest id, for near copies the smallest
id. Rows that share an id, or have none, are judged one by one. Further columns pass through, whatever
their names, but for those that start with ``__siftwork_``. Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siftwork.llm import bpe, decontaminate, exact_dedup, jaccard_join, language_id
from siftwork.llm.common import read
from siftwork.plans.stage import Stage


#: Rows and bytes that go to a Python worker at once. The buffers of both sides, which executors keep for
#: reuse over all stages, grow with the largest batch, and a thousand long texts can be far larger than usual ones.
ROWS_AT_ONCE, BYTES_AT_ONCE = 1000, 4 << 20


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_AT_ONCE)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BYTES_AT_ONCE)


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified."""
    small_batches(spark)
    return language_id.keep_identified(docs, Stage(spark))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.keep_first_copies(docs, Stage(spark))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies: five words, similarity of 0.8 or more."""
    small_batches(spark)
    return jaccard_join.keep_one_of_each(docs, Stage(spark), width=5, similarity=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passages of the benchmark to speak of."""
    small_batches(spark)
    return decontaminate.keep_clean(docs, read(spark, sf_dir, "benchmark"), Stage(spark))


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the tokens and of the text decoded from them."""
    small_batches(spark)
    return bpe.round_trip(docs, bpe.vocabulary_path())


STAGES = [
    ("language_id", identified),
    ("exact_dedup", without_copies),
    ("jaccard_join", without_near_copies),
    ("decontamination", decontaminated),
    ("bpe", tokenized),
]

#: SQL has no trigram tables, transitive links or merges; the tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = Stage(spark)
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage.table(step(spark, docs, sf_dir), name, "zstd")
    return STAGES[-1][1](spark, docs, sf_dir)
