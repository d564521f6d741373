"""A cleaning pipeline over ``documents``, built of the operators in plumbline.llm.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; ``docs`` has the
columns of ``documents``, which all stages but the last return. Rows are handled as the stages'
operators define it: nulls, empty texts, repeated rows and empty tables included.

Every stage runs on the executors that the stages before it have filled, so rows go to Python in
batches of ``BATCH`` bytes instead of Spark's 64 MB, unless the session sets a size itself.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import decontaminate, jaccard, langid, toxicity
from plumbline.llm.queries import encoded_digests, language_model, table, toxicity_model
from plumbline.llm.store import written

#: Bytes of a batch of rows on its way to Python, where texts are treated 2 MB at a time at most; both sides hold whole batches.
BATCH = 1 << 20


def in_batches(stage):
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        key = "spark.sql.execution.arrow.maxBytesPerBatch"
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, str(BATCH))  # stays, as the result is computed later
        return stage(spark, docs, sf_dir)

    return run


@in_batches
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language; texts without words of any language go."""
    return langid.accepted(spark, docs, language_model(docs))


@in_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return toxicity.accepted(spark, docs, toxicity_model(spark, docs, table(spark, sf_dir, "labels")))


@in_batches
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies, that of the smallest doc_id."""
    return jaccard.one_of_each(docs)


@in_batches
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words are in benchmark windows."""
    return decontaminate.accepted(spark, docs, table(spark, sf_dir, "benchmark"))


@in_batches
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents that are left: their number and digest, and the digest of the decoded text."""
    return encoded_digests(spark, docs)


STAGES = [
    ("language ID", identify_language),
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("encoding", encode),
]

#: Models are trained along the way, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
