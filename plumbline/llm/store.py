"""Tables that cut a lineage, in the folder all executors share."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.sources.tables import remove_staged, shared_folder


def new_path(spark: SparkSession, label: str) -> str:
    """An unused path under ``spark.checkpoint.dir``.

    Without that setting a folder of this machine is chosen (and kept for the session) in local
    mode, where there is no other machine; on a cluster its absence is an error.
    """
    folder = shared_folder(spark)
    if folder is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="plumbline-")
        spark.sparkContext.setCheckpointDir(folder)
    return f"{folder.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame written as a table and read back: later plans start there and survive lost executors."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A function like ``written`` whose tables are removed at the end of the ``with`` block."""
    paths = []

    def put(df: DataFrame, label: str) -> DataFrame:
        paths.append(new_path(spark, label))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    try:
        yield put
    finally:
        for path in paths:
            remove_staged(spark, path)


@contextlib.contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Within the block, the files of a query's shuffles go when it has ended, not when the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def text_digest(column: str = "text"):
    """128 bits that stand for a text; null for null."""
    return F.unhex(F.md5(F.encode(F.col(column).cast("string"), "UTF-8")))


def same_rows(documents: DataFrame, chosen: DataFrame, how: str) -> DataFrame:
    """The documents, all columns, that have (``left_semi``) or lack (``left_anti``) a row (doc_id, digest) in ``chosen``; nulls match nulls."""
    keyed = documents.withColumn("__digest", text_digest()).alias("d")
    c = chosen.select(F.col("doc_id").alias("__id"), F.col("digest").alias("__other")).distinct().alias("c")
    met = F.col("d.doc_id").cast("bigint").eqNullSafe(F.col("c.__id")) & F.col("d.__digest").eqNullSafe(F.col("c.__other"))
    return keyed.join(c, met, how)


def sampled_rows(rows: DataFrame, key: str, size: int, seed: int = 0) -> list:
    """At most ``size`` rows, those that come first by a hash of a key that no two rows share.

    Rows are thinned to about twice as many before any are ordered, so that no more than that
    reach the driver, however many tasks there are.
    """
    total = rows.count()
    place = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30))
    thin = rows.filter(place < F.lit(int(min(1.0, 2 * size / max(total, 1)) * (1 << 30))))
    return thin.orderBy(place, key).limit(size).collect()
