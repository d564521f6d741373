"""Tables under test: any query, or only the newest slice of a table."""

from __future__ import annotations

import contextlib
import datetime
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import columns as C


def query_source(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """The rows of a query; ``tables`` are visible to it, and only to it, under their names."""
    before = {name: _view(spark, name) for name in tables}
    try:
        for name, df in tables.items():
            df.createOrReplaceTempView(name)
        return spark.sql(query)  # analysed here: the names are not needed later
    finally:
        for name, view in before.items():
            if view is None:
                spark.catalog.dropTempView(name)
            else:
                view.createOrReplaceTempView(name)


def _view(spark: SparkSession, name: str) -> DataFrame | None:
    """The caller's own temporary view of that name."""
    there = any(t.isTemporary and t.name == name.lower() for t in spark.catalog.listTables(pattern=name.lower()))
    return spark.table(C.quoted(name)) if there else None


def latest_slice(df: DataFrame, column: str) -> DataFrame:
    """Rows of the newest value of a date, time or ``yyyymmdd`` column.

    The maximum is a scalar subquery: one lazy plan, whose filter prunes partitions (or is
    pushed into the scan) once the maximum is known.
    """
    newest = df.agg(F.max(C.column(column))).scalar()
    return df.filter(C.column(column) == newest)


def newest_value(spark: SparkSession, path: str, column: str) -> object:
    """The greatest value of a column of a Parquet table; None without any.

    Of whole numbers, floating-point numbers and dates it is read from the files' footers, in tasks and without a
    data page, and of a partition column from the folders' names; other columns are scanned.
    """
    statistics = spark.newSession()  # the same engine, with settings of its own
    statistics.conf.set("spark.sql.sources.useV1SourceList", "")
    statistics.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    frame = statistics.read.parquet(path)
    return frame.agg(F.max(C.column(column)).cast("string").alias("newest")).first()["newest"]


def newest_slice(spark: SparkSession, path: str, column: str) -> DataFrame:
    """Rows of the newest value of a column of a Parquet table, like ``latest_slice``.

    The value is found here and once, from what the files say of themselves, however many plans a suite makes of the
    slice; each of them has it as a literal, which prunes partitions and row groups when it is planned.
    """
    df = spark.read.parquet(path)
    newest = newest_value(spark, path, column)
    return df.limit(0) if newest is None else df.filter(C.column(column) == F.lit(newest).cast(df.schema[column].dataType))


def today_slice(df: DataFrame, column: str, today: datetime.date | None = None) -> DataFrame:
    """Rows of the current date; the column is a date, a timestamp, a ``yyyymmdd`` integer, or text in that
    spelling or as ``yyyy-mm-dd``. Always a predicate on the bare column, so that partitions prune."""
    day = F.lit(today.isoformat()).cast("date") if today else F.current_date()
    dtype, c = df.schema[column].dataType, C.column(column)
    if isinstance(dtype, T.DateType):
        return df.filter(c == day)
    if C.is_temporal(dtype):
        # a range on the bare column, so that it reaches the scan
        return df.filter((c >= day.cast(dtype)) & (c < F.date_add(day, 1).cast(dtype)))
    digits = F.date_format(day, "yyyyMMdd")
    if isinstance(dtype, T.StringType):
        return df.filter(c.isin(digits, F.date_format(day, "yyyy-MM-dd")))
    if not isinstance(dtype, T.IntegralType):
        raise ValueError(f"{column} is {C.type_name(dtype)}, which holds no dates")
    return df.filter(c == digits.cast(dtype))


def shared_folder(spark: SparkSession) -> str | None:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def staged(df: DataFrame, columns: Sequence[str], path: str | None = None) -> DataFrame:
    """The needed columns of an expensive source, written once to a new path of the shared folder and read back.

    A written table outlives lost executors and stays columnar, so each plan of a suite reads
    only its own columns. It is the caller's to remove (``remove_staged``), who may name the path.
    """
    spark = df.sparkSession
    if path is None:
        folder = shared_folder(spark)
        if folder is None:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder to stage a source")
        path = f"{folder.rstrip('/')}/staged-{uuid.uuid4().hex}"
    # a column of no type cannot be stored, and a table needs a column
    kept = [C.column(c).cast("string") if isinstance(df.schema[c].dataType, T.NullType) else C.column(c) for c in columns]
    named = [k.alias(c) for k, c in zip(kept, columns)] or [F.lit(True).alias("row")]
    df.select(*named).write.parquet(path)
    return spark.read.parquet(path)


def remove_staged(spark: SparkSession, path: str) -> None:
    """Remove a staged table, on whatever file system it is."""
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(there, True)


@contextlib.contextmanager
def staged_table(df: DataFrame, columns: Sequence[str] | None = None) -> Iterator[DataFrame]:
    """The staged source for the length of a ``with`` block; results must be collected or written inside it."""
    folder = shared_folder(df.sparkSession)
    if folder is None:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder to stage a source")
    path = f"{folder.rstrip('/')}/staged-{uuid.uuid4().hex}"
    try:
        yield staged(df, df.columns if columns is None else columns, path)
    finally:
        remove_staged(df.sparkSession, path)
