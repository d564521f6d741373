"""Small frames of facts the driver already knows: one row per rule, column or quantile."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_ARROW = {"string": pa.string(), "bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}


def local_frame(spark: SparkSession, fields: Mapping[str, str], rows: Iterable[Sequence]) -> DataFrame:
    """A local relation of known size: no job to read it, and joins can plan by its size."""
    rows = list(rows)
    arrays = [pa.array([row[i] for row in rows], _ARROW[dtype]) for i, dtype in enumerate(fields.values())]
    return spark.createDataFrame(pa.table(arrays, names=list(fields)))
