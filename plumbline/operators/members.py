"""Value sets as relations, and how a frame learns which of its values are members."""

from __future__ import annotations

import decimal
from collections.abc import Sequence
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from plumbline.functions import columns as C
from plumbline.rules import LITERAL_SET_LIMIT, FrequencyRule

# All sets of a suite up to this size together may be sent to every executor. Further ones never meet the
# rows of a table, only its frequency table, and Spark chooses that join by the set's known size.
BROADCAST_BYTES = 8 * 2**20

ROW_JUDGES = ("rows_in_set", "rows_not_in_set")


def broadcastable(rules: Sequence[FrequencyRule], schema: T.StructType) -> set[str | None]:
    """Ids of the membership rules whose sets, different ones taken together, may be sent to every executor."""
    left, chosen, out = BROADCAST_BYTES, {}, set()
    for rule in rules:
        if rule.judge not in ROW_JUDGES or rule.relation is not None:
            continue
        key = set_key(rule)
        if key not in chosen:
            size = _set_as_table(rule, [schema[c].dataType for c in rule.columns]).nbytes
            chosen[key] = size <= left
            left -= size if chosen[key] else 0
        if chosen[key]:
            out.add(rule.check_id)
    return out


def set_key(rule: FrequencyRule) -> tuple:
    """Equal for rules that can share one join: same columns, same members (as spelt, type included)."""
    return rule.columns, frozenset((type(v), v) for m in rule.members for v in m), frozenset(rule.members)


def member_count(rule: FrequencyRule, types: Sequence[T.DataType]) -> int:
    """Different members, as the column's type tells them apart, with those it can never hold."""
    never = [m for m in dict.fromkeys(rule.members) if _impossible(m, types)]
    return _set_as_table(rule, types).num_rows + len(never)


def _impossible(member: Sequence[object], types: Sequence[T.DataType]) -> bool:
    """Is it a member that no value of these types equals?"""
    return any(C.fitted(v, t) is None for v, t in zip(member, types))


def with_members(
    frame: DataFrame, rule: FrequencyRule, types: Sequence[T.DataType], names: Sequence[str], mark: str,
    broadcast: bool = False,
) -> DataFrame:
    """Add ``mark``: the weight of the value in columns ``names`` (or true); null outside the set.

    ``types`` are the types of those columns. Only pass ``broadcast`` for a rule that is ``broadcastable``.
    """
    if rule.relation is not None:
        side = members_of(rule, types[0]).select(F.col("member").alias(f"{mark}_0")).distinct().withColumn(mark, F.lit(True))
        return frame.join(side, C.column(names[0]) == F.col(f"{mark}_0"), "left").drop(f"{mark}_0")
    if not rule.weights and len(names) == 1 and len(rule.members) <= LITERAL_SET_LIMIT:
        hit = C.in_values(C.column(names[0]), types[0], [m[0] for m in rule.members])
        return frame.withColumn(mark, F.when(hit, F.lit(True)))
    local = frame.sparkSession.createDataFrame(_set_as_table(rule, types))
    keys = [f"{mark}_{i}" for i in range(len(names))]
    side = local.select(
        # texts take the column's collation
        *[F.col(f"k{i}").cast(t if C.is_temporal(t) or isinstance(t, T.StringType) else local.schema[f"k{i}"].dataType).alias(key)
          for i, (key, t) in enumerate(zip(keys, types))],
        (F.col("q") if rule.weights else F.lit(True)).alias(mark),
    )
    match = reduce(and_, [C.column(n) == F.col(k) for n, k in zip(names, keys)])
    return frame.join(F.broadcast(side) if broadcast else side, match, "left").drop(*keys)


def members_of(rule: FrequencyRule, dtype: T.DataType) -> DataFrame:
    """(member): the table of members without nulls, as values of the column's type."""
    held, kind = F.col(C.quoted(rule.relation.columns[0])), rule.relation.schema[0].dataType
    if C.is_numeric(dtype) and kind != dtype:
        # only what is the same number there
        member = held.try_cast(dtype)
        held = F.when(C.same_value(member, held, dtype, kind), member)
    elif kind != dtype and C.is_temporal(dtype):
        wide = C.common_form(held, kind, dtype)
        held = F.when(wide.cast(dtype).cast(C.common_type(kind, dtype)) == wide, wide.cast(dtype))
    return rule.relation.select(held.alias("member")).dropna()


def _set_as_table(rule: FrequencyRule, types: Sequence[T.DataType]) -> pa.Table:
    """Columns k0, k1, .. (and the weights as q), each member once."""
    columns, kinds = [], []
    possible = [k for k, m in enumerate(rule.members) if not _impossible(m, types)]
    for i, dtype in enumerate(types):
        values = [C.fitted(rule.members[k][i], dtype) for k in possible]
        if C.is_temporal(dtype):
            kind, values = pa.string(), [C.iso(v, dtype) for v in values]
        elif C.is_float(dtype):
            kind, values = pa.float64(), [float(v) for v in values]
        elif C.is_numeric(dtype) and all(isinstance(v, int) and abs(v) < 2**63 for v in values):
            kind = pa.int64()
        elif C.is_numeric(dtype):
            kind, values = None, [decimal.Decimal(v) for v in values]  # as wide as its members need
        else:
            kind = to_arrow_type(dtype)
        columns.append(values)
        kinds.append(kind)
    rows = list(zip(*columns))
    weights = [rule.weights[k] for k in possible] if rule.weights else []
    if not weights:
        rows = list(dict.fromkeys(rows))
    arrays = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
    names = [f"k{i}" for i in range(len(kinds))]
    if weights:
        arrays.append(pa.array(weights, pa.float64()))
        names.append("q")
    return pa.table(arrays, names=names)
