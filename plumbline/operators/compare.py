"""Comparisons of two tables: row counts, keys, aggregates and whole rows.

Both sides are tagged and grouped together instead of joined. One shuffle serves both
directions, counts combine on the map side, so a key that holds a third of a table is
one row per task, and nulls compare as equal without special care.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import columns as C
from plumbline.operators.verdict import judged, local_rows, rows, text_sql
from plumbline.rules import Rule


def _tagged(left: DataFrame, right: DataFrame, on: Sequence[str], right_on: Sequence[str] | None) -> DataFrame:
    names = [f"k{i}" for i in range(len(on))]
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    lefts, rights = comparable_forms(left, right, on, right_on)
    a = left.select(*[c.alias(n) for c, n in zip(lefts, names)], one.alias("l"), none.alias("r"))
    b = right.select(*[c.alias(n) for c, n in zip(rights, names)], none.alias("l"), one.alias("r"))
    return a.unionByName(b).groupBy(*names).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))


def comparable_forms(
    left: DataFrame, right: DataFrame, on: Sequence[str], right_on: Sequence[str] | None
) -> tuple[list[Column], list[Column]]:
    """The columns of both sides such that equal values, and only they, are equal whatever types they come in."""
    lefts, rights = [], []
    for a, b in zip(on, right_on or on):
        own, other = left.schema[a].dataType, right.schema[b].dataType
        lefts.append(C.common_form(C.column(a), own, other))
        rights.append(C.common_form(C.column(b), other, own))
    return lefts, rights


def incomparable_columns(left: DataFrame, right: DataFrame, on: Sequence[str], right_on: Sequence[str] | None) -> str | None:
    for a, b in zip(on, right_on or on):
        why = C.incomparable([f"left {a}", f"right {b}"], [left.schema[a].dataType, right.schema[b].dataType])
        if why:
            return why
    return None


def failed_comparison(left: DataFrame, kind: str, columns: Sequence[str], check_id: str, why: str) -> DataFrame:
    return local_rows(
        left.sparkSession,
        [
            {"check_id": f"{check_id}.missing_from_{side}", "kind": kind, "columns": ",".join(columns), "success": False,
             "observed_text": why}
            for side in ("right", "left")
        ],
    )


def _side_by_side(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two one-row frames of different columns as one row, without a join."""
    both = left.unionByName(right, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def compare_row_counts(left: DataFrame, right: DataFrame, check_id: str = "compare_row_counts") -> DataFrame:
    """Both tables hold the same number of rows; ``unexpected_count`` is the difference."""
    counts = _side_by_side(left.agg(F.count(F.lit(1)).alias("n")), right.agg(F.count(F.lit(1)).alias("m")))
    n, m = F.col("n"), F.col("m")
    rule = Rule(kind="compare_row_counts", check_id=check_id)
    return rows(counts, [judged(rule, n == m, element_count=n, unexpected_count=F.abs(n - m), observed_num=m)])


def compare_keys(
    left: DataFrame, right: DataFrame, on: Sequence[str], right_on: Sequence[str] | None = None,
    check_id: str = "compare_keys",
) -> DataFrame:
    """Two verdicts: every key of each table also occurs in the other. Counts are of distinct keys.

    Keys of types that cannot be compared make two failed verdicts with the reason.
    """
    why = incomparable_columns(left, right, on, right_on)
    if why:
        return failed_comparison(left, "compare_keys", on, check_id, why)
    keys = _tagged(left, right, on, right_on).agg(
        C.count_where(F.col("l") > 0).alias("in_left"),
        C.count_where(F.col("r") > 0).alias("in_right"),
        C.count_where(F.col("r") == 0).alias("only_left"),
        C.count_where(F.col("l") == 0).alias("only_right"),
    )
    out = []
    for side, size, lone in (("right", "in_left", "only_left"), ("left", "in_right", "only_right")):
        rule = Rule(kind="compare_keys", columns=tuple(on), check_id=f"{check_id}.missing_from_{side}")
        out.append(judged(rule, F.col(lone) == 0, element_count=F.col(size), unexpected_count=F.col(lone)))
    return rows(keys, out)


def compare_aggregates(
    left: DataFrame, right: DataFrame, measures: Mapping[str, Column], right_measures: Mapping[str, Column] | None = None,
    tolerance: float = 0.0, check_id: str = "compare_aggregates",
) -> DataFrame:
    """One verdict per measure: its values on the two tables differ by at most ``tolerance``.

    Values are compared in the measures' own types: whole numbers and decimals exactly, NaN is equal to NaN, and what is not a
    number has to be equal. Measures of types that cannot be compared fail with the reason.
    """
    names = list(measures)
    others = right_measures or measures
    both = _side_by_side(
        left.agg(*[measures[n].alias(f"l{i}") for i, n in enumerate(names)]),
        right.agg(*[others[n].alias(f"r{i}") for i, n in enumerate(names)]),
    )
    out = []
    for i, name in enumerate(names):
        rule = Rule(kind="compare_aggregates", check_id=f"{check_id}.{name}")
        a, b = F.col(f"l{i}"), F.col(f"r{i}")
        a_type, b_type = both.schema[f"l{i}"].dataType, both.schema[f"r{i}"].dataType
        why = C.incomparable([f"left {name}", f"right {name}"], [a_type, b_type])
        if why:
            out.append(judged(rule, "false", observed_text=text_sql(why)))
        else:
            near, gap = _near(a, b, a_type, b_type, tolerance)
            out.append(judged(rule, near, observed_num=gap))
    return rows(both, out)


def _near(a: Column, b: Column, a_type: T.DataType, b_type: T.DataType, tolerance: float) -> tuple[Column, Column]:
    """Whether two values are within the tolerance, and their difference as a number."""
    same = C.same_value(a, b, a_type, b_type)
    if not C.is_numeric(a_type):
        return same, F.when(same, F.lit(0.0))
    if C.is_float(a_type) or C.is_float(b_type):
        x, y = a.cast("double"), b.cast("double")
        gap = F.when(same | (F.isnan(x) & F.isnan(y)), F.lit(0.0)).otherwise(F.abs(x - y))
        if tolerance == 0:
            return F.when(a.isNotNull() & b.isNotNull(), same | (F.isnan(x) & F.isnan(y))), gap
        return ~F.isnan(gap) & (gap <= F.lit(float(tolerance))), gap
    wide = [c.cast(C.WIDE_INTEGER) if isinstance(t, T.IntegralType) else c for c, t in ((a, a_type), (b, b_type))]
    gap = F.when(same, F.lit(0.0)).otherwise(F.abs(F.try_subtract(*wide)).cast("double"))
    return F.when(a.isNotNull() & b.isNotNull(), same | (gap <= F.lit(float(tolerance))) if tolerance else same), gap


def row_differences(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (as a bag) that one table holds more often than the other: columns, ``only_left``, ``only_right``."""
    why = incomparable_columns(left, right, columns, None)
    if why:
        raise ValueError(why)
    surplus = F.col("l") - F.col("r")
    tagged = _tagged(left, right, columns, None)
    return (
        tagged.filter(surplus != 0)
        .select(
            *[C.shown_form(F.col(f"k{i}"), tagged.schema[f"k{i}"].dataType).alias(c) for i, c in enumerate(columns)],
            F.greatest(surplus, F.lit(0)).alias("only_left"),
            F.greatest(-surplus, F.lit(0)).alias("only_right"),
        )
    )


def compare_rows(
    left: DataFrame, right: DataFrame, columns: Sequence[str], check_id: str = "compare_rows"
) -> DataFrame:
    """Two verdicts: each table, as a bag of rows, is contained in the other; failed with the reason if types cannot be compared."""
    why = incomparable_columns(left, right, columns, None)
    if why:
        return failed_comparison(left, "compare_rows", columns, check_id, why)
    return rows(bag_totals(left, right, columns), bag_verdicts("compare_rows", columns, check_id))


def bag_totals(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: rows of each table, and rows that only one holds (or holds more often)."""
    surplus = F.col("l") - F.col("r")
    return _tagged(left, right, columns, None).agg(
        F.coalesce(F.sum("l"), F.lit(0)).alias("in_left"),
        F.coalesce(F.sum("r"), F.lit(0)).alias("in_right"),
        F.coalesce(F.sum(F.greatest(surplus, F.lit(0))), F.lit(0)).alias("only_left"),
        F.coalesce(F.sum(F.greatest(-surplus, F.lit(0))), F.lit(0)).alias("only_right"),
    )


def bag_verdicts(kind: str, columns: Sequence[str], check_id: str, **more: Column) -> list[dict[str, Column]]:
    out = []
    for side, size, lone in (("right", "in_left", "only_left"), ("left", "in_right", "only_right")):
        rule = Rule(kind=kind, columns=tuple(columns), check_id=f"{check_id}.missing_from_{side}")
        out.append(judged(rule, F.col(lone) == 0, element_count=F.col(size), unexpected_count=F.col(lone), **more))
    return out
