"""Rules: what a check asks of a table, as plain values.

Each ``expect_*`` function checks its arguments and returns one rule. A rule touches
no data; ``plumbline.plans.suite.Suite`` turns many of them into few DataFrames.
"""

from __future__ import annotations

import dataclasses
import decimal
import functools
import inspect
import json
import math
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import columns as C

# A longer collection appears in a report by its size.
SHOWN_MEMBERS = 100
# Up to this many members a value set is a literal IN list; beyond it the set becomes a relation.
LITERAL_SET_LIMIT = 1000
LITERAL_PAIR_LIMIT = 50

Holds = Callable[[Sequence[Column], Sequence[T.DataType]], Column]


@dataclass(frozen=True, kw_only=True)
class Rule:
    kind: str
    columns: tuple[str, ...] = ()
    check_id: str | None = None
    literals: tuple[object, ...] = ()  # compared with every column of the rule
    numeric: bool = False  # does the check only make sense on numbers?
    compared: bool = False  # are the columns compared with each other?
    config: str = "{}"  # the arguments it was declared with, as JSON

    def misfit(self, dtypes: Sequence[T.DataType]) -> str | None:
        """Why the check cannot run on columns of these types, or None if it can."""
        for name, dtype in zip(self.columns, dtypes):
            if self.numeric and not C.is_numeric(dtype):
                return f"{name} is {C.type_name(dtype)}, not a number"
            odd = [v for v in self.literals if not C.accepts(dtype, v)]
            if odd:
                return f"{name} is {C.type_name(dtype)}, not comparable with {odd[0]!r}"
        return C.incomparable(self.columns, dtypes) if self.compared else None


@dataclass(frozen=True, kw_only=True)
class RowRule(Rule):
    """A predicate every evaluated row should satisfy, up to the tolerance ``mostly``."""

    holds: Holds
    text: Callable[[str, T.DataType], str | None] | None = None  # the same as SQL, for a quoted column; None where only columns will do
    mostly: float = 1.0
    ignore_row_if: str = "all_values_are_missing"
    subject_is_null: bool = False  # the null itself is what is judged: evaluate all rows
    patterns: tuple[str, ...] = ()


@dataclass(frozen=True, kw_only=True)
class AggregateRule(Rule):
    """One aggregate of a column (or the row count) inside an inclusive range."""

    measure: Callable[[Column, T.DataType], Column] | None = None  # None: the row count
    function: str | None = None  # the measure's name, if it is an aggregate of the bare column
    low: object = None
    high: object = None
    apart: bool = False  # an aggregate that Spark cannot compile: keep it out of the others' pass


@dataclass(frozen=True, kw_only=True)
class QuantileRule(Rule):
    """Quantiles, each inside its own range. Exact unless ``approx``."""

    probabilities: tuple[float, ...]
    ranges: tuple[tuple[object, object], ...]
    approx: bool = False

    def misfit(self, dtypes: Sequence[T.DataType]) -> str | None:
        name, dtype = self.columns[0], dtypes[0]
        if not C.is_numeric(dtype) and (self.approx or not C.is_temporal(dtype)):
            return f"{name} is {C.type_name(dtype)}, not a number" + ("" if self.approx else ", date or time")
        odd = [b for r in self.ranges for b in r if b is not None and not C.accepts(dtype, b)]
        return f"{name} is {C.type_name(dtype)}, not comparable with {odd[0]!r}" if odd else None


@dataclass(frozen=True, kw_only=True)
class FrequencyRule(Rule):
    """A check on the distinct values (or key combinations) of a table and their counts.

    ``members`` holds tuples, one entry per column.
    """

    judge: str
    members: tuple[tuple[object, ...], ...] = ()
    relation: DataFrame | None = None  # the members as a table of one column, of any size
    weights: tuple[float, ...] = ()
    low: float | None = None
    high: float | None = None
    mostly: float = 1.0
    ties_okay: bool = False
    few_members: bool = False  # meet a large table of members through a filter, see operators.setfilter
    few_repeats: bool = False  # look for repeats with a counting filter, see operators.uniqueness
    ignore_row_if: str = "all_values_are_missing"

    def misfit(self, dtypes: Sequence[T.DataType]) -> str | None:
        for i, (name, dtype) in enumerate(zip(self.columns, dtypes)):
            odd = [m[i] for m in self.members if not C.accepts(dtype, m[i])]
            if odd:
                return f"{name} is {C.type_name(dtype)}, not comparable with {odd[0]!r}"
        if self.relation is not None:
            held = self.relation.schema[0]
            why = C.incomparable([held.name, *self.columns], [held.dataType, *dtypes])
            if why:
                return why
        return super().misfit(dtypes)


@dataclass(frozen=True, kw_only=True)
class SchemaRule(Rule):
    """A promise about names, order or types: answered from the analysed plan, no scan."""

    test: Callable[[T.StructType], tuple[bool, float | None, str | None]] = field(repr=False)


@dataclass(frozen=True, kw_only=True)
class ConstraintRule(Rule):
    """A query that must return no rows; ``{table}`` in it stands for the table under test."""

    query: str


# ---------------------------------------------------------------- argument checks


def recorded(expect):
    """Keep the arguments of a declaration with its rule, for the report."""
    signature = inspect.signature(expect)

    @functools.wraps(expect)
    def declare(*args, **kwargs):
        rule = expect(*args, **kwargs)
        given = signature.bind(*args, **kwargs).arguments
        shown = {k: _shown(v) for k, v in given.items() if k != "check_id" and v is not None}
        return dataclasses.replace(rule, config=json.dumps(shown, ensure_ascii=False))

    return declare


def _shown(value: object) -> object:
    if isinstance(value, DataFrame):
        return {"table": value.columns}
    if isinstance(value, Mapping):
        return {str(k): _shown(v) for k, v in value.items()}
    if isinstance(value, Iterable) and not isinstance(value, str):
        held = list(value) if isinstance(value, (Sequence, set, frozenset)) else []
        if len(held) > SHOWN_MEMBERS:
            return {"size": len(held)}
        ordered = sorted(held, key=repr) if isinstance(value, (set, frozenset)) else held
        return [_shown(v) for v in ordered]
    return value if isinstance(value, (bool, int, str)) or (isinstance(value, float) and math.isfinite(value)) else str(value)


def _mostly(mostly: float) -> float:
    if not 0 <= mostly <= 1:
        raise ValueError(f"mostly must lie in [0, 1], got {mostly!r}")
    return float(mostly)


def _policy(policy: str) -> str:
    if policy not in C.MISSING_POLICIES:
        raise ValueError(f"ignore_row_if must be one of {C.MISSING_POLICIES}, got {policy!r}")
    return policy


def _bounds(low: object, high: object) -> tuple[object, ...]:
    given = tuple(v for v in (low, high) if v is not None)
    if not given:
        raise ValueError("give min_value, max_value or both")
    if any(isinstance(v, float) and math.isnan(v) for v in given):
        raise ValueError("a bound may not be NaN")
    numbers = all(isinstance(v, (int, float, decimal.Decimal)) and not isinstance(v, bool) for v in given)
    if len(given) == 2 and (numbers or type(low) is type(high)) and low > high:  # type: ignore[operator]
        raise ValueError(f"min_value {low!r} is above max_value {high!r}")
    return given


def _members(value_set: Iterable[object]) -> tuple[object, ...]:
    if isinstance(value_set, str):
        raise ValueError("value_set must be a collection, not a single string")
    seen = dict.fromkeys(value_set)
    if None in seen:
        raise ValueError("a value set may not hold null: x IN (.., NULL) is never false")
    return tuple(seen)


def _columns(names: Sequence[str], least: int = 1) -> tuple[str, ...]:
    names = (names,) if isinstance(names, str) else tuple(names)
    if len(names) < least or len(set(names)) != len(names):
        raise ValueError(f"need at least {least} different columns, got {names!r}")
    return names


def _texts(patterns: Iterable[str]) -> tuple[str, ...]:
    patterns = (patterns,) if isinstance(patterns, str) else tuple(patterns)
    if not patterns or not all(isinstance(p, str) for p in patterns):
        raise ValueError(f"need at least one pattern, and only text, got {patterns!r}")
    return patterns


# ---------------------------------------------------------------- row rules


@recorded
def expect_column_values_to_be_null(column: str, mostly: float = 1.0, check_id: str | None = None) -> RowRule:
    return RowRule(
        kind="expect_column_values_to_be_null", columns=_columns(column), check_id=check_id,
        holds=lambda c, t: c[0].isNull(), text=lambda c, t: f"{c} IS NULL", mostly=_mostly(mostly), ignore_row_if="never", subject_is_null=True,
    )


@recorded
def expect_column_values_to_not_be_null(column: str, mostly: float = 1.0, check_id: str | None = None) -> RowRule:
    return RowRule(
        kind="expect_column_values_to_not_be_null", columns=_columns(column), check_id=check_id,
        holds=lambda c, t: c[0].isNotNull(), text=lambda c, t: f"{c} IS NOT NULL", mostly=_mostly(mostly), ignore_row_if="never", subject_is_null=True,
    )


@recorded
def expect_column_values_to_be_between(
    column: str, min_value: object = None, max_value: object = None, mostly: float = 1.0, check_id: str | None = None
) -> RowRule:
    return RowRule(
        kind="expect_column_values_to_be_between", columns=_columns(column), check_id=check_id,
        literals=_bounds(min_value, max_value), mostly=_mostly(mostly),
        holds=lambda c, t: C.in_range(c[0], t[0], min_value, max_value),
        text=lambda c, t: C.range_sql(c, t, min_value, max_value),
    )


def _table_rule(
    kind: str, judge: str, column: str, table: DataFrame, check_id: str | None, mostly: float, few_members: bool
) -> FrequencyRule:
    """Membership in a table of one column, whose nulls are no members: joined to the column's frequency table."""
    if len(table.columns) != 1:
        raise ValueError(f"a table of members has one column, got {table.columns}")
    return FrequencyRule(
        kind=kind, columns=_columns(column), check_id=check_id, judge=judge, relation=table, mostly=_mostly(mostly), few_members=few_members
    )


@recorded
def expect_column_values_to_be_in_set(
    column: str, value_set: Iterable[object] | DataFrame, mostly: float = 1.0, few_members: bool = False, check_id: str | None = None
) -> Rule:
    """``few_members``: the set is a large table, and few rows are believed to be in it. A filter then tells most rows
    from members where they are read; the verdict is the same."""
    kind = "expect_column_values_to_be_in_set"
    if isinstance(value_set, DataFrame):
        return _table_rule(kind, "rows_in_set", column, value_set, check_id, mostly, few_members)
    members = _members(value_set)
    if len(members) > LITERAL_SET_LIMIT:
        return FrequencyRule(
            kind=kind, columns=_columns(column), check_id=check_id, judge="rows_in_set",
            members=tuple((m,) for m in members), mostly=_mostly(mostly),
        )
    return RowRule(
        kind=kind, columns=_columns(column), check_id=check_id, literals=members, mostly=_mostly(mostly),
        holds=lambda c, t: C.in_values(c[0], t[0], members), text=lambda c, t: C.values_sql(c, t, members),
    )


@recorded
def expect_column_values_to_not_be_in_set(
    column: str, value_set: Iterable[object] | DataFrame, mostly: float = 1.0, few_members: bool = False, check_id: str | None = None
) -> Rule:
    """``few_members`` as for ``expect_column_values_to_be_in_set``."""
    kind = "expect_column_values_to_not_be_in_set"
    if isinstance(value_set, DataFrame):
        return _table_rule(kind, "rows_not_in_set", column, value_set, check_id, mostly, few_members)
    members = _members(value_set)
    if len(members) > LITERAL_SET_LIMIT:
        return FrequencyRule(
            kind=kind, columns=_columns(column), check_id=check_id, judge="rows_not_in_set",
            members=tuple((m,) for m in members), mostly=_mostly(mostly),
        )
    return RowRule(
        kind=kind, columns=_columns(column), check_id=check_id, literals=members, mostly=_mostly(mostly),
        holds=lambda c, t: ~C.in_values(c[0], t[0], members),
        text=lambda c, t: f"NOT ({inside})" if (inside := C.values_sql(c, t, members)) else None,
    )


@recorded
def expect_column_value_lengths_to_be_between(
    column: str, min_value: int | None = None, max_value: int | None = None, mostly: float = 1.0,
    check_id: str | None = None,
) -> RowRule:
    _bounds(min_value, max_value)
    return RowRule(
        kind="expect_column_value_lengths_to_be_between", columns=_columns(column), check_id=check_id,
        mostly=_mostly(mostly),
        holds=lambda c, t: C.in_range(F.char_length(c[0].cast("string")), T.IntegerType(), min_value, max_value),
        text=lambda c, t: C.range_sql(f"char_length(CAST({c} AS STRING))", T.IntegerType(), min_value, max_value),
    )


@recorded
def expect_column_value_lengths_to_equal(
    column: str, value: int, mostly: float = 1.0, check_id: str | None = None
) -> RowRule:
    return RowRule(
        kind="expect_column_value_lengths_to_equal", columns=_columns(column), check_id=check_id,
        mostly=_mostly(mostly), holds=lambda c, t: F.char_length(c[0].cast("string")) == F.lit(value),
    )


def _matches_any(c: Column, patterns: Sequence[str]) -> Column:
    text = c.cast("string")
    return C.any_of([text.rlike(p) for p in patterns])


@recorded
def expect_column_values_to_match_regex(
    column: str, regex: str, mostly: float = 1.0, check_id: str | None = None
) -> RowRule:
    """The pattern is searched for anywhere in the value; anchor it to match the whole."""
    patterns = _texts(regex)
    return RowRule(
        kind="expect_column_values_to_match_regex", columns=_columns(column), check_id=check_id,
        mostly=_mostly(mostly), patterns=patterns, holds=lambda c, t: _matches_any(c[0], patterns),
    )


@recorded
def expect_column_values_to_match_regex_list(
    column: str, regex_list: Sequence[str], mostly: float = 1.0, check_id: str | None = None
) -> RowRule:
    """The value matches at least one pattern."""
    patterns = _texts(regex_list)
    return RowRule(
        kind="expect_column_values_to_match_regex_list", columns=_columns(column), check_id=check_id,
        mostly=_mostly(mostly), patterns=patterns, holds=lambda c, t: _matches_any(c[0], patterns),
    )


@recorded
def expect_column_values_to_not_match_regex_list(
    column: str, regex_list: Sequence[str], mostly: float = 1.0, check_id: str | None = None
) -> RowRule:
    """The value matches none of the patterns."""
    patterns = _texts(regex_list)
    return RowRule(
        kind="expect_column_values_to_not_match_regex_list", columns=_columns(column), check_id=check_id,
        mostly=_mostly(mostly), patterns=patterns, holds=lambda c, t: ~_matches_any(c[0], patterns),
    )


@recorded
def expect_column_values_to_not_match_like_pattern_list(
    column: str, like_pattern_list: Sequence[str], mostly: float = 1.0, check_id: str | None = None
) -> RowRule:
    """The value matches none of the SQL LIKE patterns (``%`` any text, ``_`` one character)."""
    patterns = _texts(like_pattern_list)
    return RowRule(
        kind="expect_column_values_to_not_match_like_pattern_list", columns=_columns(column), check_id=check_id,
        mostly=_mostly(mostly),
        holds=lambda c, t: ~C.any_of([c[0].cast("string").like(p) for p in patterns]),
    )


@recorded
def expect_column_pair_values_a_to_be_greater_than_b(
    column_A: str, column_B: str, mostly: float = 1.0, ignore_row_if: str = "all_values_are_missing",
    check_id: str | None = None,
) -> RowRule:
    return RowRule(
        kind="expect_column_pair_values_a_to_be_greater_than_b", columns=_columns((column_A, column_B), 2),
        check_id=check_id, mostly=_mostly(mostly), ignore_row_if=_policy(ignore_row_if), compared=True,
        holds=lambda c, t: c[0] > c[1],
    )


@recorded
def expect_column_pair_values_to_be_equal(
    column_A: str, column_B: str, mostly: float = 1.0, ignore_row_if: str = "all_values_are_missing",
    check_id: str | None = None,
) -> RowRule:
    return RowRule(
        kind="expect_column_pair_values_to_be_equal", columns=_columns((column_A, column_B), 2),
        check_id=check_id, mostly=_mostly(mostly), ignore_row_if=_policy(ignore_row_if), compared=True,
        holds=lambda c, t: F.coalesce(C.same_value(*c, *t), c[0].isNull() & c[1].isNull()),
    )


@recorded
def expect_column_pair_values_to_be_in_set(
    column_A: str, column_B: str, value_pairs_set: Iterable[tuple[object, object]], mostly: float = 1.0,
    ignore_row_if: str = "all_values_are_missing", check_id: str | None = None,
) -> Rule:
    pairs = tuple(dict.fromkeys(tuple(p) for p in value_pairs_set))
    if any(len(p) != 2 or None in p for p in pairs):
        raise ValueError("value_pairs_set must hold pairs without nulls")
    common = dict(
        kind="expect_column_pair_values_to_be_in_set", columns=_columns((column_A, column_B), 2),
        check_id=check_id, mostly=_mostly(mostly), ignore_row_if=_policy(ignore_row_if),
    )
    if len(pairs) > LITERAL_PAIR_LIMIT:
        return FrequencyRule(judge="rows_in_set", members=pairs, **common)
    return _PairSetRule(
        pairs=pairs,
        holds=lambda c, t: C.any_of(
            [C.equals(c[0], t[0], a) & C.equals(c[1], t[1], b) for a, b in pairs]
        ),
        **common,
    )


@dataclass(frozen=True, kw_only=True)
class _PairSetRule(RowRule):
    pairs: tuple[tuple[object, object], ...] = ()

    def misfit(self, dtypes: Sequence[T.DataType]) -> str | None:
        for i, (name, dtype) in enumerate(zip(self.columns, dtypes)):
            odd = [p[i] for p in self.pairs if not C.accepts(dtype, p[i])]
            if odd:
                return f"{name} is {C.type_name(dtype)}, not comparable with {odd[0]!r}"
        return None


@recorded
def expect_multicolumn_sum_to_equal(
    column_list: Sequence[str], sum_total: float, mostly: float = 1.0,
    ignore_row_if: str = "all_values_are_missing", check_id: str | None = None,
) -> RowRule:
    return RowRule(
        kind="expect_multicolumn_sum_to_equal", columns=_columns(column_list, 2), check_id=check_id, numeric=True,
        mostly=_mostly(mostly), ignore_row_if=_policy(ignore_row_if),
        holds=lambda c, t: C.row_sum(c, t) == F.lit(sum_total),
    )


@recorded
def expect_select_column_values_to_be_unique_within_record(
    column_list: Sequence[str], mostly: float = 1.0, ignore_row_if: str = "any_value_is_missing",
    check_id: str | None = None,
) -> RowRule:
    """The columns of one row hold pairwise different values; a null never equals anything."""
    return RowRule(
        kind="expect_select_column_values_to_be_unique_within_record", columns=_columns(column_list, 2),
        check_id=check_id, mostly=_mostly(mostly), ignore_row_if=_policy(ignore_row_if), compared=True,
        holds=lambda c, t: ~C.some_pair_equal(c, t),
    )


# ---------------------------------------------------------------- aggregate rules


def _aggregate(kind: str, column: str, low: object, high: object, check_id: str | None, measure, numeric=True, function=None):
    """``numeric=False``: the aggregate keeps the column's type, so the bounds must fit that type."""
    bounds = _bounds(low, high)
    return AggregateRule(
        kind=kind, columns=_columns(column), check_id=check_id, literals=() if numeric else bounds, numeric=numeric,
        measure=measure, low=low, high=high, function=function,
    )


@recorded
def expect_column_max_to_be_between(
    column: str, min_value: object = None, max_value: object = None, check_id: str | None = None
) -> AggregateRule:
    return _aggregate("expect_column_max_to_be_between", column, min_value, max_value, check_id,
                      lambda c, t: F.max(c), numeric=False, function="max")


@recorded
def expect_column_min_to_be_between(
    column: str, min_value: object = None, max_value: object = None, check_id: str | None = None
) -> AggregateRule:
    return _aggregate("expect_column_min_to_be_between", column, min_value, max_value, check_id,
                      lambda c, t: F.min(c), numeric=False, function="min")


@recorded
def expect_column_mean_to_be_between(
    column: str, min_value: float | None = None, max_value: float | None = None, check_id: str | None = None
) -> AggregateRule:
    return _aggregate("expect_column_mean_to_be_between", column, min_value, max_value, check_id,
                      lambda c, t: F.try_avg(c) if isinstance(t, T.DecimalType) else F.avg(c))


@recorded
def expect_column_sum_to_be_between(
    column: str, min_value: float | None = None, max_value: float | None = None, check_id: str | None = None
) -> AggregateRule:
    return _aggregate("expect_column_sum_to_be_between", column, min_value, max_value, check_id,
                      lambda c, t: F.try_sum(c.cast(C.WIDE_INTEGER)) if isinstance(t, T.IntegralType)
                      else F.try_sum(c) if isinstance(t, T.DecimalType) else F.sum(c))


@recorded
def expect_column_stdev_to_be_between(
    column: str, min_value: float | None = None, max_value: float | None = None, check_id: str | None = None
) -> AggregateRule:
    """Sample standard deviation."""
    return _aggregate("expect_column_stdev_to_be_between", column, min_value, max_value, check_id,
                      lambda c, t: F.stddev_samp(c), function="stddev_samp")


@recorded
def expect_table_row_count_to_be_between(
    min_value: int | None = None, max_value: int | None = None, check_id: str | None = None
) -> AggregateRule:
    _bounds(min_value, max_value)
    return AggregateRule(kind="expect_table_row_count_to_be_between", check_id=check_id, low=min_value, high=max_value)


@recorded
def expect_table_row_count_to_equal(value: int, check_id: str | None = None) -> AggregateRule:
    return AggregateRule(kind="expect_table_row_count_to_equal", check_id=check_id, low=value, high=value)


@recorded
def expect_column_median_to_be_between(
    column: str, min_value: object = None, max_value: object = None, approx: bool = False,
    check_id: str | None = None,
) -> QuantileRule:
    """Median of numbers, interpolated; of dates and times, the first that half of the rows do not exceed."""
    _bounds(min_value, max_value)
    return QuantileRule(
        kind="expect_column_median_to_be_between", columns=_columns(column), check_id=check_id,
        probabilities=(0.5,), ranges=((min_value, max_value),), approx=approx,
    )


@recorded
def expect_column_quantile_values_to_be_between(
    column: str, quantile_ranges: Mapping[str, Sequence], approx: bool = False, check_id: str | None = None
) -> QuantileRule:
    """``quantile_ranges`` = ``{"quantiles": [..], "value_ranges": [[low, high], ..]}``, None = open side."""
    probabilities = tuple(float(q) for q in quantile_ranges["quantiles"])
    ranges = tuple((low, high) for low, high in quantile_ranges["value_ranges"])
    if not probabilities or len(probabilities) != len(ranges):
        raise ValueError("quantiles and value_ranges must be parallel and not empty")
    if not all(0 <= p <= 1 for p in probabilities):
        raise ValueError("quantiles must lie in [0, 1]")
    return QuantileRule(
        kind="expect_column_quantile_values_to_be_between", columns=_columns(column), check_id=check_id,
        probabilities=probabilities, ranges=ranges, approx=approx,
    )


# ---------------------------------------------------------------- distinct values, frequencies, keys


def _set_rule(kind: str, judge: str, column: str, value_set, check_id, **more) -> FrequencyRule:
    return FrequencyRule(
        kind=kind, judge=judge, columns=_columns(column), check_id=check_id,
        members=tuple((m,) for m in _members(value_set)), **more,
    )


@recorded
def expect_column_distinct_values_to_be_in_set(
    column: str, value_set: Iterable[object], check_id: str | None = None
) -> FrequencyRule:
    return _set_rule("expect_column_distinct_values_to_be_in_set", "distinct_in_set", column, value_set, check_id)


@recorded
def expect_column_distinct_values_to_contain_set(
    column: str, value_set: Iterable[object], check_id: str | None = None
) -> FrequencyRule:
    return _set_rule("expect_column_distinct_values_to_contain_set", "distinct_contains", column, value_set, check_id)


@recorded
def expect_column_distinct_values_to_equal_set(
    column: str, value_set: Iterable[object], check_id: str | None = None
) -> FrequencyRule:
    return _set_rule("expect_column_distinct_values_to_equal_set", "distinct_equals", column, value_set, check_id)


@recorded
def expect_column_most_common_value_to_be_in_set(
    column: str, value_set: Iterable[object], ties_okay: bool = False, check_id: str | None = None
) -> FrequencyRule:
    """The most frequent value is in the set. On a tie: fail, or with ``ties_okay`` any tied value will do."""
    return _set_rule("expect_column_most_common_value_to_be_in_set", "most_common", column, value_set, check_id,
                     ties_okay=ties_okay)


@recorded
def expect_column_proportion_of_unique_values_to_be_between(
    column: str, min_value: float | None = None, max_value: float | None = None, check_id: str | None = None
) -> FrequencyRule:
    """Distinct values divided by non-null rows."""
    _bounds(min_value, max_value)
    return FrequencyRule(
        kind="expect_column_proportion_of_unique_values_to_be_between", judge="unique_proportion",
        columns=_columns(column), check_id=check_id, low=min_value, high=max_value,
    )


@recorded
def expect_column_unique_value_count_to_be_between(
    column: str, min_value: int | None = None, max_value: int | None = None, approx: bool = False,
    check_id: str | None = None,
) -> Rule:
    """Number of distinct values. ``approx`` trades exactness for a sketch in a pass of its own."""
    kind = "expect_column_unique_value_count_to_be_between"
    _bounds(min_value, max_value)
    if approx:
        return AggregateRule(
            kind=kind, columns=_columns(column), check_id=check_id, low=min_value, high=max_value,
            measure=lambda c, t: F.approx_count_distinct(c), apart=True,
        )
    return FrequencyRule(
        kind=kind, judge="unique_count", columns=_columns(column), check_id=check_id, low=min_value, high=max_value
    )


@recorded
def expect_column_values_to_be_unique(
    column: str, mostly: float = 1.0, few_repeats: bool = False, check_id: str | None = None
) -> FrequencyRule:
    """``few_repeats``: the column is believed to be nearly unique. Repeats are then sought with a filter that
    shuffles no rows but those that may repeat; the verdict is the same."""
    return FrequencyRule(
        kind="expect_column_values_to_be_unique", judge="unique", columns=_columns(column), check_id=check_id,
        mostly=_mostly(mostly), few_repeats=few_repeats,
    )


@recorded
def expect_compound_columns_to_be_unique(
    column_list: Sequence[str], mostly: float = 1.0, ignore_row_if: str = "all_values_are_missing",
    few_repeats: bool = False, check_id: str | None = None,
) -> FrequencyRule:
    """The columns together are a key; nulls compare as equal to each other. ``few_repeats`` as for one column."""
    return FrequencyRule(
        kind="expect_compound_columns_to_be_unique", judge="unique", columns=_columns(column_list),
        check_id=check_id, mostly=_mostly(mostly), ignore_row_if=_policy(ignore_row_if), few_repeats=few_repeats,
    )


@recorded
def expect_column_kl_divergence_to_be_less_than(
    column: str, partition_object: Mapping[str, Sequence], threshold: float, check_id: str | None = None
) -> FrequencyRule:
    """Kullback-Leibler divergence of the observed from the expected distribution, natural log.

    An observed value without expected weight makes it infinite: the check fails, with no number.
    """
    values, weights = tuple(partition_object["values"]), tuple(float(w) for w in partition_object["weights"])
    if len(values) != len(weights) or not values or None in values or len(set(values)) != len(values):
        raise ValueError("values and weights must be parallel, not empty, distinct and without null")
    if any(not w >= 0 for w in weights) or abs(math.fsum(weights) - 1) > 1e-9:
        raise ValueError("weights must not be negative and must sum to 1")
    return FrequencyRule(
        kind="expect_column_kl_divergence_to_be_less_than", judge="kl", columns=_columns(column), check_id=check_id,
        members=tuple((v,) for v in values), weights=weights, high=threshold,
    )


# ---------------------------------------------------------------- schema rules


@recorded
def expect_column_to_exist(column: str, check_id: str | None = None) -> SchemaRule:
    return SchemaRule(
        kind="expect_column_to_exist", columns=_columns(column), check_id=check_id,
        test=lambda s: (column in s.names, None, column if column in s.names else None),
    )


def _type_test(column: str, wanted: tuple[str, ...]):
    def test(schema: T.StructType):
        seen = C.type_name(schema[column].dataType) if column in schema.names else None
        return seen in wanted, None, seen

    return test


@recorded
def expect_column_values_to_be_of_type(column: str, type_: str, check_id: str | None = None) -> SchemaRule:
    """``type_`` is a Spark type class name such as ``DoubleType``."""
    return SchemaRule(
        kind="expect_column_values_to_be_of_type", columns=_columns(column), check_id=check_id,
        test=_type_test(column, (type_,)),
    )


@recorded
def expect_column_values_to_be_in_type_list(
    column: str, type_list: Sequence[str], check_id: str | None = None
) -> SchemaRule:
    return SchemaRule(
        kind="expect_column_values_to_be_in_type_list", columns=_columns(column), check_id=check_id,
        test=_type_test(column, tuple(type_list)),
    )


@recorded
def expect_table_column_count_to_be_between(
    min_value: int | None = None, max_value: int | None = None, check_id: str | None = None
) -> SchemaRule:
    _bounds(min_value, max_value)

    def test(schema: T.StructType):
        n = len(schema)
        fits = (min_value is None or n >= min_value) and (max_value is None or n <= max_value)
        return fits, float(n), None

    return SchemaRule(kind="expect_table_column_count_to_be_between", check_id=check_id, test=test)


@recorded
def expect_table_column_count_to_equal(value: int, check_id: str | None = None) -> SchemaRule:
    return SchemaRule(
        kind="expect_table_column_count_to_equal", check_id=check_id,
        test=lambda s: (len(s) == value, float(len(s)), None),
    )


@recorded
def expect_table_columns_to_match_ordered_list(
    column_list: Sequence[str], check_id: str | None = None
) -> SchemaRule:
    wanted = list(column_list)
    return SchemaRule(
        kind="expect_table_columns_to_match_ordered_list", check_id=check_id,
        test=lambda s: (s.names == wanted, float(len(s)), ",".join(s.names)),
    )


@recorded
def expect_table_columns_to_match_set(column_set: Iterable[str], check_id: str | None = None) -> SchemaRule:
    wanted = set(column_set)
    return SchemaRule(
        kind="expect_table_columns_to_match_set", check_id=check_id,
        test=lambda s: (set(s.names) == wanted, float(len(s)), ",".join(sorted(s.names))),
    )


# ---------------------------------------------------------------- SQL constraints


@recorded
def expect_query_to_return_no_rows(query: str, check_id: str | None = None) -> ConstraintRule:
    return ConstraintRule(kind="expect_query_to_return_no_rows", check_id=check_id, query=query)
