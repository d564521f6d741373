"""Exact quantiles of wide whole numbers, decimals, dates and times, in the column's own type.

Values are treated as whole numbers in order: integers themselves, decimals in units of their last digit (up to 128
bits), dates as days, times as microseconds. A pass cuts the range that holds a wanted rank into ``CELLS`` cells and
counts the rows of each, with the least and the greatest value met there; the cell that holds the rank is the next
pass's range. Counts combine in the tasks, a row per cell and task is shuffled, and each pass reads only the range it cuts, on the bare
column. A range of few rows, or of few possible values, is counted value by value. Nothing is rounded: a cell
only has to keep the order, the answer is a value that was counted.
"""

from __future__ import annotations

import bisect
import datetime
import decimal
import itertools
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import columns as C

CELLS = 1024
#: Rows of all ranges of a column that are counted value by value.
FEW_ROWS = 50_000
PASSES = 40
#: Decimals of so many digits, and integers of up to 32 bits, are told apart as floating-point numbers.
NARROW = 15


class Unsettled(Exception):
    """The exact search did not come to an end."""


def is_wide(dtype: T.DataType) -> bool:
    return C.is_temporal(dtype) or isinstance(dtype, T.LongType) or (isinstance(dtype, T.DecimalType) and dtype.precision > NARROW)


@dataclass(frozen=True)
class Line:
    """The column's values as whole numbers."""

    dtype: T.DataType

    @property
    def scale(self) -> int:
        return self.dtype.scale if isinstance(self.dtype, T.DecimalType) else 0

    def number(self, c: Column) -> Column:
        """A number column in the order of the values."""
        if isinstance(self.dtype, T.DateType):
            return F.unix_date(c).cast("bigint")
        if isinstance(self.dtype, T.TimestampType):
            return F.unix_micros(c)
        if isinstance(self.dtype, T.TimestampNTZType):
            return F.timestamp_diff("MICROSECOND", F.lit(datetime.datetime(1970, 1, 1)).cast("timestamp_ntz"), c)
        return c

    def unit(self, text: str | None) -> int | None:
        """What ``number`` shows as text, as a whole number."""
        return None if text is None else int(Fraction(decimal.Decimal(text)) * 10**self.scale)

    def at(self, unit: int) -> Column:
        """A literal of the column's type."""
        if isinstance(self.dtype, T.DateType):
            return F.date_from_unix_date(F.lit(unit))
        if isinstance(self.dtype, T.TimestampType):
            return F.timestamp_micros(F.lit(unit).cast("bigint"))
        if isinstance(self.dtype, T.TimestampNTZType):
            return F.timestamp_add("MICROSECOND", F.lit(unit).cast("bigint"), F.lit(datetime.datetime(1970, 1, 1)).cast("timestamp_ntz"))
        return F.lit(str(self.value(unit))).cast(self.dtype)

    def value(self, unit: int | Fraction) -> object:
        """The number itself: an integer, else a decimal or float that is exactly it, else a decimal of 38 digits."""
        exact = Fraction(unit) / 10**self.scale
        if exact.denominator == 1 and not self.scale:
            return exact.numerator
        if not self.scale and Fraction(float(exact)) == exact:
            return float(exact)
        with decimal.localcontext(prec=60):
            found = decimal.Decimal(exact.numerator) / exact.denominator
        if Fraction(unit).denominator == 1:
            return found.quantize(decimal.Decimal(1).scaleb(-self.scale), context=decimal.Context(prec=60))
        return decimal.Context(prec=38).create_decimal(found)

    def cell(self, low: int, high: int) -> Column:
        """Number of the cell that a value between the ends falls in: it never falls as the value rises."""
        v = F.col("v")
        width = -(-(high - low + 1) // CELLS)
        if isinstance(self.dtype, T.DecimalType):
            far = F.coalesce(F.try_subtract(v, self.at(low)).cast("double"), v.cast("double") - self.at(low).cast("double"))
            return F.floor(far * float(10**self.scale) / float(width)).cast("bigint")
        if high - low >= 2**63:
            return F.floor((v.cast("double") - float(low)) / float(width)).cast("bigint")
        return F.expr(f"(v - ({low}L)) div {width}L" if low > -(2**63) else f"(v + 1 + {2**63 - 1}L) div {width}L")


@dataclass
class _Range:
    """Values between ``low`` and ``high``, of which ``below`` rows of the column are smaller and ``rows`` are inside."""

    low: int
    high: int
    below: int
    rows: int
    ranks: list[int]


def ranks_found(df: DataFrame, ranks: Mapping[str, Sequence[int]], ends: Mapping[str, tuple[int, int, int]]) -> dict[str, dict[int, int]]:
    """column -> {rank -> value as a whole number}; ``ends`` are each column's least and greatest one and its rows with a value."""
    found: dict[str, dict[int, int]] = {n: {} for n in ranks}
    todo = {n: [_Range(*ends[n][:2], 0, ends[n][2], sorted(set(r)))] for n, r in ranks.items() if ends[n][2]}
    for _ in range(PASSES):
        for name in list(todo):
            settled = [r for r in todo[name] if r.low == r.high]
            found[name] |= {k: r.low for r in settled for k in r.ranks}
            todo[name] = [r for r in todo[name] if r.low < r.high]
            if not todo[name]:
                del todo[name]
        if not todo:
            return found
        plans = [_counted(df, name, k, held) for k, (name, held) in enumerate(todo.items())]
        union = plans[0]
        for plan in plans[1:]:
            union = union.unionByName(plan)
        cells: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        for row in union.collect():  # at most CELLS rows a range (a decimal's cell may round at its ends), or FEW_ROWS a column
            line = Line(df.schema[list(todo)[row["column"]]].dataType)
            cells.setdefault((row["column"], row["range"]), []).append((line.unit(row["first"]), line.unit(row["last"]), row["n"]))
        todo = {name: [part for j, r in enumerate(held) for part in _closer(r, sorted(cells.get((k, j), [])))] for k, (name, held) in enumerate(todo.items())}
    raise Unsettled("the ranges of the wanted ranks do not get narrower")


def _counted(df: DataFrame, name: str, k: int, held: Sequence[_Range]) -> DataFrame:
    """(column, range, first, last, n) for every cell of a column's ranges that holds rows."""
    line, c = Line(df.schema[name].dataType), C.column(name)
    by_value = sum(r.rows for r in held) <= FEW_ROWS or all(r.high - r.low < CELLS for r in held)
    inside = [(c >= line.at(r.low)) & (c <= line.at(r.high)) for r in held]
    place, cell = F.lit(None).cast("int"), F.lit(None).cast("bigint")
    for j, r in enumerate(held):
        place = F.when(inside[j], F.lit(j)).otherwise(place)
    rows = df.filter(C.any_of(inside)).select(place.alias("range"), line.number(c).alias("v"))
    if by_value:
        groups = rows.groupBy("range", F.col("v").alias("cell"))
    else:
        for j, r in enumerate(held):
            here = F.col("range") == j
            cell = F.when(here, line.cell(r.low, r.high)).otherwise(cell)
        groups = rows.groupBy("range", cell.alias("cell"))
    return groups.agg(F.min("v").cast("string").alias("first"), F.max("v").cast("string").alias("last"), F.count(F.lit(1)).alias("n")).select(
        F.lit(k).alias("column"), "range", "first", "last", "n"
    )


def _closer(held: _Range, cells: Sequence[tuple[int, int, int]]) -> list[_Range]:
    """The cells that hold the range's ranks."""
    upto = list(itertools.accumulate((n for *_, n in cells), initial=held.below))
    out: dict[int, _Range] = {}
    for rank in held.ranks:
        at = bisect.bisect_right(upto, rank) - 1
        if not 0 <= at < len(cells):
            raise Unsettled("the table changes from one read to the next: stage it, then check it")
        low, high, n = cells[at]
        out.setdefault(at, _Range(low, high, upto[at], n, [])).ranks.append(rank)
    return list(out.values())


def wide_quantiles(df: DataFrame, wanted: Mapping[str, Sequence[float]]) -> tuple[int, dict[str, tuple[int, dict[float, object]]]]:
    """Rows of the table, and column -> (rows with a value, quantile -> value).

    Numbers are interpolated as ``percentile`` does, exactly. Dates and times, which have no mean, give the first value that at least the
    wanted share of rows does not exceed, as text.
    """
    lines = {n: Line(df.schema[n].dataType) for n in wanted}
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, (n, line) in enumerate(lines.items()):
        v = line.number(C.column(n))
        aggs += [F.count(C.column(n)).alias(f"n{i}"), F.min(v).cast("string").alias(f"low{i}"), F.max(v).cast("string").alias(f"high{i}")]
    seen = df.agg(*aggs).first()
    ends, ranks = {}, {}
    for i, (n, line) in enumerate(lines.items()):
        ends[n] = (line.unit(seen[f"low{i}"]), line.unit(seen[f"high{i}"]), seen[f"n{i}"])
        ranks[n] = [r for p in wanted[n] for r in _ranks(p, ends[n][2], line)] if ends[n][2] else []
    found = ranks_found(df, ranks, ends)
    out = {}
    for n, line in lines.items():
        present = ends[n][2]
        out[n] = (present, {p: _answer(p, present, line, found[n]) if present else None for p in wanted[n]})
    texts = [(n, p) for n, line in lines.items() for p, v in out[n][1].items() if C.is_temporal(line.dtype) and v is not None]
    if texts:  # evaluated on one local row, without a job
        shown = df.sparkSession.range(1).select(*[lines[n].at(out[n][1][p]).cast("string").alias(f"t{k}") for k, (n, p) in enumerate(texts)]).first()
        for k, (n, p) in enumerate(texts):
            out[n][1][p] = shown[k]
    return seen["rows"], out


def _ranks(p: float, n: int, line: Line) -> tuple[int, ...]:
    exact = Fraction(str(p))
    if C.is_temporal(line.dtype):
        return (max(math.ceil(exact * n) - 1, 0),)
    position = exact * (n - 1)
    return math.floor(position), math.ceil(position)


def _answer(p: float, n: int, line: Line, at: Mapping[int, int]) -> object:
    ranks = _ranks(p, n, line)
    if len(ranks) == 1:
        return at[ranks[0]]
    first, last = ranks
    return line.value(at[first] + (Fraction(str(p)) * (n - 1) - first) * (at[last] - at[first]))
