"""Comparison of two large tables by digests of key ranges: only ranges that differ are read again.

Both tables are cut into the same ranges of a key. A range's digest is its row count, sums of two parts of its rows'
hashes and the exclusive or of another hash: none depends on the order of rows, so it combines in the tasks and a
shuffle carries a row per range and task, whatever the tables hold. Ranges that differ are cut again, level by level,
until they hold few rows or a single key; those rows alone are compared as such, so the counts are exact up to digests that agree by
chance (62 bits of sums and 64 more).

A key that is one whole number, date or time is cut by its values, and what is read again is a range of the bare column, which
prunes partitions, files and row groups. Other keys, and several columns together, are cut by their hash.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import columns as C
from plumbline.operators.compare import bag_totals, bag_verdicts, comparable_forms, failed_comparison, incomparable_columns, row_differences
from plumbline.operators.verdict import rows

#: Ranges of a level, the rows that are compared as such without a further level, and ranges kept apart.
RANGES, FEW_ROWS, APART = 1024, 100_000, 32
LEVELS = 8
HALF = 31

Range = tuple[int, int]


@dataclass(frozen=True)
class Differing:
    """Where two tables may differ, and the rows counted on the way."""

    ranges: list[Range]
    nulls: bool  # do the rows without key differ, too?
    left_rows: int
    right_rows: int
    held: int  # rows of both tables inside the ranges
    levels: int


def _place(df: DataFrame, on: Sequence[str], forms: Sequence[Column], by_value: bool) -> Column:
    """The key as a whole number of 64 bits; null for a null key."""
    c = C.column(on[0])
    if by_value:
        dtype = df.schema[on[0]].dataType
        if isinstance(dtype, T.DateType):
            return F.unix_date(c).cast("bigint")
        if isinstance(dtype, T.TimestampType):
            return F.unix_micros(c)
        return c.cast("bigint")
    return F.when(~C.missing([C.column(n) for n in on], "all_values_are_missing"), F.xxhash64(*forms))


def _by_value(left: DataFrame, right: DataFrame, on: Sequence[str]) -> bool:
    kinds = [df.schema[on[0]].dataType for df in (left, right)]
    if len(on) > 1:
        return False
    return all(isinstance(k, T.IntegralType) for k in kinds) or (kinds[0] == kinds[1] and isinstance(kinds[0], (T.DateType, T.TimestampType)))


def _bound(value: int, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.DateType):
        return F.date_from_unix_date(F.lit(value))
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_micros(F.lit(value))
    return F.lit(value)


def inside(df: DataFrame, on: Sequence[str], place: Column, by_value: bool, ranges: Sequence[Range], nulls: bool) -> DataFrame:
    """Rows whose key lies in one of the ranges."""
    c, dtype = C.column(on[0]), df.schema[on[0]].dataType
    if by_value:  # on the bare column, so that it reaches the scan
        tests = [(c >= _bound(a, dtype)) & (c <= _bound(b, dtype)) for a, b in ranges]
    else:
        tests = [place.between(F.lit(a), F.lit(b)) for a, b in ranges]
    if nulls:
        tests.append(place.isNull())
    return df.filter(reduce(or_, tests)) if tests else df.limit(0)


def _digests(df: DataFrame, place: Column, forms: Sequence[Column], cells: Sequence[tuple[int, int, int]]) -> DataFrame:
    """(cell, part, n, low, high, mixed, first, last): a digest per range and its outermost keys; ``cells`` are (start, end, width of a part) in ascending order, cell -1 has null keys."""
    row = df.select(place.alias("p"), F.xxhash64(*forms).alias("h"), F.xxhash64(F.lit(0x5EED), *forms).alias("g"))
    cell, part = F.lit(-1), F.lit(0).cast("bigint")
    for i, (start, end, width) in enumerate(cells):
        here = F.col("p").between(start, end)
        cell = F.when(here, F.lit(i)).otherwise(cell)
        # the distance from the start can exceed 64 bits
        far = F.col("p").cast("decimal(20,0)") - F.lit(str(start)).cast("decimal(20,0)") if end - start >= 2**63 else F.col("p") - F.lit(start)
        steps = F.floor(far / F.lit(str(width)).cast("decimal(20,0)")).cast("bigint") if end - start >= 2**63 else F.expr(f"(p - ({start}L)) div {width}L")
        part = F.when(here, steps).otherwise(part)
    mask = F.lit((1 << HALF) - 1)
    return row.groupBy(cell.alias("cell"), part.alias("part")).agg(
        F.count(F.lit(1)).alias("n"),
        F.try_sum(F.col("h").bitwiseAND(mask)).alias("low"),
        F.try_sum(F.shiftright("h", HALF).bitwiseAND(mask)).alias("high"),
        F.bit_xor("g").alias("mixed"),
        F.min("p").alias("first"),
        F.max("p").alias("last"),
    )


def _compared(left: DataFrame, right: DataFrame) -> DataFrame:
    """Counts of both sides per range, and whether its digests differ (a sum beyond 64 bits counts as a difference)."""
    names = ("n", "low", "high", "mixed")
    none = F.lit(None).cast("bigint")
    kept = ("cell", "part", "first", "last")
    a = left.select(*kept, *[F.col(n).alias(f"l_{n}") for n in names], *[none.alias(f"r_{n}") for n in names])
    b = right.select(*kept, *[none.alias(f"l_{n}") for n in names], *[F.col(n).alias(f"r_{n}") for n in names])
    sides = [F.max(f"{s}_{n}").alias(f"{s}_{n}") for s in "lr" for n in names]
    both = a.unionByName(b).groupBy("cell", "part").agg(F.min("first").alias("first"), F.max("last").alias("last"), *sides)
    same = reduce(and_, [F.coalesce(F.col(f"l_{n}") == F.col(f"r_{n}"), F.lit(False)) for n in names])
    return both.select("cell", "first", "last", F.coalesce("l_n", F.lit(0)).alias("l"), F.coalesce("r_n", F.lit(0)).alias("r"), (~same).alias("differs"))


def _joined(ranges: Sequence[Range], most: int = APART) -> list[Range]:
    """Adjacent ranges as one, and the nearest ones too until no more than ``most`` are left."""
    merged: list[Range] = []
    for a, b in sorted(ranges):
        if merged and a <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    while len(merged) > most:
        gaps = [merged[i + 1][0] - merged[i][1] for i in range(len(merged) - 1)]
        i = gaps.index(min(gaps))
        merged[i : i + 2] = [(merged[i][0], merged[i + 1][1])]
    return merged


def differing_ranges(
    left: DataFrame, right: DataFrame, on: Sequence[str], columns: Sequence[str], ranges: int = RANGES, few_rows: int = FEW_ROWS
) -> Differing:
    """Key ranges whose rows differ, found level by level. A level costs one aggregation of what differed on the level before."""
    by_value = _by_value(left, right, on)
    key_forms = comparable_forms(left, right, on, None)
    forms = comparable_forms(left, right, columns, None)
    places = [_place(df, on, f, by_value) for df, f in zip((left, right), key_forms)]
    low, high = -(2**63), 2**63 - 1
    if by_value:
        ends = [df.select(p.alias("p")).agg(F.min("p").alias("a"), F.max("p").alias("b")) for df, p in zip((left, right), places)]
        seen = ends[0].unionByName(ends[1]).agg(F.min("a").alias("a"), F.max("b").alias("b")).first()
        low, high = (0, 0) if seen["a"] is None else (seen["a"], seen["b"])
    todo, nulls, totals, held, idle = [(low, high)], True, None, 0, 0
    sides = [left, right]
    for level in range(1, LEVELS + 1):
        per = max(1, ranges // len(todo))
        cells = [(a, b, -(-(b - a + 1) // per)) for a, b in todo]
        parts = _compared(*[_digests(df, p, f, cells) for df, p, f in zip(sides, places, forms)]).collect()  # a row per range
        if totals is None:
            totals = (sum(p["l"] for p in parts), sum(p["r"] for p in parts))
            nulls = any(p["differs"] for p in parts if p["cell"] < 0)
            held = sum(totals)
        odd = [p for p in parts if p["differs"]]
        before, held = held, sum(p["l"] + p["r"] for p in odd)
        idle = idle + 1 if held >= before else 0
        todo = _joined([(p["first"], p["last"]) for p in odd if p["cell"] >= 0])
        # no further level if there is little to read, nothing left to cut, or cutting does not help
        if not todo or held <= few_rows or all(a == b for a, b in todo) or idle > 1:
            break
        sides = [inside(df, on, p, by_value, todo, False) for df, p in zip((left, right), places)]
    return Differing(todo, nulls, *totals, held, level)


def _read_again(left: DataFrame, right: DataFrame, on: Sequence[str], found: Differing) -> tuple[DataFrame, DataFrame]:
    by_value = _by_value(left, right, on)
    a, b = (
        inside(df, on, _place(df, on, f, by_value), by_value, found.ranges, found.nulls)
        for df, f in zip((left, right), comparable_forms(left, right, on, None))
    )
    return a, b


def digest_differences(left: DataFrame, right: DataFrame, on: Sequence[str], columns: Sequence[str] | None = None, **limits: int) -> DataFrame:
    """Rows that one table holds more often than the other, as ``row_differences`` gives them, from the differing key ranges alone."""
    columns = list(columns or left.columns)
    why = incomparable_columns(left, right, columns, None)
    if why:
        raise ValueError(why)
    return row_differences(*_read_again(left, right, on, differing_ranges(left, right, on, columns, **limits)), columns)


def compare_digests(
    left: DataFrame, right: DataFrame, on: Sequence[str], columns: Sequence[str] | None = None, check_id: str = "compare_digests", **limits: int
) -> DataFrame:
    """Two verdicts, as of ``compare_rows``: each table, as a bag of rows, is contained in the other.

    ``on`` is the key by which the tables are cut; it need not be unique. ``observed_text`` says how many rows were read again. The levels run here.
    """
    columns = list(columns or left.columns)
    why = incomparable_columns(left, right, columns, None)
    if why:
        return failed_comparison(left, "compare_digests", columns, check_id, why)
    found = differing_ranges(left, right, on, columns, **limits)
    seen = bag_totals(*_read_again(left, right, on, found), columns).select(
        F.lit(found.left_rows).cast("bigint").alias("in_left"), F.lit(found.right_rows).cast("bigint").alias("in_right"), "only_left", "only_right"
    )
    again = F.lit(f"{found.held} of {found.left_rows + found.right_rows} rows compared, {len(found.ranges)} ranges of level {found.levels}")
    return rows(seen, bag_verdicts("compare_digests", columns, check_id, observed_text=again))
