"""Exact quantiles that no single task has to hold.

Spark's exact ``percentile`` keeps every distinct value of the column in one buffer, which a
near-unique column at scale does not fit. Here a first pass brackets each wanted rank between
two values of an approximate grid, and a second pass counts exactly: all rows outside the
brackets collapse into one group per gap, so only the few values inside a bracket are shuffled.
When a bracket may still hold too many rows, further passes narrow it first.

Wide integers, decimals, dates and times are searched in their own type instead, see ``operators.radix``.

A sketch only ever chooses where to look. Every answer is read from exact counts, which also
tell whether the rank really lay inside its bracket; if not, the search repeats with wider ones.
"""

from __future__ import annotations

import bisect
import itertools
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import columns as C
from plumbline.functions.local import local_frame
from plumbline.operators.radix import Unsettled, is_wide, wide_quantiles
from plumbline.operators.sketches import quantiles_of, rank_error, sketch_and_count
from plumbline.operators.verdict import local_rows
from plumbline.rules import QuantileRule

GRID = 2000
SKETCH_SIZE = 8_000
# twice the error a sketch of that size stays below 99 times of 100, as a share of its rows
RANK_ERROR = 2 * rank_error(SKETCH_SIZE)
# most rows all brackets of a column may hold together before they are ranked in one group
BRACKET_LIMIT = 2_000_000
# brackets of so few rows need not get narrower, whatever the limit
FEW = 10_000
# rows looked at to see whether a column has few values, and how many values of them are few
PEEK, FEW_VALUES = 4096, 256
# up to so many counted values are ranked on the driver, without a sort of their own
FEW_GROUPS = 50_000


@dataclass
class _Bracket:
    """Closed value range believed to hold the sorted row number ``rank``."""

    rank: int
    low: float
    high: float
    rows: int  # how many rows it may hold, copies of its two ends aside


_Searches = dict[int, list[_Bracket]]  # by column number


@dataclass(frozen=True)
class ColumnQuantiles:
    rows: int
    present: int
    values: dict[float, object]  # numbers; dates and times as text; None without rows


def exact_quantiles(
    df: DataFrame, wanted: Mapping[str, Sequence[float]], bracket_limit: int = BRACKET_LIMIT
) -> dict[str, ColumnQuantiles]:
    """Interpolated quantiles per column, the same numbers as Spark's ``percentile``, and exact beyond 53 bits.

    Of dates and times, the first value that at least the wanted share of rows does not exceed. Columns of few values are
    counted value by value. For others, runs two jobs for all columns together, and one more per narrowing round; each round
    divides what is left of a column by about 150. What reaches the driver are a sketch per
    column, in later rounds per wanted quantile, and at most ``FEW_GROUPS`` counted values.
    """
    wide = {n: p for n, p in wanted.items() if is_wide(df.schema[n].dataType)}
    if wide:
        rows, found = wide_quantiles(df, wide)
        answers = {n: ColumnQuantiles(rows, present, values) for n, (present, values) in found.items()}
        others = {n: p for n, p in wanted.items() if n not in wide}
        return answers | (exact_quantiles(df, others, bracket_limit) if others else {})
    names = list(wanted)
    known = _by_counting(df, wanted)
    if known is not None:
        return known
    pruned = df.select(*[C.column(n).cast("double").alias(f"v{i}") for i, n in enumerate(names)])
    seen = _first_pass(pruned, len(names))
    searches: _Searches = {}
    for i, name in enumerate(names):
        present = seen[f"n{i}"]
        if present:
            ranks = {r for p in wanted[name] for r in _ranks(p, present)}
            searches[i] = _chosen(df.sparkSession, seen[f"g{i}"], 0, present, sorted(ranks), 1)
    found = _search(pruned, searches, bracket_limit, {i: seen[f"n{i}"] for i in searches})
    answers = {}
    for i, name in enumerate(names):
        present, nans = seen[f"n{i}"], seen[f"nan{i}"]
        values = {p: _interpolate(p, present, nans, found[i]) if present else None for p in wanted[name]}
        answers[name] = ColumnQuantiles(seen["rows"], present, values)
    return answers


def _by_counting(df: DataFrame, wanted: Mapping[str, Sequence[float]]) -> dict[str, ColumnQuantiles] | None:
    """The answers from all values' counts, for columns whose first rows hold few values; None if they hold many after all."""
    names = list(wanted)
    values = [C.column(n).cast("double").alias(f"v{i}") for i, n in enumerate(names)]
    first = df.select(*values).head(PEEK)
    if len(first) == PEEK and any(len({r[i] for r in first}) > FEW_VALUES for i in range(len(names))):
        return None
    plans = [df.groupBy(v.alias("value")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("column"), "value", "n") for i, v in enumerate(values)]
    union = plans[0]
    for plan in plans[1:]:
        union = union.unionByName(plan)
    counted = union.head(FEW_GROUPS + 1)
    if len(counted) > FEW_GROUPS:
        return None
    answers = {}
    for i, name in enumerate(names):
        own = [(r["value"], r["n"]) for r in counted if r["column"] == i]
        held = sorted((math.inf if math.isnan(v) else v, n) for v, n in own if v is not None)
        nans = sum(n for v, n in own if v is not None and math.isnan(v))
        upto = list(itertools.accumulate(n for _, n in held))
        present = upto[-1] if upto else 0
        at = {r: held[bisect.bisect_right(upto, r)][0] for p in wanted[name] for r in _ranks(p, present)} if present else {}
        answers[name] = ColumnQuantiles(sum(n for _, n in own), present, {p: _interpolate(p, present, nans, at) if present else None for p in wanted[name]})
    return answers


def _ranks(p: float, n: int) -> tuple[int, int]:
    position = p * (n - 1)
    return math.floor(position), math.ceil(position)


def _interpolate(p: float, n: int, nans: int, at: Mapping[int, float]) -> float:
    position = p * (n - 1)
    first, last = _ranks(p, n)
    # NaN sorts above every number; the searches see it as infinity
    low, high = (math.nan if r >= n - nans else at[r] for r in (first, last))
    if first == last or low == high:
        return low
    return (last - position) * low + (position - first) * high


def _ordered(i: int) -> Column:
    """Column ``i`` with NaN where it sorts: above everything else."""
    v = F.col(f"v{i}")
    return F.when(F.isnan(v), F.lit(math.inf)).otherwise(v)


def _counts_and_sketches(pruned: DataFrame, counts: dict[str, Column], sketched: dict[str, Column]) -> Row:
    return sketch_and_count(pruned, counts, sketched, SKETCH_SIZE).first()


def _chosen(spark: SparkSession, sketch: bytes, below: int, inside: int, ranks: Sequence[int], slack: int) -> list[_Bracket]:
    """Brackets of the ranks, from the few grid values they need; the sketch is read on the driver, without a job."""
    places = sorted({g for r in ranks for g in _span(below, inside, r, slack)})
    local = spark.createDataFrame(pa.table({"s": [bytes(sketch)]}))
    values = local.select(quantiles_of(F.col("s"), [g / GRID for g in places])).first()[0]
    grid = dict(zip(places, values))
    return [_choose(grid, below, inside, r, slack) for r in ranks]


def _first_pass(pruned: DataFrame, n: int) -> Row:
    counts = {"rows": F.count(F.lit(1))}
    for i in range(n):
        counts[f"n{i}"] = F.count(f"v{i}")
        counts[f"nan{i}"] = C.count_where(F.isnan(f"v{i}"))
    return _counts_and_sketches(pruned, counts, {f"g{i}": _ordered(i) for i in range(n)})


def _error(inside: int, slack: int) -> float:
    """Rows that a grid value may be off: the sketch's rank error, and a row for rounding."""
    return slack * (inside * RANK_ERROR + 1)


def _span(below: int, inside: int, rank: int, slack: int) -> tuple[int, int]:
    """Places of the ``GRID + 1`` evenly spaced quantiles that are sure to enclose the rank."""
    error = _error(inside, slack)
    left = max(math.floor((rank - below - error) / inside * GRID), 0)
    right = min(math.ceil((rank - below + 1 + error) / inside * GRID), GRID)
    return left, right


def _choose(grid: Mapping[int, float], below: int, inside: int, rank: int, slack: int = 1) -> _Bracket:
    """Smallest pair of grid values sure to enclose the wanted rank.

    The grid describes ``inside`` rows that follow ``below`` smaller ones.
    """
    error = _error(inside, slack)
    left, right = _span(below, inside, rank, slack)
    low = -math.inf if left == 0 else grid[left]
    high = math.inf if right == GRID else grid[right]
    held = inside * (right - left) / GRID + 2 * error
    return _Bracket(rank, low, high, math.ceil(min(held, inside)))


def _search(pruned: DataFrame, searches: _Searches, limit: int, present: Mapping[int, int]) -> dict[int, dict[int, float]]:
    """column -> {rank -> value}"""
    found: dict[int, dict[int, float]] = {i: {} for i in searches}
    slack = 1
    while searches:
        while any(_held(brackets) > limit for brackets in searches.values()):
            narrowed = _narrow(pruned, searches, slack)
            stuck = all(_held(narrowed[i]) >= _held(searches[i]) for i in searches)
            searches = narrowed
            if stuck:
                break
        if any(_held(brackets) > max(limit, FEW) for brackets in searches.values()):
            raise Unsettled("the brackets of the wanted ranks do not get narrower")
        for i, values in _rank(pruned, searches).items():
            found[i].update(values)
        # a rank outside its bracket: the sketch was further off than it should be, so trust it less and
        # begin again with the whole column, whose size is known
        missed = {i: [b.rank for b in brackets if b.rank not in found[i]] for i, brackets in searches.items()}
        searches = {i: [_Bracket(r, -math.inf, math.inf, present[i]) for r in ranks] for i, ranks in missed.items() if ranks}
        slack *= 8
        if searches and slack > 64:
            raise Unsettled("the table changes from one read to the next: stage it, then check it")
    return found


def _ends(brackets: Sequence[_Bracket]) -> list[tuple[float, float]]:
    return sorted({(b.low, b.high) for b in brackets})


def _held(brackets: Sequence[_Bracket]) -> int:
    return sum({(b.low, b.high): b.rows for b in brackets}.values())


def _narrow(pruned: DataFrame, searches: _Searches, slack: int) -> _Searches:
    """Count exactly below, on and between the ends of each bracket, and lay a new grid between.

    Rows equal to an end are counted apart, so a value that repeats without bound settles at
    an end and stops counting as unresolved.
    """
    counts, grids = {}, {}
    for i, brackets in searches.items():
        v = _ordered(i)
        for j, (low, high) in enumerate(_ends(brackets)):
            between = (v > low) & (v < high)
            counts[f"below{i}_{j}"] = C.count_where(v < low)
            counts[f"low{i}_{j}"] = C.count_where(v == low)
            counts[f"open{i}_{j}"] = C.count_where(between)
            grids[f"g{i}_{j}"] = F.when(between, v)
    seen = _counts_and_sketches(pruned, counts, grids)
    out: _Searches = {}
    for i, brackets in searches.items():
        out[i] = []
        for b in brackets:
            j = _ends(brackets).index((b.low, b.high))
            start = seen[f"below{i}_{j}"] + seen[f"low{i}_{j}"]  # first row of the open part
            inside = seen[f"open{i}_{j}"]
            if b.rank < start:
                out[i].append(_Bracket(b.rank, b.low, b.low, 0))
            elif b.rank >= start + inside:
                out[i].append(_Bracket(b.rank, b.high, b.high, 0))
            else:
                closer = _chosen(pruned.sparkSession, seen[f"g{i}_{j}"], start, inside, [b.rank], slack)[0]
                closer.low, closer.high = max(closer.low, b.low), min(closer.high, b.high)
                out[i].append(closer)
    return out


def _rank(pruned: DataFrame, searches: _Searches) -> dict[int, dict[int, float]]:
    """Exact values at the wanted ranks, as far as the brackets hold them."""
    plans = []
    for i, brackets in searches.items():
        v = _ordered(i)
        spans = _merge([(b.low, b.high) for b in brackets])
        # odd regions are brackets, even ones the gaps between them
        region = F.lit(0)
        value = F.lit(None).cast("double")
        for s, (low, high) in enumerate(spans):  # in ascending order
            region = F.when(v > high, 2 * s + 2).when(v >= low, 2 * s + 1).otherwise(region)
            value = F.when((v >= low) & (v <= high), v).otherwise(value)
        counts = (
            pruned.filter(F.col(f"v{i}").isNotNull())
            .select(region.alias("region"), value.alias("value"))
            .groupBy("region", "value")
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("column", F.lit(i))
        )
        plans.append(counts)
    union = plans[0]
    for plan in plans[1:]:
        union = union.unionByName(plan)
    if sum(map(_held, searches.values())) <= FEW_GROUPS:
        return _rank_here(union, searches)
    running = F.sum("n").over(
        Window.partitionBy("column").orderBy("region", "value").rowsBetween(Window.unboundedPreceding, 0)
    )
    ranked = union.withColumn("upto", running)
    wanted = sorted({b.rank for brackets in searches.values() for b in brackets})
    # the first row whose running count passes a rank holds that rank; a gap holds no value
    hits = ranked.groupBy("column").agg(
        *[F.min_by("value", F.when(F.col("upto") > r, F.col("upto"))).alias(f"r{r}") for r in wanted]
    )
    found: dict[int, dict[int, float]] = {i: {} for i in searches}
    for row in hits.collect():
        i = row["column"]
        found[i] = {b.rank: row[f"r{b.rank}"] for b in searches[i] if row[f"r{b.rank}"] is not None}
    return found


def _rank_here(counts: DataFrame, searches: _Searches) -> dict[int, dict[int, float]]:
    """The same on the driver, for a few counted values."""
    groups: dict[int, list[tuple]] = {i: [] for i in searches}
    for r in counts.collect():
        groups[r["column"]].append((r["region"], r["value"], r["n"]))
    found: dict[int, dict[int, float]] = {i: {} for i in searches}
    for i, held in groups.items():
        held.sort(key=lambda g: (g[0], -math.inf if g[1] is None else g[1]))
        upto = list(itertools.accumulate(n for *_, n in held))
        for b in searches[i]:
            at = bisect.bisect_right(upto, b.rank)
            if at < len(held) and held[at][1] is not None:
                found[i][b.rank] = held[at][1]
    return found


def _merge(spans: list[tuple[float, float]]) -> list[tuple[float, float]]:
    merged: list[tuple[float, float]] = []
    for low, high in sorted(spans):
        if merged and low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], high))
        else:
            merged.append((low, high))
    return merged


def quantile_verdicts(df: DataFrame, rules: Sequence[QuantileRule]) -> DataFrame:
    wanted: dict[str, list[float]] = {}
    for rule in rules:
        wanted.setdefault(rule.columns[0], [])
        wanted[rule.columns[0]] += [p for p in rule.probabilities if p not in wanted[rule.columns[0]]]
    try:
        answers = exact_quantiles(df, wanted)
    except Unsettled as why:
        return local_rows(
            df.sparkSession,
            [
                {"check_id": r.check_id, "kind": r.kind, "columns": r.columns[0], "success": False, "observed_text": str(why)}
                for r in rules
            ],
        )
    records = []
    for rule in rules:
        answer, dtype = answers[rule.columns[0]], df.schema[rule.columns[0]].dataType
        values = [answer.values[p] for p in rule.probabilities]
        number = len(values) == 1 and C.is_numeric(dtype) and values[0] is not None
        inside = _moments_inside(df.sparkSession, values, rule.ranges, dtype) if C.is_temporal(dtype) else [_inside(v, *b) for v, b in zip(values, rule.ranges)]
        records.append(
            {
                "check_id": rule.check_id, "kind": rule.kind, "columns": rule.columns[0],
                "success": all(inside),
                "element_count": answer.rows, "missing_count": answer.rows - answer.present,
                "observed_num": float(values[0]) if number else None,
                "observed_text": ",".join("null" if v is None else str(v) for v in values),
            }
        )
    return local_rows(df.sparkSession, records)


def _inside(value: object, low: object, high: object) -> bool:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return False
    return (low is None or _exact(value) >= _exact(low)) and (high is None or _exact(value) <= _exact(high))


def _exact(value: object) -> object:
    """A number as it compares without rounding."""
    return value if isinstance(value, float) and not math.isfinite(value) else Fraction(value)


def _moments_inside(spark: SparkSession, values: Sequence[str | None], ranges: Sequence[tuple], dtype: T.DataType) -> list[bool]:
    """The same for dates and times, by Spark's own comparison on one local row."""
    tests = [F.lit(v).cast(dtype).isNotNull() if low is None and high is None else C.in_range(F.lit(v).cast(dtype), dtype, low, high) for v, (low, high) in zip(values, ranges)]
    return [bool(t) for t in spark.range(1).select(*[F.coalesce(t, F.lit(False)).alias(f"t{i}") for i, t in enumerate(tests)]).first()]


def quantile_table(df: DataFrame, name: str, probabilities: Sequence[float]) -> DataFrame:
    """(quantile, value) rows: the exact quantiles of one column of numbers, as floating-point numbers."""
    answer = exact_quantiles(df, {name: probabilities})[name]
    rows = [(float(p), None if answer.values[p] is None else float(answer.values[p])) for p in probabilities]
    return local_frame(df.sparkSession, {"quantile": "double", "value": "double"}, rows)
