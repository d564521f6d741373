"""Row predicates, membership in sets and plain aggregates: one scan, one aggregate.

The rules become columns of a single global aggregate. Each task reads its split once, keeps
one buffer row, and one row per task is shuffled.

Spark stops compiling an operator of more than 100 fields (``spark.sql.codegen.maxFields``),
which costs more than a second pass. So a very long list of rules is sorted by column and cut
into aggregates below that width; each reads its own columns, so little is read twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import columns as C
from plumbline.operators.members import set_key, with_members
from plumbline.operators.verdict import Evidence, counted, judged, rows, text_sql
from plumbline.rules import AggregateRule, FrequencyRule, Rule, RowRule

# safely below spark.sql.codegen.maxFields
BUFFER_FIELDS = 90
OVERFLOW = "beyond 38 digits"


def kept(rule: RowRule | FrequencyRule) -> Column:
    """The rows a rule looks at."""
    return ~C.missing([C.column(name) for name in rule.columns], rule.ignore_row_if)


def failed(rule: RowRule, schema: T.StructType) -> Column:
    """True for the rows that break a row rule; false or null for all others."""
    cols = [C.column(name) for name in rule.columns]
    holds = rule.holds(cols, [schema[name].dataType for name in rule.columns])
    if len(cols) == 1 and not rule.subject_is_null:
        # one column: the predicate is null exactly where the row is not evaluated
        return ~holds
    return kept(rule) & ~F.coalesce(holds, F.lit(False))


# evidence of one check, or how to make it once the aggregates' types are known
Outcome = dict[str, Evidence] | Callable[[T.StructType], dict[str, Evidence]]


class _Aggregates:
    """Collects aggregates, SQL text or columns, each once, under short names."""

    def __init__(self) -> None:
        self.named: dict[object, Evidence] = {}
        self.order: dict[object, str] = {}

    def add(self, key: object, make: Callable[[], Evidence]) -> str:
        if key not in self.order:
            self.order[key] = f"a{len(self.order)}"
            self.named[key] = make()
        return self.order[key]

    def over(self, df: DataFrame) -> DataFrame:
        """One row of all of them."""
        texts = ", ".join(f"'{self.order[k]}', {v}" for k, v in self.named.items() if isinstance(v, str))
        built = [v.alias(self.order[k]) for k, v in self.named.items() if not isinstance(v, str)]
        one = df.agg(F.expr(f"named_struct({texts})").alias("texts"), *built)
        return one.select("texts.*", *[self.order[k] for k, v in self.named.items() if not isinstance(v, str)])


def fused_verdicts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    apart = [r for r in rules if isinstance(r, AggregateRule) and r.apart]
    together = [r for r in rules if r not in apart]
    parts = [_one_aggregate(df, pack) for group in (together, apart) if group for pack in packs(group)]
    return reduce(DataFrame.unionByName, parts)


def packs(rules: Sequence[Rule], limit: int = BUFFER_FIELDS) -> list[list[Rule]]:
    """All rules together if one aggregate can hold them; else by column, as many as fit."""
    if _width(rules) <= limit:
        return [list(rules)]
    out: list[list[Rule]] = [[]]
    for rule in sorted(rules, key=lambda r: r.columns):
        if out[-1] and _width([*out[-1], rule]) > limit:
            out.append([])
        out[-1].append(rule)
    return out


def _width(rules: Sequence[Rule]) -> int:
    """Buffer fields: the row count, one count per column set, and each rule's own."""
    own = sum(3 if isinstance(r, AggregateRule) and r.measure else 1 for r in rules)
    return 1 + len({r.columns for r in rules}) + own


def _one_aggregate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    df, aggs, out = planned(df, rules)
    return outcomes_of(aggs.over(df), out)


def outcomes_of(seen: DataFrame, out: Sequence[Outcome]) -> DataFrame:
    """Verdicts from the one row of aggregates."""
    return rows(seen, [outcome(seen.schema) if callable(outcome) else outcome for outcome in out])


def planned(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, _Aggregates, list[Outcome]]:
    """The frame (with the sets the rules need joined to it), its aggregates, and what each rule makes of them."""
    schema, aggs = df.schema, _Aggregates()
    total = aggs.add("rows", lambda: "count(1)")
    out, marks = [], {}
    for i, rule in enumerate(rules):
        if isinstance(rule, FrequencyRule):
            # membership in a set too long for a literal list, but small enough for every executor
            mark = marks.get(set_key(rule))
            if mark is None:
                mark = marks[set_key(rule)] = f"plumbline_member_{i}"
                types = [schema[c].dataType for c in rule.columns]
                df = with_members(df, rule, types, rule.columns, mark, broadcast=True)
            out.append(_member_verdict(rule, mark, aggs, total))
        elif isinstance(rule, RowRule):
            out.append(_row_verdict(rule, i, schema, aggs, total))
        else:
            out.append(_aggregate_verdict(rule, schema, aggs, total))
    return df, aggs, out


def _nulls(name: str, aggs: _Aggregates, total: str) -> str:
    return f"({total} - {aggs.add(('present', name), lambda: f'count({C.quoted(name)})')})"


def _failures(rule: RowRule, schema: T.StructType) -> Evidence:
    """How many rows break a row rule."""
    if rule.text is not None:
        holds = rule.text(C.quoted(rule.columns[0]), schema[rule.columns[0]].dataType)
        if holds is not None:
            return f"count(CASE WHEN NOT ({holds}) THEN 1 END)"
    return C.count_where(failed(rule, schema))


def _row_verdict(rule: RowRule, i: int, schema: T.StructType, aggs: _Aggregates, total: str) -> dict:
    bad = aggs.add(("failed", i), lambda: _failures(rule, schema))
    if rule.subject_is_null:
        return counted(rule, rule.mostly, total, "0", bad, missing=_nulls(rule.columns[0], aggs, total))
    return counted(rule, rule.mostly, total, _ignored(rule, aggs, total), bad)


def _ignored(rule: RowRule | FrequencyRule, aggs: _Aggregates, total: str) -> str:
    if rule.ignore_row_if == "never":
        return "0"
    if len(rule.columns) == 1:
        return _nulls(rule.columns[0], aggs, total)
    return f"({total} - {aggs.add(('kept', rule.columns, rule.ignore_row_if), lambda: C.count_where(kept(rule)))})"


def _member_verdict(rule: FrequencyRule, mark: str, aggs: _Aggregates, total: str) -> dict:
    inside = F.col(mark).isNotNull()
    wrong = inside if rule.judge == "rows_not_in_set" else ~inside
    bad = aggs.add(("wrong", mark, rule.judge, rule.ignore_row_if), lambda: C.count_where(kept(rule) & wrong))
    return counted(rule, rule.mostly, total, _ignored(rule, aggs, total), bad)


def _passed(seen: str, dtype: T.DataType, rule: AggregateRule) -> Evidence:
    return C.range_sql(seen, dtype, rule.low, rule.high) or C.in_range(F.col(seen), dtype, rule.low, rule.high)


def _aggregate_verdict(rule: AggregateRule, schema: T.StructType, aggs: _Aggregates, total: str) -> Outcome:
    if rule.measure is None:
        return judged(rule, _passed(total, T.LongType(), rule), element_count=total, observed_num=total)
    name, dtype = rule.columns[0], schema[rule.columns[0]].dataType
    measured = lambda: f"{rule.function}({C.quoted(name)})" if rule.function else rule.measure(C.column(name), dtype)
    seen = aggs.add((rule.kind, name), measured)
    nulls = _nulls(name, aggs, total)

    def finish(types: T.StructType) -> dict:
        seen_type = types[seen].dataType
        evidence = {"observed_num" if C.is_numeric(seen_type) else "observed_text": seen}
        if isinstance(seen_type, (T.IntegralType, T.DecimalType)):
            # all its digits; no number although there are values is an overflow
            evidence["observed_text"] = f"CASE WHEN {seen} IS NULL AND {nulls} < {total} THEN {text_sql(OVERFLOW)} ELSE CAST({seen} AS STRING) END"
        return judged(rule, _passed(seen, seen_type, rule), element_count=total, missing_count=nulls, **evidence)

    return finish
