"""Checks on distinct values and keys: one frequency table per column (or key) for all of them.

``groupBy(value).count()`` combines on the map side, so a value that holds a third of all
rows reaches the shuffle as one row per task. What every check asks of the table - counts, hits,
ties for the most common value - is then one aggregate over the distinct values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import columns as C
from plumbline.operators.members import ROW_JUDGES, member_count, with_members
from plumbline.operators.verdict import counted, judged, rows
from plumbline.rules import FrequencyRule


def key_names(columns: Sequence[str]) -> list[str]:
    return [f"k{i}" for i in range(len(columns))]


def frequency_table(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(k0, .., n): each distinct combination, nulls included, with its row count."""
    keys = [C.column(name).alias(k) for name, k in zip(names, key_names(names))]
    return df.select(*keys).groupBy(*key_names(names)).agg(F.count(F.lit(1)).alias("n"))


def frequency_verdicts(df: DataFrame, rules: Sequence[FrequencyRule], freq: DataFrame | None = None) -> DataFrame:
    """Verdicts of rules that share their columns and missing-value policy: one plan for all.

    ``freq`` is the columns' frequency table, if it is known already.
    """
    names, policy = rules[0].columns, rules[0].ignore_row_if
    keys = [F.col(k) for k in key_names(names)]
    freq = frequency_table(df, names) if freq is None else freq
    types = [df.schema[c].dataType for c in names]
    marks = {}
    for i, rule in enumerate(rules):
        if rule.members or rule.relation is not None or rule.judge in _SET_JUDGES:
            marks[rule.check_id] = f"m{i}"
            freq = with_members(freq, rule, types, key_names(names), f"m{i}")

    n, lost = F.col("n"), C.missing(keys, policy)
    kept = ~lost
    sums = {
        "elements": n,
        "missing": F.when(lost, n),
        "total": F.when(kept, n),
        "distinct": F.when(kept, 1),
        "repeated": F.when(kept & (n > 1), n),
    }
    tops = {}
    for rule in rules:
        mark = marks.get(rule.check_id)
        if mark:
            hit = kept & F.col(mark).isNotNull()
            sums[f"{mark}_hits"] = F.when(hit, 1)
            sums[f"{mark}_rows"] = F.when(hit, n)
        if rule.judge == "kl":
            q = F.col(mark)
            sums[f"{mark}_unseen"] = F.when(kept & (q.isNull() | (q <= 0)), 1)
            sums[f"{mark}_s"] = F.when(kept & (q > 0), n * F.ln(F.try_divide(n.cast("double"), q)))
        if rule.judge == "most_common":
            tops[f"{mark}_top"] = F.max(F.when(hit, n))
    if tops:
        # the first and last of the most frequent values: the same one unless there is a tie
        tops["top"] = F.max(F.when(kept, n))
        tops["first_mode"] = F.min(F.when(kept, F.struct((-n).alias("n"), keys[0].alias("v"))))["v"]
        tops["last_mode"] = F.max(F.when(kept, F.struct(n.alias("n"), keys[0].alias("v"))))["v"]
    one = freq.agg(
        *[F.coalesce(F.sum(v), F.lit(0)).alias(name) for name, v in sums.items()],
        *[v.alias(name) for name, v in tops.items()],
    )
    return rows(one, [judge_of(rule, marks.get(rule.check_id), types) for rule in rules])


_SET_JUDGES = {"distinct_in_set", "distinct_contains", "distinct_equals", "most_common", *ROW_JUDGES}


def judge_of(rule: FrequencyRule, mark: str | None, types: Sequence[T.DataType]) -> dict:
    elements, missing, total = F.col("elements"), F.col("missing"), F.col("total")
    distinct = F.col("distinct")
    base = {"element_count": elements, "missing_count": missing}
    hits = F.col(f"{mark}_hits") if mark else None
    if rule.judge == "distinct_in_set":
        return judged(rule, hits == distinct, observed_num=distinct, **base)
    if rule.judge == "distinct_contains":
        return judged(rule, hits == member_count(rule, types), observed_num=distinct, **base)
    if rule.judge == "distinct_equals":
        same = (hits == distinct) & (hits == member_count(rule, types))
        return judged(rule, same, observed_num=distinct, **base)
    if rule.judge == "most_common":
        success = F.col(f"{mark}_top") == F.col("top")
        if not rule.ties_okay:
            success = success & (F.col("first_mode") == F.col("last_mode"))
        return judged(rule, success, observed_text=F.col("first_mode"), **base)
    if rule.judge == "unique_proportion":
        share = F.try_divide(distinct.cast("double"), total)
        return judged(rule, C.in_range(share, T.DoubleType(), rule.low, rule.high), observed_num=share, **base)
    if rule.judge == "unique_count":
        return judged(rule, C.in_range(distinct, T.LongType(), rule.low, rule.high), observed_num=distinct, **base)
    if rule.judge == "unique":
        return counted(rule, rule.mostly, elements, missing, F.col("repeated"))
    if rule.judge == "rows_in_set":
        return counted(rule, rule.mostly, elements, missing, total - F.col(f"{mark}_rows"))
    if rule.judge == "rows_not_in_set":
        return counted(rule, rule.mostly, elements, missing, F.col(f"{mark}_rows"))
    if rule.judge == "kl":
        # sum p ln(p/q) with p = n/total; undefined as soon as one value had no expected weight
        divergence = F.when(
            (F.col(f"{mark}_unseen") == 0) & (total > 0),
            F.try_divide(F.col(f"{mark}_s"), total.cast("double")) - F.ln(total.cast("double")),
        )
        return judged(rule, divergence < F.lit(float(rule.high)), observed_num=divergence, **base)
    raise ValueError(f"unknown judge {rule.judge!r}")
