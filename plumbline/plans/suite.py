"""Suites: many rules over one table, in as few Spark plans as their kinds allow.

===========================  ==================================================
rules                        plan
===========================  ==================================================
row, aggregate, row count,   one global aggregate for all of them: one scan, one
membership in a set          exchange of one row per task
approximate quantiles        one sketch per column, one scan for all of them
frequency, key, membership   one frequency table per column (or key) for all of
in a very large set          its checks
uniqueness, few repeats      a counting filter: two jobs, see ``operators.uniqueness``
membership in a large table, a bit map of the members at the scan, the
few members                  frequency table of what passes
exact quantiles              two or more small jobs, see ``operators.quantiles``
schema                       no job
SQL constraints              filters of the table: one scan for all; others as
                             written, one count each
===========================  ==================================================
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterable, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.local import local_frame
from plumbline.operators.constraints import constraint_verdicts
from plumbline.operators.evidence import TOP, failing_values
from plumbline.operators.frequency import frequency_verdicts
from plumbline.operators.fused import fused_verdicts
from plumbline.operators.members import broadcastable
from plumbline.operators.quantiles import quantile_verdicts
from plumbline.operators.schema import schema_verdicts
from plumbline.operators.setfilter import filtered_sets, set_filter_verdicts
from plumbline.operators.sketches import sketch_verdicts
from plumbline.operators.uniqueness import filtered, unique_verdicts
from plumbline.operators.verdict import local_rows
from plumbline.rules import ConstraintRule, FrequencyRule, QuantileRule, RowRule, Rule, SchemaRule
from plumbline.sources.report import write_report
from plumbline.sources.tables import staged


class Suite:
    """An ordered collection of rules with unique check ids."""

    def __init__(self, rules: Iterable[Rule]) -> None:
        self.rules = _with_ids(list(rules))

    def applicable(self, df: DataFrame) -> list[Rule]:
        """Rules whose columns the table has, by exact name. Schema rules always apply."""
        present = set(df.columns)
        return [r for r in self.rules if isinstance(r, SchemaRule) or present.issuperset(r.columns)]

    def skipped(self, df: DataFrame) -> DataFrame:
        """(check_id, kind, missing_columns) of the rules left out because a column is absent."""
        run = {r.check_id for r in self.applicable(df)}
        return local_frame(
            df.sparkSession,
            {"check_id": "string", "kind": "string", "missing_columns": "string"},
            [
                (r.check_id, r.kind, ",".join(c for c in r.columns if c not in df.columns))
                for r in self.rules
                if r.check_id not in run
            ],
        )

    def configs(self, df: DataFrame) -> DataFrame:
        """(check_id, kwargs) of all rules: the arguments each was declared with, as JSON."""
        return local_frame(df.sparkSession, {"check_id": "string", "kwargs": "string"}, [(r.check_id, r.config) for r in self.rules])

    def write_report(self, df: DataFrame, path: str, mode: str = "errorifexists", top: int | None = TOP) -> None:
        """Run all checks and write the whole report: verdicts, thresholds, failing values, skipped checks."""
        write_report(self.verdicts(df), path, mode, self.configs(df), self.skipped(df), self.failing_values(df, top=top))

    def verdicts(self, df: DataFrame, stage: bool | str = False) -> DataFrame:
        """One row per applicable rule.

        Lazy, except that exact quantiles and counting filters run their searches and constraints their counts here. With ``stage`` the needed
        columns are first written to the shared folder (or the path given as ``stage``), for a
        source that is expensive to compute and would otherwise be computed once per plan. What is
        staged stays until ``remove_staged``; ``staged_table`` removes it by itself.
        """
        rules, unfit = self._fitting(df)
        _check_patterns(df, rules)
        schema_rules = [r for r in rules if isinstance(r, SchemaRule)]
        parts = []
        if schema_rules:
            parts.append(schema_verdicts(df, schema_rules))
        if unfit:
            parts.append(_misfits(df, unfit))
        if stage:
            constrained = any(isinstance(r, ConstraintRule) for r in rules)
            read = {c for r in rules if not isinstance(r, SchemaRule) for c in r.columns}
            df = staged(df, df.columns if constrained else [c for c in df.columns if c in read], stage if isinstance(stage, str) else None)
        exact = [r for r in rules if isinstance(r, QuantileRule) and not r.approx]
        joined = broadcastable([r for r in rules if isinstance(r, FrequencyRule)], df.schema)
        counted = [r for r in rules if isinstance(r, FrequencyRule) and r.check_id not in joined]
        through_filter = filtered_sets(counted)
        frequency = [r for r in counted if not (r.few_members and r.relation is not None)]
        constraints = [r for r in rules if isinstance(r, ConstraintRule)]
        sketched = [r for r in rules if isinstance(r, QuantileRule) and r.approx]
        apart = {r.check_id for r in (*schema_rules, *exact, *sketched, *counted, *constraints)}
        fused = [r for r in rules if r.check_id not in apart]
        if fused:
            parts.append(fused_verdicts(df, fused))
        if sketched:
            parts.append(sketch_verdicts(df, sketched))
        if exact:
            parts.append(quantile_verdicts(df, exact))
        shared: dict[tuple, list[FrequencyRule]] = {}
        for rule in frequency:
            shared.setdefault((rule.columns, rule.ignore_row_if), []).append(rule)
        parts += [(unique_verdicts if filtered(df, group) else frequency_verdicts)(df, group) for group in shared.values()]
        parts += [set_filter_verdicts(df, rule) for rule in through_filter]
        parts += constraint_verdicts(df, constraints)
        if not parts:
            return local_rows(df.sparkSession, [])
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def failing_values(self, df: DataFrame, check_ids: Iterable[str] | None = None, top: int | None = TOP) -> DataFrame:
        """(check_id, value, n, distinct_values, failing_rows): the ``top`` most frequent offending values of each
        check (all, if None), and how many values and rows offend in all."""
        rules, _ = self._fitting(df)
        _check_patterns(df, rules)
        wanted = None if check_ids is None else set(check_ids)
        return failing_values(df, [r for r in rules if wanted is None or r.check_id in wanted], top)

    def _fitting(self, df: DataFrame) -> tuple[list[Rule], list[tuple[Rule, str]]]:
        """Applicable rules, and apart from them those that make no sense on the columns' types."""
        fit, unfit = [], []
        for rule in self.applicable(df):
            known = isinstance(rule, SchemaRule)
            why = None if known else rule.misfit([df.schema[c].dataType for c in rule.columns])
            if why:
                unfit.append((rule, why))
            else:
                fit.append(rule)
        return fit, unfit


def _with_ids(rules: list[Rule]) -> list[Rule]:
    used = {r.check_id for r in rules if r.check_id is not None}
    if len(used) != sum(r.check_id is not None for r in rules):
        raise ValueError("check ids must be unique")
    out = []
    for rule in rules:
        if rule.check_id is None:
            base = f"{rule.kind}({','.join(rule.columns)})"
            name, i = base, 1
            while name in used:
                i += 1
                name = f"{base}#{i}"
            used.add(name)
            rule = dataclasses.replace(rule, check_id=name)
        out.append(rule)
    return out


def _misfits(df: DataFrame, unfit: Sequence[tuple[Rule, str]]) -> DataFrame:
    """They fail with the reason; the other checks still run."""
    return local_rows(
        df.sparkSession,
        [
            {"check_id": r.check_id, "kind": r.kind, "columns": ",".join(r.columns), "success": False,
             "observed_text": why}
            for r, why in unfit
        ],
    )


def _check_patterns(df: DataFrame, rules: Sequence[Rule]) -> None:
    """A malformed regex passes analysis and would only abort the job halfway: try them all now."""
    patterns = sorted({p for r in rules if isinstance(r, RowRule) for p in r.patterns})
    if not patterns:
        return
    # on a local row: the optimiser evaluates it, no job runs
    probe = local_frame(df.sparkSession, {"text": "string"}, [[""]]).select(*[F.col("text").rlike(p) for p in patterns])
    try:
        probe.collect()
    except PySparkException as error:
        bad = patterns
        if len(patterns) > 1:  # which one?
            for pattern in patterns:
                try:
                    probe.sparkSession.range(1).select(F.lit("").rlike(pattern)).collect()
                except PySparkException:
                    bad = [pattern]
                    break
        raise ValueError(f"not a valid regular expression: {bad[0]!r}") from error
