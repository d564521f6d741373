"""Validation of a table that grows by slices: only new slices are read.

What a check needs of a slice is kept as a mergeable state: counts, sums, extremes, moments, sketches, and
frequency tables of columns whose values are counted. A run computes the states of the slices it does not
know, in one pass per kind of state, appends them to tables under a folder, and merges the states of all slices that the table has now
into the verdicts of the whole table. A slice counts as known once its row in the table of slices is written, which
comes last; states of a run that broke off are never read.

Exact quantiles, constraints and approximate distinct counts have no such state: they read the whole table.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import columns as C
from plumbline.functions.local import local_frame
from plumbline.operators.frequency import frequency_verdicts, key_names
from plumbline.operators.fused import outcomes_of, packs, planned
from plumbline.operators.sketches import ANSWER_SIZE, SLICES, sketched_verdicts, wanted_columns
from plumbline.plans.suite import Suite
from plumbline.rules import AggregateRule, FrequencyRule, QuantileRule, RowRule, Rule

MEAN, STDEV = "expect_column_mean_to_be_between", "expect_column_stdev_to_be_between"


def verdicts_by_slice(suite: Suite, df: DataFrame, by: str, folder: str, refresh: Iterable[object] = ()) -> DataFrame:
    """Verdicts of the suite over the whole table, as ``suite.verdicts``; sums and means of floating-point numbers up to rounding.

    ``by`` is the column whose values are the slices, best the one the table is partitioned by. ``refresh`` names
    slices to read again because their rows have changed. Slices that the table no longer has are left out. The states belong to the
    suite's rules and the columns' types: a suite that differs begins anew in the same folder.
    """
    rules, _ = suite._fitting(df)
    kept = [r for r in rules if _mergeable(r)]
    mark = hashlib.sha256(json.dumps([by, df.schema.json(), [(r.check_id, r.kind, r.columns, r.config) for r in kept]]).encode()).hexdigest()[:16]
    states = _States(df, by, f"{folder.rstrip('/')}/{mark}", kept)
    states.update({None if v is None else str(v) for v in refresh})
    others = {r.check_id for r in kept}
    rest = Suite([r for r in suite.rules if r.check_id not in others])
    out = rest.verdicts(df)
    for part in states.verdicts():
        out = out.unionByName(part)
    return out


def _mergeable(rule: Rule) -> bool:
    if isinstance(rule, QuantileRule):
        return rule.approx
    return isinstance(rule, (RowRule, FrequencyRule)) or (isinstance(rule, AggregateRule) and not rule.apart)


def _read(df: DataFrame, path: str) -> DataFrame | None:
    """A table of states, or None if none was written yet."""
    try:
        return df.sparkSession.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


class _States:
    """The states of a table's slices for some rules."""

    def __init__(self, df: DataFrame, by: str, folder: str, rules: Sequence[Rule]) -> None:
        self.df, self.by, self.folder = df, by, folder
        fused = [r for r in rules if isinstance(r, (RowRule, AggregateRule))]
        self.packs = packs(fused) if fused else []
        self.sketched = [r for r in rules if isinstance(r, QuantileRule)]
        groups: dict[tuple, list[FrequencyRule]] = {}
        for r in rules:
            if isinstance(r, FrequencyRule):
                groups.setdefault(r.columns, []).append(r)
        self.groups = groups
        self.slice = C.column(by).cast("string").alias("slice")

    def update(self, refresh: set[str | None]) -> None:
        """Compute and store the states of slices that have none."""
        # a row per slice; of a partition column, without reading a file
        present = {r["slice"]: r["value"] for r in self.df.select(self.slice, C.column(self.by).alias("value")).distinct().collect()}
        known = _read(self.df, f"{self.folder}/slices")
        stored = {r["slice"] for r in known.select("slice").distinct().collect()} if known is not None else set()
        new = [s for s in present if s not in stored or s in refresh]
        if new:
            run = uuid.uuid4().hex
            self._store(self._rows_of({s: present[s] for s in new}), run)
            place = 1 + (known.agg(F.max("place")).first()[0] if known is not None else 0)
            rows = local_frame(self.df.sparkSession, {"slice": "string", "run": "string", "place": "bigint"}, [(s, run, place) for s in new])
            rows.coalesce(1).write.mode("append").parquet(f"{self.folder}/slices")
        self.present = local_frame(self.df.sparkSession, {"slice": "string"}, [(s,) for s in present])

    def _rows_of(self, slices: dict[str | None, object]) -> DataFrame:
        c = C.column(self.by)
        tests = [c.isin([F.lit(v) for v in slices.values() if v is not None])] if set(slices) - {None} else []
        if any(isinstance(v, float) for v in slices.values()):
            tests = [C.column(self.by).cast("string").isin([s for s in slices if s is not None])]
        return self.df.filter(C.any_of([*tests, *([c.isNull()] if None in slices else [])]))

    def _store(self, rows: DataFrame, run: str) -> None:
        def append(states: DataFrame, name: str) -> None:
            states.withColumn("run", F.lit(run)).write.mode("append").parquet(f"{self.folder}/{name}")

        for i, rules in enumerate(self.packs):
            parts = [p for part in self._parts(rules) for p in part[1]]
            append(rows.groupBy(self.slice).agg(*[column.alias(n) for n, column in parts]), f"aggregates-{i}")
        if self.sketched:
            _, counts, ordered = wanted_columns(self.sketched)
            tasks = F.pmod(F.spark_partition_id(), F.lit(SLICES)).alias("task")
            partial = rows.groupBy(self.slice, tasks).agg(*[c.alias(n) for n, c in counts.items()], *[F.kll_sketch_agg_double(v, F.lit(ANSWER_SIZE)).alias(n) for n, v in ordered.items()])
            append(partial.groupBy("slice").agg(*[F.sum(n).alias(n) for n in counts], *[F.kll_merge_agg_double(n).alias(n) for n in ordered]), "sketches")
        for i, names in enumerate(self.groups):
            keys = [C.column(n).alias(k) for n, k in zip(names, key_names(names))]
            append(rows.select(self.slice, *keys).groupBy("slice", *key_names(names)).agg(F.count(F.lit(1)).alias("n")), f"frequencies-{i}")

    def _parts(self, rules: Sequence[Rule]) -> list[tuple[str, list[tuple[str, Column]], Column]]:
        """For each aggregate of the rules: its name, what is stored of a slice, and how that merges."""
        _, aggs, _ = planned(self.df, rules)
        out = []
        for key, name in aggs.order.items():
            kind, column = key if isinstance(key, tuple) and len(key) == 2 else (key, None)
            own = aggs.named[key]
            own = F.expr(own) if isinstance(own, str) else own
            if kind == MEAN:
                c, result = C.column(column), self.df.agg(own).schema[0].dataType
                total = F.try_sum(c) if isinstance(result, T.DecimalType) else F.sum(c.cast("double"))
                merged = F.try_divide(F.try_sum(f"{name}_sum"), F.sum(f"{name}_n")).cast(result)
                out.append((name, [(f"{name}_sum", total), (f"{name}_n", F.count(c))], merged))
            elif kind == STDEV:
                c = C.column(column).cast("double")
                parts = [(f"{name}_n", F.count(c)), (f"{name}_mean", F.avg(c)), (f"{name}_m2", F.var_pop(c) * F.count(c))]
                out.append((name, parts, _merged_deviation(name)))
            else:
                merge = F.max(name) if kind == "expect_column_max_to_be_between" else F.min(name) if kind == "expect_column_min_to_be_between" else F.try_sum(name)
                if kind not in ("expect_column_max_to_be_between", "expect_column_min_to_be_between", "expect_column_sum_to_be_between"):
                    merge = F.coalesce(merge, F.lit(0))  # a count
                out.append((name, [(name, own)], merge))
        return out

    def _current(self, name: str) -> DataFrame | None:
        """The states of the table's slices, each from the latest run that stored it."""
        states, slices = _read(self.df, f"{self.folder}/{name}"), _read(self.df, f"{self.folder}/slices")
        if states is None or slices is None:
            return None
        latest = slices.groupBy("slice").agg(F.max_by("run", "place").alias("run"))
        shown = latest.join(self.present, latest["slice"].eqNullSafe(self.present["slice"]), "left_semi")
        s, l = states.alias("s"), F.broadcast(shown.alias("l"))  # a row per slice
        return s.join(l, F.col("s.slice").eqNullSafe(F.col("l.slice")) & (F.col("s.run") == F.col("l.run"))).select("s.*")

    def verdicts(self) -> list[DataFrame]:
        out = []
        for i, rules in enumerate(self.packs):
            parts, (_, aggs, outcomes) = self._parts(rules), planned(self.df, rules)
            states = self._current(f"aggregates-{i}")
            if states is None:  # a table without rows has no slices
                out.append(outcomes_of(aggs.over(self.df.limit(0)), outcomes))
            else:
                wanted = aggs.over(self.df).schema
                merged = states.agg(*[merge.alias(name) for name, _, merge in parts])
                out.append(outcomes_of(merged.select(*[F.col(f.name).cast(f.dataType) for f in wanted]), outcomes))
        if self.sketched:
            states = self._current("sketches")
            _, counts, ordered = wanted_columns(self.sketched)
            if states is None:
                out.append(Suite(self.sketched).verdicts(self.df.limit(0)))
            else:
                merged = states.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counts], *[F.kll_merge_agg_double(n).alias(n) for n in ordered])
                some = merged.select(*counts, *[F.when(F.kll_sketch_get_n_double(F.col(n)) > 0, F.col(n)).alias(n) for n in ordered])
                out.append(sketched_verdicts(some, self.sketched))
        for i, (names, rules) in enumerate(self.groups.items()):
            states = self._current(f"frequencies-{i}")
            freq = None if states is None else states.groupBy(*key_names(names)).agg(F.sum("n").alias("n"))
            for policy in dict.fromkeys(r.ignore_row_if for r in rules):
                own = [r for r in rules if r.ignore_row_if == policy]
                out.append(frequency_verdicts(self.df.limit(0) if freq is None else self.df, own, freq))
        return out


def _merged_deviation(name: str) -> Column:
    """Sample deviation of all slices from each one's rows, mean and squared deviations: a list of one entry per slice."""
    some = F.filter(F.collect_list(F.struct(F.col(f"{name}_n").alias("n"), F.col(f"{name}_mean").alias("mean"), F.col(f"{name}_m2").alias("m2"))), lambda s: s.n > 0)
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def add(a: Column, b: Column) -> Column:
        n = a.n + b.n
        gap = b.mean - a.mean
        return F.struct(n.alias("n"), (a.mean + gap * b.n / n).alias("mean"), (a.m2 + b.m2 + gap * gap * a.n * b.n / n).alias("m2"))

    return F.aggregate(some, zero, add, lambda s: F.when(s.n > 1, F.sqrt(s.m2 / (s.n - 1))))
