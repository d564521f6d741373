"""SQL constraints: any query that must come back empty.

Queries that do no more than filter the table under test are found by their analysed plans, and all of them are
counted in one scan; any other query is counted by itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import columns as C
from plumbline.operators.verdict import local_rows
from plumbline.rules import ConstraintRule


#: What Spark calls a subquery that has no name.
UNNAMED = "__auto_generated_subquery_name"


def constraint_verdicts(df: DataFrame, rules: Sequence[ConstraintRule]) -> list[DataFrame]:
    """A frame of one verdict per rule; filters of the table share a scan.

    If that scan fails, as the condition of one of them does on some row, each is counted by itself.
    """
    shared = {r.check_id: c for r in rules if (c := filter_of(df, r.query)) is not None}
    counts: dict[str, int] = {}
    if len(shared) > 1:
        names = {f"c{i}": check_id for i, check_id in enumerate(shared)}
        try:
            seen = df.agg(*[C.count_where(shared[check_id]).alias(n) for n, check_id in names.items()]).first()
            counts = {check_id: seen[n] for n, check_id in names.items()}
        except PySparkException:
            counts = {}
    return [_counted(df, r, counts[r.check_id]) if r.check_id in counts else constraint_verdict(df, r) for r in rules]


def filter_of(df: DataFrame, query: str) -> Column | None:
    """The condition of a query whose rows are those of the table that meet it; None for any other query.

    Columns chosen and computed by the query change nothing about how many rows there are, as long as no
    condition refers to them. Conditions that name the table by an alias are left to the query itself.
    """
    if "{table}" not in query:
        return None
    view = f"table_under_test_{uuid.uuid4().hex}"
    try:
        plan = _viewed(df, query, view)._jdf.queryExecution().analyzed()
        if not plan.subqueriesAll().isEmpty():
            return None
        tests = []
        while plan.nodeName() != "View":
            if plan.nodeName() == "Filter" and plan.condition().deterministic():
                tests.append(plan.condition().sql())
            elif plan.nodeName() == "Project":
                chosen = plan.projectList()
                if tests and any(chosen.apply(i).nodeName() != "AttributeReference" for i in range(chosen.size())):
                    return None  # a condition above may refer to what is computed here
            elif plan.nodeName() != "SubqueryAlias":
                return None
            plan = plan.children().apply(0)
        if not plan.desc().identifier().table() == view:
            return None
        for name in (view, UNNAMED):  # names that occur nowhere else
            tests = [t.replace(f"{name}.", "") for t in tests]
        met = reduce(and_, [F.expr(t) for t in tests], F.lit(True))
        df.select(met)  # analysed here, not run
        return met
    except PySparkException:
        return None


def _viewed(df: DataFrame, query: str, view: str) -> DataFrame:
    df.createTempView(view)  # the name is only needed while the query is analysed
    try:
        return df.sparkSession.sql(query.replace("{table}", view))
    finally:
        df.sparkSession.catalog.dropTempView(view)


def _counted(df: DataFrame, rule: ConstraintRule, n: int) -> DataFrame:
    base = {"check_id": rule.check_id, "kind": rule.kind, "columns": ""}
    return local_rows(df.sparkSession, [{**base, "success": n == 0, "unexpected_count": n, "observed_num": float(n)}])


def constraint_verdict(df: DataFrame, rule: ConstraintRule) -> DataFrame:
    """A verdict row instead of an exception: one violated constraint must not lose the report.

    Nor must a query that cannot be analysed, say because a column is gone, or one that fails while
    it runs: it is counted here, and its verdict holds the reason.
    """
    base = {"check_id": rule.check_id, "kind": rule.kind, "columns": ""}
    try:
        n = _run(df, rule.query).count()
    except PySparkException as error:
        why = (error.getMessage() or str(error)).splitlines()[0]
        return local_rows(df.sparkSession, [{**base, "success": False, "observed_text": why}])
    return _counted(df, rule, n)


def _run(df: DataFrame, query: str) -> DataFrame:
    spark = df.sparkSession
    if "{table}" not in query:
        return spark.sql(query)
    return _viewed(df, query, f"table_under_test_{uuid.uuid4().hex}")
