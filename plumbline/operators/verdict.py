"""The verdict row every operator returns, and the arithmetic on it."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.local import local_frame
from plumbline.rules import Rule

# field -> type; every operator emits exactly these, so verdicts of any origin can be unioned
FIELDS = {
    "check_id": "string",
    "kind": "string",
    "columns": "string",
    "success": "boolean",
    "element_count": "bigint",
    "missing_count": "bigint",
    "unexpected_count": "bigint",
    "unexpected_percent": "double",
    "observed_num": "double",
    "observed_text": "string",
}

# What a check hands over; success and percentage of counting checks follow from it in ``rows``.
_EVIDENCE = {
    "check_id": "string",
    "kind": "string",
    "columns": "string",
    "passed": "boolean",  # judged by the check itself
    "mostly": "double",  # or by the share of good rows among the evaluated ones
    "element_count": "bigint",
    "missing_count": "bigint",
    "ignored": "bigint",  # rows the check did not evaluate
    "unexpected_count": "bigint",
    "observed_num": "double",
    "observed_text": "string",
}


# Evidence is a column of the frame of aggregates, or SQL text over its columns. Text is what long suites are made of: columns
# are built call by call over the bridge to the JVM, text is parsed there at once.
Evidence = Column | str


def judged(rule: Rule, passed: Evidence, **evidence: Evidence) -> dict[str, Evidence]:
    """Outcome of a check that decides by itself; null means no evidence, which is not a pass."""
    return _outcome(rule, passed=passed, **evidence)


def counted(
    rule: Rule, mostly: float, elements: Evidence, ignored: Evidence, unexpected: Evidence, missing: Evidence | None = None
) -> dict[str, Evidence]:
    """Outcome of a check that counts unexpected rows among the evaluated ones."""
    return _outcome(
        rule, mostly=f"{float(mostly)!r}D", element_count=elements, ignored=ignored, unexpected_count=unexpected,
        missing_count=ignored if missing is None else missing,
    )


def _outcome(rule: Rule, **evidence: Evidence) -> dict[str, Evidence]:
    named = {"check_id": rule.check_id, "kind": rule.kind, "columns": ",".join(rule.columns)}
    return {name: text_sql(value) for name, value in named.items()} | evidence


def rows(frame: DataFrame, outcomes: Iterable[dict[str, Evidence]]) -> DataFrame:
    """One-row frame of aggregates -> one verdict row per outcome."""
    written, built = [], []
    for outcome in outcomes:
        (written if all(isinstance(v, str) for v in outcome.values()) else built).append(outcome)
    arrays = []
    if written:
        structs = ", ".join(
            "named_struct(" + ", ".join(f"'{n}', CAST({o[n]} AS {t})" if n in o else f"'{n}', CAST(NULL AS {t})" for n, t in _EVIDENCE.items()) + ")"
            for o in written
        )
        arrays.append(F.expr(f"array({structs})"))
    if built:
        nothing = {dtype: F.lit(None).cast(dtype) for dtype in set(_EVIDENCE.values())}
        column = lambda v: F.expr(v) if isinstance(v, str) else v
        arrays.append(
            F.array(*[F.struct(*[column(o[n]).cast(t).alias(n) if n in o else nothing[t].alias(n) for n, t in _EVIDENCE.items()]) for o in built])
        )
    evidence = frame.select(F.inline(arrays[0] if len(arrays) == 1 else F.concat(*arrays))).toDF(*_EVIDENCE)
    evaluated = "(element_count - ignored)"
    return evidence.selectExpr(
        "check_id",
        "kind",
        "columns",
        "coalesce(if(mostly IS NULL, passed, "
        f"{evaluated} = 0 OR (element_count - ignored - unexpected_count) / double({evaluated}) >= mostly), false)"
        " AS success",
        "element_count",
        "missing_count",
        "unexpected_count",
        f"if(mostly IS NULL, NULL, if({evaluated} = 0, 0D, 100D * unexpected_count / double({evaluated})))"
        " AS unexpected_percent",
        "observed_num",
        "observed_text",
    )


def text_sql(text: str | None) -> str:
    """A text as SQL that reads the same under any parser setting."""
    if text is None:
        return "CAST(NULL AS STRING)"
    if re.fullmatch(r"[\w .,:;()#+*/<>=-]*", text, re.ASCII):
        return f"'{text}'"
    return f"decode(unhex('{text.encode().hex()}'), 'UTF-8')"


def local_rows(spark: SparkSession, records: list[dict]) -> DataFrame:
    """Verdicts already known on the driver (a handful of rows, one per rule)."""
    return local_frame(spark, FIELDS, [[r.get(name) for name in FIELDS] for r in records])
