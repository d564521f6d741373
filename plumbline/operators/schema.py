"""Schema contracts: answered from analysed plans, without touching a row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import columns as C
from plumbline.functions.local import local_frame
from plumbline.operators.verdict import local_rows
from plumbline.rules import SchemaRule

_COLUMNS = {"table_name": "string", "position": "bigint", "column_name": "string", "column_type": "string"}


def schema_verdicts(df: DataFrame, rules: Sequence[SchemaRule]) -> DataFrame:
    records = []
    for rule in rules:
        success, number, text = rule.test(df.schema)
        records.append(
            {"check_id": rule.check_id, "kind": rule.kind, "columns": ",".join(rule.columns), "success": success,
             "observed_num": number, "observed_text": text}
        )
    return local_rows(df.sparkSession, records)


def observed_columns(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, position, column_name, column_type) of any number of tables."""
    some = next(iter(tables.values()))
    return local_frame(
        some.sparkSession,
        _COLUMNS,
        [
            (table, i, field.name, C.type_name(field.dataType))
            for table, df in tables.items()
            for i, field in enumerate(df.schema.fields, start=1)
        ],
    )


def schema_drift(tables: Mapping[str, DataFrame], contract: Mapping[str, Sequence[tuple[str, str]]]) -> DataFrame:
    """One row per column that departs from the contract ``{table: [(column, type), ..]}``.

    ``drift`` is ``missing``, ``extra``, ``retyped`` or ``moved``.
    """
    spark = next(iter(tables.values())).sparkSession
    expected = local_frame(
        spark,
        _COLUMNS,
        [(t, i, name, dtype) for t, cols in contract.items() for i, (name, dtype) in enumerate(cols, start=1)],
    )
    seen = observed_columns(tables).select(
        "table_name", "column_name", F.col("position").alias("observed_position"),
        F.col("column_type").alias("observed_type"),
    )
    wanted = expected.select(
        "table_name", "column_name", F.col("position").alias("expected_position"),
        F.col("column_type").alias("expected_type"),
    )
    drift = (
        F.when(F.col("observed_position").isNull(), "missing")
        .when(F.col("expected_position").isNull(), "extra")
        .when(F.col("observed_type") != F.col("expected_type"), "retyped")
        .when(F.col("observed_position") != F.col("expected_position"), "moved")
    )
    return (
        seen.join(wanted, ["table_name", "column_name"], "full_outer")
        .withColumn("drift", drift)
        .filter(F.col("drift").isNotNull())
    )


#: Entries of a column's sketch: columns of up to so many different values are compared exactly.
SKETCH_BITS = 12
#: Columns are taken for one renamed if so many of their values are the same.
LIKE = 0.5
#: Columns whose sketches one scan makes.
TOGETHER = 64


def schema_renames(old: DataFrame, new: DataFrame, like: float = LIKE) -> DataFrame:
    """What became of the columns from one version of a table to the next, telling renamed from removed and added ones.

    Rows (change, old_column, new_column, old_type, new_type, likeness), one per column: ``same``, ``moved`` or ``retyped`` for columns of one name
    (the last two by position and type), ``renamed`` for a removed and an added column of one family of types whose values are alike,
    ``removed`` and ``added`` for the rest. Likeness is the share of different values, as texts, that both hold; among equals the nearer position,
    then the earlier column decides. Nulls are no values, and columns without any are alike only if both are empty and in one place.
    Values are sketched in one scan of the candidates of each side; sketches merge, so neither side's values meet anywhere.
    """
    before, after = _placed(old), _placed(new)
    gone = [c for c in before if c not in after]
    come = [c for c in after if c not in before]
    found = _likeness(old, new, gone, come) if gone and come else {}
    order = sorted(found, key=lambda pair: (-found[pair], abs(before[pair[0]] - after[pair[1]]), before[pair[0]], after[pair[1]]))
    renamed: dict[str, str] = {}
    for a, b in order:
        if found[a, b] >= like and a not in renamed and b not in renamed.values():
            renamed[a] = b
    kind = lambda df, c: C.type_name(df.schema[c].dataType)
    rows = []
    kept = [c for c in before if c in after]
    places = {c: (i, sorted(kept, key=after.__getitem__).index(c)) for i, c in enumerate(kept)}
    for c in kept:
        types = kind(old, c), kind(new, c)
        rows.append(("retyped" if types[0] != types[1] else "same" if places[c][0] == places[c][1] else "moved", c, c, *types, None))
    rows += [("renamed", a, b, kind(old, a), kind(new, b), found[a, b]) for a, b in renamed.items()]
    rows += [("removed", c, None, kind(old, c), None, None) for c in gone if c not in renamed]
    rows += [("added", None, c, None, kind(new, c), None) for c in come if c not in renamed.values()]
    fields = {"change": "string", "old_column": "string", "new_column": "string", "old_type": "string", "new_type": "string", "likeness": "double"}
    return local_frame(old.sparkSession, fields, rows)


def _placed(df: DataFrame) -> dict[str, int]:
    return {c: i for i, c in enumerate(df.columns)}


def _likeness(old: DataFrame, new: DataFrame, gone: Sequence[str], come: Sequence[str]) -> dict[tuple[str, str], float]:
    """Share of common values of every pair of columns that can be compared, from one row of sketches of each side."""
    family = lambda df, c: C.family(df.schema[c].dataType)
    pairs = [(a, b) for a in gone for b in come if family(old, a) is not None and family(old, a) == family(new, b)]
    left, right = (_sketched(df, sorted({p[i] for p in pairs}, key=df.columns.index)) for i, df in enumerate((old, new)))
    tests = []
    for a, b in pairs:
        union, both = F.lit(left[a][0]), F.lit(right[b][0])
        alike = F.theta_sketch_estimate(F.theta_intersection(union, both)) / F.theta_sketch_estimate(F.theta_union(union, both))
        empty = left[a][1] == right[b][1] == 0
        tests.append(F.lit(1.0 if empty and old.columns.index(a) == new.columns.index(b) else 0.0) if not left[a][1] or not right[b][1] else alike.cast("double"))
    out: dict[tuple[str, str], float] = {}
    for at in range(0, len(pairs), TOGETHER):  # on one local row, without a job
        row = old.sparkSession.range(1).select(*[t.alias(f"p{k}") for k, t in enumerate(tests[at : at + TOGETHER])]).first()
        out |= {pair: row[k] for k, pair in enumerate(pairs[at : at + TOGETHER])}
    return out


def _sketched(df: DataFrame, names: Sequence[str]) -> dict[str, tuple[bytes, int]]:
    """Each column's sketch of its values, and how many values it has."""
    out: dict[str, tuple[bytes, int]] = {}
    for at in range(0, len(names), TOGETHER):
        part = names[at : at + TOGETHER]
        # numbers meet as what they are, whatever their type
        value = lambda c: F.to_json(F.struct(C.column(c).alias("v"))) if C.family(df.schema[c].dataType) not in ("number", "text", "time", "boolean", "binary") else _spelt(C.column(c), df.schema[c].dataType)
        row = df.agg(*[F.theta_sketch_agg(value(c), SKETCH_BITS).alias(f"s{k}") for k, c in enumerate(part)], *[F.count(C.column(c)).alias(f"n{k}") for k, c in enumerate(part)]).first()
        out |= {c: (bytes(row[f"s{k}"]), row[f"n{k}"]) for k, c in enumerate(part)}
    return out


def _spelt(c: Column, dtype: T.DataType) -> Column:
    """A value as text, equal for equal numbers of different types and for a date and its midnight."""
    if C.is_numeric(dtype):
        whole = c.try_cast("bigint")
        return F.when(whole.cast("double") == c.cast("double"), whole.cast("string")).otherwise(c.cast("double").cast("string"))
    return c.cast("timestamp_ntz").cast("string") if C.is_temporal(dtype) else c.cast("string")
