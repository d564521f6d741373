"""Failing values: counted samples of what broke each check, with totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import columns as C
from plumbline.functions.local import local_frame
from plumbline.operators.frequency import frequency_table, key_names
from plumbline.operators.fused import failed
from plumbline.operators.members import with_members
from plumbline.rules import FrequencyRule, RowRule, Rule

TOP = 20
# the ranking of one check is begun in this many places
SLICES = 64
# texts of so many bytes are kept beside their hash
SHORT = 64

FIELDS = {"check_id": "string", "value": "string", "n": "bigint", "distinct_values": "bigint", "failing_rows": "bigint"}


def failing_values(df: DataFrame, rules: Sequence[Rule], top: int | None = TOP) -> DataFrame:
    """(check_id, value, n, distinct_values, failing_rows): the ``top`` most frequent offending values of each
    check, ties in the order of the values (of their hashes for texts), and the totals of the check.

    All row rules share one scan, and rules on one column share its frequency table. Offenders are
    counted before any ranking; texts are counted by a 128-bit hash, and only the long texts that are
    shown are read again (they are chosen here, the rest is lazy). The ranking is cut to ``top`` per slice before the slices
    meet, and carries the totals along.
    """
    row_rules = [r for r in rules if isinstance(r, RowRule)]
    shared: dict[tuple, list[FrequencyRule]] = {}
    for r in rules:
        if isinstance(r, FrequencyRule) and _offends(r):
            shared.setdefault((r.columns, r.ignore_row_if), []).append(r)
    parts = [_row_offenders(df, row_rules)] if row_rules else []
    parts += [_frequency_offenders(df, group) for group in shared.values()]
    if not parts:
        return local_frame(df.sparkSession, FIELDS, [])
    offenders = parts[0]
    for part in parts[1:]:
        offenders = offenders.unionByName(part)
    shown = _best(offenders, top)
    checks = [*row_rules, *(r for group in shared.values() for r in group)]
    if not any(_hashed(r, df.schema) for r in checks):
        return shown.withColumnRenamed("key", "value").select(*FIELDS)
    if top is not None:
        # a few rows per check, wanted twice: to find their texts, and beside them
        kind = {"check_id": "string", "key": "string", "hashed": "boolean", "short": "string", "n": "bigint", "distinct_values": "bigint", "failing_rows": "bigint"}
        known = [[r[c] for c in kind] for r in shown.select(*kind).collect()]
        shown = local_frame(df.sparkSession, kind, known)
        if all(not hashed or short is not None for _, _, hashed, short, *_ in known):
            return shown.withColumn("value", F.when(F.col("hashed"), F.col("short")).otherwise(F.col("key"))).select(*FIELDS)
    texts = _texts(df, checks, shown, top)
    named = shown.join(texts, ["check_id", "key"], "left")
    return named.withColumn("value", F.when(F.col("hashed"), F.coalesce("short", "text")).otherwise(F.col("key"))).select(*FIELDS)


def _best(offenders: DataFrame, top: int | None) -> DataFrame:
    """The most frequent offenders of each check with the check's totals, all in the passes that rank them."""
    order = [F.desc("n"), F.asc("key")]
    slices = Window.partitionBy("check_id", F.pmod(F.xxhash64("key"), F.lit(SLICES)))
    first = offenders.withColumn("place", F.row_number().over(slices.orderBy(*order)))
    first = first.withColumn("values", F.count(F.lit(1)).over(slices)).withColumn("rows", F.sum("n").over(slices))
    if top is not None:
        first = first.filter(F.col("place") <= top)
    whole = Window.partitionBy("check_id")
    once = F.col("place") == 1  # a slice's totals count where its first value is
    totals = first.withColumn("distinct_values", F.sum(F.when(once, F.col("values"))).over(whole)).withColumn("failing_rows", F.sum(F.when(once, F.col("rows"))).over(whole))
    if top is not None:
        totals = totals.withColumn("place", F.row_number().over(whole.orderBy(*order))).filter(F.col("place") <= top)
    return totals.drop("place", "values", "rows")


def _hashed(rule: Rule, schema: T.StructType) -> bool:
    return any(isinstance(schema[c].dataType, (T.StringType, T.BinaryType)) for c in rule.columns)


def _key(text: Column, hashed: bool) -> Column:
    return F.md5(F.encode(text, "UTF-8")) if hashed else text


def _short(text: Column, hashed: bool) -> Column:
    """The text itself if it is short, which its hash decides like everything else about it."""
    return F.when(F.octet_length(text) <= SHORT, text) if hashed else F.lit(None).cast("string")


def _subject(rule: Rule) -> Column:
    return C.as_text([C.column(c) for c in rule.columns], rule.columns)


def _row_offenders(df: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    marks = []
    for rule in rules:
        hashed = _hashed(rule, df.schema)
        text = _subject(rule)
        mark = F.struct(F.lit(rule.check_id).alias("check_id"), _key(text, hashed).alias("key"), F.lit(hashed).alias("hashed"), _short(text, hashed).alias("short"))
        marks.append(F.when(failed(rule, df.schema), mark))
    hits = df.select(F.explode(F.array_compact(F.array(*marks))).alias("hit"))
    return hits.groupBy("hit.check_id", "hit.key", "hit.hashed", "hit.short").agg(F.count(F.lit(1)).alias("n"))


def _offends(rule: FrequencyRule) -> bool:
    """Does a single value offend? Else the check judges the column as a whole."""
    return rule.judge in ("unique", "distinct_in_set", "distinct_equals", "rows_in_set", "rows_not_in_set", "kl")


def _frequency_offenders(df: DataFrame, rules: Sequence[FrequencyRule]) -> DataFrame:
    """Offenders of rules on the same columns: of one frequency table, by hash where no set needs the values."""
    names, hashed = rules[0].columns, _hashed(rules[0], df.schema)
    if hashed and all(r.judge == "unique" for r in rules):
        kept = df.filter(~C.missing([C.column(c) for c in names], rules[0].ignore_row_if))
        text = _subject(rules[0])
        freq = kept.groupBy(_key(text, True).alias("key"), _short(text, True).alias("short")).agg(F.count(F.lit(1)).alias("n"))
    else:
        keys = [F.col(k) for k in key_names(names)]
        types = [df.schema[c].dataType for c in names]
        freq = frequency_table(df, names).filter(~C.missing(keys, rules[0].ignore_row_if))
        for i, rule in enumerate(rules):
            if rule.judge != "unique":
                freq = with_members(freq, rule, types, key_names(names), f"m{i}")
        text = C.as_text(keys, names)
        freq = freq.withColumn("key", _key(text, hashed)).withColumn("short", _short(text, hashed))
    marks = []
    for i, rule in enumerate(rules):
        bad = F.col("n") > 1 if rule.judge == "unique" else F.col(f"m{i}").isNotNull() if rule.judge == "rows_not_in_set" else F.col(f"m{i}").isNull()
        marks.append(F.when(bad, F.lit(rule.check_id)))
    return freq.select(F.explode(F.array_compact(F.array(*marks))).alias("check_id"), "key", F.lit(hashed).alias("hashed"), "short", "n")


def _texts(df: DataFrame, rules: Sequence[Rule], shown: DataFrame, top: int | None) -> DataFrame | None:
    """(check_id, key, text) of the hashed values that are shown; None if there is no text among the columns."""
    marks = []
    for rule in rules:
        if _hashed(rule, df.schema):
            text = _subject(rule)
            mark = F.struct(F.lit(rule.check_id).alias("check_id"), _key(text, True).alias("key"), text.alias("text"))
            marks.append(F.when(failed(rule, df.schema), mark) if isinstance(rule, RowRule) else mark)
    if not marks:
        return None
    wanted = shown.filter("hashed").select("check_id", "key")
    hits = df.select(F.explode(F.array_compact(F.array(*marks))).alias("hit")).select("hit.*")
    # at most ``top`` short rows per check
    return hits.join(wanted if top is None else F.broadcast(wanted), ["check_id", "key"]).groupBy("check_id", "key").agg(F.min("text").alias("text"))
