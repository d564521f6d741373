"""Membership in a very large table of members, where few rows of the table under test are expected to be members.

The members are folded into a bit map: each sets the bit of its hash, 64 bits a word, words combined in the tasks. The map has a fixed
size, whatever the number of members, so it may go to every executor; rows meet it where they are read. A row whose bit is not set
is no member and is only counted. The others, members and the few whose hash meets a member's bit, are counted by
value and joined with the members themselves, so the verdict is exact, and what is shuffled is bounded by the members
found and the filter's error (members / bits).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import columns as C
from plumbline.operators.members import members_of
from plumbline.operators.verdict import counted, rows
from plumbline.rules import FrequencyRule

#: Bits of the map: 2 million words. With 10 million members 7 of 100 other values pass.
BITS = 1 << 27


def filtered_sets(rules: Sequence[FrequencyRule]) -> list[FrequencyRule]:
    """Rules that ask for the filter."""
    return [r for r in rules if r.few_members and r.relation is not None]


def _bit(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(BITS))


def bit_map(members: DataFrame) -> DataFrame:
    """(word, bits): the words of the map that are not zero, for the members in column ``member``."""
    at = members.select(_bit(F.col("member")).alias("at"))
    words = at.select(F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, CAST(at % 64 AS INT))").alias("bit"))
    return words.groupBy("word").agg(F.bit_or("bit").alias("bits"))


def possible_members(df: DataFrame, name: str, members: DataFrame) -> DataFrame:
    """(value, maybe): the column, and whether the map has the value's bit; null for a null."""
    value = df.select(C.column(name).alias("value")).withColumn("at", _bit(F.col("value")))
    met = value.join(F.broadcast(bit_map(members)), F.shiftright("at", 6) == F.col("word"), "left")
    maybe = F.coalesce(F.expr("getbit(bits, CAST(at % 64 AS INT))") == 1, F.lit(False))
    return met.select("value", F.when(F.col("value").isNotNull(), maybe).alias("maybe"))


def set_filter_verdicts(df: DataFrame, rule: FrequencyRule) -> DataFrame:
    """Verdict of a rule of membership in a table, equal to that of the column's whole frequency table."""
    name = rule.columns[0]
    members = members_of(rule, df.schema[name].dataType)
    seen = possible_members(df, name, members)
    # rows that are no members, and nulls, are one group each in every task
    freq = seen.groupBy("maybe", F.when(F.col("maybe"), F.col("value")).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    held = freq.join(members.distinct().withColumn("inside", F.lit(True)), F.col("value") == F.col("member"), "left")
    n = F.col("n")
    one = held.agg(
        *[F.coalesce(F.sum(v), F.lit(0)).alias(k) for k, v in {
            "elements": n, "missing": F.when(F.col("maybe").isNull(), n), "hits": F.when(F.col("inside"), n),
        }.items()]
    )
    wrong = "hits" if rule.judge == "rows_not_in_set" else "(elements - missing - hits)"
    return rows(one, [counted(rule, rule.mostly, "elements", "missing", wrong)])
