"""Membership through a bit map: the verdicts of the frequency table, and only possible members shuffled."""

import datetime
import random

import pytest

import plumbline as pl
from plumbline.operators import setfilter as S
from plumbline.operators.members import members_of
from tests.helpers import one, plan_of


def both(df, members, column="c", **arguments):
    for rule in (pl.expect_column_values_to_be_in_set, pl.expect_column_values_to_not_be_in_set):
        got, want = (one(df, rule(column, members, few_members=few, check_id="c", **arguments)) for few in (True, False))
        assert got.asDict() == want.asDict()
    return got


@pytest.mark.parametrize("bits", [64, 1 << 27])
@pytest.mark.parametrize("dtype", ["string", "bigint", "double", "date", "decimal(10,2)"])
def test_same_verdicts_whatever_passes(spark, monkeypatch, bits, dtype):
    """With 64 bits nearly everything passes the map, and is told apart by the members themselves."""
    monkeypatch.setattr(S, "BITS", bits)
    rng = random.Random(1)
    value = {
        "string": lambda k: f"v{k}", "bigint": lambda k: k * 10**15, "double": lambda k: k / 7, "date": lambda k: datetime.date(2000, 1, 1) + datetime.timedelta(k),
        "decimal(10,2)": lambda k: __import__("decimal").Decimal(k) / 4,
    }[dtype]
    df = spark.createDataFrame([(value(rng.randrange(200)) if rng.random() < 0.9 else None,) for _ in range(500)], f"c {dtype}").repartition(3)
    members = spark.createDataFrame([(value(k),) for k in range(0, 300, 3)] + [(value(0),), (None,)], f"m {dtype}")
    got = both(df, members, mostly=0.5)
    assert 0 < got.unexpected_count < 450 and got.missing_count > 0
    assert both(df, members.limit(0)).unexpected_count == 0 and both(df.limit(0), members).element_count == 0


def test_numbers_and_times_of_other_types(spark):
    df = spark.createDataFrame([(2**53 + 1, 3, datetime.date(2024, 1, 1))], "b bigint, i int, d date")
    doubles = spark.createDataFrame([(float(2**53),), (3.0,), (3.5,), (float("nan"),)], "m double")
    assert both(df, doubles, "b").unexpected_count == 0 and both(df, doubles, "i").unexpected_count == 1
    noon, midnight = (spark.createDataFrame([(datetime.datetime(2024, 1, 1, h),)], "m timestamp_ntz") for h in (12, 0))
    assert both(df, noon, "d").unexpected_count == 0 and both(df, midnight, "d").unexpected_count == 1


def test_what_passes_is_bounded_by_the_filters_error(spark, monkeypatch):
    monkeypatch.setattr(S, "BITS", 1 << 20)
    df = spark.range(0, 200_000, 1, 4).selectExpr("concat('k', id) AS c")
    members = spark.range(1_000_000, 1_020_000).selectExpr("concat('k', id) AS m").union(df.limit(50))
    rule = pl.expect_column_values_to_not_be_in_set("c", members, few_members=True, check_id="c")
    table = members_of(rule, df.schema["c"].dataType)
    words = S.bit_map(table)
    assert words.count() <= S.BITS // 64
    seen = S.possible_members(df, "c", table)
    passed = seen.filter("maybe").count()
    assert 50 <= passed <= 50 + 1.2 * 200_000 * 20_050 / S.BITS
    # rows meet the map in the scan's own stage: nothing of them is shuffled for it
    assert "BroadcastHashJoin" in plan_of(seen) and "SortMergeJoin" not in plan_of(seen)
    assert one(df, rule).unexpected_count == 50


def test_ten_million_members(spark):
    df = spark.range(0, 300_000, 1, 8).selectExpr("id * 1000003 AS c")
    members = spark.range(0, 10_000_000, 1, 8).selectExpr("id * 7 AS m")
    got = one(df, pl.expect_column_values_to_not_be_in_set("c", members, few_members=True))
    assert got.unexpected_count == sum(1 for k in range(300_000) if k * 1000003 % 7 == 0 and k * 1000003 < 70_000_000)


def test_names_that_clash(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "value string, maybe int")
    members = spark.createDataFrame([("a",)], "value string")
    assert both(df, members, "value").unexpected_count == 1
    assert both(df, spark.createDataFrame([(2,)], "word int"), "maybe").unexpected_count == 1
