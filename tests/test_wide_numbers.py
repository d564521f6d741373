"""Numbers that floating point rounds: quantiles in the own type, sets, comparisons, overflow."""

import datetime
import decimal
import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

import plumbline as pl
from plumbline.operators import radix as R
from tests.helpers import one, run

D = decimal.Decimal
BIG = 2**53
PROBABILITIES = [0.0, 0.1, 0.25, 0.5, 0.617, 0.75, 0.999, 1.0]


def brute(values, p):
    values = sorted(v for v in values if v is not None)
    position = Fraction(str(p)) * (len(values) - 1)
    low, high = math.floor(position), math.ceil(position)
    return Fraction(values[low]) + (position - low) * (Fraction(values[high]) - Fraction(values[low]))


def shapes():
    rng = random.Random(11)
    yield "wide", "bigint", [rng.randrange(-(2**63), 2**63) for _ in range(3000)]
    yield "close", "bigint", [BIG * 512 + rng.randrange(40) for _ in range(3000)]
    yield "ends", "bigint", [-(2**63), 2**63 - 1] * 20 + [0, None]
    yield "hot", "bigint", [7] * 1000 + [rng.randrange(10**12) for _ in range(500)]
    yield "one", "bigint", [None, 5]
    yield "digits", "decimal(38,4)", [D(rng.randrange(-(10**38) + 1, 10**38)).scaleb(-4, decimal.Context(prec=38)) for _ in range(2000)]
    yield "last digits", "decimal(38,10)", [D(10**37 + rng.randrange(2000)).scaleb(-10, decimal.Context(prec=38)) for _ in range(2000)]
    yield "tiny", "decimal(20,18)", [D(rng.randrange(5)).scaleb(-18) for _ in range(100)]


@pytest.mark.parametrize("few", [0, 50_000])
@pytest.mark.parametrize("name, dtype, values", list(shapes()), ids=lambda v: v if isinstance(v, str) else "")
def test_quantiles_are_exact(spark, monkeypatch, name, dtype, values, few):
    monkeypatch.setattr(R, "FEW_ROWS", few)
    df = spark.createDataFrame([(v,) for v in values], f"c {dtype}").repartition(4)
    found = pl.exact_quantiles(df, {"c": PROBABILITIES})["c"]
    assert found.present == sum(v is not None for v in values)
    for p in PROBABILITIES:
        got, want = found.values[p], brute(values, p)
        assert Fraction(got) == want or abs(Fraction(got) - want) <= abs(want) / 10**37


def test_dates_and_times_give_a_value_that_is_there(spark):
    rng = random.Random(2)
    days = [datetime.date(2020, 1, 1) + datetime.timedelta(rng.randrange(4000)) for _ in range(501)]
    times = [datetime.datetime(1969, 12, 31, 23, 59, 59, 999_990) + datetime.timedelta(microseconds=rng.randrange(30)) for _ in range(501)]
    df = spark.createDataFrame(list(zip(days, times, times)), "d date, t timestamp_ntz, z timestamp")
    found = pl.exact_quantiles(df, {c: [0.0, 0.25, 0.5, 1.0] for c in "dtz"})
    for c, values in (("d", days), ("t", times)):
        ordered = sorted(values)
        for p in (0.0, 0.25, 0.5, 1.0):
            want = ordered[max(math.ceil(Fraction(str(p)) * len(ordered)) - 1, 0)]
            assert datetime.datetime.fromisoformat(found[c].values[p]) == datetime.datetime.fromisoformat(str(want))


def test_rules_on_wide_columns(spark):
    df = spark.createDataFrame([(BIG + 1, datetime.date(2024, 5, 1), D("0.30"))], "b bigint, d date, m decimal(38,2)")
    median = pl.expect_column_median_to_be_between
    rows = {
        r.check_id: r
        for r in run(
            df,
            median("b", None, BIG, check_id="above"), median("b", BIG + 1, BIG + 1, check_id="at"),
            median("d", datetime.date(2024, 5, 1), None, check_id="day"), median("d", None, "2024-04-30", check_id="before"),
            median("d", datetime.datetime(2024, 5, 1, 12), None, check_id="noon"), median("m", 0.25, D("0.30"), check_id="money"),
            median("d", 5, None, check_id="odd"), median("d", None, "2024-04-30", approx=True, check_id="approx"),
        )
    }
    assert [n for n, r in rows.items() if r.success] == ["at", "day", "money"] or {n for n, r in rows.items() if r.success} == {"at", "day", "money"}
    assert rows["at"].observed_text == str(BIG + 1) and rows["day"].observed_text == "2024-05-01" and rows["money"].observed_text == "0.30"
    assert "not comparable" in rows["odd"].observed_text and "not a number" in rows["approx"].observed_text
    empty = run(df.limit(0), median("b", 0, None, check_id="b"), median("d", "2020-01-01", None, check_id="d"))
    assert not any(r.success for r in empty)


def test_wide_and_narrow_columns_together(spark):
    df = spark.range(1001).selectExpr("id AS b", "CAST(id AS DOUBLE) AS x", "CAST(id AS INT) AS i")
    found = pl.exact_quantiles(df, {"b": [0.5], "x": [0.5], "i": [0.5]})
    assert [found[c].values[0.5] for c in "bxi"] == [500, 500.0, 500.0]


def test_each_pass_reads_its_range_only(spark):
    df = spark.range(100_000).selectExpr("id AS c")
    plan = R._counted(df, "c", 0, [R._Range(500, 90_000, 500, 89_501, [700])])._jdf.queryExecution().optimizedPlan().toString()
    assert ">= 500" in plan and "<= 90000" in plan


# ------------------------------------------------------------------ sets and comparisons


def test_members_of_other_number_types(spark):
    df = spark.createDataFrame([(BIG + 1, float(BIG), D("0.1"), 3)], "b bigint, x double, m decimal(10,2), i int")
    within = pl.expect_column_values_to_be_in_set
    cases = {
        ("b", (float(BIG),)): False, ("b", (BIG + 1, 0.5)): True, ("b", (float(BIG), float(BIG + 2))): False, ("x", (BIG + 1,)): False, ("x", (BIG,)): True,
        ("m", (0.1,)): True, ("m", (D("0.10"),)): True, ("i", (3.0,)): True, ("i", (3.5, 2**70)): False, ("b", (math.inf, math.nan)): False,
    }
    for (c, members), want in cases.items():
        assert one(df, within(c, members)).success is want, (c, members)
        many = [*members, *range(10_000, 11_500)]
        assert one(df, within(c, many)).success is want, (c, members)
        pairs = [(m, 3) for m in members]
        assert one(df.select(c, F.lit(3).alias("three")), pl.expect_column_pair_values_to_be_in_set(c, "three", pairs)).success is want
        table = spark.createDataFrame([(m,) for m in members if isinstance(m, float)], "m double")
        if any(isinstance(m, float) for m in members):
            held = any(isinstance(m, float) and math.isfinite(m) and (Fraction(m) == Fraction(df.first()[c]) or (c == "m" and m == 0.1)) for m in members)
            assert one(df, within(c, table)).success is held, (c, members)
    distinct = pl.expect_column_distinct_values_to_equal_set
    assert one(df, distinct("b", [BIG + 1])).success and not one(df, distinct("b", [BIG + 1, 0.5])).success and not one(df, distinct("b", [float(BIG)])).success


def test_bounds_do_not_round_integers(spark):
    df = spark.createDataFrame([(BIG + 1,)], "b bigint")
    assert not one(df, pl.expect_column_values_to_be_between("b", None, float(BIG))).success
    assert one(df, pl.expect_column_values_to_be_between("b", float(BIG), None)).success
    assert not one(df, pl.expect_column_max_to_be_between("b", None, float(BIG))).success


NUMBERS = [0, 1, -1, 3, BIG, BIG + 1, BIG + 2, 2**62, 2**63 - 1, -(2**63), 0.5, 0.1, -2.25, 1e300, float(BIG), 2.0**63]
TYPES = {"int": lambda v: v == int(v) and abs(v) < 2**31, "bigint": lambda v: v == int(v) and -(2**63) <= v < 2**63,
         "double": lambda v: int(float(v)) == v if isinstance(v, int) else True, "float": lambda v: abs(v) < 2**20 and v != 0.1,
         "decimal(38,2)": lambda v: abs(v) < 10**30 and v != 0.1, "decimal(38,18)": lambda v: abs(v) < 10**19, "decimal(20,0)": lambda v: v == int(v) and abs(v) < 10**19}


@pytest.mark.parametrize("a", TYPES)
@pytest.mark.parametrize("b", TYPES)
def test_keys_of_any_two_number_types_meet_if_they_are_the_same_number(spark, a, b):
    def column(dtype):
        held = [v for v in NUMBERS if TYPES[dtype](v)]
        made = [D(str(v)) if "decimal" in dtype else float(v) if dtype in ("double", "float") else int(v) for v in held]
        return spark.createDataFrame([(v,) for v in [*made, None]], f"k {dtype}"), {Fraction(v) if v != 0.1 else 0.1 for v in held}

    (left, l), (right, r) = column(a), column(b)
    rows = {x.check_id.split(".")[1]: x for x in pl.compare_keys(left, right, ["k"]).collect()}
    assert rows["missing_from_right"].unexpected_count == len(l - r) and rows["missing_from_left"].unexpected_count == len(r - l)


def test_aggregates_compare_in_their_own_types(spark):
    df = spark.createDataFrame([(BIG + 1, D(10**37), "x", datetime.date(2024, 1, 1), math.nan, None)], "b bigint, m decimal(38,0), s string, d date, x double, n int")
    other = spark.createDataFrame([(BIG, D(10**37 - 1), "y", datetime.date(2024, 1, 2), math.nan, None)], df.schema)
    measures = {c: F.max(c) for c in df.columns}
    found = {r.check_id.split(".")[1]: r for r in pl.compare_aggregates(df, other, measures).collect()}
    assert {c for c, r in found.items() if r.success} == {"x"}
    assert found["b"].observed_num == 1 and found["m"].observed_num == 1
    near = {r.check_id.split(".")[1]: r.success for r in pl.compare_aggregates(df, other, measures, tolerance=1).collect()}
    assert near == {"b": True, "m": True, "s": False, "d": False, "x": True, "n": False}
    mixed = pl.compare_aggregates(df, df, {"v": F.max("b")}, {"v": F.max("s")}).first()
    assert not mixed.success and "StringType" in mixed.observed_text


def test_overflow_fails_its_check_only(spark):
    nines = D("9" * 38)
    df = spark.createDataFrame([(nines, nines, 1.0), (nines, nines, 2.0)], "a decimal(38,0), b decimal(38,0), x double")
    rows = {
        r.check_id: r
        for r in run(
            df, pl.expect_column_sum_to_be_between("a", 0, None, check_id="sum"), pl.expect_column_mean_to_be_between("a", 0, None, check_id="mean"),
            pl.expect_multicolumn_sum_to_equal(["a", "b"], 1, check_id="row"), pl.expect_column_mean_to_be_between("x", 1.5, 1.5, check_id="fine"),
            pl.expect_column_max_to_be_between("a", 0, None, check_id="max"),
        )
    }
    assert {n for n, r in rows.items() if r.success} == {"fine", "max"}
    assert rows["sum"].observed_text == rows["mean"].observed_text == "beyond 38 digits" and rows["row"].unexpected_count == 2
