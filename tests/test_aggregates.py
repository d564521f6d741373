"""Aggregates and quantiles."""

import math
import random

import pytest
from pyspark.sql import functions as F

import plumbline as pl
from plumbline.operators import quantiles as Q
from tests.helpers import one, run

AGGREGATES = [
    (pl.expect_column_max_to_be_between, 4.0),
    (pl.expect_column_min_to_be_between, 1.0),
    (pl.expect_column_mean_to_be_between, 2.5),
    (pl.expect_column_sum_to_be_between, 10.0),
    (pl.expect_column_stdev_to_be_between, math.sqrt(5 / 3)),
    (pl.expect_column_median_to_be_between, 2.5),
]


def numbers(spark, values, dtype="double"):
    return spark.createDataFrame([(v,) for v in values], f"c {dtype}")


@pytest.mark.parametrize("expect, value", AGGREGATES)
def test_controls(spark, expect, value):
    df = numbers(spark, [1.0, None, 2.0, 3.0, 4.0])
    inside, above, open_low = run(
        df,
        expect("c", value - 1e-9, value + 1e-9, check_id="inside"),
        expect("c", value + 0.1, None, check_id="above"),
        expect("c", None, value + 1e-9, check_id="open"),
    )
    assert inside.success and not above.success and open_low.success
    assert inside.observed_num == pytest.approx(value)
    assert (inside.element_count, inside.missing_count) == (5, 1)


@pytest.mark.parametrize("expect, value", AGGREGATES)
def test_no_evidence_is_no_pass(spark, expect, value):
    for values in ([], [None, None, None]):
        row = one(numbers(spark, values), expect("c", -100, 100))
        assert not row.success and row.observed_num is None
        assert (row.element_count, row.missing_count) == (len(values), len(values))


def test_edges_are_inclusive(spark):
    df = numbers(spark, [1.0, 5.0])
    assert one(df, pl.expect_column_max_to_be_between("c", 5.0, 5.0)).success
    assert one(df, pl.expect_column_min_to_be_between("c", 1, 1)).success


def test_nan_fails_bounded_checks(spark):
    df = numbers(spark, [float("nan"), 1.0])
    for rule in (
        pl.expect_column_max_to_be_between("c", 0, None),
        pl.expect_column_mean_to_be_between("c", 0, None),
        pl.expect_column_sum_to_be_between("c", 0, None),
    ):
        row = one(df, rule)
        assert not row.success and math.isnan(row.observed_num)


def test_one_row_has_no_deviation(spark):
    assert not one(numbers(spark, [1.0]), pl.expect_column_stdev_to_be_between("c", 0, 1)).success


def test_integer_sums_do_not_overflow(spark):
    row = one(numbers(spark, [2**63 - 1, 1], "bigint"), pl.expect_column_sum_to_be_between("c", 2**63, 2**63))
    assert row.success and row.observed_num == float(2**63)


def test_extremes_of_text_and_time(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', TIMESTAMP_NTZ'2024-01-01'), ('c', TIMESTAMP_NTZ'2024-03-01') AS t(s, t)")
    rows = run(
        df,
        pl.expect_column_max_to_be_between("s", "b", "d"),
        pl.expect_column_min_to_be_between("s", "b", "d"),
        pl.expect_column_max_to_be_between("t", "2024-02-01", "2024-03-01"),
    )
    assert [r.success for r in rows] == [True, False, True]
    assert [r.observed_text for r in rows] == ["c", "a", "2024-03-01 00:00:00"]


def test_decimal_columns(spark):
    df = spark.sql("SELECT CAST(x AS DECIMAL(10,2)) AS c FROM VALUES (1.25), (2.25) AS t(x)")
    rows = run(
        df,
        pl.expect_column_mean_to_be_between("c", 1.7, 1.8),
        pl.expect_column_sum_to_be_between("c", 3.5, 3.5),
        pl.expect_column_max_to_be_between("c", 2, 3),
        pl.expect_column_median_to_be_between("c", 1.75, 1.75),
        pl.expect_column_stdev_to_be_between("c", 0, 1),
    )
    assert all(r.success for r in rows)


def test_row_count(spark):
    df = numbers(spark, [1.0, None])
    rows = run(
        df,
        pl.expect_table_row_count_to_equal(2),
        pl.expect_table_row_count_to_equal(3),
        pl.expect_table_row_count_to_be_between(1, 2),
        pl.expect_table_row_count_to_be_between(3, None),
        pl.expect_table_row_count_to_be_between(None, 2),
    )
    assert [r.success for r in rows] == [True, False, True, False, True]
    assert one(numbers(spark, []), pl.expect_table_row_count_to_equal(0)).success


def test_wrong_type_fails_one_check_only(spark):
    df = spark.createDataFrame([("a", 1)], "s string, n int")
    rows = {
        r.check_id: r
        for r in run(
            df,
            pl.expect_column_mean_to_be_between("s", 0, 1, check_id="mean"),
            pl.expect_column_values_to_be_between("s", 0, 1, check_id="between"),
            pl.expect_column_values_to_be_in_set("n", ["1"], check_id="set"),
            pl.expect_column_distinct_values_to_be_in_set("n", ["1"], check_id="distinct"),
            pl.expect_column_pair_values_to_be_in_set("s", "n", [("a", "1")], check_id="pair"),
            pl.expect_column_median_to_be_between("s", 0, 1, check_id="median"),
            pl.expect_column_sum_to_be_between("n", 1, 1, check_id="fine"),
        )
    }
    assert rows.pop("fine").success
    assert all(not r.success and "Type" in r.observed_text for r in rows.values())


# ------------------------------------------------------------------ exact quantiles

PROBABILITIES = [0.0, 0.1, 0.25, 0.5, 0.617, 0.75, 0.999, 1.0]


def by_percentile(df, name):
    p = ", ".join(f"{x}D" for x in PROBABILITIES)
    return df.selectExpr(f"percentile({name}, array({p})) AS q").first().q


def shapes():
    rng = random.Random(7)
    yield "spread", [rng.gauss(0, 1000) for _ in range(4000)]
    yield "hot", [5.0] * 1500 + [rng.random() * 10 for _ in range(2500)]
    yield "few", [float(rng.randrange(4)) for _ in range(3000)]
    yield "tiny", [3.0, 1.0, None, 2.0]
    yield "same", [7.0] * 500
    yield "skewed", [math.exp(rng.gauss(0, 20)) * rng.choice([-1, 1]) for _ in range(3000)]
    yield "infinite", [math.inf] * 100 + [-math.inf] * 100 + [rng.random() for _ in range(200)]


@pytest.mark.parametrize("limit", [0, 40, 1_000_000])
@pytest.mark.parametrize("name, values", list(shapes()), ids=lambda v: v if isinstance(v, str) else "")
def test_exact_quantiles_match_percentile(spark, monkeypatch, name, values, limit):
    if limit < 1_000_000:  # by brackets, however few values there are
        monkeypatch.setattr(Q, "PEEK", 0)
        monkeypatch.setattr(Q, "FEW_VALUES", -1)
    df = numbers(spark, values).repartition(4)
    found = pl.exact_quantiles(df, {"c": PROBABILITIES}, bracket_limit=limit)["c"]
    expected = by_percentile(df, "c")
    for p, want in zip(PROBABILITIES, expected):
        got = found.values[p]
        assert got == want or got == pytest.approx(want, rel=1e-12) or (math.isnan(got) and math.isnan(want))


def test_exact_quantiles_of_several_columns(spark):
    df = spark.range(10_000).selectExpr("id", "CAST(id % 13 AS INT) AS m", "CAST(null AS DOUBLE) AS nothing",
                                        "CAST(id / 7 AS DECIMAL(12,3)) AS d")
    found = pl.exact_quantiles(df, {"id": [0.5], "m": PROBABILITIES, "nothing": [0.5], "d": [0.25]}, bracket_limit=50)
    assert found["id"].values[0.5] == 4999.5
    assert [found["m"].values[p] for p in PROBABILITIES] == by_percentile(df, "m")
    assert found["nothing"].values[0.5] is None and found["nothing"].present == 0
    assert found["d"].values[0.25] == pytest.approx(df.selectExpr("percentile(d, 0.25D) AS q").first().q)


def test_a_column_that_only_begins_with_few_values(spark, monkeypatch):
    monkeypatch.setattr(Q, "FEW_GROUPS", 1000)
    df = spark.range(0, 30_000, 1, 3).selectExpr("CAST(IF(id < 5000, 7, id) AS DOUBLE) AS c")
    assert Q._by_counting(df, {"c": [0.5]}) is None
    found = pl.exact_quantiles(df, {"c": PROBABILITIES})["c"]
    assert [found.values[p] for p in PROBABILITIES] == pytest.approx(by_percentile(df, "c"))


@pytest.mark.parametrize("counted", [True, False])
def test_nan_sorts_above_everything(spark, monkeypatch, counted):
    if not counted:
        monkeypatch.setattr(Q, "PEEK", 0)
        monkeypatch.setattr(Q, "FEW_VALUES", -1)
    df = numbers(spark, [1.0, 2.0, math.inf, math.nan, math.nan])
    found = pl.exact_quantiles(df, {"c": [0.0, 0.25, 0.5, 0.75, 1.0]})["c"].values
    assert (found[0.0], found[0.25], found[0.5]) == (1.0, 2.0, math.inf)
    assert math.isnan(found[0.75]) and math.isnan(found[1.0])


def test_a_bracket_that_misses_is_searched_again_within_the_limit(spark, monkeypatch):
    df = spark.range(200_000).selectExpr("CAST((id * 7919) % 200000 AS DOUBLE) AS c")
    honest, rank, calls, held = Q._choose, Q._rank, [], []

    def wrong_at_first(grid, below, inside, rank, slack=1):
        calls.append(slack)
        if slack == 1:
            return Q._Bracket(rank, 1.0, 2.0, 2)
        return honest(grid, below, inside, rank, slack)

    def watched(pruned, searches):
        for brackets in searches.values():
            spans = Q._merge([(b.low, b.high) for b in brackets])
            held.append(sum(pruned.filter((F.col("v0") >= low) & (F.col("v0") <= high)).count() for low, high in spans))
        return rank(pruned, searches)

    monkeypatch.setattr(Q, "_choose", wrong_at_first)
    monkeypatch.setattr(Q, "_rank", watched)
    found = pl.exact_quantiles(df, {"c": [0.5, 0.9]}, bracket_limit=1000)["c"].values
    assert found == {0.5: 99999.5, 0.9: pytest.approx(179999.1)}
    assert max(calls) > 1 and len(held) == 2 and max(held) <= 1000


def test_a_table_that_changes_between_reads_fails_its_quantiles_only(spark, monkeypatch):
    monkeypatch.setattr(Q, "_choose", lambda grid, below, inside, rank, slack=1: Q._Bracket(rank, 1.0, 2.0, 2))
    monkeypatch.setattr(Q, "BRACKET_LIMIT", 100)
    monkeypatch.setattr(Q.exact_quantiles, "__defaults__", (100,))
    df = spark.range(5000).selectExpr("CAST(id AS DOUBLE) AS c")
    median, high = run(df, pl.expect_column_median_to_be_between("c", 0, 9999), pl.expect_column_max_to_be_between("c", 0, 9999))
    if high.kind != "expect_column_max_to_be_between":
        median, high = high, median
    assert high.success and not median.success and "changes" in median.observed_text


def test_quantile_rules(spark):
    df = spark.range(101).selectExpr("CAST(id AS DOUBLE) AS c")
    ranges = {"quantiles": [0.25, 0.5], "value_ranges": [[25, 25], [None, 50]]}
    tight = {"quantiles": [0.25, 0.5], "value_ranges": [[25, 25], [51, None]]}
    for approx in (False, True):
        good, bad = run(
            df,
            pl.expect_column_quantile_values_to_be_between("c", ranges, approx=approx, check_id="good"),
            pl.expect_column_quantile_values_to_be_between("c", tight, approx=approx, check_id="bad"),
        )
        assert good.success and not bad.success and good.observed_text == "25.0,50.0"
    empty = one(numbers(spark, []), pl.expect_column_quantile_values_to_be_between("c", ranges, approx=True))
    assert not empty.success
