"""Row predicates: a passing and a failing control each, nulls, empty tables, edges."""

import datetime
import decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import plumbline as pl
from tests.helpers import counts, one, run

WORDS = "c string"


def frame(spark, values, schema):
    return spark.createDataFrame([(v,) for v in values], schema)


# rule on column c, values that pass, values that fail, rows failing
CONTROLS = [
    (pl.expect_column_values_to_be_in_set("c", ["a", "b"]), ["a", "b", "a"], ["a", "x", "y"], 2),
    (pl.expect_column_values_to_not_be_in_set("c", ["DROP", "NULL"]), ["a", "null"], ["NULL", "a"], 1),
    (pl.expect_column_value_lengths_to_be_between("c", 2, 3), ["ab", "abc"], ["a", "ab", "abcd"], 2),
    (pl.expect_column_value_lengths_to_equal("c", 2), ["ab", "cd"], ["ab", "c"], 1),
    (pl.expect_column_values_to_match_regex("c", "^a[0-9]$"), ["a1", "a2"], ["a1", "b1", "a11"], 2),
    (pl.expect_column_values_to_match_regex_list("c", ["^a", "z$"]), ["ab", "bz"], ["ab", "bb"], 1),
    (pl.expect_column_values_to_not_match_regex_list("c", ["^a", "z$"]), ["bb", "cc"], ["ab", "bz", "bb"], 2),
    (pl.expect_column_values_to_not_match_like_pattern_list("c", ["a%", "_z"]), ["bb", "bbz"], ["ab", "bz"], 2),
    (pl.expect_column_values_to_be_between("c", "b", "d"), ["b", "c", "d"], ["a", "b", "e"], 2),
]


@pytest.mark.parametrize("rule, good, bad, failing", CONTROLS, ids=lambda v: getattr(v, "kind", None))
def test_controls(spark, rule, good, bad, failing):
    assert one(frame(spark, good, WORDS), rule).success
    row = one(frame(spark, bad, WORDS), rule)
    assert not row.success and counts(row) == (len(bad), 0, failing)
    assert row.unexpected_percent == pytest.approx(100 * failing / len(bad))


@pytest.mark.parametrize("rule, good, bad, failing", CONTROLS, ids=lambda v: getattr(v, "kind", None))
def test_null_grid(spark, rule, good, bad, failing):
    empty = one(frame(spark, [], WORDS), rule)
    assert empty.success and counts(empty) == (0, 0, 0) and empty.unexpected_percent == 0
    nothing = one(frame(spark, [None] * 3, WORDS), rule)
    assert nothing.success and counts(nothing) == (3, 3, 0) and nothing.unexpected_percent == 0
    half = [v for b in bad for v in (b, None)]
    row = one(frame(spark, half, WORDS), rule)
    assert not row.success and counts(row) == (2 * len(bad), len(bad), failing)


def test_null_rules_judge_every_row(spark):
    df = frame(spark, ["a", None, "b", None], WORDS)
    not_null = one(df, pl.expect_column_values_to_not_be_null("c"))
    assert not not_null.success and counts(not_null) == (4, 2, 2) and not_null.unexpected_percent == 50
    null = one(df, pl.expect_column_values_to_be_null("c"))
    assert not null.success and counts(null) == (4, 2, 2)
    assert one(df, pl.expect_column_values_to_not_be_null("c", mostly=0.5)).success
    assert one(frame(spark, [None, None], WORDS), pl.expect_column_values_to_be_null("c")).success
    assert one(frame(spark, [], WORDS), pl.expect_column_values_to_not_be_null("c")).success


def test_tolerance_is_exact(spark):
    df = frame(spark, ["a"] * 19 + ["b"], WORDS)
    assert one(df, pl.expect_column_values_to_be_in_set("c", ["a"], mostly=0.95)).success
    assert not one(df, pl.expect_column_values_to_be_in_set("c", ["a"], mostly=0.951)).success


def test_between_edges_nan_and_open_sides(spark):
    df = frame(spark, [1.0, 2.0, 3.0, float("nan")], "c double")
    assert one(df, pl.expect_column_values_to_be_between("c", 1, 3)).unexpected_count == 1
    assert one(df, pl.expect_column_values_to_be_between("c", min_value=1)).unexpected_count == 1
    assert one(df, pl.expect_column_values_to_be_between("c", max_value=2)).unexpected_count == 2


def test_between_dates_and_times(spark):
    days = frame(spark, [datetime.date(2024, 1, 1), datetime.date(2024, 1, 3)], "c date")
    assert one(days, pl.expect_column_values_to_be_between("c", "2024-01-01", datetime.date(2024, 1, 2))).unexpected_count == 1
    times = frame(spark, [datetime.datetime(2024, 1, 1, 12)], "c timestamp_ntz")
    noon = datetime.datetime(2024, 1, 1, 12)
    assert one(times, pl.expect_column_values_to_be_between("c", noon, noon)).success


def test_text_traps(spark):
    newline = frame(spark, ["BAD-\nx"], WORDS)
    assert not one(newline, pl.expect_column_values_to_not_match_like_pattern_list("c", ["BAD-%"])).success
    assert one(newline, pl.expect_column_values_to_not_match_regex_list("c", ["^BAD-.*$"])).success
    final = frame(spark, ["a\n"], WORDS)
    assert one(final, pl.expect_column_values_to_match_regex("c", "^a$")).success
    assert not one(final, pl.expect_column_values_to_match_regex("c", r"^a\z")).success
    assert one(frame(spark, ["\U0001f600é"], WORDS), pl.expect_column_value_lengths_to_equal("c", 2)).success
    assert one(frame(spark, ["a b@c.d"], WORDS), pl.expect_column_values_to_match_regex("c", r"[^@\s]+@[^@\s]+\.[^@\s]+")).success
    assert one(frame(spark, ["10%", "x"], WORDS), pl.expect_column_values_to_not_match_like_pattern_list("c", [r"10\%%"])).unexpected_count == 1


PAIRS = [(1, 1), (1, None), (None, None), (2, 1)]


def test_pairs_and_missing_policies(spark):
    df = spark.createDataFrame(PAIRS, "a int, b int")
    equal = pl.expect_column_pair_values_to_be_equal
    greater = pl.expect_column_pair_values_a_to_be_greater_than_b
    allowed = pl.expect_column_pair_values_to_be_in_set
    assert counts(one(df, equal("a", "b"))) == (4, 1, 2)
    assert counts(one(df, equal("a", "b", ignore_row_if="any_value_is_missing"))) == (4, 2, 1)
    assert counts(one(df, equal("a", "b", ignore_row_if="never"))) == (4, 0, 2)
    assert counts(one(df, greater("a", "b"))) == (4, 1, 2)
    assert counts(one(df, greater("a", "b", ignore_row_if="never"))) == (4, 0, 3)
    assert counts(one(df, allowed("a", "b", [(1, 1), (2, 1)]))) == (4, 1, 1)
    assert one(spark.createDataFrame([(2, 1)], "a int, b int"), greater("a", "b")).success
    assert one(spark.createDataFrame([(1, 1)], "a int, b int"), equal("a", "b")).success
    for rule in (equal("a", "b"), greater("a", "b"), allowed("a", "b", [(1, 1)])):
        assert one(spark.createDataFrame([], "a int, b int"), rule).success
        assert one(spark.createDataFrame([(None, None)] * 2, "a int, b int"), rule).success


def test_constraint_drops_nulls_where_a_rule_fails_them(spark):
    df = spark.createDataFrame([(1, None), (2, 1)], "a int, b int")
    assert one(df, pl.expect_query_to_return_no_rows("SELECT * FROM {table} WHERE a <= b")).success
    assert not one(df, pl.expect_column_pair_values_a_to_be_greater_than_b("a", "b")).success


def test_multicolumn_sum(spark):
    total = pl.expect_multicolumn_sum_to_equal
    df = spark.createDataFrame([(60, 30, 10), (60, 30, 11), (None, 50, 50), (None, None, None)], "a int, b int, c int")
    assert counts(one(df, total(["a", "b", "c"], 100))) == (4, 1, 2)
    assert counts(one(df, total(["a", "b", "c"], 100, ignore_row_if="any_value_is_missing"))) == (4, 2, 1)
    big = spark.createDataFrame([(2**63 - 1, 1, -1)], "a bigint, b bigint, c bigint")
    assert one(big, total(["a", "b", "c"], 2**63 - 1)).success
    ints = spark.createDataFrame([(2**31 - 1, 1)], "a int, b int")
    assert one(ints, total(["a", "b"], 2**31)).success


def test_within_record(spark):
    distinct = pl.expect_select_column_values_to_be_unique_within_record
    rows = [("x", "x", None), ("x", "x", "y"), ("a", "b", "c"), (None, None, "z")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    assert counts(one(df, distinct(["a", "b", "c"]))) == (4, 2, 1)
    assert counts(one(df, distinct(["a", "b", "c"], ignore_row_if="all_values_are_missing"))) == (4, 0, 2)
    wide = spark.createDataFrame(
        [(1, 2, 3, 4, 5, 6), (1, 2, 3, 4, 5, 1), (1, None, 3, None, 5, 6)], "a int, b int, c int, d int, e int, f int"
    )
    assert counts(one(wide, distinct(list("abcdef")))) == (3, 1, 1)
    assert counts(one(wide, distinct(list("abcdef"), ignore_row_if="never"))) == (3, 0, 1)


@pytest.mark.parametrize("limit", [0, 8 * 2**20])
def test_large_sets_agree_with_small_ones(spark, monkeypatch, limit):
    monkeypatch.setattr("plumbline.operators.members.BROADCAST_BYTES", limit)
    df = spark.range(5000).selectExpr("if(id % 10 = 0, null, id % 3000) AS c", "cast(id % 7 AS int) AS d")
    wanted = list(range(1200))
    large = one(df, pl.expect_column_values_to_be_in_set("c", wanted))
    small = one(df, pl.expect_column_values_to_be_between("c", 0, 1199))
    assert counts(large) == counts(small) and large.kind == "expect_column_values_to_be_in_set"
    outside = one(df, pl.expect_column_values_to_not_be_in_set("c", wanted))
    assert outside.unexpected_count == large.element_count - large.missing_count - large.unexpected_count
    allowed = [(a, b) for a in range(40) for b in range(5)]
    pairs = one(df, pl.expect_column_pair_values_to_be_in_set("c", "d", allowed))
    assert pairs.missing_count == 0
    assert pairs.unexpected_count == df.filter("NOT coalesce(c < 40 AND d < 5, false)").count()
    for policy, missing in (("any_value_is_missing", 500), ("never", 0), ("all_values_are_missing", 0)):
        row = one(df, pl.expect_column_pair_values_to_be_in_set("c", "d", allowed, ignore_row_if=policy))
        assert row.missing_count == missing and row.unexpected_count == pairs.unexpected_count - missing


@pytest.mark.parametrize("limit", [0, 8 * 2**20])
def test_large_sets_of_dates_hold_each_day_once(spark, monkeypatch, limit):
    monkeypatch.setattr("plumbline.operators.members.BROADCAST_BYTES", limit)
    first = datetime.date(2020, 1, 1)
    days = [first + datetime.timedelta(i) for i in range(1200)]
    df = spark.range(1300).selectExpr("date_add(DATE'2020-01-01', CAST(id AS INT)) AS c")
    row = one(df, pl.expect_column_values_to_be_in_set("c", [*days, *[d.isoformat() for d in days], "20200101"]))
    assert counts(row) == (1300, 0, 100)
    assert one(df, pl.expect_column_values_to_be_between("c", "20200101", "20230801")).unexpected_count == 0


@pytest.mark.parametrize("limit", [0, 8 * 2**20])
def test_large_sets_of_any_number(spark, monkeypatch, limit):
    monkeypatch.setattr("plumbline.operators.members.BROADCAST_BYTES", limit)
    df = spark.range(2000).selectExpr("id AS i", "CAST(id / 4 AS DECIMAL(6,2)) AS d", "id / 4 AS f")
    quarters = [decimal.Decimal(n) / 4 for n in range(1200)]
    for rule, bad in (
        (pl.expect_column_values_to_be_in_set("i", [*range(1200), 10**30]), 800),
        (pl.expect_column_values_to_be_in_set("i", [float(n) for n in range(1200)]), 800),
        (pl.expect_column_values_to_be_in_set("d", quarters), 800),
        (pl.expect_column_values_to_be_in_set("d", range(1200)), 1500),
        (pl.expect_column_values_to_be_in_set("f", quarters), 800),
        (pl.expect_column_values_to_be_in_set("f", [*range(1200)]), 1500),
    ):
        assert counts(one(df, rule)) == (2000, 0, bad)
    assert not one(df, pl.expect_column_distinct_values_to_contain_set("i", [1, 10**30])).success


def test_column_names_with_dots_and_backticks(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "`x.y` string, `t``k` int")
    rows = run(
        df,
        pl.expect_column_values_to_not_be_null("x.y"),
        pl.expect_column_values_to_be_unique("t`k"),
        pl.expect_compound_columns_to_be_unique(["x.y", "t`k"]),
        pl.expect_column_median_to_be_between("t`k", 1, 2),
    )
    assert {r.columns: r.success for r in rows} == {"x.y": False, "t`k": True, "x.y,t`k": True}


@pytest.mark.parametrize(
    "build",
    [
        lambda: pl.expect_column_values_to_be_in_set("c", ["a", None]),
        lambda: pl.expect_column_values_to_be_in_set("c", "abc"),
        lambda: pl.expect_column_values_to_be_between("c"),
        lambda: pl.expect_column_values_to_be_between("c", 3, 2),
        lambda: pl.expect_column_values_to_be_between("c", float("nan")),
        lambda: pl.expect_column_values_to_not_be_null("c", mostly=1.1),
        lambda: pl.expect_column_values_to_match_regex_list("c", []),
        lambda: pl.expect_column_pair_values_to_be_equal("c", "c"),
        lambda: pl.expect_column_pair_values_to_be_equal("a", "b", ignore_row_if="sometimes"),
        lambda: pl.expect_column_pair_values_to_be_in_set("a", "b", [(1, None)]),
        lambda: pl.expect_multicolumn_sum_to_equal(["a"], 1),
        lambda: pl.expect_column_kl_divergence_to_be_less_than("c", {"values": ["a"], "weights": [0.9]}, 0.5),
        lambda: pl.expect_column_kl_divergence_to_be_less_than("c", {"values": ["a", "b"], "weights": [1.5, -0.5]}, 1),
        lambda: pl.expect_column_quantile_values_to_be_between("c", {"quantiles": [2], "value_ranges": [[0, 1]]}),
        lambda: pl.expect_column_quantile_values_to_be_between("c", {"quantiles": [0.5], "value_ranges": []}),
    ],
)
def test_bad_arguments_are_refused(build):
    with pytest.raises(ValueError):
        build()


def test_bad_regex_is_refused_before_the_run(spark):
    suite = pl.Suite([pl.expect_column_values_to_match_regex("c", "(")])
    with pytest.raises(ValueError, match="regular expression"):
        suite.verdicts(frame(spark, ["a"], WORDS))


VALUES = {
    "i": ("int", [1, 2, None]), "l": ("bigint", [9007199254740993, 9007199254740992, 2, None]), "d": ("double", [9007199254740992.0, -0.0, 0.0, 2.0, 2.5, None]),
    "m": ("decimal(10,1)", ["2.5", "2.0", None]),
}


def _equal(a, b):
    return a is not None and b is not None and a == b  # Python compares numbers of all kinds exactly


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(sorted(VALUES)), min_size=2, max_size=12).flatmap(lambda kinds: st.tuples(st.just(kinds), st.tuples(*[st.sampled_from(VALUES[k][1]) for k in kinds]))))
def test_within_record_means_the_same_at_every_width(spark, drawn):
    kinds, values = drawn
    values = [decimal.Decimal(v) if k == "m" and v is not None else v for k, v in zip(kinds, values)]
    df = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} {VALUES[k][0]}" for i, k in enumerate(kinds)))
    names = df.columns
    # columns that equal none of the others
    wide = df.selectExpr("*", *[f"CAST({1000 + i} AS BIGINT) AS x{i}" for i in range(6)])
    rule = lambda cols: pl.expect_select_column_values_to_be_unique_within_record(cols, ignore_row_if="never")
    want = not any(_equal(a, b) for i, a in enumerate(values) for b in values[i + 1 :])
    assert one(df, rule(names)).success == want
    assert one(wide, rule(wide.columns)).success == want


@pytest.mark.parametrize("rule", [
    pl.expect_column_pair_values_to_be_equal("a", "b"), pl.expect_column_pair_values_a_to_be_greater_than_b("a", "b"),
    pl.expect_select_column_values_to_be_unique_within_record(["a", "b"]),
])
@pytest.mark.parametrize("types", ["a string, b double", "a string, b bigint", "a timestamp, b double", "a boolean, b int", "a map<int,int>, b map<int,int>", "a array<int>, b array<string>"])
def test_columns_of_different_families_fail_with_the_reason(spark, rule, types):
    row = one(spark.createDataFrame([(None, None)], types), rule)
    assert not row.success and "compar" in row.observed_text


def test_keys_of_different_families(spark):
    rows = pl.compare_keys(spark.range(3), spark.range(3).selectExpr("CAST(id AS STRING) AS id"), ["id"]).collect()
    assert len(rows) == 2 and not any(r.success for r in rows) and all("not comparable" in r.observed_text for r in rows)


def test_bounds_of_mixed_number_types_are_checked():
    with pytest.raises(ValueError):
        pl.expect_column_values_to_be_between("x", min_value=10, max_value=1.0)


def test_moments_inside_a_day_are_no_dates(spark):
    df = spark.sql("SELECT DATE '2024-01-01' AS d")
    noon = datetime.datetime(2024, 1, 1, 12)
    assert not one(df, pl.expect_column_values_to_be_between("d", min_value=noon)).success
    assert one(df, pl.expect_column_values_to_be_between("d", max_value=noon)).success
    assert not one(df, pl.expect_column_values_to_be_in_set("d", [noon])).success
    assert one(df, pl.expect_column_values_to_not_be_in_set("d", [noon])).success
    assert not one(df, pl.expect_column_distinct_values_to_contain_set("d", [noon])).success
    assert one(df, pl.expect_column_distinct_values_to_contain_set("d", [datetime.datetime(2024, 1, 1)])).success


def test_a_constraint_that_fails_as_it_runs(spark):
    bad, good = pl.Suite([
        pl.expect_query_to_return_no_rows("SELECT * FROM {table} WHERE CAST(c AS INT) > 0", check_id="a"),
        pl.expect_query_to_return_no_rows("SELECT * FROM {table} WHERE c = 'y'", check_id="b"),
    ]).verdicts(spark.sql("SELECT 'x' AS c")).orderBy("check_id").collect()
    assert not bad.success and "CAST_INVALID_INPUT" in bad.observed_text and good.success
