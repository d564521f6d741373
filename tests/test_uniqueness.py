"""Uniqueness by counting filter: the same verdicts as the frequency table, and next to no rows shuffled."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import plumbline as pl
from plumbline.operators import uniqueness as U
from tests.helpers import counts, one, plan_of, run


def both(df, rule, **arguments):
    """Verdicts of the filter and of the frequency table."""
    return [one(df, rule(**arguments, few_repeats=few, check_id="c")) for few in (True, False)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**U.BITS - 1), max_size=40))
def test_packed_numbers_come_back(values):
    values = np.unique(np.array(values, np.uint64))
    assert U.unpacked(U.packed(values)).tolist() == values.tolist()


def test_gaps_take_few_bytes():
    values = np.cumsum(np.random.default_rng(1).integers(1, 60_000, 100_000)).astype(np.uint64)
    assert len(U.packed(values)) < 2.01 * len(values)


@pytest.mark.parametrize("partitions", [1, 7])
def test_columns(spark, partitions):
    rng = random.Random(3)
    shapes = {
        "unique": [str(i) for i in range(500)],
        "some": [rng.choice([None, str(rng.randrange(300))]) for _ in range(500)],
        "hot": ["x"] * 200 + [str(i) for i in range(300)],
        "nulls": [None] * 30,
        "empty": [],
    }
    for values in shapes.values():
        df = spark.createDataFrame([(v,) for v in values], "c string").repartition(partitions)
        got, want = both(df, pl.expect_column_values_to_be_unique, column="c", mostly=0.5)
        assert got.asDict() == want.asDict()


@pytest.mark.parametrize("policy", ["never", "any_value_is_missing", "all_values_are_missing"])
def test_keys_with_nulls(spark, policy):
    rows = [(1, None), (1, None), (None, None), (None, None), (None, "1"), (1, "a"), (2, "a"), (2, "a")]
    df = spark.createDataFrame(rows, "a int, b string").repartition(3)
    got, want = both(df, pl.expect_compound_columns_to_be_unique, column_list=["a", "b"], ignore_row_if=policy)
    assert got.asDict() == want.asDict() and got.unexpected_count == {"never": 6, "any_value_is_missing": 2, "all_values_are_missing": 4}[policy]


def test_values_that_are_equal_but_spelt_differently(spark):
    df = spark.sql("SELECT * FROM VALUES (0.0D), (-0.0D), (CAST('NaN' AS DOUBLE)), (CAST('NaN' AS DOUBLE)), (1.0D) AS t(c)")
    got, want = both(df, pl.expect_column_values_to_be_unique, column="c")
    assert got.asDict() == want.asDict() and got.unexpected_count == 4


def test_keys_that_share_a_hash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(U, "BITS", 6)  # 64 hashes for 1,000 keys
    df = spark.range(1000).selectExpr("id AS c").union(spark.range(3).selectExpr("id AS c"))
    assert counts(one(df, pl.expect_column_values_to_be_unique("c", few_repeats=True))) == (1003, 0, 6)


def test_a_task_passes_its_sets_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(U, "FOLD", 10)
    prints = U.fingerprints(spark.range(100, numPartitions=1).selectExpr("id % 90 AS c"), ["c"], "never")
    parts = list(U._folded(4)(iter(prints.select("print").toArrow().to_batches(max_chunksize=7))))
    assert len(parts) > 5 and sum(sum(p.column("rows").to_pylist()) for p in parts) == 100


def test_a_unique_key_shuffles_no_rows(spark):
    """What leaves the tasks of the first pass is a few bytes a row in a few rows; the second pass has nothing to do."""
    df = spark.range(0, 400_000, 1, 4).selectExpr("concat('order-', id) AS c")
    prints = U.fingerprints(df, ["c"], "never")
    sets = U.folded(prints, 8).collect()
    assert len(sets) == 4 * 8
    assert sum(len(s["once"]) + len(s["more"]) for s in sets) < 7 * 400_000
    count, missing, suspects = U.suspected(prints)
    assert (count, missing, len(suspects)) == (400_000, 0, 0)
    repeated = df.union(df.limit(5))
    prints = U.fingerprints(repeated, ["c"], "never")
    possible = U.possible_repeats(prints, U.suspected(prints)[2])
    assert possible.count() == 10
    # those rows meet the hashes where they are read, and are shuffled after that
    assert "BroadcastHashJoin" in plan_of(possible) and "Exchange hashpartitioning" not in plan_of(possible)
    assert counts(one(repeated, pl.expect_column_values_to_be_unique("c", few_repeats=True))) == (400_005, 0, 10)


def test_many_repeats_fall_back_to_the_frequency_table(spark, monkeypatch):
    called = []
    monkeypatch.setattr(U, "SUSPECTS", 256)
    monkeypatch.setattr(U, "frequency_verdicts", lambda df, rules, f=U.frequency_verdicts: (called.append(1), f(df, rules))[1])
    df = spark.range(20_000).selectExpr("id % 10000 AS c")
    assert counts(one(df, pl.expect_column_values_to_be_unique("c", few_repeats=True))) == (20_000, 0, 20_000) and called


def test_other_checks_of_the_column_take_the_table_for_all(spark):
    df = spark.range(10).selectExpr("CAST(id AS string) AS c")
    rows = run(df, pl.expect_column_values_to_be_unique("c", few_repeats=True, check_id="a"), pl.expect_column_distinct_values_to_contain_set("c", ["3"], check_id="b"))
    assert all(r.success for r in rows)
    rows = run(df, pl.expect_column_values_to_be_unique("c", few_repeats=True, check_id="a"), pl.expect_column_unique_value_count_to_be_between("c", 10, 10, check_id="b"))
    assert all(r.success for r in rows)


def test_clashing_names_and_failing_values(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, 2, 4)], "print int, suspect int, k0 int")
    assert one(df, pl.expect_compound_columns_to_be_unique(["print", "suspect"], few_repeats=True)).unexpected_count == 2
    assert one(df, pl.expect_column_values_to_be_unique("k0", few_repeats=True)).success
    suite = pl.Suite([pl.expect_column_values_to_be_unique("print", few_repeats=True)])
    assert [(r.value, r.n) for r in suite.failing_values(df).collect()] == [("1", 2)]


def test_collated_texts_keep_to_the_table(spark):
    df = spark.sql("SELECT c COLLATE UTF8_LCASE AS c FROM VALUES ('a'), ('A'), ('b') AS t(c)")
    assert one(df, pl.expect_column_values_to_be_unique("c", few_repeats=True)).unexpected_count == 2
