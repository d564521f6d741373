"""Comparison by digests of key ranges: the counts of a whole comparison, and only differing ranges read again."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

import plumbline as pl
from plumbline.operators import digests as D
from tests.helpers import scan_metrics


def verdicts(frame):
    return {r.check_id.split("_")[-1]: (r.element_count, r.unexpected_count, r.success) for r in frame.collect()}


def same_as_whole(left, right, on, columns=None, listed=True, **limits):
    columns = columns or left.columns
    got = verdicts(pl.compare_digests(left, right, on, columns, **limits))
    assert got == verdicts(pl.compare_rows(left, right, columns))
    if not listed:
        return got
    key = lambda rows: sorted(map(repr, (tuple(r) for r in rows)))
    assert key(pl.digest_differences(left, right, on, columns, **limits).collect()) == key(pl.row_differences(left, right, columns).collect())
    return got


KEYS = {
    "whole": "id", "negative": "id - 5000", "small": "CAST(id % 100 AS TINYINT)", "far apart": "IF(id = 77, 9223372036854775807, IF(id = 78, -9223372036854775807 - 1, id))",
    "date": "date_add(DATE'2000-01-01', CAST(id AS INT))", "time": "timestamp_micros(id * 1000003)", "local time": "CAST(timestamp_micros(id * 7) AS TIMESTAMP_NTZ)",
    "text": "concat('k', id)", "float": "id / 7", "decimal": "CAST(id AS DECIMAL(30, 2))", "nulls": "IF(id % 3 = 0, NULL, id)", "all null": "CAST(NULL AS BIGINT)", "one value": "1",
}


@pytest.mark.parametrize("name, few_rows", [*[(name, 0) for name in KEYS], ("whole", 100_000), ("text", 100_000), ("nulls", 100_000)])
def test_keys_of_all_kinds(spark, name, few_rows):
    left = spark.range(3000).selectExpr(f"{KEYS[name]} AS k", "id % 11 AS v")
    right = spark.range(3000).filter("id <> 1234").selectExpr(f"{KEYS[name]} AS k", "IF(id IN (5, 6, 2500), -1, id % 11) AS v")
    got = same_as_whole(left, right, ["k"], listed=few_rows > 0, few_rows=few_rows, ranges=64)
    assert got["right"][1] >= 1 and not got["right"][2]
    assert all(ok and n == 0 for _, n, ok in verdicts(pl.compare_digests(left, left.repartition(5), ["k"], few_rows=few_rows)).values())


def test_bags_and_keys_of_several_columns(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, "a", "b", "c"]), rng.randrange(5), rng.randrange(3)) for _ in range(400)]
    left = spark.createDataFrame(rows, "a string, b int, c int").repartition(3)
    right = spark.createDataFrame(rows[7:] + rows[20:23] + [(None, None, 1)], "a string, b int, c int")
    same_as_whole(left, right, ["a", "b"], few_rows=3)
    same_as_whole(left, right, ["a"], few_rows=0)


def test_empty_tables_and_repeated_rows(spark):
    some = spark.createDataFrame([(1, "x"), (1, "x")], "k bigint, v string")
    none = some.limit(0)
    assert same_as_whole(some, none, ["k"]) == {"right": (2, 2, False), "left": (0, 0, True)}
    assert same_as_whole(none, none, ["k"]) == {"right": (0, 0, True), "left": (0, 0, True)}
    once = some.limit(1)
    assert same_as_whole(some, once, ["k"]) == {"right": (2, 1, False), "left": (1, 0, True)}
    # an even number of copies does not cancel out
    assert same_as_whole(some.union(some), some.limit(0).union(some), ["k"])["right"] == (4, 2, False)


def test_numbers_of_other_types_and_names_that_clash(spark):
    left = spark.range(100).selectExpr("id AS place", "CAST(id AS INT) AS cell", "CAST(id AS DECIMAL(10, 2)) AS n")
    right = spark.range(100).selectExpr("CAST(id AS INT) AS place", "id AS cell", "CAST(id AS DOUBLE) + IF(id = 3, 0.25, 0) AS n")
    assert same_as_whole(left, right, ["place"])["left"] == (100, 1, False)
    failed = pl.compare_digests(left, right.withColumn("n", F.lit("x")), ["place"], ["n"]).collect()
    assert all(not r.success and "StringType" in r.observed_text for r in failed)
    with pytest.raises(ValueError):
        pl.digest_differences(left, right.withColumn("n", F.lit("x")), ["place"], ["n"])


def test_one_differing_row_reads_one_range_again(spark, tmp_path):
    """Of a table of 400,000 rows in key order, the second read gets the differing range's row group alone."""
    rows = spark.range(0, 400_000, 1, 8).selectExpr("id AS k", "id * 3 AS v")
    rows.write.parquet(str(tmp_path / "l"))
    rows.withColumn("v", F.when(F.col("k") == 123_456, -1).otherwise(F.col("v"))).write.parquet(str(tmp_path / "r"))
    left, right = (spark.read.parquet(str(tmp_path / x)) for x in "lr")
    found = D.differing_ranges(left, right, ["k"], ["k", "v"], few_rows=2000)
    assert len(found.ranges) == 1 and found.levels == 1 and found.held <= 2 * 400 and not found.nulls
    low, high = found.ranges[0]
    assert low <= 123_456 <= high and high - low < 400
    again = D._read_again(left, right, ["k"], found)
    for side in again:
        assert max(scan_metrics(side, "numOutputRows")) <= 50_000  # of the one file's row group
    text = pl.compare_digests(left, right, ["k"], few_rows=2000).first().observed_text
    assert text.startswith(f"{found.held} of 800000 rows compared, 1 ranges")


def test_a_shuffle_carries_ranges_not_rows(spark):
    left = spark.range(0, 100_000, 1, 4).selectExpr("id AS k", "id AS v")
    place = F.col("k")
    seen = D._digests(left, place, [F.col("k"), F.col("v")], [(0, 99_999, 1000)])
    assert seen.count() == 100
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_xor" in plan and plan.count("Exchange") == 1


def test_many_places_are_joined_to_few(spark):
    ranges = [(i * 10, i * 10 + 1) for i in range(500)]
    joined = D._joined(ranges)
    assert len(joined) == D.APART and joined[0][0] == 0 and joined[-1][1] == 4991
    assert D._joined([(5, 6), (7, 9), (20, 20)]) == [(5, 9), (20, 20)]
    left = spark.range(20_000).selectExpr("id AS k", "id AS v")
    right = left.withColumn("v", F.when(F.col("k") % 97 == 0, 0).otherwise(F.col("v")))
    same_as_whole(left, right, ["k"], few_rows=10, ranges=64)


def test_dates_prune(spark):
    day = datetime.date(2024, 1, 1)
    left = spark.range(1000).selectExpr("date_add(DATE'2024-01-01', CAST(id % 100 AS INT)) AS d", "id AS v")
    right = left.filter(~((F.col("d") == day) & (F.col("v") == 0)))
    found = D.differing_ranges(left, right, ["d"], ["d", "v"], few_rows=1)
    assert found.ranges == [(19723, 19723)]
    plan = D._read_again(left, right, ["d"], found)[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "2024-01-01" in plan
