"""Validation by slice: equal to a run over the whole table, and only new slices are read."""

import datetime
import decimal
import random

import pytest
from pyspark.sql import functions as F

import plumbline as pl
from plumbline.plans import incremental as I

D = decimal.Decimal
SCHEMA = "day date, x double, i bigint, m decimal(10,2), s string"


def rules():
    return [
        pl.expect_column_values_to_not_be_null("s", mostly=0.7), pl.expect_column_values_to_be_between("x", 0, 50, mostly=0.5), pl.expect_column_values_to_be_in_set("s", ["a", "b"]),
        pl.expect_column_pair_values_a_to_be_greater_than_b("x", "i"), pl.expect_column_max_to_be_between("i", 0, None), pl.expect_column_min_to_be_between("s", "a", None),
        pl.expect_column_max_to_be_between("day", datetime.date(2020, 1, 1), None), pl.expect_column_mean_to_be_between("x", 10, None), pl.expect_column_mean_to_be_between("m", 0, None),
        pl.expect_column_sum_to_be_between("i", 0, None), pl.expect_column_sum_to_be_between("m", 0, None), pl.expect_column_stdev_to_be_between("x", 0, 1000),
        pl.expect_table_row_count_to_be_between(1, 10_000), pl.expect_column_values_to_be_unique("i"), pl.expect_column_unique_value_count_to_be_between("s", 1, 3),
        pl.expect_compound_columns_to_be_unique(["i", "s"], ignore_row_if="never"), pl.expect_compound_columns_to_be_unique(["i", "s"], ignore_row_if="any_value_is_missing", check_id="complete"),
        pl.expect_column_distinct_values_to_contain_set("s", ["a"]), pl.expect_column_most_common_value_to_be_in_set("s", ["a"]), pl.expect_column_values_to_be_in_set("i", range(2000)),
        pl.expect_column_kl_divergence_to_be_less_than("s", {"values": ["a", "b", "c"], "weights": [0.4, 0.3, 0.3]}, 1.0), pl.expect_column_median_to_be_between("x", 0, None),
        pl.expect_query_to_return_no_rows("SELECT * FROM {table} WHERE x > 90"), pl.expect_column_unique_value_count_to_be_between("i", 1, None, approx=True),
        pl.expect_column_to_exist("s"), pl.expect_column_values_to_not_be_null("nowhere"), pl.expect_column_mean_to_be_between("s", 0, 1),
    ]


def rows(rng, days, n):
    return [
        (rng.choice(days), rng.choice([None, rng.uniform(0, 100)]), rng.randrange(3000), D(rng.randrange(100000)).scaleb(-2), rng.choice([None, "a", "b", "c"])) for _ in range(n)
    ]


def seen(verdicts):
    out = {}
    for r in verdicts.collect():
        row = r.asDict()
        text = row.pop("observed_text")
        out[r.check_id] = {k: round(v, 6) if isinstance(v, float) else v for k, v in row.items()} | ({} if text is None or row["observed_num"] is not None else {"text": text})
    return out


DAYS = [datetime.date(2024, 1, 1) + datetime.timedelta(k) for k in range(6)]


def test_equal_to_a_whole_run_as_slices_come_go_and_change(spark, tmp_path):
    rng = random.Random(1)
    suite, folder = pl.Suite(rules()), str(tmp_path / "states")
    first = spark.createDataFrame(rows(rng, DAYS[:3], 200), SCHEMA).repartition(3)
    more = spark.createDataFrame(rows(rng, [*DAYS[3:], None], 150), SCHEMA).repartition(3)
    both = first.union(more)
    pl.verdicts_by_slice(suite, first, "day", folder)
    whole = seen(suite.verdicts(both))
    assert seen(pl.verdicts_by_slice(suite, both, "day", folder)) == whole
    # a slice is gone
    less = both.filter(F.col("day").isNull() | (F.col("day") != DAYS[1]))
    assert seen(pl.verdicts_by_slice(suite, less, "day", folder)) == seen(suite.verdicts(less))
    # a slice has other rows now: seen only when it is named
    changed = both.withColumn("s", F.when(F.col("day") == DAYS[0], "c").otherwise(F.col("s")))
    kept = [r for r in pl.Suite(rules()).rules if I._mergeable(r)]
    old = seen(pl.verdicts_by_slice(suite, changed, "day", folder))
    assert all(old[r.check_id] == whole[r.check_id] for r in kept if r.check_id in old and r.columns == ("s",))
    assert seen(pl.verdicts_by_slice(suite, changed, "day", folder, refresh=[DAYS[0]])) == seen(suite.verdicts(changed))


def test_one_new_slice_is_the_only_one_read(spark, tmp_path):
    """Files of known slices may even be unreadable."""
    table, folder = str(tmp_path / "t"), str(tmp_path / "states")
    rng = random.Random(2)
    spark.createDataFrame(rows(rng, DAYS[:2], 100), SCHEMA).write.partitionBy("day").parquet(table)
    suite = pl.Suite([r for r in pl.Suite(rules()).rules if I._mergeable(r) and "nowhere" not in r.columns])
    want_old = seen(pl.verdicts_by_slice(suite, spark.read.schema(SCHEMA).parquet(table), "day", folder))
    spark.createDataFrame(rows(rng, DAYS[2:3], 50), SCHEMA).write.mode("append").partitionBy("day").parquet(table)
    whole = seen(suite.verdicts(spark.read.schema(SCHEMA).parquet(table)))
    for old in (tmp_path / "t").glob("day=2024-01-0[12]/*.parquet"):
        data = bytearray(old.read_bytes())
        data[4:40] = b"\xff" * 36  # the first data page; the footer, which has the number of rows, stays
        old.write_bytes(bytes(data))
        (old.parent / f".{old.name}.crc").unlink(missing_ok=True)
    assert seen(pl.verdicts_by_slice(suite, spark.read.schema(SCHEMA).parquet(table), "day", folder)) == whole != want_old


def test_a_run_that_broke_off_counts_for_nothing(spark, tmp_path, monkeypatch):
    rng = random.Random(4)
    df = spark.createDataFrame(rows(rng, DAYS, 60), SCHEMA)
    suite, folder = pl.Suite(rules()), str(tmp_path / "states")
    honest = I.local_frame
    with monkeypatch.context() as broken:
        broken.setattr(I, "local_frame", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            pl.verdicts_by_slice(suite, df, "day", folder)
    assert I.local_frame is honest
    assert seen(pl.verdicts_by_slice(suite, df, "day", folder)) == seen(suite.verdicts(df))


def test_another_suite_begins_anew_and_an_empty_table_has_no_slices(spark, tmp_path):
    folder = str(tmp_path / "states")
    df = spark.createDataFrame(rows(random.Random(5), DAYS, 40), SCHEMA)
    assert seen(pl.verdicts_by_slice(pl.Suite(rules()), df.limit(0), "day", folder)) == seen(pl.Suite(rules()).verdicts(df.limit(0)))
    for high in (20, 60):
        suite = pl.Suite([pl.expect_column_values_to_be_between("x", 0, high, check_id="x")])
        assert seen(pl.verdicts_by_slice(suite, df, "day", folder)) == seen(suite.verdicts(df))


@pytest.mark.parametrize("column", ["x", "s", "i"])
def test_slices_of_other_types(spark, tmp_path, column):
    df = spark.createDataFrame(rows(random.Random(6), DAYS, 30), SCHEMA)
    suite = pl.Suite([pl.expect_column_sum_to_be_between("i", 0, None), pl.expect_column_values_to_be_unique("s")])
    assert seen(pl.verdicts_by_slice(suite, df.filter("i > 1000"), column, str(tmp_path))) == seen(suite.verdicts(df.filter("i > 1000")))
    assert seen(pl.verdicts_by_slice(suite, df, column, str(tmp_path), refresh=[r[0] for r in df.select(column).collect()])) == seen(suite.verdicts(df))


def test_approximate_quantiles_merge(spark, tmp_path):
    df = spark.range(20_000).selectExpr("id % 4 AS part", "CAST(id AS DOUBLE) AS x", "CAST(null AS DOUBLE) AS nothing")
    suite = pl.Suite([pl.expect_column_median_to_be_between("x", 9900, 10_100, approx=True), pl.expect_column_median_to_be_between("nothing", 0, 1, approx=True)])
    pl.verdicts_by_slice(suite, df.filter("part < 2"), "part", str(tmp_path))
    x, nothing = sorted(pl.verdicts_by_slice(suite, df, "part", str(tmp_path)).collect(), key=lambda r: r.columns, reverse=True)
    assert x.success and x.element_count == 20_000 and not nothing.success and nothing.missing_count == 20_000
