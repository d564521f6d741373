"""History of runs, newest slices from file statistics, constraints that share a scan, renamed columns."""

import datetime
import math
import statistics

import pytest
from pyspark.sql import functions as F

import plumbline as pl
from plumbline.operators import constraints
from plumbline.operators import schema as S
from tests.helpers import scan_metrics

# ------------------------------------------------------------------ history


def recorded(spark, path, values, check=None):
    check = check or (lambda: pl.expect_column_mean_to_be_between("x", 0, 10, check_id="mean"))
    for k, v in enumerate(values):
        df = spark.createDataFrame([(v,)], "x double")
        pl.record_run(pl.Suite([check()]).verdicts(df), path, datetime.datetime(2024, 1, 1) + datetime.timedelta(days=k), f"run{k:02d}")


def test_trend_of_a_check(spark, tmp_path):
    values = [5.0, 6.0, 5.5, 30.0, 12.0, 5.2, None, 5.1]
    recorded(spark, str(tmp_path), values)
    found = sorted(pl.trend(pl.history(spark, str(tmp_path)), earlier=3).collect(), key=lambda r: r.run_id)
    assert [r.observed for r in found] == values
    assert [r.failing_runs for r in found] == [0, 0, 0, 1, 2, 0, 1, 0] and [r.turned for r in found] == [False, False, False, True, False, True, True, True]
    for k, r in enumerate(found):
        before = [v for v in values[max(0, k - 3) : k] if v is not None]
        assert r.earlier_runs == len(before) and r.previous == (values[k - 1] if k else None)
        assert (r.mean is None) == (not before) and (not before or math.isclose(r.mean, statistics.mean(before)))
        if len(before) < 2 or values[k] is None:
            assert r.unusual is None
        else:
            assert r.unusual == (abs(values[k] - statistics.mean(before)) > 3 * statistics.stdev(before))
    assert found[3].unusual and math.isclose(found[3].change, 24.5)


def test_runs_are_appended_and_counted_once(spark, tmp_path):
    path = str(tmp_path / "runs")
    recorded(spark, path, [1.0, 2.0])
    verdicts = pl.Suite([pl.expect_column_mean_to_be_between("x", 0, 10, check_id="mean")]).verdicts(spark.createDataFrame([(7.0,)], "x double"))
    again = pl.record_run(verdicts, path, datetime.datetime(2024, 3, 1), "run01")
    new = pl.record_run(verdicts, path)
    seen = {r.run_id: r.observed_num for r in pl.history(spark, path).collect()}
    assert seen == {"run00": 1.0, "run01": 7.0, new: 7.0} and again == "run01"
    assert pl.history(spark, path).filter(F.col("run_id") == new).first().run_time > datetime.datetime(2024, 3, 1)


def test_checks_that_count_rows_and_checks_that_observe_nothing(spark, tmp_path):
    recorded(spark, str(tmp_path / "a"), [1.0, 20.0], lambda: pl.expect_column_values_to_be_between("x", 0, 10, check_id="rows"))
    assert [r.observed for r in sorted(pl.trend(pl.history(spark, str(tmp_path / "a"))).collect(), key=lambda r: r.run_id)] == [0.0, 100.0]
    recorded(spark, str(tmp_path / "b"), [1.0, 1.0, 1.0], lambda: pl.expect_column_to_exist("y", check_id="there"))
    found = sorted(pl.trend(pl.history(spark, str(tmp_path / "b"))).collect(), key=lambda r: r.run_id)
    assert [(r.observed, r.unusual, r.failing_runs) for r in found] == [(None, None, 1), (None, None, 2), (None, None, 3)]
    recorded(spark, str(tmp_path / "c"), [4.0, 4.0, 4.0, 4.5])
    assert [r.unusual for r in sorted(pl.trend(pl.history(spark, str(tmp_path / "c"))).collect(), key=lambda r: r.run_id)] == [None, None, False, True]


# ------------------------------------------------------------------ newest slice


@pytest.mark.parametrize("column, kind", [("i", "bigint"), ("d", "date"), ("x", "double")])
def test_the_newest_value_comes_from_footers(spark, tmp_path, column, kind):
    """The table's data pages are damaged, its footers are not."""
    path = tmp_path / "t"
    spark.range(0, 1000, 1, 4).selectExpr("id AS i", "date_add(DATE'2024-01-01', CAST(id % 50 AS INT)) AS d", "id / 3 AS x").write.parquet(str(path))
    want = str(spark.read.parquet(str(path)).agg(F.max(column)).first()[0])
    kept = pl.newest_slice(spark, str(path), column).count()
    assert kept == (20 if column == "d" else 1)
    for file in path.glob("*.parquet"):
        data = bytearray(file.read_bytes())
        data[4:64] = b"\xff" * 60
        file.write_bytes(bytes(data))
        (path / f".{file.name}.crc").unlink(missing_ok=True)
    assert pl.newest_value(spark, str(path), column) == want
    # and the caller's session reads as before
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_newest_slices_of_other_columns(spark, tmp_path):
    rows = spark.range(100).selectExpr("id", "concat('2024-0', 1 + id % 3) AS month", "CAST(20240100 + id % 4 AS INT) AS yyyymmdd", "CAST(timestamp_micros(id) AS TIMESTAMP_NTZ) AS t")
    rows.write.partitionBy("month", "yyyymmdd").parquet(str(tmp_path / "t"))
    for column in ("month", "yyyymmdd", "t", "id"):
        newest = pl.newest_slice(spark, str(tmp_path / "t"), column)
        assert sorted(newest.collect()) == sorted(pl.latest_slice(spark.read.parquet(str(tmp_path / "t")), column).collect())
    assert scan_metrics(pl.newest_slice(spark, str(tmp_path / "t"), "yyyymmdd"), "numFiles") == [len(list((tmp_path / "t").glob("*/yyyymmdd=20240103/*.parquet")))]
    rows.filter("id < 0").write.parquet(str(tmp_path / "none"))
    assert pl.newest_slice(spark, str(tmp_path / "none"), "id").count() == 0 and pl.newest_value(spark, str(tmp_path / "none"), "id") is None


# ------------------------------------------------------------------ constraints


FILTERS = ["SELECT * FROM {table} WHERE x > 1", "SELECT x + 1 AS x FROM {table} WHERE {table}.x > 1 AND y IS NULL", "SELECT * FROM (SELECT * FROM {table} WHERE x > 0) WHERE y <> 'it''s'"]
OTHERS = [
    "SELECT -x AS x FROM (SELECT -x AS x, y FROM {table}) WHERE x > 1", "SELECT x FROM {table} GROUP BY x HAVING count(*) > 1", "SELECT * FROM {table} LIMIT 1", "SELECT DISTINCT x FROM {table} WHERE x > 1",
    "SELECT * FROM {table} WHERE x IN (SELECT max(x) FROM {table})", "SELECT * FROM {table} WHERE rand() > 2", "SELECT a.x FROM {table} a JOIN {table} b ON a.x = b.x WHERE a.x > 1", "SELECT 1 AS one",
    "SELECT x FROM {table} WHERE x > 1 UNION ALL SELECT x FROM {table}", "SELECT explode(array(1, 2)) AS e FROM {table} WHERE x > 1", "SELECT sum(x) OVER () AS s FROM {table} WHERE x > 1", "SELECT * FROM {table} WHERE nowhere > 1",
    "SELECT * FROM {table} t WHERE t.x > 1",
]


@pytest.fixture
def pairs(spark):
    return spark.createDataFrame([(1, "a"), (2, None), (2, "it's"), (3, "c"), (None, "d")], "x int, y string")


def test_filters_are_told_from_other_queries(pairs):
    assert all(constraints.filter_of(pairs, q) is not None for q in FILTERS)
    assert all(constraints.filter_of(pairs, q) is None for q in OTHERS)
    assert not [t for t in pairs.sparkSession.catalog.listTables() if t.name.startswith("table_under_test")]


def test_same_verdicts_in_one_scan(pairs, monkeypatch):
    queries = [q for q in FILTERS + OTHERS if "LIMIT" not in q]
    suite = pl.Suite([pl.expect_query_to_return_no_rows(q, check_id=q) for q in queries])
    shared = {r.check_id: (r.success, r.unexpected_count, r.observed_num) for r in suite.verdicts(pairs).collect()}
    alone = []
    monkeypatch.setattr(constraints, "constraint_verdict", lambda df, rule, f=constraints.constraint_verdict: (alone.append(rule.check_id), f(df, rule))[1])
    again = {r.check_id: (r.success, r.unexpected_count, r.observed_num) for r in suite.verdicts(pairs).collect()}
    assert again == shared and set(alone) == {q for q in OTHERS if "LIMIT" not in q}
    monkeypatch.setattr(constraints, "filter_of", lambda df, q: None)
    assert {r.check_id: (r.success, r.unexpected_count, r.observed_num) for r in suite.verdicts(pairs).collect()} == shared


def test_a_condition_that_fails_on_a_row_fails_alone(pairs):
    queries = {"fine": FILTERS[0], "divides": "SELECT * FROM {table} WHERE 10 / (x - 1) > 1", "casts": "SELECT * FROM {table} WHERE CAST(y AS INT) > 1", "none": "SELECT * FROM {table} WHERE x > 9"}
    found = {r.check_id: r for r in pl.Suite([pl.expect_query_to_return_no_rows(q, check_id=n) for n, q in queries.items()]).verdicts(pairs).collect()}
    assert found["none"].success and found["fine"].unexpected_count == 3
    assert not found["divides"].success and "DIVIDE_BY_ZERO" in found["divides"].observed_text and not found["casts"].success


def test_names_that_need_quotes(spark):
    df = spark.createDataFrame([(1, 2), (5, 1)], "`a.b` int, `x``y` int")
    query = "SELECT * FROM {table} WHERE `a.b` > `x``y`"
    assert constraints.filter_of(df, query) is not None
    rows = pl.Suite([pl.expect_query_to_return_no_rows(query, check_id=str(k)) for k in range(2)]).verdicts(df).collect()
    assert [r.unexpected_count for r in rows] == [1, 1]


# ------------------------------------------------------------------ renamed columns


def changes(old, new, **more):
    return {(r.change, r.old_column, r.new_column): r for r in pl.schema_renames(old, new, **more).collect()}


def test_columns_of_each_fate(spark):
    old = spark.range(1000).selectExpr("id", "id % 7 AS week", "concat('n', id % 100) AS name", "CAST(id AS DOUBLE) AS amount", "id % 2 = 0 AS even", "date_add(DATE'2024-01-01', CAST(id % 90 AS INT)) AS day", "'x' AS gone")
    new = spark.range(100, 1000).selectExpr("id", "CAST(id % 2 = 0 AS BOOLEAN) AS is_even", "concat('n', id % 100) AS label", "CAST(id % 7 AS INT) AS weekday", "CAST(id AS STRING) AS amount", "CAST(date_add(DATE'2024-01-01', CAST(id % 90 AS INT)) AS TIMESTAMP) AS moment", "0.5 AS come")
    found = changes(old, new)
    assert set(found) == {
        ("same", "id", "id"), ("retyped", "amount", "amount"), ("renamed", "week", "weekday"), ("renamed", "name", "label"), ("renamed", "even", "is_even"), ("renamed", "day", "moment"),
        ("removed", "gone", None), ("added", None, "come"),
    }
    assert found["renamed", "week", "weekday"].likeness == 1 and found["renamed", "week", "weekday"].new_type == "IntegerType"


def test_likeness_is_the_share_of_common_values(spark):
    old = spark.range(100).selectExpr("id AS a", "id + 1000 AS b")
    new = spark.range(100).selectExpr("id + 1010 AS c", "id + 25 AS d")
    found = changes(old, new)
    assert found["renamed", "a", "d"].likeness == pytest.approx(75 / 125) and found["renamed", "b", "c"].likeness == pytest.approx(90 / 110)
    assert ("removed", "a", None) in changes(old, new, like=0.7)


def test_ties_go_to_the_nearer_column_and_empty_columns_to_their_place(spark):
    old = spark.range(10).selectExpr("id AS a", "id AS b", "CAST(NULL AS STRING) AS c")
    new = spark.range(10).selectExpr("id AS p", "id AS q", "CAST(NULL AS STRING) AS r")
    assert set(changes(old, new)) == {("renamed", "a", "p"), ("renamed", "b", "q"), ("renamed", "c", "r")}
    moved = spark.range(10).selectExpr("CAST(NULL AS STRING) AS r", "id AS p", "id AS q")
    assert set(changes(old, moved)) == {("renamed", "b", "p"), ("renamed", "a", "q"), ("removed", "c", None), ("added", None, "r")}


def test_order_many_columns_and_types_that_do_not_compare(spark, monkeypatch):
    monkeypatch.setattr(S, "TOGETHER", 4)
    old = spark.range(50).select("id", *[(F.col("id") * (k + 2)).alias(f"a{k}") for k in range(9)], F.create_map(F.lit(1), F.lit(2)).alias("m"))
    new = spark.range(50).select(F.create_map(F.lit(1), F.lit(2)).alias("n"), *[(F.col("id") * (k + 2)).alias(f"b{k}") for k in reversed(range(9))], "id")
    found = changes(old, new)
    assert {k for k in found if k[0] == "renamed"} == {("renamed", f"a{k}", f"b{k}") for k in range(9)}
    assert ("removed", "m", None) in found and ("added", None, "n") in found and ("same", "id", "id") in found
    swapped = spark.range(3).selectExpr("1 AS x", "2 AS y", "3 AS z")
    assert {k[0] for k in changes(swapped, swapped.select("y", "x", "z"))} == {"moved", "same"}
    assert set(changes(swapped, swapped)) == {("same", c, c) for c in "xyz"} and changes(swapped.select(), swapped.select()) == {}
