"""Suites, schema contracts, constraints, comparisons, sources, reports and evidence."""

import datetime
import hashlib
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import plumbline as pl
from plumbline.operators import members
from tests.helpers import one, plan_of, run, scan_metrics


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [(1, "ann", 30.0), (2, "bob", None), (3, "cy", 50.0), (3, None, 70.0)], "id bigint, name string, age double"
    ).cache()


# ------------------------------------------------------------------ schema


def test_schema_rules(people):
    good = [
        pl.expect_column_to_exist("age"),
        pl.expect_column_values_to_be_of_type("age", "DoubleType"),
        pl.expect_column_values_to_be_in_type_list("id", ["IntegerType", "LongType"]),
        pl.expect_table_column_count_to_be_between(2, 3),
        pl.expect_table_column_count_to_equal(3),
        pl.expect_table_columns_to_match_ordered_list(["id", "name", "age"]),
        pl.expect_table_columns_to_match_set({"age", "name", "id"}),
    ]
    bad = [
        pl.expect_column_to_exist("AGE"),
        pl.expect_column_values_to_be_of_type("age", "FloatType"),
        pl.expect_column_values_to_be_of_type("nope", "FloatType"),
        pl.expect_column_values_to_be_in_type_list("id", ["StringType"]),
        pl.expect_table_column_count_to_be_between(4, None),
        pl.expect_table_column_count_to_equal(4),
        pl.expect_table_columns_to_match_ordered_list(["name", "id", "age"]),
        pl.expect_table_columns_to_match_set({"age", "name"}),
    ]
    assert [r.success for r in run(people, *good)] == [True] * len(good)
    assert [r.success for r in run(people, *bad)] == [False] * len(bad)


def test_schema_drift(spark, people):
    contract = {"people": [("name", "StringType"), ("id", "IntegerType"), ("age", "DoubleType"), ("city", "StringType")]}
    rows = pl.schema_drift({"people": people.withColumn("zip", F.lit(1))}, contract).collect()
    assert {(r.column_name, r.drift) for r in rows} == {
        ("name", "moved"), ("id", "retyped"), ("city", "missing"), ("zip", "extra")
    }
    same = {"people": [("id", "LongType"), ("name", "StringType"), ("age", "DoubleType")]}
    assert pl.schema_drift({"people": people}, same).count() == 0


# ------------------------------------------------------------------ constraints


def test_constraints(spark, people):
    rows = run(
        people,
        pl.expect_query_to_return_no_rows("SELECT * FROM {table} WHERE id > 2"),
        pl.expect_query_to_return_no_rows("SELECT * FROM {table} WHERE id > 9"),
        pl.expect_query_to_return_no_rows("SELECT 1 WHERE 'a1' RLIKE '[0-9]{4}'"),
        pl.expect_query_to_return_no_rows("SELECT id FROM {table} GROUP BY id HAVING count(*) > 1"),
    )
    assert [(r.success, r.unexpected_count) for r in rows] == [(False, 2), (True, 0), (True, 0), (False, 1)]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("table_under_test")]


def test_a_constraint_that_cannot_be_analysed_fails_alone(people):
    rows = run(
        people,
        pl.expect_query_to_return_no_rows("SELECT * FROM {table} WHERE no_such_column > 2"),
        pl.expect_query_to_return_no_rows("SELEC 1"),
        pl.expect_column_values_to_not_be_null("id"),
    )
    by_text = {r.observed_text: r.success for r in rows}
    assert by_text.pop(None) is True
    assert len(by_text) == 2 and not any(by_text.values()) and any("no_such_column" in t for t in by_text)


# ------------------------------------------------------------------ the suite


def mixed_rules():
    return [
        pl.expect_column_values_to_not_be_null("name", check_id="null"),
        pl.expect_column_values_to_be_between("age", 0, 60, check_id="range"),
        pl.expect_column_max_to_be_between("age", 0, 60, check_id="max"),
        pl.expect_column_median_to_be_between("age", 50, 50, check_id="median"),
        pl.expect_column_median_to_be_between("age", 50, 50, approx=True, check_id="sketch"),
        pl.expect_column_values_to_be_unique("id", check_id="unique"),
        pl.expect_column_unique_value_count_to_be_between("id", 3, 3, check_id="number"),
        pl.expect_compound_columns_to_be_unique(["id", "name"], check_id="key"),
        pl.expect_table_row_count_to_equal(4, check_id="rows"),
        pl.expect_column_to_exist("age", check_id="exists"),
        pl.expect_query_to_return_no_rows("SELECT * FROM {table} WHERE age > 60", check_id="query"),
    ]


EXPECTED = {"null": False, "range": False, "max": False, "median": True, "sketch": True, "unique": False,
            "number": True, "key": True, "rows": True, "exists": True, "query": False}


def test_a_suite_gives_the_verdicts_of_its_checks_alone(people):
    together = {r.check_id: r for r in run(people, *mixed_rules())}
    assert {k: r.success for k, r in together.items()} == EXPECTED
    for rule in mixed_rules():
        assert one(people, rule) == together[rule.check_id]


def test_verdicts_do_not_depend_on_partitioning(people):
    want = sorted(run(people, *mixed_rules()))
    for n in (1, 3, 16):
        assert sorted(run(people.repartition(n), *mixed_rules())) == want


def test_guard_is_case_sensitive(people):
    suite = pl.Suite(
        [
            pl.expect_column_values_to_not_be_null("ID", check_id="a"),
            pl.expect_column_pair_values_to_be_equal("id", "other", check_id="b"),
            pl.expect_column_values_to_not_be_null("id", check_id="c"),
        ]
    )
    assert [r.check_id for r in suite.verdicts(people).collect()] == ["c"]
    assert {tuple(r) for r in suite.skipped(people).select("check_id", "missing_columns").collect()} == {
        ("a", "ID"), ("b", "other")
    }
    assert pl.Suite([pl.expect_column_values_to_not_be_null("x")]).verdicts(people).count() == 0


def test_check_ids(people):
    rule = pl.expect_column_values_to_not_be_null("id")
    assert [r.check_id for r in pl.Suite([rule, rule]).rules] == [
        "expect_column_values_to_not_be_null(id)", "expect_column_values_to_not_be_null(id)#2"
    ]
    with pytest.raises(ValueError, match="unique"):
        pl.Suite([pl.expect_table_row_count_to_equal(1, check_id="a"), pl.expect_table_row_count_to_equal(2, check_id="a")])


def test_staged_source(people):
    rules = [r for r in mixed_rules() if r.check_id != "query"]
    assert sorted(pl.Suite(rules).verdicts(people, stage=True).collect()) == sorted(run(people, *rules))
    with_query = pl.Suite(mixed_rules()).verdicts(people, stage=True)
    assert {r.check_id: r.success for r in with_query.collect()} == EXPECTED
    counting = pl.Suite([pl.expect_table_row_count_to_equal(4)])
    assert counting.verdicts(people, stage=True).first().success
    odd = people.selectExpr("id AS `a.b c`", "null AS nothing")
    rules = [pl.expect_column_values_to_be_null("nothing"), pl.expect_column_values_to_not_be_null("a.b c")]
    assert [r.success for r in pl.Suite(rules).verdicts(odd, stage=True).collect()] == [True, True]


def test_a_staged_source_is_computed_once_and_read_by_column(people):
    slow = people.withColumn("doubled", F.col("age") * 2)
    rules = [pl.expect_column_mean_to_be_between("doubled", 0, 200), pl.expect_column_values_to_be_unique("id")]
    plan = plan_of(pl.Suite(rules).verdicts(slow, stage=True))
    assert "ReadSchema: struct<doubled:double>" in plan and "ReadSchema: struct<id:bigint>" in plan
    assert "InMemoryTableScan" not in plan and "* 2" not in plan


# ------------------------------------------------------------------ statistics, report, evidence


def test_statistics_and_failures(people):
    verdicts = pl.Suite(mixed_rules()).verdicts(people)
    stats = pl.statistics(verdicts).first()
    assert (stats.evaluated_expectations, stats.successful_expectations, stats.unsuccessful_expectations) == (11, 6, 5)
    assert stats.success_percent == pytest.approx(600 / 11)
    assert {r.check_id for r in pl.failures(verdicts).collect()} == {k for k, v in EXPECTED.items() if not v}
    none = pl.statistics(verdicts.filter("false")).first()
    assert none.evaluated_expectations == 0 and none.success_percent is None


def test_report_is_indented_json_in_new_folders(people, tmp_path):
    path = tmp_path / "deep" / "er" / "report"
    pl.write_report(pl.Suite(mixed_rules()).verdicts(people), str(path))
    text = "\n".join(p.read_text() for p in sorted(path.glob("part-*")))
    assert "\n  " in text
    report = json.loads(text)
    assert report["success"] is False
    assert report["statistics"]["evaluated_expectations"] == 11
    by_id = {r["check_id"]: r for r in report["results"]}
    assert by_id["max"]["expectation_config"]["type"] == "expect_column_max_to_be_between"
    assert by_id["max"]["result"]["observed_value"] == 70.0
    assert by_id["null"]["result"]["unexpected_count"] == 1
    assert report["run_id"]["run_time"]


def test_failing_values(spark):
    df = spark.sql(
        "SELECT CAST(id AS STRING) AS c, id % 3 AS d, IF(id < 5, NULL, id) AS e FROM range(100) "
        "UNION ALL SELECT 'hot', 0, 7 FROM range(50)"
    )
    suite = pl.Suite(
        [
            pl.expect_column_values_to_match_regex("c", "^[0-9]$", check_id="regex"),
            pl.expect_column_values_to_not_be_null("e", check_id="null"),
            pl.expect_column_pair_values_to_be_in_set("d", "e", [(0, 7)], check_id="pair"),
            pl.expect_column_distinct_values_to_be_in_set("d", [0, 1], check_id="distinct"),
            pl.expect_column_values_to_be_unique("c", check_id="unique"),
            pl.expect_column_values_to_not_be_in_set("e", range(7, 2000), check_id="large"),
            pl.expect_table_row_count_to_equal(1, check_id="rows"),
            pl.expect_column_to_exist("zz", check_id="schema"),
        ]
    )
    rows = suite.failing_values(df).collect()
    by_id = {}
    totals = {}
    for r in sorted(rows, key=lambda r: (-r.n, r.value or "")):
        by_id.setdefault(r.check_id, []).append((r.value, r.n))
        totals[r.check_id] = (r.distinct_values, r.failing_rows)
    assert by_id["regex"][0] == ("hot", 50) and len(by_id["regex"]) == 20
    # ties of texts in the order of their hashes
    first = sorted(map(str, range(10, 100)), key=lambda v: hashlib.md5(v.encode()).hexdigest())[:19]
    assert {v for v, _ in by_id["regex"][1:]} == set(first)
    assert totals["regex"] == (91, 140) and totals["null"] == (1, 5) and totals["unique"] == (1, 50) and totals["distinct"] == (1, 33)
    for top in (1001, None):
        every = [r for r in suite.failing_values(df, ["regex"], top=top).collect()]
        assert len(every) == 91 and sum(r.n for r in every) == 140 and {r.failing_rows for r in every} == {140}
    assert by_id["null"] == [(None, 5)]
    assert by_id["pair"][0] == ('{"d":0,"e":null}', 2)
    assert by_id["distinct"] == [("2", 33)]
    assert by_id["unique"] == [("hot", 50)]
    assert by_id["large"][0] == ("7", 51)
    assert "rows" not in by_id and "schema" not in by_id
    assert {r.check_id for r in suite.failing_values(df, ["null"], top=3).collect()} == {"null"}
    assert pl.Suite([pl.expect_table_row_count_to_equal(1)]).failing_values(df).count() == 0


# ------------------------------------------------------------------ sources


def test_latest_slice(spark):
    df = spark.sql("SELECT * FROM VALUES (DATE'2024-01-01', 1), (DATE'2024-01-02', 2), (DATE'2024-01-02', 3), (NULL, 4) AS t(d, v)")
    assert {r.v for r in pl.latest_slice(df, "d").collect()} == {2, 3}
    assert pl.latest_slice(df.filter("false"), "d").count() == 0
    numeric = df.selectExpr("CAST(date_format(d, 'yyyyMMdd') AS INT) AS d", "v")
    assert {r.v for r in pl.latest_slice(numeric, "d").collect()} == {2, 3}


def test_today_slice(spark):
    df = spark.sql(
        "SELECT current_date() AS d, current_timestamp() AS t, CAST(date_format(current_date(), 'yyyyMMdd') AS INT) AS n,"
        " date_format(current_date(), 'yyyyMMdd') AS s"
        " UNION ALL SELECT date_sub(current_date(), 1), current_timestamp() - INTERVAL 1 DAY, 19990101, '19990101'"
    )
    assert [pl.today_slice(df, c).count() for c in "dtns"] == [1, 1, 1, 1]
    assert pl.today_slice(df, "n", datetime.date(1999, 1, 1)).count() == 1


def test_latest_slice_reads_one_partition(spark, tmp_path):
    path = str(tmp_path / "parts")
    spark.range(100).selectExpr("id", "CAST(20240100 + id % 5 AS INT) AS day").write.partitionBy("day").parquet(path)
    latest = pl.latest_slice(spark.read.parquet(path), "day")
    assert latest.count() == 20
    assert "PartitionFilters: [isnotnull(day" in plan_of(latest) and "Subquery" in plan_of(latest)
    assert scan_metrics(latest, "numPartitions") == [1]
    assert scan_metrics(spark.read.parquet(path), "numPartitions") == [5]


def test_query_source(spark, people):
    df = pl.query_source(spark, "SELECT age FROM crowd WHERE id = 1", crowd=people)
    assert [r.age for r in df.collect()] == [30.0]


# ------------------------------------------------------------------ comparisons


def test_compare_row_counts(people):
    assert pl.compare_row_counts(people, people).first().success
    row = pl.compare_row_counts(people, people.filter("id > 2")).first()
    assert not row.success and row.unexpected_count == 2
    assert pl.compare_row_counts(people.filter("false"), people.filter("false")).first().success


def keyed(df):
    return {r.check_id.split(".")[1]: (r.success, r.unexpected_count) for r in df.collect()}


def test_compare_keys(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(1,), (3,), (3,)], "j int")
    assert keyed(pl.compare_keys(a, b, ["k"], ["j"])) == {
        "missing_from_right": (False, 2), "missing_from_left": (False, 1)
    }
    assert keyed(pl.compare_keys(a, a, ["k"])) == {"missing_from_right": (True, 0), "missing_from_left": (True, 0)}


def test_compare_rows_counts_copies(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (1, "x"), (None, "y")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (None, "y"), (None, "y"), (2, "z")], "k int, v string")
    assert keyed(pl.compare_rows(a, b, ["k", "v"])) == {
        "missing_from_right": (False, a.exceptAll(b).count()), "missing_from_left": (False, b.exceptAll(a).count())
    }
    assert {tuple(r) for r in pl.row_differences(a, b, ["k", "v"]).collect()} == {
        (1, "x", 2, 0), (None, "y", 0, 1), (2, "z", 0, 1)
    }
    assert pl.row_differences(a, a, ["k", "v"]).count() == 0


def test_compare_aggregates(people):
    measures = {"n": F.count(F.lit(1)), "age": F.avg("age")}
    assert all(r.success for r in pl.compare_aggregates(people, people, measures).collect())
    rows = pl.compare_aggregates(people, people.filter("id < 3"), measures, tolerance=2.0).collect()
    assert keyed(pl.compare_aggregates(people, people.filter("false"), measures))["age"][0] is False
    assert {r.check_id: (r.success, r.observed_num) for r in rows} == {
        "compare_aggregates.n": (True, 2.0), "compare_aggregates.age": (False, 20.0)
    }


# ------------------------------------------------------------------ plans


@pytest.fixture(scope="module")
def lines(spark):
    return spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")


def test_fused_rules_share_one_scan_and_one_exchange(lines):
    suite = pl.Suite(
        [
            pl.expect_column_values_to_be_between("l_quantity", 1, 50),
            pl.expect_column_values_to_not_be_null("l_tax"),
            pl.expect_column_mean_to_be_between("l_quantity", 0, 50),
            pl.expect_column_values_to_be_in_set("l_returnflag", ["A", "N", "R"]),
            pl.expect_table_row_count_to_equal(1),
        ]
    )
    plan = plan_of(suite.verdicts(lines))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    assert "ReadSchema: struct<l_quantity:double,l_tax:double,l_returnflag:string>" in plan


def test_very_long_suites_stay_compiled_and_read_no_column_twice(lines):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    rules = [pl.expect_column_values_to_be_between(columns[i % 4], 0, 10 * i + 10) for i in range(160)]
    verdicts = pl.Suite(rules).verdicts(lines)
    plan = plan_of(verdicts)
    assert plan.count("FileScan") == 2 and plan.count("Exchange") == 2
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_discount:double,l_tax:double>" not in plan
    found = {r.check_id: r for r in verdicts.collect()}
    assert len(found) == 160
    alone = one(lines, rules[0])
    assert found[alone.check_id] == alone and alone.unexpected_count > 0


def test_checks_of_a_column_share_its_frequency_table(lines):
    suite = pl.Suite(
        [
            IN("l_returnflag", ["A", "N"]) for IN in (
                pl.expect_column_distinct_values_to_be_in_set, pl.expect_column_distinct_values_to_contain_set,
                pl.expect_column_distinct_values_to_equal_set, pl.expect_column_most_common_value_to_be_in_set)
        ]
        + [pl.expect_column_values_to_be_unique("l_returnflag")]
    )
    plan = plan_of(suite.verdicts(lines))
    assert plan.count("FileScan") == 1
    assert "ReadSchema: struct<l_returnflag:string>" in plan and "partial_count(1)" in plan


def test_no_python_and_no_cross_join_in_any_plan(spark, lines):
    suite = pl.Suite(
        [
            pl.expect_column_values_to_be_in_set("l_partkey", range(2000)),
            pl.expect_column_kl_divergence_to_be_less_than(
                "l_returnflag", {"values": ["A", "N", "R"], "weights": [0.3, 0.3, 0.4]}, 0.5),
            pl.expect_compound_columns_to_be_unique(["l_orderkey", "l_linenumber"]),
            pl.expect_query_to_return_no_rows("SELECT * FROM {table} WHERE l_tax > 1"),
        ]
    )
    frames = [
        suite.verdicts(lines), suite.failing_values(lines), pl.compare_rows(lines, lines, ["l_orderkey"]),
        pl.compare_keys(lines, lines, ["l_orderkey"]), pl.latest_slice(lines, "l_shipdate"),
    ]
    for frame in frames:
        plan = plan_of(frame)
        for word in ("Python", "Arrow", "Cartesian", "NestedLoop"):
            assert word not in plan


def test_comparison_shuffles_once(lines):
    plan = plan_of(pl.compare_rows(lines, lines, ["l_orderkey", "l_linenumber"]))
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_sum" in plan


def test_sets_of_checked_size_meet_the_rows_and_fold_into_the_fused_pass(lines):
    suite = pl.Suite(
        [
            pl.expect_column_values_to_be_in_set("l_partkey", range(2000)),
            pl.expect_column_pair_values_to_be_in_set(
                "l_linenumber", "l_suppkey", [(a, b) for a in range(5) for b in range(60)]),
            pl.expect_column_values_to_be_between("l_tax", 0, 1),
        ]
    )
    plan = plan_of(suite.verdicts(lines))
    assert plan.count("FileScan") == 1 and plan.count("BroadcastHashJoin") == 2
    assert "hashpartitioning" not in plan


def test_larger_sets_meet_the_frequency_table_by_a_join_spark_chooses(spark, lines, monkeypatch):
    rule = pl.expect_column_values_to_be_in_set("l_partkey", range(2000))
    broadcast = one(lines, rule)
    monkeypatch.setattr("plumbline.operators.members.BROADCAST_BYTES", 0)
    small = plan_of(pl.Suite([rule]).verdicts(lines))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1kb")
        large = plan_of(pl.Suite([rule]).verdicts(lines))
        verdict = one(lines, rule)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in small and "SortMergeJoin" in large
    assert verdict == one(lines, rule) == broadcast


def test_a_whole_report_is_read_back(spark, people, tmp_path):
    suite = pl.Suite(
        [
            pl.expect_column_to_exist("age", check_id="there"),
            pl.expect_column_values_to_be_in_set("id", range(5000), check_id="large", mostly=0.5),
            pl.expect_column_sum_to_be_between("id", 0, None, check_id="sum"),
            pl.expect_column_values_to_not_be_null("nowhere", check_id="gone"),
        ]
    )
    suite.write_report(people, str(tmp_path / "r"))
    read = pl.read_report(spark, str(tmp_path / "r")).first()
    assert [r.check_id for r in read.results] == ["large", "sum", "there"]
    assert [tuple(r) for r in read.skipped] == [("gone", "expect_column_values_to_not_be_null", "nowhere")]
    by_id = {r.check_id: r for r in read.results}
    assert by_id["large"].expectation_config.kwargs.toPython() == {"column": "id", "mostly": 0.5, "value_set": {"size": 5000}}
    assert by_id["sum"].result.observed_value.toPython() == people.agg(F.sum("id")).first()[0]
    assert by_id["there"].result.unexpected_count is None and by_id["there"].result.observed_value.toPython() == "age"


def test_exact_digits_of_large_integers(spark):
    df = spark.createDataFrame([(9007199254740993,), (1,)], "x bigint")
    row = pl.Suite([pl.expect_column_max_to_be_between("x", 0, None)]).verdicts(df).first()
    assert row.success and row.observed_text == "9007199254740993"


def test_an_approximate_count_leaves_the_others_compiled(spark):
    rules = [pl.expect_column_values_to_be_between("id", i, None) for i in range(5)]
    rules.append(pl.expect_column_unique_value_count_to_be_between("id", 1, None, approx=True))
    plan = plan_of(pl.Suite(rules).verdicts(spark.range(100)))
    assert plan.count("Scan") + plan.count("Range (") == 2
    lines = [line for line in plan.splitlines() if "functions=[partial_" in line]
    assert len(lines) == 2 and not any("CASE" in line for line in lines if "approx_count_distinct" in line)
    assert sum("CASE" in line for line in lines) == 1


def test_sets_share_joins_and_a_broadcast_budget(spark, monkeypatch):
    df = spark.range(3000).selectExpr("id AS a", "id AS b")
    big = list(range(1500))
    rules = [
        pl.expect_column_values_to_be_in_set("a", big), pl.expect_column_values_to_not_be_in_set("a", big),
        pl.expect_column_values_to_be_in_set("b", [v + 1 for v in big]),
    ]
    assert plan_of(pl.Suite(rules).verdicts(df)).count("BroadcastExchange") == 2
    one = members._set_as_table(rules[0], [T.LongType()]).nbytes
    monkeypatch.setattr(members, "BROADCAST_BYTES", one + 10)
    assert members.broadcastable(pl.Suite(rules).rules, df.schema) == {r.check_id for r in pl.Suite(rules).rules[:2]}
    got = {r.check_id: r.unexpected_count for r in pl.Suite(rules).verdicts(df).collect()}
    assert sorted(got.values()) == [1500, 1500, 1500]


def test_a_table_of_members(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("c",)], "x string")
    table = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "y string")
    inside, outside = pl.Suite([pl.expect_column_values_to_be_in_set("x", table), pl.expect_column_values_to_not_be_in_set("x", table)]).verdicts(df).collect()
    assert (inside.unexpected_count, outside.unexpected_count, inside.missing_count) == (1, 2, 1)
    wrong = pl.Suite([pl.expect_column_values_to_be_in_set("x", spark.range(3))]).verdicts(df).first()
    assert not wrong.success and "not comparable" in wrong.observed_text
    with pytest.raises(ValueError):
        pl.expect_column_values_to_be_in_set("x", table.selectExpr("y", "1 AS z"))


def test_collated_text_and_a_large_set(spark):
    df = spark.sql("SELECT collate(c, 'UTF8_LCASE') AS c FROM VALUES ('Ab'), ('zz') t(c)")
    row = pl.Suite([pl.expect_column_values_to_be_in_set("c", ["ab", *map(str, range(2000))])]).verdicts(df).first()
    assert row.unexpected_count == 1


def test_a_caller_keeps_its_views(spark):
    spark.range(7).createOrReplaceTempView("mine")
    try:
        assert pl.query_source(spark, "SELECT * FROM mine", mine=spark.range(2)).count() == 2
        assert spark.table("mine").count() == 7
        pl.query_source(spark, "SELECT * FROM other", other=spark.range(2))
        assert "other" not in {t.name for t in spark.catalog.listTables()}
    finally:
        spark.catalog.dropTempView("mine")


def test_staged_tables_can_be_removed(spark, tmp_path):
    path = str(tmp_path / "here")
    rule = pl.expect_column_median_to_be_between("id", 0, 9)
    assert pl.Suite([rule]).verdicts(spark.range(9), stage=path).first().success
    assert (tmp_path / "here").exists()
    pl.remove_staged(spark, path)
    assert not (tmp_path / "here").exists()
    with pl.staged_table(spark.range(9)) as kept:
        files = kept.inputFiles()
        assert files and kept.count() == 9
    assert not Path(files[0].removeprefix("file://")).exists()


def test_date_slices_of_text_prune_partitions(spark, tmp_path):
    path = str(tmp_path / "days")
    spark.sql("SELECT id, date_format(date_add(DATE '2024-01-01', CAST(id AS INT)), 'yyyy-MM-dd') AS day FROM range(5)").write.partitionBy("day").parquet(path)
    days = spark.read.schema("id bigint, day string").parquet(path)
    day = pl.today_slice(days, "day", today=datetime.date(2024, 1, 3))
    assert scan_metrics(day, "numPartitions") == [1]
    assert [r.id for r in day.collect()] == [2]
    with pytest.raises(ValueError, match="holds no dates"):
        pl.today_slice(spark.range(3).selectExpr("CAST(id AS DOUBLE) AS day"), "day")
