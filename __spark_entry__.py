"""Registered queries, one or more per operator, each beside the SQL it must agree with.

Every query runs its checks over whole tables. Most carry a check that passes and one that
fails on the same data, so a check that cannot fail would show.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import plumbline as pl
from plumbline.sources.tables import shared_folder

try:  # the operators for training data are a part that may be absent
    import corpus_pipeline
    from plumbline.llm import queries as llm
except ModuleNotFoundError as absent:
    if absent.name not in {"corpus_pipeline", "plumbline.llm"}:
        raise
    corpus_pipeline = llm = None

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        _QUERIES[name] = build
        if sql is not None:
            _ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def from_sql(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    return pl.query_source(spark, sql, **{n: table(spark, sf_dir, n) for n in names})


# ------------------------------------------------------------------ shapes of the results


def counts(df: DataFrame, *rules) -> DataFrame:
    """What a row-counting check found."""
    return pl.Suite(rules).verdicts(df).select(
        "check_id", "element_count", "missing_count", "unexpected_count",
        F.round("unexpected_percent", 6).alias("unexpected_percent"), "success",
    )


def numbers(df: DataFrame, *rules) -> DataFrame:
    """What an aggregate check observed."""
    return pl.Suite(rules).verdicts(df).select(
        "check_id", F.round("observed_num", 6).alias("observed_num"), "success"
    )


def counts_sql(source: str, *checks: tuple) -> str:
    """(check id, rows left out, predicate, mostly) -> the verdicts by plain counting."""
    return "\nUNION ALL\n".join(
        f"""SELECT '{check_id}' AS check_id, n AS element_count, m AS missing_count, u AS unexpected_count,
       round(CASE WHEN n = m THEN 0::DOUBLE ELSE 100::DOUBLE * u / (n - m) END, 6) AS unexpected_percent,
       (n = m OR (n - m - u)::DOUBLE / (n - m) >= {mostly}) AS success
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE {missing}) AS m,
             count(*) FILTER (WHERE NOT ({missing}) AND NOT coalesce({holds}, false)) AS u
      FROM {source})"""
        for check_id, missing, holds, mostly in checks
    )


def numbers_sql(source: str, *checks: tuple) -> str:
    """(check id, aggregate, low, high) -> the aggregate and whether it lies in the range."""
    parts = []
    for check_id, aggregate, low, high in checks:
        tests = [f"x >= {low}"] * (low is not None) + [f"x <= {high}"] * (high is not None)
        parts.append(
            f"""SELECT '{check_id}' AS check_id, round(x::DOUBLE, 6) AS observed_num,
       coalesce({' AND '.join(tests)}, false) AS success
FROM (SELECT {aggregate} AS x FROM {source})"""
        )
    return "\nUNION ALL\n".join(parts)


# ------------------------------------------------------------------ sources and sinks

ORDERS_WITH_SEGMENT = """SELECT o_orderkey, o_totalprice, c_mktsegment
FROM orders LEFT JOIN customer ON o_custkey = c_custkey"""


@query(
    "src_query",
    counts_sql(
        f"({ORDERS_WITH_SEGMENT})",
        ("segment", "c_mktsegment IS NULL", "c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE')", 0.5),
        ("price", "o_totalprice IS NULL", "o_totalprice >= 1000", 1.0),
    ),
)
def src_query(spark, sf_dir):
    return counts(
        from_sql(spark, sf_dir, ORDERS_WITH_SEGMENT, "orders", "customer"),
        pl.expect_column_values_to_be_in_set(
            "c_mktsegment", {"BUILDING", "MACHINERY", "AUTOMOBILE"}, mostly=0.5, check_id="segment"
        ),
        pl.expect_column_values_to_be_between("o_totalprice", min_value=1000, check_id="price"),
    )


@query(
    "src_latest_slice",
    """SELECT count(*) AS n, round(sum(o_totalprice), 6) AS total
FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""",
)
def src_latest_slice(spark, sf_dir):
    newest = pl.latest_slice(table(spark, sf_dir, "orders"), "o_orderdate")
    return newest.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 6).alias("total"))


@query(
    "src_latest_slice_yyyymmdd",
    """WITH t AS (SELECT *, strftime(ts, '%Y%m%d')::INTEGER AS day FROM events)
SELECT day, count(*) AS n, round(sum(value), 6) AS total
FROM t WHERE day = (SELECT max(day) FROM t) GROUP BY day""",
)
def src_latest_slice_yyyymmdd(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyyMMdd").cast("int"))
    return (
        pl.latest_slice(events, "day")
        .groupBy("day")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("total"))
    )


@query(
    "src_date_slice",
    "SELECT count(*) AS n, round(sum(value), 6) AS total FROM events WHERE ts::DATE = DATE '2024-01-15'",
)
def src_date_slice(spark, sf_dir):
    day = pl.today_slice(table(spark, sf_dir, "events"), "ts", today=datetime.date(2024, 1, 15))
    return day.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("total"))


@query(
    "src_date_slice_text",
    """SELECT 'iso' AS spelling, count(*) AS n, round(sum(value), 6) AS total FROM events WHERE ts::DATE = DATE '2024-01-15'
UNION ALL SELECT 'digits', count(*), round(sum(value), 6) FROM events WHERE ts::DATE = DATE '2024-01-15'""",
)
def src_date_slice_text(spark, sf_dir):
    def day(spelling, pattern):
        events = table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", pattern))
        found = pl.today_slice(events, "day", today=datetime.date(2024, 1, 15))
        return found.agg(F.lit(spelling).alias("spelling"), F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("total"))

    return day("iso", "yyyy-MM-dd").unionByName(day("digits", "yyyyMMdd"))


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name under the shared folder of the cluster."""
    shared = shared_folder(spark)
    if shared is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{shared.rstrip('/')}/report-{uuid.uuid4().hex}"


@query(
    "sink_report",
    """SELECT 'cheap' AS check_id, count(*) FILTER (WHERE NOT value <= 100) AS unexpected_count, NULL AS observed, '100' AS max_value,
       (SELECT count(DISTINCT value) FROM events WHERE NOT value <= 100) AS distinct_values, count(*) FILTER (WHERE NOT value <= 100) = 0 AS success FROM events
UNION ALL SELECT 'kind', count(*) FILTER (WHERE event_type NOT IN ('click', 'view')), NULL, NULL,
       (SELECT count(DISTINCT event_type) FROM events WHERE event_type NOT IN ('click', 'view')),
       count(*) FILTER (WHERE event_type NOT IN ('click', 'view')) = 0 FROM events
UNION ALL SELECT 'largest', NULL, (max(event_id) + 9007199254740993)::VARCHAR, '5', NULL, max(event_id) + 9007199254740993 <= 5 FROM events
UNION ALL SELECT 'there', NULL, '"value"', NULL, NULL, true
UNION ALL SELECT 'left out', NULL, 'nowhere', NULL, NULL, NULL""",
)
def sink_report(spark, sf_dir):
    """A written report read back: counts, a bound, an exact bigint, a schema check and a check that was left out."""
    suite = pl.Suite(
        [
            pl.expect_column_values_to_be_between("value", max_value=100, check_id="cheap"),
            pl.expect_column_values_to_be_in_set("event_type", ["click", "view"], check_id="kind"),
            pl.expect_column_max_to_be_between("big", max_value=5, check_id="largest"),
            pl.expect_column_to_exist("value", check_id="there"),
            pl.expect_column_values_to_not_be_null("nowhere", check_id="left out"),
        ]
    )
    path = scratch_folder(spark) + "/report"
    suite.write_report(table(spark, sf_dir, "events").withColumn("big", F.col("event_id") + 9007199254740993), path)
    read = pl.read_report(spark, path)
    run = read.select(F.explode("results").alias("r")).select(
        "r.check_id", "r.result.unexpected_count", F.to_json("r.result.observed_value").alias("observed"),
        F.try_variant_get("r.expectation_config.kwargs", "$.max_value", "string").alias("max_value"),
        F.col("r.result.unexpected_distinct").alias("distinct_values"), "r.success",
    )
    nothing = [F.lit(None).cast(t).alias(c) for c, t in run.dtypes]
    skipped = read.select(F.explode("skipped").alias("s")).select(
        F.col("s.check_id"), nothing[1], F.col("s.missing_columns").alias("observed"), *nothing[3:]
    )
    return run.withColumn("observed", F.nullif("observed", F.lit("null"))).unionByName(skipped)


@query(
    "src_newest_slice",
    """SELECT 'day' AS slice, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)
UNION ALL SELECT 'key', count(*), round(sum(l_extendedprice), 2) FROM lineitem WHERE l_orderkey = (SELECT max(l_orderkey) FROM lineitem)""",
)
def src_newest_slice(spark, sf_dir):
    """The newest slice by the files' own statistics where they have them (the key), else by a scan (the time)."""
    parts = []
    for name, path, column, price in (("day", "orders", "o_orderdate", "o_totalprice"), ("key", "lineitem", "l_orderkey", "l_extendedprice")):
        newest = pl.newest_slice(spark, f"{sf_dir}/{path}.parquet", column)
        parts.append(newest.agg(F.lit(name).alias("slice"), F.count(F.lit(1)).alias("n"), F.round(F.sum(price), 2).alias("total")))
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------------ row predicates

EVENTS_SOME_NULL = "SELECT *, nullif(event_type, 'click') AS kind, nullif(event_type, event_type) AS nothing FROM events"


def events_some_null(spark, sf_dir):
    return from_sql(spark, sf_dir, EVENTS_SOME_NULL, "events")


def null_sql(*checks: tuple) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT '{check_id}' AS check_id, n AS element_count, m AS missing_count, u AS unexpected_count,
       round(100::DOUBLE * u / n, 6) AS unexpected_percent, (n - u)::DOUBLE / n >= {mostly} AS success
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE {column} IS NULL) AS m,
             count(*) FILTER (WHERE {bad}) AS u FROM ({EVENTS_SOME_NULL}))"""
        for check_id, column, bad, mostly in checks
    )


@query(
    "row_null",
    null_sql(("some", "kind", "kind IS NOT NULL", 1.0), ("all", "nothing", "nothing IS NOT NULL", 1.0)),
)
def row_null(spark, sf_dir):
    return counts(
        events_some_null(spark, sf_dir),
        pl.expect_column_values_to_be_null("kind", check_id="some"),
        pl.expect_column_values_to_be_null("nothing", check_id="all"),
    )


@query(
    "row_not_null",
    null_sql(
        ("strict", "kind", "kind IS NULL", 0.99), ("loose", "kind", "kind IS NULL", 0.75),
        ("none", "nothing", "nothing IS NULL", 0.99),
    ),
)
def row_not_null(spark, sf_dir):
    return counts(
        events_some_null(spark, sf_dir),
        pl.expect_column_values_to_not_be_null("kind", mostly=0.99, check_id="strict"),
        pl.expect_column_values_to_not_be_null("kind", mostly=0.75, check_id="loose"),
        pl.expect_column_values_to_not_be_null("nothing", mostly=0.99, check_id="none"),
    )


@query(
    "row_between",
    counts_sql(
        "events",
        ("both", "value IS NULL", "value BETWEEN 5 AND 400", 0.9),
        ("strict", "value IS NULL", "value BETWEEN 5 AND 400", 1.0),
        ("low", "value IS NULL", "value >= 0.01", 1.0),
        ("when", "ts IS NULL", "ts <= TIMESTAMP '2024-01-20 12:00:00'", 0.5),
    ),
)
def row_between(spark, sf_dir):
    return counts(
        table(spark, sf_dir, "events"),
        pl.expect_column_values_to_be_between("value", 5, 400, mostly=0.9, check_id="both"),
        pl.expect_column_values_to_be_between("value", 5, 400, check_id="strict"),
        pl.expect_column_values_to_be_between("value", min_value=0.01, check_id="low"),
        pl.expect_column_values_to_be_between(
            "ts", max_value=datetime.datetime(2024, 1, 20, 12), mostly=0.5, check_id="when"
        ),
    )


EVENT_DAYS = "SELECT CAST(ts AS DATE) AS day FROM events"


@query(
    "row_between_dates",
    counts_sql(
        f"({EVENT_DAYS})",
        ("after noon", "day IS NULL", "day::TIMESTAMP >= TIMESTAMP '2024-01-10 12:00:00'", 0.5),
        ("before noon", "day IS NULL", "day::TIMESTAMP <= TIMESTAMP '2024-01-20 12:00:00'", 0.5),
        ("midnight", "day IS NULL", "day::TIMESTAMP >= TIMESTAMP '2024-01-10 00:00:00'", 0.5),
        ("moments", "day IS NULL", "day::TIMESTAMP IN (TIMESTAMP '2024-01-10 12:00:00', TIMESTAMP '2024-01-11 00:00:00')", 0.01),
        ("no moments", "day IS NULL", "day::TIMESTAMP NOT IN (TIMESTAMP '2024-01-10 12:00:00')", 1.0),
    ),
)
def row_between_dates(spark, sf_dir):
    """Dates against bounds and members with a time of day: a date is its midnight."""
    noon, moment = datetime.datetime(2024, 1, 10, 12), datetime.datetime
    return counts(
        from_sql(spark, sf_dir, EVENT_DAYS, "events"),
        pl.expect_column_values_to_be_between("day", min_value=noon, mostly=0.5, check_id="after noon"),
        pl.expect_column_values_to_be_between("day", max_value="2024-01-20T12:00:00", mostly=0.5, check_id="before noon"),
        pl.expect_column_values_to_be_between("day", min_value=moment(2024, 1, 10), mostly=0.5, check_id="midnight"),
        pl.expect_column_values_to_be_in_set("day", [noon, moment(2024, 1, 11)], mostly=0.01, check_id="moments"),
        pl.expect_column_values_to_not_be_in_set("day", [noon], check_id="no moments"),
    )


@query(
    "row_in_table_set",
    counts_sql(
        "lineitem",
        ("known", "l_suppkey IS NULL", "l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)", 0.5),
        ("unknown", "l_suppkey IS NULL", "l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)", 0.5),
        ("orders", "l_orderkey IS NULL", "l_orderkey IN (SELECT o_orderkey FROM orders)", 1.0),
    ),
)
def row_in_table_set(spark, sf_dir):
    """Members that are a table of any size."""
    solvent = table(spark, sf_dir, "supplier").filter("s_acctbal > 0").select("s_suppkey")
    return counts(
        table(spark, sf_dir, "lineitem"),
        pl.expect_column_values_to_be_in_set("l_suppkey", solvent, mostly=0.5, check_id="known"),
        pl.expect_column_values_to_not_be_in_set("l_suppkey", solvent, mostly=0.5, check_id="unknown"),
        pl.expect_column_values_to_be_in_set("l_orderkey", table(spark, sf_dir, "orders").select("o_orderkey"), check_id="orders"),
    )


@query(
    "row_in_filtered_set",
    counts_sql(
        "lineitem",
        ("known", "l_suppkey IS NULL", "l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)", 0.5),
        ("forbidden", "l_orderkey IS NULL", "l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 450000)", 0.8),
    )
    + "\nUNION ALL\n"
    + counts_sql("documents", ("texts", "text IS NULL", "text NOT IN (SELECT text FROM documents WHERE doc_id % 7 = 3 AND text IS NOT NULL)", 0.5)),
)
def row_in_filtered_set(spark, sf_dir):
    """Members that are a table, met through a bit map of them."""
    within, without = pl.expect_column_values_to_be_in_set, pl.expect_column_values_to_not_be_in_set
    solvent = table(spark, sf_dir, "supplier").filter("s_acctbal > 0").select("s_suppkey")
    dear = table(spark, sf_dir, "orders").filter("o_totalprice > 450000").select("o_orderkey")
    documents = table(spark, sf_dir, "documents")
    return counts(
        table(spark, sf_dir, "lineitem"),
        within("l_suppkey", solvent, mostly=0.5, few_members=True, check_id="known"),
        without("l_orderkey", dear, mostly=0.8, few_members=True, check_id="forbidden"),
    ).unionByName(counts(documents, without("text", documents.filter("doc_id % 7 = 3").select("text"), mostly=0.5, few_members=True, check_id="texts")))


#: Whole numbers around the first that a floating-point number cannot hold.
WIDE_KEYS = "SELECT 9007199254740992 + l_linenumber AS k, CAST(9007199254740992 + l_linenumber AS DOUBLE) AS x, l_linenumber AS n FROM lineitem"


@query(
    "row_in_mixed_set",
    counts_sql(
        f"({WIDE_KEYS})",
        ("listed", "k IS NULL", "k IN (9007199254740993, 9007199254740994, 9007199254740996)", 0.5),
        ("floats", "x IS NULL", "x::BIGINT IN (9007199254740994)", 0.5),
        ("table", "k IS NULL", "k IN (SELECT x::BIGINT FROM mixed)", 0.5),
        ("not in table", "k IS NULL", "k NOT IN (SELECT x::BIGINT FROM mixed)", 0.5),
        ("whole in table", "x IS NULL", "x::BIGINT IN (SELECT k FROM mixed)", 0.5),
    ).replace("FROM mixed", f"FROM ({WIDE_KEYS}) WHERE n < 4"),
)
def row_in_mixed_set(spark, sf_dir):
    """Members of another number type than the column: a number is only itself."""
    keys = from_sql(spark, sf_dir, WIDE_KEYS, "lineitem")
    within, without = pl.expect_column_values_to_be_in_set, pl.expect_column_values_to_not_be_in_set
    few = keys.filter("n < 4")
    return counts(
        keys,
        within("k", [9007199254740993, 9007199254740994.0, 9007199254740996.0, 1.5], mostly=0.5, check_id="listed"),
        within("x", [9007199254740993, 9007199254740994], mostly=0.5, check_id="floats"),
        within("k", few.select("x"), mostly=0.5, check_id="table"),
        without("k", few.select("x"), mostly=0.5, check_id="not in table"),
        within("x", few.select("k"), mostly=0.5, check_id="whole in table"),
    )


@query(
    "row_in_set",
    counts_sql(
        f"({EVENTS_SOME_NULL})",
        ("two", "kind IS NULL", "kind IN ('view', 'purchase')", 1.0),
        ("four", "kind IS NULL", "kind IN ('view', 'purchase', 'error', 'signup')", 1.0),
    ),
)
def row_in_set(spark, sf_dir):
    return counts(
        events_some_null(spark, sf_dir),
        pl.expect_column_values_to_be_in_set("kind", ["view", "purchase"], check_id="two"),
        pl.expect_column_values_to_be_in_set("kind", {"view", "purchase", "error", "signup"}, check_id="four"),
    )


# sets too long for a literal list: a relation of checked size, broadcast into the fused pass
@query(
    "row_in_large_set",
    counts_sql(
        "lineitem",
        ("in", "l_partkey IS NULL", "l_partkey BETWEEN 1 AND 1500", 0.5),
        ("not_in", "l_partkey IS NULL", "NOT l_partkey BETWEEN 1 AND 1500", 0.5),
    ),
)
def row_in_large_set(spark, sf_dir):
    return counts(
        table(spark, sf_dir, "lineitem"),
        pl.expect_column_values_to_be_in_set("l_partkey", range(1, 1501), mostly=0.5, check_id="in"),
        pl.expect_column_values_to_not_be_in_set("l_partkey", range(1, 1501), mostly=0.5, check_id="not_in"),
    )


@query(
    "row_not_in_set",
    counts_sql(
        "orders",
        ("status", "o_orderstatus IS NULL", "o_orderstatus NOT IN ('P')", 1.0),
        ("tokens", "o_orderstatus IS NULL", "o_orderstatus NOT IN ('DROP', 'NULL', 'INVALID')", 1.0),
    ),
)
def row_not_in_set(spark, sf_dir):
    return counts(
        table(spark, sf_dir, "orders"),
        pl.expect_column_values_to_not_be_in_set("o_orderstatus", ["P"], check_id="status"),
        pl.expect_column_values_to_not_be_in_set("o_orderstatus", ["DROP", "NULL", "INVALID"], check_id="tokens"),
    )


@query(
    "row_len_between",
    counts_sql("part", ("brand", "p_brand IS NULL", "length(p_brand) BETWEEN 7 AND 8", 1.0))
    + "\nUNION ALL\n"
    + counts_sql("part", ("name", "p_name IS NULL", "length(p_name) <= 12", 0.9)),
)
def row_len_between(spark, sf_dir):
    return counts(
        table(spark, sf_dir, "part"),
        pl.expect_column_value_lengths_to_be_between("p_brand", 7, 8, check_id="brand"),
        pl.expect_column_value_lengths_to_be_between("p_name", max_value=12, mostly=0.9, check_id="name"),
    )


@query(
    "row_len_equal",
    counts_sql("documents", ("lang", "lang IS NULL", "length(lang) = 2", 1.0))
    + "\nUNION ALL\n"
    + counts_sql("part", ("brand", "p_brand IS NULL", "length(p_brand) = 8", 1.0)),
)
def row_len_equal(spark, sf_dir):
    return counts(
        table(spark, sf_dir, "documents"), pl.expect_column_value_lengths_to_equal("lang", 2, check_id="lang")
    ).unionByName(
        counts(table(spark, sf_dir, "part"), pl.expect_column_value_lengths_to_equal("p_brand", 8, check_id="brand"))
    )


@query(
    "row_regex",
    counts_sql(
        "part",
        ("one_digit", "p_brand IS NULL", "regexp_matches(p_brand, '^Brand#[0-9]$')", 1.0),
        ("tolerant", "p_brand IS NULL", "regexp_matches(p_brand, '^Brand#[0-9]$')", 0.3),
        ("found_inside", "p_brand IS NULL", "regexp_matches(p_brand, 'and#[0-9]+')", 1.0),
    ),
)
def row_regex(spark, sf_dir):
    return counts(
        table(spark, sf_dir, "part"),
        pl.expect_column_values_to_match_regex("p_brand", r"^Brand#[0-9]$", check_id="one_digit"),
        pl.expect_column_values_to_match_regex("p_brand", r"^Brand#[0-9]$", mostly=0.3, check_id="tolerant"),
        pl.expect_column_values_to_match_regex("p_brand", r"and#[0-9]+", check_id="found_inside"),
    )


@query(
    "row_regex_any",
    counts_sql(
        "pages",
        ("url", "url IS NULL", "(regexp_matches(url, '^https://') OR regexp_matches(url, '/(en|de)/'))", 0.8),
        ("path", "url IS NULL", "(regexp_matches(url, '/(en|de)/') OR regexp_matches(url, '/fr/'))", 1.0),
    ),
)
def row_regex_any(spark, sf_dir):
    return counts(
        table(spark, sf_dir, "pages"),
        pl.expect_column_values_to_match_regex_list("url", [r"^https://", r"/(en|de)/"], mostly=0.8, check_id="url"),
        pl.expect_column_values_to_match_regex_list("url", [r"/(en|de)/", r"/fr/"], check_id="path"),
    )


@query(
    "row_regex_none",
    counts_sql(
        "documents",
        ("text", "text IS NULL", "NOT (regexp_matches(text, '(?i)license') OR regexp_matches(text, '^A'))", 1.0),
        ("tolerant", "text IS NULL", "NOT regexp_matches(text, '(?i)license')", 0.85),
    ),
)
def row_regex_none(spark, sf_dir):
    return counts(
        table(spark, sf_dir, "documents"),
        pl.expect_column_values_to_not_match_regex_list("text", [r"(?i)license", r"^A"], check_id="text"),
        pl.expect_column_values_to_not_match_regex_list("text", [r"(?i)license"], mostly=0.85, check_id="tolerant"),
    )


@query(
    "row_like_none",
    counts_sql(
        "documents",
        ("text", "text IS NULL", "NOT (text LIKE 'A%' OR text LIKE '%license%')", 1.0),
        ("lang", "lang IS NULL", "NOT (lang LIKE '___' OR lang LIKE 'x%')", 1.0),
    ),
)
def row_like_none(spark, sf_dir):
    return counts(
        table(spark, sf_dir, "documents"),
        pl.expect_column_values_to_not_match_like_pattern_list("text", ["A%", "%license%"], check_id="text"),
        pl.expect_column_values_to_not_match_like_pattern_list("lang", ["___", "x%"], check_id="lang"),
    )


SHIPMENTS = """SELECT l_shipdate, o_orderdate, nullif(l_linenumber, 1) AS a, nullif(l_linenumber, 2) AS b,
       nullif(l_linenumber, 1) AS c
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey"""


@query(
    "pair_gt",
    counts_sql(
        f"({SHIPMENTS})",
        ("shipped_later", "l_shipdate IS NULL AND o_orderdate IS NULL", "l_shipdate > o_orderdate", 1.0),
        ("half_null", "a IS NULL AND b IS NULL", "a > b", 0.5),
        ("complete", "a IS NULL OR b IS NULL", "a > b", 0.5),
        ("every", "false", "a > b", 0.5),
    ),
)
def pair_gt(spark, sf_dir):
    greater = pl.expect_column_pair_values_a_to_be_greater_than_b
    return counts(
        from_sql(spark, sf_dir, SHIPMENTS, "lineitem", "orders"),
        greater("l_shipdate", "o_orderdate", check_id="shipped_later"),
        greater("a", "b", mostly=0.5, check_id="half_null"),
        greater("a", "b", mostly=0.5, ignore_row_if="any_value_is_missing", check_id="complete"),
        greater("a", "b", mostly=0.5, ignore_row_if="never", check_id="every"),
    )


@query(
    "pair_eq",
    counts_sql("(SELECT n_chars, length(text)::BIGINT AS counted FROM documents)",
               ("chars", "n_chars IS NULL AND counted IS NULL", "n_chars = counted", 1.0))
    + "\nUNION ALL\n"
    + counts_sql(
        f"({SHIPMENTS})",
        ("half_null", "a IS NULL AND b IS NULL", "a IS NOT DISTINCT FROM b", 0.5),
        ("both_null", "false", "a IS NOT DISTINCT FROM c", 1.0),
    ),
)
def pair_eq(spark, sf_dir):
    equal = pl.expect_column_pair_values_to_be_equal
    texts = table(spark, sf_dir, "documents").select("n_chars", F.char_length("text").cast("bigint").alias("counted"))
    return counts(texts, equal("n_chars", "counted", check_id="chars")).unionByName(
        counts(
            from_sql(spark, sf_dir, SHIPMENTS, "lineitem", "orders"),
            equal("a", "b", mostly=0.5, check_id="half_null"),
            equal("a", "c", ignore_row_if="never", check_id="both_null"),
        )
    )


@query(
    "pair_in_set",
    counts_sql(
        "lineitem",
        ("flags", "l_returnflag IS NULL AND l_linestatus IS NULL",
         "(l_returnflag, l_linestatus) IN (('A', 'F'), ('N', 'O'), ('R', 'F'))", 1.0),
        ("all_flags", "l_returnflag IS NULL AND l_linestatus IS NULL",
         "l_returnflag IN ('A', 'N', 'R') AND l_linestatus IN ('F', 'O')", 1.0),
    ),
)
def pair_in_set(spark, sf_dir):
    allowed = pl.expect_column_pair_values_to_be_in_set
    return counts(
        table(spark, sf_dir, "lineitem"),
        allowed("l_returnflag", "l_linestatus", [("A", "F"), ("N", "O"), ("R", "F")], check_id="flags"),
        allowed("l_returnflag", "l_linestatus", [(f, s) for f in "ANR" for s in "FO"], check_id="all_flags"),
    )


@query(
    "pair_in_large_set",
    counts_sql(
        "lineitem",
        ("pairs", "l_linenumber IS NULL AND l_suppkey IS NULL",
         "l_linenumber BETWEEN 1 AND 4 AND l_suppkey BETWEEN 1 AND 60", 0.3),
    ),
)
def pair_in_large_set(spark, sf_dir):
    return counts(
        table(spark, sf_dir, "lineitem"),
        pl.expect_column_pair_values_to_be_in_set(
            "l_linenumber", "l_suppkey", [(a, b) for a in range(1, 5) for b in range(1, 61)], mostly=0.3,
            check_id="pairs",
        ),
    )


ORDER_PARTS = """SELECT day(o_orderdate) AS a, 60 - day(o_orderdate) AS b,
       40 + CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS c,
       o_orderkey AS d, 100 - o_orderkey AS e
FROM orders"""


@query(
    "multi_sum",
    counts_sql(
        f"({ORDER_PARTS})",
        ("hundred", "a IS NULL AND b IS NULL AND c IS NULL", "a + b + c = 100", 1.0),
        ("tolerant", "a IS NULL AND b IS NULL AND c IS NULL", "a + b + c = 100", 0.9),
        ("wide", "d IS NULL AND e IS NULL", "d + e = 100", 1.0),
    ),
)
def multi_sum(spark, sf_dir):
    total = pl.expect_multicolumn_sum_to_equal
    return counts(
        from_sql(spark, sf_dir, ORDER_PARTS, "orders"),
        total(["a", "b", "c"], sum_total=100, check_id="hundred"),
        total(["a", "b", "c"], sum_total=100, mostly=0.9, check_id="tolerant"),
        total(["d", "e"], sum_total=100, check_id="wide"),
    )


LINE_CODES = """SELECT l_linenumber AS a, nullif(CAST(l_quantity AS INT), 50) AS b,
       CAST(round(l_discount * 100) AS INT) AS c, CAST(round(l_tax * 100) AS INT) AS d,
       day(l_shipdate) AS e, month(l_shipdate) AS f
FROM lineitem"""


@query(
    "within_record",
    counts_sql(
        f"({LINE_CODES})",
        ("three", "a IS NULL OR b IS NULL OR c IS NULL",
         "NOT coalesce(a = b OR a = c OR b = c, false)", 0.9),
        ("six", "a IS NULL AND b IS NULL AND c IS NULL AND d IS NULL AND e IS NULL AND f IS NULL",
         "len(list_distinct([a, b, c, d, e, f])) = 6 - (b IS NULL)::INT", 0.1),
    ),
)
def within_record(spark, sf_dir):
    distinct = pl.expect_select_column_values_to_be_unique_within_record
    return counts(
        from_sql(spark, sf_dir, LINE_CODES, "lineitem"),
        distinct(["a", "b", "c"], mostly=0.9, check_id="three"),
        distinct(list("abcdef"), mostly=0.1, ignore_row_if="all_values_are_missing", check_id="six"),
    )


# bigints beyond 2**53 beside doubles, zeros of both signs, nulls; no two columns of the first check are ever equal
LINE_WIDE = """SELECT l_linenumber + CAST(9007199254740992 AS BIGINT) AS a, CAST(9007199254740992 AS DOUBLE) AS b, l_quantity AS c,
       -l_quantity AS d, 0.5 + l_linenumber AS e, CAST(NULL AS BIGINT) AS f, l_orderkey + CAST(100 AS BIGINT) AS g,
       l_discount * 0 AS zero, CAST(-0.0 AS DOUBLE) * l_quantity AS minus FROM lineitem"""


@query(
    "within_record_wide",
    counts_sql(
        "lineitem",
        ("exact", "false", "true", 1.0),
        ("more", "false", "NOT (l_quantity = l_orderkey + 100 OR 0.5 + l_linenumber = l_quantity)", 0.9),
        ("zeros", "false", "false", 0.9),
    ),
)
def within_record_wide(spark, sf_dir):
    """One meaning at every width: integers and doubles are equal only if they are the same number."""
    distinct = pl.expect_select_column_values_to_be_unique_within_record
    policy = "all_values_are_missing"
    return counts(
        from_sql(spark, sf_dir, LINE_WIDE, "lineitem"),
        distinct(["a", "b"], check_id="exact"),
        distinct(list("abcdefg"), mostly=0.9, ignore_row_if=policy, check_id="more"),
        distinct(["a", "b", "zero", "minus", "e", "f", "g"], mostly=0.9, ignore_row_if=policy, check_id="zeros"),
    )


# ------------------------------------------------------------------ aggregates


def aggregate_query(name: str, column: str, source: str, sql: str, good: tuple, bad: tuple, expect) -> None:
    checks = [("good", sql, *good), ("bad", sql, *bad)]

    @query(name, numbers_sql(source, *checks))
    def build(spark, sf_dir):
        return numbers(
            table(spark, sf_dir, source), expect(column, *good, check_id="good"), expect(column, *bad, check_id="bad")
        )


aggregate_query("agg_max", "value", "events", "max(value)", (0, 10000), (None, 100), pl.expect_column_max_to_be_between)
aggregate_query("agg_min", "value", "events", "min(value)", (0, 10000), (1, None), pl.expect_column_min_to_be_between)
aggregate_query("agg_mean", "value", "events", "avg(value)", (40, 60), (50, 500), pl.expect_column_mean_to_be_between)
aggregate_query("agg_sum", "value", "events", "sum(value)", (100, None), (None, 1000), pl.expect_column_sum_to_be_between)
aggregate_query("agg_sum_integer", "l_orderkey", "lineitem", "sum(l_orderkey)", (100, None), (None, 1000),
                pl.expect_column_sum_to_be_between)
aggregate_query("agg_stdev", "value", "events", "stddev_samp(value)", (0, 1000), (None, 10),
                pl.expect_column_stdev_to_be_between)
aggregate_query("agg_median", "value", "events", "median(value)", (30, 40), (40, 400),
                pl.expect_column_median_to_be_between)


@query(
    "agg_quantiles",
    """WITH q AS (SELECT quantile_cont(o_totalprice, [0.25, 0.5, 0.75]) AS v FROM orders)
SELECT 0.25::DOUBLE AS quantile, round(v[1], 6) AS value FROM q
UNION ALL SELECT 0.5::DOUBLE, round(v[2], 6) FROM q
UNION ALL SELECT 0.75::DOUBLE, round(v[3], 6) FROM q""",
)
def agg_quantiles(spark, sf_dir):
    found = pl.quantile_table(table(spark, sf_dir, "orders"), "o_totalprice", [0.25, 0.5, 0.75])
    return found.select("quantile", F.round("value", 6).alias("value"))


#: Integers beyond 53 bits, decimals of 38 digits, dates and times.
WIDE_VALUES = """SELECT 9007199254740992 + l_linenumber * 2 + l_orderkey % 2 AS big,
    CAST(90000000000000000000000000000000000 + l_orderkey * 1000 + l_linenumber AS DECIMAL(38, 2)) AS amount, l_shipdate AS shipped,
    CAST(l_shipdate AS DATE) AS day FROM lineitem"""


@query(
    "agg_quantiles_wide",
    f"""WITH t AS ({WIDE_VALUES.replace("90000000000000000000000000000000000 +", "90000000000000000000000000000000000::DECIMAL(38, 2) +")}),
one AS (SELECT count(*) AS n, list_sort(list(big)) AS b, list_sort(list(amount)) AS a, quantile_disc(shipped, 0.75) AS s, quantile_disc(day, 0.5) AS d FROM t),
mid AS (SELECT *, (n - 1) // 2 + 1 AS h, n % 2 = 1 AS odd FROM one)
SELECT 'big' AS check_id, n AS element_count, CASE WHEN odd THEN b[h] * 2 ELSE b[h] + b[h + 1] END <= 2 * 9007199254741001 AS success,
    CASE WHEN odd OR b[h] = b[h + 1] THEN b[h]::VARCHAR END AS observed_text FROM mid
UNION ALL SELECT 'big below', n, CASE WHEN odd THEN b[h] * 2 ELSE b[h] + b[h + 1] END <= 2 * 9007199254741000, NULL FROM mid
UNION ALL SELECT 'amount', n, true, CASE WHEN odd THEN a[h]::VARCHAR ELSE (a[h] + (a[h + 1] - a[h]) * 0.5)::DECIMAL(38, 2)::VARCHAR END FROM mid
UNION ALL SELECT 'shipped', n, s >= TIMESTAMP '1995-01-01', strftime(s, '%Y-%m-%d %H:%M:%S') FROM mid
UNION ALL SELECT 'day', n, d BETWEEN DATE '1990-01-01' AND DATE '2030-01-01', d::VARCHAR FROM mid""",
)
def agg_quantiles_wide(spark, sf_dir):
    """Medians and quantiles that a floating-point number would round."""
    values = from_sql(spark, sf_dir, WIDE_VALUES, "lineitem")
    found = pl.Suite(
        [
            pl.expect_column_median_to_be_between("big", None, 9007199254741001, check_id="big"),
            pl.expect_column_median_to_be_between("big", None, 9007199254741000, check_id="big below"),
            pl.expect_column_median_to_be_between("amount", 1, None, check_id="amount"),
            pl.expect_column_quantile_values_to_be_between(
                "shipped", {"quantiles": [0.75], "value_ranges": [[datetime.datetime(1995, 1, 1), None]]}, check_id="shipped"
            ),
            pl.expect_column_median_to_be_between("day", datetime.date(1990, 1, 1), "2030-01-01", check_id="day"),
        ]
    ).verdicts(values)
    text = F.when(F.col("check_id") != "big below", F.col("observed_text"))
    return found.select("check_id", "element_count", "success", text.alias("observed_text"))


QUANTILE_RANGES = {
    "good": {"quantiles": [0.25, 0.5, 0.75], "value_ranges": [[10, 200], [20, None], [None, 800]]},
    "bad": {"quantiles": [0.25, 0.5], "value_ranges": [[10, 200], [None, 30]]},
}


@query(
    "agg_quantile_ranges",
    """WITH q AS (SELECT quantile_cont(value, [0.25, 0.5, 0.75]) AS v, count(*) AS n FROM events)
SELECT 'good' AS check_id, n AS element_count, v[1] BETWEEN 10 AND 200 AND v[2] >= 20 AND v[3] <= 800 AS success FROM q
UNION ALL SELECT 'bad', n, v[1] BETWEEN 10 AND 200 AND v[2] <= 30 FROM q""",
)
def agg_quantile_ranges(spark, sf_dir):
    rules = [
        pl.expect_column_quantile_values_to_be_between("value", quantile_ranges=r, check_id=name)
        for name, r in QUANTILE_RANGES.items()
    ]
    return pl.Suite(rules).verdicts(table(spark, sf_dir, "events")).select("check_id", "element_count", "success")


# a sketch agrees with no other engine to the last digit, so only the verdicts are compared
@query(
    "agg_quantiles_approx",
    """WITH q AS (SELECT quantile_cont(value, [0.25, 0.5, 0.75]) AS v, count(*) AS n FROM events)
SELECT 'good' AS check_id, n AS element_count, v[1] BETWEEN 10 AND 200 AND v[2] >= 20 AND v[3] <= 800 AS success, true AS close FROM q
UNION ALL SELECT 'bad', n, v[1] BETWEEN 10 AND 200 AND v[2] <= 30, true FROM q
UNION ALL SELECT 'median', n, v[2] BETWEEN 30 AND 40, true FROM q""",
)
def agg_quantiles_approx(spark, sf_dir):
    rules = [
        pl.expect_column_quantile_values_to_be_between("value", quantile_ranges=r, approx=True, check_id=name)
        for name, r in QUANTILE_RANGES.items()
    ]
    rules.append(pl.expect_column_median_to_be_between("value", 30, 40, approx=True, check_id="median"))
    events = table(spark, sf_dir, "events")
    found = pl.Suite(rules).verdicts(events).select("check_id", "element_count", "success", "observed_text").collect()  # three rows
    # every quantile within three times the published rank error of 0.07 %
    share = lambda below: F.count(F.when(below, 1)) / F.count("value")
    tests = []
    for r, rule in ((r, rule) for r in found for rule in rules if rule.check_id == r.check_id):
        seen = [float(v) for v in r.observed_text.split(",")]
        inside = [(share(F.col("value") < v) <= p + 0.0021) & (share(F.col("value") <= v) >= p - 0.0021) for p, v in zip(rule.probabilities, seen)]
        row = [F.lit(r.check_id), F.lit(r.element_count).cast("bigint"), F.lit(r.success)]
        tests.append(F.struct(*[c.alias(n) for n, c in zip(("check_id", "element_count", "success"), row)], reduce(and_, inside).alias("close")))
    return events.agg(F.array(*tests).alias("t")).select(F.inline("t"))


@query(
    "rowcount_between",
    numbers_sql("lineitem", ("good", "count(*)", 50, None), ("bad", "count(*)", 50, 1000)),
)
def rowcount_between(spark, sf_dir):
    return numbers(
        table(spark, sf_dir, "lineitem"),
        pl.expect_table_row_count_to_be_between(50, None, check_id="good"),
        pl.expect_table_row_count_to_be_between(50, 1000, check_id="bad"),
    )


@query(
    "rowcount_equal",
    numbers_sql("lineitem", ("small", "count(*)", 60000, 60000), ("bad", "count(*)", 100, 100)),
)
def rowcount_equal(spark, sf_dir):
    return numbers(
        table(spark, sf_dir, "lineitem"),
        pl.expect_table_row_count_to_equal(60000, check_id="small"),
        pl.expect_table_row_count_to_equal(100, check_id="bad"),
    )


# ------------------------------------------------------------------ distinct values, frequencies, keys

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def distinct_sql(*checks: tuple) -> str:
    """(check id, test over the sorted distinct list ``d``)"""
    return "\nUNION ALL\n".join(
        f"""SELECT '{check_id}' AS check_id, len(d)::DOUBLE AS observed_num, {test} AS success
FROM (SELECT list_sort(list(DISTINCT event_type)) AS d FROM events)"""
        for check_id, test in checks
    )


@query(
    "distinct_in_set",
    distinct_sql(
        ("good", "list_has_all(['click', 'error', 'purchase', 'signup', 'view', 'other'], d)"),
        ("bad", "list_has_all(['click', 'view'], d)"),
    ),
)
def distinct_in_set(spark, sf_dir):
    return numbers(
        table(spark, sf_dir, "events"),
        pl.expect_column_distinct_values_to_be_in_set("event_type", [*EVENT_TYPES, "other"], check_id="good"),
        pl.expect_column_distinct_values_to_be_in_set("event_type", ["click", "view"], check_id="bad"),
    )


@query(
    "distinct_contains",
    distinct_sql(("good", "list_has_all(d, ['click', 'view'])"), ("bad", "list_has_all(d, ['click', 'other'])")),
)
def distinct_contains(spark, sf_dir):
    return numbers(
        table(spark, sf_dir, "events"),
        pl.expect_column_distinct_values_to_contain_set("event_type", ["click", "view"], check_id="good"),
        pl.expect_column_distinct_values_to_contain_set("event_type", ["click", "other"], check_id="bad"),
    )


@query(
    "distinct_equals",
    distinct_sql(
        ("good", "d = ['click', 'error', 'purchase', 'signup', 'view']"),
        ("bad", "d = ['click', 'error', 'purchase', 'signup', 'other']"),
    ),
)
def distinct_equals(spark, sf_dir):
    return numbers(
        table(spark, sf_dir, "events"),
        pl.expect_column_distinct_values_to_equal_set("event_type", EVENT_TYPES, check_id="good"),
        pl.expect_column_distinct_values_to_equal_set("event_type", [*EVENT_TYPES[:4], "other"], check_id="bad"),
    )


@query(
    "frequency_table",
    "SELECT o_orderpriority AS value, count(*) AS n FROM orders GROUP BY o_orderpriority",
)
def frequency_table(spark, sf_dir):
    return pl.frequency_table(table(spark, sf_dir, "orders"), ["o_orderpriority"]).withColumnRenamed("k0", "value")


@query(
    "unique_proportion",
    numbers_sql(
        "lineitem",
        ("keys", "count(DISTINCT l_orderkey)::DOUBLE / count(l_orderkey)", 0.7, 1.0),
        ("parts", "count(DISTINCT l_partkey)::DOUBLE / count(l_partkey)", None, 0.5),
    ),
)
def unique_proportion(spark, sf_dir):
    share = pl.expect_column_proportion_of_unique_values_to_be_between
    return numbers(
        table(spark, sf_dir, "lineitem"),
        share("l_orderkey", 0.7, 1.0, check_id="keys"), share("l_partkey", None, 0.5, check_id="parts"),
    )


@query(
    "unique_count",
    numbers_sql(
        "lineitem",
        ("keys", "count(DISTINCT l_orderkey)", 10, 1000), ("lines", "count(DISTINCT l_linenumber)", 7, 7),
    ),
)
def unique_count(spark, sf_dir):
    number = pl.expect_column_unique_value_count_to_be_between
    return numbers(
        table(spark, sf_dir, "lineitem"),
        number("l_orderkey", 10, 1000, check_id="keys"), number("l_linenumber", 7, 7, check_id="lines"),
    )


@query(
    "unique_count_approx",
    """SELECT 'keys' AS check_id, count(DISTINCT l_orderkey) BETWEEN 10 AND 1000 AS success, count(DISTINCT l_orderkey) AS exact, true AS close FROM lineitem
UNION ALL SELECT 'more', count(DISTINCT l_orderkey) >= 10, count(DISTINCT l_orderkey), true FROM lineitem""",
)
def unique_count_approx(spark, sf_dir):
    number = pl.expect_column_unique_value_count_to_be_between
    rules = [
        number("l_orderkey", 10, 1000, approx=True, check_id="keys"),
        number("l_orderkey", 10, None, approx=True, check_id="more"),
    ]
    lines = table(spark, sf_dir, "lineitem")
    exact = lines.agg(F.countDistinct("l_orderkey")).scalar()
    # three times the published standard error of 5 %
    close = F.abs(F.col("observed_num") - exact) <= 0.15 * exact
    return pl.Suite(rules).verdicts(lines).select("check_id", "success", exact.alias("exact"), close.alias("close"))


def unique_sql(check_id: str, source: str, keys: str, missing: str, mostly: float) -> str:
    return f"""SELECT '{check_id}' AS check_id, n AS element_count, m AS missing_count, u AS unexpected_count,
       round(CASE WHEN n = m THEN 0::DOUBLE ELSE 100::DOUBLE * u / (n - m) END, 6) AS unexpected_percent,
       (n = m OR (n - m - u)::DOUBLE / (n - m) >= {mostly}) AS success
FROM (SELECT sum(c)::BIGINT AS n, coalesce(sum(c) FILTER (WHERE {missing}), 0)::BIGINT AS m,
             coalesce(sum(c) FILTER (WHERE NOT ({missing}) AND c > 1), 0)::BIGINT AS u
      FROM (SELECT {keys}, count(*) AS c FROM {source} GROUP BY ALL))"""


@query(
    "unique_values",
    unique_sql("orders", "lineitem", "l_orderkey", "l_orderkey IS NULL", 1.0)
    + "\nUNION ALL\n" + unique_sql("events", "events", "event_id", "event_id IS NULL", 1.0),
)
def unique_values(spark, sf_dir):
    unique = pl.expect_column_values_to_be_unique
    return counts(table(spark, sf_dir, "lineitem"), unique("l_orderkey", check_id="orders")).unionByName(
        counts(table(spark, sf_dir, "events"), unique("event_id", check_id="events"))
    )


@query(
    "most_common",
    """WITH f AS (SELECT o_orderpriority AS v, count(*) AS n FROM orders GROUP BY 1),
top AS (SELECT min(v) AS mode, count(*) AS modes FROM f WHERE n = (SELECT max(n) FROM f))
SELECT 'good' AS check_id, mode AS observed_text, modes = 1 AND mode IN ('4-NOT SPECIFIED', '5-LOW') AS success FROM top
UNION ALL SELECT 'bad', mode, modes = 1 AND mode IN ('1-URGENT', '2-HIGH') FROM top
UNION ALL
SELECT 'tied', min(v)::VARCHAR, count(*) FILTER (WHERE v IN (1, 2)) > 0
FROM (SELECT o_orderkey AS v, count(*) AS n FROM orders GROUP BY 1 QUALIFY n = max(n) OVER ())""",
)
def most_common(spark, sf_dir):
    mode = pl.expect_column_most_common_value_to_be_in_set
    rules = [
        mode("o_orderpriority", ["4-NOT SPECIFIED", "5-LOW"], check_id="good"),
        mode("o_orderpriority", ["1-URGENT", "2-HIGH"], check_id="bad"),
        mode("o_orderkey", [1, 2], ties_okay=True, check_id="tied"),
    ]
    return pl.Suite(rules).verdicts(table(spark, sf_dir, "orders")).select("check_id", "observed_text", "success")


LINE_KEYS = "SELECT l_orderkey, l_linenumber, l_partkey, nullif(l_returnflag, 'R') AS flag FROM lineitem"


@query(
    "compound_unique",
    "\nUNION ALL\n".join(
        [
            unique_sql("lines", f"({LINE_KEYS})", "l_orderkey, l_linenumber",
                       "l_orderkey IS NULL AND l_linenumber IS NULL", 1.0),
            unique_sql("parts", f"({LINE_KEYS})", "l_orderkey, l_linenumber, l_partkey",
                       "l_orderkey IS NULL AND l_linenumber IS NULL AND l_partkey IS NULL", 0.5),
            unique_sql("complete", f"({LINE_KEYS})", "l_orderkey, flag", "l_orderkey IS NULL OR flag IS NULL", 1.0),
            unique_sql("every", f"({LINE_KEYS})", "l_orderkey, flag", "false", 1.0),
        ]
    ),
)
def compound_unique(spark, sf_dir):
    key = pl.expect_compound_columns_to_be_unique
    return counts(
        from_sql(spark, sf_dir, LINE_KEYS, "lineitem"),
        key(["l_orderkey", "l_linenumber"], check_id="lines"),
        key(["l_orderkey", "l_linenumber", "l_partkey"], mostly=0.5, check_id="parts"),
        key(["l_orderkey", "flag"], ignore_row_if="any_value_is_missing", check_id="complete"),
        key(["l_orderkey", "flag"], ignore_row_if="never", check_id="every"),
    )


@query(
    "unique_few_repeats",
    unique_sql("orders", "lineitem", "l_orderkey", "l_orderkey IS NULL", 1.0)
    + "\nUNION ALL\n" + unique_sql("lines", f"({LINE_KEYS})", "l_orderkey, l_linenumber", "l_orderkey IS NULL AND l_linenumber IS NULL", 0.5)
    + "\nUNION ALL\n" + unique_sql("every", f"({LINE_KEYS})", "l_orderkey, l_linenumber, flag", "false", 1.0)
    + "\nUNION ALL\n" + unique_sql("events", "events", "event_id", "event_id IS NULL", 1.0)
    + "\nUNION ALL\n" + unique_sql("texts", "documents", "text", "text IS NULL", 0.5),
)
def unique_few_repeats(spark, sf_dir):
    """Keys believed to be nearly unique, whether they are or not."""
    unique, key = pl.expect_column_values_to_be_unique, pl.expect_compound_columns_to_be_unique
    parts = [
        counts(
            from_sql(spark, sf_dir, LINE_KEYS, "lineitem"),
            unique("l_orderkey", few_repeats=True, check_id="orders"),
            key(["l_orderkey", "l_linenumber"], mostly=0.5, few_repeats=True, check_id="lines"),
            key(["l_orderkey", "l_linenumber", "flag"], ignore_row_if="never", few_repeats=True, check_id="every"),
        ),
        counts(table(spark, sf_dir, "events"), unique("event_id", few_repeats=True, check_id="events")),
        counts(table(spark, sf_dir, "documents"), unique("text", mostly=0.5, few_repeats=True, check_id="texts")),
    ]
    return reduce(DataFrame.unionByName, parts)


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "kl_divergence",
    """WITH f AS (SELECT o_orderpriority AS v, count(*)::DOUBLE / sum(count(*)) OVER () AS p FROM orders GROUP BY 1),
w(v, even, tilted) AS (VALUES ('1-URGENT', 0.2::DOUBLE, 0.02::DOUBLE), ('2-HIGH', 0.2, 0.02), ('3-MEDIUM', 0.2, 0.02),
                       ('4-NOT SPECIFIED', 0.2, 0.02), ('5-LOW', 0.2, 0.92))
SELECT 'even' AS check_id, round(sum(p * ln(p / even)), 6) AS observed_num, sum(p * ln(p / even)) < 0.5 AS success
FROM f JOIN w USING (v)
UNION ALL SELECT 'tilted', round(sum(p * ln(p / tilted)), 6), sum(p * ln(p / tilted)) < 0.5 FROM f JOIN w USING (v)
UNION ALL SELECT 'unseen', NULL, false""",
)
def kl_divergence(spark, sf_dir):
    divergence = pl.expect_column_kl_divergence_to_be_less_than
    return numbers(
        table(spark, sf_dir, "orders"),
        divergence("o_orderpriority", {"values": PRIORITIES, "weights": [0.2] * 5}, threshold=0.5, check_id="even"),
        divergence("o_orderpriority", {"values": PRIORITIES, "weights": [0.02] * 4 + [0.92]}, threshold=0.5,
                   check_id="tilted"),
        # one observed value has no expected weight: infinitely far, so no number and no pass
        divergence("o_orderpriority", {"values": PRIORITIES[:4], "weights": [0.25] * 4}, threshold=0.5,
                   check_id="unseen"),
    )


# ------------------------------------------------------------------ schema contracts
# Each runs beside a row-count check, as a schema check alone reads no row.

LINEITEM_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]


def schema_query(name: str, sql_tests: dict[str, str], *rules) -> None:
    """``sql_tests``: check id -> aggregate test over lineitem's rows of information_schema.columns."""
    parts = [
        f"SELECT '{check_id}' AS check_id, {test} AS success FROM information_schema.columns "
        "WHERE table_name = 'lineitem'"
        for check_id, test in sql_tests.items()
    ]
    parts.append("SELECT 'rows', count(*) >= 50 FROM lineitem")

    @query(name, "\nUNION ALL\n".join(parts))
    def build(spark, sf_dir):
        suite = pl.Suite([*rules, pl.expect_table_row_count_to_be_between(50, None, check_id="rows")])
        return suite.verdicts(table(spark, sf_dir, "lineitem")).select("check_id", "success")


schema_query(
    "schema_exists",
    {"good": "count(*) FILTER (WHERE column_name = 'l_tax') = 1",
     "bad": "count(*) FILTER (WHERE column_name = 'l_comment') = 1"},
    pl.expect_column_to_exist("l_tax", check_id="good"),
    pl.expect_column_to_exist("l_comment", check_id="bad"),
)
schema_query(
    "schema_type",
    {"good": "count(*) FILTER (WHERE column_name = 'l_tax' AND data_type = 'DOUBLE') = 1",
     "bad": "count(*) FILTER (WHERE column_name = 'l_orderkey' AND data_type = 'DOUBLE') = 1",
     "absent": "count(*) FILTER (WHERE column_name = 'l_comment' AND data_type = 'VARCHAR') = 1"},
    pl.expect_column_values_to_be_of_type("l_tax", type_="DoubleType", check_id="good"),
    pl.expect_column_values_to_be_of_type("l_orderkey", type_="DoubleType", check_id="bad"),
    pl.expect_column_values_to_be_of_type("l_comment", type_="StringType", check_id="absent"),
)
schema_query(
    "schema_type_list",
    {"good": "count(*) FILTER (WHERE column_name = 'l_orderkey' AND data_type IN ('INTEGER', 'BIGINT')) = 1",
     "bad": "count(*) FILTER (WHERE column_name = 'l_shipdate' AND data_type IN ('DATE', 'VARCHAR')) = 1"},
    pl.expect_column_values_to_be_in_type_list("l_orderkey", type_list=["IntegerType", "LongType"], check_id="good"),
    pl.expect_column_values_to_be_in_type_list("l_shipdate", type_list=["DateType", "StringType"], check_id="bad"),
)
schema_query(
    "schema_column_count_between",
    {"good": "count(*) BETWEEN 10 AND 20", "bad": "count(*) BETWEEN 30 AND 40"},
    pl.expect_table_column_count_to_be_between(min_value=10, max_value=20, check_id="good"),
    pl.expect_table_column_count_to_be_between(min_value=30, max_value=40, check_id="bad"),
)
schema_query(
    "schema_column_count_equal",
    {"good": "count(*) = 11", "bad": "count(*) = 12"},
    pl.expect_table_column_count_to_equal(11, check_id="good"),
    pl.expect_table_column_count_to_equal(12, check_id="bad"),
)
_NAMES = "string_agg(column_name, ',' ORDER BY {})"
schema_query(
    "schema_ordered_list",
    {"good": f"{_NAMES.format('ordinal_position')} = '{','.join(LINEITEM_COLUMNS)}'",
     "bad": f"{_NAMES.format('ordinal_position')} = '{','.join(sorted(LINEITEM_COLUMNS))}'"},
    pl.expect_table_columns_to_match_ordered_list(LINEITEM_COLUMNS, check_id="good"),
    pl.expect_table_columns_to_match_ordered_list(sorted(LINEITEM_COLUMNS), check_id="bad"),
)
schema_query(
    "schema_set",
    {"good": f"{_NAMES.format('column_name')} = '{','.join(sorted(LINEITEM_COLUMNS))}'",
     "bad": f"{_NAMES.format('column_name')} = '{','.join(sorted(LINEITEM_COLUMNS)[1:])}'"},
    pl.expect_table_columns_to_match_set(sorted(LINEITEM_COLUMNS), check_id="good"),
    pl.expect_table_columns_to_match_set(set(LINEITEM_COLUMNS[1:]) | {"l_comment"}, check_id="bad"),
)

CONTRACT = {
    "nation": [("n_nationkey", "IntegerType"), ("n_regionkey", "IntegerType"), ("n_name", "StringType")],
    "orders": [("o_orderkey", "LongType"), ("o_custkey", "IntegerType"), ("o_comment", "StringType")],
    "events": [("event_id", "LongType"), ("ts", "TimestampNTZType"), ("user_id", "LongType"),
               ("event_type", "StringType"), ("value", "DoubleType"), ("props", "StringType")],
}


@query(
    "schema_drift",
    """WITH wanted(table_name, pos, column_name, kind) AS (VALUES
  ('nation', 1, 'n_nationkey', 'INTEGER'), ('nation', 2, 'n_regionkey', 'INTEGER'), ('nation', 3, 'n_name', 'VARCHAR'),
  ('orders', 1, 'o_orderkey', 'BIGINT'), ('orders', 2, 'o_custkey', 'INTEGER'), ('orders', 3, 'o_comment', 'VARCHAR'),
  ('events', 1, 'event_id', 'BIGINT'), ('events', 2, 'ts', 'TIMESTAMP'), ('events', 3, 'user_id', 'BIGINT'),
  ('events', 4, 'event_type', 'VARCHAR'), ('events', 5, 'value', 'DOUBLE'), ('events', 6, 'props', 'VARCHAR')),
seen AS (SELECT table_name, column_name, ordinal_position AS pos, data_type AS kind FROM information_schema.columns
         WHERE table_name IN ('nation', 'orders', 'events')),
both_sides AS (SELECT coalesce(w.table_name, s.table_name) AS table_name,
                      coalesce(w.column_name, s.column_name) AS column_name,
                      w.pos AS w_pos, s.pos AS s_pos, w.kind AS w_kind, s.kind AS s_kind
               FROM wanted w FULL JOIN seen s ON w.table_name = s.table_name AND w.column_name = s.column_name),
sizes AS (SELECT 'nation' AS table_name, count(*) AS n FROM nation
          UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'events', count(*) FROM events)
SELECT table_name, column_name,
       CASE WHEN s_pos IS NULL THEN 'missing' WHEN w_pos IS NULL THEN 'extra'
            WHEN s_kind <> w_kind THEN 'retyped' ELSE 'moved' END AS drift, n AS affected_rows
FROM both_sides JOIN sizes USING (table_name)
WHERE s_pos IS NULL OR w_pos IS NULL OR s_kind <> w_kind OR s_pos <> w_pos""",
)
def schema_drift(spark, sf_dir):
    tables = {name: table(spark, sf_dir, name) for name in CONTRACT}
    sizes = None
    for name, df in tables.items():
        size = df.agg(F.count(F.lit(1)).alias("affected_rows")).withColumn("table_name", F.lit(name))
        sizes = size if sizes is None else sizes.unionByName(size)
    return pl.schema_drift(tables, CONTRACT).join(sizes, "table_name").select(
        "table_name", "column_name", "drift", "affected_rows"
    )


# ------------------------------------------------------------------ constraints and comparisons


NEXT_CUSTOMERS = """SELECT c_custkey, c_nationkey AS nation, 'x' AS note, c_mktsegment AS segment, CAST(c_acctbal AS DECIMAL(12, 2)) AS c_acctbal
FROM customer WHERE c_nationkey < 20"""


@query(
    "schema_renames",
    """WITH k AS (SELECT column_name AS c, CASE data_type WHEN 'BIGINT' THEN 'LongType' WHEN 'INTEGER' THEN 'IntegerType' WHEN 'DOUBLE' THEN 'DoubleType' ELSE 'StringType' END AS t
           FROM information_schema.columns WHERE table_name = 'customer')
SELECT CASE WHEN c = 'c_custkey' THEN 'same' WHEN c = 'c_acctbal' THEN 'retyped' WHEN c = 'c_name' THEN 'removed' ELSE 'renamed' END AS change, c AS old_column,
    CASE c WHEN 'c_nationkey' THEN 'nation' WHEN 'c_mktsegment' THEN 'segment' WHEN 'c_name' THEN NULL ELSE c END AS new_column, t AS old_type,
    CASE c WHEN 'c_acctbal' THEN 'DecimalType' WHEN 'c_name' THEN NULL ELSE t END AS new_type,
    CASE c WHEN 'c_nationkey' THEN (SELECT round(count(DISTINCT c_nationkey) FILTER (WHERE c_nationkey < 20)::DOUBLE / count(DISTINCT c_nationkey), 6) FROM customer)
        WHEN 'c_mktsegment' THEN (SELECT round(count(DISTINCT c_mktsegment) FILTER (WHERE c_nationkey < 20)::DOUBLE / count(DISTINCT c_mktsegment), 6) FROM customer) END AS likeness
FROM k UNION ALL SELECT 'added', NULL, 'note', NULL, 'StringType', NULL""",
)
def schema_renames(spark, sf_dir):
    """A version of a table with renamed, retyped, removed and added columns, told apart by their values."""
    found = pl.schema_renames(table(spark, sf_dir, "customer"), from_sql(spark, sf_dir, NEXT_CUSTOMERS, "customer"))
    return found.withColumn("likeness", F.round("likeness", 6))


@query(
    "sql_constraint",
    """SELECT 'price' AS check_id, count(*) AS unexpected_count, count(*) = 0 AS success
FROM lineitem WHERE l_extendedprice <= l_quantity * 900
UNION ALL SELECT 'discount', count(*), count(*) = 0 FROM lineitem WHERE l_discount > 1
UNION ALL SELECT 'orders', count(*), count(*) = 0
FROM (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING sum(l_quantity) > 300)""",
)
def sql_constraint(spark, sf_dir):
    rules = [
        pl.expect_query_to_return_no_rows("SELECT * FROM {table} WHERE l_extendedprice <= l_quantity * 900",
                                          check_id="price"),
        pl.expect_query_to_return_no_rows("SELECT * FROM {table} WHERE l_discount > 1", check_id="discount"),
        pl.expect_query_to_return_no_rows(
            "SELECT l_orderkey FROM {table} GROUP BY l_orderkey HAVING sum(l_quantity) > 300", check_id="orders"
        ),
    ]
    return pl.Suite(rules).verdicts(table(spark, sf_dir, "lineitem")).select("check_id", "unexpected_count", "success")


@query(
    "sql_constraints_shared",
    """SELECT 'cheap' AS check_id, count(*) AS unexpected_count, count(*) = 0 AS success FROM lineitem WHERE l_extendedprice <= l_quantity * 900
UNION ALL SELECT 'discount', count(*), count(*) = 0 FROM lineitem WHERE l_discount > 1
UNION ALL SELECT 'flag', count(*), count(*) = 0 FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'O' AND l_tax > 0.05
UNION ALL SELECT 'null', count(*), count(*) = 0 FROM lineitem WHERE nullif(l_returnflag, 'A') <> 'N'
UNION ALL SELECT 'negated', count(*), count(*) = 0 FROM (SELECT -l_quantity AS l_quantity FROM lineitem) WHERE l_quantity > -2
UNION ALL SELECT 'first', 1, false""",
)
def sql_constraints_shared(spark, sf_dir):
    """Filters of the table, which share a scan, beside queries that only look like one."""
    queries = {
        "cheap": "SELECT * FROM {table} WHERE l_extendedprice <= l_quantity * 900",
        "discount": "SELECT l_orderkey + 1 AS k FROM {table} AS t WHERE t.l_discount > 1",
        "flag": "SELECT * FROM (SELECT * FROM {table} WHERE l_returnflag = 'R' AND l_linestatus = 'O') WHERE l_tax > 0.05",
        "null": "SELECT * FROM {table} WHERE nullif(l_returnflag, 'A') <> 'N'",
        "negated": "SELECT * FROM (SELECT -l_quantity AS l_quantity FROM {table}) WHERE l_quantity > -2",
        "first": "SELECT * FROM {table} LIMIT 1",
    }
    suite = pl.Suite([pl.expect_query_to_return_no_rows(q, check_id=name) for name, q in queries.items()])
    return suite.verdicts(table(spark, sf_dir, "lineitem")).select("check_id", "unexpected_count", "success")


MIXED = """SELECT event_id, event_type, value, ts, user_id FROM events"""


@query(
    "suite_mixed_types",
    """SELECT 'pair' AS check_id, false AS success, true AS told, NULL::BIGINT AS unexpected_count
UNION ALL SELECT 'greater', false, true, NULL
UNION ALL SELECT 'record', false, true, NULL
UNION ALL SELECT 'time', false, true, NULL
UNION ALL SELECT 'fails as it runs', false, true, NULL
UNION ALL SELECT 'is not analysed', false, true, NULL
UNION ALL SELECT 'keys.missing_from_left', false, true, NULL
UNION ALL SELECT 'keys.missing_from_right', false, true, NULL
UNION ALL SELECT 'range', count(*) FILTER (WHERE NOT value <= 100) = 0, false, count(*) FILTER (WHERE NOT value <= 100) FROM events
UNION ALL SELECT 'query', count(*) = 0, false, count(*) FROM events WHERE value > 400""",
)
def suite_mixed_types(spark, sf_dir):
    """Checks that make no sense on their columns' types, or fail as they run, beside good ones: each is a verdict."""
    suite = pl.Suite(
        [
            pl.expect_column_pair_values_to_be_equal("event_type", "value", check_id="pair"),
            pl.expect_column_pair_values_a_to_be_greater_than_b("event_type", "user_id", check_id="greater"),
            pl.expect_select_column_values_to_be_unique_within_record(["user_id", "event_type"], check_id="record"),
            pl.expect_column_pair_values_to_be_equal("ts", "value", check_id="time"),
            pl.expect_query_to_return_no_rows("SELECT * FROM {table} WHERE CAST(event_type AS INT) > 0", check_id="fails as it runs"),
            pl.expect_query_to_return_no_rows("SELECT * FROM {table} WHERE nowhere > 0", check_id="is not analysed"),
            pl.expect_column_values_to_be_between("value", max_value=100, check_id="range"),
            pl.expect_query_to_return_no_rows("SELECT * FROM {table} WHERE value > 400", check_id="query"),
        ]
    )
    events = from_sql(spark, sf_dir, MIXED, "events")
    keys = pl.compare_keys(events, events, ["user_id"], ["event_type"], check_id="keys")
    verdicts = suite.verdicts(events).unionByName(keys)
    return verdicts.select("check_id", "success", F.col("observed_text").isNotNull().alias("told"), "unexpected_count")


def parity(verdicts: DataFrame) -> DataFrame:
    return verdicts.select("check_id", "element_count", "unexpected_count", "success")


@query(
    "compare_counts",
    """SELECT 'compare_row_counts' AS check_id, n AS element_count, abs(n - m) AS unexpected_count, n = m AS success
FROM (SELECT (SELECT count(*) FROM documents) AS n, (SELECT count(*) FROM labels) AS m)""",
)
def compare_counts(spark, sf_dir):
    return parity(pl.compare_row_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


@query(
    "compare_keys",
    """WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders), b AS (SELECT DISTINCT c_custkey AS k FROM customer)
SELECT 'compare_keys.missing_from_right' AS check_id, (SELECT count(*) FROM a) AS element_count,
       count(*) AS unexpected_count, count(*) = 0 AS success FROM a WHERE k NOT IN (SELECT k FROM b)
UNION ALL
SELECT 'compare_keys.missing_from_left', (SELECT count(*) FROM b), count(*), count(*) = 0
FROM b WHERE k NOT IN (SELECT k FROM a)""",
)
def compare_keys(spark, sf_dir):
    return parity(
        pl.compare_keys(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"), ["o_custkey"], ["c_custkey"])
    )


@query(
    "compare_aggs",
    """SELECT 'compare_aggregates.lines' AS check_id,
       round(abs((SELECT count(*) FROM lineitem) - (SELECT count(*) FROM orders))::DOUBLE, 6) AS observed_num,
       (SELECT count(*) FROM lineitem) = (SELECT count(*) FROM orders) AS success
UNION ALL
SELECT 'compare_aggregates.first_key',
       abs((SELECT min(l_orderkey) FROM lineitem) - (SELECT min(o_orderkey) FROM orders))::DOUBLE,
       (SELECT min(l_orderkey) FROM lineitem) = (SELECT min(o_orderkey) FROM orders)""",
)
def compare_aggs(spark, sf_dir):
    return pl.compare_aggregates(
        table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"),
        {"lines": F.count(F.lit(1)), "first_key": F.min("l_orderkey")},
        {"lines": F.count(F.lit(1)), "first_key": F.min("o_orderkey")},
    ).select("check_id", F.round("observed_num", 6).alias("observed_num"), "success")


RELABELLED = """SELECT CASE WHEN event_type = 'signup' THEN 'view' ELSE event_type END AS event_type, user_id
FROM events"""


@query(
    "compare_rows",
    f"""WITH a AS (SELECT event_type, user_id FROM events), b AS ({RELABELLED})
SELECT 'compare_rows.missing_from_right' AS check_id, (SELECT count(*) FROM a) AS element_count,
       count(*) AS unexpected_count, count(*) = 0 AS success FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
UNION ALL
SELECT 'compare_rows.missing_from_left', (SELECT count(*) FROM b), count(*), count(*) = 0
FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""",
)
def compare_rows(spark, sf_dir):
    changed = from_sql(spark, sf_dir, RELABELLED, "events")
    return parity(pl.compare_rows(table(spark, sf_dir, "events"), changed, ["event_type", "user_id"]))


@query(
    "row_differences",
    f"""WITH a AS (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL),
b AS (SELECT event_type, user_id, count(*) AS n FROM ({RELABELLED}) GROUP BY ALL)
SELECT event_type, user_id, greatest(coalesce(a.n, 0) - coalesce(b.n, 0), 0) AS only_left,
       greatest(coalesce(b.n, 0) - coalesce(a.n, 0), 0) AS only_right
FROM a FULL JOIN b USING (event_type, user_id) WHERE a.n IS DISTINCT FROM b.n""",
)
def row_differences(spark, sf_dir):
    changed = from_sql(spark, sf_dir, RELABELLED, "events")
    return pl.row_differences(table(spark, sf_dir, "events"), changed, ["event_type", "user_id"])


@query(
    "compare_mixed_numbers",
    f"""WITH t AS ({WIDE_KEYS}), a AS (SELECT DISTINCT k FROM t), b AS (SELECT DISTINCT x::BIGINT AS k FROM t)
SELECT 'keys.missing_from_right' AS check_id, (SELECT count(*) FROM a) AS element_count, count(*) AS unexpected_count, count(*) = 0 AS success
FROM a WHERE k NOT IN (SELECT k FROM b)
UNION ALL SELECT 'keys.missing_from_left', (SELECT count(*) FROM b), count(*), count(*) = 0 FROM b WHERE k NOT IN (SELECT k FROM a)
UNION ALL SELECT 'rows.missing_from_right', (SELECT count(*) FROM t), count(*), count(*) = 0 FROM (SELECT k, n FROM t EXCEPT ALL SELECT x::BIGINT, n FROM t)
UNION ALL SELECT 'rows.missing_from_left', (SELECT count(*) FROM t), count(*), count(*) = 0 FROM (SELECT x::BIGINT, n FROM t EXCEPT ALL SELECT k, n FROM t)
UNION ALL SELECT 'aggregates.highest', NULL, NULL, max(k) = max(x)::BIGINT FROM t
UNION ALL SELECT 'aggregates.first', NULL, NULL, min(k) = min(k - 1) FROM t
UNION ALL SELECT 'aggregates.nan', NULL, NULL, true
UNION ALL SELECT 'aggregates.flag', NULL, NULL, true
UNION ALL SELECT 'aggregates.odd', NULL, NULL, false""",
)
def compare_mixed_numbers(spark, sf_dir):
    """Whole numbers beyond 2**53 against floating-point ones, NaN, and texts."""
    wide = from_sql(spark, sf_dir, WIDE_KEYS, "lineitem")
    measures = {
        "highest": F.max("k"), "first": F.min("k"), "nan": F.max(F.lit(float("nan"))), "flag": F.min(F.lit("flag")), "odd": F.max("k"),
    }
    others = measures | {"highest": F.max("x"), "first": F.min(F.col("k") - 1), "odd": F.max(F.lit("9"))}
    left, right = wide.select("k", "n"), wide.select(F.col("x").alias("k"), "n")
    parts = [
        parity(pl.compare_keys(left, right, ["k"], check_id="keys")),
        parity(pl.compare_rows(left, right, ["k", "n"], check_id="rows")),
        parity(pl.compare_aggregates(wide, wide, measures, others, check_id="aggregates")),
    ]
    return reduce(DataFrame.unionByName, parts)


ORDER_COLUMNS = "o_orderkey, o_orderdate, o_totalprice, o_orderpriority"
CHANGED_ORDERS = """SELECT o_orderkey, o_orderdate, CASE WHEN o_orderkey % 5000 = 7 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
    o_orderpriority FROM orders WHERE o_orderkey % 7001 <> 3"""


def bag_sql(check_id: str, left: str, right: str) -> str:
    return f"""SELECT '{check_id}.missing_from_right' AS check_id, (SELECT count(*) FROM ({left})) AS element_count,
       count(*) AS unexpected_count, count(*) = 0 AS success FROM (({left}) EXCEPT ALL ({right}))
UNION ALL SELECT '{check_id}.missing_from_left', (SELECT count(*) FROM ({right})), count(*), count(*) = 0 FROM (({right}) EXCEPT ALL ({left}))"""


@query(
    "compare_digests",
    "\nUNION ALL\n".join(
        [
            bag_sql("by_key", f"SELECT {ORDER_COLUMNS} FROM orders", CHANGED_ORDERS),
            bag_sql("by_date", CHANGED_ORDERS, f"SELECT {ORDER_COLUMNS} FROM orders"),
            bag_sql("by_text", f"SELECT {ORDER_COLUMNS} FROM orders", CHANGED_ORDERS),
            bag_sql("equal", f"SELECT {ORDER_COLUMNS} FROM orders", f"SELECT {ORDER_COLUMNS} FROM orders"),
            bag_sql("hot", "SELECT event_type, user_id FROM events", RELABELLED),
        ]
    ),
)
def compare_digests(spark, sf_dir):
    """Few differences between large tables: by a number, a date, texts, and a key that few values hold."""
    orders, changed = table(spark, sf_dir, "orders"), from_sql(spark, sf_dir, CHANGED_ORDERS, "orders")
    columns = ORDER_COLUMNS.split(", ")
    events, relabelled = table(spark, sf_dir, "events"), from_sql(spark, sf_dir, RELABELLED, "events")
    parts = [
        pl.compare_digests(orders, changed, ["o_orderkey"], columns, check_id="by_key", few_rows=100),
        pl.compare_digests(changed, orders, ["o_orderdate"], columns, check_id="by_date"),
        pl.compare_digests(orders, changed, ["o_orderpriority", "o_orderkey"], columns, check_id="by_text", few_rows=10),
        pl.compare_digests(orders, orders, ["o_orderkey"], columns, check_id="equal"),
        pl.compare_digests(events, relabelled, ["event_type"], ["event_type", "user_id"], check_id="hot", few_rows=10),
    ]
    return reduce(DataFrame.unionByName, [parity(p) for p in parts])


# ------------------------------------------------------------------ suites


@query(
    "suite_overflow",
    """SELECT 'sum' AS check_id, false AS success, 'beyond 38 digits' AS observed_text FROM (SELECT count(*) FROM lineitem)
UNION ALL SELECT 'mean', false, 'beyond 38 digits'
UNION ALL SELECT 'columns', false, NULL
UNION ALL SELECT 'quantity', avg(l_quantity) BETWEEN 1 AND 50, NULL FROM lineitem
UNION ALL SELECT 'highest', true, '99999999999999999999999999999999999999'
UNION ALL SELECT 'lines', sum(l_linenumber) >= 1, sum(l_linenumber)::BIGINT::VARCHAR FROM lineitem""",
)
def suite_overflow(spark, sf_dir):
    """Decimals that overflow are failed checks beside unchanged others."""
    nines = "CAST('" + "9" * 38 + "' AS DECIMAL(38, 0))"
    rows = from_sql(spark, sf_dir, f"SELECT {nines} AS big, {nines} AS other, l_quantity, l_linenumber FROM lineitem", "lineitem")
    return pl.Suite(
        [
            pl.expect_column_sum_to_be_between("big", 0, None, check_id="sum"),
            pl.expect_column_mean_to_be_between("big", 0, None, check_id="mean"),
            pl.expect_multicolumn_sum_to_equal(["big", "other"], 5, check_id="columns"),
            pl.expect_column_mean_to_be_between("l_quantity", 1, 50, check_id="quantity"),
            pl.expect_column_max_to_be_between("big", 0, None, check_id="highest"),
            pl.expect_column_sum_to_be_between("l_linenumber", 1, None, check_id="lines"),
        ]
    ).verdicts(rows).select("check_id", "success", "observed_text")


DAYS = "SELECT *, CAST(ts AS DATE) AS day, nullif(event_type, 'click') AS kind FROM events"


@query(
    "suite_by_slice",
    f"""WITH t AS ({DAYS})
SELECT 'kind' AS check_id, count(*) AS element_count, count(*) FILTER (WHERE kind IS NULL) AS unexpected_count, NULL::DOUBLE AS observed_num,
    count(kind)::DOUBLE / count(*) >= 0.9 AS success FROM t
UNION ALL SELECT 'value', count(*), count(*) FILTER (WHERE NOT value BETWEEN 5 AND 400), NULL, false FROM t
UNION ALL SELECT 'mean', count(*), NULL, round(avg(value), 6), avg(value) BETWEEN 40 AND 60 FROM t
UNION ALL SELECT 'deviation', count(*), NULL, round(stddev_samp(value), 6), stddev_samp(value) <= 10 FROM t
UNION ALL SELECT 'most', count(*), NULL, round(max(value), 6), true FROM t
UNION ALL SELECT 'sum', count(*), NULL, sum(event_id)::DOUBLE, sum(event_id) >= 1 FROM t
UNION ALL SELECT 'rows', count(*), NULL, count(*)::DOUBLE, count(*) > 100 FROM t
UNION ALL SELECT 'unique', count(*), count(*) - count(DISTINCT event_id), NULL, count(*) = count(DISTINCT event_id) FROM t
UNION ALL SELECT 'users', count(*), NULL, count(DISTINCT user_id)::DOUBLE, false FROM t
UNION ALL SELECT 'median', count(*), NULL, round(median(value), 6), median(value) >= 1 FROM t
UNION ALL SELECT 'large', NULL, count(*), count(*)::DOUBLE, count(*) = 0 FROM t WHERE value > 400""",
)
def suite_by_slice(spark, sf_dir):
    """Validated when two thirds of the days were there, then again with all: the second run reads the new days."""
    events = from_sql(spark, sf_dir, DAYS, "events")
    suite = pl.Suite(
        [
            pl.expect_column_values_to_not_be_null("kind", mostly=0.9, check_id="kind"),
            pl.expect_column_values_to_be_between("value", 5, 400, check_id="value"),
            pl.expect_column_mean_to_be_between("value", 40, 60, check_id="mean"),
            pl.expect_column_stdev_to_be_between("value", None, 10, check_id="deviation"),
            pl.expect_column_max_to_be_between("value", 0, None, check_id="most"),
            pl.expect_column_sum_to_be_between("event_id", 1, None, check_id="sum"),
            pl.expect_table_row_count_to_be_between(101, None, check_id="rows"),
            pl.expect_column_values_to_be_unique("event_id", check_id="unique"),
            pl.expect_column_unique_value_count_to_be_between("user_id", 0, 1, check_id="users"),
            pl.expect_column_median_to_be_between("value", 1, None, check_id="median"),
            pl.expect_query_to_return_no_rows("SELECT * FROM {table} WHERE value > 400", check_id="large"),
        ]
    )
    folder = scratch_folder(spark)
    pl.verdicts_by_slice(suite, events.filter("day <= DATE'2024-01-20'"), "day", folder)
    found = pl.verdicts_by_slice(suite, events, "day", folder)
    return found.select("check_id", "element_count", "unexpected_count", F.round("observed_num", 6).alias("observed_num"), "success")


@query(
    "suite_trend",
    """WITH t AS (SELECT year(o_orderdate)::VARCHAR AS run_id, count(*) AS n, avg(o_totalprice) AS price,
    100::DOUBLE * count(*) FILTER (WHERE NOT o_totalprice <= 450000) / count(*) AS dear FROM orders GROUP BY ALL),
v AS (SELECT 'rows' AS check_id, run_id, n::DOUBLE AS observed, n >= (SELECT avg(n) FROM t) AS success FROM t
    UNION ALL SELECT 'price', run_id, price, price <= (SELECT avg(price) FROM t) FROM t
    UNION ALL SELECT 'dear', run_id, dear, dear <= 10 FROM t),
w AS (SELECT *, lag(observed) OVER o AS previous, count(observed) OVER b AS earlier_runs, avg(observed) OVER b AS mean, stddev_samp(observed) OVER b AS deviation,
    lag(success) OVER o AS was, sum(success::INT) OVER (PARTITION BY check_id ORDER BY run_id) AS stretch FROM v
    WINDOW o AS (PARTITION BY check_id ORDER BY run_id), b AS (PARTITION BY check_id ORDER BY run_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING))
SELECT check_id, run_id, success, round(observed, 4) AS observed, round(observed - previous, 4) AS change, earlier_runs, round(mean, 4) AS mean, round(deviation, 4) AS deviation,
    CASE WHEN earlier_runs >= 2 THEN abs(observed - mean) > 1.5 * deviation END AS unusual,
    count(*) FILTER (WHERE NOT success) OVER (PARTITION BY check_id, stretch ORDER BY run_id) AS failing_runs, coalesce(was <> success, false) AS turned
FROM w""",
)
def suite_trend(spark, sf_dir):
    """A run for each year's orders, recorded, and every check beside its three earlier runs."""
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    per_year = orders.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.avg("o_totalprice").alias("price"))
    norm = per_year.agg(F.avg("n").alias("n"), F.avg("price").alias("price")).first()
    suite = pl.Suite(
        [
            pl.expect_table_row_count_to_be_between(norm["n"], None, check_id="rows"),
            pl.expect_column_mean_to_be_between("o_totalprice", None, norm["price"], check_id="price"),
            pl.expect_column_values_to_be_between("o_totalprice", None, 450000, mostly=0.9, check_id="dear"),
        ]
    )
    path = scratch_folder(spark) + "/runs"
    for (year,) in per_year.select("year").orderBy("year").collect():  # a run per year
        pl.record_run(suite.verdicts(orders.filter(F.col("year") == year)), path, datetime.datetime(year, 12, 31), str(year))
    found = pl.trend(pl.history(spark, path), earlier=3, tolerance=1.5)
    rounded = [F.round(c, 4).alias(c) for c in ("observed", "change", "mean", "deviation")]
    return found.select("check_id", "run_id", "success", *rounded, "earlier_runs", "unusual", "failing_runs", "turned")


def event_rules() -> list:
    return [
        pl.expect_column_values_to_not_be_null("event_type", mostly=0.99, check_id="e01"),
        pl.expect_column_values_to_be_between("value", 5, 400, mostly=0.9, check_id="e02"),
        pl.expect_column_values_to_be_in_set("event_type", ["click", "view"], check_id="e03"),
        pl.expect_column_values_to_match_regex("props", r"[0-9]", check_id="e04"),
        pl.expect_column_max_to_be_between("value", 0, 10000, check_id="e05"),
        pl.expect_column_mean_to_be_between("value", 50, 500, check_id="e06"),
        pl.expect_table_row_count_to_be_between(50, 10000, check_id="e07"),
        pl.expect_column_distinct_values_to_equal_set("event_type", EVENT_TYPES, check_id="e08"),
        pl.expect_column_values_to_be_unique("event_id", check_id="e09"),
        pl.expect_column_median_to_be_between("value", 40, 400, check_id="e10"),
        pl.expect_query_to_return_no_rows("SELECT * FROM {table} WHERE value > 400", check_id="e11"),
        pl.expect_column_values_to_not_be_null("no_such_column", check_id="e12"),
    ]


EVENT_VERDICTS = """SELECT 'e01' AS check_id, count(event_type)::DOUBLE / count(*) >= 0.99 AS success FROM events
UNION ALL SELECT 'e02', (count(*) FILTER (WHERE value BETWEEN 5 AND 400))::DOUBLE / count(value) >= 0.9 FROM events
UNION ALL SELECT 'e03', bool_and(event_type IN ('click', 'view')) FROM events
UNION ALL SELECT 'e04', bool_and(regexp_matches(props, '[0-9]')) FROM events
UNION ALL SELECT 'e05', max(value) BETWEEN 0 AND 10000 FROM events
UNION ALL SELECT 'e06', avg(value) BETWEEN 50 AND 500 FROM events
UNION ALL SELECT 'e07', count(*) BETWEEN 50 AND 10000 FROM events
UNION ALL SELECT 'e08', list_sort(list(DISTINCT event_type)) = ['click', 'error', 'purchase', 'signup', 'view'] FROM events
UNION ALL SELECT 'e09', count(DISTINCT event_id) = count(event_id) FROM events
UNION ALL SELECT 'e10', median(value) BETWEEN 40 AND 400 FROM events
UNION ALL SELECT 'e11', count(*) = 0 FROM events WHERE value > 400"""


@query("suite_verdicts", EVENT_VERDICTS)
def suite_verdicts(spark, sf_dir):
    return pl.Suite(event_rules()).verdicts(table(spark, sf_dir, "events")).select("check_id", "success")


@query(
    "suite_stats",
    f"""SELECT count(*) AS evaluated_expectations, count(*) FILTER (WHERE success) AS successful_expectations,
       count(*) FILTER (WHERE NOT success) AS unsuccessful_expectations,
       round(100::DOUBLE * count(*) FILTER (WHERE success) / count(*), 6) AS success_percent
FROM ({EVENT_VERDICTS})""",
)
def suite_stats(spark, sf_dir):
    stats = pl.statistics(pl.Suite(event_rules()).verdicts(table(spark, sf_dir, "events")))
    return stats.withColumn("success_percent", F.round("success_percent", 6))


@query("suite_failures", f"SELECT check_id FROM ({EVENT_VERDICTS}) WHERE NOT success")
def suite_failures(spark, sf_dir):
    return pl.failures(pl.Suite(event_rules()).verdicts(table(spark, sf_dir, "events"))).select("check_id")


@query(
    "suite_guard",
    """SELECT 'e12' AS check_id, 'no_such_column' AS missing_columns, count(*) AS unchecked_rows FROM events""",
)
def suite_guard(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    rows = events.agg(F.count(F.lit(1)).alias("unchecked_rows"))
    skipped = pl.Suite(event_rules()).skipped(events).select("check_id", "missing_columns")
    return skipped.withColumn("unchecked_rows", rows.scalar())


def failing_sql(*checks: tuple) -> str:
    """(check id, value, source of the offending rows, order of ties): the 20 most frequent, with totals."""
    return "\nUNION ALL\n".join(
        f"""SELECT '{check_id}' AS check_id, value, n, distinct_values, failing_rows FROM (
  SELECT value, n, count(*) OVER () AS distinct_values, (sum(n) OVER ())::BIGINT AS failing_rows
  FROM (SELECT {value} AS value, count(*) AS n FROM {source} GROUP BY {value} {having}) ORDER BY n DESC, {ties} LIMIT 20)"""
        for check_id, value, source, having, ties in checks
    )


@query(
    "failing_values",
    failing_sql(
        ("kind", "event_type", "events WHERE event_type NOT IN ('view')", "", "md5(value)"),
        ("user", "user_id::VARCHAR", "events WHERE NOT user_id >= 100", "", "value"),
        ("unique", "user_id::VARCHAR", "events", "HAVING count(*) > 1", "value"),
    ),
)
def failing_values(spark, sf_dir):
    suite = pl.Suite(
        [
            pl.expect_column_values_to_be_in_set("event_type", ["view"], check_id="kind"),
            pl.expect_column_values_to_be_between("user_id", min_value=100, check_id="user"),
            pl.expect_column_values_to_be_unique("user_id", check_id="unique"),
        ]
    )
    return suite.failing_values(table(spark, sf_dir, "events"))


@query(
    "failing_texts",
    failing_sql(
        ("length", "text", "documents WHERE NOT length(text) BETWEEN 500 AND 5000", "", "md5(value)"),
        ("unique", "text", "documents", "HAVING count(*) > 1", "md5(value)"),
        ("lang", "lang", "documents WHERE lang NOT IN ('en', 'de')", "", "md5(value)"),
    ),
)
def failing_texts(spark, sf_dir):
    suite = pl.Suite(
        [
            pl.expect_column_value_lengths_to_be_between("text", 500, 5000, check_id="length"),
            pl.expect_column_values_to_be_unique("text", check_id="unique"),
            pl.expect_column_distinct_values_to_be_in_set("lang", ["en", "de"], check_id="lang"),
        ]
    )
    return suite.failing_values(table(spark, sf_dir, "documents"))


# ------------------------------------------------------------------ the full suite on a 33-column table

# The columns of the table under test, in their contracted order.
RECORD_COLUMNS = [
    "row_id", "nullable_comment", "all_null_col", "required_col", "amount", "score", "measure_a", "measure_b",
    "fixed_sum_1", "fixed_sum_2", "fixed_sum_3", "category", "business_key", "status", "country_cd", "currency_cd",
    "name_txt", "exact_len_2", "forbidden_token", "like_code", "free_text", "email", "regex_id", "regex_list_id",
    "phone10", "postal_code", "equal_col_a", "equal_col_b", "code_a", "code_b", "code_c", "compound_key_1",
    "compound_key_2",
]

# That table, derived from every row of orders; the text reads the same in both engines.
RECORDS = """SELECT
  o_orderkey AS row_id,
  nullif(o_orderpriority, '5-LOW') AS nullable_comment,
  CAST(nullif(o_orderstatus, o_orderstatus) AS STRING) AS all_null_col,
  nullif(o_orderstatus, 'P') AS required_col,
  o_totalprice / 1000 AS amount,
  o_totalprice AS score,
  o_custkey AS measure_a,
  CAST(month(o_orderdate) AS BIGINT) AS measure_b,
  CAST(day(o_orderdate) AS INT) AS fixed_sum_1,
  CAST(60 - day(o_orderdate) AS INT) AS fixed_sum_2,
  CAST(40 AS INT) AS fixed_sum_3,
  CASE o_orderstatus WHEN 'O' THEN 'A' WHEN 'F' THEN 'B' ELSE 'C' END AS category,
  CAST(o_custkey AS STRING) AS business_key,
  CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'F' THEN 'PENDING' ELSE 'CLOSED' END AS status,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'IN' WHEN '2-HIGH' THEN 'US' ELSE 'SG' END AS country_cd,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'INR' WHEN '2-HIGH' THEN 'USD' WHEN '5-LOW' THEN 'USD' ELSE 'SGD' END
    AS currency_cd,
  o_orderpriority AS name_txt,
  substr(o_orderpriority, 1, 2) AS exact_len_2,
  CASE WHEN o_orderstatus = 'P' THEN 'INVALID' ELSE o_orderstatus END AS forbidden_token,
  concat('L-', o_orderstatus) AS like_code,
  CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN 'BAD-1'
       WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN 'UNWANTED text' ELSE 'plain' END AS free_text,
  CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'nobody'
       ELSE concat('u', CAST(o_custkey AS STRING), '@shop.example') END AS email,
  concat('EMP', lpad(CAST(o_custkey AS STRING), 4, '0')) AS regex_id,
  concat(CASE WHEN o_orderstatus = 'O' THEN 'AA-' ELSE 'BB-' END, lpad(CAST(day(o_orderdate) AS STRING), 3, '0'))
    AS regex_list_id,
  lpad(CAST(o_custkey AS STRING), 10, '0') AS phone10,
  concat(lpad(CAST(o_custkey AS STRING), 5, '0'), CASE o_orderstatus WHEN 'P' THEN '-0001' WHEN 'F' THEN '-1' ELSE '' END)
    AS postal_code,
  o_orderpriority AS equal_col_a,
  CASE WHEN o_orderstatus = 'P' THEN nullif(o_orderpriority, '5-LOW')
       ELSE CASE o_orderpriority WHEN '3-MEDIUM' THEN '2-HIGH' ELSE o_orderpriority END END AS equal_col_b,
  o_orderstatus AS code_a,
  substr(o_orderpriority, 3, 1) AS code_b,
  nullif(substr(o_orderpriority, 4, 1), 'R') AS code_c,
  CAST(o_custkey AS STRING) AS compound_key_1,
  o_orderpriority AS compound_key_2
FROM orders"""

# Thresholds, sets and patterns of the checks.
CATEGORIES = ["A", "B", "C"]
CATEGORY_WEIGHTS = [0.3, 0.3, 0.4]
STATUSES = ["ACTIVE", "PENDING", "INACTIVE"]
COUNTRY_CURRENCY = [("IN", "INR"), ("US", "USD"), ("SG", "SGD")]
FORBIDDEN_TOKENS = ["DROP", "NULL", "INVALID"]
FORBIDDEN_REGEXES = [r"BAD-.*", r"FORBIDDEN.*"]
FORBIDDEN_LIKE = ["UNWANTED%", "BAD-%"]
EMAIL = r"[^@\s]+@[^@\s]+\.[^@\s]+"
EMPLOYEE_ID = r"^EMP[0-9]{4}$"
CODE_LIST = [r"^(AA|BB)-[0-9]{3}$"]
PHONE = r"^[0-9]{10}$"
POSTAL_CODE = r"^[0-9]{5}(-[0-9]{4})?$"
AMOUNT_QUANTILES = {"quantiles": [0.25, 0.5, 0.75], "value_ranges": [[10, 200], [20, 400], [50, 800]]}


def record_rules() -> list:
    return [
        # completeness
        pl.expect_column_values_to_be_null("all_null_col", check_id="r01"),
        pl.expect_column_values_to_not_be_null("required_col", mostly=0.99, check_id="r02"),
        # numbers
        pl.expect_column_max_to_be_between("amount", 0.0, 10000.0, check_id="r03"),
        pl.expect_column_mean_to_be_between("amount", 50.0, 500.0, check_id="r04"),
        pl.expect_column_median_to_be_between("amount", 40.0, 400.0, check_id="r05"),
        pl.expect_column_min_to_be_between("amount", 0.0, 10000.0, check_id="r06"),
        pl.expect_column_quantile_values_to_be_between("amount", quantile_ranges=AMOUNT_QUANTILES, check_id="r07"),
        pl.expect_column_stdev_to_be_between("amount", 0.0, 1000.0, check_id="r08"),
        pl.expect_column_sum_to_be_between("amount", 100.0, 1_000_000.0, check_id="r09"),
        pl.expect_column_values_to_be_between("amount", 0.0, 2000.0, check_id="r10"),
        pl.expect_column_pair_values_a_to_be_greater_than_b("measure_a", "measure_b", check_id="r11"),
        pl.expect_multicolumn_sum_to_equal(["fixed_sum_1", "fixed_sum_2", "fixed_sum_3"], 100, check_id="r12"),
        pl.expect_column_kl_divergence_to_be_less_than(
            "category", {"values": CATEGORIES, "weights": CATEGORY_WEIGHTS}, threshold=0.5, check_id="r13"
        ),
        # schema
        pl.expect_column_to_exist("row_id", check_id="r14"),
        pl.expect_column_values_to_be_of_type("amount", type_="DoubleType", check_id="r15"),
        pl.expect_column_values_to_be_in_type_list("measure_a", ["IntegerType", "LongType"], check_id="r16"),
        pl.expect_table_column_count_to_be_between(30, 40, check_id="r17"),
        pl.expect_table_column_count_to_equal(32, check_id="r18"),
        pl.expect_table_columns_to_match_ordered_list(RECORD_COLUMNS, check_id="r19"),
        pl.expect_table_columns_to_match_set(set(RECORD_COLUMNS), check_id="r20"),
        # validity
        pl.expect_column_most_common_value_to_be_in_set("status", STATUSES, check_id="r21"),
        pl.expect_column_pair_values_to_be_equal("equal_col_a", "equal_col_b", check_id="r22"),
        pl.expect_column_pair_values_to_be_in_set("country_cd", "currency_cd", COUNTRY_CURRENCY, check_id="r23"),
        pl.expect_column_value_lengths_to_be_between("name_txt", 3, 50, check_id="r24"),
        pl.expect_column_value_lengths_to_equal("exact_len_2", 2, check_id="r25"),
        pl.expect_column_values_to_be_in_set("category", CATEGORIES, check_id="r26"),
        pl.expect_column_values_to_not_be_in_set("forbidden_token", FORBIDDEN_TOKENS, check_id="r27"),
        pl.expect_column_values_to_match_regex("email", EMAIL, mostly=0.95, check_id="r28"),
        pl.expect_column_values_to_match_regex("regex_id", EMPLOYEE_ID, check_id="r29"),
        pl.expect_column_values_to_match_regex_list("regex_list_id", CODE_LIST, check_id="r30"),
        pl.expect_column_values_to_not_match_regex_list("free_text", FORBIDDEN_REGEXES, check_id="r31"),
        pl.expect_column_values_to_not_match_like_pattern_list("free_text", FORBIDDEN_LIKE, check_id="r32"),
        pl.expect_column_values_to_match_regex("phone10", PHONE, check_id="r33"),
        pl.expect_column_values_to_match_regex("postal_code", POSTAL_CODE, check_id="r34"),
        # uniqueness
        pl.expect_column_distinct_values_to_be_in_set("category", CATEGORIES, check_id="r35"),
        pl.expect_column_distinct_values_to_contain_set("category", CATEGORIES, check_id="r36"),
        pl.expect_column_distinct_values_to_equal_set("category", CATEGORIES, check_id="r37"),
        pl.expect_column_proportion_of_unique_values_to_be_between("business_key", 0.7, 1.0, check_id="r38"),
        pl.expect_column_unique_value_count_to_be_between("business_key", 10, 1000, check_id="r39"),
        pl.expect_column_values_to_be_unique("row_id", check_id="r40"),
        pl.expect_compound_columns_to_be_unique(["compound_key_1", "compound_key_2"], check_id="r41"),
        pl.expect_select_column_values_to_be_unique_within_record(
            ["code_a", "code_b", "code_c"], ignore_row_if="any_value_is_missing", check_id="r42"
        ),
        # volume
        pl.expect_table_row_count_to_be_between(50, 10000, check_id="r43"),
        pl.expect_table_row_count_to_equal(100, check_id="r44"),
        # constraints
        pl.expect_query_to_return_no_rows("SELECT * FROM {table} WHERE measure_a <= measure_b", check_id="r45"),
        pl.expect_query_to_return_no_rows("SELECT * FROM {table} WHERE equal_col_a <> equal_col_b", check_id="r46"),
        pl.expect_query_to_return_no_rows(
            "SELECT * FROM {table} WHERE fixed_sum_1 + fixed_sum_2 + fixed_sum_3 <> 100", check_id="r47"
        ),
    ]


def _record_sql() -> str:
    bad_rows = {  # check id: (rows that break it, least share that must hold among the rows evaluated)
        "r01": ("all_null_col IS NOT NULL", "true", 1.0),
        "r02": ("required_col IS NULL", "true", 0.99),
        "r10": ("NOT amount BETWEEN 0 AND 2000", "true", 1.0),
        "r11": ("NOT measure_a > measure_b", "true", 1.0),
        "r12": ("fixed_sum_1 + fixed_sum_2 + fixed_sum_3 <> 100", "true", 1.0),
        "r22": ("equal_col_a IS DISTINCT FROM equal_col_b", "true", 1.0),
        "r23": ("(country_cd, currency_cd) NOT IN (('IN', 'INR'), ('US', 'USD'), ('SG', 'SGD'))", "true", 1.0),
        "r24": ("NOT length(name_txt) BETWEEN 3 AND 50", "true", 1.0),
        "r25": ("length(exact_len_2) <> 2", "true", 1.0),
        "r26": ("category NOT IN ('A', 'B', 'C')", "true", 1.0),
        "r27": ("forbidden_token IN ('DROP', 'NULL', 'INVALID')", "true", 1.0),
        "r28": (f"NOT regexp_matches(email, '{EMAIL}')", "true", 0.95),
        "r29": (f"NOT regexp_matches(regex_id, '{EMPLOYEE_ID}')", "true", 1.0),
        "r30": (f"NOT regexp_matches(regex_list_id, '{CODE_LIST[0]}')", "true", 1.0),
        "r31": ("regexp_matches(free_text, 'BAD-.*') OR regexp_matches(free_text, 'FORBIDDEN.*')", "true", 1.0),
        "r32": ("free_text LIKE 'UNWANTED%' OR free_text LIKE 'BAD-%'", "true", 1.0),
        "r33": (f"NOT regexp_matches(phone10, '{PHONE}')", "true", 1.0),
        "r34": (f"NOT regexp_matches(postal_code, '{POSTAL_CODE}')", "true", 1.0),
        "r42": ("code_a = code_b OR code_a = code_c OR code_b = code_c", "code_c IS NOT NULL", 1.0),
    }
    measured = {  # check id: (aggregate, test of it as x)
        "r03": ("max(amount)", "x BETWEEN 0 AND 10000"),
        "r04": ("avg(amount)", "x BETWEEN 50 AND 500"),
        "r05": ("median(amount)", "x BETWEEN 40 AND 400"),
        "r06": ("min(amount)", "x BETWEEN 0 AND 10000"),
        "r08": ("stddev_samp(amount)", "x BETWEEN 0 AND 1000"),
        "r09": ("sum(amount)", "x BETWEEN 100 AND 1000000"),
        "r35": ("count(DISTINCT category)", "x = (SELECT count(DISTINCT category) FROM t WHERE category IN ('A','B','C'))"),
        "r36": ("count(DISTINCT category)", "(SELECT count(DISTINCT category) FROM t WHERE category IN ('A','B','C')) = 3"),
        "r37": ("count(DISTINCT category)", "x = 3 AND (SELECT bool_and(category IN ('A','B','C')) FROM t)"),
        "r38": ("count(DISTINCT business_key)::DOUBLE / count(business_key)", "x BETWEEN 0.7 AND 1.0"),
        "r39": ("count(DISTINCT business_key)", "x BETWEEN 10 AND 1000"),
        "r43": ("count(*)", "x BETWEEN 50 AND 10000"),
        "r44": ("count(*)", "x = 100"),
        "r45": ("count(*) FILTER (WHERE measure_a <= measure_b)", "x = 0"),
        "r46": ("count(*) FILTER (WHERE equal_col_a <> equal_col_b)", "x = 0"),
        "r47": ("count(*) FILTER (WHERE fixed_sum_1 + fixed_sum_2 + fixed_sum_3 <> 100)", "x = 0"),
    }
    described = {  # check id: (number shown, test over the described columns)
        "r14": ("-1", "count(*) FILTER (WHERE column_name = 'row_id') = 1"),
        "r15": ("-1", "count(*) FILTER (WHERE column_name = 'amount' AND column_type = 'DOUBLE') = 1"),
        "r16": ("-1", "count(*) FILTER (WHERE column_name = 'measure_a' AND column_type IN ('INTEGER', 'BIGINT')) = 1"),
        "r17": ("count(*)", "count(*) BETWEEN 30 AND 40"),
        "r18": ("count(*)", "count(*) = 32"),
        "r19": ("count(*)", f"list(column_name) = {RECORD_COLUMNS}"),
        "r20": ("count(*)", f"list_sort(list(column_name)) = {sorted(RECORD_COLUMNS)}"),
    }
    parts = [
        f"SELECT '{i}' AS check_id, (count(*) FILTER (WHERE ({kept}) AND ({bad})))::DOUBLE AS evidence, "
        f"(count(*) FILTER (WHERE ({kept}) AND NOT ({bad})))::DOUBLE / count(*) FILTER (WHERE {kept}) >= {mostly} AS success FROM t"
        for i, (bad, kept, mostly) in bad_rows.items()
    ]
    parts += [
        f"SELECT '{i}', round(x::DOUBLE, 6), {test} FROM (SELECT {aggregate} AS x FROM t)"
        for i, (aggregate, test) in measured.items()
    ]
    parts += [
        f"SELECT '{i}', ({shown})::DOUBLE, {test} FROM (DESCRIBE {RECORDS})" for i, (shown, test) in described.items()
    ]
    parts += [
        """SELECT 'r07', -1::DOUBLE, v[1] BETWEEN 10 AND 200 AND v[2] BETWEEN 20 AND 400 AND v[3] BETWEEN 50 AND 800
FROM (SELECT quantile_cont(amount, [0.25, 0.5, 0.75]) AS v FROM t)""",
        """SELECT 'r13', round(sum(p * ln(p / q)), 6), sum(p * ln(p / q)) < 0.5
FROM (SELECT category, count(*)::DOUBLE / (SELECT count(*) FROM t) AS p FROM t GROUP BY category)
JOIN (VALUES ('A', 0.3::DOUBLE), ('B', 0.3), ('C', 0.4)) w(category, q) USING (category)""",
        """SELECT 'r21', -1::DOUBLE, count(*) = 1 AND bool_and(status IN ('ACTIVE', 'PENDING', 'INACTIVE'))
FROM (SELECT status, count(*) AS n FROM t GROUP BY status QUALIFY n = max(n) OVER ())""",
        """SELECT 'r40', coalesce(sum(n) FILTER (WHERE n > 1), 0)::DOUBLE, max(n) = 1
FROM (SELECT row_id, count(*) AS n FROM t GROUP BY row_id)""",
        """SELECT 'r41', coalesce(sum(n) FILTER (WHERE n > 1), 0)::DOUBLE, max(n) = 1
FROM (SELECT compound_key_1, compound_key_2, count(*) AS n FROM t GROUP BY ALL)""",
    ]
    return f"WITH t AS ({RECORDS})\n" + "\nUNION ALL\n".join(parts)


@query("suite_records", _record_sql())
def suite_records(spark, sf_dir):
    verdicts = pl.Suite(record_rules()).verdicts(from_sql(spark, sf_dir, RECORDS, "orders"))
    evidence = F.coalesce(F.col("unexpected_count").cast("double"), F.round("observed_num", 6), F.lit(-1.0))
    return verdicts.select("check_id", evidence.alias("evidence"), "success")


# ------------------------------------------------------------------ driver contract


def entry(spark: SparkSession) -> DataFrame:
    """The full suite over a 33-column table: every kind of check in one verdict frame."""
    records = from_sql(spark, "/root/testdata/sf0.001", RECORDS, "orders")
    return pl.Suite(record_rules()).verdicts(records)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES) if llm is None else _QUERIES | llm.QUERIES | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    if llm is None:
        return dict(_ORACLES)
    return _ORACLES | llm.ORACLES | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
