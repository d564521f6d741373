"""Reports: statistics of a run, its failing checks, and the JSON document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import columns as C


def statistics(verdicts: DataFrame) -> DataFrame:
    """One row: how many checks were evaluated, how many passed, and the percentage."""
    n, good = F.count(F.lit(1)), C.count_where(F.col("success"))
    return verdicts.agg(
        n.alias("evaluated_expectations"),
        good.alias("successful_expectations"),
        (n - good).alias("unsuccessful_expectations"),
        F.try_divide(F.lit(100.0) * good, n).alias("success_percent"),
    )


def failures(verdicts: DataFrame) -> DataFrame:
    return verdicts.filter(~F.col("success"))


RESULT = (
    "element_count bigint, missing_count bigint, unexpected_count bigint, unexpected_percent double, observed_value variant, "
    "partial_unexpected_counts array<struct<value string, count bigint>>, unexpected_distinct bigint"
)
SCHEMA = (
    "success boolean, statistics struct<evaluated_expectations bigint, successful_expectations bigint, unsuccessful_expectations bigint, "
    "success_percent double>, results array<struct<check_id string, expectation_config struct<type string, columns string, kwargs variant>, "
    f"success boolean, result struct<{RESULT}>>>, skipped array<struct<check_id string, type string, missing_columns string>>, run_id struct<run_time timestamp>"
)


def report(
    verdicts: DataFrame, configs: DataFrame | None = None, skipped: DataFrame | None = None, failing: DataFrame | None = None
) -> DataFrame:
    """The whole run as one nested record, results in order of check id.

    ``configs``, ``skipped`` and ``failing`` are what a suite says of its checks: their arguments,
    the checks left out, and the failing values. What is gathered is a row per rule and a bounded
    sample of values, so it is little whatever the table's size.
    """
    text, number = F.col("observed_text"), F.col("observed_num")
    # exact digits where a check has them, a number where it has one, else the text
    observed = (
        F.when(number.isNotNull() & text.isNotNull(), F.coalesce(F.try_parse_json(text), number.cast("variant")))
        .when(number.isNotNull(), number.cast("variant"))
        .otherwise(text.cast("variant"))
    )
    rows = verdicts
    if configs is None:
        rows = rows.withColumn("kwargs", F.lit(None).cast("string"))
    else:
        rows = rows.join(F.broadcast(configs), "check_id", "left")
    sample = F.struct("value", F.col("n").alias("count"))
    if failing is None:
        rows = rows.withColumn("sample", F.lit(None).cast("array<struct<value:string,count:bigint>>")).withColumn("unexpected_distinct", F.lit(None).cast("bigint"))
    else:
        found = failing.groupBy("check_id").agg(
            F.array_sort(F.collect_list(sample), lambda a, b: F.when(a["count"] != b["count"], F.sign(b["count"] - a["count"]).cast("int")).when(a["value"] < b["value"], -1).otherwise(1)).alias("sample"),
            F.max("distinct_values").alias("unexpected_distinct"),
        )
        rows = rows.join(found, "check_id", "left")
    result = F.struct(
        F.col("check_id"),
        F.struct(F.col("kind").alias("type"), F.col("columns").alias("columns"), F.try_parse_json("kwargs").alias("kwargs")).alias("expectation_config"),
        F.col("success"),
        F.struct(
            "element_count", "missing_count", "unexpected_count", "unexpected_percent", observed.alias("observed_value"),
            F.col("sample").alias("partial_unexpected_counts"), "unexpected_distinct",
        ).alias("result"),
    )
    left_out = [] if skipped is None else [tuple(r) for r in skipped.collect()]  # local facts, a row per rule
    kind = "array<struct<check_id string, type string, missing_columns string>>"
    listed = [F.struct(*[F.lit(v).alias(k) for k, v in zip(("check_id", "type", "missing_columns"), r)]) for r in left_out]
    n, good = F.col("evaluated"), F.col("successful")
    return rows.agg(
        F.count(F.lit(1)).alias("evaluated"),
        C.count_where(F.col("success")).alias("successful"),
        F.array_sort(F.collect_list(result), lambda a, b: F.when(a.check_id < b.check_id, -1).otherwise(1)).alias("results"),
    ).select(
        (n == good).alias("success"),
        F.struct(
            n.alias("evaluated_expectations"),
            good.alias("successful_expectations"),
            (n - good).alias("unsuccessful_expectations"),
            F.try_divide(F.lit(100.0) * good, n).alias("success_percent"),
        ).alias("statistics"),
        "results",
        F.array(*listed).cast(kind).alias("skipped"),
        F.struct(F.current_timestamp().alias("run_time")).alias("run_id"),
    )


def write_report(
    verdicts: DataFrame, path: str, mode: str = "errorifexists",
    configs: DataFrame | None = None, skipped: DataFrame | None = None, failing: DataFrame | None = None,
) -> None:
    """Write the report as indented JSON under ``path`` (any file system Spark can write)."""
    document = report(verdicts, configs, skipped, failing)
    text = F.to_json(F.struct(*[C.column(c) for c in document.columns]), {"pretty": "true", "ignoreNullFields": "false"})
    document.select(text.alias("value")).coalesce(1).write.mode(mode).text(path)


def read_report(spark, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).json(path, multiLine=True)
