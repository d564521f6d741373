"""Data-quality checks on Spark tables.

>>> from plumbline import Suite, expect_column_values_to_not_be_null, statistics
>>> suite = Suite([expect_column_values_to_not_be_null("customer", mostly=0.99)])
>>> verdicts = suite.verdicts(spark.table("orders"))          # doctest: +SKIP
>>> statistics(verdicts).show()                               # doctest: +SKIP
"""

from plumbline import rules as _rules
from plumbline.operators.compare import (
    compare_aggregates,
    compare_keys,
    compare_row_counts,
    compare_rows,
    row_differences,
)
from plumbline.operators.digests import compare_digests, digest_differences
from plumbline.operators.frequency import frequency_table
from plumbline.operators.quantiles import exact_quantiles, quantile_table
from plumbline.operators.schema import observed_columns, schema_drift, schema_renames
from plumbline.plans.incremental import verdicts_by_slice
from plumbline.plans.suite import Suite
from plumbline.rules import *  # noqa: F403
from plumbline.sources.history import history, record_run, trend
from plumbline.sources.report import failures, read_report, report, statistics, write_report
from plumbline.sources.tables import latest_slice, newest_slice, newest_value, query_source, remove_staged, staged, staged_table, today_slice

__all__ = [
    *[name for name in dir(_rules) if name.startswith("expect_")],
    "Suite", "compare_aggregates", "compare_digests", "compare_keys", "compare_row_counts", "compare_rows", "digest_differences", "exact_quantiles",
    "failures", "frequency_table", "history", "latest_slice", "newest_slice", "newest_value", "observed_columns", "quantile_table", "query_source",
    "read_report", "record_run", "remove_staged", "report", "row_differences", "schema_drift", "schema_renames", "staged", "staged_table", "statistics",
    "today_slice", "trend", "verdicts_by_slice",
    "write_report",
]
