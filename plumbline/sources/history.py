"""History of runs: an append-only table of verdicts, and each check's results beside its earlier ones."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.functions import columns as C
from plumbline.operators.verdict import FIELDS

SCHEMA = "run_id string, run_time timestamp, " + ", ".join(f"{n} {t}" for n, t in FIELDS.items())


def record_run(verdicts: DataFrame, path: str, run_time: datetime.datetime | None = None, run_id: str | None = None) -> str:
    """Append the verdicts of a run to the table of all runs; its id is returned.

    Nothing that is there is rewritten, so runs of several jobs may be recorded at once. A run recorded twice under
    one id counts once, with the later time.
    """
    run_id = run_id or uuid.uuid4().hex
    moment = F.current_timestamp() if run_time is None else F.lit(run_time.isoformat()).cast("timestamp")
    rows = verdicts.select(F.lit(run_id).alias("run_id"), moment.alias("run_time"), *FIELDS)
    rows.coalesce(1).write.mode("append").parquet(path)  # a row per check
    return run_id


def history(spark: SparkSession, path: str) -> DataFrame:
    """All recorded verdicts: ``run_id``, ``run_time`` and the fields of a verdict."""
    again = Window.partitionBy("run_id", "check_id").orderBy(F.desc("run_time"))
    return spark.read.schema(SCHEMA).parquet(path).withColumn("again", F.row_number().over(again)).filter("again = 1").drop("again")


def trend(runs: DataFrame, earlier: int = 10, tolerance: float = 3.0) -> DataFrame:
    """Every recorded verdict beside the check's earlier ones.

    ``observed`` is what the check observed, or the share of unexpected rows in percent of a check that counts rows.
    ``previous`` and ``change`` compare it with the run before; ``mean`` and ``deviation`` (of a sample) are those of up to ``earlier`` runs
    before; ``unusual`` says that it lies more than ``tolerance`` deviations from their mean, or off it if they were all
    the same (null with fewer than two of them). ``failing_runs`` counts the failed runs in a row up to this one, and ``turned`` marks
    a check whose success changed. Runs are in the order of their time, then of their ids.
    """
    own = Window.partitionBy("check_id").orderBy("run_time", "run_id")
    before = own.rowsBetween(-earlier, -1)
    observed = F.coalesce("observed_num", "unexpected_percent")
    rows = runs.withColumn("observed", observed)
    rows = rows.withColumn("previous", F.lag("observed").over(own))
    rows = rows.withColumn("earlier_runs", F.count("observed").over(before)).withColumn("mean", F.avg("observed").over(before)).withColumn("deviation", F.stddev_samp("observed").over(before))
    away = F.abs(F.col("observed") - F.col("mean"))
    rows = rows.withColumn("unusual", F.when(F.col("earlier_runs") >= 2, away > F.lit(tolerance) * F.col("deviation")))
    # runs since the last success: each success begins a new stretch
    rows = rows.withColumn("stretch", F.sum(F.col("success").cast("int")).over(own.rowsBetween(Window.unboundedPreceding, 0)))
    streak = Window.partitionBy("check_id", "stretch").orderBy("run_time", "run_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("failing_runs", C.count_where(~F.col("success")).over(streak))
    turned = F.coalesce(F.lag("success").over(own) != F.col("success"), F.lit(False))
    return rows.select(
        "check_id", "run_id", "run_time", "success", "observed", "previous", (F.col("observed") - F.col("previous")).alias("change"), "earlier_runs", "mean", "deviation",
        "unusual", "failing_runs", turned.alias("turned"),
    )
