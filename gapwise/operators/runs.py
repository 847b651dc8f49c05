"""Measure-run log.

The log is append-only: a run adds a ``RUNNING`` row when it starts and a
``SUCCEEDED`` or ``FAILED`` row when it ends; the current state of each run is
its latest row (the ``latest`` operator keyed on ``id``, ordered by a lifecycle
step). Completed rows are derived from the run's evaluations, so their counts
are computed by Spark, not passed through the driver.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapwise.operators.versions import latest

# --- fixed values ------------------------------------------------------------
RUN_STATUSES = ("RUNNING", "SUCCEEDED", "FAILED")
ERROR_MAX_CHARS = 2000

RUN_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("run_date", T.DateType(), False),
    T.StructField("started_at", T.TimestampType(), False),
    T.StructField("completed_at", T.TimestampType(), True),
    T.StructField("status", T.StringType(), False),
    T.StructField("error", T.StringType(), True),
    T.StructField("gaps_open", T.IntegerType(), True),
    T.StructField("gaps_closed", T.IntegerType(), True),
])
LOG_SCHEMA = T.StructType(RUN_SCHEMA.fields + [T.StructField("step", T.IntegerType(), False)])
COLUMNS = [f.name for f in RUN_SCHEMA.fields]


def new_run_id() -> str:
    return str(uuid.uuid4())


def run_started(spark: SparkSession, run_id: str, run_date: dt.date,
                now: dt.datetime) -> DataFrame:
    return spark.createDataFrame(
        [(run_id, run_date, now, None, "RUNNING", None, None, None, 0)], LOG_SCHEMA)


def run_completed(summary: DataFrame, run_id: str, run_date: dt.date, started_at: dt.datetime,
                  now: dt.datetime) -> DataFrame:
    """SUCCEEDED row from a one-row ``run_summary`` DataFrame."""
    return summary.select(
        F.lit(run_id).alias("id"), F.lit(run_date).alias("run_date"),
        F.lit(started_at).cast("timestamp").alias("started_at"),
        F.lit(now).cast("timestamp").alias("completed_at"),
        F.lit("SUCCEEDED").alias("status"), F.lit(None).cast("string").alias("error"),
        F.col("gaps_open").cast("int"), F.col("gaps_closed").cast("int"),
        F.lit(1).alias("step"))


def run_failed(spark: SparkSession, run_id: str, run_date: dt.date, started_at: dt.datetime,
               now: dt.datetime, error: str | None) -> DataFrame:
    df = spark.createDataFrame(
        [(run_id, run_date, started_at, now, "FAILED", error, None, None, 1)], LOG_SCHEMA)
    return df.withColumn("error", F.substring("error", 1, ERROR_MAX_CHARS))


def current_runs(log: DataFrame) -> DataFrame:
    """One row per run id: its latest lifecycle row."""
    return latest(log, "id", [F.col("step").desc()]).select(*COLUMNS)
