"""A ledger of runs: what a job wrote counts once its attempt is committed, and only the run's last one.

Every attempt of a run writes to partitions of its own (``attempt=...``), so an attempt that dies leaves
rows that no reader sees, and a run that is repeated replaces itself. A commit is one small JSON file.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ATTEMPT = "attempt"
LEDGER = T.StructType([T.StructField("run_id", T.StringType()), T.StructField(ATTEMPT, T.StringType()),
                       T.StructField("committed_at", T.LongType())])


def run_of(as_of: _dt.datetime) -> str:
    """The id of a scheduled run: its time, the same however often it is tried."""
    return as_of.strftime("%Y%m%dT%H%M%S%f")


def new_attempt(run_id: str) -> str:
    return f"{run_id}-{uuid.uuid4().hex[:12]}"


def commit(spark: SparkSession, ledger: str, run_id: str, attempt: str) -> None:
    """From now on readers see this attempt of the run, and no earlier one."""
    row = spark.createDataFrame([(run_id, attempt, time.time_ns())], LEDGER)
    row.coalesce(1).write.mode("append").json(ledger)


def commits(spark: SparkSession, ledger: str) -> DataFrame:
    return spark.read.schema(LEDGER).json(ledger)


def committed(spark: SparkSession, ledger: str) -> DataFrame:
    """``attempt``: the last committed one of each run."""
    return commits(spark, ledger).groupBy("run_id").agg(F.max_by(ATTEMPT, "committed_at").alias(ATTEMPT)).select(ATTEMPT)


def only_committed(df: DataFrame, ledger: str) -> DataFrame:
    """The rows of committed attempts. The ledger has a row for each commit, so adaptive execution broadcasts it
    while it is small, and the partitions of other attempts are pruned at run time."""
    return df.join(committed(df.sparkSession, ledger), ATTEMPT, "left_semi")
