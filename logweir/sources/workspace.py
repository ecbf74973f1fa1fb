"""Intermediate tables.

A small table that decides how a large one is processed (the bots of the
log, its distinct addresses) is written once and read back. That cuts the
lineage, survives the loss of executors, runs the work once however often the
result is used, and lets Spark see the true size before it plans the join.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from logweir.operators.lookup import row_bytes


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in `spark.checkpoint.dir`.

    A session without the setting, as in tests, gets a folder in its warehouse,
    which all executors share as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        context.setCheckpointDir(f"{warehouse.rstrip('/')}/_work")
        folder = context.getCheckpointDir()
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """Path of a new folder in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write the table to the shared folder and read it back. Starts a job."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Measured:
    """A written table with its number of rows and its rough size in memory (:func:`row_bytes`)."""

    table: DataFrame
    rows: int
    bytes: int


def measured(df: DataFrame, label: str) -> Measured:
    """Write the table as :func:`written` does and measure it on the way.

    The figures come with the write, so no other job reads the table for them.
    Tasks that run again after the loss of an executor may count rows twice: the
    figures are upper bounds, which is what decisions about broadcasts need.
    """
    size = F.sum(row_bytes(df).cast("bigint")).alias("bytes")
    observation = Observation()
    table = written(df.observe(observation, F.count(F.lit(1)).alias("rows"), size), label)
    try:
        got = observation.get
    except Py4JJavaError:
        # The optimiser found out that there are no rows, and nothing ran.
        got = {}
    return Measured(table, got.get("rows") or 0, got.get("bytes") or 0)
