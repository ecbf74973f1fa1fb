"""Stage tables with one partition per day and a commit log, and versioned lookup tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.sources.commits import Commit, commit, committed, wanted_files
from logweir.sources.folders import exists, names_in, remove, sizes_in

DAY = "log_date"
COMPRESSION = "gzip"
# Stage tables are written and read again by the job itself: about the size of
# gzip in half the time.
STAGE_COMPRESSION = "zstd"

DAY_SCHEMA = T.StructType([T.StructField(DAY, T.DateType())])


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet table; with ``schema``, an empty one where there are no files."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        absent = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
        if schema is None or error.getCondition() not in absent:
            raise
        return spark.createDataFrame([], schema)


def write_table(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).option("compression", COMPRESSION).parquet(path)


def present_days(spark: SparkSession, path: str) -> DataFrame:
    """Days that a stage table has, by its commit log; a day may be empty."""
    return spark.createDataFrame([(day,) for day in sorted(committed(spark, path))], DAY_SCHEMA)


def whole_days(spark: SparkSession, path: str, days: Iterable[dt.date]) -> DataFrame:
    """Of these days those that are committed and whose files are all there, with their sizes."""
    done = committed(spark, path)
    whole = [
        (day,)
        for day in days
        if day in done and done[day].files.items() <= sizes_in(spark, _folder(path, day)).items()
    ]
    return spark.createDataFrame(whole, DAY_SCHEMA)


def _folder(path: str, day: dt.date) -> str:
    return f"{path}/{DAY}={day.isoformat()}"


def read_days(
    spark: SparkSession, path: str, days: Iterable[dt.date], schema: T.StructType | None = None
) -> DataFrame:
    """Rows of some days; only files that their commits name are read.

    Days may have columns of their own: the table has those of all its wanted
    days, null where a day lacks them. A column with two types is an error.
    """
    days = list(days)
    done = committed(spark, path)
    files = wanted_files(done, days, f"{path}/{DAY}=%s")
    if not files:
        # Days without rows have no files; the other days know the columns.
        others = [day for day in sorted(done) if done[day].files][-1:]
        if not others and schema is not None:
            return spark.createDataFrame([], schema)
        files = wanted_files(done, others, f"{path}/{DAY}=%s")
        if not files:
            raise FileNotFoundError(f"no day in {path} has any rows")
    merged = spark.read.option("basePath", path).option("mergeSchema", "true")
    return merged.parquet(*files).where(F.col(DAY).isin(days))


def write_days(
    df: DataFrame, path: str, days: Iterable[dt.date], compression: str = COMPRESSION
) -> dict[str, int]:
    """Replace the rows of ``days``; other days stay as they are.

    New files are written beside the old ones, then a commit names them, then
    all other files of the days are removed: the old ones, and what a run left
    that broke off before its commit. A day without rows is committed without
    files.

    Returns the number of days and rows, for the log of the run.
    """
    spark = df.sparkSession
    days = list(days)
    before = {day: set(names_in(spark, _folder(path, day))) for day in days}
    (
        df.where(F.col(DAY).isin(days))
        .write.mode("append")
        .option("compression", compression)
        .partitionBy(DAY)
        .parquet(path)
    )
    new: dict[dt.date, dict[str, int]] = {}
    for day in days:
        sizes = sizes_in(spark, _folder(path, day))
        new[day] = {
            name: size
            for name, size in sizes.items()
            if name not in before[day] and not name.startswith(("_", "."))
        }
    counts = _rows_by_day(spark, path, [f"{_folder(path, day)}/{name}" for day in days for name in new[day]])
    commit(spark, path, {day: Commit(counts.get(day, 0), new[day]) for day in days})
    for day in days:
        for name in before[day]:
            remove(spark, f"{_folder(path, day)}/{name}")
    return {"days": len(days), "rows": sum(counts.values())}


def _rows_by_day(spark: SparkSession, path: str, files: list[str]) -> dict[dt.date, int]:
    """Rows of files by their day, from the ends of the files."""
    if not files:
        return {}
    rows = spark.read.option("basePath", path).parquet(*files).groupBy(DAY).count().collect()
    return {row[DAY]: row["count"] for row in rows}


def version_numbers(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the versions that were written to the end."""
    versions = [name for name in names_in(spark, folder) if name.startswith("v=")]
    numbers = [int(name[2:]) for name in versions if name[2:].isdigit()]
    return sorted(n for n in numbers if exists(spark, f"{folder}/v={n}/_SUCCESS"))


def read_latest(
    spark: SparkSession, folder: str, schema: T.StructType | None = None
) -> DataFrame:
    """Latest complete version of a lookup table, empty if there is none yet."""
    numbers = version_numbers(spark, folder)
    if not numbers:
        if schema is None:
            raise FileNotFoundError(f"no version of a table in {folder}")
        return spark.createDataFrame([], schema)
    return read_table(spark, f"{folder}/v={numbers[-1]}", schema)


def write_next(df: DataFrame, folder: str) -> DataFrame:
    """Write the next version and read it back.

    The version that ``df`` may itself be read from is not touched, and until
    the new one is complete it stays the latest.
    """
    spark = df.sparkSession
    numbers = version_numbers(spark, folder)
    target = f"{folder}/v={(numbers[-1] if numbers else 0) + 1}"
    write_table(df, target, mode="overwrite")
    return spark.read.schema(df.schema).parquet(target)
