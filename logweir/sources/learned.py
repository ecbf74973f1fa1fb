"""Locations that lookups have found: a log of answers on top of a base table.

A round of lookups adds its answers as a folder of their own and touches nothing
else; the base is not written again. A folder counts once Spark has finished it.
Of several answers for one range the newest holds. When many rounds have come
together, the whole table is written as the next base, with no answers yet.

```
locations/v=1/                  base after the first compaction
locations/answers/v=1/round=1/  answers since then
```
Answers before the first compaction are on top of the plain ranges, as version 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.operators.addresses import updated_locations
from logweir.schemas import LOCATIONS
from logweir.sources.folders import exists, names_in
from logweir.sources.tables import read_latest, version_numbers, write_next, write_table

# Rounds on top of a base before it is written anew.
ROUNDS = 64

_ROUND = T.StructType([*LOCATIONS.fields, T.StructField("round", T.IntegerType())])


def _version(spark: SparkSession, folder: str) -> int:
    numbers = version_numbers(spark, folder)
    return numbers[-1] if numbers else 0


def _rounds(spark: SparkSession, folder: str) -> tuple[str, list[int]]:
    """Folder of the answers on top of the latest base, and the finished rounds in it."""
    top = f"{folder}/answers/v={_version(spark, folder)}"
    names = [name.removeprefix("round=") for name in names_in(spark, top) if name.startswith("round=")]
    numbers = sorted(int(name) for name in names if name.isdigit())
    return top, [n for n in numbers if exists(spark, f"{top}/round={n}/_SUCCESS")]


def read_answers(spark: SparkSession, folder: str) -> DataFrame | None:
    """The newest answer for each range since the last base; None if there are none."""
    top, rounds = _rounds(spark, folder)
    if not rounds:
        return None
    paths = [f"{top}/round={n}" for n in rounds]
    rows = spark.read.schema(_ROUND).option("basePath", top).parquet(*paths)
    if len(rounds) == 1:
        return rows.drop("round")
    rest = [name for name in LOCATIONS.names if name not in ("ip_from", "ip_to")]
    newest = rows.groupBy("ip_from", "ip_to").agg(F.max(F.struct("round", *rest)).alias("r"))
    return newest.select("ip_from", "ip_to", *(F.col(f"r.{name}").alias(name) for name in rest))


def read_learned(spark: SparkSession, folder: str, ranges: DataFrame) -> DataFrame:
    """The location table: the base, or ``ranges`` if there is none yet, under its answers."""
    base = read_latest(spark, folder, LOCATIONS) if _version(spark, folder) else ranges
    answers = read_answers(spark, folder)
    return base if answers is None else updated_locations(base, answers)


def append_answers(answers: DataFrame, folder: str) -> DataFrame:
    """Add the answers of one round and read them back."""
    spark = answers.sparkSession
    top, rounds = _rounds(spark, folder)
    target = f"{top}/round={rounds[-1] + 1 if rounds else 1}"
    # What a round left that broke off is overwritten.
    write_table(answers, target, mode="overwrite")
    return spark.read.schema(answers.schema).parquet(target)


def compact(spark: SparkSession, folder: str, ranges: DataFrame, rounds: int = ROUNDS) -> bool:
    """Write the table as the next base once there are so many rounds on top of the last one."""
    if len(_rounds(spark, folder)[1]) < rounds:
        return False
    write_next(read_learned(spark, folder, ranges), folder)
    return True
