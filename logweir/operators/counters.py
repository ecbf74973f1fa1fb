"""Row counters that ride along with a job instead of needing one of their own."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def counted(df: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    """The same rows, and a function that tells how many there were.

    Ask after the action. Where the optimiser finds out that there are no rows
    the counter never runs, which is read as 0. Stages that ran again after
    the loss of an executor may count twice: a figure for logs, not for logic.
    """
    observation = Observation()
    watched = df.observe(observation, F.count(F.lit(1)).alias("rows"))

    def value() -> int:
        try:
            return observation.get["rows"]
        except Py4JJavaError:
            return 0

    return watched, value
