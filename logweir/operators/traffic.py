"""Transferred volume from the network log of a browser."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def transferred_mb(log: DataFrame, line: str = "line") -> DataFrame:
    """One row: megabytes of all finished loads in a table of JSON log lines.

    A line is a JSON object whose `message` is again JSON, as text. An empty
    log gives 0. Bytes are whole numbers, which doubles add up exactly, and are
    divided once at the end, so the order of rows does not show.
    """
    inner = F.get_json_object(F.col(line), "$.message")
    finished = F.get_json_object(inner, "$.message.method") == "Network.loadingFinished"
    size = F.get_json_object(inner, "$.message.params.encodedDataLength").cast("double")
    total = F.coalesce(F.sum(size), F.lit(0.0))
    return log.where(finished).agg((total / 1024 / 1024).alias("total_mb"))
