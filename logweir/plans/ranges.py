"""IP range file -> location table."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.operators.ranges import OUTSIDE, OVERLAPPING, REPEATED, REVERSED, range_conflicts
from logweir.sources.logs import read_ip_ranges
from logweir.sources.tables import write_next
from logweir.sources.workspace import written

_logger = logging.getLogger(__name__)

_SAYS = {
    REPEATED: "range starts occur more than once",
    REVERSED: "ranges end before they start",
    OUTSIDE: "ranges do not lie within the IPv4 addresses",
    OVERLAPPING: "ranges overlap",
}


def load_ip_ranges(
    spark: SparkSession, csv_path: str, target: str, allowed: Iterable[str] = (OVERLAPPING,)
) -> DataFrame:
    """Convert the CSV file to Parquet once; later runs start from there.

    The file is checked first (:func:`range_conflicts`). A fault that is not
    ``allowed`` is an error, and the table that is there already stays as it
    is; otherwise the file becomes the next version of it. By default ranges
    may overlap, as the narrowest holds.
    """
    ranges = written(read_ip_ranges(spark, csv_path), "ip-ranges")
    conflicts = written(range_conflicts(ranges), "conflicts")
    found = conflicts.groupBy("conflict").agg(F.count(F.lit(1)).alias("n"), F.min("ip_from").alias("first")).collect()
    for row in sorted(found):
        message = f"{_SAYS[row.conflict]}: {row.n} times, the first at {row.first}"
        if row.conflict not in set(allowed):
            raise ValueError(message)
        _logger.warning("%s: %s", csv_path, message)
    return write_next(ranges, target)
