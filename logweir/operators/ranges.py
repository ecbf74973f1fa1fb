"""Faults in a table of address ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# What can be wrong with a range.
OUTSIDE, REVERSED, REPEATED, OVERLAPPING = "outside", "reversed", "repeated", "overlapping"

# Addresses end here; a block of the sweep has 2^20 of them.
_LAST = 2**32 - 1
_BLOCK = 20


def range_conflicts(ranges: DataFrame) -> DataFrame:
    """(`ip_from`, `ip_to`, `conflict`, `rows`, `reaches`) of every fault.

    ``outside``: an end is null or no IPv4 address; ``reversed``: the end lies
    before the start. Both leave the range out of the rest. ``repeated``: several
    rows have this start. ``overlapping``: ranges that start earlier reach up to
    ``reaches``, at or beyond this start. For the last two `ip_to` is the farthest
    end of the ranges with this start. `rows` counts equal faults.

    One sweep over the starts in their order. Rows of a start come together
    first, combined before the shuffle, so a start that a third of all rows
    have is one row in the sweep. Starts are dealt by block of the address
    space, 2^20 addresses each; a block needs of all blocks before it only how
    far they reach, which is one number for each of at most 4,096 blocks.
    """
    start, end = F.col("ip_from"), F.col("ip_to")
    inside = start.between(0, _LAST) & end.between(0, _LAST)
    fault = F.when(~F.coalesce(inside, F.lit(False)), OUTSIDE).when(end < start, REVERSED)
    named = ranges.select(start, end, fault.alias("conflict"))
    nowhere = F.lit(None).cast("bigint").alias("reaches")
    bad = (
        named.where("conflict is not null")
        .groupBy("ip_from", "ip_to", "conflict")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("reaches", nowhere)
    )
    starts = (
        named.where("conflict is null")
        .groupBy("ip_from")
        .agg(F.max("ip_to").alias("ip_to"), F.count(F.lit(1)).alias("rows"))
        .withColumn("block", F.shiftright("ip_from", _BLOCK))
    )
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = starts.groupBy("block").agg(F.max("ip_to").alias("far"))
    # One row for each block: at most 2^32 / 2^20.
    carried = carried.select("block", F.max("far").over(before).alias("carried"))
    within = Window.partitionBy("block").orderBy("ip_from").rowsBetween(Window.unboundedPreceding, -1)
    swept = starts.join(F.broadcast(carried), "block").select(
        "ip_from", "ip_to", "rows", F.greatest("carried", F.max("ip_to").over(within)).alias("reaches")
    )
    repeated = swept.where("rows > 1").select("ip_from", "ip_to", F.lit(REPEATED).alias("conflict"), "rows", nowhere)
    overlapping = swept.where("reaches >= ip_from").select(
        "ip_from", "ip_to", F.lit(OVERLAPPING).alias("conflict"), "rows", "reaches"
    )
    return bad.unionByName(repeated).unionByName(overlapping)
