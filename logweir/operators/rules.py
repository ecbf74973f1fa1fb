"""Automated traffic: three rules on requests per address, and its removal.

R  more than ``r`` requests of one address in one time bucket (a minute)
P  more than ``p`` distinct entities of one address in one time bucket
V  more than ``v`` requests of one address in one day

All rules look at raw addresses within one day, need *more than* the
threshold, and mark the address for the whole day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.functions.times import bucket_start, parse_datetime
from logweir.operators.lookup import BROADCAST_BYTES, row_bytes, spread_nulls

DAY = "log_date"

# Default thresholds of the three rules (fixed values).
R, P, V = 25, 3, 500


def successful_requests(log: DataFrame) -> DataFrame:
    """Rows with code 200, idx 0, crawler 0. A null in any of them drops the row."""
    return log.where((F.col("code") == 200) & (F.col("idx") == 0) & (F.col("crawler") == 0))


def with_datetime(log: DataFrame) -> DataFrame:
    return log.withColumn("datetime", parse_datetime(F.col("date"), F.col("time")))


def rule_base(log: DataFrame, bucket: str = "minute") -> DataFrame:
    """The four columns the rules read. Rows without an address are left out:
    a null never equals anything, so they can be no one's traffic."""
    moment = parse_datetime(F.col("date"), F.col("time"))
    return log.where(F.col("ip").isNotNull()).select(
        DAY, bucket_start(moment, bucket).alias("bucket"), "ip", "cik"
    )


def _marked(counted: DataFrame, measure: str, threshold: int) -> DataFrame:
    return counted.where(F.col(measure) > threshold).select(DAY, "ip").distinct()


def bots_by_rate(base: DataFrame, r: int = R) -> DataFrame:
    """R rule alone: (day, address) pairs."""
    counted = base.groupBy(DAY, "bucket", "ip").agg(F.count(F.lit(1)).alias("requests"))
    return _marked(counted, "requests", r)


def bots_by_entities(base: DataFrame, p: int = P) -> DataFrame:
    """P rule alone. A null entity counts as one value of its own."""
    entities = F.count_distinct("cik") + F.max(F.col("cik").isNull().cast("int"))
    counted = base.groupBy(DAY, "bucket", "ip").agg(entities.alias("entities"))
    return _marked(counted, "entities", p)


def bots_by_volume(base: DataFrame, v: int = V) -> DataFrame:
    """V rule alone."""
    counted = base.groupBy(DAY, "ip").agg(F.count(F.lit(1)).alias("requests"))
    return _marked(counted, "requests", v)


def union_of_bots(*sets: DataFrame) -> DataFrame:
    """Set union of several bot sets."""
    first, *rest = sets
    for other in rest:
        first = first.unionByName(other)
    return first.distinct()


def traffic_profile(base: DataFrame) -> DataFrame:
    """Per day and address: busiest bucket, most entities in one, all requests.

    One pass for the three rules. Every level groups by one key less than the
    level below and is combined before its shuffle, so the rows of the busiest
    address are counted in many tasks: by entity, then by bucket, and only its
    bucket totals meet. Grouping by entity first also makes the distinct count
    a row count, in which null is a value like any other.
    """
    per_entity = base.groupBy(DAY, "bucket", "ip", "cik").agg(F.count(F.lit(1)).alias("n"))
    per_bucket = per_entity.groupBy(DAY, "bucket", "ip").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("entities")
    )
    return per_bucket.groupBy(DAY, "ip").agg(
        F.max("n").alias("max_requests"),
        F.max("entities").alias("max_entities"),
        F.sum("n").alias("requests"),
    )


def find_bots(base: DataFrame, r: int = R, p: int = P, v: int = V) -> DataFrame:
    """(day, address, requests) of every address that breaks any rule."""
    broken = (
        (F.col("max_requests") > r) | (F.col("max_entities") > p) | (F.col("requests") > v)
    )
    return traffic_profile(base).where(broken).select(DAY, "ip", "requests")


def bytes_by_level(bots: DataFrame) -> dict[int, int]:
    """Size of the bots by power of two of their requests. Starts a job."""
    level = F.length(F.bin(F.col("requests"))) - 1
    sizes = bots.groupBy(level.alias("level")).agg(F.sum(row_bytes(bots).cast("bigint")).alias("bytes"))
    return {row["level"]: row["bytes"] for row in sizes.collect()}


def _busiest_that_fit(levels: dict[int, int], limit: int) -> tuple[int | None, bool]:
    """Least power of two such that the bots with at least so many requests fit.

    Returns (threshold, do all fit).
    """
    total, threshold = 0, None
    for level in sorted(levels, reverse=True):
        total += levels[level]
        if total > limit:
            return threshold, False
        threshold = 2**level
    return threshold, True


def drop_bots(
    log: DataFrame,
    bots: DataFrame,
    limit: int = BROADCAST_BYTES,
    size: int | None = None,
) -> DataFrame:
    """Drop all rows of the marked (day, address) pairs; null addresses stay.

    ``bots`` should be a written table: it is measured, unless its ``size`` is
    known and within ``limit`` bytes. While it fits it is broadcast and the log
    is not moved. Otherwise the busiest bots that fit are broadcast: they hold
    most of the rows and every hot key, which are gone before the rest of the
    log is shuffled to meet the many small bots. Then the rows of a day are
    brought together again.
    """
    keys, columns = [DAY, "ip"], log.columns
    threshold, all_fit = None, size is not None and size <= limit
    if not all_fit:
        threshold, all_fit = _busiest_that_fit(bytes_by_level(bots), limit)
    if all_fit:
        return log.join(F.broadcast(bots.select(keys)), keys, "left_anti").select(columns)
    if threshold is not None:
        busy = bots.where(F.col("requests") >= threshold).select(keys)
        bots = bots.where(F.col("requests") < threshold)
        log = log.join(F.broadcast(busy), keys, "left_anti")
    quiet = bots.select(F.col(DAY).alias("_day"), F.col("ip").alias("_bot"))
    kept = log.withColumn("_ip", spread_nulls(log, "ip")).join(
        quiet,
        (F.col(DAY) == F.col("_day")) & (F.col("_ip") == F.col("_bot")) & F.col("ip").isNotNull(),
        "left_anti",
    )
    return kept.select(columns).hint("rebalance", DAY)
