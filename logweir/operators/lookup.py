"""Left joins of a long table to a lookup table whose size is not known ahead."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes a lookup table may take up in every executor before it is shuffled.
BROADCAST_BYTES = 128 * 1024 * 1024

# Values that rows without a key are spread over in a shuffle.
_NULL_PARTS = 4096


def spread_nulls(df: DataFrame, key: str) -> Column:
    """The key, with one of many values in place of null.

    Rows without a key can match nothing, but a shuffle would send them all to
    one task. Join on this and require the key itself to be not null. (A second
    key column, constant on the other side, would not do: Spark folds it.)
    """
    part = F.pmod(F.xxhash64(*df.columns), F.lit(_NULL_PARTS))
    return F.coalesce(F.col(key), part.cast(df.schema[key].dataType))


def row_bytes(df: DataFrame) -> Column:
    """Rough size of a row in memory, from above for flat tables."""
    size = F.lit(16)
    for field in df.schema:
        size = size + F.lit(16)
        if isinstance(field.dataType, T.StringType):
            size = size + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0))
    return size


def fits_in_memory(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Measure the table. Starts a job, so ``df`` should be a written table."""
    return (df.agg(F.sum(row_bytes(df).cast("bigint")).alias("b")).first()["b"] or 0) <= limit


def lookup_join(
    facts: DataFrame,
    table: DataFrame,
    fact_key: str,
    table_key: str,
    limit: int = BROADCAST_BYTES,
    regroup: str | None = None,
    size: int | None = None,
) -> DataFrame:
    """Left join on one key; the key of ``table`` does not appear in the result.

    ``table`` is measured first unless its ``size`` is known. Within ``limit`` it is broadcast and ``facts``
    is not moved. Beyond, both sides are shuffled: adaptive execution splits
    partitions of hot keys, and rows with a null key, which can match nothing
    but would all meet in one partition, are spread out. ``regroup`` names the
    column a later write partitions by: after a shuffle on another key every
    task holds rows of every day, so they are brought together again.
    """
    table = table.withColumnRenamed(table_key, "_table_key")
    if size <= limit if size is not None else fits_in_memory(table, limit):
        joined = facts.join(F.broadcast(table), F.col(fact_key) == F.col("_table_key"), "left")
        return joined.drop("_table_key")
    joined = facts.withColumn("_key", spread_nulls(facts, fact_key)).join(
        table, (F.col("_key") == F.col("_table_key")) & F.col(fact_key).isNotNull(), "left"
    )
    joined = joined.drop("_table_key", "_key")
    return joined.hint("rebalance", regroup) if regroup else joined
