"""Addresses of a log and their places in the location table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.functions.addresses import clean_ip, clean_ip_to_long
from logweir.operators.columns import add_missing_column, conform
from logweir.schemas import ATTEMPTED, LOCATIONS

# Columns a location brings along, without the key.
PLACE = [name for name in LOCATIONS.names if name != "ip_from"]

# Block sizes of the range lookup, as powers of two from large to small. No
# range, however wide, is cut into more than 886 blocks.
_LEVELS = (24, 16, 12, 8, 4, 0)


def with_clean_ip(log: DataFrame, strict: bool = False) -> DataFrame:
    """Add `cleaned_ip` and `cleaned_ip_int`."""
    ip = F.col("ip")
    return log.withColumns(
        {"cleaned_ip": clean_ip(ip), "cleaned_ip_int": clean_ip_to_long(ip, strict)}
    )


def distinct_addresses(log: DataFrame) -> DataFrame:
    """Distinct (`cleaned_ip`, `cleaned_ip_int`) pairs."""
    return log.select("cleaned_ip", "cleaned_ip_int").distinct()


def location_table(table: DataFrame) -> DataFrame:
    """Any table of locations in the standard columns and types.

    A table without the attempted mark gets one, all false. Postcodes become
    text here, on either side of a later union.
    """
    return conform(add_missing_column(table, ATTEMPTED, False), LOCATIONS)


def repeated_starts(locations: DataFrame) -> DataFrame:
    """Range starts that occur more than once; each would multiply log rows."""
    counted = locations.groupBy("ip_from").agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.col("n") > 1) & F.col("ip_from").isNotNull())


def match_exact(addresses: DataFrame, locations: DataFrame, how: str = "left") -> DataFrame:
    """Location whose range *starts* at the address; the range end is not looked at.

    ``addresses`` must be distinct. Of several ranges with one start, such as a
    network and an address in it that was looked up, the narrowest holds.
    """
    keyed = locations.withColumnRenamed("ip_from", "_start")
    joined = addresses.join(keyed, addresses["cleaned_ip_int"] == keyed["_start"], how)
    width = (F.col("ip_to") - F.col("_start")).alias("width")
    return _narrowest(joined, addresses.columns, F.struct(width, *PLACE))


def _narrowest(found: DataFrame, columns: list[str], place: Column) -> DataFrame:
    """One row for each address: the least place, which begins with the width of its range."""
    best = found.groupBy(*columns).agg(F.min(place).alias("place"))
    return best.select(*columns, *(F.col(f"place.{name}").alias(name) for name in PLACE))


def _key(block: Column, level: int) -> Column:
    """One number for a block of a size; block numbers need at most 32 bits."""
    return block + F.lit(level << 40).cast("bigint")


def _block_runs(start: Column, end: Column) -> Column:
    """Cut a range into aligned blocks of the sizes in ``_LEVELS``, each as
    large as it can be; together they cover the range exactly once.

    Returns an array of runs (first key, last key), some of them empty: the
    blocks of the largest size, then for each smaller size those before and
    those after.
    """
    runs, outer = [], None

    def add(first: Column, last: Column, level: int) -> None:
        runs.append(
            F.struct(_key(first, level).alias("first"), _key(last, level).alias("last"))
        )

    for level in _LEVELS:
        # Blocks of this size that lie wholly within the range.
        first = F.shiftright(start + ((1 << level) - 1), level)
        last = F.shiftright(end + 1, level) - 1
        if outer is None:
            add(first, last, level)
        else:
            wide_first, wide_last, wide_level = outer
            ratio = 1 << (wide_level - level)
            none_wide = wide_first > wide_last
            add(first, F.when(none_wide, last).otherwise(wide_first * ratio - 1), level)
            add(F.when(none_wide, last + 1).otherwise((wide_last + 1) * ratio), last, level)
        outer = (first, last, level)
    return F.array(*runs)


def match_range(addresses: DataFrame, locations: DataFrame, how: str = "left") -> DataFrame:
    """Location whose range holds the address, the narrowest where they overlap.

    ``addresses`` must be distinct. Ranges are cut into aligned blocks, and an
    address lies in exactly one block of each size, so the lookup is an equi
    join on the block: no pair is looked at that does not match. Within a
    block all ranges cover the same addresses, so only the narrowest of each
    block is kept before the join, and at most one per size meets an address.
    """
    start, end = F.col("ip_from"), F.col("ip_to")
    place = F.struct((end - start).alias("width"), "ip_from", *PLACE).alias("place")
    blocks = (
        locations.where(start <= end)
        .select(place, F.inline(_block_runs(start, end)))
        .where(F.col("first") <= F.col("last"))
        .select("place", F.explode(F.sequence("first", "last")).alias("block"))
        .groupBy("block")
        .agg(F.min("place").alias("place"))
    )
    # A null address has null blocks, which match nothing.
    own = F.array(
        *(_key(F.shiftright(F.col("cleaned_ip_int"), level), level) for level in _LEVELS)
    )
    found = addresses.select("*", F.explode(own).alias("block")).join(blocks, "block", how)
    return _narrowest(found, addresses.columns, F.col("place"))


def locate(
    addresses: DataFrame, locations: DataFrame, match: str = "exact", how: str = "left"
) -> DataFrame:
    """Distinct addresses with the columns of their location."""
    if match == "exact":
        return match_exact(addresses, locations, how)
    if match == "range":
        return match_range(addresses, locations, how)
    raise ValueError(f"match must be exact or range, not {match!r}")


def needs_lookup(located: DataFrame) -> DataFrame:
    """Addresses without a country that were never asked for.

    Text that only looks like an address (`999.1.1.0`) has no number under
    which an answer could be kept, so it is not asked for.
    """
    tried = F.coalesce(F.col(ATTEMPTED), F.lit(False))
    open_ = ~tried & F.col("country_code").isNull()
    return (
        located.where(open_ & F.col("cleaned_ip").isNotNull() & F.col("cleaned_ip_int").isNotNull())
        .select("cleaned_ip", "cleaned_ip_int")
        .distinct()
    )


def worth_keeping(locations: DataFrame) -> DataFrame:
    """Locations with a country, or known to have none."""
    return locations.where(F.col("country_code").isNotNull() | F.col(ATTEMPTED))


def updated_locations(locations: DataFrame, found: DataFrame) -> DataFrame:
    """The location table under the answers of lookups.

    An answer takes the place of a row for the same range. Any other row
    without a country that was never tried makes room as well: a lookup by
    address has come instead.
    """
    kept = worth_keeping(location_table(locations))
    found = conform(found, LOCATIONS)
    return kept.join(found.select("ip_from", "ip_to"), ["ip_from", "ip_to"], "left_anti").unionByName(found)
