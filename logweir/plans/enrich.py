"""Clean log -> log with locations, and a location table that learns."""

from __future__ import annotations

import logging
import math
import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.operators.addresses import (
    PLACE,
    distinct_addresses,
    locate,
    location_table,
    needs_lookup,
    updated_locations,
)
from logweir.operators.lookup import BROADCAST_BYTES, lookup_join
from logweir.operators.resolving import Resolver, point_locations
from logweir.operators.rules import DAY
from logweir.sources.journal import clear, read_journal
from logweir.sources.workspace import measured, written

Save = Callable[[DataFrame], DataFrame]

# Lookups whose answers are stored together.
ROUND_SIZE = 1_000_000

_logger = logging.getLogger(__name__)


def attach_locations(
    log: DataFrame,
    addresses: DataFrame,
    locations: DataFrame,
    match: str = "exact",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left join of the log to the locations of its addresses.

    Only locations of addresses that occur take part, so that the side to be
    broadcast or shuffled is as small as it can be.
    """
    occurring = addresses.where(F.col("cleaned_ip_int").isNotNull())
    located = locate(occurring, locations, match, "inner")
    found = measured(located.select("cleaned_ip_int", *PLACE), "places")
    places = found.table.withColumnRenamed("cleaned_ip_int", "_address")
    regroup = DAY if DAY in log.columns else None
    return lookup_join(log, places, "cleaned_ip_int", "_address", limit, regroup, found.bytes)


def learn_locations(
    addresses: DataFrame,
    locations: DataFrame,
    resolver: Resolver,
    match: str = "exact",
    at: Column | None = None,
    save: Save | None = None,
    round_size: int = ROUND_SIZE,
    journal: str | None = None,
) -> DataFrame:
    """The location table after looking up the addresses it does not know.

    Each address is asked for once. A million lookups may take hours, so they
    go in rounds, by hash, and ``save`` stores the answers of each, and only
    them. Within a round, answers go to the ``journal`` as they come, if the
    resolver can keep one (:func:`calling`): a task that runs again, or a
    run after one that broke off, goes on from there. Without missing addresses
    the table stays as it is.
    """
    spark = addresses.sparkSession
    looked = measured(needs_lookup(locate(addresses, locations, match)), "missing")
    missing, count = looked.table, looked.rows
    keep = save or (lambda answers: written(answers, "answers"))
    start = time.monotonic()
    found = []
    if journal and (known := read_journal(spark, journal)) is not None:
        # A run before this one got these and ended before they were stored.
        known = written(known.join(missing, "cleaned_ip_int", "left_semi"), "journal")
        found.append(keep(point_locations(known, at)))
        looked = measured(missing.join(known, "cleaned_ip_int", "left_anti"), "missing")
        missing, count = looked.table, looked.rows
        clear(spark, journal)
    rounds = math.ceil(count / round_size)
    if journal and hasattr(resolver, "with_journal"):
        resolver = resolver.with_journal(journal)
    for number in range(rounds):
        own = F.pmod(F.xxhash64("cleaned_ip_int"), F.lit(rounds)) == number
        found.append(keep(point_locations(resolver(missing.where(own)), at)))
        if journal:
            clear(spark, journal)
    _logger.info("looked up %d addresses in %.1f s", count, time.monotonic() - start)
    return updated_locations(locations, reduce(DataFrame.unionByName, found)) if found else locations


def enrich_ip(
    log: DataFrame,
    locations: DataFrame,
    resolver: Resolver | None = None,
    match: str = "exact",
    at: Column | None = None,
    save: Save | None = None,
    limit: int = BROADCAST_BYTES,
    journal: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Returns (log with locations, location table to use next time).

    ``match`` is `exact` (address = start of the range) or `range`. With a
    ``resolver``, addresses without a known country are looked up and the
    answers, hits and misses, go into the table; ``save`` writes the answers
    and reads them back, by default in the shared work folder. ``journal`` is
    as in :func:`learn_locations`. The log is read twice, so it should be a
    written table.
    """
    locations = location_table(locations)
    addresses = written(distinct_addresses(log), "addresses")
    if resolver is not None:
        locations = learn_locations(
            addresses, locations, resolver, match, at, save, journal=journal
        )
    return attach_locations(log, addresses, locations, match, limit), locations
