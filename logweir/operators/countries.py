"""Country names: a mapping that grows by the names it does not hold yet."""

from __future__ import annotations

import csv
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.operators.columns import conform, require_columns
from logweir.operators.lookup import BROADCAST_BYTES, lookup_join
from logweir.operators.rules import DAY
from logweir.schemas import COUNTRY_MAPPING

# Fixed value: standard name of a country no rule knows.
NOT_FOUND = "not found"


_RULES = "priority int, pattern string, standard_name string"


class CountryRule(NamedTuple):
    """Names that match the pattern, in any case, get the standard name.

    The rule with the lowest priority wins.
    """

    priority: int
    pattern: str
    standard_name: str


def read_rules(path: str, spark: SparkSession | None = None) -> list[CountryRule]:
    """Rules from a CSV file with the header `priority,pattern,standard_name`.

    With a session the file may be anywhere Spark reads from.
    """
    if spark is not None:
        options = {"header": True, "quote": '"', "escape": '"', "multiLine": True}
        rows = spark.read.options(**options).schema(_RULES).csv(path).collect()
        return [CountryRule(*row) for row in rows]
    with open(path, newline="", encoding="utf-8") as file:
        return [
            CountryRule(int(row["priority"]), row["pattern"], row["standard_name"])
            for row in csv.DictReader(file)
        ]


def unmapped_names(
    df: DataFrame, mapping: DataFrame, country_col: str = "country_name"
) -> DataFrame:
    """Distinct names of the table that the mapping does not hold, nulls left out."""
    names = (
        df.select(F.col(country_col).alias("raw_country_name"))
        .where(F.col("raw_country_name").isNotNull())
        .distinct()
    )
    return names.join(mapping, "raw_country_name", "left_anti")


def standard_name(
    name: Column, rules: Iterable[CountryRule], unmatched: str = NOT_FOUND
) -> Column:
    """Standard name of a country by the first rule that fits.

    The rules are part of the program, as constant patterns that are compiled
    once, so no join is needed. ``unmatched`` is `not found` or `keep`.
    """
    if unmatched not in (NOT_FOUND, "keep"):
        raise ValueError(f"unmatched must be {NOT_FOUND!r} or 'keep', not {unmatched!r}")
    otherwise = F.when(name.isNotNull(), F.lit(NOT_FOUND)) if unmatched == NOT_FOUND else name
    fitting = [
        F.when(name.rlike(f"(?iu){pattern}"), F.lit(standard))
        for _, pattern, standard in sorted(rules)
    ]
    return F.coalesce(*fitting, otherwise)


def new_mappings(
    names: DataFrame, rules: Iterable[CountryRule], unmatched: str = NOT_FOUND
) -> DataFrame:
    raw = F.col("raw_country_name")
    cleaned = standard_name(raw, rules, unmatched)
    return names.select(raw, cleaned.alias("cleaned_country_name"))


def extended_mapping(mapping: DataFrame, new: DataFrame) -> DataFrame:
    """The new names first, then all that were there."""
    return conform(new, COUNTRY_MAPPING).unionByName(conform(mapping, COUNTRY_MAPPING))


def apply_mapping(
    df: DataFrame,
    mapping: DataFrame,
    country_col: str = "country_name",
    limit: int = BROADCAST_BYTES,
    size: int | None = None,
) -> DataFrame:
    """Replace country names by their standard names where there is one.

    Measures the mapping, which should be a written table, unless its ``size``
    is known.
    """
    mapping = require_columns(mapping, COUNTRY_MAPPING.names, "country mapping")
    names = mapping.select("raw_country_name", "cleaned_country_name")
    regroup = DAY if DAY in df.columns else None
    joined = lookup_join(df, names, country_col, "raw_country_name", limit, regroup, size)
    preferred = F.coalesce(F.col("cleaned_country_name"), F.col(country_col))
    return joined.withColumn(country_col, preferred).drop("cleaned_country_name")
