"""Country names of the customers' nations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.operators.countries import extended_mapping, new_mappings, unmapped_names
from logweir.plans import standardise_country
from logweir.suite.views import (
    COUNTRY_MAPPING,
    COUNTRY_RULES,
    country_mapping,
    standard_sql,
    table,
    with_sql,
)


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    customer, nation = table(spark, folder, "customer"), table(spark, folder, "nation")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.col("n_name").alias("country_name")
    )


def country_unmapped(spark: SparkSession, folder: str) -> DataFrame:
    return unmapped_names(_customers(spark, folder), country_mapping(spark, folder))


def country_mapping_grown(spark: SparkSession, folder: str) -> DataFrame:
    mapping = country_mapping(spark, folder)
    new = unmapped_names(_customers(spark, folder), mapping)
    return extended_mapping(mapping, new_mappings(new, COUNTRY_RULES))


def country_standard(spark: SparkSession, folder: str) -> DataFrame:
    customers, mapping = _customers(spark, folder), country_mapping(spark, folder)
    standard, _ = standardise_country(customers, mapping, COUNTRY_RULES)
    return standard


def country_standard_keep(spark: SparkSession, folder: str) -> DataFrame:
    customers, mapping = _customers(spark, folder), country_mapping(spark, folder)
    standard, _ = standardise_country(customers, mapping, COUNTRY_RULES, unmatched="keep")
    return standard


QUERIES = {
    "q_country_unmapped": country_unmapped,
    "q_country_mapping": country_mapping_grown,
    "q_country_standard": country_standard,
    "q_country_standard_keep": country_standard_keep,
}

_CUSTOMERS = """customers AS (
  SELECT c_custkey, n_name AS country_name
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

_UNMAPPED = """unmapped AS (
  SELECT DISTINCT country_name AS raw_country_name FROM customers
  WHERE country_name NOT IN (SELECT raw_country_name FROM mapping))"""

_STANDARD = f"""coalesce(m.cleaned_country_name, {standard_sql('c.country_name')})"""
_JOIN = "FROM customers c LEFT JOIN mapping m ON c.country_name = m.raw_country_name"

SQL = {
    "q_country_unmapped": with_sql(
        COUNTRY_MAPPING, _CUSTOMERS, _UNMAPPED, select="SELECT * FROM unmapped"
    ),
    "q_country_mapping": with_sql(
        COUNTRY_MAPPING,
        _CUSTOMERS,
        _UNMAPPED,
        select="SELECT * FROM mapping UNION ALL SELECT raw_country_name, "
        f"{standard_sql('raw_country_name')} FROM unmapped",
    ),
    "q_country_standard": with_sql(
        COUNTRY_MAPPING,
        _CUSTOMERS,
        select=f"SELECT c.c_custkey, {_STANDARD} AS country_name {_JOIN}",
    ),
    "q_country_standard_keep": with_sql(
        COUNTRY_MAPPING,
        _CUSTOMERS,
        select=f"SELECT c.c_custkey, CASE WHEN {_STANDARD} = 'not found' THEN c.country_name "
        f"ELSE {_STANDARD} END AS country_name {_JOIN}",
    ),
}
