"""All steps in a row: clean, locate with lookups, standard country names, count."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.operators.resolving import from_table
from logweir.plans import clean_log, enrich_ip, standardise_country
from logweir.sources.workspace import written
from logweir.suite.cleaning import BOTS
from logweir.suite.locations import LEARNING, answers_table
from logweir.suite.views import (
    COUNTRY_MAPPING,
    COUNTRY_RULES,
    ONE_FILE,
    access_log,
    country_mapping,
    locations_exact,
    standard_sql,
    with_sql,
)


def days_by_country(spark: SparkSession, folder: str) -> DataFrame:
    """Requests of people, by day and standard country name."""
    # Two later steps read the clean log, so it is written, as in the daily job.
    clean = written(clean_log(access_log(spark, folder), **ONE_FILE), "clean")
    resolver = from_table(answers_table(spark, folder))
    # The location table is a stored one there, too, and read more than once.
    locations = written(locations_exact(spark, folder), "locations")
    located, _ = enrich_ip(clean, locations, resolver)
    standard, _ = standardise_country(located, country_mapping(spark, folder), COUNTRY_RULES)
    return standard.groupBy("date", "country_name").agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_distinct("cleaned_ip").alias("addresses"),
    )


QUERIES = {"q_days_by_country": days_by_country}

# The bots come before the addresses: lookups are for addresses of people only.
_ACCESS_LOG, _REQUESTS, *_REST = LEARNING
_KEPT = "requests AS (SELECT * FROM all_requests WHERE ip NOT IN (SELECT ip FROM bots))"

SQL = {
    "q_days_by_country": with_sql(
        _ACCESS_LOG,
        _REQUESTS.replace("requests AS", "all_requests AS"),
        BOTS.replace("FROM requests", "FROM all_requests"),
        _KEPT,
        *_REST,
        COUNTRY_MAPPING,
        "located AS (SELECT a.*, l.country_name FROM addressed a "
        "LEFT JOIN updated l ON a.cleaned_ip_int = l.ip_from)",
        "named AS (SELECT c.date, c.cleaned_ip, coalesce(m.cleaned_country_name, "
        f"{standard_sql('c.country_name')}) AS country_name FROM located c "
        "LEFT JOIN mapping m ON c.country_name = m.raw_country_name)",
        select="SELECT date, country_name, count(*) AS requests, "
        "count(DISTINCT cleaned_ip) AS addresses FROM named GROUP BY date, country_name",
    ),
}
