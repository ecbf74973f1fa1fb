"""Location lookup: exact, by range, what is missing, and the cache of answers."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.functions import zone_offset
from logweir.operators.addresses import (
    distinct_addresses,
    location_table,
    match_exact,
    match_range,
    needs_lookup,
    updated_locations,
    with_clean_ip,
)
from logweir.operators.columns import conform, drop_columns
from logweir.operators.resolving import calling, from_table, point_locations
from logweir.operators.rules import successful_requests
from logweir.plans import enrich_ip
from logweir.schemas import LOCATIONS
from logweir.suite.views import (
    ACCESS_LOG,
    ADDRESSES,
    KNOWN_ADDRESSES,
    LOCATIONS_EXACT,
    LOCATIONS_RANGE,
    REQUESTS,
    access_log,
    addresses_of_events,
    locations_exact,
    locations_range,
    table,
    with_sql,
)

# Instant of all zone offsets, in summer time of the northern half.
_AT = "2024-07-01T00:00:00Z"

# Zones of the offset query and their offsets at that instant (fixed values).
ZONES = {
    "Africa/Lagos": "+01:00",
    "America/New_York": "-04:00",
    "Asia/Kolkata": "+05:30",
    "Australia/Adelaide": "+09:30",
    "Pacific/Auckland": "+12:00",
    "America/St_Johns": "-02:30",
    "Etc/UTC": "+00:00",
}


def _at() -> Column:
    return F.lit(_AT).cast("timestamp")


def requests(spark: SparkSession, folder: str) -> DataFrame:
    return with_clean_ip(successful_requests(access_log(spark, folder)))


def _addresses(spark: SparkSession, folder: str) -> DataFrame:
    return distinct_addresses(requests(spark, folder))


def stub_answer(ip: str) -> str | None:
    """Stands in for a location service: half of the networks are known."""
    first, second, third, _ = (int(octet) for octet in ip.split("."))
    if third >= 128:
        return None
    nation = (first * 256 + second) % 25
    return json.dumps(
        {
            "country_code": f"N{nation}",
            "country_name": f"NATION_{nation}",
            "state": "Not found",
            "city": f"City {second}",
            "latitude": first - 90,
            "longitude": "Not found" if second < 9 else second - 128,
            "postal": f"{third:05d}",
            "zone": "Asia/Kolkata",
        }
    )


def answers_table(spark: SparkSession, folder: str) -> DataFrame:
    """The same answers as a table over all addresses of the log."""
    x = F.col("x")
    first, second, third = F.floor(x / 16777216), F.floor(x / 65536) % 256, F.floor(x / 256) % 256
    nation = ((first * 256 + second) % 25).cast("string")
    answer = F.to_json(
        F.struct(
            F.concat(F.lit("N"), nation).alias("country_code"),
            F.concat(F.lit("NATION_"), nation).alias("country_name"),
            F.lit("Not found").alias("state"),
            F.concat(F.lit("City "), second.cast("string")).alias("city"),
            (first - 90).alias("latitude"),
            F.when(second < 9, F.lit("Not found"))
            .otherwise((second - 128).cast("string"))
            .alias("longitude"),
            F.lpad(third.cast("string"), 5, "0").alias("postal"),
            F.lit("Asia/Kolkata").alias("zone"),
        )
    )
    return addresses_of_events(spark, folder).select(
        x.alias("cleaned_ip_int"), F.when(third < 128, answer).alias("payload")
    )


def location_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Ranges without the attempted mark, in the columns of the location table."""
    plain = drop_columns(locations_range(spark, folder), "geolocation_db_attempted", "no_such")
    return location_table(plain)


def ip_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return _addresses(spark, folder)


def geo_exact(spark: SparkSession, folder: str) -> DataFrame:
    log = requests(spark, folder)
    enriched, _ = enrich_ip(log, locations_exact(spark, folder))
    return enriched


def geo_exact_addresses(spark: SparkSession, folder: str) -> DataFrame:
    return match_exact(_addresses(spark, folder), locations_exact(spark, folder))


def _missing(spark: SparkSession, folder: str) -> DataFrame:
    located = match_exact(_addresses(spark, folder), locations_exact(spark, folder))
    return needs_lookup(located)


def geo_lookup(spark: SparkSession, folder: str) -> DataFrame:
    answers = calling(stub_answer, pause=0.0)(_missing(spark, folder))
    return point_locations(answers, _at())


def geo_cache_update(spark: SparkSession, folder: str) -> DataFrame:
    resolver = from_table(answers_table(spark, folder))
    found = point_locations(resolver(_missing(spark, folder)), _at())
    return updated_locations(locations_exact(spark, folder), found)


def geo_learned(spark: SparkSession, folder: str) -> DataFrame:
    resolver = from_table(answers_table(spark, folder))
    log = requests(spark, folder)
    enriched, _ = enrich_ip(log, locations_exact(spark, folder), resolver, at=_at())
    return enriched


def _ranges(spark: SparkSession, folder: str) -> DataFrame:
    return conform(locations_range(spark, folder), LOCATIONS)


_RANGE_COLUMNS = ["cleaned_ip", "cleaned_ip_int", "ip_to", "country_code", "country_name"]


def geo_range(spark: SparkSession, folder: str) -> DataFrame:
    found = match_range(_addresses(spark, folder), _ranges(spark, folder))
    return found.select(*_RANGE_COLUMNS)


def geo_range_log(spark: SparkSession, folder: str) -> DataFrame:
    log = requests(spark, folder)
    enriched, _ = enrich_ip(log, _ranges(spark, folder), match="range")
    return enriched.select("event_id", *_RANGE_COLUMNS)


def payload_rows(spark: SparkSession, folder: str) -> DataFrame:
    return point_locations(answers_table(spark, folder), _at())


def zone_offsets(spark: SparkSession, folder: str) -> DataFrame:
    names = list(ZONES)
    zone = F.element_at(F.array(*map(F.lit, names)), (F.col("c_nationkey") % len(names)) + 1)
    return table(spark, folder, "customer").select(
        "c_custkey", zone.alias("zone"), zone_offset(zone, _at()).alias("utc_offset")
    )


QUERIES = {
    "q_location_columns": location_columns,
    "q_ip_distinct": ip_distinct,
    "q_geo_exact": geo_exact,
    "q_geo_exact_addresses": geo_exact_addresses,
    "q_geo_missing": _missing,
    "q_geo_lookup": geo_lookup,
    "q_geo_cache_update": geo_cache_update,
    "q_geo_learned": geo_learned,
    "q_geo_range": geo_range,
    "q_geo_range_log": geo_range_log,
    "q_payload_rows": payload_rows,
    "q_zone_offset": zone_offsets,
}

_PLACE = (
    "l.ip_to, l.country_code, l.country_name, l.region_name, l.city_name, l.latitude, "
    "l.longitude, l.zip_code, l.timezone, l.geolocation_db_attempted"
)

_DISTINCT = "addresses AS (SELECT DISTINCT cleaned_ip, cleaned_ip_int FROM addressed)"

MISSING = """missing AS (
  SELECT a.cleaned_ip, a.cleaned_ip_int FROM addresses a
  LEFT JOIN locations l ON a.cleaned_ip_int = l.ip_from
  WHERE NOT coalesce(l.geolocation_db_attempted, false) AND l.country_code IS NULL
    AND a.cleaned_ip IS NOT NULL)"""


def found_sql(source: str, number: str) -> str:
    """SQL of the stub's answers for the addresses of a table."""
    first, second, third = (
        f"({number} // 16777216)",
        f"({number} // 65536 % 256)",
        f"({number} // 256 % 256)",
    )
    nation = f"CAST(({first} * 256 + {second}) % 25 AS varchar)"
    hit = f"{third} < 128"
    return f"""found AS (
  SELECT {number} AS ip_from, {number} AS ip_to,
    CASE WHEN {hit} THEN concat('N', {nation}) END AS country_code,
    CASE WHEN {hit} THEN concat('NATION_', {nation}) END AS country_name,
    CAST(NULL AS varchar) AS region_name,
    CASE WHEN {hit} THEN concat('City ', CAST({second} AS varchar)) END AS city_name,
    CASE WHEN {hit} THEN CAST({first} - 90 AS double) END AS latitude,
    CASE WHEN {hit} AND {second} >= 9 THEN CAST({second} - 128 AS double) END AS longitude,
    CASE WHEN {hit} THEN lpad(CAST({third} AS varchar), 5, '0') END AS zip_code,
    CASE WHEN {hit} AND {second} >= 9 THEN '+05:30' END AS timezone,
    true AS geolocation_db_attempted
  FROM {source})"""


UPDATED = """updated AS (
  SELECT * FROM locations WHERE country_code IS NOT NULL OR geolocation_db_attempted
  UNION ALL SELECT * FROM found)"""

_BASE = (ACCESS_LOG, REQUESTS, ADDRESSES, _DISTINCT, KNOWN_ADDRESSES)
LEARNING = (*_BASE, LOCATIONS_EXACT, MISSING, found_sql("missing", "cleaned_ip_int"), UPDATED)

_RANGE = "l.ip_to, l.country_code, l.country_name"
_IN_RANGE = "LEFT JOIN ranges l ON a.cleaned_ip_int BETWEEN l.ip_from AND l.ip_to"

SQL = {
    "q_location_columns": with_sql(
        KNOWN_ADDRESSES,
        LOCATIONS_RANGE,
        select="SELECT ip_from, ip_to, country_code, country_name, "
        "CAST(NULL AS varchar) AS region_name, CAST(NULL AS varchar) AS city_name, "
        "CAST(NULL AS double) AS latitude, CAST(NULL AS double) AS longitude, "
        "CAST(NULL AS varchar) AS zip_code, CAST(NULL AS varchar) AS timezone, "
        "false AS geolocation_db_attempted FROM ranges",
    ),
    "q_ip_distinct": with_sql(
        ACCESS_LOG, REQUESTS, ADDRESSES, _DISTINCT, select="SELECT * FROM addresses"
    ),
    "q_geo_exact": with_sql(
        *_BASE,
        LOCATIONS_EXACT,
        select=f"SELECT a.*, {_PLACE} FROM addressed a "
        "LEFT JOIN locations l ON a.cleaned_ip_int = l.ip_from",
    ),
    "q_geo_exact_addresses": with_sql(
        *_BASE,
        LOCATIONS_EXACT,
        select=f"SELECT a.*, {_PLACE} FROM addresses a "
        "LEFT JOIN locations l ON a.cleaned_ip_int = l.ip_from",
    ),
    "q_geo_missing": with_sql(*_BASE, LOCATIONS_EXACT, MISSING, select="SELECT * FROM missing"),
    "q_geo_lookup": with_sql(*LEARNING, select="SELECT * FROM found"),
    "q_geo_cache_update": with_sql(*LEARNING, select="SELECT * FROM updated"),
    "q_geo_learned": with_sql(
        *LEARNING,
        select=f"SELECT a.*, {_PLACE} FROM addressed a "
        "LEFT JOIN updated l ON a.cleaned_ip_int = l.ip_from",
    ),
    "q_geo_range": with_sql(
        *_BASE, LOCATIONS_RANGE, select=f"SELECT a.*, {_RANGE} FROM addresses a {_IN_RANGE}"
    ),
    "q_geo_range_log": with_sql(
        *_BASE,
        LOCATIONS_RANGE,
        select=f"SELECT a.event_id, a.cleaned_ip, a.cleaned_ip_int, {_RANGE} "
        f"FROM addressed a {_IN_RANGE}",
    ),
    "q_payload_rows": with_sql(
        KNOWN_ADDRESSES, found_sql("known_addresses", "x"), select="SELECT * FROM found"
    ),
    "q_zone_offset": with_sql(
        "zones(n, zone, utc_offset) AS (VALUES "
        + ", ".join(f"({n}, '{zone}', '{off}')" for n, (zone, off) in enumerate(ZONES.items()))
        + ")",
        select="SELECT c_custkey, zone, utc_offset FROM customer "
        f"JOIN zones ON n = c_nationkey % {len(ZONES)}",
    ),
}
