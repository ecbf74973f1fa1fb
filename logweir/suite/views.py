"""The tables of an access-log pipeline, derived from the given tables.

Each view exists twice: as a DataFrame and as the text of a SQL common table
expression.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.operators.countries import CountryRule

DAY = dt.date(2024, 1, 1)

# The given events are sparse: no user has more than two in a minute. With a
# day as the bucket and these thresholds every rule marks some addresses.
ONE_FILE = {"r": 5, "p": 4, "v": 40, "bucket": "day"}
# The same for many days, with an hour as the bucket.
MANY_DAYS = {"r": 1, "p": 1, "v": 4, "bucket": "hour"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def with_sql(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def access_log(spark: SparkSession, folder: str) -> DataFrame:
    """`events` as an access log; some addresses are no IPv4 addresses."""
    user = F.col("user_id")
    entity = F.get_json_object("props", "$.k").cast("bigint")
    masked = F.concat(
        (user % 223 + 1).cast("string"),
        F.lit("."),
        (user % 256).cast("string"),
        F.lit("."),
        (user * 7 % 256).cast("string"),
        F.lit(".abc"),
    )
    odd = F.concat(F.lit("unknown-"), user.cast("string"))
    return table(spark, folder, "events").select(
        "event_id",
        F.when(user % 17 == 0, odd).otherwise(masked).alias("ip"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.date_format("ts", "HH:mm:ss").alias("time"),
        entity.alias("cik"),
        F.when(F.col("event_type") == "error", 404).otherwise(200).alias("code"),
        F.when(F.col("event_type") == "signup", 1).otherwise(0).alias("idx"),
        F.when(entity == 13, 1).otherwise(0).alias("crawler"),
    )


ACCESS_LOG = """access_log AS (
  SELECT event_id,
    CASE WHEN user_id % 17 = 0 THEN concat('unknown-', CAST(user_id AS varchar))
         ELSE concat(CAST(user_id % 223 + 1 AS varchar), '.', CAST(user_id % 256 AS varchar), '.',
                     CAST((user_id * 7) % 256 AS varchar), '.abc') END AS ip,
    strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H:%M:%S') AS time,
    CAST(json_extract_string(props, '$.k') AS bigint) AS cik,
    CASE WHEN event_type = 'error' THEN 404 ELSE 200 END AS code,
    CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS idx,
    CASE WHEN CAST(json_extract_string(props, '$.k') AS bigint) = 13 THEN 1 ELSE 0 END AS crawler
  FROM events)"""

REQUESTS = """requests AS (
  SELECT * FROM access_log WHERE code = 200 AND idx = 0 AND crawler = 0)"""


def one_file(spark: SparkSession, folder: str) -> DataFrame:
    """The whole log as the log of one day."""
    return access_log(spark, folder).withColumn("log_date", F.lit(DAY))


def many_days(spark: SparkSession, folder: str) -> DataFrame:
    log = access_log(spark, folder)
    return log.withColumn("log_date", F.to_date("date"))


# Octets by position in the text, as the expressions of the package do not
# exist in SQL.
ADDRESSES = r"""cleaned AS (
  SELECT *, CASE WHEN regexp_matches(ip, '^\d{1,3}\.\d{1,3}\.\d{1,3}\.[^.\s]+$')
                 THEN concat(split_part(ip, '.', 1), '.', split_part(ip, '.', 2), '.',
                             split_part(ip, '.', 3), '.0') END AS cleaned_ip
  FROM requests),
addressed AS (
  SELECT *, CASE WHEN CAST(split_part(cleaned_ip, '.', 1) AS bigint) <= 255
                  AND CAST(split_part(cleaned_ip, '.', 2) AS bigint) <= 255
                  AND CAST(split_part(cleaned_ip, '.', 3) AS bigint) <= 255
                  AND NOT regexp_matches(cleaned_ip, '(^|\.)0\d')
                 THEN CAST(split_part(cleaned_ip, '.', 1) AS bigint) * 16777216
                    + CAST(split_part(cleaned_ip, '.', 2) AS bigint) * 65536
                    + CAST(split_part(cleaned_ip, '.', 3) AS bigint) * 256 END AS cleaned_ip_int
  FROM cleaned)"""


def addresses_of_events(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct numbers of the addresses of all users, without going over the text.

    Users whose address in the log is no IPv4 address have one here, so some of
    these addresses never occur in the log.
    """
    user = F.col("user_id")
    number = (user % 223 + 1) * 16777216 + (user % 256) * 65536 + (user * 7 % 256) * 256
    return table(spark, folder, "events").select(number.alias("x")).distinct()


KNOWN_ADDRESSES = """known_addresses AS (
  SELECT DISTINCT (user_id % 223 + 1) * 16777216 + (user_id % 256) * 65536
       + (user_id * 7 % 256) * 256 AS x
  FROM events)"""

# First addresses of the networks that get different kinds of location rows.
_NO_COUNTRY, _NOT_TRIED, _ABSENT = (n * 16777216 for n in (64, 96, 128))


def locations_exact(spark: SparkSession, folder: str) -> DataFrame:
    """Location table whose range starts are addresses of the log.

    By network: a country is known; known to have none; never tried; absent.
    """
    x = F.col("x")
    known = x < _NO_COUNTRY
    country = F.concat(F.lit("NATION_"), (F.floor(x / 65536) % 25).cast("string"))
    return addresses_of_events(spark, folder).where(x < _ABSENT).select(
        x.alias("ip_from"),
        (x + 255).alias("ip_to"),
        F.when(known, F.concat(F.lit("N"), (F.floor(x / 65536) % 25).cast("string"))).alias(
            "country_code"
        ),
        F.when(known, country).alias("country_name"),
        F.lit(None).cast("string").alias("region_name"),
        F.lit(None).cast("string").alias("city_name"),
        F.when(known, (F.floor(x / 16777216) - 90).cast("double")).alias("latitude"),
        F.when(known, (F.floor(x / 65536) % 256 - 128).cast("double")).alias("longitude"),
        F.lit(None).cast("string").alias("zip_code"),
        F.lit(None).cast("string").alias("timezone"),
        ((x >= _NO_COUNTRY) & (x < _NOT_TRIED)).alias("geolocation_db_attempted"),
    )


LOCATIONS_EXACT = f"""locations AS (
  SELECT x AS ip_from, x + 255 AS ip_to,
    CASE WHEN x < {_NO_COUNTRY} THEN concat('N', CAST((x // 65536) % 25 AS varchar)) END
      AS country_code,
    CASE WHEN x < {_NO_COUNTRY} THEN concat('NATION_', CAST((x // 65536) % 25 AS varchar)) END
      AS country_name,
    CAST(NULL AS varchar) AS region_name, CAST(NULL AS varchar) AS city_name,
    CASE WHEN x < {_NO_COUNTRY} THEN CAST(x // 16777216 - 90 AS double) END AS latitude,
    CASE WHEN x < {_NO_COUNTRY} THEN CAST((x // 65536) % 256 - 128 AS double) END AS longitude,
    CAST(NULL AS varchar) AS zip_code, CAST(NULL AS varchar) AS timezone,
    x >= {_NO_COUNTRY} AND x < {_NOT_TRIED} AS geolocation_db_attempted
  FROM known_addresses WHERE x < {_ABSENT})"""


def locations_range(spark: SparkSession, folder: str) -> DataFrame:
    """One range in each block of 65,536 addresses, from its eighth address on.

    It holds some addresses of the block and misses others, and as it starts
    at none of them, the exact lookup finds nothing.
    """
    x = F.col("x")
    block = F.floor(x / 65536) * 65536
    return (
        addresses_of_events(spark, folder)
        .where(x < _ABSENT)
        .select(block.alias("b"))
        .distinct()
        .select(
            (F.col("b") + 7).alias("ip_from"),
            (F.col("b") + 40007).alias("ip_to"),
            F.concat(F.lit("N"), (F.floor(F.col("b") / 65536) % 25).cast("string")).alias(
                "country_code"
            ),
            F.concat(F.lit("NATION_"), (F.floor(F.col("b") / 65536) % 25).cast("string")).alias(
                "country_name"
            ),
        )
    )


LOCATIONS_RANGE = f"""ranges AS (
  SELECT b + 7 AS ip_from, b + 40007 AS ip_to,
    concat('N', CAST((b // 65536) % 25 AS varchar)) AS country_code,
    concat('NATION_', CAST((b // 65536) % 25 AS varchar)) AS country_name
  FROM (SELECT DISTINCT x // 65536 * 65536 AS b FROM known_addresses WHERE x < {_ABSENT}))"""

# Country rules for the invented nation names: ten are known.
COUNTRY_RULES = [CountryRule(n, f"^nation_{n}$", f"Country No. {n}") for n in range(10, 20)]


def country_mapping(spark: SparkSession, folder: str) -> DataFrame:
    """A mapping that already holds the nations of the first two regions."""
    return table(spark, folder, "nation").where(F.col("n_regionkey") < 2).select(
        F.col("n_name").alias("raw_country_name"),
        F.concat(F.lit("Mapped "), F.col("n_name")).alias("cleaned_country_name"),
    )


COUNTRY_MAPPING = """mapping AS (
  SELECT n_name AS raw_country_name, concat('Mapped ', n_name) AS cleaned_country_name
  FROM nation WHERE n_regionkey < 2)"""


def standard_sql(name: str) -> str:
    """SQL for the rules above, for a name that the mapping does not hold."""
    return (
        f"CASE WHEN regexp_matches({name}, '^NATION_1[0-9]$') "
        f"THEN concat('Country No. ', substr({name}, 8)) "
        f"WHEN {name} IS NOT NULL THEN 'not found' END"
    )
