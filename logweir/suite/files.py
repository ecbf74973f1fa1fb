"""Operators on files: what they write is derived from the given tables and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.operators.catalogue import day_range
from logweir.operators.columns import conform
from logweir.operators.ranges import range_conflicts
from logweir.operators.resolving import from_table
from logweir.plans import Layout, load_ip_ranges, run
from logweir.schemas import IP_RANGES, RAW_LOG
from logweir.sources.archives import write_logs
from logweir.sources.logs import read_csv_logs, read_zip_logs
from logweir.sources.tables import DAY_SCHEMA, read_days
from logweir.sources.workspace import fresh_path, written
from logweir.suite.cleaning import BOTS_DAYS, DATETIME, PROFILE_DAYS
from logweir.suite.locations import answers_table, found_sql
from logweir.suite.views import (
    ACCESS_LOG,
    ADDRESSES,
    COUNTRY_RULES,
    KNOWN_ADDRESSES,
    LOCATIONS_EXACT,
    LOCATIONS_RANGE,
    MANY_DAYS,
    REQUESTS,
    locations_exact,
    locations_range,
    many_days,
    standard_sql,
    table,
    with_sql,
)


def raw_log(spark: SparkSession, folder: str) -> DataFrame:
    """The log of many days with all columns that log files need, some values null or empty."""
    event = F.col("event_id")
    accession = F.when(event % 5 == 0, F.lit(None)).when(event % 5 == 1, "").otherwise(
        F.concat(F.lit('a "b", '), event.cast("string"))
    )
    log = many_days(spark, folder).withColumns({"accession": accession, "event_id": event.cast("string")})
    return conform(log, T.StructType([*RAW_LOG.fields, T.StructField("event_id", T.StringType()), *DAY_SCHEMA.fields]))


def csv_log(spark: SparkSession, folder: str) -> DataFrame:
    """One CSV file a day, read back; every other day is packed with gzip."""
    log, path = raw_log(spark, folder), fresh_path(spark, "csv-log")
    odd = F.dayofmonth("log_date") % 2 == 1
    plain = write_logs(log.where(odd), path, "csv")
    packed = write_logs(log.where(~odd), path, "csv.gz")
    return read_csv_logs(spark, [row["path"] for row in plain.unionByName(packed).collect()])


def zip_log(spark: SparkSession, folder: str) -> DataFrame:
    """One archive a day, read back."""
    path = fresh_path(spark, "zip-log")
    write_logs(raw_log(spark, folder), path, "zip")
    return read_zip_logs(spark, path)


def daily_output(spark: SparkSession, folder: str) -> DataFrame:
    """All days through the whole job, in two runs that have a day in common."""
    layout = Layout(fresh_path(spark, "daily"))
    log = raw_log(spark, folder)
    odd = F.dayofmonth("log_date") % 2 == 1
    write_logs(log.where(odd).drop("event_id"), layout.downloads, "csv")
    write_logs(log.where(~odd), layout.downloads, "zip")
    ranges = conform(locations_exact(spark, folder).where("country_code is not null"), IP_RANGES)
    path = fresh_path(spark, "ranges-csv")
    ranges.write.csv(path)
    load_ip_ranges(spark, path, layout.ip_ranges)
    ends = log.agg(F.min("log_date").alias("a"), F.max("log_date").alias("b")).first()
    middle = ends["a"] + (ends["b"] - ends["a"]) // 2
    resolver = from_table(written(answers_table(spark, folder), "answers"))
    thresholds = {key: MANY_DAYS[key] for key in ("r", "p", "v", "bucket")}
    # The day in the middle is done twice, the second time by force.
    for start, end, force in ((ends["a"], middle, False), (middle, ends["b"], True)):
        run(spark, layout.root, start, end, force, COUNTRY_RULES, resolver, **thresholds)
    days = [row["log_date"] for row in day_range(spark, ends["a"], ends["b"]).collect()]
    output = read_days(spark, layout.output, days)
    return output.select(
        "event_id", "log_date", "ip", "datetime", "accession", "cleaned_ip", "cleaned_ip_int", "ip_to",
        "country_code", "country_name", "city_name", "geolocation_db_attempted",
    )


def ip_ranges_loaded(spark: SparkSession, folder: str) -> DataFrame:
    """The ranges as a CSV file without header, loaded."""
    ranges = conform(locations_range(spark, folder), IP_RANGES)
    path = fresh_path(spark, "ranges-csv")
    ranges.write.csv(path)
    return load_ip_ranges(spark, path, fresh_path(spark, "ip-ranges"))


def faulty_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """A range for every order: some end before they start, repeat a start, overlap or lie outside."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    start = F.when(key % 7 == 0, key - 1).otherwise(key) * 300
    end = start + customer % 400 - 10
    return table(spark, folder, "orders").select(
        start.alias("ip_from"), F.when(key % 101 == 0, -key).when(key % 103 != 0, end).alias("ip_to")
    )


def conflicts(spark: SparkSession, folder: str) -> DataFrame:
    return range_conflicts(faulty_ranges(spark, folder))


QUERIES = {
    "q_csv_log": csv_log,
    "q_zip_log": zip_log,
    "q_daily_output": daily_output,
    "q_ip_ranges_loaded": ip_ranges_loaded,
    "q_range_conflicts": conflicts,
}

_FAULTY = """faulty AS (
  SELECT CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey - 1 ELSE o_orderkey END * 300 AS ip_from,
    CASE WHEN o_orderkey % 101 = 0 THEN -o_orderkey
         WHEN o_orderkey % 103 <> 0
         THEN CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey - 1 ELSE o_orderkey END * 300
              + o_custkey % 400 - 10 END AS ip_to
  FROM orders)"""

_KINDS = """kinds AS (
  SELECT *, CASE WHEN ip_from BETWEEN 0 AND 4294967295 AND ip_to BETWEEN 0 AND 4294967295
                 THEN CASE WHEN ip_to < ip_from THEN 'reversed' END ELSE 'outside' END AS conflict
  FROM faulty),
starts AS (
  SELECT ip_from, max(ip_to) AS ip_to, count(*) AS rows FROM kinds WHERE conflict IS NULL GROUP BY ip_from),
swept AS (
  SELECT *, max(ip_to) OVER (ORDER BY ip_from ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reaches
  FROM starts)"""

_RAW_LOG = """SELECT ip, date, time, CAST(cik AS double) AS cik,
    CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE concat('a "b", ', CAST(event_id AS varchar)) END AS accession,
    CAST(code AS double) AS code, CAST(idx AS double) AS idx, CAST(crawler AS double) AS crawler,
    CAST(event_id AS varchar) AS event_id, CAST(date AS date) AS log_date
  FROM access_log"""

# Learned rows beside the ranges with a country: the addresses that are no start of one.
_LEARNED = f"""known AS (SELECT * FROM locations WHERE country_code IS NOT NULL),
people AS (
  SELECT a.*, CAST(a.date AS date) AS log_date FROM addressed a
  WHERE NOT EXISTS (SELECT 1 FROM bots b WHERE b.ip = a.ip AND b.log_date = CAST(a.date AS date))),
missing AS (
  SELECT DISTINCT cleaned_ip_int FROM people
  WHERE cleaned_ip_int IS NOT NULL AND cleaned_ip_int NOT IN (SELECT ip_from FROM known)),
{found_sql("missing", "cleaned_ip_int")},
places AS (
  SELECT ip_from, ip_to, country_code, country_name, CAST(NULL AS varchar) AS city_name,
    false AS geolocation_db_attempted FROM known
  UNION ALL
  SELECT ip_from, ip_to, country_code, country_name, city_name, true FROM found)"""

SQL = {
    "q_csv_log": with_sql(ACCESS_LOG, select=_RAW_LOG),
    "q_zip_log": with_sql(ACCESS_LOG, select=_RAW_LOG),
    "q_daily_output": with_sql(
        ACCESS_LOG,
        REQUESTS,
        PROFILE_DAYS,
        BOTS_DAYS,
        ADDRESSES,
        KNOWN_ADDRESSES,
        LOCATIONS_EXACT,
        _LEARNED,
        select="SELECT CASE WHEN day(p.log_date) % 2 = 0 THEN CAST(event_id AS varchar) END AS event_id, p.log_date, ip, "
        f"{DATETIME}, CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' "
        "ELSE concat('a \"b\", ', CAST(event_id AS varchar)) END AS accession, cleaned_ip, cleaned_ip_int, "
        f"l.ip_to, l.country_code, {standard_sql('l.country_name')} AS country_name, l.city_name, "
        "l.geolocation_db_attempted FROM people p LEFT JOIN places l ON p.cleaned_ip_int = l.ip_from",
    ),
    "q_ip_ranges_loaded": with_sql(
        KNOWN_ADDRESSES,
        LOCATIONS_RANGE,
        select="SELECT ip_from, ip_to, country_code, country_name, "
        "CAST(NULL AS varchar) AS region_name, CAST(NULL AS varchar) AS city_name, "
        "CAST(NULL AS double) AS latitude, CAST(NULL AS double) AS longitude, "
        "CAST(NULL AS varchar) AS zip_code, CAST(NULL AS varchar) AS timezone FROM ranges",
    ),
    "q_range_conflicts": with_sql(
        _FAULTY,
        _KINDS,
        select="SELECT ip_from, ip_to, conflict, count(*) AS rows, CAST(NULL AS bigint) AS reaches "
        "FROM kinds WHERE conflict IS NOT NULL GROUP BY ip_from, ip_to, conflict "
        "UNION ALL SELECT ip_from, ip_to, 'repeated', rows, NULL FROM swept WHERE rows > 1 "
        "UNION ALL SELECT ip_from, ip_to, 'overlapping', rows, reaches FROM swept WHERE reaches >= ip_from",
    ),
}
