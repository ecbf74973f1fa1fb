"""Base filter, rules, bot removal, address cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.functions import clean_ip, ipv4_to_long
from logweir.operators.addresses import with_clean_ip
from logweir.operators.rules import (
    bots_by_entities,
    bots_by_rate,
    bots_by_volume,
    find_bots,
    rule_base,
    successful_requests,
    traffic_profile,
    union_of_bots,
    with_datetime,
)
from logweir.plans import clean_log
from logweir.suite.views import (
    ACCESS_LOG,
    ADDRESSES,
    MANY_DAYS,
    ONE_FILE,
    REQUESTS,
    access_log,
    many_days,
    one_file,
    table,
    with_sql,
)

_R, _P, _V = (ONE_FILE[key] for key in "rpv")


def _base(spark: SparkSession, folder: str) -> DataFrame:
    return rule_base(successful_requests(one_file(spark, folder)), ONE_FILE["bucket"])


def _base_days(spark: SparkSession, folder: str) -> DataFrame:
    return rule_base(successful_requests(many_days(spark, folder)), MANY_DAYS["bucket"])


def base_filter(spark: SparkSession, folder: str) -> DataFrame:
    return successful_requests(access_log(spark, folder))


def datetimes(spark: SparkSession, folder: str) -> DataFrame:
    return with_datetime(access_log(spark, folder)).select("event_id", "datetime")


def rule_r(spark: SparkSession, folder: str) -> DataFrame:
    return bots_by_rate(_base(spark, folder), _R).select("ip")


def rule_p(spark: SparkSession, folder: str) -> DataFrame:
    return bots_by_entities(_base(spark, folder), _P).select("ip")


def rule_v(spark: SparkSession, folder: str) -> DataFrame:
    return bots_by_volume(_base(spark, folder), _V).select("ip")


def rule_p_null(spark: SparkSession, folder: str) -> DataFrame:
    base = _base(spark, folder)
    holes = base.withColumn("cik", F.when(F.col("cik") % 10 != 0, F.col("cik")))
    return bots_by_entities(holes, _P).select("ip")


def bot_ips(spark: SparkSession, folder: str) -> DataFrame:
    base = _base(spark, folder)
    return union_of_bots(
        bots_by_rate(base, _R), bots_by_entities(base, _P), bots_by_volume(base, _V)
    ).select("ip")


def bot_ips_one_pass(spark: SparkSession, folder: str) -> DataFrame:
    return find_bots(_base(spark, folder), _R, _P, _V).select("ip", "requests")


def bot_ips_days(spark: SparkSession, folder: str) -> DataFrame:
    thresholds = (MANY_DAYS[key] for key in "rpv")
    return find_bots(_base_days(spark, folder), *thresholds).select("log_date", "ip", "requests")


def bot_ips_minute(spark: SparkSession, folder: str) -> DataFrame:
    base = rule_base(successful_requests(many_days(spark, folder)), "minute")
    thresholds = (MANY_DAYS[key] for key in "rpv")
    return find_bots(base, *thresholds).select("log_date", "ip", "requests")


def profile_days(spark: SparkSession, folder: str) -> DataFrame:
    return traffic_profile(_base_days(spark, folder))


def clean(spark: SparkSession, folder: str) -> DataFrame:
    return clean_log(access_log(spark, folder), **ONE_FILE)


def clean_days(spark: SparkSession, folder: str) -> DataFrame:
    return clean_log(many_days(spark, folder), **MANY_DAYS)


def ip_clean(spark: SparkSession, folder: str) -> DataFrame:
    log = access_log(spark, folder)
    return with_clean_ip(log).select("event_id", "cleaned_ip", "cleaned_ip_int")


def ip_clean_docs(spark: SparkSession, folder: str) -> DataFrame:
    """Every dotted quad in the texts, as it stands and cleaned."""
    quads = F.regexp_extract_all("text", F.lit(r"\b(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})\b"), 1)
    found = table(spark, folder, "documents").select("doc_id", F.explode(quads).alias("ip"))
    cleaned = clean_ip(F.col("ip"))
    return found.select(
        "doc_id",
        "ip",
        ipv4_to_long(F.col("ip")).alias("ip_int"),
        cleaned.alias("cleaned_ip"),
        ipv4_to_long(cleaned).alias("cleaned_ip_int"),
    )


QUERIES = {
    "q_base_filter": base_filter,
    "q_datetime": datetimes,
    "q_rule_r": rule_r,
    "q_rule_p": rule_p,
    "q_rule_v": rule_v,
    "q_rule_p_null": rule_p_null,
    "q_bot_ips": bot_ips,
    "q_bot_ips_one_pass": bot_ips_one_pass,
    "q_bot_ips_days": bot_ips_days,
    "q_bots_minute": bot_ips_minute,
    "q_traffic_profile": profile_days,
    "q_clean_log": clean,
    "q_clean_log_days": clean_days,
    "q_ip_clean": ip_clean,
    "q_ip_clean_docs": ip_clean_docs,
}

# Bots of the log as one file, as three rules.
BOTS = f"""bots AS (
  SELECT ip FROM requests GROUP BY ip, date HAVING count(*) > {_R}
  UNION
  SELECT ip FROM requests GROUP BY ip, date HAVING count(DISTINCT cik) > {_P}
  UNION
  SELECT ip FROM requests GROUP BY ip HAVING count(*) > {_V})"""

PROFILE_DAYS = """per_hour AS (
  SELECT CAST(date AS date) AS log_date, ip, substr(time, 1, 2) AS hour,
    count(*) AS n, count(DISTINCT cik) AS entities
  FROM requests GROUP BY ALL),
profile AS (
  SELECT log_date, ip, CAST(max(n) AS bigint) AS max_requests,
    CAST(max(entities) AS bigint) AS max_entities, CAST(sum(n) AS bigint) AS requests
  FROM per_hour GROUP BY ALL)"""

BOTS_DAYS = f"""bots AS (
  SELECT log_date, ip, requests FROM profile
  WHERE max_requests > {MANY_DAYS['r']} OR max_entities > {MANY_DAYS['p']}
     OR requests > {MANY_DAYS['v']})"""

DATETIME = "CAST(concat(date, ' ', time) AS timestamp) AS datetime"

_QUAD = r"""quads AS (
  SELECT doc_id, unnest(regexp_extract_all(text,
    '\b(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})\b', 1)) AS ip FROM documents)"""


def _number(text: str) -> str:
    octets = [f"CAST(split_part({text}, '.', {n}) AS bigint)" for n in (1, 2, 3, 4)]
    legal = " AND ".join(f"{octet} <= 255" for octet in octets)
    value = " + ".join(f"{o} * {w}" for o, w in zip(octets, (16777216, 65536, 256, 1)))
    return rf"CASE WHEN {legal} AND NOT regexp_matches({text}, '(^|\.)0\d') THEN {value} END"


SQL = {
    "q_base_filter": with_sql(
        ACCESS_LOG, select="SELECT * FROM access_log WHERE code = 200 AND idx = 0 AND crawler = 0"
    ),
    "q_datetime": with_sql(ACCESS_LOG, select=f"SELECT event_id, {DATETIME} FROM access_log"),
    "q_rule_r": with_sql(
        ACCESS_LOG,
        REQUESTS,
        select=f"SELECT DISTINCT ip FROM requests GROUP BY ip, date HAVING count(*) > {_R}",
    ),
    "q_rule_p": with_sql(
        ACCESS_LOG,
        REQUESTS,
        select="SELECT DISTINCT ip FROM requests GROUP BY ip, date "
        f"HAVING count(DISTINCT cik) > {_P}",
    ),
    "q_rule_v": with_sql(
        ACCESS_LOG,
        REQUESTS,
        select=f"SELECT ip FROM requests GROUP BY ip HAVING count(*) > {_V}",
    ),
    "q_rule_p_null": with_sql(
        ACCESS_LOG,
        REQUESTS,
        "holes AS (SELECT ip, date, CASE WHEN cik % 10 <> 0 THEN cik END AS cik FROM requests)",
        select="SELECT DISTINCT ip FROM holes GROUP BY ip, date "
        f"HAVING count(DISTINCT cik) + max(CASE WHEN cik IS NULL THEN 1 ELSE 0 END) > {_P}",
    ),
    "q_bot_ips": with_sql(ACCESS_LOG, REQUESTS, BOTS, select="SELECT ip FROM bots"),
    "q_bot_ips_one_pass": with_sql(
        ACCESS_LOG,
        REQUESTS,
        BOTS,
        select="SELECT ip, count(*) AS requests FROM requests "
        "WHERE ip IN (SELECT ip FROM bots) GROUP BY ip",
    ),
    "q_bot_ips_days": with_sql(
        ACCESS_LOG, REQUESTS, PROFILE_DAYS, BOTS_DAYS, select="SELECT * FROM bots"
    ),
    "q_bots_minute": with_sql(
        ACCESS_LOG,
        REQUESTS,
        PROFILE_DAYS.replace("substr(time, 1, 2) AS hour", "substr(time, 1, 5) AS minute"),
        BOTS_DAYS,
        select="SELECT * FROM bots",
    ),
    "q_traffic_profile": with_sql(
        ACCESS_LOG, REQUESTS, PROFILE_DAYS, select="SELECT * FROM profile"
    ),
    "q_clean_log": with_sql(
        ACCESS_LOG,
        REQUESTS,
        BOTS,
        ADDRESSES,
        select=f"SELECT *, {DATETIME} FROM addressed a "
        "WHERE NOT EXISTS (SELECT 1 FROM bots b WHERE b.ip = a.ip)",
    ),
    "q_clean_log_days": with_sql(
        ACCESS_LOG,
        REQUESTS,
        PROFILE_DAYS,
        BOTS_DAYS,
        ADDRESSES,
        select=f"SELECT *, CAST(date AS date) AS log_date, {DATETIME} FROM addressed a "
        "WHERE NOT EXISTS (SELECT 1 FROM bots b WHERE b.ip = a.ip "
        "AND b.log_date = CAST(a.date AS date))",
    ),
    "q_ip_clean": with_sql(
        ACCESS_LOG,
        "requests AS (SELECT * FROM access_log)",
        ADDRESSES,
        select="SELECT event_id, cleaned_ip, cleaned_ip_int FROM addressed",
    ),
    "q_ip_clean_docs": with_sql(
        _QUAD,
        "cleaned AS (SELECT doc_id, ip, concat(split_part(ip, '.', 1), '.', "
        "split_part(ip, '.', 2), '.', split_part(ip, '.', 3), '.0') AS cleaned_ip FROM quads)",
        select=f"SELECT doc_id, ip, {_number('ip')} AS ip_int, cleaned_ip, "
        f"{_number('cleaned_ip')} AS cleaned_ip_int FROM cleaned",
    ),
}
