"""URLs and transferred volume."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.functions import DEFAULT_BLOCKED_URLS, is_blocked, normalize_url
from logweir.operators.blocklist import mark_blocked
from logweir.operators.traffic import transferred_mb
from logweir.suite.views import table, with_sql

_BLOCKED = ("*.html", "*utm_source=*", "*#top")


def urls(spark: SparkSession, folder: str) -> DataFrame:
    """URLs of the pages; those of even pages lose their path."""
    url = F.col("url")
    bare = F.regexp_replace(url, r"^(\w+://[^/?#]*)[^?#]*", "$1")
    return table(spark, folder, "pages").select(
        "page_id", F.when(F.col("page_id") % 2 == 0, bare).otherwise(url).alias("url")
    )


def url_normalise(spark: SparkSession, folder: str) -> DataFrame:
    return urls(spark, folder).select("page_id", normalize_url(F.col("url")).alias("url"))


def url_blocklist(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return pages.where(~is_blocked(F.col("url"), _BLOCKED, match="whole"))


# Ends that make files of the pages' addresses; some are on the default list.
_ENDS = (".png", ".woff2?v=1", "/static/app.js", "/app.js", "/gtm.js?id=1", ".css/a", "")


def url_blocklist_default(spark: SparkSession, folder: str) -> DataFrame:
    """Files next to the pages, by the default list."""
    number = (F.col("page_id") % len(_ENDS) + 1).cast("int")
    end = F.element_at(F.array(*map(F.lit, _ENDS)), number)
    url = F.concat(F.regexp_replace("url", "[?#].*$", ""), end)
    files = table(spark, folder, "pages").select("page_id", url.alias("url"))
    return files.select("page_id", "url", is_blocked(F.col("url"), match="whole").alias("blocked"))


def url_blocklist_part(spark: SparkSession, folder: str) -> DataFrame:
    """The default list, looked for anywhere in addresses that pass through some of its sites."""
    number = (F.col("page_id") % len(_VIA) + 1).cast("int")
    url = F.concat(F.element_at(F.array(*map(F.lit, _VIA)), number), F.col("url"))
    pages = table(spark, folder, "pages").select("page_id", url.alias("url"))
    return pages.select("page_id", "url", is_blocked(F.col("url")).alias("blocked"))


# What stands before a page's address; two of them are on the default list.
_VIA = ("", "https://www.youtube.com/redirect?q=", "https://www.facebook.com/l.php?u=", "https://a.example/?u=")


def url_patterns(spark: SparkSession, folder: str) -> DataFrame:
    """Block patterns made of the pages' addresses, some short, some without a literal part."""
    url, n = F.col("url"), F.col("page_id")
    site = F.regexp_extract(url, r"^https?://([^./]*)", 1)
    path = F.regexp_extract(url, r"([^/]*)$", 1)
    pattern = (
        F.when(n % 5 == 0, F.concat(F.lit("http*://"), site, F.lit(".*/en/*")))
        .when(n % 5 == 1, F.concat(F.lit("*/"), path))
        .when(n % 5 == 2, F.concat(F.lit("x_%y*"), site))
        .when(n % 25 == 3, F.concat((n % 1000).cast("string"), F.lit("?")))
        .when(n % 5 == 4, F.concat(site, F.lit("*"), path, F.lit("*")))
    )
    return table(spark, folder, "pages").select(pattern.alias("pattern"))


def url_blocklist_table(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return mark_blocked(pages, url_patterns(spark, folder).where("pattern not in ('*/', '*')"))


def network_log(spark: SparkSession, folder: str) -> DataFrame:
    """`events` as lines of a browser's network log."""
    size = F.get_json_object("props", "$.k").cast("bigint")
    method = F.when(F.col("event_type") == "click", "Network.loadingFinished").otherwise(
        F.lit("Network.dataReceived")
    )
    params = F.struct(size.alias("encodedDataLength"))
    inner = F.struct(method.alias("method"), params.alias("params"))
    message = F.to_json(F.struct(inner.alias("message")))
    return table(spark, folder, "events").select(
        F.to_json(F.struct(message.alias("message"))).alias("line")
    )


def transfer_mb(spark: SparkSession, folder: str) -> DataFrame:
    return transferred_mb(network_log(spark, folder))


QUERIES = {
    "q_url_blocklist_table": url_blocklist_table,
    "q_url_normalise": url_normalise,
    "q_url_blocklist": url_blocklist,
    "q_url_blocklist_default": url_blocklist_default,
    "q_url_blocklist_part": url_blocklist_part,
    "q_transfer_mb": transfer_mb,
}

_URLS = r"""urls AS (
  SELECT page_id, CASE WHEN page_id % 2 = 0
    THEN regexp_replace(url, '^(\w+://[^/?#]*)[^?#]*', '\1') ELSE url END AS url FROM pages)"""


def _like(pattern: str) -> str:
    text = pattern.replace("!", "!!").replace("%", "!%").replace("_", "!_").replace("*", "%")
    return f"url LIKE '{text}' ESCAPE '!'"


_DEFAULT_PART = " OR ".join(_like(f"*{pattern}*") for pattern in DEFAULT_BLOCKED_URLS)
_DEFAULT = " OR ".join(_like(pattern) for pattern in DEFAULT_BLOCKED_URLS)

_PATTERNS = r"""parts AS (
  SELECT page_id AS n, regexp_extract(url, '^https?://([^./]*)', 1) AS site,
    regexp_extract(url, '([^/]*)$', 1) AS path FROM pages),
patterns AS (
  SELECT CASE WHEN n % 5 = 0 THEN concat('http*://', site, '.*/en/*') WHEN n % 5 = 1 THEN concat('*/', path)
    WHEN n % 5 = 2 THEN concat('x_%y*', site) WHEN n % 25 = 3 THEN concat(CAST(n % 1000 AS varchar), '?')
    WHEN n % 5 = 4 THEN concat(site, '*', path, '*') END AS pattern FROM parts),
likes AS (
  SELECT DISTINCT concat('%', replace(replace(replace(replace(pattern, '\', '\\'), '%', '\%'), '_', '\_'), '*', '%'), '%') AS p
  FROM patterns WHERE pattern NOT IN ('*/', '*'))"""

SQL = {
    "q_url_blocklist_table": with_sql(
        _PATTERNS,
        select="SELECT page_id, url, EXISTS (SELECT 1 FROM likes WHERE url LIKE p ESCAPE '\\') AS blocked FROM pages",
    ),
    "q_url_normalise": with_sql(
        _URLS,
        select=r"SELECT page_id, regexp_replace(url, '^(\w+://[^/?#]*)([?#].*)?$', '\1/\2') AS url "
        "FROM urls",
    ),
    "q_url_blocklist": "SELECT page_id, url FROM pages WHERE NOT ("
    + " OR ".join(_like(pattern) for pattern in _BLOCKED)
    + ")",
    "q_url_blocklist_default": with_sql(
        f"""found AS (SELECT page_id, concat(regexp_replace(url, '[?#].*$', ''),
          [{', '.join(repr(end) for end in _ENDS)}][page_id % {len(_ENDS)} + 1]) AS url
          FROM pages)""",
        select=f"SELECT page_id, url, {_DEFAULT} AS blocked FROM found",
    ),
    "q_url_blocklist_part": with_sql(
        f"""found AS (SELECT page_id, concat(
          [{', '.join(repr(via) for via in _VIA)}][page_id % {len(_VIA)} + 1], url) AS url
          FROM pages)""",
        select=f"SELECT page_id, url, {_DEFAULT_PART} AS blocked FROM found",
    ),
    "q_transfer_mb": """
        SELECT coalesce(sum(CAST(json_extract_string(props, '$.k') AS double)), 0.0)
          / 1024 / 1024 AS total_mb
        FROM events WHERE event_type = 'click'""",
}
