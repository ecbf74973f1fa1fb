"""Links to log files, days to do, names of files and pages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.functions import date_from_link, file_name, index_page, swap_suffix
from logweir.operators.catalogue import day_range, latest_link, link_catalogue, page_links, pending_days
from logweir.suite.views import table, with_sql

_PAGE = "https://host.example/files/logs%d.html"
_FIRST, _LAST = dt.date(2000, 1, 1), dt.date(2001, 12, 31)


def links(spark: SparkSession, folder: str) -> DataFrame:
    """A link for every order; some are no archives, some have no address."""
    key = F.col("o_orderkey")
    suffix = F.when(key % 10 == 0, F.lit(".txt")).otherwise(F.lit(".zip"))
    link = F.concat(
        F.lit("https://host.example/files/log"), F.date_format("o_orderdate", "yyyyMMdd"), suffix
    )
    return table(spark, folder, "orders").select(
        F.when(F.col("o_orderstatus") != "P", link).alias("link"), key.alias("pos")
    )


def link_dates(spark: SparkSession, folder: str) -> DataFrame:
    return links(spark, folder).select("pos", date_from_link(F.col("link")).alias("log_date"))


def catalogue(spark: SparkSession, folder: str) -> DataFrame:
    return link_catalogue(links(spark, folder))


def latest(spark: SparkSession, folder: str) -> DataFrame:
    return latest_link(catalogue(spark, folder))


def dates_pending(spark: SparkSession, folder: str) -> DataFrame:
    """Days of two years, beyond the last order, without an order of a large sum."""
    large = table(spark, folder, "orders").where(F.col("o_totalprice") > 250000)
    present = large.select(F.to_date("o_orderdate").alias("log_date"))
    return pending_days(day_range(spark, _FIRST, _LAST), present)


def day_files(spark: SparkSession, folder: str) -> DataFrame:
    """File names of all stages for each day with an order."""
    day = F.to_date("o_orderdate").alias("log_date")
    days = table(spark, folder, "orders").select(day).distinct()
    name = file_name(F.col("log_date"))
    return days.select(
        "log_date",
        name.alias("zip_name"),
        swap_suffix(name, ".zip", ".csv").alias("csv_name"),
        swap_suffix(name, ".zip", ".parquet").alias("parquet_name"),
    )


def year_page(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey", index_page(F.to_date("o_orderdate"), _PAGE).alias("page")
    )


# Forms of an anchor, by page, in place of `<a href="/` (what SQL says of them is below).
_FORMS = (
    '<a href="/',
    "<A class='k>' HREF = \"./",
    '<a href="//other.example/',
    '<a title="a > b" href="?q=1&amp;r=',
    '<a data-href="no" href="sub/../',
    '<!-- <a href="no"> --><a href="&#47;&#x64;/',
)
_BASE = '<head><base href="/base/dir/">'


def links_of_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Links in the source of pages, written in several ways; a quarter has a base address."""
    form = F.element_at(F.array(*map(F.lit, _FORMS)), (F.col("page_id") % len(_FORMS) + 1).cast("int"))
    html = F.replace("html", F.lit('<a href="/'), form)
    based = F.when(F.col("page_id") % 4 == 3, F.replace(html, F.lit("<head>"), F.lit(_BASE))).otherwise(html)
    return page_links(table(spark, folder, "pages").select("page_id", "url", based.alias("html")), "page_id")


QUERIES = {
    "q_page_links": links_of_pages,
    "q_link_dates": link_dates,
    "q_link_catalogue": catalogue,
    "q_link_latest": latest,
    "q_dates_pending": dates_pending,
    "q_day_files": day_files,
    "q_year_page": year_page,
}

_LINKS = """links AS (
  SELECT CASE WHEN o_orderstatus <> 'P' THEN concat('https://host.example/files/log',
      strftime(o_orderdate, '%Y%m%d'),
      CASE WHEN o_orderkey % 10 = 0 THEN '.txt' ELSE '.zip' END) END AS link,
    o_orderkey AS pos FROM orders)"""

_DATE = r"CAST(strptime(regexp_extract(link, '/log(\d{8})\.', 1), '%Y%m%d') AS date)"

_CATALOGUE = f"""catalogue AS (
  SELECT {_DATE} AS log_date, arg_max(link, pos) AS link FROM links
  WHERE link LIKE '%.zip' GROUP BY 1)"""

_PARTS = r"""sites AS (
  SELECT page_id, html, regexp_extract(url, '^https?:') AS scheme, regexp_extract(url, '^https?://[^/?#]*') AS site,
    CASE WHEN page_id % 4 = 3 THEN '/base/dir/'
         ELSE regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) END AS path FROM pages),
anchors AS (
  SELECT page_id, scheme, site, path, CASE WHEN path = '' THEN '/' ELSE regexp_extract(path, '^.*/') END AS dir,
    regexp_extract_all(html, '<a href="/([^"]*)"', 1) AS words FROM sites),
each AS (
  SELECT page_id, scheme, site, path, dir, unnest(range(0, len(words))) AS pos,
    replace(unnest(words), '&amp;', '&') AS w FROM anchors)"""

SQL = {
    "q_page_links": with_sql(
        _PARTS,
        select="""SELECT page_id, pos, CASE page_id % 6
          WHEN 0 THEN concat(site, '/', w)
          WHEN 2 THEN concat(scheme, '//other.example/', w)
          WHEN 3 THEN concat(site, path, '?q=1&r=', w)
          WHEN 5 THEN concat(site, '/d/', w)
          ELSE concat(site, dir, w) END AS link FROM each""",
    ),
    "q_link_dates": with_sql(_LINKS, select=f"SELECT pos, {_DATE} AS log_date FROM links"),
    "q_link_catalogue": with_sql(_LINKS, _CATALOGUE, select="SELECT * FROM catalogue"),
    "q_link_latest": with_sql(
        _LINKS,
        _CATALOGUE,
        select="SELECT max(log_date) AS log_date, arg_max(link, log_date) AS link FROM catalogue",
    ),
    "q_dates_pending": f"""
        SELECT CAST(d AS date) AS log_date
        FROM generate_series(timestamp '{_FIRST}', timestamp '{_LAST}', interval 1 day) AS t(d)
        WHERE CAST(d AS date) NOT IN
          (SELECT CAST(o_orderdate AS date) FROM orders WHERE o_totalprice > 250000)""",
    "q_day_files": with_sql(
        "days AS (SELECT DISTINCT CAST(o_orderdate AS date) AS log_date FROM orders)",
        "named AS (SELECT log_date, concat('log', strftime(log_date, '%Y%m%d')) AS stem FROM days)",
        select="SELECT log_date, concat(stem, '.zip') AS zip_name, "
        "concat(stem, '.csv') AS csv_name, concat(stem, '.parquet') AS parquet_name FROM named",
    ),
    "q_year_page": "SELECT o_orderkey, concat('https://host.example/files/logs', "
    "CAST(year(o_orderdate) AS varchar), '.html') AS page FROM orders",
}
