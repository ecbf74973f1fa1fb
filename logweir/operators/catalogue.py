"""Which log files there are and which days are still to do."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.functions.anchors import absolute, base_href, hrefs, markup
from logweir.functions.links import date_from_link


def page_links(pages: DataFrame, *keys: str) -> DataFrame:
    """(``keys``, `pos`, `link`) of every anchor in the `html` of pages, with full addresses.

    `pos` counts the anchors of a page from 0. Relative links start from the
    `base` of the page, else from its `url`; comments and scripts hold no links.
    A page without source or links has no row. The result, of one page, is what
    :func:`link_catalogue` takes.
    """
    # Step by step, so that no step is worked out again for each use of it.
    source = pages.select(*keys, "url", markup(F.col("html")).alias("_source"))
    parts = source.select(*keys, "url", hrefs(F.col("_source")).alias("_hrefs"), base_href(F.col("_source")).alias("_own"))
    own = F.when(F.col("_own").isNotNull(), absolute(F.col("_own"), F.col("url"))).otherwise(F.col("url"))
    found = parts.select(*keys, own.alias("_base"), F.posexplode("_hrefs").alias("_pos", "_href"))
    link = absolute(F.col("_href"), F.col("_base"))
    return found.select(*keys, F.col("_pos").cast("long").alias("pos"), link.alias("link"))


def link_catalogue(links: DataFrame, suffix: str = ".zip") -> DataFrame:
    """(`log_date`, `link`) of the links that end in ``suffix``.

    The last link of a day, by `pos`, wins; of equal ones the greater text.
    """
    dated = links.where(F.col("link").endswith(suffix)).withColumn(
        "log_date", date_from_link(F.col("link"))
    )
    return (
        dated.where(F.col("log_date").isNotNull())
        .groupBy("log_date")
        .agg(F.max(F.struct("pos", "link"))["link"].alias("link"))
    )


def latest_link(catalogue: DataFrame) -> DataFrame:
    """One row: the latest day and its link."""
    return catalogue.agg(
        F.max("log_date").alias("log_date"), F.max_by("link", "log_date").alias("link")
    )


def link_of_day(catalogue: DataFrame, day: dt.date) -> str:
    """Link of one day; `ValueError` when the catalogue has none."""
    row = catalogue.where(F.col("log_date") == F.lit(day)).first()
    if row is None:
        raise ValueError(f"no log file for {day}")
    return row["link"]


def day_range(spark: SparkSession, start: dt.date, end: dt.date | None = None) -> DataFrame:
    """Days from ``start`` to ``end``, both included; ``end`` may come first."""
    end = start if end is None else end
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end))).alias("log_date")
    )


def pending_days(wanted: DataFrame, present: DataFrame, force: bool = False) -> DataFrame:
    """Wanted days that are not present; all wanted days with ``force``."""
    return wanted if force else wanted.join(present, "log_date", "left_anti")
