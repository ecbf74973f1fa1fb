"""Names of log files and of the pages that list them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_from_link(link: Column) -> Column:
    """`.../log20240320.zip` -> 2024-03-20; null when the name holds no date.

    The date is what is left of the file name without `log` and from the first
    dot on, with or without dashes.
    """
    name = F.replace(F.substring_index(link, "/", -1), F.lit("log"), F.lit(""))
    stem = F.substring_index(name, ".", 1)
    dated = stem.rlike(r"^(?:\d{8}|\d{4}-\d{2}-\d{2})\z")
    return F.when(dated, F.try_to_date(F.replace(stem, F.lit("-"), F.lit("")), "yyyyMMdd"))


def file_name(day: Column, suffix: str = ".zip") -> Column:
    """2024-03-20 -> `log20240320.zip`."""
    return F.concat(F.lit("log"), F.date_format(day, "yyyyMMdd"), F.lit(suffix))


def swap_suffix(name: Column, old: str, new: str) -> Column:
    """Name of the file of another stage: every ``old`` becomes ``new``."""
    return F.replace(name, F.lit(old), F.lit(new))


def year_of(day: Column) -> Column:
    """Year of a day, the current year when the day is null."""
    return F.year(F.coalesce(day, F.current_date()))


def index_page(day: Column, template: str) -> Column:
    """Address of the index page of a year; ``template`` has one `%d`."""
    return F.format_string(template, year_of(day))
