"""The whole way from log files to the output table, day by day or years at once."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from logweir.operators.catalogue import day_range, latest_link, link_catalogue, pending_days
from logweir.operators.columns import conform, union_of
from logweir.operators.countries import NOT_FOUND, CountryRule
from logweir.operators.resolving import Resolver
from logweir.operators.rules import P, R, V
from logweir.plans.clean import clean_log
from logweir.plans.enrich import enrich_ip
from logweir.plans.standardise import standardise_country
from logweir.schemas import COUNTRY_MAPPING, LOCATIONS, RAW_LOG
from logweir.sources.learned import append_answers, compact, read_learned
from logweir.sources.logs import raw_files, read_csv_logs, read_zip_logs
from logweir.sources.tables import (
    COMPRESSION,
    DAY_SCHEMA,
    STAGE_COMPRESSION,
    read_days,
    read_latest,
    read_table,
    version_numbers,
    whole_days,
    write_days,
    write_next,
)

_logger = logging.getLogger(__name__)

# Kinds of log files, in the order they are preferred for a day.
_SUFFIXES = (".csv", ".csv.gz", ".zip")

# Columns of the stage tables, for the case that no day has any rows.
_CONVERTED = T.StructType([*RAW_LOG.fields, *DAY_SCHEMA.fields])
_CLEAN = T.StructType(
    [
        *RAW_LOG.fields,
        T.StructField("datetime", T.TimestampNTZType()),
        T.StructField("cleaned_ip", T.StringType()),
        T.StructField("cleaned_ip_int", T.LongType()),
        *DAY_SCHEMA.fields,
    ]
)
_ENRICHED = T.StructType([*_CLEAN.fields, *LOCATIONS.fields[1:]])


@dataclass(frozen=True)
class Layout:
    """Where everything lies below one root folder."""

    root: str

    def _below(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def downloads(self) -> str:
        """Log files, `logYYYYMMDD.zip`, `.csv` or `.csv.gz`."""
        return self._below("downloads")

    @property
    def converted(self) -> str:
        return self._below("converted")

    @property
    def no_bots(self) -> str:
        return self._below("no_bots")

    @property
    def ip_enriched(self) -> str:
        return self._below("ip_enriched")

    @property
    def output(self) -> str:
        return self._below("output")

    @property
    def ip_ranges(self) -> str:
        """Parquet table of IP ranges, the start of the location table."""
        return self._below("ip_ranges")

    @property
    def locations(self) -> str:
        """What lookups have found, on top of the ranges."""
        return self._below("locations")

    @property
    def journal(self) -> str:
        """Answers of lookups that are not in a table yet."""
        return self._below("lookups")

    @property
    def country_mapping(self) -> str:
        return self._below("country_mapping")


def _pending(spark: SparkSession, path: str, days: list[dt.date], force: bool) -> list[dt.date]:
    wanted = spark.createDataFrame([(day,) for day in days], DAY_SCHEMA)
    rows = pending_days(wanted, whole_days(spark, path, days), force).collect()
    return sorted(row["log_date"] for row in rows)


def _slices(days: list[dt.date], size: int | None) -> list[list[dt.date]]:
    step = size or max(len(days), 1)
    return [days[i : i + step] for i in range(0, len(days), step)]


def _files_by_suffix(
    spark: SparkSession, folder: str, days: list[dt.date]
) -> dict[str, dict[dt.date, str]]:
    """For each kind of file the days to read from it; every day once."""
    files = raw_files(spark, folder)
    open_days = spark.createDataFrame([(day,) for day in days], DAY_SCHEMA)
    chosen: dict[str, dict[dt.date, str]] = {}
    left = set(days)
    for suffix in _SUFFIXES:
        rows = link_catalogue(files, suffix).join(open_days, "log_date", "left_semi").collect()
        links = {row["log_date"]: row["link"] for row in rows if row["log_date"] in left}
        left -= set(links)
        if links:
            chosen[suffix] = links
    if left:
        raise ValueError(f"no log file for {', '.join(str(day) for day in sorted(left))}")
    return chosen


def _raw_logs(
    spark: SparkSession,
    folder: str,
    days: list[dt.date],
    types: Mapping[str, T.DataType] | None,
) -> DataFrame:
    chosen = _files_by_suffix(spark, folder, days)
    parts = []
    for suffix, links in chosen.items():
        paths = [links[day] for day in sorted(links)]
        read = read_zip_logs if suffix == ".zip" else read_csv_logs
        parts.append(read(spark, paths, types=types))
    return union_of(parts)


def _latest_day(spark: SparkSession, folder: str) -> dt.date:
    files = raw_files(spark, folder)
    found = [latest_link(link_catalogue(files, suffix)).first()["log_date"] for suffix in _SUFFIXES]
    known = [day for day in found if day is not None]
    if not known:
        raise ValueError(f"no log files in {folder}")
    return max(known)


def _ranges(spark: SparkSession, layout: Layout) -> DataFrame:
    """The IP ranges: the latest load, or a plain table that was put there."""
    if version_numbers(spark, layout.ip_ranges):
        return read_latest(spark, layout.ip_ranges)
    return read_table(spark, layout.ip_ranges, LOCATIONS)


def location_table_of(spark: SparkSession, layout: Layout) -> DataFrame:
    """The IP ranges under everything that lookups have found."""
    return read_learned(spark, layout.locations, _ranges(spark, layout))


def run(
    spark: SparkSession,
    root: str,
    start: dt.date | None = None,
    end: dt.date | None = None,
    force: bool = False,
    rules: Iterable[CountryRule] = (),
    resolver: Resolver | None = None,
    match: str = "exact",
    r: int = R,
    p: int = P,
    v: int = V,
    unmatched: str = NOT_FOUND,
    types: Mapping[str, T.DataType] | None = None,
    at: Column | None = None,
    compression: str = COMPRESSION,
    stage_compression: str = STAGE_COMPRESSION,
    days_per_job: int | None = None,
    bucket: str = "minute",
    strict: bool = False,
    retry: bool = False,
    report: Callable[[str, dict[str, int]], None] | None = None,
) -> DataFrame:
    """Process the days from ``start`` to ``end`` and return their output rows.

    ``end`` defaults to ``start``, ``start`` to the latest day with a file.
    Every stage skips days it already has, unless ``force`` is set; the country
    stage always runs, so that an edit of the mapping takes effect. A stage
    works on all its days at once, or on ``days_per_job`` at a time: a run that
    breaks off then goes on where it was, and the tables that are broadcast
    stay small. ``bucket`` and ``strict`` go to :func:`clean_log`, ``retry`` to
    :func:`standardise_country`. ``report`` is called with the name of each stage and its counts
    after every job.
    """
    layout = Layout(root)
    if start is None:
        start = _latest_day(spark, layout.downloads)
    days = [row["log_date"] for row in day_range(spark, start, end).collect()]

    def store(stage: str, path: str, df: DataFrame, on: list[dt.date]) -> None:
        codec = compression if stage == "output" else stage_compression
        counts = write_days(df, path, on, codec)
        _logger.info("%s: %s", stage, counts)
        if report:
            report(stage, counts)

    def pending(path: str) -> list[list[dt.date]]:
        return _slices(_pending(spark, path, days, force), days_per_job)

    for part in pending(layout.converted):
        logs = _raw_logs(spark, layout.downloads, part, types)
        store("converted", layout.converted, logs, part)

    for part in pending(layout.no_bots):
        converted = read_days(spark, layout.converted, part, _CONVERTED)
        store("no_bots", layout.no_bots, clean_log(converted, r, p, v, bucket, strict), part)

    for part in pending(layout.ip_enriched):
        enriched, _ = enrich_ip(
            read_days(spark, layout.no_bots, part, _CLEAN),
            location_table_of(spark, layout),
            resolver,
            match,
            at,
            save=lambda answers: append_answers(answers, layout.locations),
            journal=layout.journal,
        )
        store("ip_enriched", layout.ip_enriched, enriched, part)
        compact(spark, layout.locations, _ranges(spark, layout))

    for part in _slices(days, days_per_job):
        mapping = read_latest(spark, layout.country_mapping, COUNTRY_MAPPING)
        output, _ = standardise_country(
            read_days(spark, layout.ip_enriched, part, _ENRICHED),
            conform(mapping, COUNTRY_MAPPING),
            rules,
            unmatched=unmatched,
            retry=retry,
            save=lambda table: write_next(table, layout.country_mapping),
        )
        store("output", layout.output, output, part)
    return read_days(spark, layout.output, days, _ENRICHED)
