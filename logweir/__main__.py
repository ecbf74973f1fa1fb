"""Command line: `python -m logweir --root R --start-date D`, or `process_logs.py`."""

from __future__ import annotations

import argparse
import datetime as dt
import importlib
import logging

from pyspark.sql import SparkSession

from logweir.operators.countries import NOT_FOUND, read_rules
from logweir.operators.resolving import Resolver, calling, from_table
from logweir.plans.daily import run


def _resolver(spark: SparkSession, answers: str | None, function: str | None) -> Resolver | None:
    if answers:
        return from_table(spark.read.parquet(answers))
    if function:
        module, _, name = function.partition(":")
        return calling(getattr(importlib.import_module(module), name))
    return None


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="logweir", description="Process days of access logs.")
    parser.add_argument("--root", required=True, help="folder with downloads/ and all tables")
    parser.add_argument("--start-date", type=dt.date.fromisoformat, help="default: latest")
    parser.add_argument("--end-date", type=dt.date.fromisoformat, help="default: the start date")
    parser.add_argument("--force", action="store_true", help="process days again that are done")
    parser.add_argument("--rules", help="CSV of country rules: priority,pattern,standard_name")
    parser.add_argument("--match", choices=("exact", "range"), default="exact")
    parser.add_argument("--answers", help="Parquet table of lookup answers: cleaned_ip_int, payload")
    parser.add_argument("--resolver", help="module:function that answers lookups for one address")
    parser.add_argument("--strict", action="store_true", help="octets over 255 are an error")
    parser.add_argument("--bucket", choices=("minute", "hour", "day"), default="minute")
    parser.add_argument("--unmatched", choices=(NOT_FOUND, "keep"), default=NOT_FOUND)
    parser.add_argument("--retry", action="store_true", help="try names again that no rule fitted")
    parser.add_argument("--days-per-job", type=int, help="default: all days in one job")
    options = parser.parse_args(arguments)

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = (
        SparkSession.builder.appName("logweir")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    run(
        spark,
        options.root,
        options.start_date,
        options.end_date,
        options.force,
        rules=read_rules(options.rules, spark) if options.rules else (),
        resolver=_resolver(spark, options.answers, options.resolver),
        strict=options.strict,
        bucket=options.bucket,
        unmatched=options.unmatched,
        retry=options.retry,
        match=options.match,
        days_per_job=options.days_per_job,
    )


if __name__ == "__main__":
    main()
