"""Commit log of a stage table: which days are done, and which files are theirs.

A stage writes the files of its days first and a record after them, in the
folder `_commits` of the table. A day is what the latest record that names it
says: its files, with their sizes, and its number of rows. Files that no record
names do not count: they are what a run left that broke off, and the next run of
their day removes them. A record is written under another name and then renamed,
so there is no half of one.

A record is a text file with a JSON line for each day. Every ``_SUMMARY`` records
one holds all days, and readers start from there.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession

from logweir.sources.folders import names_in, read_text, write_text

FOLDER = "_commits"
_SUMMARY = 32


@dataclass(frozen=True)
class Commit:
    """One day of a table: number of rows, and its files with their sizes in bytes."""

    rows: int
    files: Mapping[str, int]


def _records(spark: SparkSession, path: str) -> list[tuple[int, str, bool]]:
    """(number, name, is a summary) of the records, in their order."""
    out = []
    for name in names_in(spark, f"{path}/{FOLDER}"):
        number, _, kind = name.partition(".")
        if number.isdigit() and kind in ("json", "all.json"):
            out.append((int(number), name, kind == "all.json"))
    return sorted(out)


def committed(spark: SparkSession, path: str) -> dict[dt.date, Commit]:
    """The days of a table that are done, by its log, which is read in the driver: a line for each day."""
    records = _records(spark, path)
    start = max((i for i, r in enumerate(records) if r[2]), default=0)
    out: dict[dt.date, Commit] = {}
    for _, name, _ in records[start:]:
        for line in read_text(spark, f"{path}/{FOLDER}/{name}").splitlines():
            entry = json.loads(line)
            out[dt.date.fromisoformat(entry["day"])] = Commit(entry["rows"], entry["files"])
    return out


def commit(spark: SparkSession, path: str, days: Mapping[dt.date, Commit]) -> None:
    """Add a record. A reader sees all of its days or none."""
    records = _records(spark, path)
    number = records[-1][0] + 1 if records else 1
    last = max((i for i, r in enumerate(records) if r[2]), default=-1)
    summary = len(records) - last > _SUMMARY
    if summary:
        days = {**committed(spark, path), **days}
    lines = [
        json.dumps({"day": day.isoformat(), "rows": c.rows, "files": dict(c.files)})
        for day, c in sorted(days.items())
    ]
    name = f"{number:012d}.all.json" if summary else f"{number:012d}.json"
    folder = f"{path}/{FOLDER}"
    write_text(spark, f"{folder}/{name}", "\n".join(lines) + "\n", f"{folder}/_{uuid.uuid4().hex}")


def wanted_files(days: Mapping[dt.date, Commit], wanted: Iterable[dt.date], folder: str) -> list[str]:
    """Paths of the files of some days; ``folder`` has one `%s`, for the day."""
    return [folder % day.isoformat() + "/" + name for day in wanted if day in days for name in sorted(days[day].files)]
