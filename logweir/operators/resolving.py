"""Asking a location service for addresses the table does not know.

A resolver is a function from a DataFrame (`cleaned_ip`, `cleaned_ip_int`) to
a DataFrame (`cleaned_ip_int`, `payload`): the JSON answer, or null when the
service knows nothing. Every row it returns is remembered, found or not; an
address it leaves out counts as not tried and is asked for again next time.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.functions.payload import location_from_payload
from logweir.sources.journal import record, recorded

Resolver = Callable[[DataFrame], DataFrame]

# Defaults of the lookup calls (fixed values).
WORKERS = 16
TRIES = 5
PAUSE_SECONDS = 1.0

# Answers that are written to the journal together.
BATCH = 100

_logger = logging.getLogger(__name__)


class Unavailable(Exception):
    """The service gave no usable answer; try the call again at once."""


def _ask(fetch: Callable[[str], str | None], ip: str, tries: int, pause: float) -> str | None:
    for attempt in range(1, tries + 1):
        try:
            return fetch(ip)
        except Unavailable:
            continue
        except Exception as error:  # noqa: BLE001 - whatever the client raises
            _logger.error("lookup of %s failed: %s", ip, error)
            if attempt < tries:
                time.sleep(pause)
    return None


@dataclass(frozen=True)
class Calling:
    """Resolver that calls ``fetch(ip)`` for each address; see :func:`calling`."""

    fetch: Callable[[str], str | None]
    workers: int
    tries: int
    pause: float
    batch: int
    journal: str | None = None

    def with_journal(self, folder: str) -> Calling:
        """The same, with a journal in a shared folder."""
        return replace(self, journal=folder)

    def __call__(self, missing: DataFrame) -> DataFrame:
        fetch, tries, pause, batch, journal = self.fetch, self.tries, self.pause, self.batch, self.journal

        def asked(frame: pd.DataFrame, known: dict[int, str | None]) -> pd.DataFrame:
            new, answers = [], []
            for ip, number in zip(frame["cleaned_ip"], frame["cleaned_ip_int"], strict=True):
                if number in known:
                    answers.append(known[number])
                else:
                    answers.append(_ask(fetch, ip, tries, pause))
                    new.append((number, answers[-1]))
            if journal and new:
                record(journal, TaskContext.get().partitionId(), new)
            payload = pd.Series(answers, index=frame.index, dtype="object")
            return pd.DataFrame({"cleaned_ip_int": frame["cleaned_ip_int"], "payload": payload})

        def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            known = recorded(journal, TaskContext.get().partitionId()) if journal else {}
            for frame in frames:
                for at in range(0, len(frame), batch):
                    yield asked(frame.iloc[at : at + batch], known)

        return missing.repartition(self.workers, "cleaned_ip").mapInPandas(
            batches, "cleaned_ip_int bigint, payload string"
        )


def calling(
    fetch: Callable[[str], str | None],
    workers: int = WORKERS,
    tries: int = TRIES,
    pause: float = PAUSE_SECONDS,
    batch: int = BATCH,
) -> Calling:
    """Resolver that calls ``fetch(ip)`` once for each address.

    ``workers`` tasks call at the same time. A call that raises is repeated,
    after a pause unless it raised :class:`Unavailable`; an address for which
    every try failed is remembered as not found. With a journal, as the daily
    job has one, each ``batch`` of answers is written as soon as it is there,
    and a task that runs again asks for none of them.
    """
    return Calling(fetch, workers, tries, pause, batch)


def from_table(
    answers: DataFrame, ip: str = "cleaned_ip_int", payload: str = "payload"
) -> Resolver:
    """Resolver over a table of answers; an address it lacks is not tried."""

    def resolve(missing: DataFrame) -> DataFrame:
        known = answers.select(F.col(ip).alias("_ip"), F.col(payload).alias("payload"))
        joined = missing.join(known, missing["cleaned_ip_int"] == known["_ip"])
        return joined.select("cleaned_ip_int", "payload")

    return resolve


def point_locations(answers: DataFrame, at: Column | None = None) -> DataFrame:
    """Answers -> rows of the location table, each a range of one address.

    An answer that is no JSON is left out: that lookup failed.
    """
    number = F.col("cleaned_ip_int")
    return (
        answers.where(number.isNotNull())
        .select(
            number.alias("ip_from"),
            number.alias("ip_to"),
            location_from_payload(F.col("payload"), at).alias("place"),
        )
        .where(F.col("place").isNotNull())
        .select("ip_from", "ip_to", "place.*", F.lit(True).alias("geolocation_db_attempted"))
    )
