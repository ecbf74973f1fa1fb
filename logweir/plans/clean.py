"""Raw log -> requests of people, with clean addresses."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.operators.addresses import with_clean_ip
from logweir.operators.lookup import BROADCAST_BYTES
from logweir.operators.rules import (
    DAY,
    P,
    R,
    V,
    drop_bots,
    find_bots,
    rule_base,
    successful_requests,
    with_datetime,
)
from logweir.sources.workspace import measured

_ANY_DAY = dt.date(1970, 1, 1)


def clean_log(
    log: DataFrame,
    r: int = R,
    p: int = P,
    v: int = V,
    bucket: str = "minute",
    strict: bool = False,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Keep successful requests, drop automated traffic, clean the addresses.

    The rules apply within each `log_date`; a log without that column counts
    as one day. The bots are written first (a job), since whether the log has
    to be shuffled to lose them depends on how many there are.
    """
    whole = DAY not in log.columns
    if whole:
        log = log.withColumn(DAY, F.lit(_ANY_DAY))
    requests = successful_requests(log)
    bots = measured(find_bots(rule_base(requests, bucket), r, p, v), "bots")
    people = drop_bots(requests, bots.table, limit, bots.bytes)
    kept = with_clean_ip(with_datetime(people), strict)
    return kept.drop(DAY) if whole else kept
