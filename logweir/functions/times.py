"""Log times. Everything stays `timestamp_ntz`: the session zone plays no part."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_datetime(date: Column, time: Column) -> Column:
    """`date` + `time` -> timestamp without zone; null if either part is null.

    Text in another form than `2024-03-20 01:02:03` is an error, whatever
    `spark.sql.ansi.enabled` says.
    """
    text = F.concat(date, F.lit(" "), time)
    # A cast takes half the time of a pattern, but also takes other forms. Text
    # of this outline is read the same way by both; the rest is left to the
    # pattern.
    outline = (
        (F.length(date) == 10)
        & (F.length(time) == 8)
        & (F.substring(date, 5, 1) == "-")
        & (F.substring(date, 8, 1) == "-")
        & (F.substring(time, 3, 1) == ":")
        & (F.substring(time, 6, 1) == ":")
        & F.substring(time, 8, 1).between("0", "9")
    )
    exact = F.to_timestamp_ntz(text, F.lit("yyyy-MM-dd HH:mm:ss"))
    parsed = F.when(outline, text.cast("timestamp_ntz")).otherwise(exact)
    message = F.concat(F.lit("not a date and time: "), text)
    wrong = F.when(text.isNotNull(), F.raise_error(message).cast("timestamp_ntz"))
    return F.coalesce(parsed, wrong)


def bucket_start(moment: Column, bucket: str = "minute") -> Column:
    """Start of the minute, hour or day that ``moment`` lies in.

    `date_trunc` would turn a zone-less timestamp into a zoned one, and then a
    session zone with daylight saving could merge two buckets. Taking off the
    seconds as an interval has no such step.
    """
    zero = F.lit(0)
    seconds = F.extract(F.lit("SECOND"), moment)
    if bucket == "minute":
        return moment - F.make_dt_interval(zero, zero, zero, seconds)
    if bucket == "hour":
        return moment - F.make_dt_interval(zero, zero, F.minute(moment), seconds)
    if bucket == "day":
        return F.to_date(moment).cast("timestamp_ntz")
    raise ValueError(f"bucket must be minute, hour or day, not {bucket!r}")
