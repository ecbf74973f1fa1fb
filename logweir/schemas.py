"""Schemas of every table the package reads or writes.

Nothing is inferred: a wrong value in a log file fails the load instead of
quietly turning a column into text.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import types as T

# Columns the cleaning rules use. `code`, `idx`, `crawler` and `cik` are
# doubles because log files print them as `200.0`.
_LOG_TYPES: dict[str, T.DataType] = {
    "ip": T.StringType(),
    "date": T.StringType(),
    "time": T.StringType(),
    "cik": T.DoubleType(),
    "accession": T.StringType(),
    "code": T.DoubleType(),
    "idx": T.DoubleType(),
    "crawler": T.DoubleType(),
}

RAW_LOG = T.StructType([T.StructField(name, kind) for name, kind in _LOG_TYPES.items()])

IP_RANGES = T.StructType(
    [
        T.StructField("ip_from", T.LongType()),
        T.StructField("ip_to", T.LongType()),
        T.StructField("country_code", T.StringType()),
        T.StructField("country_name", T.StringType()),
        T.StructField("region_name", T.StringType()),
        T.StructField("city_name", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("zip_code", T.StringType()),
        T.StructField("timezone", T.StringType()),
    ]
)

ATTEMPTED = "geolocation_db_attempted"

LOCATIONS = T.StructType([*IP_RANGES.fields, T.StructField(ATTEMPTED, T.BooleanType())])

COUNTRY_MAPPING = T.StructType(
    [
        T.StructField("raw_country_name", T.StringType()),
        T.StructField("cleaned_country_name", T.StringType()),
    ]
)

# All text: numbers and the "Not found" sentinel share the same fields.
# `zone` is ours: the name of the time zone, when the service knows it.
LOCATION_PAYLOAD = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "latitude",
            "longitude",
            "country_code",
            "country_name",
            "state",
            "city",
            "postal",
            "zone",
        )
    ]
)


def log_schema(
    header: Iterable[str], types: Mapping[str, T.DataType] | None = None
) -> T.StructType:
    """Schema of a log file with the given header.

    The columns of :data:`RAW_LOG` keep their types and must all be there;
    any other column passes through as text unless ``types`` says otherwise.
    """
    names = list(header)
    if len(set(names)) < len(names):
        raise ValueError(f"log header names a column twice: {names}")
    missing = [name for name in _LOG_TYPES if name not in names]
    if missing:
        raise ValueError(f"log header lacks the columns {missing}")
    kinds = {**_LOG_TYPES, **(types or {})}
    return T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in names])
