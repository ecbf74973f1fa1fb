"""Answers of a location service -> columns of the location table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.schemas import LOCATION_PAYLOAD

# Fixed value: the text the location service uses for a missing field.
NOT_FOUND = "Not found"

_CORRUPT = "_corrupt"
_PARSED = T.StructType([*LOCATION_PAYLOAD.fields, T.StructField(_CORRUPT, T.StringType())])


def not_found_to_null(field: Column) -> Column:
    return F.nullif(field, F.lit(NOT_FOUND))


def zone_offset(zone: Column, at: Column) -> Column:
    """Offset of a named zone from UTC at an instant, as `+HH:MM`."""
    seconds = F.unix_timestamp(F.from_utc_timestamp(at, zone)) - F.unix_timestamp(at)
    size = F.abs(seconds)
    hours = F.floor(size / 3600).cast("int")
    minutes = F.floor(size % 3600 / 60).cast("int")
    sign = F.when(seconds < 0, F.lit("-")).otherwise(F.lit("+"))
    return F.when(
        seconds.isNotNull(), F.concat(sign, F.format_string("%02d:%02d", hours, minutes))
    )


def location_from_payload(payload: Column, at: Column | None = None) -> Column:
    """JSON text -> struct of location columns (all but the address columns).

    A null payload (nothing found) gives a struct of nulls; text that is not
    JSON gives a null struct, so that the caller can tell the two apart.
    ``at`` is the instant of the zone offset, the current time by default.
    """
    parsed = F.from_json(payload, _PARSED, {"columnNameOfCorruptRecord": _CORRUPT})

    def field(name: str) -> Column:
        return not_found_to_null(parsed[name])

    latitude = field("latitude").try_cast("double")
    longitude = field("longitude").try_cast("double")
    moment = F.current_timestamp() if at is None else at
    offset = F.when(
        latitude.isNotNull() & longitude.isNotNull(), zone_offset(field("zone"), moment)
    )
    location = F.struct(
        field("country_code").alias("country_code"),
        field("country_name").alias("country_name"),
        field("state").alias("region_name"),
        field("city").alias("city_name"),
        latitude.alias("latitude"),
        longitude.alias("longitude"),
        field("postal").alias("zip_code"),
        offset.alias("timezone"),
    )
    return F.when(parsed[_CORRUPT].isNull(), location)
