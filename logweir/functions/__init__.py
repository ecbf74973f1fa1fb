"""Column expressions. No function here starts a job or needs Python workers."""

from logweir.functions.addresses import clean_ip, clean_ip_to_long, ipv4_to_long
from logweir.functions.links import date_from_link, file_name, index_page, swap_suffix, year_of
from logweir.functions.payload import location_from_payload, not_found_to_null, zone_offset
from logweir.functions.times import bucket_start, parse_datetime
from logweir.functions.urls import DEFAULT_BLOCKED_URLS, is_blocked, normalize_url

__all__ = [
    "DEFAULT_BLOCKED_URLS",
    "bucket_start",
    "clean_ip",
    "clean_ip_to_long",
    "date_from_link",
    "file_name",
    "index_page",
    "ipv4_to_long",
    "is_blocked",
    "location_from_payload",
    "normalize_url",
    "not_found_to_null",
    "parse_datetime",
    "swap_suffix",
    "year_of",
    "zone_offset",
]
