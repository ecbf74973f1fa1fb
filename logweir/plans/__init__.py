"""Whole jobs, made of the operators."""

from logweir.plans.clean import clean_log
from logweir.plans.daily import Layout, run
from logweir.plans.enrich import attach_locations, enrich_ip, learn_locations
from logweir.plans.ranges import load_ip_ranges
from logweir.plans.standardise import standardise_country

__all__ = [
    "Layout",
    "attach_locations",
    "clean_log",
    "enrich_ip",
    "learn_locations",
    "load_ip_ranges",
    "run",
    "standardise_country",
]
