"""Access-log analytics on Spark: people's requests, located and counted."""

import sys

from pyspark import cloudpickle

from logweir.operators.countries import CountryRule, read_rules
from logweir.operators.resolving import Unavailable, calling, from_table
from logweir.plans import (
    Layout,
    attach_locations,
    clean_log,
    enrich_ip,
    learn_locations,
    load_ip_ranges,
    run,
    standardise_country,
)

__all__ = [
    "CountryRule",
    "Layout",
    "Unavailable",
    "attach_locations",
    "calling",
    "clean_log",
    "enrich_ip",
    "from_table",
    "learn_locations",
    "load_ip_ranges",
    "read_rules",
    "run",
    "standardise_country",
]

# Functions that run in tasks travel with the job, so that workers need no copy
# of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
