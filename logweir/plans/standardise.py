"""Log with locations -> the same with standard country names."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.operators.columns import require_columns
from logweir.operators.countries import (
    NOT_FOUND,
    CountryRule,
    apply_mapping,
    extended_mapping,
    new_mappings,
    unmapped_names,
)
from logweir.operators.lookup import BROADCAST_BYTES
from logweir.schemas import COUNTRY_MAPPING
from logweir.sources.workspace import measured

Save = Callable[[DataFrame], DataFrame]


def standardise_country(
    df: DataFrame,
    mapping: DataFrame,
    rules: Iterable[CountryRule],
    country_col: str = "country_name",
    unmatched: str = NOT_FOUND,
    save: Save | None = None,
    limit: int = BROADCAST_BYTES,
    retry: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Returns (table with standard names, mapping to use next time).

    Names the mapping holds are never converted again, so a row edited by hand
    stays. New names are converted by the rules and come first in the new
    mapping, which ``save`` writes and reads back. The table is read twice, the
    first time for its country names only.

    Without rules there is nothing to convert by: names the mapping lacks stay,
    and the mapping does not grow. With rules, names that an earlier run could
    not convert (`not found`) are tried again if ``retry`` is set.
    """
    mapping = require_columns(mapping, COUNTRY_MAPPING.names, "country mapping")
    rules = list(rules)
    if not rules:
        return apply_mapping(df, mapping, country_col, limit), mapping
    if retry:
        mapping = mapping.where(~F.col("cleaned_country_name").eqNullSafe(F.lit(NOT_FOUND)))
    new = measured(unmapped_names(df, mapping, country_col), "new-names")
    size = None
    if new.rows:
        table = extended_mapping(mapping, new_mappings(new.table, rules, unmatched))
        if save:
            mapping = save(table)
        else:
            kept = measured(table, "country-mapping")
            mapping, size = kept.table, kept.bytes
    return apply_mapping(df, mapping, country_col, limit, size), mapping
