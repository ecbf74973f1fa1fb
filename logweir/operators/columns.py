"""Small schema steps."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def add_missing_column(
    df: DataFrame, name: str, value: Any, kind: T.DataType | None = None
) -> DataFrame:
    """Add a constant column unless the table has one of that name."""
    if name in df.columns:
        return df
    constant = F.lit(value)
    return df.withColumn(name, constant if kind is None else constant.cast(kind))


def require_columns(df: DataFrame, names: Iterable[str], what: str = "table") -> DataFrame:
    """The table itself, or `ValueError` when a column is missing."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"{what} is missing required columns {missing}")
    return df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in its order and types; absent ones are null."""
    present = set(df.columns)
    return df.select(
        *(
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        )
    )


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns; a name the table lacks is passed over."""
    return df.drop(*names)


def merged_schema(schemas: Iterable[T.StructType]) -> T.StructType:
    """Columns of all schemas, each where it comes first.

    A column of two types is an error, and so are names that differ in case
    only: later steps could not tell them apart.
    """
    fields: dict[str, T.StructField] = {}
    for schema in schemas:
        for field in schema:
            known = fields.setdefault(field.name.lower(), field)
            if known.name != field.name:
                raise ValueError(f"columns {known.name} and {field.name} differ in case only")
            if known.dataType != field.dataType:
                kinds = f"{known.dataType.simpleString()} and {field.dataType.simpleString()}"
                raise ValueError(f"column {field.name} has two types: {kinds}")
    return T.StructType(list(fields.values()))


def union_of(frames: Iterable[DataFrame]) -> DataFrame:
    """Rows of all tables by column name, null where a table lacks a column."""
    frames = list(frames)
    merged_schema(frame.schema for frame in frames)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
