"""Projections to the output shapes of a contract."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from weir.operators.contract import Contract


def project(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Keep the named fields in order. Absent columns and missing text become ``''``.

    Typed columns, such as money and offsets, keep their type.
    """
    types = {field.name: field.dataType for field in df.schema.fields}

    def output(name: str) -> Column:
        if name not in types:
            return F.lit("").alias(name)
        if isinstance(types[name], StringType):
            return F.coalesce(F.col(name), F.lit("")).alias(name)
        return F.col(name)

    return df.select(*(output(name) for name in names))


def required_only(df: DataFrame, contract: Contract) -> DataFrame:
    """Keep the required fields."""
    return project(df, contract.required)


def accepted_shape(df: DataFrame, contract: Contract) -> DataFrame:
    """Keep the columns of the accepted table."""
    return project(df, contract.accepted_fields)


def rejected_shape(df: DataFrame, contract: Contract) -> DataFrame:
    """Keep the columns of the rejected table."""
    return project(df, contract.rejected_fields)


def consumed_shape(df: DataFrame, contract: Contract, extra: Iterable[str] = ()) -> DataFrame:
    """Keep the columns of the consumed output, with ``extra`` ones at the end."""
    return project(df, [*contract.consumed_fields, *extra])


def extend(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Keep every input column and add, or overwrite, the given ones."""
    return df.withColumns(columns)
