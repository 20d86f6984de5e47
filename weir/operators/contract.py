"""The data contract of a message: its fields, its rules and the shapes of its outputs."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from weir.functions.rules import Rule

# Fixed value: the envelope columns of a consumed message.
ENVELOPE = ("_kafka_key", "_kafka_partition", "_kafka_offset")
ENVELOPE_TYPES = (StringType(), IntegerType(), LongType())

ERROR_TEXT = "validation_errors"


class SchemaError(ValueError):
    """A column that a plan needs is not there."""


@dataclass(frozen=True)
class Contract:
    """What a valid message of one domain looks like.

    ``rules`` run only on rows that have all required fields. ``references`` names, for each
    foreign-key field, the reference table it points to. ``stored`` lists the columns of the
    accepted table when they differ from the consumed columns.
    """

    name: str
    key: str
    required: tuple[str, ...]
    optional: tuple[str, ...]
    derived: tuple[str, ...]
    rules: tuple[Rule, ...] = ()
    references: dict[str, str] = field(default_factory=dict)
    stored: tuple[str, ...] = ()

    @property
    def fields(self) -> tuple[str, ...]:
        return self.required + self.optional

    @property
    def consumed_fields(self) -> tuple[str, ...]:
        return self.required + self.derived + ENVELOPE

    @property
    def accepted_fields(self) -> tuple[str, ...]:
        return self.stored or self.consumed_fields

    @property
    def rejected_fields(self) -> tuple[str, ...]:
        return (*self.required, ERROR_TEXT, *ENVELOPE)

    @property
    def schema(self) -> StructType:
        """All message fields as text: messages are typed only after they are checked."""
        return StructType([StructField(name, StringType()) for name in self.fields])

    @property
    def envelope_schema(self) -> StructType:
        pairs = zip(ENVELOPE, ENVELOPE_TYPES)
        return StructType([*self.schema.fields, *(StructField(name, kind) for name, kind in pairs)])


def require_fields(df: DataFrame, names: Iterable[str], label: str = "input") -> DataFrame:
    """Return ``df`` unchanged, or fail before any plan is built if a column is absent."""
    absent = [name for name in names if name not in df.columns]
    if absent:
        raise SchemaError(f"{label} lacks {', '.join(absent)}; available fields: {', '.join(df.columns)}")
    return df
