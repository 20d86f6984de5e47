"""Validation rules.

A rule says when a row fails and what is then reported. Both are Columns, and both are total: any
text, NULL included, is answered without an error under ANSI mode, and ``fails`` is never NULL.

The texts of the shared helper rules are this library's own choice and are kept together here.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from weir.functions import text as T

KNOWN_FLAG = "_known_"


@dataclass(frozen=True)
class Rule:
    """A named check over some fields. Its Columns are built when a plan needs them."""

    name: str
    fields: tuple[str, ...]
    fails: Callable[[], Column]
    message: Callable[[], Column]

    def outcome(self) -> Column:
        """Return the message, or NULL when the row passes."""
        return F.when(self.fails(), self.message())


def _on(name: str, field: str, fails: Callable[[Column], Column], message: Callable[[Column], Column]) -> Rule:
    return Rule(f"{name}_{field}", (field,), lambda: fails(F.col(field)), lambda: message(F.col(field)))


def required(field: str) -> Rule:
    """The field is present and not blank."""
    return _on("required", field, T.is_missing, lambda _: F.lit(f"Missing required field: {field}"))


def known(field: str) -> Rule:
    """The field's value is a key of its reference table (see ``validate``)."""
    return _on(
        "known",
        field,
        lambda _: F.col(KNOWN_FLAG + field).isNull(),
        lambda value: T.complaint(f"Unknown {field}", value),
    )


def allowed(field: str, values: Iterable[str]) -> Rule:
    """The field's value is one of a fixed set; a missing value is not."""
    choices = list(values)
    return _on(
        "allowed",
        field,
        lambda value: ~T.or_empty(value).isin(choices),
        lambda value: T.complaint(f"Invalid {field}", value),
    )


def iso_datetime(field: str) -> Rule:
    """The field is an ISO-8601 moment."""
    return _on(
        "datetime",
        field,
        lambda value: ~T.is_iso_datetime(value),
        lambda value: T.complaint(f"Invalid {field}", value),
    )


def positive_integer(field: str) -> Rule:
    """The field is a whole number of at least 1 that the priced columns can hold."""

    def message(value: Column) -> Column:
        cause = F.when(T.is_positive_whole_number(value), "Quantity must be at most 2147483647: ")
        cause = cause.when(T.is_whole_number(value), "Quantity must be at least 1: ")
        return F.concat(cause.otherwise("Quantity must be an integer: "), T.or_empty(value))

    return _on("positive", field, lambda value: ~T.is_countable(value), message)


def boolean_text(field: str) -> Rule:
    """The field is true or false, in any case."""
    return _on(
        "boolean",
        field,
        lambda value: ~T.is_boolean_text(value),
        lambda value: T.complaint(f"Invalid {field}", value),
    )


def near_listed(field: str, listed: str, parsed: Callable[[Column], Column], share: str) -> Rule:
    """The price in ``field`` differs from the looked-up one in ``listed`` by at most a share of that.

    A price that does not parse is another rule's matter, and one without a listed price is not judged.
    """

    def fails(value: Column) -> Column:
        price = parsed(F.col(listed))
        apart = F.abs(parsed(value) - price) > price * F.lit(share).cast("decimal(6,4)")
        return ~T.is_missing(F.col(listed)) & F.coalesce(apart, F.lit(False))

    return _on("near", field, fails, lambda value: T.complaint(f"Unlisted {field}", value))


def computable(field: str, parsed: Callable[[Column], Column]) -> Rule:
    """The field parses to a number, so the derived fields of its row can be computed."""
    return _on(
        "computable",
        field,
        lambda value: parsed(value).isNull(),
        lambda value: T.complaint(f"Invalid {field}", value),
    )
